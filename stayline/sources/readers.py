"""Reading raw customers, split folders and nested card files."""

from __future__ import annotations

import csv
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.schema import CUSTOMER_SCHEMA

CORRUPT = "_corrupt_record"

CARD_STRUCT = (
    "struct<cluster_id:int,segmento:string,perfil_label:string,risk_level:string,"
    "churn_rate:double,cobertura_pct:double,n_amostras:bigint,description:string,"
    "feature_means:map<string,double>,action_recommendation:string,"
    "gargalos:array<string>,rag_tags:array<string>>"
)
CARDS_TYPE = f"map<string,map<string,{CARD_STRUCT}>>"


def csv_headers(spark: SparkSession, path) -> DataFrame:
    """(header, files): the first lines of the CSV files below a path, and the files that begin with each.

    Only the first block of a file is looked at. There are a few headers, and as many files as the reader lists anyway.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"))
    place = F.monotonically_increasing_id()
    first = lines.withColumn("_row", place).filter("_at = 0").groupBy("file").agg(F.min_by("value", "_row").alias("header"))
    return first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files"))


def header_names(header: str) -> list[str]:
    """The column names of a header line; quotes, a byte order mark and blanks around names are left out."""
    return [c.strip() for c in next(csv.reader([header.lstrip("\ufeff")]), [])]


def read_customers_csv(
    spark: SparkSession, path, schema: T.StructType = CUSTOMER_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantined records with the names of the bad fields) from CSV folders.

    Columns are taken by the names in each file's header, in any order and file by file: those that a file lacks are
    NULL, those that `schema` lacks are not read (`csv_headers` names them). Files with the same header are read together.
    All fields are read as text and cast by expressions. The reader's own check looks only
    at the fields a query selects, so a bad field would go unnoticed in a narrow query.
    """
    heads = [(header_names(r["header"]), r["files"]) for r in csv_headers(spark, path).collect()]
    parts = [_read_by_name(spark, names, files, schema) for names, files in sorted(heads, key=lambda h: h[1])]
    if not parts:
        parts = [_read_by_name(spark, [f.name for f in schema.fields], path, schema)]
    good, bad = zip(*parts)
    return functools.reduce(DataFrame.unionByName, good), functools.reduce(DataFrame.unionByName, bad)


def _read_by_name(spark: SparkSession, header: list[str], path, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    known = {f.name for f in schema.fields}
    # An unknown or repeated name gets one of its own place, so that it takes its field and no other.
    own = [c if c in known and c not in header[:k] else f"_{k}" for k, c in enumerate(header)]
    text_schema = T.StructType([T.StructField(c, T.StringType()) for c in [*own, CORRUPT]])
    raw = (
        spark.read.schema(text_schema)
        .options(
            header=True,
            sep=",",
            quote='"',
            recursiveFileLookup=True,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
            columnPruning=False,
        )
        .csv(path)
    )
    raw = raw.withColumns({f.name: F.lit(None).cast("string") for f in schema.fields if f.name not in own})
    names = [f.name for f in schema.fields]
    bad_fields = F.array_compact(
        F.array(
            *[
                F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), f.name)
                for f in schema.fields
            ],
            F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT)),
        )
    )
    checked = raw.withColumn("errors", bad_fields)
    good = cast_columns(checked.filter(F.size("errors") == 0), schema)
    record = F.coalesce(CORRUPT, F.to_json(F.struct(*names)))
    bad = checked.filter(F.size("errors") > 0).select(names[0], "errors", record.alias("record"))
    return good, bad


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed projection of text columns; what does not parse becomes NULL."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns]
    )


def _exists(spark: SparkSession, pattern: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return found is not None and len(found) > 0


def load_folder_checked(
    spark: SparkSession, path: str, schema: T.StructType = CUSTOMER_SCHEMA
) -> tuple[DataFrame, DataFrame | None]:
    """(rows, quarantined records): Parquet if the folder has any, else CSV, else an error.

    Parquet is typed already and has no quarantine (None).
    """
    if _exists(spark, f"{path}/*.parquet"):
        return spark.read.parquet(path), None
    if _exists(spark, f"{path}/*.csv"):
        return read_customers_csv(spark, path, schema)
    raise FileNotFoundError(f"no parquet or csv files in {path}")


def load_folder(spark: SparkSession, path: str, schema: T.StructType = CUSTOMER_SCHEMA) -> DataFrame:
    """Rows of a folder; fails on records of a CSV folder that do not fit the schema."""
    rows, bad = load_folder_checked(spark, path, schema)
    if bad is not None and bad.limit(1).count():
        raise ValueError(f"{path} has records that do not fit; use load_folder_checked")
    return rows


def explode_cards(nested: DataFrame, column: str = "cards") -> DataFrame:
    """Flat card rows from a map segment -> cluster key -> card."""
    by_segment = nested.select(F.explode(column).alias("_segment", "_clusters"))
    by_cluster = by_segment.select(F.explode("_clusters").alias("cluster_key", "card"))
    return by_cluster.select("cluster_key", "card.*")


def parse_cards(text: Column) -> Column:
    return F.from_json(text, CARDS_TYPE)


def read_cards_json(spark: SparkSession, path) -> DataFrame:
    raw = spark.read.option("wholetext", True).text(path)
    return explode_cards(raw.select(parse_cards(F.col("value")).alias("cards")))
