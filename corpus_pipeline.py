"""A corpus made ready for training, in five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and is written
as Parquet and read again before the next one. All but the last return the columns of `docs`, extra
ones included; n_chars, where there is one, follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.llm import bytebpe, forest, mixing, passages, quality
from stayline.session import materialize

WORDS, RATIO = 5, (80, 100)
ABOVE = 1 << 62  # from here on are the numbers of further texts of a doc_id


def set_aside(docs: DataFrame, names, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`step` on `docs`, with the columns of `docs` that have a name of the step's own put out of its way."""
    own = [c for c in docs.columns if c in names]
    away = {c: f"_own_{c}" for c in own}
    done = step(docs.withColumnsRenamed(away)).drop(*own)
    return done.withColumnsRenamed({v: k for k, v in away.items()})


def with_length(docs: DataFrame, changed) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: texts that it predicts as 0 go. It learns from the labelled texts of `docs` that are
    not held out; if there are none, every text stays. Empty texts are judged by the bias alone."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    def step(rows: DataFrame) -> DataFrame:
        weights = quality.train(rows, labels)
        return quality.score(rows, weights, keep_text=True).filter("predicted = 1")

    return set_aside(docs, ("score", "predicted"), step).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (words of five, Jaccard 0.8): of each component the smallest doc_id stays, with one
    row. Where a doc_id has several texts, all but one of them take part under numbers of their own, so that none
    is lost or kept for another's sake. Rows with a NULL doc_id, and texts without words, stay."""
    rows = docs.filter("doc_id is not null").withColumn("_md5", F.md5(F.coalesce("text", F.lit(""))))
    several = rows.groupBy("doc_id").agg(F.min("_md5").alias("_first"), F.max("_md5").alias("_last")).filter("_first <> _last")
    other = F.col("_md5") != F.col("_first")  # NULL where a doc_id has one text
    number = F.xxhash64("doc_id", "_md5").bitwiseAND(ABOVE - 1) + F.lit(ABOVE)
    rows = rows.join(several.drop("_last"), "doc_id", "left").withColumn("_key", F.when(other, number).otherwise(F.col("doc_id")))
    found = forest.near_duplicates(rows.select("_key", "text"), n_words=WORDS, ratio=RATIO, key="_key")
    stays = found.filter("kept").select("_key").distinct()
    one = Window.partitionBy("_key").orderBy(F.col("text").asc_nulls_last())
    kept = rows.join(stays, "_key", "left_semi").withColumn("_row", F.row_number().over(one)).filter("_row = 1")
    return kept.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages that repeat one of a text with a smaller doc_id are cut out. A text of which
    nothing is left goes; others stay, cut or not."""

    def step(rows: DataFrame) -> DataFrame:
        cut = passages.remove_repeats(rows, WORDS, RATIO)
        cut = cut.filter((F.col("n_removed") == 0) | (F.col("text") != ""))
        return with_length(cut, F.col("n_removed") > 0)

    return set_aside(docs, ("n_removed", "removed_bytes", "first_docs"), step).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a text comes as often as its source is repeated, a
    fractional repetition by some of its texts in full; texts that the mix does not take go."""

    def step(rows: DataFrame) -> DataFrame:
        return with_length(mixing.sample(mixing.mix(rows, whole_texts=True)), F.lit(True))

    names = ("size", "source_size", "target", "whole", "part", "taken")
    return set_aside(docs, names, step).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the columns of `docs`, with the text decoded from its ids, and ids and n_tokens."""
    def step(rows: DataFrame) -> DataFrame:
        coded = bytebpe.encode(rows, decoded="_text")
        return coded.withColumnRenamed("_text", "text").withColumn("n_tokens", F.size("ids").cast("bigint"))

    if {"ids", "n_tokens"} & set(docs.columns):
        docs = docs.drop("ids", "n_tokens")
    return step(docs).select(*docs.columns, "ids", "n_tokens")


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("source mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: A trained classifier is not an SQL expression; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-stage-{k + 1}")
    return docs
