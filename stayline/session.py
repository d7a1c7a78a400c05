"""Session helpers: shared scratch tables and size checks before broadcasting."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark deletes a query's shuffle files as soon as the query ends.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "stayline", cpus: str = "*", **conf) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the given one."""
    n = "8" if cpus == "*" else cpus
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only in local mode."""
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        path = tempfile.mkdtemp(prefix="stayline-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_SCOPES: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that are written inside once their results have been consumed."""
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in _SCOPES.pop():
            path = hadoop.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def kept_scratch() -> Iterator[None]:
    """Inside, tables outlive the scope around: they are shared by later queries of the application."""
    _SCOPES.append([])
    try:
        yield
    finally:
        _SCOPES.pop()


@contextlib.contextmanager
def outer_scratch() -> Iterator[None]:
    """Inside, tables belong to the scope around the present one, and outlive the present one."""
    inner = _SCOPES.pop()
    try:
        yield
    finally:
        _SCOPES.append(inner)


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write once as Parquet in the shared folder and read back.

    Used where a costly sub-plan has several readers: the lineage is cut, a lost
    executor does not redo the work, and every reader sees the same rows. The sub-plan's shuffle
    files have no reader once the table is written and are deleted.
    """
    path = new_path(df.sparkSession, name)
    before = df.sparkSession.conf.get(CLEANUP_CONF, "false")
    df.sparkSession.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        df.sparkSession.conf.set(CLEANUP_CONF, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A short driver-side list as a local relation (no job, known size)."""
    schema = spark.createDataFrame([], ddl).schema
    arrow = pa.Table.from_pandas(
        pd.DataFrame([tuple(r) for r in rows], columns=schema.names),
        schema=to_arrow_schema(schema),
        preserve_index=False,
    )
    return spark.createDataFrame(arrow, schema)


def fits(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after a row count; otherwise leave the join to AQE."""
    return F.broadcast(df) if fits(df, max_rows) else df
