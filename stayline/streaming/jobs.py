"""Streaming jobs over file sources.

Sinks are written per micro-batch into a folder named by the batch number, so a batch
that runs again after a failure replaces its own output. Jobs keep no state in Spark: each
batch writes aggregates that can be merged (counts, sums, histograms, the first or newest row
of a key), and reading merges them. So no row is ever too late to count, whatever the number and order
of files; rows later than a delay are counted in a log, not dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayline.operators import score, validate
from stayline.operators.clean import latest_per_key
from stayline.operators.ranks import prefix_sums, quantiles_from
from stayline.operators.split import capture_sample

DELAY = "1 hour"
BATCH = "_batch"


def read_folder(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _write_batch(df: DataFrame, batch: int, path: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def start(df: DataFrame, sink: Callable, checkpoint: str, mode: str = "append", once: bool = True) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_to(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    return start(df, lambda b, i: _write_batch(b, i, path), checkpoint, "append", once)


def merge_to(df: DataFrame, parts: Callable, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """`parts(batch)`, mergeable aggregates of each batch, appended; the reader merges them."""
    return start(df, lambda b, i: _write_batch(parts(b), i, path), checkpoint, "append", once)


def merge_updates(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """The groups of a streaming aggregate that a batch has, appended; the reader takes the last of each."""
    return start(df, lambda b, i: _write_batch(b, i, path), checkpoint, "update", once)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)


def compact(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Replace all batches written so far by one merged table.

    `merge` must give the same result on merged and unmerged rows. The merged rows take the place of
    the newest batch, in a new folder beside the old one, which readers use until the next call.
    """
    newest = spark.read.parquet(path).agg(F.max(BATCH)).first()[0]
    done = f"{path.rstrip('/')}-compacted"
    merge(read_appended(spark, path)).write.mode("overwrite").parquet(f"{done}/{BATCH}={newest}")


def _log_arrivals(batch: DataFrame, number: int, ts: str, delay: str, log: str) -> None:
    spark = batch.sparkSession
    newest = None
    if number:
        newest = spark.read.parquet(log).filter(F.col(BATCH) < number).agg(F.max("newest")).first()[0]
    late = F.lit(0)
    if newest is not None:
        late = F.count(F.when(F.col(ts) < F.lit(newest) - F.expr(f"interval {delay}"), 1))
    row = batch.agg(F.count(F.lit(1)).alias("rows"), late.cast("bigint").alias("late_rows"), F.max(ts).alias("newest"))
    _write_batch(row, number, log)


def windows_to(
    df: DataFrame,
    ts: str,
    parts: Callable[[DataFrame], DataFrame],
    output: str,
    log: str,
    checkpoint: str,
    delay: str = DELAY,
    once: bool = True,
) -> StreamingQuery:
    """Windowed aggregates of every row, early or late, and a log of arrivals.

    `parts` makes mergeable rows per window. The log has a row per batch: rows, late_rows (input
    rows more than `delay` older than the newest row of earlier batches) and the newest time.
    """

    def handle(batch: DataFrame, number: int) -> None:
        _write_batch(parts(batch), number, output)
        _log_arrivals(batch, number, ts, delay, log)

    return start(df, handle, checkpoint, "append", once)


def arrivals(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log).select(F.col(BATCH).cast("bigint").alias("batch"), "rows", "late_rows")


# --- jobs ----------------------------------------------------------------------------


def score_requests(
    requests: DataFrame,
    assign_and_score: Callable[[DataFrame], DataFrame],
    cards: DataFrame,
    output: str,
    quarantine: str,
    checkpoint: str,
    model_version: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Validate text requests, score the valid ones, attach the card; the rest is quarantined.

    `assign_and_score` adds `cluster_id` and `probability` to typed rows.
    """
    cards = cards.select("segmento", "cluster_id", "perfil_label")

    def handle(batch: DataFrame, number: int) -> None:
        good, bad = validate.split_valid(validate.validate_requests(batch))
        answered = score.respond(score.lookup_cards(assign_and_score(good), cards), model_version=model_version)
        _write_batch(answered, number, output)
        _write_batch(bad, number, quarantine)

    return start(requests, handle, checkpoint, "append", once)


def first_rows(df: DataFrame, key: str, ts: str, tiebreak: str) -> DataFrame:
    """Earliest row per key; summed up in the tasks first, so a key with very many rows is no load."""
    rest = [c for c in df.columns if c not in (key, ts, tiebreak)]
    first = df.groupBy(key).agg(F.min(F.struct(ts, tiebreak, *rest)).alias("_first"))
    return first.select(key, *[F.col(f"_first.{c}").alias(c) for c in (ts, tiebreak, *rest)])


def first_wins(df: DataFrame, key: str, ts: str, tiebreak: str, path: str, checkpoint: str, once: bool = True):
    """Deduplication of a stream: the earliest row of each key, over all batches (`read_first`)."""
    return merge_to(df, lambda b: first_rows(b, key, ts, tiebreak), path, checkpoint, once)


def read_first(spark: SparkSession, path: str, key: str, ts: str, tiebreak: str) -> DataFrame:
    return first_rows(read_appended(spark, path), key, ts, tiebreak)


def latest_wins(df: DataFrame, key: str, ts: str, tiebreak: str, path: str, checkpoint: str, once: bool = True):
    """Newest row per key of each batch; `read_latest` merges the batches on read."""

    def handle(batch: DataFrame, number: int) -> None:
        _write_batch(latest_per_key(batch, key, ts, tiebreak), number, path)

    return start(df, handle, checkpoint, "append", once)


def read_latest(spark: SparkSession, path: str, key: str, ts: str, tiebreak: str) -> DataFrame:
    return latest_per_key(read_appended(spark, path), key, ts, tiebreak)


def _in_window(ts: str, width: str, step: str | None) -> Column:
    return F.window(ts, width, step) if step else F.window(ts, width)


def _flat_window(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


WINDOW = ("window_start", "window_end")


def value_counts(df: DataFrame, ts: str, value: str, width: str = "1 day") -> DataFrame:
    """Histogram of a value per tumbling window; histograms of parts of the rows add up."""
    counts = df.groupBy(_in_window(ts, width, None).alias("window"), F.col(value).alias("value"))
    return _flat_window(counts.agg(F.count(F.lit(1)).alias("n")))


def latency_from(counts: DataFrame) -> DataFrame:
    """Requests, mean and exact percentiles per window from histograms. NULL values only count as requests."""
    whole = counts.groupBy(*WINDOW, "value").agg(F.sum("n").alias("n"))
    known = F.col("value").isNotNull()
    # Decimals add up to the same sum in any order, so a mean does not depend on how rows were dealt.
    total = F.sum(F.col("value").cast("decimal(18,6)") * F.col("n").cast("decimal(18,0)"))
    mean = (total / F.sum(F.when(known, F.col("n")))).cast("decimal(28,12)").cast("double")
    stats = whole.groupBy(*WINDOW).agg(F.sum("n").alias("n"), mean.alias("mean"))
    ranked = prefix_sums(whole.filter(known), "value", ["n"], WINDOW)
    marks = quantiles_from(ranked, "value", (0.5, 0.95, 0.99), WINDOW)
    marks = marks.withColumnsRenamed({"q0": "p50", "q1": "p95", "q2": "p99"})
    return stats.join(marks, list(WINDOW), "left")


def value_sketches(df: DataFrame, ts: str, value: str, width: str = "1 hour") -> DataFrame:
    """A KLL sketch of a value per tumbling window: a few KB each, whatever the rows. Sketches of parts of the rows merge."""
    sketches = df.groupBy(_in_window(ts, width, None).alias("window")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value)).alias("sketch")
    )
    return _flat_window(sketches)


def sketched_latency(sketches: DataFrame, width: str = "1 day", marks=(0.5, 0.95, 0.99)) -> DataFrame:
    """Requests and approximate percentiles (p50, ...) per wider window, merged from `value_sketches`."""
    merged = sketches.groupBy(F.window("window_start", width).alias("window")).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    at = {f"p{round(100 * q)}": F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for q in marks}
    return _flat_window(merged.withColumns(at).drop("sketch"))


def latency_stats(df: DataFrame, ts: str, value: str, width: str = "1 day") -> DataFrame:
    return latency_from(value_counts(df, ts, value, width))


def rate_counts(df: DataFrame, ts: str, indicator: Column, width: str, step: str | None = None) -> DataFrame:
    """Rows and rows with the indicator per (sliding) window."""
    counts = df.groupBy(_in_window(ts, width, step).alias("window")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(indicator).alias("hits")
    )
    return _flat_window(counts)


def rate_from(counts: DataFrame) -> DataFrame:
    whole = counts.groupBy(*WINDOW).agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return whole.select(*WINDOW, "n", (F.col("hits") / F.col("n")).alias("rate"))


def rate_in_windows(df: DataFrame, ts: str, indicator: Column, width: str, step: str | None = None) -> DataFrame:
    """Share of rows with the indicator per (sliding) window."""
    return rate_from(rate_counts(df, ts, indicator, width, step))


def drift_from_baseline(rates: DataFrame, baseline: float, limit: float) -> DataFrame:
    """Each window's rate against the rate of a reference period, and whether it moved by more than `limit`."""
    moved = F.col("rate") - F.lit(baseline)
    return rates.withColumns({"baseline": F.lit(baseline), "drifted": (F.abs(moved) > limit).cast("int")})


def running_totals(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def totals_from(parts: DataFrame, key: str) -> DataFrame:
    return parts.groupBy(key).agg(F.sum("n").alias("n"))


def file_sink(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Rows appended by Spark's own Parquet sink. Its log names the files of finished batches, and readers of
    `path` follow the log, so a batch that is repeated after a failure counts once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def captured(df: DataFrame, key: str, percent: int = 20, seed: int = 42) -> DataFrame:
    return capture_sample(df, percent, key, seed)
