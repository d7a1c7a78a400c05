"""Keyed state in the stream itself: the newest row of each key, forgotten after a time without rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stayline.streaming.jobs import merge_to, merge_updates

AT = "_at"  # the time as a whole number of microseconds, which state and Python hold exactly


def _newest(rows: pd.DataFrame, by: list[str], key: str) -> pd.DataFrame:
    return rows.sort_values(by, kind="stable").drop_duplicates(key, keep="last")


def _keep_newest(key: str, by: list[str], names: list[str], ttl_ms: int):
    """A row whenever a key's newest row changes; the state is the place of that row in the order."""

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = tuple(state.get) if state.exists else None
        best, newest = None, held
        for part in parts:
            at = np.lexsort([part[c].to_numpy() for c in reversed(by)])[-1]
            place = tuple(int(part[c].iat[at]) for c in by)
            if newest is None or place > newest:
                best, newest = part.iloc[[at]], place
        if best is not None:
            state.update(newest)
            yield best[names]
        state.setTimeoutDuration(ttl_ms)

    return run


def latest_stateful(
    df: DataFrame, key: str, ts: str, tiebreak: str, path: str, checkpoint: str, ttl_ms: int | None = None, once: bool = True
) -> StreamingQuery:
    """Newest row per key as a log of changes below `path`; `jobs.read_latest` folds the log.

    `tiebreak` is a whole number. Without `ttl_ms` the state is the newest row of every key, kept by a streaming
    aggregate: a batch logs the newest row so far of each key that it has, and each task sends one row per key.
    With it, state is one pair of numbers per key that had rows in the last `ttl_ms` of processing time; a key's rows go through
    Python, and a row is logged whenever the newest changes. There is no watermark, so no row is too late; a key that comes back after
    its state went logs a row once more, which the reader folds alike. There, each task keeps the newest row per key
    of an Arrow batch before the shuffle, so a key with a third of all rows is thinned out. Rows with a NULL
    key, time or tie-break column are left out. A checkpoint belongs to one of the two ways.
    """
    if ttl_ms and once:
        raise ValueError("state expires in a running query only: Spark runs batches for timeouts without end")
    names, by = df.columns, [AT, tiebreak]
    timed = df.dropna(subset=[key, ts, tiebreak]).withColumn(AT, F.unix_micros(F.col(ts).cast("timestamp")))
    if not ttl_ms:
        newest = F.max_by(F.struct(*names), F.struct(*by)).alias("_row")
        return merge_updates(timed.groupBy(key).agg(newest).select("_row.*"), path, checkpoint, once)

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield _newest(b, by, key)

    few = timed.mapInPandas(thin, timed.schema)
    changes = few.groupBy(key).applyInPandasWithState(
        _keep_newest(key, by, names, ttl_ms), df.schema, "at bigint, tie bigint", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return merge_to(changes, lambda b: b, path, checkpoint, once)
