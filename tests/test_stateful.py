import time

import pytest
from pyspark.sql import functions as F

from stayline.operators.clean import latest_per_key
from stayline.streaming import jobs, stateful
from tests.test_streaming import SCHEMA, events, rows_of, stream


def add(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, folder, out, state, **more):
    return stateful.latest_stateful(stream(spark, folder), "user_id", "ts", "event_id", out, state, **more)


def test_latest_over_arrivals_out_of_order_and_restarts(spark, tmp_path):
    rows = [r for r in events() if r[2] != 9] + [(1000, events()[-1][1], 5, None), (1001, None, 5, 1.0), (1002, events()[0][1], None, 1.0)]
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for k in (4, 0, 3, 1, 2):  # the query is stopped and started again from its checkpoint each time
        add(spark, folder, rows[k::5])
        q = run(spark, folder, out, state)
        q.awaitTermination()
        assert q.lastProgress.stateOperators[0].numRowsTotal <= 9  # a state row per key, not per event
    known = spark.createDataFrame(rows, SCHEMA).dropna(subset=["user_id", "ts"])
    want = latest_per_key(known, "user_id", "ts", "event_id")
    got = jobs.read_latest(spark, out, "user_id", "ts", "event_id")
    assert rows_of(got) == rows_of(want) and got.count() == 9
    assert spark.read.parquet(out).count() < known.count()


def held(q):
    return q.lastProgress.stateOperators[0].numRowsTotal if q.lastProgress else None


def wait(done, seconds=40):
    until = time.time() + seconds
    while not done():
        assert time.time() < until
        time.sleep(0.3)


def test_state_goes_after_its_time_and_no_row_is_lost(spark, tmp_path):
    rows = events(60)
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    add(spark, folder, rows[30:])
    q = run(spark, folder, out, state, ttl_ms=4000, once=False)
    try:
        wait(lambda: held(q) and held(q) > 0)
        wait(lambda: held(q) == 0)
        add(spark, folder, rows[:30])  # older rows, whose keys have no state any more
        wait(lambda: spark.read.parquet(out).filter(F.col("event_id") < 30).count() > 0)
    finally:
        q.stop()
    want = latest_per_key(spark.createDataFrame(rows, SCHEMA), "user_id", "ts", "event_id")
    assert rows_of(jobs.read_latest(spark, out, "user_id", "ts", "event_id")) == rows_of(want)


def test_expiry_needs_a_running_query(spark, tmp_path):
    add(spark, str(tmp_path / "in"), events(5))
    with pytest.raises(ValueError, match="running query"):
        run(spark, str(tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "s"), ttl_ms=1000)


def test_file_sink_counts_a_repeated_batch_once(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = events(40)
    add(spark, folder, rows[:20])
    jobs.file_sink(stream(spark, folder), out, state).awaitTermination()
    # The batch is undone in the checkpoint as if the job had died before its commit, then runs again.
    for name in (tmp_path / "state" / "commits").iterdir():
        if name.name.lstrip(".").startswith("0"):
            name.unlink()
    add(spark, folder, rows[20:])
    jobs.file_sink(stream(spark, folder), out, state).awaitTermination()
    assert rows_of(spark.read.parquet(out)) == rows_of(spark.createDataFrame(rows, SCHEMA))


def test_no_key_goes_through_python_without_expiry(spark, tmp_path):
    """Ties, NULL values and arrays are kept by the aggregate; older rows of a later batch change nothing."""
    ts = events(3)
    rows = [(1, ts[0][1], 5, None, [1]), (2, ts[2][1], 5, 2.0, None), (3, ts[2][1], 5, None, [None, 3]), (4, ts[1][1], 6, 4.0, [])]
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    kinds = SCHEMA + ", tags array<int>"
    for part in (rows[2:], rows[:2]):
        spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(folder)
        live = jobs.read_folder(spark, folder, spark.createDataFrame([], kinds).schema)
        q = stateful.latest_stateful(live, "user_id", "ts", "event_id", out, state)
        q.awaitTermination()
        assert [(s.operatorName, s.numRowsTotal) for s in q.lastProgress.stateOperators] == [("stateStoreSave", 2)]
    got = jobs.read_latest(spark, out, "user_id", "ts", "event_id")
    assert sorted((r["user_id"], r["event_id"], r["value"], r["tags"]) for r in got.collect()) == [(5, 3, None, [None, 3]), (6, 4, 4.0, [])]
