import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stayline.operators.clean import latest_per_key
from stayline.streaming import jobs

SCHEMA = "event_id long, ts timestamp, user_id long, value double"


def events(n=600):
    rnd = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    return [(i, start + dt.timedelta(minutes=10 * i), rnd.randint(0, 9), rnd.random() * 200) for i in range(n)]


@pytest.fixture()
def folder(spark, tmp_path):
    """Events as several files in time order."""
    rows, path = events(), tmp_path / "in"
    for part in range(6):
        spark.createDataFrame(rows[part * 100 : (part + 1) * 100], SCHEMA).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def stream(spark, folder):
    return jobs.read_folder(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def shuffled(spark, path, parts, rows):
    """Files that arrive out of time order."""
    order = list(range(parts))
    random.Random(1).shuffle(order)
    for k in order:
        part = [r for r in rows if r[0] * parts // len(rows) == k]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return order


def test_windows_are_complete_whatever_the_order_of_files(spark, tmp_path):
    path, rows = str(tmp_path / "in"), events()
    shuffled(spark, path, 7, rows)
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    q = jobs.windows_to(stream(spark, path), "ts", lambda b: jobs.value_counts(b, "ts", "value"), out, log, str(tmp_path / "state"))
    q.awaitTermination()
    want = jobs.latency_stats(spark.createDataFrame(rows, SCHEMA), "ts", "value")
    got = jobs.latency_from(jobs.read_appended(spark, out))
    assert rows_of(got.drop("mean")) == rows_of(want.drop("mean"))
    arrived = jobs.arrivals(spark, log).collect()
    assert len(arrived) == 7 and sum(r["rows"] for r in arrived) == len(rows) and sum(r["late_rows"] for r in arrived) > 0


def test_percentiles_are_exact(spark):
    rows = [(i, dt.datetime(2024, 1, 1), 0, float((i * 7919) % 20_000)) for i in range(20_000)] + [(-1, dt.datetime(2024, 1, 1), 0, None)]
    r = jobs.latency_stats(spark.createDataFrame(rows, SCHEMA), "ts", "value").first()
    assert (r["n"], r["p50"], r["p95"], r["p99"], r["mean"]) == (20_001, 9999.0, 18999.0, 19799.0, 9999.5)


def test_running_totals(spark, folder, tmp_path):
    path = str(tmp_path / "o")
    jobs.merge_to(stream(spark, folder), lambda b: jobs.running_totals(b, "user_id"), path, str(tmp_path / "s")).awaitTermination()
    want = rows_of(jobs.running_totals(spark.createDataFrame(events(), SCHEMA), "user_id"))
    assert rows_of(jobs.totals_from(jobs.read_appended(spark, path), "user_id")) == want
    jobs.compact(spark, path, lambda d: jobs.totals_from(d, "user_id"))
    assert rows_of(jobs.totals_from(jobs.read_appended(spark, path + "-compacted"), "user_id")) == want


def test_restart_goes_on_where_it_stopped(spark, folder, tmp_path):
    out, state = str(tmp_path / "o"), str(tmp_path / "s")
    jobs.append_to(jobs.captured(stream(spark, folder), "event_id"), out, state).awaitTermination()
    once = jobs.read_appended(spark, out).count()
    more = spark.createDataFrame([(i, dt.datetime(2024, 2, 1), 1, 1.0) for i in range(1000, 1200)], SCHEMA)
    more.coalesce(1).write.mode("append").parquet(folder)
    jobs.append_to(jobs.captured(stream(spark, folder), "event_id"), out, state).awaitTermination()
    want = jobs.captured(spark.createDataFrame(events(), SCHEMA).unionByName(more), "event_id")
    assert jobs.read_appended(spark, out).count() == want.count() > once


def test_first_and_latest_per_key(spark, folder, tmp_path):
    jobs.first_wins(stream(spark, folder), "user_id", "ts", "event_id", str(tmp_path / "o"), str(tmp_path / "s")).awaitTermination()
    firsts = jobs.read_first(spark, str(tmp_path / "o"), "user_id", "ts", "event_id")
    assert rows_of(firsts) == rows_of(jobs.first_rows(spark.createDataFrame(events(), SCHEMA), "user_id", "ts", "event_id"))
    jobs.latest_wins(stream(spark, folder), "user_id", "ts", "event_id", str(tmp_path / "lo"), str(tmp_path / "ls")).awaitTermination()
    got = jobs.read_latest(spark, str(tmp_path / "lo"), "user_id", "ts", "event_id")
    want = latest_per_key(spark.createDataFrame(events(), SCHEMA), "user_id", "ts", "event_id")
    assert rows_of(got) == rows_of(want)


def test_late_rows_are_counted_and_kept(spark, tmp_path):
    path = str(tmp_path / "in")
    late = [(9000 + i, dt.datetime(2023, 12, 1), 1, 5.0) for i in range(7)]
    for part in (events(200), events(210)[200:], late):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    out, log = str(tmp_path / "o"), str(tmp_path / "l")
    parts = lambda b: jobs.rate_counts(b, "ts", F.col("value") > 100, "1 day")
    jobs.windows_to(stream(spark, path), "ts", parts, out, log, str(tmp_path / "s")).awaitTermination()
    got = jobs.rate_from(jobs.read_appended(spark, out))
    assert got.agg(F.min("window_start")).first()[0] == dt.datetime(2023, 12, 1)
    assert got.agg(F.sum("n")).first()[0] == 217
    assert sum(r["late_rows"] for r in jobs.arrivals(spark, log).collect()) == 7


def test_scoring_quarantines_bad_requests(spark, tmp_path):
    names = "tenure_months monthly_charges total_charges num_products support_calls payment_delay_days age satisfaction_score segmento".split()
    ddl = "customer_id long, " + ", ".join(f"{n} string" for n in names)
    rows = [
        (1, "60", "120", "7200", "5", "0", "0", "55", "9.5", "PF"),
        (2, "3", "450", "1350", "1", "12", "25", "22", "1.5", None),
        (3, "doze", "120", "7200", "5", "0", "0", "55", "9.5", "PF"),
        (4, "60", "120", "7200", "5", None, "0", "99", "9.5", "PF"),
    ]
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "in"))
    known = spark.createDataFrame([("PF", 0, "low"), ("PF", 1, "high")], "segmento string, cluster_id int, perfil_label string")

    def fake(df):
        risky = F.when(F.col("support_calls") > 5, 1).otherwise(0)
        return df.withColumns({"cluster_id": risky, "probability": risky * 0.9})

    schema = spark.createDataFrame([], ddl).schema
    jobs.score_requests(
        jobs.read_folder(spark, str(tmp_path / "in"), schema), fake, known,
        str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "state"), "m1",
    ).awaitTermination()
    good = {r["customer_id"]: r for r in jobs.read_appended(spark, str(tmp_path / "ok")).collect()}
    bad = {r["customer_id"]: r["errors"] for r in jobs.read_appended(spark, str(tmp_path / "bad")).collect()}
    assert set(good) == {1, 2} and good[2]["risk_level"] == "ALTO" and good[2]["perfil_label"] == "high"
    assert bad == {3: ["tenure_months:type"], 4: ["support_calls:missing", "age:range"]}
