"""Streaming jobs run to the end of the given tables; results must equal the batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators import model
from stayline.operators.cluster_metrics import assign_nearest, fit_centroids
from stayline.operators.scaling import fit_standard
from stayline.plans.base import (
    DIST_SQL,
    RAW_SCORE,
    clean_table,
    query,
    raw_score,
    table,
    z_names,
)
from stayline.plans.etl import _TEXT, text_requests
from stayline.plans.evaluation import _rounded
from stayline.plans.models import trained_model
from stayline.plans.monitoring import CAPTURE_SQL, LATENCY_SQL, RATE_SQL, TOTALS_SQL
from stayline.plans.segmentation import CARDS, cards
from stayline.schema import FEATURES_8
from stayline.session import materialize, new_path
from stayline.streaming import jobs, stateful


def stream_table(spark, sf, name: str) -> DataFrame:
    """A table as a file stream; the bracket lets one file or a folder of files match."""
    schema = table(spark, sf, name).schema
    return jobs.read_folder(spark, f"{sf}/{name[:-1]}[{name[-1]}].parquet", schema)


def paths(spark) -> tuple[str, str]:
    return new_path(spark, "stream-out"), new_path(spark, "stream-state")


def _finish(q) -> None:
    q.awaitTermination()


def _windows_ntz(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


ARRIVAL = (2, 0, 3, 1)  # weeks of the month in the order in which they arrive


def in_arrivals(spark, sf, *columns: str):
    """(schema, folder, next) of events that arrive out of time order: next(k) adds the k-th part as files."""
    rows = table(spark, sf, "events").select("ts", *columns)
    folder = new_path(spark, "arrivals")
    week = F.floor((F.dayofmonth("ts") - 1) / 8)
    place = F.least(week, F.lit(len(ARRIVAL) - 1))

    def add(k: int) -> None:
        rows.filter(place == ARRIVAL[k]).write.mode("append").parquet(folder)

    return rows.schema, folder, add


def run_arrivals(spark, sf, parts, *columns: str) -> tuple[str, str]:
    """The windowed job stopped and started again for each arrival; returns output and log."""
    schema, folder, add = in_arrivals(spark, sf, *columns)
    out, state = paths(spark)
    log = new_path(spark, "stream-log")
    for k in range(len(ARRIVAL)):
        add(k)
        live = jobs.read_folder(spark, folder, schema, files_per_batch=1_000_000)  # an arrival is one batch
        _finish(jobs.windows_to(live, "ts", parts, out, log, state))
    return out, log


@query(LATENCY_SQL)
def stream_latency(spark, sf) -> DataFrame:
    out, _ = run_arrivals(spark, sf, lambda b: jobs.value_counts(b, "ts", "value"), "value")
    return _rounded(_windows_ntz(jobs.latency_from(jobs.read_appended(spark, out))), "mean")


def high(value: str = "value"):
    return F.col(value) > 100


@query(RATE_SQL)
def stream_sliding_rate(spark, sf) -> DataFrame:
    out, _ = run_arrivals(spark, sf, lambda b: jobs.rate_counts(b, "ts", high(), "7 days", "1 day"), "value")
    return _rounded(_windows_ntz(jobs.rate_from(jobs.read_appended(spark, out))), "rate")


def _drift_sql(days: int) -> str:
    return f"""WITH e AS (SELECT ts, value, unnest(range({days})) AS back FROM events),
    w AS (SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') - back * INTERVAL '1 day' AS s, value FROM e),
    r AS (SELECT s, count(*) AS n, count(*) FILTER (value > 100) / count(*) AS rate FROM w GROUP BY s),
    b AS (SELECT count(*) FILTER (value > 100) / count(*) AS baseline FROM events WHERE ts < TIMESTAMP '2024-01-08')
    SELECT s AS window_start, s + INTERVAL '{days} days' AS window_end, n, round(rate, 6) AS rate, round(baseline, 6) AS baseline,
      CASE WHEN abs(rate - baseline) > 0.02e0 THEN 1 ELSE 0 END AS drifted FROM r, b"""


def stream_drift(spark, sf, days: int) -> DataFrame:
    """Share of high values per sliding window against the first week's."""
    first_week = table(spark, sf, "events").filter("ts < '2024-01-08'")
    baseline = first_week.agg(F.count_if(high()) / F.count(F.lit(1))).first()[0] or 0.0
    width = f"{days} days"
    out, _ = run_arrivals(spark, sf, lambda b: jobs.rate_counts(b, "ts", high(), width, "1 day"), "value")
    rates = _windows_ntz(jobs.rate_from(jobs.read_appended(spark, out)))
    return _rounded(jobs.drift_from_baseline(rates, baseline, 0.02), "rate", "baseline")


@query(_drift_sql(7))
def stream_drift_7d(spark, sf) -> DataFrame:
    return stream_drift(spark, sf, 7)


@query(_drift_sql(30))
def stream_drift_30d(spark, sf) -> DataFrame:
    return stream_drift(spark, sf, 30)


@query(
    f"""WITH e AS (SELECT ts, list_position({list(ARRIVAL)}, least((day(ts) - 1) // 8, {len(ARRIVAL) - 1})) - 1 AS batch FROM events),
    m AS (SELECT batch, max(ts) AS newest FROM e GROUP BY batch),
    s AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM m)
    SELECT CAST(e.batch AS BIGINT) AS batch, count(*) AS rows, count(*) FILTER (ts < seen - INTERVAL '1 hour') AS late_rows
    FROM e JOIN s ON e.batch = s.batch GROUP BY e.batch"""
)
def stream_late_rows(spark, sf) -> DataFrame:
    """Late input rows of each batch; they are counted and still in their windows."""
    _, log = run_arrivals(spark, sf, lambda b: jobs.rate_counts(b, "ts", high(), "1 day"), "value")
    return jobs.arrivals(spark, log)


@query(TOTALS_SQL)
def stream_totals(spark, sf) -> DataFrame:
    out, state = paths(spark)
    events = stream_table(spark, sf, "events").select("event_type")
    _finish(jobs.merge_to(events, lambda b: jobs.running_totals(b, "event_type"), out, state))
    return jobs.totals_from(jobs.read_appended(spark, out), "event_type")


@query(CAPTURE_SQL)
def stream_capture(spark, sf) -> DataFrame:
    out, state = paths(spark)
    events = stream_table(spark, sf, "events").select("event_id", "value")
    _finish(jobs.append_to(jobs.captured(events, "event_id"), out, state))
    return jobs.read_appended(spark, out)


@query(
    f"""WITH c AS ({CAPTURE_SQL}) SELECT c.event_id, c.value, c_mktsegment FROM c JOIN events e ON e.event_id = c.event_id
    LEFT JOIN customer ON c_custkey = e.user_id"""
)
def stream_capture_sink(spark, sf) -> DataFrame:
    """Captured events with their user's segment through the Parquet sink; the job is started anew for each arrival."""
    schema, folder, add = in_arrivals(spark, sf, "event_id", "user_id", "value")
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    out, state = paths(spark)
    for k in range(len(ARRIVAL)):
        add(k)
        live = jobs.captured(jobs.read_folder(spark, folder, schema, files_per_batch=1_000_000), "event_id")
        _finish(jobs.file_sink(live.join(users, "user_id", "left").select("event_id", "value", "c_mktsegment"), out, state))
    return spark.read.parquet(out)


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def stream_latest_stateful(spark, sf) -> DataFrame:
    """The newest event of each user, held as state over arrivals out of time order and restarts."""
    schema, folder, add = in_arrivals(spark, sf, "user_id", "event_id", "value")
    out, state = paths(spark)
    for k in range(len(ARRIVAL)):
        add(k)
        live = jobs.read_folder(spark, folder, schema, files_per_batch=1_000_000)
        _finish(stateful.latest_stateful(live, "user_id", "ts", "event_id", out, state))
    return jobs.read_latest(spark, out, "user_id", "ts", "event_id").select("user_id", "event_id", "value")


@query("SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def stream_first_per_user(spark, sf) -> DataFrame:
    """The first event of each user, however late it arrives."""
    out, state = paths(spark)
    events = stream_table(spark, sf, "events").select("user_id", "ts", "event_id")
    _finish(jobs.first_wins(events, "user_id", "ts", "event_id", out, state))
    return jobs.read_first(spark, out, "user_id", "ts", "event_id").select("user_id", "event_id")


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def stream_latest_order(spark, sf) -> DataFrame:
    out, state = paths(spark)
    orders = stream_table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    _finish(jobs.latest_wins(orders, "o_custkey", "o_orderdate", "o_orderkey", out, state))
    latest = jobs.read_latest(spark, out, "o_custkey", "o_orderdate", "o_orderkey")
    return latest.select("o_custkey", "o_orderkey", "o_totalprice")


_Z_REQ = ", ".join(
    f"({'round_even(satisfaction_score, 1)' if f == 'satisfaction_score' else f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END AS z_{f}"
    for f in FEATURES_8
)
_SERVE = (
    CARDS
    + _TEXT[_TEXT.index("req AS (") - 2 :]
    + f""",
good AS (SELECT customer_id, segmento, {RAW_SCORE} AS p, {_Z_REQ} FROM checked, moments WHERE len(errors) = 0),
near AS (SELECT customer_id, arg_min(cid, (d, cid)) AS cluster_id FROM (SELECT customer_id, cid, {DIST_SQL} AS d FROM good, cent) GROUP BY customer_id)
SELECT good.customer_id, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS churn_prediction,
  CASE WHEN p < 0.30 THEN 'BAIXO' WHEN p < 0.60 THEN 'MÉDIO' ELSE 'ALTO' END AS risk_level, near.cluster_id, perfil_label, good.segmento
FROM good JOIN near ON near.customer_id = good.customer_id
LEFT JOIN cards ON cards.segmento = good.segmento AND cards.cluster_id = near.cluster_id"""
)


def serve_requests(spark, sf, assign_and_score=None) -> tuple[str, str]:
    """Text requests through the scoring job: (folder of answers, folder of quarantined requests)."""
    out, state = paths(spark)
    bad, source = new_path(spark, "quarantine"), new_path(spark, "requests")
    requests = text_requests(spark, sf)
    requests.write.parquet(source)
    clean = clean_table(spark, sf)
    params = fit_standard(clean, FEATURES_8)
    zs = z_names()
    scale = {f"z_{f}": (F.col(f).cast("double") - m) / s for f, (m, s) in params.items()}
    cents = fit_centroids(clean.withColumns(scale), zs, "segmento")
    known = materialize(cards(spark, sf), "cards")
    rate = assign_and_score or (lambda df: df.withColumn("probability", raw_score()))

    def handle(df: DataFrame) -> DataFrame:
        return rate(assign_nearest(df.withColumns(scale), zs, cents))

    stream = jobs.read_folder(spark, source, requests.schema)
    _finish(jobs.score_requests(stream, handle, known, out, bad, state))
    return out, bad


@query(f"WITH {_SERVE}")
def stream_scoring(spark, sf) -> DataFrame:
    """Text requests validated, scored, clustered and labelled with their card."""
    out, _ = serve_requests(spark, sf)
    return jobs.read_appended(spark, out).select(
        "customer_id", "churn_prediction", "risk_level", "cluster_id", "perfil_label", "segmento"
    )


@query(f"WITH {_TEXT} SELECT customer_id, array_to_string(errors, ',') AS errors FROM checked WHERE len(errors) > 0")
def stream_quarantine(spark, sf) -> DataFrame:
    """Requests that the scoring job turned away, with their errors."""
    _, bad = serve_requests(spark, sf)
    return jobs.read_appended(spark, bad).select("customer_id", F.array_join("errors", ",").alias("errors"))


@query(
    f"""WITH {_SERVE.rsplit("SELECT good.customer_id", 1)[0]} SELECT good.customer_id, 1 AS in_range, 1 AS decided, 1 AS banded,
    near.cluster_id, perfil_label, good.segmento FROM good JOIN near ON near.customer_id = good.customer_id
    LEFT JOIN cards ON cards.segmento = good.segmento AND cards.cluster_id = near.cluster_id"""
)
def stream_model_scoring(spark, sf) -> DataFrame:
    """The same job serving the trained pipeline; its answers must agree with their own probability."""
    fitted = trained_model(spark, sf)

    def rate(df: DataFrame) -> DataFrame:
        return model.score(df, fitted).drop("churn_prediction")

    out, _ = serve_requests(spark, sf, rate)
    p = F.col("churn_probability")
    band = F.when(p < 0.30, "BAIXO").when(p < 0.60, "MÉDIO").otherwise("ALTO")
    return jobs.read_appended(spark, out).select(
        "customer_id",
        p.between(0, 1).cast("int").alias("in_range"),
        (F.col("churn_prediction") == (p >= 0.5).cast("int")).cast("int").alias("decided"),
        (F.col("risk_level") == band).cast("int").alias("banded"),
        "cluster_id",
        "perfil_label",
        "segmento",
    )
