"""Data quality, drift, feature registry and batch monitoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.hashing import md5_uniform
from stayline.functions.numeric import exact_sum
from stayline.operators import metrics, quality, score, segment
from stayline.operators.clean import latest_per_key
from stayline.plans.base import (
    AS_OF,
    CLEAN,
    CLUSTERED,
    CUST,
    ORACLES,
    SEGMENT_SQL,
    clean_customers,
    clean_table,
    clustered_customers,
    customers,
    md5_mod,
    query,
    table,
)
from stayline.plans.evaluation import _rounded, curve_sql
from stayline.schema import FEATURES_8, FEATURES_11
from stayline.session import materialize, new_path
from stayline.sources import bucketed
from stayline.sources.registry import feature_registry as op_feature_registry
from stayline.streaming import jobs

_REF = f"{md5_mod(42, 'customer_id', 100)} < 80"


def long_sql(source: str, features, keep: str = "") -> str:
    pre = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {pre}'{f}' AS feature, {f}::DOUBLE AS v FROM {source}" for f in features)


def is_reference():
    return md5_uniform(42, "customer_id", 100) < 80


_LONG = CLEAN + f", base AS (SELECT *, {_REF} AS ref FROM clean), long AS ({long_sql('base', FEATURES_8, 'ref')})"


def compared(spark, sf) -> DataFrame:
    """Training part against the rest, per feature and value."""
    return quality.compared_histogram(clean_customers(spark, sf), FEATURES_8, is_reference())


@query(
    f"""WITH {_LONG},
    cuts AS (SELECT feature, quantile_disc(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM long WHERE ref GROUP BY feature),
    b AS (SELECT long.feature, ref, len(list_filter(q, lambda c: c < v)) AS bin FROM long JOIN cuts ON long.feature = cuts.feature),
    n AS (SELECT feature, bin, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM b GROUP BY ALL),
    p AS (SELECT feature, greatest(r / sum(r) OVER (PARTITION BY feature), 1e-4) AS p,
                 greatest(c / sum(c) OVER (PARTITION BY feature), 1e-4) AS q FROM n)
    SELECT feature, round(sum((p - q) * ln(p / q)), 6) AS psi FROM p GROUP BY feature"""
)
def population_stability(spark, sf) -> DataFrame:
    return _rounded(quality.population_stability(compared(spark, sf)), "psi")


@query(
    f"""WITH {_LONG}, h AS (SELECT feature, v, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM long GROUP BY ALL),
    k AS (SELECT feature, abs(sum(r) OVER w / sum(r) OVER (PARTITION BY feature) - sum(c) OVER w / sum(c) OVER (PARTITION BY feature)) AS gap
          FROM h WINDOW w AS (PARTITION BY feature ORDER BY v))
    SELECT feature, round(max(gap), 6) AS ks FROM k GROUP BY feature"""
)
def kolmogorov_smirnov(spark, sf) -> DataFrame:
    return _rounded(quality.kolmogorov_smirnov(compared(spark, sf)), "ks")


_HALF = dt.datetime(2024, 1, 15)


def _before_half():
    return F.col("ts") < F.lit(_HALF).cast("timestamp_ntz")


@query(
    """WITH cell AS (SELECT event_type, ts < TIMESTAMP '2024-01-15' AS ref, count(*)::DOUBLE AS o FROM events GROUP BY ALL),
    e AS (SELECT o, sum(o) OVER (PARTITION BY event_type) * sum(o) OVER (PARTITION BY ref) / sum(o) OVER () AS x FROM cell)
    SELECT round(sum((o - x) * (o - x) / x), 6) AS chi2, (SELECT count(DISTINCT event_type) - 1 FROM events) AS dof FROM e"""
)
def chi_square(spark, sf) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", "ts")
    return _rounded(quality.chi_square(events, "event_type", _before_half()), "chi2")


@query(
    """WITH base AS (SELECT avg(CASE WHEN value > 100 THEN 1e0 ELSE 0e0 END) AS b FROM events WHERE ts < TIMESTAMP '2024-01-15'),
    w AS (SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS s, count(*) AS n,
                 avg(CASE WHEN value > 100 THEN 1e0 ELSE 0e0 END) AS rate FROM events GROUP BY s)
    SELECT s AS window_start, s + INTERVAL '7 days' AS window_end, n, round(rate, 6) AS rate, round(rate - b, 6) AS drift FROM w, base"""
)
def prediction_drift(spark, sf) -> DataFrame:
    """Rate of positive outcomes (a value above 100) per week against the first two weeks."""
    events = table(spark, sf, "events").select("ts", "value")
    positive = F.col("value") > 100
    base = events.filter(_before_half()).agg(F.avg(positive.cast("double")))
    return _rounded(quality.prediction_drift(events, "ts", positive, base, "7 days"), "rate", "drift")


def _window_auc_sql(width: str) -> str:
    return f"""WITH ev AS (SELECT time_bucket(INTERVAL '{width}', ts, TIMESTAMP '1970-01-01') AS w,
      CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, value AS score FROM events),{curve_sql('ev', 'y', 'score', 'w')}
    SELECT w AS window_start, positives, negatives, round(roc_auc, 6) AS roc_auc FROM rank_metrics"""


def window_auc(spark, sf, width: str) -> DataFrame:
    scored = table(spark, sf, "events").select(
        F.window("ts", width)["start"].alias("window_start"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("y"),
        F.col("value").alias("score"),
    )
    ranked = metrics.ranking_metrics(scored, "y", "score", ["window_start"])
    return _rounded(ranked, "roc_auc").drop("average_precision")


@query(_window_auc_sql("7 days"))
def concept_drift_7d(spark, sf) -> DataFrame:
    return window_auc(spark, sf, "7 days")


@query(_window_auc_sql("30 days"))
def concept_drift_30d(spark, sf) -> DataFrame:
    return window_auc(spark, sf, "30 days")


def stats_sql(long: str) -> str:
    return f"""SELECT feature, count(*) AS n_rows, avg(CASE WHEN v IS NULL THEN 1e0 ELSE 0e0 END) AS null_rate, round(avg(v), 6) AS mean,
      round(stddev_pop(v), 6) AS std, min(v) AS min, max(v) AS max, quantile_disc(v, 0.25) AS p25,
      quantile_disc(v, 0.5) AS p50, quantile_disc(v, 0.75) AS p75 FROM {long} GROUP BY feature"""


_RAWLONG = CUST + f", rl AS ({long_sql('cust', FEATURES_8)})"


def raw_stats(spark, sf) -> DataFrame:
    return _rounded(quality.feature_stats(materialize(customers(spark, sf), "customers"), FEATURES_8), "mean", "std")


@query(f"WITH {_RAWLONG} {stats_sql('rl')}")
def feature_statistics(spark, sf) -> DataFrame:
    return raw_stats(spark, sf)


@query(
    f"""WITH {_RAWLONG}, st AS ({stats_sql('rl')}),
    ty AS (SELECT * FROM (VALUES ('tenure_months', 0, 'int'), ('monthly_charges', 1, 'double'), ('total_charges', 2, 'double'),
      ('num_products', 3, 'int'), ('support_calls', 4, 'int'), ('payment_delay_days', 5, 'int'), ('age', 6, 'int'),
      ('satisfaction_score', 7, 'double')) t(feature, position, type))
    SELECT ty.feature, position, type, 'v1' AS feature_version, n_rows, null_rate, mean, std, min, max, p25, p50, p75
    FROM ty LEFT JOIN st ON ty.feature = st.feature"""
)
def feature_registry(spark, sf) -> DataFrame:
    return op_feature_registry(raw_stats(spark, sf), customers(spark, sf), FEATURES_8, "v1")


@query(
    f"""WITH {_LONG}, s AS (SELECT feature, ref, avg(v) AS mean, stddev_pop(v) AS std,
        avg(CASE WHEN v IS NULL THEN 1e0 ELSE 0e0 END) AS null_rate FROM long GROUP BY ALL)
    SELECT c.feature, round(c.mean, 6) AS cur_mean, round(c.std, 6) AS cur_std, c.null_rate AS cur_null_rate,
      round(r.mean, 6) AS ref_mean, round(r.std, 6) AS ref_std, r.null_rate AS ref_null_rate,
      round(c.mean - r.mean, 5) AS diff_mean, round(c.std - r.std, 5) AS diff_std, c.null_rate - r.null_rate AS diff_null_rate
    FROM (SELECT * FROM s WHERE NOT ref) c FULL JOIN (SELECT * FROM s WHERE ref) r ON c.feature = r.feature"""
)
def statistics_drift(spark, sf) -> DataFrame:
    """Mean, deviation and share of NULLs of both parts, from one aggregate."""
    return _rounded(quality.compare_parts(clean_customers(spark, sf), FEATURES_8, is_reference()), "cur_mean", "cur_std", "ref_mean", "ref_std")


_FILLED = " + ".join(f"({f} IS NOT NULL)::INT" for f in FEATURES_8)


@query(
    f"""WITH {CUST}, s AS (SELECT *, {SEGMENT_SQL} AS segmento FROM cust)
    SELECT segmento, round(avg(({_FILLED}) / 8e0) * 100, 6) AS completeness_pct FROM s GROUP BY segmento"""
)
def completeness(spark, sf) -> DataFrame:
    df = segment.add_segment(customers(spark, sf))
    return _rounded(quality.completeness(df, FEATURES_8, "segmento"), "completeness_pct")


def _outlier_sql(bounds: str) -> str:
    return f"""WITH {CLEAN}, long AS ({long_sql('clean', FEATURES_8)}), {bounds}
    SELECT long.feature, count(*) AS n, count(*) FILTER (v < lo OR v > hi) AS outliers,
      count(*) FILTER (v < lo OR v > hi) / count(*) * 100 AS outlier_pct FROM long JOIN bd ON long.feature = bd.feature GROUP BY long.feature"""


@query(
    _outlier_sql(
        """q AS (SELECT feature, quantile_disc(v, 0.25) AS a, quantile_disc(v, 0.75) AS b FROM long GROUP BY feature),
    bd AS (SELECT feature, a - 1.5e0 * (b - a) AS lo, b + 1.5e0 * (b - a) AS hi FROM q)"""
    )
)
def outliers_iqr(spark, sf) -> DataFrame:
    return quality.outlier_rate(clean_customers(spark, sf), FEATURES_8, "iqr")


@query(
    _outlier_sql(
        "bd AS (SELECT feature, avg(v) - 3e0 * stddev_pop(v) AS lo, avg(v) + 3e0 * stddev_pop(v) AS hi FROM long GROUP BY feature)"
    )
)
def outliers_sigma(spark, sf) -> DataFrame:
    return quality.outlier_rate(clean_table(spark, sf), FEATURES_8, "sigma")


@query(
    f"WITH {CUST} "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {'1' if f in FEATURES_8 else '0'} AS present, "
        f"count({f if f in FEATURES_8 else 'NULL'}) AS filled FROM cust"
        for f in FEATURES_11
    )
)
def feature_coverage(spark, sf) -> DataFrame:
    """Expected features against the raw view: presence and filled rows."""
    df = customers(spark, sf)
    have = set(df.columns)
    wide = df.agg(
        *[(F.count(f) if f in have else F.lit(0).cast("bigint")).alias(f) for f in FEATURES_11]
    )
    long = wide.unpivot([], list(FEATURES_11), "feature", "filled")
    return long.withColumn("present", F.col("feature").isin(*[f for f in FEATURES_11 if f in have]).cast("int"))


_TYPES = {
    "customer_id": ("string", "bigint"),
    "event_date": ("timestamp", "timestamp_ntz"),
    "tenure_months": ("int", "int"),
    "monthly_charges": ("double", "double"),
    "total_charges": ("double", "double"),
    "num_products": ("int", "int"),
    "support_calls": ("int", "int"),
    "payment_delay_days": ("int", "int"),
    "age": ("int", "int"),
    "satisfaction_score": ("double", "double"),
    "churn": ("int", "int"),
}


@query(
    f"WITH {CLEAN}, c AS ("
    + " UNION ALL ".join(
        [
            f"SELECT '{f}' AS feature, '{e}' AS expected_type, '{c}' AS current_type, '{'same' if e == c else 'changed'}' AS status, count({f}) AS filled FROM clean"
            for f, (e, c) in _TYPES.items()
        ]
        + [
            f"SELECT '{f}', NULL, '{t}', 'added', count({f}) FROM clean"
            for f, t in (
                ("data_quality_flag", "string"),
                ("avg_revenue_per_product", "double"),
                ("support_call_rate", "double"),
                ("is_new_customer", "int"),
                ("segmento", "string"),
            )
        ]
    )
    + ") SELECT * FROM c"
)
def schema_drift(spark, sf) -> DataFrame:
    """Clean table against the canonical schema, with filled rows per column."""
    from stayline.schema import CUSTOMER_SCHEMA

    df = clean_table(spark, sf)
    expected = spark.createDataFrame([], CUSTOMER_SCHEMA)
    drift = quality.schema_drift(quality.schema_table(df), quality.schema_table(expected))
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "feature", "filled")
    return drift.join(filled, "feature", "left")


@query(
    """SELECT avg(date_diff('day', t::DATE, DATE '2001-08-02')) AS freshness_days
    FROM (SELECT o_custkey, max(o_orderdate) AS t FROM orders GROUP BY o_custkey)"""
)
def freshness(spark, sf) -> DataFrame:
    return quality.freshness(table(spark, sf, "orders").select("o_custkey", "o_orderdate"), "o_custkey", "o_orderdate", AS_OF)


@query(
    f"""WITH {CLUSTERED}, a AS (SELECT c.customer_id, CASE WHEN c.monthly_charges > 250 AND c.num_products >= 3 THEN 'PJ' ELSE 'PF' END AS segmento,
        clus.cluster_id FROM cust c LEFT JOIN clus ON clus.customer_id = c.customer_id)
    SELECT segmento, avg(CASE WHEN cluster_id IS NOT NULL THEN 1e0 ELSE 0e0 END) * 100 AS profile_coverage_pct FROM a GROUP BY segmento"""
)
def profile_coverage(spark, sf) -> DataFrame:
    every = segment.add_segment(customers(spark, sf)).select("customer_id", "segmento")
    assigned = clustered_customers(spark, sf).select("customer_id", "cluster_id")
    return quality.coverage(every.join(assigned, "customer_id", "left"), "cluster_id", "segmento")


@query(
    """WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT event_id, user_id, o_orderkey, o_totalprice FROM events LEFT JOIN o ON user_id = o_custkey"""
)
def online_feature_lookup(spark, sf) -> DataFrame:
    """Every request (event) joined with the newest order of its user."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    latest = latest_per_key(orders, "o_custkey", "o_orderdate", "o_orderkey").select(
        F.col("o_custkey").alias("user_id"), "o_orderkey", "o_totalprice"
    )
    requests = table(spark, sf, "events").select("event_id", "user_id")
    return score.lookup_features(requests, latest, "user_id").select("event_id", "user_id", "o_orderkey", "o_totalprice")


@query(ORACLES["online_feature_lookup"])
def bucketed_feature_lookup(spark, sf) -> DataFrame:
    """The same lookup from a stored table of buckets, which is not shuffled again."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    latest = latest_per_key(orders, "o_custkey", "o_orderdate", "o_orderkey")
    buckets = bucketed.bucket_count(spark, orders.count())
    features = latest.select(F.col("o_custkey").alias("user_id"), "o_orderkey", "o_totalprice")
    stored = bucketed.write_bucketed(features, new_path(spark, "bucketed"), "user_id", buckets)
    requests = table(spark, sf, "events").select("event_id", "user_id")
    return bucketed.bucketed_lookup(requests, stored, "user_id", buckets).select("event_id", "user_id", "o_orderkey", "o_totalprice")


@query(
    """WITH f AS (SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(28, 6))) AS DOUBLE) AS quantity,
      max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, o_custkey, n_lines, quantity, date_diff('day', o_orderdate, last_ship)::INTEGER AS days_to_ship
    FROM orders LEFT JOIN f ON l_orderkey = o_orderkey"""
)
def order_line_features(spark, sf) -> DataFrame:
    """Features of every order from its lines: two tables of like buckets, joined without a shuffle of either."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), exact_sum("l_quantity").alias("quantity"), F.max("l_shipdate").alias("last_ship")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    buckets = bucketed.bucket_count(spark, orders.count())
    left = bucketed.write_bucketed(orders, new_path(spark, "bucketed"), "o_orderkey", buckets)
    right = bucketed.write_bucketed(lines, new_path(spark, "bucketed"), "o_orderkey", buckets)
    days = F.date_diff("last_ship", "o_orderdate").alias("days_to_ship")
    return left.join(right.hint("merge"), "o_orderkey", "left").select("o_orderkey", "o_custkey", "n_lines", "quantity", days)


# --- batch twins of the streaming jobs -----------------------------------------------

# The mean is rounded as a whole number of millionths, so no tie depends on the order of a sum.
LATENCY_SQL = """SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 day' AS window_end, count(*) AS n,
  CAST((2 * sum(CAST(CAST(value AS DECIMAL(18, 6)) * 1000000 AS HUGEINT)) + count(value)) // (2 * count(value)) AS DOUBLE) / 1000000 AS mean,
  quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY ALL"""
RATE_SQL = """WITH e AS (SELECT ts, value, unnest(range(7)) AS back FROM events),
w AS (SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') - back * INTERVAL '1 day' AS s, value FROM e)
SELECT s AS window_start, s + INTERVAL '7 days' AS window_end, count(*) AS n,
  round(avg(CASE WHEN value > 100 THEN 1e0 ELSE 0e0 END), 6) AS rate FROM w GROUP BY s"""
TOTALS_SQL = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
CAPTURE_SQL = f"SELECT event_id, value FROM events WHERE {md5_mod(42, 'event_id', 100)} < 20"


@query(LATENCY_SQL)
def latency_by_day(spark, sf) -> DataFrame:
    return _rounded(jobs.latency_stats(table(spark, sf, "events"), "ts", "value"), "mean")


@query(
    """SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n, 1 AS p50, 1 AS p95, 1 AS p99
    FROM events GROUP BY ALL"""
)
def latency_sketch(spark, sf) -> DataFrame:
    """Daily percentiles from hourly sketches, each within 0.01 of its exact rank among the day's values."""
    events = table(spark, sf, "events").select("ts", "value")
    sketches = materialize(jobs.value_sketches(events, "ts", "value"), "sketches")
    days = jobs.sketched_latency(sketches).drop("window_end")
    rows = events.select(F.window("ts", "1 day")["start"].alias("window_start"), "value").join(days, "window_start")

    def near(name: str, q: float):
        """Whether q lies between the shares of values below the mark and up to it, or 0.01 beside them."""
        below, upto = F.avg((F.col("value") < F.col(name)).cast("double")), F.avg((F.col("value") <= F.col(name)).cast("double"))
        return ((below - 0.01 <= q) & (upto + 0.01 >= q)).cast("int").alias(name)

    return rows.groupBy("window_start").agg(
        F.max("n").alias("n"), near("p50", 0.5), near("p95", 0.95), near("p99", 0.99)
    ).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(RATE_SQL)
def sliding_rate(spark, sf) -> DataFrame:
    events = table(spark, sf, "events").select("ts", "value")
    return _rounded(jobs.rate_in_windows(events, "ts", F.col("value") > 100, "7 days", "1 day"), "rate")


@query(TOTALS_SQL)
def request_totals(spark, sf) -> DataFrame:
    return jobs.running_totals(table(spark, sf, "events"), "event_type")


@query(CAPTURE_SQL)
def event_capture(spark, sf) -> DataFrame:
    return jobs.captured(table(spark, sf, "events"), "event_id").select("event_id", "value")
