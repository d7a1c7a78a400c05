"""JSON bodies, reports and log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.text import fixed
from stayline.operators import score
from stayline.plans.base import (
    CLEAN,
    CLUSTERED,
    RAW_SCORE,
    clean_customers,
    clustered_customers,
    query,
    raw_score,
    table,
)
from stayline.plans.evaluation import _rounded
from stayline.schema import FEATURES_8


@query(
    f"""WITH {CLEAN}, s AS (SELECT customer_id, {RAW_SCORE} AS p FROM clean)
    SELECT customer_id, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS churn_prediction, round(p, 6) AS churn_probability FROM s"""
)
def json_serving_round_trip(spark, sf) -> DataFrame:
    """Features to a JSON request body, parsed, scored, encoded and read back by path."""
    df = clean_customers(spark, sf)
    vector = F.array(*[F.col(f).cast("double") for f in FEATURES_8])
    bodies = df.select("customer_id", F.to_json(F.struct(F.array(vector).alias("instances"))).alias("body"))
    parsed = score.parse_instances(bodies, FEATURES_8)
    p = raw_score()
    answered = parsed.select(
        "customer_id", score.decide(p).alias("churn_prediction"), F.round(p, 6).alias("churn_probability")
    )
    encoded = score.encode_predictions(answered)
    return encoded.select(
        "customer_id",
        F.get_json_object("response", "$.churn_prediction").cast("int").alias("churn_prediction"),
        F.get_json_object("response", "$.churn_probability").cast("double").alias("churn_probability"),
    )


# Metric patterns of a training log; the third accepts both wordings.
LOG_PATTERNS = (
    ("validation:roc_auc", r"ROC-AUC \(Teste\): ([0-9\.]+)"),
    ("validation:avg_precision", r"Avg-Precision: ([0-9\.]+)"),
    ("train:cv_roc_auc_mean", r"ROC-AUC \(CV[^)]*\) — Média: ([0-9\.]+)"),
)


def log_metrics(lines: DataFrame, line: str = "line") -> DataFrame:
    """metric, value for each log line that matches a pattern."""
    found = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("metric"),
                    F.nullif(F.regexp_extract(line, pattern, 1), F.lit("")).alias("value"),
                )
                for name, pattern in LOG_PATTERNS
            ]
        ),
        lambda m: m["value"].isNotNull(),
    )
    keep = [c for c in lines.columns if c != line]
    return lines.select(*keep, F.explode(found).alias("m")).select(
        *keep, "m.metric", F.col("m.value").cast("double").alias("value")
    )


def log_lines(spark, sf) -> DataFrame:
    """One log line per event, in the wording of the training jobs."""
    value = fixed(F.col("value") / 1000, 5)
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("ROC-AUC (Teste): "), value))
        .when(F.col("event_type") == "view", F.concat(F.lit("Avg-Precision: "), value))
        .when(F.col("event_type") == "click", F.concat(F.lit("ROC-AUC (CV 5-fold) — Média: "), value, F.lit(" ± 0.0100")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("ROC-AUC (CV) — Média: "), value, F.lit(" ± 0.0100")))
        .otherwise(F.concat(F.lit("step "), value))
    )
    return table(spark, sf, "events").select("event_id", line.alias("line"))


@query(
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'validation:roc_auc' WHEN 'view' THEN 'validation:avg_precision'
      ELSE 'train:cv_roc_auc_mean' END AS metric, round(value / 1000, 5) AS value FROM events WHERE event_type <> 'purchase'"""
)
def log_metric_capture(spark, sf) -> DataFrame:
    return log_metrics(log_lines(spark, sf))


@query(
    f"""WITH {CLUSTERED}, k AS (SELECT num_products AS k, round(sum(sq_distance), 4) AS inertia FROM clus GROUP BY num_products)
    SELECT CAST(k AS VARCHAR) AS key, inertia FROM k"""
)
def report_string_keys(spark, sf) -> DataFrame:
    """A report map with number keys, written with text keys and read back."""
    per_key = _rounded(
        clustered_customers(spark, sf).groupBy("num_products").agg(F.sum("sq_distance").alias("inertia")),
        "inertia",
        digits=4,
    )
    # num_products has at most a handful of values
    as_map = per_key.agg(F.map_from_entries(F.collect_list(F.struct("num_products", "inertia"))).alias("m"))
    text = as_map.select(
        F.to_json(F.struct(F.transform_keys("m", lambda k, v: k.cast("string")).alias("elbow_inertias"))).alias("body")
    )
    back = F.from_json("body", "struct<elbow_inertias:map<string,double>>")["elbow_inertias"]
    return text.select(F.explode(back).alias("key", "inertia"))
