"""Reports that bring the results of several operators together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators import cluster_metrics as cm
from stayline.operators import metrics, quality
from stayline.plans import monitoring, retrieval, segmentation
from stayline.plans.base import (
    AS_OF,
    CUST,
    DIST_SQL,
    ORACLES,
    PROCESSED_AT,
    SCALED,
    customers,
    md5_mod,
    query,
    scaled_customers,
    z_names,
)
from stayline.functions.hashing import md5_uniform
from stayline.plans.evaluation import _rounded
from stayline.schema import FEATURES_8
from stayline.session import new_path
from stayline.sources.readers import read_cards_json
from stayline.sources.writers import write_cards, write_report

_NAMES = segmentation.CLUSTER_METRICS
REPORT_DDL = (
    "generated_at timestamp, chosen_k int, features array<string>, "
    f"metrics struct<{', '.join(f'{m}: double' for m in _NAMES)}>, "
    "cluster_profiles map<string, struct<n_samples: bigint, churn_rate: double, risk_label: string>>, "
    "elbow_inertias map<string, double>"
)


def as_map(df: DataFrame, key, value, name: str) -> DataFrame:
    """One row with a map of a model-sized table."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias(name))


@query(
    f"""WITH {segmentation.METRIC_ROWS}, inertias AS ({ORACLES['inertia_by_k']})
    SELECT concat('metric ', metric) AS field, value FROM v
    UNION ALL SELECT concat('profile ', cluster_id), count(*)::DOUBLE FROM clus GROUP BY cluster_id
    UNION ALL SELECT concat('inertia ', k), inertia FROM inertias
    UNION ALL SELECT 'chosen_k', count(DISTINCT cluster_id)::DOUBLE FROM clus
    UNION ALL SELECT 'features', {len(FEATURES_8)}e0"""
)
def cluster_report(spark, sf) -> DataFrame:
    """The report on the clusters as one nested JSON document, written, read back and listed by field."""
    values = segmentation.cluster_metric_rows(spark, sf)
    wide = values.groupBy().pivot("metric", list(_NAMES)).agg(F.first("value"))
    profiles = segmentation.cluster_profiles(spark, sf)
    profile = F.struct("n_samples", "churn_rate", "risk_label")
    profiles = as_map(profiles, F.col("cluster_id").cast("string"), profile, "cluster_profiles")
    inertias = as_map(segmentation.inertia_by_k(spark, sf), F.col("k").cast("string"), F.col("inertia"), "elbow_inertias")
    one = spark.range(1).select(F.lit(PROCESSED_AT).alias("generated_at"), F.lit(list(FEATURES_8)).alias("features"))
    report = one.withColumns(
        {
            "metrics": wide.select(F.struct(*_NAMES)).scalar(),
            "cluster_profiles": profiles.scalar(),
            "elbow_inertias": inertias.scalar(),
        }
    ).withColumn("chosen_k", F.size("cluster_profiles"))
    path = new_path(spark, "cluster-report")
    write_report(report, path)
    back = spark.read.schema(REPORT_DDL).json(path)

    def listed(field, value) -> DataFrame:
        return back.select(field.alias("field"), value.cast("double").alias("value"))

    rows = [listed(F.lit(f"metric {m}"), F.col(f"metrics.{m}")) for m in _NAMES]
    rows += [listed(F.lit("chosen_k"), F.col("chosen_k")), listed(F.lit("features"), F.size("features"))]
    kept = back.select(F.explode("cluster_profiles").alias("k", "p"))
    rows.append(kept.select(F.concat(F.lit("profile "), "k"), F.col("p.n_samples").cast("double")))
    rows.append(back.select(F.explode("elbow_inertias").alias("k", "value")).select(F.concat(F.lit("inertia "), "k"), "value"))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


@query(ORACLES["nested_card_scan"])
def card_file_scan(spark, sf) -> DataFrame:
    """Cards written as one JSON file and scanned back into flat rows."""
    path = new_path(spark, "cards-json")
    write_cards(segmentation.cards(spark, sf), path)
    flat = read_cards_json(spark, path)
    return flat.drop("cluster_key", "feature_means").withColumns(
        {"gargalos": F.array_join("gargalos", "|"), "rag_tags": F.array_join("rag_tags", " ")}
    )


_GATES = (("recall", ">=", 0.80), ("context_precision", ">=", 0.75))


@query(
    f"""WITH q AS ({ORACLES['retrieval_quality']}), v AS (SELECT 'recall' AS metric, round(avg(recall), 6) AS value FROM q
      UNION ALL SELECT 'context_precision', round(avg(context_precision), 6) FROM q)
    SELECT metric, value, '>=' AS op, CASE metric WHEN 'recall' THEN 0.80e0 ELSE 0.75e0 END AS gate,
      CASE WHEN value >= CASE metric WHEN 'recall' THEN 0.80e0 ELSE 0.75e0 END THEN 1 ELSE 0 END AS pass FROM v"""
)
def retrieval_gates(spark, sf) -> DataFrame:
    """Mean recall and context precision of the dense search against their gates."""
    q = retrieval.retrieval_quality(spark, sf)
    mean = q.agg(*[F.round(F.avg(c), 6).alias(c) for c, _, _ in _GATES])
    return metrics.apply_gates(metrics.metrics_long(mean, [c for c, _, _ in _GATES]), _GATES)


def stability(spark, sf) -> DataFrame:
    """ARI between the clusters of all rows and those of centroids fitted on 80 % of them."""
    df, zs = scaled_customers(spark, sf), z_names()
    whole = cm.assign_nearest(df, zs, cm.fit_centroids(df, zs, "segmento"))
    part = cm.fit_centroids(df.filter(md5_uniform(43, "customer_id", 100) < 80), zs, "segmento")
    both = cm.assign_nearest(whole.drop("sq_distance"), zs, part, cluster="again")
    return cm.external_metrics(both, "cluster_id", "again")


_AVG_Z = ", ".join(f"avg(z_{f}) AS c_{f}" for f in FEATURES_8)
_STABLE = f"""(WITH {SCALED},
  c1 AS (SELECT row_number() OVER (ORDER BY segmento) AS cid, * FROM (SELECT segmento, {_AVG_Z} FROM scaled GROUP BY segmento)),
  c2 AS (SELECT row_number() OVER (ORDER BY segmento) AS cid, * FROM (SELECT segmento, {_AVG_Z} FROM scaled WHERE {md5_mod(43, 'customer_id', 100)} < 80 GROUP BY segmento)),
  a1 AS (SELECT customer_id, arg_min(cid, (d, cid)) AS a FROM (SELECT customer_id, cid, {DIST_SQL} AS d FROM scaled, c1) GROUP BY customer_id),
  a2 AS (SELECT customer_id, arg_min(cid, (d, cid)) AS b FROM (SELECT customer_id, cid, {DIST_SQL} AS d FROM scaled, c2) GROUP BY customer_id),
  two AS (SELECT a, b FROM a1 JOIN a2 ON a1.customer_id = a2.customer_id),
  {segmentation.external_sql('two', 'a', 'b')})"""
_FILLED = " + ".join(f"({f} IS NOT NULL)::INT" for f in FEATURES_8)
_LIMIT_ROWS = ", ".join(f"('{m}', '{d}', {g}e0, {a}e0)" for m, d, g, a in quality.LIMITS)


@query(
    f"""WITH {CUST}, l AS (SELECT * FROM cust WHERE churn IS NOT NULL), m AS (
      SELECT 'completeness_pct' AS metric, round(avg(({_FILLED}) / 8e0) * 100, 6) AS value FROM cust
      UNION ALL SELECT 'churn_pct', round(avg(churn) * 100, 6) FROM l
      UNION ALL SELECT 'freshness_days', round(avg(date_diff('day', event_date::DATE, DATE '2001-08-02')), 6) FROM l
      UNION ALL SELECT 'outlier_pct', round(sum(outliers) / sum(n) * 100, 6) FROM ({ORACLES['outliers_iqr']})
      UNION ALL SELECT 'feature_coverage_pct', round(avg(present) * 100, 6) FROM ({ORACLES['feature_coverage']})
      UNION ALL SELECT 'profile_coverage_pct', round(min(profile_coverage_pct), 6) FROM ({ORACLES['profile_coverage']})
      UNION ALL SELECT 'psi', max(psi) FROM ({ORACLES['population_stability']})
      UNION ALL SELECT 'silhouette', silhouette_sq FROM ({ORACLES['internal_cluster_metrics']})
      UNION ALL SELECT 'cluster_stability_ari', adjusted_rand FROM {_STABLE}
      UNION ALL SELECT 'recall_at_5', round(avg(recall), 6) FROM ({ORACLES['retrieval_quality']})
      UNION ALL SELECT 'context_precision', round(avg(context_precision), 6) FROM ({ORACLES['retrieval_quality']})),
    g AS (SELECT * FROM (VALUES {_LIMIT_ROWS}) t(metric, direction, goal, alert)),
    s AS (SELECT m.metric, value, CASE WHEN direction = 'high' THEN CASE WHEN value >= goal THEN 'ok' WHEN value < alert THEN 'alert' ELSE 'warn' END
       ELSE CASE WHEN value <= goal THEN 'ok' WHEN value > alert THEN 'alert' ELSE 'warn' END END AS status FROM m JOIN g ON m.metric = g.metric)
    SELECT *, CASE WHEN status = 'alert' THEN 1 ELSE 0 END AS retrain, max(CASE WHEN status = 'alert' THEN 1 ELSE 0 END) OVER () AS retrain_any FROM s"""
)
def monitoring_status(spark, sf) -> DataFrame:
    """All monitored values against their limits, and whether any of them asks for a new model.

    Coverage is that of the worst segment, drift that of the worst feature.
    """
    filled = sum((F.col(f).isNotNull().cast("int") for f in FEATURES_8), F.lit(0))
    age = F.when(F.col("churn").isNotNull(), F.date_diff(F.lit(AS_OF), F.col("event_date")))
    basic = customers(spark, sf).agg(
        F.round(F.avg(filled / 8.0) * 100, 6).alias("completeness_pct"),
        F.round(F.avg(F.col("churn").cast("double")) * 100, 6).alias("churn_pct"),
        F.round(F.avg(age), 6).alias("freshness_days"),
    )
    rows = metrics.metrics_long(basic, ["completeness_pct", "churn_pct", "freshness_days"])
    found = retrieval.retrieval_quality(spark, sf)
    single = {
        "outlier_pct": monitoring.outliers_iqr(spark, sf).agg(F.round(F.sum("outliers") / F.sum("n") * 100, 6)),
        "feature_coverage_pct": monitoring.feature_coverage(spark, sf).agg(F.round(F.avg("present") * 100, 6)),
        "profile_coverage_pct": monitoring.profile_coverage(spark, sf).agg(F.round(F.min("profile_coverage_pct"), 6)),
        "psi": monitoring.population_stability(spark, sf).agg(F.max("psi")),
        "silhouette": segmentation.internal_cluster_metrics(spark, sf).select("silhouette_sq"),
        "cluster_stability_ari": _rounded(stability(spark, sf), "adjusted_rand").select("adjusted_rand"),
        "recall_at_5": found.agg(F.round(F.avg("recall"), 6)),
        "context_precision": found.agg(F.round(F.avg("context_precision"), 6)),
    }
    for name, df in single.items():
        rows = rows.unionByName(df.toDF("value").select(F.lit(name).alias("metric"), F.col("value").cast("double")))
    status = quality.status_rows(rows)
    return status.withColumn("retrain_any", status.agg(F.max("retrain")).scalar())
