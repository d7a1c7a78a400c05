"""Ranking and classification metrics, gates and model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.hashing import md5_uniform

from stayline.operators import metrics, split
from stayline.plans.base import SCORED, md5_mod, query, scored_customers, table
from stayline.schema import GATE_AUC_REGISTER, GATE_AUC_TEST
from stayline.session import materialize
from stayline.sources.registry import PENDING, registry_rows


def curve_sql(source: str, label: str = "churn", score: str = "score", group: str | None = None) -> str:
    """SQL for the cumulative curve of a labelled, scored table."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
hist AS (SELECT {g}{score}, sum({label})::BIGINT AS tp, sum(1 - {label})::BIGINT AS fp
         FROM {source} GROUP BY {g}{score}),
curve AS (SELECT *, sum(tp) OVER ({part}ORDER BY {score} DESC)::BIGINT AS cum_tp,
                 sum(fp) OVER ({part}ORDER BY {score} DESC)::BIGINT AS cum_fp FROM hist),
rank_metrics AS (
  SELECT {g}sum(tp)::BIGINT AS positives, sum(fp)::BIGINT AS negatives,
         sum(fp::DOUBLE * (cum_tp - tp / 2e0)) / nullif(sum(tp)::DOUBLE * sum(fp)::DOUBLE, 0) AS roc_auc,
         sum(tp::DOUBLE * cum_tp / (cum_tp + cum_fp)) / nullif(sum(tp)::DOUBLE, 0) AS average_precision
  FROM curve {f'GROUP BY {group}' if group else ''})"""


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


_CURVE = SCORED + "," + curve_sql("scored")


@query(f"WITH {_CURVE} SELECT positives, negatives, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM rank_metrics")
def ranking_metrics(spark, sf) -> DataFrame:
    return _rounded(
        metrics.ranking_metrics(scored_customers(spark, sf), "churn", "score"), "roc_auc", "average_precision"
    )


@query(f"WITH {_CURVE} SELECT score, tp, fp, cum_tp, cum_fp FROM curve")
def ranking_curve(spark, sf) -> DataFrame:
    curve = metrics.ranking_curve(scored_customers(spark, sf), "churn", "score")
    return curve.select("score", "tp", "fp", "cum_tp", "cum_fp")


@query(f"WITH {SCORED} SELECT churn AS actual, predicted, count(*) AS n FROM scored GROUP BY ALL")
def confusion_matrix(spark, sf) -> DataFrame:
    return metrics.confusion(scored_customers(spark, sf), "churn", "predicted")


CONF2 = """
m AS (SELECT count(*) FILTER (churn = 0 AND predicted = 0) AS tn, count(*) FILTER (churn = 0 AND predicted = 1) AS fp,
             count(*) FILTER (churn = 1 AND predicted = 0) AS fn, count(*) FILTER (churn = 1 AND predicted = 1) AS tp
      FROM scored)"""


@query(f"WITH {SCORED},{CONF2} SELECT * FROM m")
def confusion_2x2(spark, sf) -> DataFrame:
    return metrics.confusion_2x2(scored_customers(spark, sf), "churn", "predicted")


@query(f"WITH {SCORED},{CONF2} SELECT coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM m")
def f1_score(spark, sf) -> DataFrame:
    return metrics.f1_score(scored_customers(spark, sf), "churn", "predicted")


_REPORT = """
pc AS (
  SELECT '0' AS class, coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0) AS precision, coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS recall,
         coalesce(2e0 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1, tn + fp AS support FROM m
  UNION ALL
  SELECT '1', coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0),
         coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn FROM m),
report AS (
  SELECT * FROM pc
  UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS a, tp + tn + fp + fn AS n FROM m)
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM pc
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support)::BIGINT FROM pc)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report"""


@query(f"WITH {SCORED},{CONF2},{_REPORT}")
def classification_report(spark, sf) -> DataFrame:
    report = metrics.classification_report(scored_customers(spark, sf), "churn", "predicted")
    return _rounded(report, "precision", "recall", "f1")


_DOC_SCORED = """
scored AS (SELECT l.toxic AS churn, CASE WHEN d.n_chars < 1000 THEN 1 ELSE 0 END AS predicted
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


@query(f"WITH {_DOC_SCORED},{CONF2},{_REPORT}")
def label_report(spark, sf) -> DataFrame:
    """The report on given labels, with text length as the prediction."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    scored = table(spark, sf, "labels").join(docs, "doc_id").select(
        "toxic", F.when(F.col("n_chars") < 1000, 1).otherwise(0).alias("predicted")
    )
    report = metrics.classification_report(scored, "toxic", "predicted")
    return _rounded(report, "precision", "recall", "f1")


# --- several model versions ----------------------------------------------------------

VERSIONS = ("v1", "v2", "v3", "v4", "v5")


def version_scores(spark, sf) -> DataFrame:
    """Deterministic scores per customer in long form; v4 and v5 know the label, more or less, so that of
    the five some fail both gates, one passes the lower, and one passes both."""
    df = scored_customers(spark, sf).select(
        "customer_id",
        "churn",
        F.col("score").alias("v1"),
        F.round(1 / (1 + F.col("tenure_months") / F.lit(12.0)), 6).alias("v2"),
        F.round(1 / (1 + F.col("total_charges") / F.lit(100.0)), 6).alias("v3"),
        *[
            ((F.col("churn") * w + md5_uniform(5, "customer_id", 100_000)) / F.lit(200_000.0)).alias(v)
            for v, w in (("v4", 26_000), ("v5", 50_000))
        ],
    )
    return df.unpivot(["customer_id", "churn"], list(VERSIONS), "model_version", "score")


_VERSIONS = (
    SCORED
    + """,
vs AS (SELECT customer_id, churn, 'v1' AS model_version, score FROM scored
  UNION ALL SELECT customer_id, churn, 'v2', round(1 / (1 + tenure_months / 12e0), 6) FROM scored
  UNION ALL SELECT customer_id, churn, 'v3', round(1 / (1 + total_charges / 100e0), 6) FROM scored"""
    + "".join(
        f" UNION ALL SELECT customer_id, churn, '{v}', (churn * {w} + {md5_mod(5, 'customer_id', 100_000)}) / 200000e0 FROM scored"
        for v, w in (("v4", 26_000), ("v5", 50_000))
    )
    + "),"
    + curve_sql("vs", group="model_version")
    + ", ev AS (SELECT model_version, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM rank_metrics)"
)


def evaluations(spark, sf) -> DataFrame:
    ranked = metrics.ranking_metrics(version_scores(spark, sf), "churn", "score", ["model_version"])
    return _rounded(ranked, "roc_auc", "average_precision").select("model_version", "roc_auc", "average_precision")


@query(f"WITH {_VERSIONS} SELECT * FROM ev")
def version_evaluations(spark, sf) -> DataFrame:
    return evaluations(spark, sf)


@query(
    f"""WITH {_VERSIONS} SELECT 'churn' AS model_group, model_version, roc_auc, '{PENDING}' AS approval_status, gate
    FROM ev, (SELECT unnest([{GATE_AUC_TEST}e0, {GATE_AUC_REGISTER}e0]) AS gate) WHERE roc_auc >= gate"""
)
def registration_gate(spark, sf) -> DataFrame:
    """What the test gate and the registration gate let pass."""
    ev = materialize(evaluations(spark, sf), "evaluations")
    passed = [registry_rows(ev, g, "churn").withColumn("gate", F.lit(g)) for g in (GATE_AUC_TEST, GATE_AUC_REGISTER)]
    return passed[0].unionByName(passed[1])


@query(f"WITH {_VERSIONS} SELECT arg_max(model_version, (roc_auc, model_version)) AS champion, max(roc_auc) AS roc_auc FROM ev")
def champion_model(spark, sf) -> DataFrame:
    return metrics.champion(evaluations(spark, sf))


@query(
    f"""WITH {_CURVE},{CONF2},
    v AS (SELECT 'roc_auc' AS metric, round(roc_auc, 6) AS value FROM rank_metrics
      UNION ALL SELECT 'average_precision', round(average_precision, 6) FROM rank_metrics),
    g AS (SELECT * FROM (VALUES ('roc_auc', '>=', {GATE_AUC_TEST}e0), ('roc_auc', '>=', {GATE_AUC_REGISTER}e0),
          ('average_precision', '>', 0e0)) t(metric, op, gate))
    SELECT v.metric, value, op, gate, CASE WHEN (op = '>=' AND value >= gate) OR (op = '>' AND value > gate)
      THEN 1 ELSE 0 END AS pass FROM v JOIN g ON v.metric = g.metric"""
)
def metric_gates(spark, sf) -> DataFrame:
    wide = _rounded(
        metrics.ranking_metrics(scored_customers(spark, sf), "churn", "score"), "roc_auc", "average_precision"
    )
    gates = (
        ("roc_auc", ">=", GATE_AUC_TEST),
        ("roc_auc", ">=", GATE_AUC_REGISTER),
        ("average_precision", ">", 0.0),
    )
    return metrics.apply_gates(metrics.metrics_long(wide, ["roc_auc", "average_precision"]), gates)


@query(
    f"""WITH {SCORED}, ab AS (SELECT *, CASE WHEN {md5_mod(7, 'customer_id', 100)} < 90 THEN 'champion'
        ELSE 'challenger' END AS variant FROM scored),{curve_sql('ab', group='variant')}
    SELECT variant, positives, negatives, round(roc_auc, 6) AS roc_auc,
           round(average_precision, 6) AS average_precision FROM rank_metrics"""
)
def variant_metrics(spark, sf) -> DataFrame:
    routed = split.assign_variant(scored_customers(spark, sf), {"champion": 90, "challenger": 10})
    return _rounded(
        metrics.ranking_metrics(routed, "churn", "score", ["variant"]), "roc_auc", "average_precision"
    )


@query(
    f"""WITH {SCORED}, folded AS (SELECT *, CAST((row_number() OVER (PARTITION BY churn
        ORDER BY md5(concat('42:', customer_id))) - 1) % 5 AS INTEGER) AS fold FROM scored),
    {curve_sql('folded', group='fold')}
    SELECT count(*) AS folds, round(avg(roc_auc), 6) AS mean, round(stddev_pop(roc_auc), 6) AS std FROM rank_metrics"""
)
def cv_score_summary(spark, sf) -> DataFrame:
    folded = split.assign_folds(
        materialize(scored_customers(spark, sf).select("customer_id", "churn", "score"), "scored")
    )
    per_fold = metrics.ranking_metrics(folded, "churn", "score", ["fold"])
    return _rounded(metrics.cv_summary(per_fold), "mean", "std")


@query(
    f"""WITH {_CURVE},{CONF2} SELECT round(roc_auc, 4) AS roc_auc, round(average_precision, 4) AS average_precision,
    round(2e0 * tp / (2 * tp + fp + fn), 4) AS f1 FROM rank_metrics, m"""
)
def evaluation_report_values(spark, sf) -> DataFrame:
    """The nested report as JSON text, read back by path."""
    scored = materialize(scored_customers(spark, sf).select("churn", "score", "predicted"), "scored")
    report = metrics.evaluation_report(
        metrics.ranking_metrics(scored, "churn", "score"), metrics.f1_score(scored, "churn", "predicted")
    )
    text = report.select(F.to_json(F.struct("binary_classification_metrics")).alias("body"))

    def at(name):
        path = f"$.binary_classification_metrics.{name}.value"
        return F.get_json_object("body", path).cast("double").alias(name)

    return text.select(at("roc_auc"), at("average_precision"), at("f1"))
