"""Classification metrics as aggregates over a score histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.ranks import prefix_sums
from stayline.session import local_table


def score_histogram(df: DataFrame, label: str, score: str, groups=()) -> DataFrame:
    """Positives and negatives per distinct score, combined on the map side."""
    y = F.col(label).cast("bigint")
    return df.filter(F.col(score).isNotNull() & y.isNotNull()).groupBy(*groups, score).agg(
        F.sum(y).alias("tp"), F.sum(1 - y).alias("fp")
    )


def ranking_curve(df: DataFrame, label: str, score: str, groups=()) -> DataFrame:
    """Cumulative true and false positives by descending score."""
    hist = score_histogram(df, label, score, groups)
    return prefix_sums(hist, score, ["tp", "fp"], groups, descending=True)


def ranking_metrics(df: DataFrame, label: str, score: str, groups=()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum); NULL for one class."""
    d = {c: F.col(c).cast("double") for c in ("tp", "fp", "cum_tp", "cum_fp")}
    wins = F.sum(d["fp"] * (d["cum_tp"] - d["tp"] / 2))
    steps = F.sum(d["tp"] * d["cum_tp"] / (d["cum_tp"] + d["cum_fp"]))
    return (
        ranking_curve(df, label, score, groups)
        .groupBy(*groups)
        .agg(
            F.sum("tp").alias("positives"),
            F.sum("fp").alias("negatives"),
            F.try_divide(wins, F.sum(d["tp"]) * F.sum(d["fp"])).alias("roc_auc"),
            F.try_divide(steps, F.sum(d["tp"])).alias("average_precision"),
        )
    )


def confusion(df: DataFrame, label: str, prediction: str, groups=()) -> DataFrame:
    """Counts per actual and predicted class (long form)."""
    return df.groupBy(*groups, F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_2x2(df: DataFrame, label: str, prediction: str, groups=()) -> DataFrame:
    """tn, fp, fn, tp in one row (per group)."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*groups).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _ratio(a, b):
    """0 when nothing was predicted or present, as the usual report does."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def f1_score(df: DataFrame, label: str, prediction: str, groups=()) -> DataFrame:
    m = confusion_2x2(df, label, prediction, groups)
    two_tp = F.col("tp") * 2
    return m.withColumn("f1", _ratio(two_tp, two_tp + F.col("fp") + F.col("fn"))).select(*groups, "f1")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows 0, 1, accuracy, macro avg, weighted avg from one 2x2 aggregate."""
    m = confusion_2x2(df, label, prediction)
    c = {k: F.col(k) for k in ("tn", "fp", "fn", "tp")}

    def one(name, hit, wrong, missed):
        p, r = _ratio(hit, hit + wrong), _ratio(hit, hit + missed)
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            _ratio(hit * 2, hit * 2 + wrong + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    per_class = m.select(
        one("0", c["tn"], c["fn"], c["fp"]).alias("a"),
        one("1", c["tp"], c["fp"], c["fn"]).alias("b"),
        _ratio(c["tp"] + c["tn"], c["tp"] + c["tn"] + c["fp"] + c["fn"]).alias("acc"),
    )
    n = F.col("a.support") + F.col("b.support")
    fields = ("precision", "recall", "f1")

    def summary(name, combine):
        return F.struct(
            F.lit(name).alias("class"), *[combine(f).alias(f) for f in fields], n.alias("support")
        )

    rows = F.array(
        F.col("a"),
        F.col("b"),
        summary("accuracy", lambda f: F.col("acc")),
        summary("macro avg", lambda f: (F.col(f"a.{f}") + F.col(f"b.{f}")) / 2),
        summary(
            "weighted avg",
            lambda f: _ratio(
                F.col(f"a.{f}") * F.col("a.support") + F.col(f"b.{f}") * F.col("b.support"), n
            ),
        ),
    )
    return per_class.select(F.explode(rows).alias("row")).select("row.*")


def evaluation_report(ranking: DataFrame, f1: DataFrame) -> DataFrame:
    """One-row nested report; both inputs are one-row aggregates."""

    def metric(value):
        return F.struct(F.round(value, 4).alias("value"), F.lit("NaN").alias("standard_deviation"))

    return ranking.withColumn("f1", f1.select("f1").scalar()).select(
        F.struct(
            metric(F.col("roc_auc")).alias("roc_auc"),
            metric(F.col("average_precision")).alias("average_precision"),
            metric(F.col("f1")).alias("f1"),
        ).alias("binary_classification_metrics")
    )


def metrics_long(wide: DataFrame, names) -> DataFrame:
    """metric, value rows from a one-row table of metrics."""
    doubles = wide.select(*[F.col(n).cast("double").alias(n) for n in names])
    return doubles.unpivot([], list(names), "metric", "value")


def apply_gates(values: DataFrame, gates) -> DataFrame:
    """(metric, value) rows against (metric, op, limit) gates: pass flag per gate.

    The gates are a short driver-side list, at most one row per metric and side.
    """
    limits = local_table(
        values.sparkSession,
        [(m, op, float(x)) for m, op, x in gates],
        "metric string, op string, gate double",
    )
    v, x = F.col("value"), F.col("gate")
    passed = (
        F.when(F.col("op") == ">=", v >= x)
        .when(F.col("op") == ">", v > x)
        .when(F.col("op") == "<=", v <= x)
        .when(F.col("op") == "<", v < x)
    )
    return values.join(F.broadcast(limits), "metric").withColumn(
        "pass", F.coalesce(passed, F.lit(False)).cast("int")
    )


def champion(evaluations: DataFrame, version: str = "model_version", auc: str = "roc_auc") -> DataFrame:
    """Best version by AUC; the larger version name wins a tie."""
    return evaluations.agg(
        F.max_by(version, F.struct(auc, version)).alias("champion"), F.max(auc).alias("roc_auc")
    )


def cv_summary(scores: DataFrame, score: str = "roc_auc") -> DataFrame:
    return scores.agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg(score).alias("mean"),
        F.stddev_pop(score).alias("std"),
    )
