"""Trained models, checked by the facts that hold for any correct fit.

Models are trained with the full settings, on all rows. A model that several queries use is
trained once per application and table.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.operators import cluster, foreign, halving, model, split
from stayline.operators.clean import fill_nulls
from stayline.operators.cluster_metrics import strictly_decreasing
from stayline.operators.metrics import ranking_metrics
from stayline.operators.scaling import fit_standard
from stayline.plans.base import CLEAN, CUST, clean_customers, clean_table, customers, md5_mod, query, table
from stayline.plans.splits import EXACT
from stayline.schema import FEATURES_8, FEATURES_11, GATE_AUC_REGISTER
from stayline.session import kept_scratch, materialize, new_path
from stayline.sources.registry import PENDING, model_metadata, register
from stayline.sources.writers import write_report

PARAMS = model.GbtParams()
TRAINED_AT = dt.datetime(2024, 1, 1)


_TRAINED: dict = {}


def split_frames(spark, sf) -> tuple[DataFrame, DataFrame]:
    parts = _once(spark, sf, "split", lambda: materialize(split.exact_split(clean_table(spark, sf)), "split"))
    return parts.filter("split = 'train'"), parts.filter("split = 'test'")


def _once(spark, sf, name, make):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _TRAINED:
        with kept_scratch():
            _TRAINED[key] = make()
    return _TRAINED[key]


def trained_model(spark, sf, features=FEATURES_8):
    """The churn pipeline fitted on the training part."""
    train, _ = split_frames(spark, sf)
    return _once(spark, sf, features, lambda: model.train(train, features, PARAMS))


def segmentation_of(spark, sf) -> cluster.Segmentation:
    """Two clusters of the training part, ten restarts."""
    train, _ = split_frames(spark, sf)
    return _once(spark, sf, "segments", lambda: cluster.fit_segmentation(train, k=2))


def flag(condition) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def in_unit(c: str) -> Column:
    return flag(F.col(c).between(0, 1))


_TEST = f"WITH {EXACT} SELECT customer_id, churn, 1 AS in_range, 1 AS decided FROM exact WHERE split = 'test'"


@query(_TEST)
def gbt_scores(spark, sf) -> DataFrame:
    """Every test row is scored, with a probability and the decision that follows from it."""
    _, test = split_frames(spark, sf)
    scored = model.score(test, trained_model(spark, sf))
    decided = flag(F.col("churn_prediction") == (F.col("probability") >= 0.5).cast("int"))
    return scored.select("customer_id", "churn", in_unit("probability").alias("in_range"), decided.alias("decided"))


@query(
    f"""WITH {EXACT} SELECT unnest(['roc_auc', 'average_precision', 'f1']) AS metric, count(*) AS n, sum(churn)::BIGINT AS positives,
      1 AS in_range, 1 AS learned FROM exact WHERE split = 'test'"""
)
def gbt_evaluation(spark, sf) -> DataFrame:
    """Metrics of the test rows. `learned`: on the rows it was fitted on, the model's log loss is below that of
    the base rate and its AUC reaches 0.70, which no constant answer does."""
    train, test = split_frames(spark, sf)
    fitted = trained_model(spark, sf, FEATURES_11)
    report = model.evaluate(test, fitted)
    names = ("roc_auc", "average_precision", "f1")
    values = report.select(*[F.col(f"binary_classification_metrics.{c}.value").alias(c) for c in names])
    tested = test.agg(F.count("churn").alias("n"), F.sum("churn").cast("bigint").alias("positives"))
    return (
        values.unpivot([], list(names), "metric", "value")
        .join(F.broadcast(tested))
        .select("metric", "n", "positives", in_unit("value").alias("in_range"), F.lit(int(learned(train, fitted))).alias("learned"))
    )


def learned(train: DataFrame, fitted) -> bool:
    """Whether a model beats the base rate, by log loss and by AUC, on the rows it was fitted on."""
    scored = materialize(model.score(train, fitted).select("churn", "probability"), "fitted-scores")
    p = F.when(F.col("churn") == 1, F.col("probability")).otherwise(1 - F.col("probability"))
    row = scored.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("loss"), F.avg("churn").alias("rate")).first()
    base = -sum(q * math.log(q) for q in (row["rate"], 1 - row["rate"]) if q)
    auc = ranking_metrics(scored, "churn", "probability").first()["roc_auc"]
    return row["loss"] < base and auc is not None and auc >= 0.7


@query(f"WITH {EXACT} SELECT customer_id, 1 AS same FROM exact WHERE split = 'test'")
def model_save_and_load(spark, sf) -> DataFrame:
    """Scores of a model before and after it went through storage."""
    _, test = split_frames(spark, sf)
    fitted = trained_model(spark, sf)
    path = new_path(spark, "model")
    model.save(fitted, path)
    before = model.score(test, fitted).select("customer_id", F.col("probability").alias("before"))
    after = model.score(test, model.load(path)).select("customer_id", F.col("probability").alias("after"))
    return before.join(after, "customer_id").select("customer_id", flag(F.col("before") == F.col("after")).alias("same"))


DEPTHS = (2, 4)


@query(
    f"""WITH {CLEAN}, f AS (SELECT churn, (row_number() OVER (PARTITION BY churn ORDER BY md5(concat('42:', customer_id))) - 1) % 5 AS fold FROM clean)
    SELECT CAST(i AS INTEGER) AS candidate, CAST(2 + 2 * i AS INTEGER) AS max_depth, CAST(fold AS INTEGER) AS fold, count(*) AS n,
      CAST(sum(churn) AS BIGINT) AS positives, 1 AS in_range FROM f, range(2) t(i) GROUP BY ALL"""
)
def cross_validation_grid(spark, sf) -> DataFrame:
    """5-fold AUC per candidate depth over stratified folds; every row is scored once a candidate."""
    folded = materialize(split.assign_folds(clean_table(spark, sf)), "folds")
    scores = model.cross_validate(folded, FEATURES_8, PARAMS, grid=[{"depth": d} for d in DEPTHS])
    by = ("candidate", "fold")
    auc = ranking_metrics(scores, "churn", "probability", by).select(*by, "positives", "negatives", "roc_auc")
    depth = F.element_at(F.array(*[F.lit(d) for d in DEPTHS]), F.col("candidate") + 1)
    return auc.select(
        "candidate",
        depth.alias("max_depth"),
        "fold",
        (F.col("positives") + F.col("negatives")).cast("bigint").alias("n"),
        F.col("positives").cast("bigint").alias("positives"),
        in_unit("roc_auc").alias("in_range"),
    )


GRID = [{"depth": d, "learning_rate": r} for d in (2, 4) for r in (0.05, 0.2)]
RUNGS = [[4, 8], [8, 16], [16, 32]]
_RUNGS = ", ".join(f"({i}, {c}, {n})" for i, (cuts, n) in enumerate(zip(RUNGS, (4, 2, 1)), 1) for c in cuts)


@query(
    f"""WITH {CLEAN}, f AS (SELECT churn, (row_number() OVER (PARTITION BY churn ORDER BY md5(concat('42:', customer_id))) - 1) % 5 AS fold FROM clean)
    SELECT CAST(rung AS INTEGER) AS rung, CAST(place AS INTEGER) AS place, CAST(trees AS INTEGER) AS trees, CAST(place <= (left_ + 1) // 2 AS INTEGER) AS kept,
      CAST(count(*) AS BIGINT) AS n, CAST(sum(churn) AS BIGINT) AS positives, 1 AS ordered, 1 AS survivor
    FROM f, (VALUES {_RUNGS}) r(rung, trees, left_), range(1, 5) p(place) WHERE fold = 0 AND place <= left_ GROUP BY ALL"""
)
def halving_search(spark, sf) -> DataFrame:
    """Four candidates, then two, then one, with more trees each time; places by the AUC on the first fold.

    `ordered`: no candidate behind has a better AUC at any tree count than the best of this one; `survivor`:
    the candidate is one that the rung before kept.
    """
    folded = materialize(split.assign_folds(clean_table(spark, sf)), "folds")
    table_, _ = halving.search(folded, GRID, RUNGS)
    best = table_.groupBy("rung", "place").agg(F.max("roc_auc").alias("best"))
    behind = best.select("rung", F.col("place").alias("_p"), F.col("best").alias("_b"))
    beaten = best.join(behind, "rung").filter("_p > place and _b > best").select("rung", "place").distinct()
    before = table_.filter("kept").select((F.col("rung") + 1).alias("rung"), "candidate").distinct()
    marked = table_.join(beaten.withColumn("_bad", F.lit(1)), ["rung", "place"], "left").join(
        before.withColumn("_from", F.lit(1)), ["rung", "candidate"], "left"
    )
    return marked.select(
        "rung",
        "place",
        "trees",
        F.col("kept").cast("int").alias("kept"),
        (F.col("positives") + F.col("negatives")).cast("bigint").alias("n"),
        F.col("positives").cast("bigint").alias("positives"),
        F.col("_bad").isNull().cast("int").alias("ordered"),
        ((F.col("rung") == 1) | F.col("_from").isNotNull()).cast("int").alias("survivor"),
    )


@query(f"WITH {EXACT} SELECT customer_id, 1 AS same FROM exact WHERE split = 'test'")
def foreign_model_scores(spark, sf) -> DataFrame:
    """The fitted trees as a written table, scored outside the JVM: equal to the pipeline's own probabilities."""
    _, test = split_frames(spark, sf)
    fitted = trained_model(spark, sf)
    scales, nodes = (materialize(t, "exported") for t in foreign.export(spark, fitted))
    own = model.score(test, fitted).withColumnRenamed("probability", "_own")
    both = foreign.score(own, scales, nodes)
    return both.select("customer_id", flag(F.abs(F.col("staged")[0] - F.col("_own")) <= 1e-9).alias("same"))


@query("SELECT 'v1' AS model_version, 8 AS n_features, 200 AS trees, 1 AS gated")
def model_registration(spark, sf) -> DataFrame:
    """Evaluate, write metadata, and register if the AUC reaches the limit: the row is there exactly then."""
    _, test = split_frames(spark, sf)
    m = "binary_classification_metrics"
    row = materialize(
        model.evaluate(test, trained_model(spark, sf)).select(
            F.lit("v1").alias("model_version"), F.col(f"{m}.roc_auc.value").alias("roc_auc")
        ),
        "evaluation",
    )
    auc = row.first()["roc_auc"]
    path = new_path(spark, "metadata")
    write_report(model_metadata(spark, "GBTClassifier", FEATURES_8, TRAINED_AT, {"roc_auc": auc}, vars(PARAMS)), path)
    registry = new_path(spark, "registry")
    register(row, registry, threshold=GATE_AUC_REGISTER)
    listed = spark.read.schema("model_version string, approval_status string").parquet(registry)
    meta = spark.read.json(path)
    n = listed.filter((F.col("model_version") == "v1") & (F.col("approval_status") == PENDING)).count()
    return row.select("model_version", flag(F.lit(n) == (F.col("roc_auc") >= GATE_AUC_REGISTER).cast("int")).alias("gated")).withColumns(
        {
            "n_features": meta.select(F.col("n_features").cast("int")).scalar(),
            "trees": meta.select(F.col("hyperparameters.trees").cast("int")).scalar(),
        }
    )


_MEDIAN_COLS = ("support_calls", "total_charges")


@query(
    f"""WITH {CUST}, s AS (SELECT customer_id, support_calls, total_charges, {md5_mod(42, 'customer_id', 100)} < 80 AS tr
        FROM cust WHERE churn IS NOT NULL),
    m AS (SELECT median(support_calls) AS a, median(total_charges) AS b FROM s WHERE tr)
    SELECT customer_id, coalesce(support_calls, a)::DOUBLE AS support_calls, coalesce(total_charges, b) AS total_charges
    FROM s, m WHERE NOT tr"""
)
def median_imputation(spark, sf) -> DataFrame:
    """Medians learned on the training part and applied to the rest."""
    df = split.bucket_split(customers(spark, sf).filter("churn is not null")).select(
        "customer_id", "split", *[F.col(c).cast("double").alias(c) for c in _MEDIAN_COLS]
    )
    medians = model.fit_medians(df.filter("split = 'train'"), _MEDIAN_COLS)
    return fill_nulls(df.filter("split = 'test'").drop("split"), medians)


@query(f"WITH {CLEAN} SELECT customer_id, 5 AS numeric, 1 AS best FROM clean")
def encoded_features(spark, sf) -> DataFrame:
    """Market segment and nation encoded; the numeric features kept are those with the best F-test."""
    extra = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation")
    )
    df = clean_customers(spark, sf).join(extra, "customer_id").withColumn("churn", F.col("churn").cast("double"))
    df = materialize(df, "encodable")
    fitted = model.encode_and_select(df, FEATURES_11, ["c_mktsegment", "nation"])
    kept = sorted(fitted.stages[3].selectedFeatures)
    by_hand = sorted(sorted(range(len(FEATURES_11)), key=_f_values(df).__getitem__)[-len(kept):])
    from pyspark.ml.functions import vector_to_array

    width = fitted.transform(df).select("customer_id", F.size(vector_to_array("numeric_best")).alias("numeric"))
    return width.withColumn("best", F.lit(int(kept == by_hand)))


def _f_values(df: DataFrame) -> list[float]:
    """F statistic of every feature between the two classes, from sums."""
    aggs = [a for f in FEATURES_11 for a in (F.sum(F.col(f).cast("double")).alias(f"s_{f}"), F.sum(F.col(f).cast("double") ** 2).alias(f"q_{f}"))]
    rows = df.groupBy("churn").agg(F.count(F.lit(1)).alias("n"), *aggs).collect()
    n, out = sum(r["n"] for r in rows), []
    for f in FEATURES_11:
        total, square = sum(r[f"s_{f}"] for r in rows), sum(r[f"q_{f}"] for r in rows)
        between = sum(r[f"s_{f}"] ** 2 / r["n"] for r in rows) - total**2 / n
        within = square - sum(r[f"s_{f}"] ** 2 / r["n"] for r in rows)
        out.append(between / max(1, len(rows) - 1) / (within / max(1, n - len(rows)) or 1.0))
    return out


def vectors(spark, sf) -> DataFrame:
    df = clean_table(spark, sf)
    scaler = fit_standard(df, FEATURES_8)
    keep = cluster.to_vectors(df, FEATURES_8, scaler).select("customer_id", "churn", "segmento", "features")
    return _once(spark, sf, "vectors", lambda: materialize(keep, "vectors"))


def at_nearest(centers) -> Column:
    """Whether `prediction` is a centre at the smallest distance from `features`."""
    from pyspark.ml.functions import vector_to_array

    v = vector_to_array("features")
    gaps = F.array(
        *[
            F.aggregate(F.zip_with(v, F.lit(list(map(float, c))), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)
            for c in centers
        ]
    )
    return flag(F.get(gaps, F.col("prediction")) <= F.array_min(gaps) + 1e-9)


_EVERY = f"WITH {CLEAN} SELECT customer_id, segmento, 1 AS nearest FROM clean"


@query(_EVERY)
def kmeans_segments(spark, sf) -> DataFrame:
    """Every row is in the cluster with the nearest of two centres."""
    v = vectors(spark, sf)
    fitted = cluster.fit_kmeans(v, 2)
    return fitted.transform(v).select("customer_id", "segmento", at_nearest(fitted.clusterCenters()).alias("nearest"))


@query(f"WITH {EXACT} SELECT customer_id, 1 AS in_range, 1 AS known FROM exact WHERE split = 'test'")
def cluster_as_feature(spark, sf) -> DataFrame:
    """Churn model with the cluster id among its features."""
    train, test = split_frames(spark, sf)
    seg = segmentation_of(spark, sf)
    fitted = model.train(seg.assign(train), (*FEATURES_8, "cluster_id"), PARAMS)
    scored = model.score(seg.assign(test), fitted)
    return scored.select("customer_id", in_unit("probability").alias("in_range"), flag(F.col("cluster_id").isin(0, 1)).alias("known"))


@query("SELECT CAST(k AS INTEGER) AS k, 1 AS decreases, 1 AS in_range, 1 AS spread FROM range(2, 9) t(k)")
def elbow_curve(spark, sf) -> DataFrame:
    """Inertia falls with k; silhouette lies in [-1, 1] and Davies-Bouldin above 0."""
    curve = cluster.elbow(vectors(spark, sf).select("features"))
    return strictly_decreasing(curve, "k", "inertia").select(
        "k", "decreases", flag(F.col("silhouette_sq").between(-1, 1)).alias("in_range"), flag(F.col("davies_bouldin") > 0).alias("spread")
    )


@query(f"WITH {CLEAN} SELECT customer_id, 1 AS finite, 1 AS ratios FROM clean")
def pca_projection(spark, sf) -> DataFrame:
    """Two components per row, the first of which explains at least as much as the second."""
    points, ratio = cluster.pca_2d(vectors(spark, sf), keep=["customer_id"])
    finite = F.abs(F.col("pc1")) + F.abs(F.col("pc2")) < float("inf")
    return points.select("customer_id", flag(finite).alias("finite"), F.lit(int(1 >= ratio[0] >= ratio[1] >= 0)).alias("ratios"))


@query(f"WITH {CLEAN} SELECT customer_id, 1 AS nearest FROM clean")
def bisecting_segments(spark, sf) -> DataFrame:
    v = vectors(spark, sf)
    fitted = cluster.fit_bisecting(v, 2)
    return fitted.transform(v).select("customer_id", at_nearest(fitted.clusterCenters()).alias("nearest"))


@query(
    f"""WITH {CLEAN}, f AS (SELECT k, (k - 1) + k * 8 + k * 36 AS free FROM range(2, 9) t(k)), n AS (SELECT count(*) AS n FROM clean)
    SELECT CAST(k AS INTEGER) AS k, round(free * (ln(n) - 2), 6) AS bic_minus_aic, 1 AS finite FROM f, n"""
)
def mixture_selection(spark, sf) -> DataFrame:
    table_ = cluster.mixture_scores(vectors(spark, sf).select("features"), range(2, 9), len(FEATURES_8))
    return table_.select(
        "k", F.round(F.col("bic") - F.col("aic"), 6).alias("bic_minus_aic"), flag(F.abs("log_likelihood") < float("inf")).alias("finite")
    )


_ROBUST = ", ".join(
    f"round(({f} - m_{f}) / CASE WHEN u_{f} = l_{f} THEN 1 ELSE u_{f} - l_{f} END, 6) AS {f}" for f in FEATURES_8
)
_MARKS = ", ".join(
    f"quantile_disc({f}::DOUBLE, 0.25) AS l_{f}, quantile_disc({f}::DOUBLE, 0.5) AS m_{f}, quantile_disc({f}::DOUBLE, 0.75) AS u_{f}" for f in FEATURES_8
)


@query(f"WITH {CLEAN}, marks AS (SELECT {_MARKS} FROM clean) SELECT customer_id, {_ROBUST} FROM clean, marks")
def robust_scaling(spark, sf) -> DataFrame:
    df = clean_table(spark, sf).select("customer_id", *FEATURES_8)
    scaled = cluster.robust_scaled(df, FEATURES_8)
    return scaled.select("customer_id", *[F.round(f, 6).alias(f) for f in FEATURES_8])


@query("SELECT CAST(i AS INTEGER) AS run, 1 AS in_range FROM range(10) t(i)")
def cluster_stability(spark, sf) -> DataFrame:
    """ARI of ten runs on 80 % of the rows against the fit on all rows."""
    runs = cluster.stability(vectors(spark, sf), "customer_id", k=2, runs=10)
    return runs.select("run", flag(F.col("adjusted_rand").between(-1, 1)).alias("in_range"))
