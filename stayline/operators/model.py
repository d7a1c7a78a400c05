"""Training, cross-validation and scoring with pyspark.ml."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.metrics import evaluation_report, f1_score, ranking_metrics
from stayline.operators.quality import to_long
from stayline.operators.ranks import exact_medians
from stayline.operators.score import decide
from stayline.schema import FEATURES_8, LABEL
from stayline.session import new_path, scratch_dir

FIT_ROWS = 50_000  # rows of a partition while trees are fitted: fewer take less time than their task
MOST_FIT_ROWS = 1_000_000  # more are cut into further partitions, whatever the cores, for their memory


@dataclass
class GbtParams:
    """Defaults of the reference model; a node of fewer than 10 rows is not split there,
    the nearest Spark setting is 5 rows per child."""

    trees: int = 200
    learning_rate: float = 0.05
    depth: int = 4
    subsample: float = 0.8
    min_child_rows: int = 5
    seed: int = 42
    extra: dict = field(default_factory=dict)


def build_estimator(features=FEATURES_8, params: GbtParams | None = None, label: str = LABEL) -> Pipeline:
    """Assembler, scaler and boosted trees; fitted together, so test rows never leak in."""
    p = params or GbtParams()
    gbt = GBTClassifier(
        labelCol=label,
        featuresCol="features",
        maxIter=p.trees,
        stepSize=p.learning_rate,
        maxDepth=p.depth,
        subsamplingRate=p.subsample,
        minInstancesPerNode=p.min_child_rows,
        seed=p.seed,
        **p.extra,
    )
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            gbt,
        ]
    )


def train(df: DataFrame, features=FEATURES_8, params: GbtParams | None = None, label: str = LABEL) -> PipelineModel:
    return build_estimator(features, params, label).fit(laid_out(df.select(*features, label)))


def laid_out(df: DataFrame, fits: int = 1) -> DataFrame:
    """The rows in as many even partitions as their number asks for, cut from their plan by one checkpoint.

    A boosted tree is a chain of small jobs: each would carry the plan to every task, and pay for every partition.
    So no more are made than the cores a fit has while `fits` of them run side by side, but for partitions too large.
    """
    scratch_dir(df.sparkSession)  # tree lineage is cut in the shared checkpoint folder as well
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-rows // FIT_ROWS), -(-cores // fits)), -(-rows // MOST_FIT_ROWS))
    return df.repartition(parts).checkpoint()


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds `probability` of churn and the 0/1 `churn_prediction`; keeps input columns."""
    out = model.transform(df).withColumn("_p", vector_to_array("probability")[1])
    return out.select(*df.columns, F.col("_p").alias("probability"), decide(F.col("_p")).alias("churn_prediction"))


def evaluate(df: DataFrame, model: PipelineModel, label: str = LABEL) -> DataFrame:
    scored = score(df, model)
    return evaluation_report(
        ranking_metrics(scored, label, "probability"), f1_score(scored, label, "churn_prediction")
    )


def held_out_scores(
    df: DataFrame, features, params: GbtParams, fold: int, fold_col: str, key: str, label: str
) -> DataFrame:
    """Probabilities of the rows of one fold by a model of the others."""
    others, own = df.filter(F.col(fold_col) != fold), df.filter(F.col(fold_col) == fold)
    fitted = build_estimator(features, params, label).fit(others.select(*features, label))
    scored = score(own.select(key, fold_col, label, *features), fitted)
    return scored.select(key, fold_col, label, "probability")


def cross_validate(
    df: DataFrame,
    features=FEATURES_8,
    params: GbtParams | None = None,
    folds: int = 5,
    fold_col: str = "fold",
    grid: list[dict] | None = None,
    parallelism: int = 16,
    key: str = "customer_id",
    label: str = LABEL,
) -> DataFrame:
    """Every row's probability by the model of the other folds, for each candidate: candidate, key, fold, label, probability.

    `grid` lists changes to `params`, one candidate each. A boosted tree is a chain of small jobs, so rows
    lie in as many partitions as their number asks for, are cut from their plan (which every task would carry)
    by one checkpoint in the shared folder, and the fits of folds and candidates run side by side, deepest trees first,
    up to `parallelism` of them and no more than give each core about three tasks: each keeps its own rows in memory.
    The best candidate is not fitted again on all rows; `train` does that where the model is wanted.
    """
    base = params or GbtParams()
    df = df.select(key, fold_col, label, *features)
    few = laid_out(df, folds)  # the folds of the deepest candidate run to the end
    candidates = [replace(base, **changes) for changes in grid or [{}]]

    def fit(task: tuple[int, int]) -> str:
        i, fold = task
        scores = held_out_scores(few, features, candidates[i], fold, fold_col, key, label)
        path = new_path(few.sparkSession, "fold-scores")
        scores.select(F.lit(i).alias("candidate"), *scores.columns).write.parquet(path)
        return path

    tasks = [(i, fold) for i in range(len(candidates)) for fold in range(folds)]
    tasks.sort(key=lambda task: -candidates[task[0]].depth * candidates[task[0]].trees)
    side_by_side = -(-3 * few.sparkSession.sparkContext.defaultParallelism // few.rdd.getNumPartitions())
    with ThreadPool(min(parallelism, len(tasks), side_by_side)) as pool:
        paths = pool.map(inheritable_thread_target(few.sparkSession)(fit), tasks, chunksize=1)
    parts = [few.sparkSession.read.parquet(path) for path in paths]
    return reduce(DataFrame.unionByName, parts)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_medians(train_df: DataFrame, columns) -> dict[str, float]:
    """Exact median per column, learned on the training rows only; one row per column
    reaches the driver. Apply with `fill_nulls(df, medians)`."""
    rows = exact_medians(to_long(train_df, columns), "value", ["feature"]).collect()
    return {r["feature"]: r["median"] for r in rows}


def encode_and_select(
    df: DataFrame, numeric, categorical, label: str = LABEL, keep: int = 5
) -> Pipeline:
    """Index and one-hot encode categories; keep the best numeric features by F-test."""
    indexed = [f"{c}_index" for c in categorical]
    encoded = [f"{c}_vec" for c in categorical]
    selector = UnivariateFeatureSelector(
        featuresCol="numeric_vec", outputCol="numeric_best", labelCol=label, selectionMode="numTopFeatures"
    ).setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(keep)
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
            VectorAssembler(inputCols=list(numeric), outputCol="numeric_vec"),
            selector,
            VectorAssembler(inputCols=["numeric_best", *encoded], outputCol="features"),
        ]
    ).fit(df)
