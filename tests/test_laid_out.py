import threading
import time

from stayline.operators import model


def test_rows_to_fit_lie_in_few_partitions_without_their_plan(spark, monkeypatch):
    monkeypatch.setattr(model, "FIT_ROWS", 40)
    df = spark.range(100).selectExpr("id", "id * 2 as x").repartition(17)
    few = model.laid_out(df)
    assert few.rdd.getNumPartitions() == 3
    assert "Range" not in few._jdf.queryExecution().analyzed().toString()
    assert sorted(r["id"] for r in few.collect()) == list(range(100))


def test_training_sees_the_laid_out_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(model, "laid_out", lambda df: seen.append(df.columns) or df)
    rows = [(float(i), float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, churn double")
    model.train(df, ("x",), model.GbtParams(trees=1, depth=1))
    assert seen == [["x", "churn"]]


def test_partitions_follow_the_cores_of_a_fit_and_not_the_rows(spark, monkeypatch):
    monkeypatch.setattr(model, "FIT_ROWS", 10)
    df, cores = spark.range(1000), spark.sparkContext.defaultParallelism
    assert [model.laid_out(df, fits).rdd.getNumPartitions() for fits in (1, 2, 100)] == [cores, -(-cores // 2), 1]
    monkeypatch.setattr(model, "MOST_FIT_ROWS", 90)
    few = model.laid_out(df, 100)
    assert few.rdd.getNumPartitions() == 12 and few.count() == 1000


def test_fits_side_by_side_share_the_cores(spark, monkeypatch):
    monkeypatch.setattr(model, "FIT_ROWS", 10)
    lock, now, most, parts = threading.Lock(), [0], [0], set()

    def scores(df, features, params, fold, fold_col, key, label):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            parts.add(df.rdd.getNumPartitions())
        time.sleep(0.5)
        with lock:
            now[0] -= 1
        return df.filter(f"fold = {fold}").selectExpr("customer_id", "fold", "churn", "0.5D as probability")

    monkeypatch.setattr(model, "held_out_scores", scores)
    df = spark.range(600).selectExpr("id as customer_id", "cast(id % 2 as double) as x", "id % 2 as churn", "id % 3 as fold")
    grid = [{"depth": d} for d in range(1, 6)]
    cores = spark.sparkContext.defaultParallelism
    assert model.cross_validate(df, ("x",), folds=3, grid=grid).count() == 5 * 600
    assert parts == {-(-cores // 3)} and most[0] > 1
    most[0] = 0
    monkeypatch.setattr(model, "MOST_FIT_ROWS", 50)
    assert model.cross_validate(df, ("x",), folds=3, grid=grid).count() == 5 * 600
    assert 12 in parts and most[0] <= -(-3 * cores // 12)
