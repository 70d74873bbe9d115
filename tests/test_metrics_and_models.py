from __future__ import annotations

from math import log2

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnow.operators import compare, metrics, models

SCHEMA = "user_id long, item_id long, rating double, prediction double"


def ndcg_by_hand(pairs, k):
    """pairs: (rating, prediction, item)"""
    by_prediction = sorted(pairs, key=lambda p: (-p[1], p[2]))[:k]
    ideal = sorted((p[0] for p in pairs), reverse=True)[:k]
    dcg = sum(p[0] / log2(i + 2) for i, p in enumerate(by_prediction))
    return dcg / sum(r / log2(i + 2) for i, r in enumerate(ideal))


def test_ndcg_by_hand_and_skips(spark):
    rows = [(1, 1, 5.0, 1.0), (1, 2, 3.0, 2.0), (1, 3, 1.0, 3.0), (2, 1, 4.0, 4.0), (3, 1, 0.0, 1.0), (3, 2, 0.0, 2.0)]
    got = metrics.ndcg_per_user(spark.createDataFrame(rows, SCHEMA), (1, 10)).collect()
    assert [r["user_id"] for r in got] == [1]  # one row, and no gain, drop out
    want = (1 + 3 / log2(3) + 5 / 2) / (5 + 3 / log2(3) + 1 / 2)
    assert got[0]["ndcg_10"] == pytest.approx(want) and got[0]["ndcg_1"] == pytest.approx(1 / 5)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 5), st.integers(0, 3)), min_size=4, max_size=60))
def test_ndcg_on_random_tables(spark, rows):
    table = [(u, i, float(r), float(p)) for i, (u, r, p) in enumerate(rows)]
    got = {r["user_id"]: r for r in metrics.ndcg_per_user(spark.createDataFrame(table, SCHEMA), (3, 10)).collect()}
    for u in {t[0] for t in table}:
        mine = [(r, p, i) for uu, i, r, p in table if uu == u]
        if len(mine) < 2:
            assert u not in got
            continue
        for k in (3, 10):
            assert got[u][f"ndcg_{k}"] == pytest.approx(ndcg_by_hand(mine, k)) and 0 <= got[u][f"ndcg_{k}"] <= 1 + 1e-12


def test_errors(spark):
    df = spark.createDataFrame([(1, 1, 3.0, 1.0), (1, 2, 3.0, 3.0), (1, 3, 4.0, 6.0), (2, 1, 4.0, 3.4)], SCHEMA)
    e = np.array([-2.0, 0.0, 2.0, -0.6])
    row = metrics.regression_metrics(df).first()
    assert row["rmse"] == pytest.approx(np.sqrt((e**2).mean())) and row["mae"] == pytest.approx(abs(e).mean())
    assert metrics.error_summary(df).first()["std_error"] == pytest.approx(e.std())
    buckets = [r["n_rows"] for r in metrics.error_buckets(df).orderBy("bucket").collect()]
    assert buckets == [0, 1, 1, 0, 1, 0, 0, 1]
    by = {r["rating"]: r for r in metrics.error_by_rating(df).collect()}
    assert by[3.0]["mean_error"] == -1 and by[4.0]["std_abs_error"] == pytest.approx(np.std([2, 0.6], ddof=1))
    empty = metrics.error_buckets(df.where("user_id = 99")).collect()
    assert len(empty) == 8 and all(r["pct"] is None for r in empty)
    assert metrics.evaluate_scores(df.where("user_id = 2")).first()["ndcg_10"] == 0.0


def test_recall_and_baselines(spark):
    wanted = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 9), (2, 3), (3, 1)], "user_id long, item_id long")
    found = spark.createDataFrame([(1, 2, 1), (1, 7, 2), (1, 1, 3), (2, 4, 1)], "user_id long, item_id long, rank int")
    got = {r["user_id"]: r for r in metrics.recall_per_user(found, wanted, (1, 3)).collect()}
    assert got[1]["n_positives"] == 3 and got[1]["recall_1"] == pytest.approx(1 / 3) and got[1]["recall_3"] == pytest.approx(2 / 3)
    assert got[2]["recall_3"] == 0 and got[3]["recall_3"] == 0
    mean = metrics.mean_recall(metrics.recall_per_user(found, wanted, (1, 3)), (1, 3)).first()
    assert mean["recall_1"] <= mean["recall_3"] == pytest.approx(2 / 9)
    best = metrics.popularity(wanted, 2).orderBy("rank").collect()
    assert [(r["item_id"], r["n_positives"]) for r in best] == [(1, 2), (2, 2)]
    popular = {r["user_id"]: r["recall_1"] for r in metrics.popularity_recall(wanted, wanted, (1,)).collect()}
    assert popular == {1: pytest.approx(1 / 3), 2: 0, 3: 1}
    table = metrics.lift({"model": mean_row(spark, 0.2), "popularity": mean_row(spark, 0.1), "random": mean_row(spark, 0.0)}, (5,), "popularity")
    assert table.first()["lift_pct"] == pytest.approx(100)
    none = metrics.lift({"model": mean_row(spark, 0.2), "popularity": mean_row(spark, 0.0)}, (5,), "popularity")
    assert none.first()["lift_pct"] is None


def mean_row(spark, value):
    return spark.createDataFrame([(3, value)], "n_users long, recall_5 double")


def test_distribution(spark):
    values = [0.1, 0.1, 0.4, 0.9]
    row = metrics.value_distribution(spark.createDataFrame([(v,) for v in values], "x double"), "x", (0.1, 0.9)).first()
    assert row["p10"] == pytest.approx(np.quantile(values, 0.1)) and row["median"] == pytest.approx(0.25)
    assert row["std"] == pytest.approx(np.std(values, ddof=1))


def scored(spark):
    rng = np.random.default_rng(2)
    rows = []
    for split in ("train", "val"):
        for u in range(6):
            for i in range(8):
                rating = float(rng.integers(1, 6))
                rows.append((u, i, rating, rating + (0.1 if split == "train" else 2) * float(rng.normal()), split))
    return spark.createDataFrame(rows, SCHEMA + ", split string")


def test_comparison_and_diagnosis(spark):
    df = scored(spark)
    both = df.withColumn("model", F.lit("good")).unionByName(
        df.withColumn("model", F.lit("bad")).withColumn("prediction", -F.col("rating")))
    table = {r["metric"]: r for r in compare.compare_models(both, ["bad", "good"]).collect()}
    assert len(table) == 4 and all(r["best_model"] == "good" and r["wins"] == 4 and r["verdict"] == "better" for r in table.values())
    assert table["rmse"]["diff"] < 0 < table["ndcg_10"]["diff"]
    same = compare.compare_models(both.where("model = 'bad'").unionByName(
        both.where("model = 'bad'").withColumn("model", F.lit("twin"))), ["bad", "twin"]).collect()
    assert all(r["best_model"] == "bad" and r["verdict"] == "same" for r in same)  # the first one wins ties
    assert compare.diagnose_fit(df).first()["action"] == "REDUCE_COMPLEXITY"
    assert compare.diagnose_fit(df.where("split = 'train'").unionByName(
        df.where("split = 'train'").withColumn("split", F.lit("val")))).first()["action"] == "NONE"
    gap = {r["metric"]: r for r in compare.split_gap(df, "train", "val").collect()}
    assert gap["rmse"]["diff"] == pytest.approx(gap["rmse"]["val"] - gap["rmse"]["train"])


def test_sweep_summary_ignores_failures(spark):
    runs = spark.createDataFrame(
        [(0, 0.1, "success", 0.5), (1, 0.1, "success", 0.7), (2, 0.2, "failed", None), (3, 0.2, "success", 0.7)],
        "run_id int, lr double, status string, recall double")
    got = {r["lr"]: r for r in compare.sweep_summary(runs, "lr", ["recall"]).collect()}
    assert got[0.1]["n_runs"] == 2 and got[0.1]["mean_recall"] == pytest.approx(0.6) and got[0.2]["std_recall"] is None
    assert compare.best_run(runs, "recall").first()["run_id"] == 1


def test_ndcg_evaluator_in_model_selection(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit

    df = VectorAssembler(inputCols=["item_id", "prediction"], outputCol="features").transform(
        scored(spark).where("split = 'train'")).select("user_id", "item_id", "rating", "features")
    lr = LinearRegression(labelCol="rating")
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 1000.0]).build()
    chosen = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=models.NdcgEvaluator(k=5), seed=1).fit(df)
    assert chosen.validationMetrics[0] >= chosen.validationMetrics[1]


def test_tuning_changes_depth_when_asked(spark):
    rng = np.random.default_rng(8)
    rows = [(u, i, float(rng.integers(1, 6)), float(rng.normal()), float(u % 3), s)
            for s in ("train", "val", "test") for u in range(12) for i in range(10)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, a double, b double, split string")
    out = models.tune_boosted_trees(df, ["a", "b"], base={"maxIter": 3, "maxDepth": 5}, step_sizes=(0.5,), depth_changes=(1,))
    got = out.orderBy("trial").collect()
    assert [r["stage"] for r in got] == ["step_size", "max_depth"] and got[0]["action"] == "REDUCE_COMPLEXITY"
    assert got[1]["max_depth"] == 4 and sum(r["chosen"] for r in got) == 1
    model = models.fit_boosted_trees(df, ["a", "b"], {"maxIter": 3, "maxDepth": 3})
    importance = models.feature_importance(model, ["a", "b"], spark)
    assert sum(r["pct"] for r in importance.collect()) == pytest.approx(100)
    groups = models.importance_by_group(importance, {"g": ["a", "b"]}).collect()
    assert len(groups) == 1 and groups[0]["pct"] == pytest.approx(100)


def test_embeddings_beat_random_on_block_structure(spark):
    # Two communities: users only like items of their own half.
    liked = [(u, i) for u in range(20) for i in range(20) if (u < 10) == (i < 10)]
    drawn = np.random.default_rng(9).random(len(liked)) < 0.25
    pairs = [p for p, d in zip(liked, drawn) if not d]
    held = [p for p, d in zip(liked, drawn) if d]
    train = spark.createDataFrame(pairs, "user_idx long, item_idx long")
    test = spark.createDataFrame(held, "user_idx long, item_idx long")
    users, items = models.fit_embeddings(train, rank=2, iterations=8)
    assert all(abs(np.linalg.norm(r["vec"]) - 1) < 1e-5 for r in users.collect())
    assert models.retrieval_recall(users, items, test, (10,)).first()["recall_10"] > 0.8
    sweep = models.sweep_embeddings(train, test, {"rank": [2, 0]}, ks=(10,), base={"iterations": 2}).orderBy("run_id").collect()
    assert [r["status"] for r in sweep] == ["success", "failed"] and sweep[1]["error"] and sweep[0]["recall_10"] > 0.5


def test_als_recall_fits_full_factors(spark, monkeypatch):
    import __spark_entry__

    fitted, fit = [], models.fit_embeddings

    def noted(pairs, **options):
        found = fit(pairs, **options)
        fitted.append((found[0].first()["vec"], options))
        return found

    monkeypatch.setattr(models, "fit_embeddings", noted)
    assert __spark_entry__.queries()["als_recall"](spark, "/root/testdata/sf0.001").first()["rises_with_k"]
    assert [(len(vec), options) for vec, options in fitted] == [(128, {})]


def test_recall_searches_only_for_users_with_wanted_items(spark, monkeypatch):
    users = spark.createDataFrame([(u, [1.0, float(u)]) for u in range(6)], "id long, vec array<double>")
    items = spark.createDataFrame([(i, [1.0, -float(i)]) for i in range(4)], "id long, vec array<double>")
    wanted = spark.createDataFrame([(2, 0), (2, 3), (5, 1), (9, 0)], "user_idx long, item_idx long")
    asked, search = [], models.exact_top_k

    def noted(queries, catalogue, k):
        asked.append((sorted(r.query_id for r in queries.collect()), catalogue.count()))
        return search(queries, catalogue, k)

    monkeypatch.setattr(models, "exact_top_k", noted)
    row = models.retrieval_recall(users, items, wanted, (1, 2)).first()
    assert asked == [([2, 5], 4)]  # user 9 has no vector and recalls nothing
    assert row["n_users"] == 3 and row["recall_1"] == pytest.approx(0.5 / 3) and row["recall_2"] == pytest.approx(1.5 / 3)


def test_ndcg_lists_rows_once_and_keeps_null_keys(spark):
    rows = [(None, 1, 5.0, 1.0), (None, 2, 3.0, 2.0), (1, 1, 4.0, 2.0), (1, 2, None, 3.0), (1, 3, 4.0, 1.0)]
    found = metrics.ndcg_per_user(spark.createDataFrame(rows, SCHEMA), (10,))
    assert "explode" not in found._jdf.queryExecution().analyzed().toString()
    got = {r["user_id"]: r["ndcg_10"] for r in found.collect()}
    assert got[None] == pytest.approx((3 + 5 / log2(3)) / (5 + 3 / log2(3)))
    assert got[1] == pytest.approx((4 / log2(3) + 4 / 2) / (4 + 4 / log2(3)))


def test_fits_store_only_the_columns_they_use(spark, monkeypatch, tmp_path):
    from winnow.catalog import model_queries

    class Parts:
        def matrix(self, rows, keep):
            return rows.select(*keep)

    row = spark.createDataFrame([(1, 2, 3, "train", 9)], "user_id long, item_id long, rating int, split string, price_cents long")
    monkeypatch.setattr(model_queries, "split", lambda spark, sf: row)
    monkeypatch.setattr(model_queries, "parts", lambda spark, sf, data: Parts())
    monkeypatch.setattr(model_queries, "materialize", lambda df: df)
    assert model_queries._data(spark, "")[1].columns == ["user_id", "item_id", "rating", "split"]


def test_trees_are_fitted_whole_and_kept_to_the_least_validation_loss(spark):
    from pyspark.ml.regression import GBTRegressor

    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(0.5 * a + 0.25 * b + n), s)  # noise hides most of what a tree gains
            for s, k in (("train", 600), ("val", 300)) for a, b, n in rng.normal(size=(k, 3))]
    df = spark.createDataFrame(rows, "a double, b double, rating double, split string").coalesce(1)
    params = {"maxIter": 12, "maxDepth": 2, "stepSize": 0.02}
    model = models.fit_boosted_trees(df, ["a", "b"], params)
    train, val = (models.assemble(df.where(F.col("split") == s), ["a", "b"]) for s in ("train", "val"))
    whole = GBTRegressor(featuresCol="features", labelCol="rating", **{**models.GBT_DEFAULTS, **params}).fit(train)
    loss = whole.evaluateEachIteration(val, "squared")
    assert model.getNumTrees == 1 + int(np.argmin(loss)) > 2
    assert model.treeWeights == whole.treeWeights[:model.getNumTrees] and model.getMaxDepth() == 2
    got = model.transform(val).selectExpr("avg(pow(rating - prediction, 2))").first()[0]
    assert got == pytest.approx(min(loss)) and model.featureImportances.toArray().sum() == pytest.approx(1)
    short = models.first_trees(whole, 3)
    assert short.getNumTrees == 3 and short.evaluateEachIteration(val, "squared") == pytest.approx(loss[:3])
    # Without validation rows nothing stops the fit.
    assert models.fit_boosted_trees(df.where("split = 'train'"), ["a", "b"], {**params, "maxIter": 3}).getNumTrees == 3


@pytest.mark.parametrize("name", ["gbt_predictions", "gbt_tuning"])
def test_tree_queries_fit_full_trees(spark, monkeypatch, name):
    import __spark_entry__

    class Fitted(Exception):
        pass

    def noted(features, columns, params=None, label="rating"):
        raise Fitted({**models.GBT_DEFAULTS, **(params or {})})

    monkeypatch.setattr(models, "fit_boosted_trees", noted)
    with pytest.raises(Fitted) as fitted:
        __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
    assert fitted.value.args[0]["maxIter"] == 100 and fitted.value.args[0]["maxDepth"] == 6
