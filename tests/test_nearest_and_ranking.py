from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnow.operators import losses, nearest, ranking
from winnow.plans.recommend import recommend, retrieve
from winnow.plans.feature_table import learn

RNG = np.random.default_rng(11)
ITEMS = RNG.normal(size=(90, 8))
ITEMS /= np.linalg.norm(ITEMS, axis=1, keepdims=True)
ITEMS[7] = ITEMS[3]  # equal similarity, the smaller id comes first
QUERIES = RNG.normal(size=(41, 8))


def frame(spark, matrix, key):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{key} long, vec array<double>").repartition(3)


@pytest.fixture(scope="module")
def sides(spark):
    return frame(spark, QUERIES, "query_id").cache(), frame(spark, ITEMS, "item_id").cache()


def brute_force(k, metric="ip"):
    s = np.round(QUERIES @ ITEMS.T, 6)
    if metric == "l2":
        s = -np.round(((QUERIES[:, None] - ITEMS[None]) ** 2).sum(axis=2), 6)
    order = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return {(q, int(i)): (r + 1, abs(s[q, i]) if metric == "l2" else s[q, i])
            for q in range(len(QUERIES)) for r, i in enumerate(order[q])}


def as_dict(df):
    return {(r["query_id"], r["item_id"]): (r["rank"], r["similarity"]) for r in df.collect()}


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("block_rows", [13, 8192])
def test_exact_top_k_equals_brute_force(sides, metric, block_rows):
    got = as_dict(nearest.exact_top_k(*sides, 9, metric, block_rows=block_rows))
    want = brute_force(9, metric)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=2e-6) for k in want)


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_items_in_chunks_give_the_same_hits(monkeypatch, metric):
    monkeypatch.setattr(nearest, "_CHUNK", 16)
    rng = np.random.default_rng(5)
    items = rng.normal(size=(400, 6)).astype(np.float32)
    items[300:] = items[:100]  # equal similarities in later chunks
    queries = rng.normal(size=(30, 6)).astype(np.float32)
    q = pd.DataFrame({"query_id": range(30), "vec": list(queries)})
    i = pd.DataFrame({"item_id": range(400), "vec": list(items)})
    s = nearest._similarity(queries.astype(float), items.astype(float), metric)
    order = np.argsort(-s, axis=1, kind="stable")[:, :7]
    got = nearest._block_top_k(q, i.sample(frac=1, random_state=1), 7, metric)
    assert got["query_id"].tolist() == np.repeat(np.arange(30), 7).tolist()
    assert got["item_id"].tolist() == order.ravel().tolist()
    assert got["similarity"].to_numpy() == pytest.approx(np.take_along_axis(s, order, 1).ravel(), abs=2e-6)
    # A vector without an order is no hit and hides none.
    i.at[0, "vec"] = np.full(6, np.nan, np.float32)
    assert 0 not in nearest._block_top_k(q, i, 7, metric)["item_id"].tolist()


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_only_a_short_first_chunk_is_computed_in_double_precision(monkeypatch, metric):
    seen, nearness = [], nearest._nearness

    def noted(q, items, metric):
        seen.append((items.dtype.itemsize, len(items)))
        return nearness(q, items, metric)

    rng = np.random.default_rng(8)
    items, queries = rng.integers(-3, 4, (20_000, 3)).astype(float), rng.integers(-3, 4, (5, 3)).astype(float)  # many ties
    s = nearest._similarity(queries, items, metric)
    want = np.argsort(-s, axis=1, kind="stable")[:, :10]
    monkeypatch.setattr(nearest, "_nearness", noted)
    rows, cols, values = nearest._strip_top_k(queries, items, items.astype(np.float32), 10, metric)
    assert cols.reshape(5, 10).tolist() == want.tolist() and values.tolist() == np.take_along_axis(s, want, 1).ravel().tolist()
    assert seen[0] == (8, 2_048) and all(size == 4 for size, _ in seen[1:]) and sum(n for _, n in seen) == 20_000


def test_a_task_holds_a_bounded_number_of_queries(sides, monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_ROWS", 4)
    cell = F.lit(0).alias("cell")
    grid = nearest._block_grid(sides[0].select(cell, "query_id", "vec"), sides[1].select(cell, "item_id", "vec"), 1000, True)
    counts = grid.applyInPandas(lambda q, i: pd.DataFrame({"q": [len(q)], "i": [len(i)]}), "q long, i long").collect()
    assert len(counts) > 8 and sum(r.q for r in counts) == len(QUERIES) and max(r.i for r in counts) == len(ITEMS)


def test_top_k_edges(sides):
    assert nearest.exact_top_k(*sides, 0).count() == 0
    assert nearest.exact_top_k(*sides, 1000, block_rows=20).count() == len(QUERIES) * len(ITEMS)
    assert nearest.exact_top_k(sides[0].where("query_id < 0"), sides[1], 5).count() == 0
    with pytest.raises(ValueError):
        nearest.exact_top_k(*sides, 3, "cosine")


def test_inverted_lists_with_full_probe_are_exact(sides):
    lists = nearest.InvertedLists(sides[1], n_lists=6)
    full = lists.search(sides[0], 9, n_probe=6, block_rows=10)
    assert as_dict(full) == as_dict(nearest.exact_top_k(*sides, 9))
    few = nearest.overlap(lists.search(sides[0], 9, n_probe=2), nearest.exact_top_k(*sides, 9)).first()
    assert few["n_exact"] == 9 * len(QUERIES) and 0.2 < few["overlap"] < 1


def test_lsh_returns_true_similarities_without_duplicates(sides):
    got = as_dict(nearest.lsh_top_k(*sides, 9, block_rows=10))
    every = brute_force(len(ITEMS))
    assert len(got) > len(QUERIES)
    assert all(got[k][1] == pytest.approx(every[k][1], abs=2e-6) for k in got)


def test_lsh_scores_few_pairs_of_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(100, 64))
    vectors = centers[np.arange(2_000) % 100] + rng.normal(0, 0.3, (2_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "item_id long, vec array<double>")
    asked = rows.where("item_id % 10 = 0").selectExpr("item_id AS query_id", "transform(vec, x -> x) AS vec")
    found = nearest.overlap(nearest.lsh_top_k(asked, rows, 10), nearest.exact_top_k(asked, rows, 10)).first()
    settings = (10, 4, 1.0, 7)
    left, right = [nearest.projection_cells(d, *settings).groupBy("cell").count() for d in (asked, rows)]
    scored = left.join(right.withColumnRenamed("count", "other"), "cell").selectExpr("sum(count * other)").first()[0]
    assert found["overlap"] >= 0.8 and scored < 0.1 * 200 * 2_000


def test_default_approximate_search_has_recall_and_all_hits(spark):
    # Unstructured vectors, the hardest case, and clusters of three, smaller than k.
    rng = np.random.default_rng(11)
    loose = rng.normal(size=(400, 32))
    tight = np.repeat(rng.normal(size=(130, 32)), 3, axis=0) + rng.normal(0, 0.02, (390, 32))
    for vectors in (loose, tight):
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        rows = frame(spark, vectors, "item_id").cache()
        asked = frame(spark, vectors, "query_id").cache()
        exact = nearest.exact_top_k(asked, rows, 10).cache()
        for found in (nearest.lsh_top_k(asked, rows, 10), nearest.InvertedLists(rows, n_lists=20).search(asked, 10)):
            assert nearest.overlap(found, exact).first()["overlap"] >= 0.9
            assert {r["count"] for r in found.groupBy("query_id").count().collect()} == {10}
        # Queries that meet too few items are searched exactly.
        narrow = nearest.lsh_top_k(asked, rows, 10, tables=1, projections=8, bucket_length=0.2)
        assert {r["count"] for r in narrow.groupBy("query_id").count().collect()} == {10}


def test_similarity_moments_over_blocks(sides):
    row = nearest.similarity_moments(*sides, sample=1000, block_rows=9).first()
    s = QUERIES @ ITEMS.T
    assert row["n_pairs"] == s.size
    assert [row[c] for c in ("mean", "std", "min", "max")] == pytest.approx([s.mean(), s.std(), s.min(), s.max()])


def test_embedding_stats(sides):
    row = nearest.embedding_stats(sides[1]).first()
    assert row["norm_mean"] == pytest.approx(1) and row["value_std"] == pytest.approx(ITEMS.std())
    assert row["dim_var_max"] == pytest.approx(ITEMS.var(axis=0).max())


def test_losses_by_hand(spark):
    df = spark.createDataFrame([(2.0, 1.0), (-800.0, 100.0)], "p double, n double")
    assert losses.bpr_loss(df, "p", "n").first()["bpr_loss"] == pytest.approx((np.log1p(np.exp(-1)) + 900) / 2)
    u, v = RNG.normal(size=(2, 5, 4))
    rows = [(b, [float(x) for x in u[i]], [float(x) for x in v[i]]) for i, b in enumerate([0, 0, 0, 1, 1])]
    got = {r["batch_id"]: r["loss"] for r in losses.inbatch_softmax_loss(
        spark.createDataFrame(rows, "batch_id long, user_vec array<double>, item_vec array<double>")).collect()}
    for b, at in ((0, slice(0, 3)), (1, slice(3, 5))):
        logits = u[at] @ v[at].T / 0.1
        want = (np.log(np.exp(logits).sum(axis=1)) - np.diag(logits)).mean()
        assert got[b] == pytest.approx(want)


def test_rank_ties_keep_retrieval_order(spark):
    rows = [(1, 30, 5.0, 1), (1, 10, 5.0, 2), (1, 20, 9.0, 3), (2, 10, 1.0, 1)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, score double, retrieval_rank int")
    got = ranking.rank_candidates(df, 2, retrieval_rank="retrieval_rank")
    assert sorted((r["user_id"], r["item_id"], r["rank"]) for r in got.collect()) == [(1, 20, 1), (1, 30, 2), (2, 10, 1)]
    merged = ranking.with_similarity(got, spark.createDataFrame([(1, 20, 0.5)], "user_id long, item_id long, similarity double"))
    assert {(r["user_id"], r["item_id"]): r["similarity"] for r in merged.collect()} == {(1, 20): 0.5, (1, 30): 0.0, (2, 10): 0.0}


def test_requests(spark):
    df = spark.createDataFrame([(1, 10), (0, 10), (1, 0), (1, 101), (None, 5), (7, 100)], "user_id long, k int")
    got = ranking.validate_requests(df).collect()
    assert [r["valid"] for r in got] == [True, False, False, False, False, True]
    assert got[3]["reason"] == "k must be at most 100"


def test_recommend_covers_exactly_the_users_with_vectors(spark):
    split = spark.createDataFrame(
        [(1, 0, 5, "train"), (1, 1, 1, "train"), (2, 2, 4, "train")], "user_id long, item_id long, rating int, split string")
    catalogue = spark.createDataFrame([(i, "t", "A") for i in range(4)], "item_id long, title string, genres string")
    people = spark.createDataFrame([(1, "M", 25, 1)], "user_id long, gender string, age int, occupation int")
    users = frame(spark, QUERIES[:2], "user_id").withColumn("user_id", F.col("user_id") + 2).withColumnRenamed("vec", "user_vec")
    items = frame(spark, ITEMS[:4], "item_id").withColumnRenamed("vec", "item_vec")
    parts, pool = learn(split, catalogue, people), retrieve(users, items, 100)
    got = recommend(pool, parts, 10, score=F.col("item_avg_rating")).collect()
    assert {r["user_id"] for r in got} == {2, 3} and len(got) == 8  # min(k, catalogue) each
    assert [r["item_id"] for r in sorted(got, key=lambda r: (r["user_id"], r["rank"])) if r["rank"] == 1] == [0, 0]
    assert {r["similarity"] for r in got} == {r["similarity"] for r in pool.collect()}
    unseen = recommend(pool, parts, 10, score=F.col("item_avg_rating"), seen=split).collect()
    assert (2, 2) not in {(r["user_id"], r["item_id"]) for r in unseen} and len(unseen) == 7
