from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnow.functions.hashing import coprime_strides
from winnow.operators import features as f
from winnow.operators import ids, profile
from winnow.plans import feature_table
from winnow.runtime import materialize

ROWS = [
    (1, 10, 5, "train"), (1, 11, 3, "train"), (2, 10, 4, "train"), (3, 12, 2, "train"),
    (1, 12, 1, "val"), (9, 10, 4, "test"), (2, 99, 5, "test"),
]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(ROWS, "user_id long, item_id long, rating int, split string")


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame(
        [(10, "a", "WAR|DRAMA"), (11, "b", "WARRIOR"), (12, "c", "DRAMA")], "item_id long, title string, genres string"
    )


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "M", 25, 3), (2, "F", 35, 4)], "user_id long, gender string, age int, occupation int"
    )


def test_entity_stats_and_defaults(spark, data):
    train = data.where("split = 'train'")
    stats = {r["user_id"]: r for r in f.entity_stats(train, "user_id", "user").collect()}
    assert stats[1]["user_rating_std"] == pytest.approx(np.std([5, 3], ddof=1)) and stats[1]["user_avg_rating"] == 4
    assert stats[2]["user_rating_std"] == 0  # one row
    d = f.cold_start_defaults(train).first()
    assert d["user_rating_count"] == 0 and d["item_avg_rating"] == 3.5
    assert d["item_rating_std"] == pytest.approx(np.std([5, 3, 4, 2], ddof=1)) and d["user_rating_max"] == 5


def test_feature_matrix_against_pandas(spark, data, catalogue, people):
    parts = feature_table.learn(data, catalogue, people)
    assert parts.vocabulary == ["DRAMA", "WAR", "WARRIOR"]
    assert len(parts.columns) == 10 + 3 + 3 + 4
    rows = {(r["user_id"], r["item_id"]): r for r in parts.matrix(data, ["user_id", "item_id", "split"]).collect()}
    assert len(rows) == len(ROWS)
    cold = rows[(9, 10)]
    assert cold["user_rating_count"] == 0 and cold["user_avg_rating"] == 3.5 and cold["gender"] == 0 and cold["age_group"] == 0
    assert cold["user_item_rating_diff"] == pytest.approx(3.5 - 4.5)
    assert cold["item_rating_count_norm"] == pytest.approx(np.log1p(2)) and cold["user_item_activity_product"] == 0
    assert rows[(2, 99)]["genre_drama"] == 0 and rows[(2, 99)]["item_avg_rating"] == 3.5
    assert rows[(1, 11)]["genre_war"] == 1  # substring match
    token = feature_table.learn(data, catalogue, people, mode="token")
    assert {r["item_id"]: r["genre_war"] for r in token.multihot.collect()} == {10: 1, 11: 0, 12: 0}
    serving = parts.matrix(data, ["user_id", "item_id"], serving=True).where("user_id = 9").first()
    assert serving["age_group"] == 25 and serving["gender"] == 0


def test_leakage_checks_find_planted_faults(spark, data, catalogue, people):
    parts = feature_table.learn(data, catalogue, people)
    good = parts.matrix(data, ["user_id", "item_id", "split"])
    clean = {r["check"]: r["violations"] for r in f.leakage_checks(good, parts.defaults, parts.columns).collect()}
    assert clean == {"user_stats_equal_across_splits": 0, "no_missing_values": 0, "cold_users_hold_defaults": 0, "cold_user_rows": 1}
    bad = good.withColumn("user_avg_rating", F.when(F.col("split") == "train", F.col("user_avg_rating")).otherwise(9.0))
    bad = bad.withColumn("occupation", F.when(F.col("user_id") == 3, None).otherwise(F.col("occupation")))
    found = {r["check"]: r["violations"] for r in f.leakage_checks(bad, parts.defaults, parts.columns).collect()}
    assert found["user_stats_equal_across_splits"] == 2 and found["no_missing_values"] == 1
    assert found["cold_users_hold_defaults"] == 1


def test_id_map_is_a_bijection(spark, data):
    m = ids.id_map(data, "item_id", "item_idx")
    assert sorted(map(tuple, m.select("item_id", "item_idx").collect())) == [(10, 0), (11, 1), (12, 2), (99, 3)]
    ok = ids.verify_id_map(m, "item_id", "item_idx").first()
    assert ok["bijective"] and ok["contiguous"]
    broken = spark.createDataFrame([(1, 0), (2, 0), (3, 5)], "item_id long, item_idx long")
    row = ids.verify_id_map(broken, "item_id", "item_idx").first()
    assert not row["bijective"] and not row["contiguous"]


def test_training_pairs_drop_unmapped_rows(spark, data):
    train = data.where("split = 'train'")
    u, i = ids.id_map(train, "user_id", "user_idx"), ids.id_map(train, "item_id", "item_idx")
    pairs = ids.training_pairs(data.where("split <> 'train'"), u, i)
    assert [(r["user_id"], r["item_id"]) for r in pairs.collect()] == [(1, 12)]


def test_positive_sets_are_chunked_and_complete(spark):
    pairs = spark.createDataFrame([(0, i % 25) for i in range(100)] + [(1, 3)], "user_idx long, item_idx long")
    sets = ids.positive_sets(pairs, user_idx="user_idx", item_idx="item_idx", chunk=10)
    rows = sorted((r["user_idx"], r["part"], r["items"]) for r in sets.collect())
    assert rows == [(0, 0, list(range(10))), (0, 1, list(range(10, 20))), (0, 2, list(range(20, 25))), (1, 0, [3])]
    js = {r["json"] for r in ids.positive_sets_json(sets, user_idx="user_idx").collect()}
    assert '{"1":[3]}' in js


def test_negatives_are_unseen_distinct_and_complete(spark):
    n_items = 30
    seen = {0: set(range(27)), 1: {5}, 2: set(range(30)), 3: set(range(0, 30, 2))}
    pairs = spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_idx long, item_idx long")
    out = ids.negative_samples(pairs, n_items, per_positive=4).toPandas()
    assert (out["neg_idx"].between(0, n_items - 1)).all()
    for (u, i), g in out.groupby(["user_idx", "item_idx"]):
        assert not set(g.neg_idx) & seen[u] and g.neg_idx.is_unique and sorted(g.n) == list(range(1, len(g) + 1))
    sizes = out.groupby(["user_idx", "item_idx"]).size()
    assert (sizes[1] == 4).all() and (sizes[3] == 4).all()
    assert (sizes[0] == 3).all() and len(sizes[0]) == 27  # only three unseen items exist
    assert 2 not in sizes.index.get_level_values(0)
    again = ids.negative_samples(pairs.repartition(3), n_items, per_positive=4).toPandas()
    key = ["user_idx", "item_idx", "n"]
    pd.testing.assert_frame_equal(out.sort_values(key).reset_index(drop=True), again.sort_values(key).reset_index(drop=True))


def test_negatives_of_a_saturated_user_list_the_catalogue_once(spark):
    n_items = 4_000
    seen = spark.range(3, n_items).selectExpr("0L AS user_idx", "id AS item_idx")
    out = ids.negative_samples(seen, n_items, per_positive=4).toPandas()
    assert len(out) == 3 * (n_items - 3) and set(out.neg_idx) == {0, 1, 2}
    listed = ids._unseen_of(seen.select("user_idx").distinct(), seen.withColumnRenamed("item_idx", "neg_idx"), n_items, "user_idx")
    assert listed.count() == 3


def _walks(seen, n_items, per_positive, seed=7):
    """Negatives by plain Python: ``{(user, item): [...]}`` of ``{user: items}``."""
    stride = coprime_strides(n_items, 1)[0][0]
    out = {}
    for u, items in seen.items():
        for i in items:
            start = int(hashlib.md5(f"{seed}|{u}|{i}".encode()).hexdigest()[:8], 16) % n_items
            walk = ((start + r * stride) % n_items for r in range(n_items))
            free = [x for x in walk if x not in items][:per_positive]
            out |= {(u, i): free} if free else {}
    return out


def _sampled(pairs, n_items, per_positive):
    out = {}
    for r in sorted(ids.negative_samples(pairs, n_items, per_positive).collect(), key=lambda r: r["n"]):
        out.setdefault((r["user_idx"], r["item_idx"]), []).append(r["neg_idx"])
        assert r["n"] == len(out[r["user_idx"], r["item_idx"]])
    return out


@pytest.mark.parametrize("listed", [0, 12, 1_000])
def test_negatives_are_the_first_unseen_of_each_walk(spark, monkeypatch, listed):
    monkeypatch.setattr(ids, "_LISTED", listed)
    # Few and many positives, runs along the walk that need a second one, few and no unseen items.
    n_items = 101
    stride = coprime_strides(n_items, 1)[0][0]
    start = int(hashlib.md5(b"7|4|50").hexdigest()[:8], 16) % n_items
    seen = {0: {3}, 1: set(range(0, 101, 3)), 2: set(range(95)), 3: set(range(101)),
            4: {50} | {(start + r * stride) % n_items for r in range(11)}, 5: set(range(40)), 6: set(range(20, 32))}
    rows = [(u, i) for u, items in seen.items() for i in items]
    pairs = spark.createDataFrame(rows + rows[:30], "user_idx long, item_idx long")
    assert _sampled(pairs, n_items, 4) == _walks(seen, n_items, 4)
    assert _sampled(pairs, n_items, 40) == _walks(seen, n_items, 40)
    assert _sampled(pairs.where("item_idx = 0"), 1, 4) == {}


def test_candidates_of_short_lists_are_not_shuffled(spark, monkeypatch):
    rows = {}

    def stored(df, name="stage"):
        out = materialize(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(ids, "materialize", stored)
    pairs = spark.range(2_000).selectExpr("id % 100 AS user_idx", "id AS item_idx")
    out = ids.negative_samples(pairs, 2_000, per_positive=4)
    assert "negatives" not in rows and rows["short"] == [0]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert out.count() == 8_000
    # One long list among them: only its pairs go through the join and the window.
    rows.clear()
    long_list = spark.range(1_500).selectExpr("100L AS user_idx", "id AS item_idx")
    out = ids.negative_samples(pairs.unionByName(long_list), 2_000, per_positive=4)
    assert rows["short"][0] == 1_500 and max(rows["negatives"]) <= 6_000
    assert out.count() == 14_000


def test_residues_of_large_catalogues(spark):
    from winnow.functions.hashing import times_modulo

    n, values = 10**13 + 37, [0, 1, 9_999_999_999_999, 5_555_555_555_555]
    df = spark.createDataFrame([(v,) for v in values], "a long")
    assert [r[0] for r in df.coalesce(1).select(times_modulo(F.col("a"), 3_819_660_112_501, n)).collect()] == [
        v * 3_819_660_112_501 % n for v in values]


def test_open_tag_vocabularies_have_a_long_form(spark):
    df = spark.createDataFrame([(1, "A|B|A"), (2, "C")], "item_id long, genres string")
    assert sorted(map(tuple, f.tag_rows(df).collect())) == [(1, "A"), (1, "B"), (2, "C")]


def test_batches_are_full_and_shuffled(spark):
    pairs = spark.range(1000).select(F.col("id").alias("u"), (F.col("id") * 7).alias("i"))
    out = ids.training_batches(pairs, 64, 1, "u", "i").toPandas()
    sizes = out.groupby("batch_id").size()
    assert len(sizes) == 16 and (sizes.iloc[:-1] == 64).all() and sizes.iloc[-1] == 1000 - 15 * 64
    assert list(out.sort_values("pos").u) != sorted(out.u) and set(out.u) == set(range(1000))


def test_random_rank_is_a_permutation_per_user(spark):
    df = spark.range(120).select((F.col("id") % 3).alias("user"), F.expr("id div 3").alias("idx"))
    out = ids.random_rank(df, 40, 5, user="user", item_idx="idx").toPandas()
    for _, g in out.groupby("user"):
        assert sorted(g["rank"]) == list(range(1, 41))
    first = out[out["rank"] == 1].set_index("user").idx
    assert first.nunique() > 1


def test_profile_edges(spark, catalogue):
    df = spark.createDataFrame([(1.0, 1.0, 2), (2.0, 1.0, 4), (4.0, 1.0, 8)], "a double, c double, rating int")
    got = {r["feature"]: r["correlation"] for r in profile.target_correlation(df, ["a", "c"]).collect()}
    assert got["a"] == pytest.approx(1.0) and got["c"] is None
    assert [tuple(r)[:2] for r in profile.correlated_pairs(df, ["a", "rating", "c"]).collect()] == [("a", "rating")]
    nulls = {r[0]: r[1] for r in profile.null_counts(spark.createDataFrame([(1, None), (2, "x")], "k int, s string")).collect()}
    assert nulls == {"k": 0, "s": 1}
    repeated = spark.createDataFrame([("A|A|B",)], "genres string")
    assert {r[0]: r[1] for r in profile.tag_counts(repeated).collect()} == {"A": 2, "B": 1}
    few = spark.createDataFrame([(1, 2), (1, 3)], "user_id long, item_id long")
    assert profile.dataset_overview(few).first()["sparsity"] == 0
    assert profile.dataset_overview(few, approximate=True).first()["n_items"] == 2
