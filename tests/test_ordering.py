"""Splits, global ranks and quantiles, with hot keys and forced narrowing."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnow.operators import drift, order_stats, ranks, splits


def labels(df, keys):
    return [r["split"] for r in df.orderBy(*keys).collect()]


def expected(n, train, val):
    a, b = int(n * train), int(n * (train + val))
    return ["train"] * a + ["val"] * (b - a) + ["test"] * (n - b)


@pytest.mark.parametrize("fetch_rows", [1, 7, 20_000])
def test_split_cuts_inside_a_hot_timestamp(spark, monkeypatch, fetch_rows):
    # More than a third of all rows share one timestamp, and the cut falls there.
    rows = [(i if i < 60 else 60, i * 37 % 1009) for i in range(100)]
    df = spark.createDataFrame(rows, "ts long, id long").repartition(5)
    found = order_stats.rows_at(df, ["ts", "id"], (0.8, 0.9), fetch_rows=fetch_rows, buckets=3)
    ordered = sorted(rows)
    for bound, position in zip(found, (80, 90)):
        row = spark.range(1).select(bound["ts"], bound["id"]).first()
        assert tuple(row) == ordered[position - 1]
    early = order_stats.rows_at(df, ["ts", "id"], (0.3,))[0]
    assert list(early) == ["ts"]
    assert labels(splits.time_split(df, ["ts", "id"]), ["ts", "id"]) == expected(100, 0.8, 0.1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60), st.sampled_from([0.0, 0.3, 0.5, 0.8]))
def test_split_sizes_add_up(spark, values, train):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "ts long, id long")
    got = labels(splits.time_split(df, ["ts", "id"], train, 0.1), ["ts", "id"])
    assert got == expected(len(values), train, 0.1)


def test_split_on_dates_and_timestamps(spark):
    df = spark.range(50).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00.000001' + make_dt_interval(0, 0, 0, id div 3 * 0.5)").alias("ts"), "id"
    ).withColumn("day", F.col("ts").cast("date")).withColumn("ltz", F.col("ts").cast("timestamp"))
    for key in ("ts", "day", "ltz"):
        assert labels(splits.time_split(df, [key, "id"]), ["id"]) == expected(50, 0.8, 0.1)


def test_split_refuses_missing_keys_and_text(spark):
    df = spark.createDataFrame([(1, 1), (None, 2)], "ts long, id long")
    with pytest.raises(ValueError, match="1 rows"):
        splits.time_split(df, ["ts", "id"])
    with pytest.raises(TypeError):
        splits.time_split(spark.createDataFrame([("a",)], "k string"), ["k"])


def test_filter_on_a_split_reaches_the_scan(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("ts"), "id").write.parquet(str(tmp_path / "t"))
    split = splits.time_split(spark.read.parquet(str(tmp_path / "t")), ["ts", "id"])
    plan = split.where("split = 'train'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "LessThanOrEqual(ts,799)" in plan


def test_minimum_history(spark):
    rows = [(1, "train")] * 3 + [(2, "train")] + [(1, "val"), (2, "val"), (2, "test"), (3, "test")]
    df = spark.createDataFrame(rows, "user_id long, split string")
    kept = splits.minimum_history(df, 2)
    assert sorted(map(tuple, kept.collect())) == [(1, "train")] * 3 + [(1, "val"), (2, "train")]
    report = {r["split"]: r for r in splits.retained_share(df, kept).collect()}
    assert report["test"]["rows_after"] == 0 and report["val"]["retained_pct"] == 50


def test_global_rank_matches_a_sort(spark):
    values = np.random.default_rng(3).permutation(5000)
    df = spark.createDataFrame([("hot" if v % 3 else "cold", int(v)) for v in values], "k string, v long").repartition(7)
    got = ranks.global_rank(df, ["k", "v"]).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(5000))
    assert [(r["k"], r["v"]) for r in got] == sorted((("hot" if v % 3 else "cold"), int(v)) for v in values)


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 2).alias("key"), "id").repartition(8)
    best = ranks.top_k(df, ["key"], [F.desc("id")], 3)
    assert sorted((r["key"], r["id"], r["rank"]) for r in best.collect()) == [
        (0, 9994, 3), (0, 9996, 2), (0, 9998, 1), (1, 9995, 3), (1, 9997, 2), (1, 9999, 1)
    ]
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@pytest.mark.parametrize("fetch,bits", [(4_096, 8), (50, 5), (1, 8)])
def test_quantiles_equal_numpy(spark, fetch, bits):
    rng = np.random.default_rng(5)
    groups = {
        "normal": rng.normal(size=700), "heavy": np.exp(rng.normal(size=500) * 4), "constant": np.full(40, 2.5),
        "hot": np.concatenate([np.full(300, 1.0), rng.uniform(size=200)]), "single": np.array([7.0]),
        "wide": np.array([-1e308, 0.0, 1e308]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("normal", None), ("normal", float("nan"))]
    df = spark.createDataFrame(rows, "feature string, value double").repartition(6)
    got = {r[0]: r[1] for r in order_stats.quantiles(df, "feature", "value", PROBS, fetch=fetch, bits=bits).collect()}
    assert set(got) == set(groups)
    for name, values in groups.items():
        if name == "wide":  # the interpolation itself overflows in numpy
            assert got[name][0] == -1e308 and got[name][3] == 0 and got[name][-1] == 1e308
            continue
        assert got[name] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_quantiles_of_infinities_denormals_and_ties(spark):
    inf, tiny = float("inf"), 5e-324
    groups = {
        "infinite": [-inf, 1.0, 2.0, 3.0, inf, inf, -0.0, 0.0], "denormal": [i * tiny for i in range(-40, 60)],
        "ties": [3.5] * 900 + [i / 7 for i in range(100)], "signs": [(-2.0) ** i for i in range(200)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "feature string, value double").repartition(4)
    want = {r[0]: r[1] for r in df.groupBy("feature").agg(F.percentile("value", F.lit(PROBS))).collect()}
    got = {r[0]: r[1] for r in order_stats.quantiles(df, "feature", "value", PROBS, fetch=3, bits=4).collect()}
    for name in groups:
        assert got[name] == pytest.approx(want[name], rel=1e-12, abs=0)


def test_integer_form_keeps_the_order(spark):
    values = sorted([float("-inf"), -1e308, -2.5, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e308, float("inf")])
    keys = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(order_stats.ordered_bits(F.col("v"))).collect()]
    assert keys == sorted(set(keys)) and [order_stats.from_ordered_bits(k) for k in keys] == values


def test_split_refuses_keys_that_tie_at_a_boundary(spark):
    df = spark.createDataFrame([(1,)] * 10, "ts long")
    for fetch_rows in (1, 20_000):
        with pytest.raises(ValueError, match="do not tell"):
            order_stats.rows_at(df, ["ts"], (0.5,), fetch_rows=fetch_rows)


def test_counted_percentiles(spark):
    values = [1, 1, 1, 2, 5, 9]
    df = spark.createDataFrame([(v,) for v in values], "n int")
    got = order_stats.counted_percentiles(df, "n", [0.25, 0.5, 0.9]).first()[0]
    assert got == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])))


def _two_scans(df, probs, **kw):
    accuracy = kw.get("accuracy", order_stats.SKETCH_ACCURACY)
    sketched = df.groupBy("feature").agg(*order_stats.bracket_aggregates("value", probs, accuracy))
    return {r[0]: r[1] for r in order_stats.bracketed_quantiles(df, "feature", "value", probs, sketched, **kw).collect()}


@pytest.mark.parametrize("accuracy,fetch", [(100_000, 20_000), (50, 20_000), (10, 3), (200, 1)])
def test_bracketed_quantiles_equal_numpy(spark, accuracy, fetch):
    """Default brackets, loose sketches, and brackets too large to gather (found by narrowing)."""
    rng = np.random.default_rng(5)
    groups = {
        "normal": rng.normal(size=700), "heavy": np.exp(rng.normal(size=500) * 4), "constant": np.full(40, 2.5),
        "hot": np.concatenate([np.full(300, 1.0), rng.uniform(size=200)]), "single": np.array([7.0]),
        "wide": np.array([-1e308, 0.0, 1e308]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("normal", None), ("normal", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows, "feature string, value double").repartition(6)
    got = _two_scans(df, PROBS, accuracy=accuracy, fetch=fetch)
    assert set(got) == set(groups)
    for name, values in groups.items():
        if name == "wide":
            assert got[name][0] == -1e308 and got[name][3] == 0 and got[name][-1] == 1e308
            continue
        assert got[name] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_bracketed_quantiles_of_infinities_denormals_and_ties(spark):
    inf, tiny = float("inf"), 5e-324
    groups = {
        "infinite": [-inf, 1.0, 2.0, 3.0, inf, inf, -0.0, 0.0], "denormal": [i * tiny for i in range(-40, 60)],
        "ties": [3.5] * 900 + [i / 7 for i in range(100)], "signs": [(-2.0) ** i for i in range(200)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "feature string, value double").repartition(4)
    want = {r[0]: r[1] for r in df.groupBy("feature").agg(F.percentile("value", F.lit(PROBS))).collect()}
    for accuracy, fetch in [(100_000, 20_000), (10, 3)]:
        got = _two_scans(df, PROBS, accuracy=accuracy, fetch=fetch)
        for name in groups:
            assert got[name] == pytest.approx(want[name], rel=1e-12, abs=0), (name, accuracy)


def test_baseline_takes_two_scans_of_the_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(f"f{i % 3}", float(v)) for i, v in enumerate(rng.normal(size=3000))]
    df = spark.createDataFrame(rows, "feature string, value double")
    got = {r["feature"]: r for r in drift.feature_baseline(df).collect()}
    for name in ("f0", "f1", "f2"):
        values = [v for f, v in rows if f == name]
        assert [got[name][c] for c in ("p05", "p25", "p50", "p75", "p95")] == pytest.approx(
            list(np.quantile(values, [0.05, 0.25, 0.5, 0.75, 0.95])), rel=1e-12)


def test_slots_are_numbered_by_ends_in_columns(spark):
    values = [-1.0, 0.0, 0.5, 1.0, 3.0, 7.0, float("inf")]
    df = spark.createDataFrame([(v, 0.0, 1.0, 3.0, float("nan")) for v in values], "v double, e0 double, e1 double, e2 double, e3 double")
    got = [r[0] for r in df.select(order_stats._slot(F.col("v"), ["e0", "e1", "e2", "e3"])).collect()]
    assert got == [0, 1, 2, 3, 5, 6, 6]


def test_values_inside_brackets_are_not_gathered_in_lists(spark, tmp_path):
    """The second scan counts in plain hash aggregates; what it keeps apart stays a table."""
    rows = [("f", float(i)) for i in range(2_000)]
    df = spark.createDataFrame(rows, "feature string, value double")
    sketched = df.groupBy("feature").agg(*order_stats.bracket_aggregates("value", [0.5], 10)).cache()
    kept = []
    keep, order_stats.materialize = order_stats.materialize, lambda d, n="stage": kept.append(d) or keep(d, n)
    try:
        found = order_stats.bracketed_quantiles(df, "feature", "value", [0.5], sketched, accuracy=10).first()
    finally:
        order_stats.materialize = keep
    assert found["quantiles"] == [999.5]
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "collect_list" not in plan
