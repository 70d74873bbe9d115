from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.operators import drift
from winnow.operators import lookup_tables as kv
from winnow.sources import files
from winnow.streaming import drift_stream


def long(spark, **features):
    rows = [(n, None if v is None else float(v)) for n, vs in features.items() for v in vs]
    return spark.createDataFrame(rows, "feature string, value double")


def test_baseline_edges(spark):
    df = long(spark, five=[1, 2, 3, 4, 5], constant=[2, 2, 2], nothing=[None, None], holes=[1, None, float("nan"), 3])
    got = {r["feature"]: r for r in drift.feature_baseline(df).collect()}
    assert set(got) == {"five", "constant", "holes"}
    assert got["five"]["mean"] == 3 and got["five"]["std"] == pytest.approx(np.std([1, 2, 3, 4, 5], ddof=1))
    assert got["five"]["p05"] == pytest.approx(1.2) and got["constant"]["std"] == 1e-10
    assert got["holes"]["n_samples"] == 2 and got["holes"]["p50"] == 2
    assert drift.to_long(spark.createDataFrame([(1, 2)], "a int, b int"), ["a", "zzz"]).collect() == [("a", 1.0)]


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(1).integers(0, 12, 300).astype(float)
    df = long(spark, x=values, flat=[4.0] * 7)
    edges = drift.histogram_edges(df)
    stored = {r["feature"]: r["edges"] for r in edges.collect()}
    want = np.unique(np.quantile(values, np.linspace(0, 1, 11)))
    assert stored["x"] == pytest.approx(list(want)) and stored["flat"] == [4.0, 4.0 + 1e-10]
    rows = drift.histogram(df, edges).where("feature = 'x'").orderBy("bin").collect()
    assert [r["n"] for r in rows] == list(np.histogram(values, bins=want)[0])
    assert sum(r["share"] for r in rows) == pytest.approx(1)
    same = drift.population_stability(drift.histogram(df, edges), drift.histogram(df, edges))
    assert all(r["psi"] == pytest.approx(0, abs=1e-12) for r in same.collect())
    outside = drift.histogram(long(spark, x=[-100, 100], flat=[4]), edges).where("feature = 'x'").orderBy("bin").collect()
    assert outside[0]["n"] == 1 and outside[-1]["n"] == 1


def test_moments_merge_and_survive_json(spark):
    whole = drift.moments(long(spark, x=[1, 2, 3, 4, 5], zero=[0, 0], one=[9]))
    got = {r["feature"]: r for r in whole.collect()}
    assert got["x"]["mean"] == 3 and got["x"]["std"] == pytest.approx(math.sqrt(2)) and got["x"]["m2"] == pytest.approx(10)
    parts = drift.moments(long(spark, x=[1, 2])).unionByName(drift.moments(long(spark, x=[3, 4, 5], zero=[0, 0], one=[9])))
    empty = spark.createDataFrame([("x", 0, 0.0, 0.0, None, None, 0.0)], parts.schema)
    merged = {r["feature"]: r for r in drift.merge_moments(parts.unionByName(empty)).collect()}
    for name in got:
        for c in ("count", "mean", "m2", "min", "max", "std"):
            assert merged[name][c] == pytest.approx(got[name][c]), (name, c)
    back = {r["feature"]: r for r in drift.moments_from_json(drift.moments_json(whole)).collect()}
    assert back["zero"]["min"] == 0.0 and back["zero"]["max"] == 0.0 and back["x"]["std"] == pytest.approx(got["x"]["std"])
    watched = drift.moments(long(spark, x=[1], y=[2]), monitored=spark.createDataFrame([("y",)], "feature string"))
    assert [r["feature"] for r in watched.collect()] == ["y"]


def test_report_and_summary(spark):
    rng = np.random.default_rng(4)
    base = long(spark, same=rng.normal(size=500), moved=rng.normal(size=500), only_base=[1, 2])
    now = long(spark, same=rng.normal(size=400), moved=rng.normal(size=50) + 6, only_now=[1])
    report = drift.drift_report(drift.feature_baseline(base), drift.moments(now))
    got = {r["feature"]: r for r in report.collect()}
    assert set(got) == {"same", "moved"}
    assert got["same"]["severity"] == "ok" and got["moved"]["severity"] == "alert"
    assert got["same"]["sufficient_samples"] and not got["moved"]["sufficient_samples"]
    one = drift.drift_summary(report).first()
    assert (one["num_ok"], one["num_warning"], one["num_alert"], one["status"]) == (1, 0, 1, "alert")
    assert one["alerting_features"] == ["moved"] and one["online_samples"] == 400
    none = drift.latest_status(drift.drift_summary(report, ["feature"]).where("false"), "feature").first()
    assert none["status"] == "not_checked" and none["n_reports"] == 0


def test_key_value_snapshot(spark, tmp_path):
    stats = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 4.0)], "user_id long, a double, b double")
    snapshot = kv.to_key_value(stats, "user", "user_id", "stats", ["a", "b"])
    demo = kv.to_key_value(stats, "user", "user_id", "demographics", ["b"])
    path = str(tmp_path / "kv")
    kv.publish(snapshot, path)
    kv.publish(demo, path)
    kv.publish(snapshot, path)  # again: same content, other kinds stay
    sink = spark.read.parquet(path)
    assert sink.count() == 6 and {r["kind"]: r["n_keys"] for r in kv.key_counts(sink).collect()} == {"user_stats": 2, "user_demographics": 2}
    assert tuple(kv.reconcile(snapshot, sink).first()) == (4, 0, 0)
    stale = sink.withColumn("value", F.when(F.col("field") == "b", F.col("value") + 1).otherwise(F.col("value"))).where("key <> 'features:user:1:stats'")
    assert tuple(kv.reconcile(snapshot, stale).first()) == (4, 2, 1)
    old = snapshot.withColumn("version", F.lit(1))
    new = spark.createDataFrame([("features:user:1:stats", "a", 9.0, 2), ("k", "a", 1.0, 2)], old.schema)
    merged = {(r["key"], r["field"]): r["value"] for r in kv.upsert(old, new).collect()}
    assert len(merged) == 5 and merged[("features:user:1:stats", "a")] == 9.0


def test_layered_lookup(spark):
    primary = spark.createDataFrame([(1, 5.0, None)], "user_id long, a double, b double")
    requests = spark.createDataFrame([(1,), (2,), (2,)], "user_id long")
    got = kv.layered_lookup(requests, primary, "user_id", {"a": 0, "b": 7}).orderBy("user_id").collect()
    assert [(r["a"], r["b"], r["source"]) for r in got] == [(5.0, None, "primary"), (0.0, 7.0, "fallback"), (0.0, 7.0, "fallback")]
    stats = kv.lookup_stats(kv.layered_lookup(requests, primary, "user_id", {"a": 0, "b": 7})).first()
    assert stats["total_requests"] == 3 and stats["hit_rate"] == pytest.approx(1 / 3)
    assert kv.lookup_stats(kv.layered_lookup(requests.where("false"), primary, "user_id", {"a": 0, "b": 7})).first()["hit_rate"] == 0
    as_map = kv.features_as_map(kv.layered_lookup(requests, primary, "user_id", {"a": 0, "b": 7}), "user_id", ["a", "b"])
    assert as_map.where("source = 'primary'").first()["features"] == {"a": 5.0, "b": None}


def test_delimited_files(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = [(1, 'Amélie "quoted", (2001)', "A|B"), (2, "plain", "C")]
    files.write_delimited(spark.createDataFrame(rows, files.ITEMS), path, encoding="ISO-8859-1")
    back = files.read_delimited(spark, path, files.ITEMS, encoding="ISO-8859-1")
    assert sorted(map(tuple, back.collect())) == rows
    (tmp_path / "ratings.dat").write_text("1::10::5::978300760\n2::11::3::978302109\n")
    ratings = files.read_delimited(spark, str(tmp_path / "ratings.dat"), files.RATINGS)
    assert sorted(map(tuple, ratings.collect())) == [(1, 10, 5, 978300760), (2, 11, 3, 978302109)]


def test_partition_pruning_of_stored_splits(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id long, split string")
    files.write_splits(df, str(tmp_path / "s"))
    part = files.read_split(spark, str(tmp_path / "s"), "test")
    assert [r["id"] for r in part.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()


# --- streams ----------------------------------------------------------------

@pytest.fixture()
def log_files(spark, tmp_path):
    """A feature log in five files, so that a stream needs several batches."""
    rng = np.random.default_rng(6)
    start = dt.datetime(2024, 1, 1)
    path = tmp_path / "log"
    for part in range(5):
        rows = [(start + dt.timedelta(minutes=30 * part + int(m)), f"f{int(m) % 3}", float(v))
                for m, v in zip(rng.integers(0, 90, 80), rng.normal(size=80))]
        spark.createDataFrame(rows, drift_stream.LOG).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


@pytest.mark.parametrize("build,keys,mode", [
    (drift_stream.online_stats, ["feature"], "complete"),
    (lambda s: drift_stream.windowed_stats(s, watermark="1 day"), ["window_start", "feature"], "update"),
])
def test_stream_equals_batch(spark, tmp_path, log_files, build, keys, mode):
    stream = drift_stream.read_feature_log(spark, log_files, files_per_trigger=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    query = drift_stream.start_upsert_sink(build(stream), out, state, mode)
    query.awaitTermination()
    assert len({r["batch_id"] for r in spark.read.parquet(out).select("batch_id").distinct().collect()}) >= 5
    got = {tuple(r[k] for k in keys): r for r in drift_stream.latest(spark, out, keys).collect()}
    want = {tuple(r[k] for k in keys): r for r in build(spark.read.parquet(log_files)).collect()}
    assert got.keys() == want.keys()
    for key, row in want.items():
        for c in ("count", "mean", "m2", "min", "max", "std"):
            assert got[key][c] == pytest.approx(row[c], abs=1e-9)
    # A restart from the same state finds nothing new and changes nothing.
    drift_stream.start_upsert_sink(build(drift_stream.read_feature_log(spark, log_files)), out, state, mode).awaitTermination()
    assert drift_stream.latest(spark, out, keys).count() == len(want)


def test_stream_joins_a_static_baseline(spark, tmp_path, log_files):
    rows = spark.read.parquet(log_files)
    baseline = drift.feature_baseline(rows.select("feature", "value")).withColumn("mean", F.col("mean") - 10)
    stream = drift_stream.windowed_stats(drift_stream.read_feature_log(spark, log_files), "1 day")
    out = str(tmp_path / "report")
    drift_stream.start_upsert_sink(
        stream, out, str(tmp_path / "st"), transform=lambda b: drift_stream.windowed_drift(b, baseline)
    ).awaitTermination()
    report = drift_stream.latest(spark, out, ["window_start", "feature"])
    assert {r["severity"] for r in report.collect()} == {"alert"} and report.count() == 3
    assert drift_stream.windowed_summary(report).first()["num_alert"] == 3


def test_publish_keeps_a_file_open_per_kind_instead_of_sorting(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from winnow.operators import lookup_tables

    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(name, None)

    def noted(self, path, *args, **kwargs):
        seen.append(int(spark.conf.get(name, "0")))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    rows = [(f"features:{e}:{i}:stats", "a", float(i)) for i in range(50) for e in ("user", "item")]
    snapshot = spark.createDataFrame(rows, "key string, field string, value double").coalesce(1)
    lookup_tables.publish(snapshot, str(tmp_path / "kv"))
    assert seen and min(seen) >= 2 and spark.conf.get(name, None) == before
    stored = spark.read.parquet(str(tmp_path / "kv"))
    assert sorted((r.key, r.field, r.value, r.kind) for r in stored.collect()) == sorted(
        (k, f, v, k.split(":")[1] + "_stats") for k, f, v in rows)
