from __future__ import annotations

import datetime as dt
import math
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.operators import drift
from winnow.streaming import drift_stream


def log_rows(seed=3, days=4, per_day=300):
    rng = np.random.default_rng(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for day in range(days):
        for i in range(per_day):
            ts = start + dt.timedelta(days=day, seconds=int(rng.integers(0, 86_400)))
            rows.append((ts, "a", float(rng.normal(day * 0.3, 1.0))))
            if i % 3 == 0:
                rows.append((ts, "b", float(rng.integers(0, 5))))
    rows += [(start, "a", None), (start, "a", float("nan")), (start, "unseen", 1.0)]
    return rows


def brute_psi(base_values, window_values, edges):
    def shares(values):
        bins = np.clip(np.searchsorted(edges, values, side="right") - 1, 0, len(edges) - 2)
        counts = np.bincount(bins, minlength=len(edges) - 1)
        return counts / counts.sum()

    b, o = shares(np.asarray(base_values)), shares(np.asarray(window_values))
    b, o = np.where(b <= 0, 1e-10, b), np.where(o <= 0, 1e-10, o)
    return float(((o - b) * np.log(o / b)).sum())


@pytest.fixture(scope="module")
def sides(spark):
    schema = "ts timestamp, feature string, value double"
    base = spark.createDataFrame([r for r in log_rows(1, 2) if r[1] != "unseen"], schema)
    online = spark.createDataFrame(log_rows(2), schema)
    edges = drift.histogram_edges(base)
    return base, online, edges, drift.histogram(base, edges)


def test_psi_per_window_equals_brute_force(spark, sides):
    base, online, edges, base_hist = sides
    state = drift_stream.windowed_state(online, edges, "1 day")
    got = {(r.window_start, r.feature): r.psi for r in drift_stream.windowed_psi(state, base_hist).collect()}
    stored = {r.feature: r.edges for r in edges.collect()}
    base_rows = base.collect()
    assert {f for _, f in got} == {"a", "b"}  # features without baseline bins are left out
    for (day, feature), psi in got.items():
        values = [r.value for r in online.collect() if r.feature == feature and r.value is not None and not math.isnan(r.value)
                  and r.ts.date() == day.date()]
        base_values = [r.value for r in base_rows if r.feature == feature and r.value is not None and not math.isnan(r.value)]
        assert psi == pytest.approx(brute_psi(base_values, values, np.array(stored[feature])), rel=1e-9)
    report = drift_stream.windowed_psi_drift(state, drift.feature_baseline(base), base_hist)
    assert report.where("psi IS NULL").count() == 0 and report.count() == len(got)


def test_stream_equals_batch(spark, sides):
    base, online, edges, base_hist = sides
    baseline = drift.feature_baseline(base)
    batch = drift_stream.windowed_psi_drift(drift_stream.windowed_state(online, edges, "1 day"), baseline, base_hist)
    folder = tempfile.mkdtemp(prefix="psi-stream-", dir="/tmp")
    # Four files read one per micro-batch: the windows' counts merge in the stream's state.
    online.withColumn("part", F.pmod(F.hash("value"), F.lit(4))).write.partitionBy("part").parquet(f"{folder}/log")
    stream = drift_stream.read_feature_log(spark, f"{folder}/log", files_per_trigger=1)
    sink = drift_stream.start_upsert_sink(
        drift_stream.windowed_state(stream, edges, "1 day", watermark="30 days"), f"{folder}/out", f"{folder}/state",
        "update", lambda b: drift_stream.windowed_psi_drift(b, baseline, base_hist))
    sink.awaitTermination()
    streamed = drift_stream.latest(spark, f"{folder}/out", ["window_start", "feature"])
    cols = ["window_start", "feature", "online_count", "psi", "severity"]
    got = sorted((r.window_start, r.feature, r.online_count, round(r.psi, 9), r.severity) for r in streamed.select(*cols).collect())
    want = sorted((r.window_start, r.feature, r.online_count, round(r.psi, 9), r.severity) for r in batch.select(*cols).collect())
    assert got == want and len(got) == 8
