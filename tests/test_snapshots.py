from __future__ import annotations

import datetime as dt
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from winnow.streaming import drift_stream, snapshots

START = dt.datetime(2024, 1, 1)


def write_days(folder, days, seed=0):
    """One file per day of a feature log."""
    rng = np.random.default_rng(seed)
    for d in days:
        ts = [START + dt.timedelta(days=d, seconds=int(s)) for s in rng.integers(0, 86_400, 40)]
        table = pa.table({"ts": pa.array(ts, pa.timestamp("us")), "feature": ["a", "b"] * 20,
                          "value": rng.normal(d, 1.0, 40)})
        pq.write_table(table, f"{folder}/day-{d:03d}.parquet")


def rows(df, keys):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*keys, "count", "mean", "max").collect())


def test_fifty_batches_with_a_restart(spark):
    root = tempfile.mkdtemp(prefix="snap-", dir="/tmp")
    src, out, state = f"{root}/log", f"{root}/out", f"{root}/state"
    import os
    os.makedirs(src)
    keys = ["window_start", "feature"]
    sink = snapshots.VersionedSink(out, keys, compact_every=10)

    def run():
        stream = drift_stream.read_feature_log(spark, src, files_per_trigger=1)
        sink.start(drift_stream.windowed_stats(stream, "1 day", watermark="100 days"), state, "update").awaitTermination()

    write_days(src, range(25))
    run()
    files_half = snapshots.count_files(spark, out)
    write_days(src, range(25, 50), seed=1)
    run()  # the same checkpoint: only the new files are read
    got = snapshots.read(spark, out, keys)
    want = drift_stream.windowed_stats(spark.read.parquet(src), "1 day")
    assert rows(got, keys) == rows(want, keys) and got.count() == 100
    # At most `compact_every` batch folders and two versions remain, whatever the length.
    assert len(snapshots._numbered(spark, f"{out}/batches", "batch_id")) < 10
    assert len(snapshots._numbered(spark, f"{out}/versions", "through")) <= 2
    assert snapshots.count_files(spark, out) <= max(files_half, 40)


def test_append_mode_writes_closed_windows_once(spark):
    root = tempfile.mkdtemp(prefix="snap-", dir="/tmp")
    src, out, state = f"{root}/log", f"{root}/out", f"{root}/state"
    import os
    os.makedirs(src)
    write_days(src, range(20))
    keys = ["window_start", "feature"]
    sink = snapshots.VersionedSink(out, keys, compact_every=1000)  # no compaction: every write stays visible
    stream = drift_stream.read_feature_log(spark, src, files_per_trigger=1)
    sink.start(drift_stream.windowed_stats(stream, "1 day", watermark="1 day"), state, "append").awaitTermination()
    written = spark.read.parquet(f"{out}/batches")
    per_key = written.groupBy(*keys).count()
    assert per_key.where("count > 1").count() == 0
    latest = spark.read.parquet(src).agg(F.max("ts")).first()[0]
    closed = drift_stream.windowed_stats(spark.read.parquet(src), "1 day").where(
        F.col("window_start") + F.expr("INTERVAL 1 DAY") <= F.lit(latest) - F.expr("INTERVAL 1 DAY"))
    assert rows(written.drop(snapshots.BATCH, "batch_id"), keys) == rows(closed, keys) and closed.count() > 0
