"""Drift monitoring over a stream of ``(ts, feature, value)`` rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from winnow.functions import drift as d
from winnow.functions.binning import histogram_bin
from winnow.operators.drift import BINS, drift_report, drift_summary, moments
from winnow.operators.ranks import top_k

LOG = T.StructType([
    T.StructField("ts", T.TimestampType()), T.StructField("feature", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def read_feature_log(spark: SparkSession, path: str, schema: T.StructType = LOG,
                     files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def online_stats(log: DataFrame) -> DataFrame:
    """Moments per feature over everything seen so far (complete mode)."""
    return moments(log)


def windowed_stats(log: DataFrame, width: str = "1 hour", watermark: str | None = "1 hour",
                   ts: str = "ts") -> DataFrame:
    """Moments per feature and tumbling window; works on streams and tables.

    The watermark bounds the state of a stream: a window older than it is
    closed and its later rows are dropped.
    """
    if log.isStreaming and watermark:
        log = log.withWatermark(ts, watermark)
    windowed = log.withColumn("w", F.window(ts, width)).withColumn("window_start", F.col("w.start"))
    keys = ["w", "feature"] if log.isStreaming else ["window_start", "feature"]
    stats = moments(windowed, keys)
    return stats.withColumn("window_start", F.col("w.start")).drop("w") if log.isStreaming else stats


def windowed_state(log: DataFrame, edges: DataFrame, width: str = "1 hour", watermark: str | None = "1 hour",
                   ts: str = "ts") -> DataFrame:
    """Moments and counts over the baseline's bins per feature and tumbling window; streams and tables.

    ``edges`` is the stored baseline's ``histogram_edges`` (one row per feature, at most
    ``BINS + 1`` edges), static and small, so it is broadcast.  A window's histogram is a
    fixed set of counts ``bin0 ..``, kept in the stream's state beside the moments and
    merged like them; every updated row carries the whole histogram of its window.
    Features without edges are left out; values outside the edges count into the end bins.
    """
    if log.isStreaming and watermark:
        log = log.withWatermark(ts, watermark)
    binned = log.where(F.col("value").isNotNull() & ~F.isnan("value")).join(
        F.broadcast(edges.select("feature", "edges")), "feature")
    binned = binned.withColumn("__bin", histogram_bin(F.col("value"), F.col("edges")))
    counts = [F.count(F.when(F.col("__bin") == i, 1)).alias(f"bin{i}") for i in range(BINS)]
    windowed = binned.withColumn("w", F.window(ts, width)).withColumn("window_start", F.col("w.start"))
    keys = ["w", "feature"] if log.isStreaming else ["window_start", "feature"]
    state = moments(windowed, keys, extra=counts)
    return state.withColumn("window_start", F.col("w.start")).drop("w") if log.isStreaming else state


def windowed_psi(state: DataFrame, base_histogram: DataFrame) -> DataFrame:
    """PSI per window and feature from a window's bin counts and the baseline's bin shares.

    ``base_histogram`` is ``drift.histogram`` of the baseline over the same edges; it has a
    row per feature and bin and is broadcast.  Empty bins count as ``FLOOR`` on either side.
    """
    base = base_histogram.groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bin", "share"))), lambda x: x["share"]).alias("__base"))
    counts = F.slice(F.array(*[F.col(f"bin{i}") for i in range(BINS)]), 1, F.size("__base"))
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda t, x: t + x)
    shares = F.transform(counts, lambda c: F.try_divide(c.cast("double"), total))
    terms = F.zip_with("__base", shares, lambda b, o: d.psi_term(b, F.coalesce(o, F.lit(0.0))))
    return state.join(F.broadcast(base), "feature").select(
        "window_start", "feature", F.aggregate(terms, F.lit(0.0), lambda t, x: t + x).alias("psi"))


def windowed_psi_drift(state: DataFrame, baseline: DataFrame, base_histogram: DataFrame) -> DataFrame:
    """Drift report per window with PSI beside z-score and KL, from one windowed state."""
    return drift_report(baseline, state, windowed_psi(state, base_histogram), keys=["window_start"])


def windowed_drift(stats: DataFrame, baseline: DataFrame) -> DataFrame:
    """Drift report per window: windowed moments against the stored baseline."""
    return drift_report(baseline, stats, keys=["window_start"])


def windowed_summary(report: DataFrame) -> DataFrame:
    return drift_summary(report, ["window_start"])


def start_upsert_sink(stream: DataFrame, path: str, checkpoint: str, mode: str = "update",
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      trigger: dict | None = None) -> StreamingQuery:
    """Writes each micro-batch of changed rows to its own folder.

    A repeated batch after a failure overwrites its own folder, so the table
    never holds a batch twice.  ``transform`` runs on each batch, for example
    the join with a static baseline.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()
    )


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key of an upsert sink."""
    rows = spark.read.parquet(path)
    return top_k(rows, keys, [F.desc("batch_id")], 1).drop("rank", "batch_id")
