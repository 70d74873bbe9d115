"""A stream's newest row per key as versioned snapshots with compaction.

Every micro-batch is written to a folder of its own (``batches/batch_id=N``); a batch
that runs again after a failure overwrites its folder.  Every ``compact_every``
batches the newest row per key of the last version and the batches since is written
as a new version (``versions/through=N``), and then a one-row manifest
(``manifest/through=N``) names it.  The manifest is complete only once Spark has
written its ``_SUCCESS`` marker, so a reader sees the old state or the new one, never
half of one.  After the switch the batches and versions the manifest no longer needs
are deleted; the version before stays for readers that started on it.  The sink thus
holds at most ``compact_every`` batches and two versions whatever the stream's length.

Readers take the newest complete manifest, its version and the batches after it.  The
sink works in update mode (states that change) and in append mode (windows closed by the
watermark, each written once).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winnow.operators.ranks import top_k

BATCH = "__batch"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbered(spark: SparkSession, folder: str, prefix: str, complete: bool = False) -> list[int]:
    """Numbers of the sub-folders ``prefix=N`` of a folder; with ``complete``, those with ``_SUCCESS``."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):  # a bounded number: see the module's note
        name = status.getPath().getName()
        if name.startswith(prefix + "="):
            if complete and not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                continue
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_view(spark: SparkSession, path: str, keys: Sequence[str], upto: int | None = None) -> DataFrame | None:
    """Newest row per key: the current version and the batches after it (up to ``upto``); None if empty."""
    manifests = _numbered(spark, f"{path}/manifest", "through", complete=True)
    through = manifests[-1] if manifests else -1
    parts = [f"{path}/versions/through={through}"] if manifests else []
    parts += [f"{path}/batches/batch_id={b}" for b in _numbered(spark, f"{path}/batches", "batch_id", complete=True)
              if b > through and (upto is None or b <= upto)]
    if not parts:
        return None
    rows = spark.read.parquet(*parts)
    return top_k(rows, list(keys), [F.desc(BATCH)], 1, "__rank").drop("__rank")


def read(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """The sink's rows without its batch numbers."""
    view = read_view(spark, path, keys)
    return None if view is None else view.drop(BATCH)


class VersionedSink:
    """Writes a stream's micro-batches below ``path`` and compacts them every ``compact_every`` batches."""

    def __init__(self, path: str, keys: Sequence[str], compact_every: int = 10,
                 transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
        self.path, self.keys, self.every, self.transform = path.rstrip("/"), list(keys), compact_every, transform

    def write(self, batch: DataFrame, batch_id: int) -> None:
        out = self.transform(batch) if self.transform else batch
        out.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{self.path}/batches/batch_id={batch_id}")
        if (batch_id + 1) % self.every == 0:
            self.compact(batch.sparkSession, batch_id)

    def compact(self, spark: SparkSession, through: int) -> None:
        """New version through batch ``through``, manifest switch, then removal of what is no longer named."""
        before = _numbered(spark, f"{self.path}/manifest", "through", complete=True)
        view = read_view(spark, self.path, self.keys, upto=through)
        if view is None:
            return
        view.write.mode("overwrite").parquet(f"{self.path}/versions/through={through}")
        spark.createDataFrame([(through,)], "through long").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest/through={through}")
        keep_version = before[-1] if before and before[-1] < through else None
        for b in _numbered(spark, f"{self.path}/batches", "batch_id"):
            if b <= through:
                _delete(spark, f"{self.path}/batches/batch_id={b}")
        for v in _numbered(spark, f"{self.path}/versions", "through"):
            if v < through and v != keep_version:
                _delete(spark, f"{self.path}/versions/through={v}")
        for m in _numbered(spark, f"{self.path}/manifest", "through"):
            if m < through and m != keep_version:
                _delete(spark, f"{self.path}/manifest/through={m}")

    def start(self, stream: DataFrame, checkpoint: str, mode: str = "update", trigger: dict | None = None) -> StreamingQuery:
        return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).foreachBatch(self.write).start())


def count_files(spark: SparkSession, path: str) -> int:
    """Files below a folder, for checks of the bound."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    it, n = fs.listFiles(p, True), 0
    while it.hasNext():
        it.next()
        n += 1
    return n
