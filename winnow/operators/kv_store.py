"""Key/value snapshots as bucketed versions with copy-on-write of touched buckets.

A store is a folder.  ``data/v=V/bucket=B`` holds the rows ``(key, field, value)`` of
bucket ``B`` as written by version ``V``; ``manifest/v=V`` is a small table naming, for
every bucket, the version whose folder holds it.  A key's bucket is a hash of the key,
and the number of buckets is fixed when the store is first published (about
``BUCKET_ROWS`` rows each).

* Publishing writes all buckets as version 0.
* An upsert finds the buckets its keys fall into, merges the rows of only those buckets
  with the changes (a change replaces the value of its ``(key, field)``), writes them
  under the next version and then the next manifest, which names the new folders for
  the touched buckets and the old folders for all others.  Untouched buckets are not
  read or written.
* A manifest becomes visible with Spark's ``_SUCCESS`` marker, after its data: readers
  take the newest complete manifest, so they never see half a version.
* Every written bucket gets a Bloom filter of its keys in ``bloom/v=V/bucket=B``: about
  ``BLOOM_BITS`` bits a key in 64-bit words, ``BLOOM_HASHES`` positions a key by double
  hashing, built with Spark's ``bit_or``.  The manifest carries each bucket's filter size.
* A lookup reads the filters of the buckets its keys fall into, keeps the keys whose
  positions are all set and reads the data folders of only their buckets; a key that is
  not stored is (up to the filter's false positives, about 1 %) answered without data.

Old versions stay until ``expire`` removes the folders that no manifest from a given
version on still names.  The bucket list and the manifest have one row per bucket, a
number fixed by the data size, so they may pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.operators.lookup_tables import layered_lookup
from winnow.operators.ranks import top_k

BUCKET_ROWS = 200_000
BLOOM_BITS = 10
BLOOM_HASHES = 7


def bucket_of(key, n_buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def bloom_positions(key, bits):
    """The filter positions of a key in a filter of ``bits`` bits; no sum leaves ``[0, 2 * bits)``."""
    m = bits.cast("long")
    first = F.pmod(F.xxhash64(key), m)
    step = F.lit(1) + F.pmod(F.hash(key).cast("long"), F.greatest(m - 1, F.lit(1)))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(BLOOM_HASHES - 1)),
                                        lambda i: F.pmod(first + F.pmod(i.cast("long") * step, m), m)))


def bit_mask(bit):
    """A long with one bit set; ``F.shiftleft`` takes no column as the number of bits."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def bit_is_set(mask, bit):
    return F.call_function("shiftright", mask, bit).bitwiseAND(F.lit(1)) == 1


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class BucketedStore:
    """A versioned key/value store below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # -- versions ------------------------------------------------------------
    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        fs, p = _fs(self.spark, f"{self.path}/manifest")
        if not fs.exists(p):
            return []
        done = []
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if name.startswith("v=") and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                done.append(int(name[2:]))
        return sorted(done)

    def _manifest_rows(self, version: int | None = None) -> dict[int, tuple[int, int]]:
        """Bucket to the version whose folder holds it and its filter's bits (one row per bucket)."""
        versions = self.versions()
        if not versions:
            return {}
        v = versions[-1] if version is None else version
        rows = self.spark.read.parquet(f"{self.path}/manifest/v={v}").collect()
        return {r.bucket: (r.data, r.bits) for r in rows}

    def manifest(self, version: int | None = None) -> dict[int, int]:
        """Bucket to the version whose folder holds it."""
        return {b: d for b, (d, _) in self._manifest_rows(version).items()}

    def n_buckets(self) -> int:
        fs, p = _fs(self.spark, f"{self.path}/buckets")
        return int(self.spark.read.parquet(f"{self.path}/buckets").first()[0]) if fs.exists(p) else 0

    def _folders(self, manifest: dict[int, int], buckets=None) -> list[str]:
        chosen = manifest if buckets is None else {b: manifest[b] for b in buckets if b in manifest}
        return [f"{self.path}/data/v={v}/bucket={b}" for b, v in sorted(chosen.items())]

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], "key string, field string, value double")
        return self.spark.read.schema("key string, field string, value double").parquet(*folders)

    def _write(self, rows: DataFrame, version: int, manifest: dict[int, tuple[int, int]]) -> None:
        """Data and filters of the touched buckets, then the manifest that names them."""
        data = f"{self.path}/data/v={version}"
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
        # The filters are built from what was written, so the merge is not computed twice.
        keys = self.spark.read.parquet(data).select("bucket", "key").distinct()
        sizes = {r.bucket: max(64, -(-BLOOM_BITS * r.n // 64) * 64)
                 for r in keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most n buckets
        bits = self.spark.createDataFrame(sorted(sizes.items()), "bucket int, bits long")
        at = keys.join(F.broadcast(bits), "bucket").select(  # one row per touched bucket
            "bucket", F.explode(bloom_positions(F.col("key"), F.col("bits"))).alias("pos"))
        words = at.groupBy("bucket", F.floor(F.col("pos") / 64).alias("word")).agg(
            F.bit_or(bit_mask(F.pmod(F.col("pos"), F.lit(64)).cast("int"))).alias("mask"))
        (words.withColumn("b", F.col("bucket")).repartition("bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.path}/bloom/v={version}"))
        # Buckets left empty by a write keep a filter of one word, so every manifest row names a filter.
        entries = {b: (d, m) for b, (d, m) in manifest.items()} | {b: (version, m) for b, m in sizes.items()}
        self.spark.createDataFrame(sorted((b, d, m) for b, (d, m) in entries.items()), "bucket int, data int, bits long").coalesce(
            1).write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}")

    # -- operations ----------------------------------------------------------
    def publish(self, snapshot: DataFrame, n_buckets: int | None = None) -> int:
        """Writes a whole snapshot as version 0 (or as the next version of an existing store)."""
        rows = snapshot.select("key", "field", F.col("value").cast("double"))
        if not self.n_buckets():
            n = n_buckets or max(1, -(-rows.count() // BUCKET_ROWS))
            self.spark.createDataFrame([(n,)], "n int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/buckets")
        n = self.n_buckets()
        version = (self.versions() or [-1])[-1] + 1
        keyed = rows.withColumn("bucket", bucket_of(F.col("key"), n))
        self._write(keyed, version, {})
        return version

    def upsert(self, changes: DataFrame) -> int:
        """Applies changes by rewriting only the buckets they touch; returns the new version."""
        n, entries = self.n_buckets(), self._manifest_rows()
        manifest = {b: d for b, (d, _) in entries.items()}
        version = (self.versions() or [-1])[-1] + 1
        new = changes.select("key", "field", F.col("value").cast("double"), F.lit(1).alias("__newer"))
        new = new.withColumn("bucket", bucket_of(F.col("key"), n))
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # at most n rows
        old = self._read(self._folders(manifest, touched)).withColumn("__newer", F.lit(0))
        old = old.withColumn("bucket", bucket_of(F.col("key"), n))
        merged = top_k(old.unionByName(new), ["key", "field"], [F.desc("__newer")], 1, "__rank").drop("__rank", "__newer")
        self._write(merged, version, {b: e for b, e in entries.items() if b not in touched})
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version (the newest by default)."""
        return self._read(self._folders(self.manifest(version)))

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows of the requested keys, read from the buckets whose filters may hold them.

        ``last_blooms`` and ``last_folders`` name the filter and data folders read.
        """
        entries, n = self._manifest_rows(version), self.n_buckets()
        wanted = keys.select("key").distinct().withColumn("bucket", bucket_of(F.col("key"), n))
        buckets = [r.bucket for r in wanted.select("bucket").distinct().collect() if r.bucket in entries]  # at most n
        self.last_blooms = [f"{self.path}/bloom/v={entries[b][0]}/bucket={b}" for b in sorted(buckets)]
        if not buckets:
            self.last_folders = []
            return self._read([])
        bits = self.spark.createDataFrame([(b, entries[b][1]) for b in buckets], "bucket int, bits long")
        probes = wanted.join(F.broadcast(bits), "bucket").select(  # one row per requested bucket
            "key", "bucket", F.explode(bloom_positions(F.col("key"), F.col("bits"))).alias("pos"))
        probes = probes.select("key", "bucket", F.floor(F.col("pos") / 64).alias("word"),
                               F.pmod(F.col("pos"), F.lit(64)).cast("int").alias("bit"))
        words = self.spark.read.schema("word long, mask long, b int").parquet(*self.last_blooms)
        hit = probes.join(words, (probes.bucket == words.b) & (probes.word == words.word), "left").select(
            "key", "bucket", F.coalesce(bit_is_set(F.col("mask"), F.col("bit")), F.lit(False)).alias("set"))
        maybe = hit.groupBy("key", "bucket").agg(F.bool_and("set").alias("maybe")).where("maybe")
        from winnow.runtime import materialize

        maybe = materialize(maybe.select("key", "bucket"), "bloom_hits")
        chosen = [r.bucket for r in maybe.select("bucket").distinct().collect()]  # at most n
        self.last_folders = self._folders({b: d for b, (d, _) in entries.items()}, chosen)
        return self._read(self.last_folders).join(maybe.select("key"), "key", "left_semi")

    def layered_lookup(self, requests: DataFrame, id_column: str, entity: str, group: str, fields: list[str],
                       fallback, version: int | None = None) -> DataFrame:
        """Features of the requested ids from keys ``features:<entity>:<id>:<group>``, else the defaults.

        Columns as :func:`lookup_tables.layered_lookup` gives them: the request's columns, one
        double per field (null where a stored key lacks the field) and ``source``.
        """
        key = F.format_string(f"features:{entity}:%s:{group}", F.col(id_column).cast("string"))
        found = self.lookup(requests.select(key.alias("key")), version)
        wide = found.groupBy("key").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
        answered = layered_lookup(requests.withColumn("__key", key), wide.withColumnRenamed("key", "__key"), "__key", fallback)
        return answered.drop("__key")

    def expire(self, keep_from: int) -> None:
        """Deletes data folders and manifests that no version from ``keep_from`` on names."""
        needed = set()
        for v in self.versions():
            if v >= keep_from:
                needed |= {(d, b) for b, d in self.manifest(v).items()}
        fs, _ = _fs(self.spark, self.path)
        for v in self.versions():
            if v < keep_from:
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/v={v}"), True)
                for b in self.manifest_buckets(v):
                    if (v, b) not in needed:
                        for kind in ("data", "bloom"):
                            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/v={v}/bucket={b}"), True)

    def manifest_buckets(self, version: int) -> list[int]:
        fs, p = _fs(self.spark, f"{self.path}/data/v={version}")
        if not fs.exists(p):
            return []
        return [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith("bucket=")]
