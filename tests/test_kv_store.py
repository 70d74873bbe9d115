from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from winnow.operators.kv_store import BucketedStore, bit_is_set, bit_mask, bucket_of


def snapshot(spark, n=5_000, shift=0.0):
    rows = [(f"features:user:{i}:stats", field, float(i) + shift + j) for i in range(n) for j, field in enumerate(("a", "b"))]
    return spark.createDataFrame(rows, "key string, field string, value double")


def folders(path, version):
    where = f"{path}/data/v={version}"
    return sorted(int(d.split("=")[1]) for d in os.listdir(where) if d.startswith("bucket=")) if os.path.isdir(where) else []


def test_upsert_rewrites_only_touched_buckets(spark):
    path = tempfile.mkdtemp(prefix="kv-", dir="/tmp")
    store = BucketedStore(spark, path)
    base = snapshot(spark)
    assert store.publish(base, n_buckets=64) == 0 and len(folders(path, 0)) == 64
    # One entity's groups: one bucket.
    one = spark.createDataFrame([("features:user:7:stats", "a", -1.0), ("features:user:7:stats", "c", 5.0)], "key string, field string, value double")
    assert store.upsert(one) == 1 and len(folders(path, 1)) == 1
    # One per cent of the keys: exactly their buckets.
    changes = snapshot(spark, 5_000, shift=0.5).where(F.pmod(F.xxhash64("key"), F.lit(100)) == 3)
    touched = sorted(r[0] for r in changes.select(bucket_of(F.col("key"), 64)).distinct().collect())
    assert store.upsert(changes) == 2 and folders(path, 2) == touched and len(touched) < 64
    manifest = store.manifest()
    assert {b for b, v in manifest.items() if v == 2} == set(touched) and len(manifest) == 64
    # Contents equal the newest value per (key, field).
    want = {(r.key, r.field): r.value for r in base.collect()}
    want |= {(r.key, r.field): r.value for r in one.collect()}
    want |= {(r.key, r.field): r.value for r in changes.collect()}
    got = {(r.key, r.field): r.value for r in store.read().collect()}
    assert got == want
    # Older versions stay readable until they expire.
    assert store.read(0).count() == base.count()


def test_half_written_version_is_not_seen(spark):
    path = tempfile.mkdtemp(prefix="kv-", dir="/tmp")
    store = BucketedStore(spark, path)
    store.publish(snapshot(spark, 200), n_buckets=8)
    # Data of version 1 without its manifest, as after a failure between the two writes.
    snapshot(spark, 200, shift=9.0).withColumn("bucket", bucket_of(F.col("key"), 8)).write.partitionBy("bucket").parquet(f"{path}/data/v=1")
    assert store.versions() == [0] and store.read().agg(F.max("value")).first()[0] == 200.0
    assert store.upsert(snapshot(spark, 1, shift=100.0)) == 1  # the next upsert takes the number and overwrites
    assert store.read().where("key = 'features:user:0:stats' AND field = 'a'").first().value == 100.0


def test_lookup_reads_only_the_buckets_of_its_keys(spark):
    path = tempfile.mkdtemp(prefix="kv-", dir="/tmp")
    store = BucketedStore(spark, path)
    store.publish(snapshot(spark), n_buckets=64)
    wanted = spark.createDataFrame([(f"features:user:{i}:stats",) for i in (1, 2, 3, 99_999)], "key string")
    got = sorted((r.key, r.field, r.value) for r in store.lookup(wanted).collect())
    assert len(store.last_folders) <= 4
    assert got == sorted((f"features:user:{i}:stats", f, float(i) + j) for i in (1, 2, 3) for j, f in enumerate("ab"))


def test_expire_keeps_what_newer_versions_name(spark):
    path = tempfile.mkdtemp(prefix="kv-", dir="/tmp")
    store = BucketedStore(spark, path)
    store.publish(snapshot(spark, 300), n_buckets=16)
    store.upsert(snapshot(spark, 1, shift=3.0))
    before = {(r.key, r.field): r.value for r in store.read().collect()}
    store.expire(1)
    assert store.versions() == [1] and len(folders(path, 0)) == 15
    assert {(r.key, r.field): r.value for r in store.read().collect()} == before


def test_filter_words_set_and_test_every_bit(spark):
    bits = spark.range(64).select(F.col("id").cast("int").alias("bit"))
    word = bits.where("bit in (0, 5, 63)").agg(F.bit_or(bit_mask(F.col("bit"))).alias("mask"))
    found = bits.join(F.broadcast(word)).where(bit_is_set(F.col("mask"), F.col("bit")))  # one row
    assert sorted(r.bit for r in found.collect()) == [0, 5, 63]
