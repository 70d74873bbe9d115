"""Exact deduplication with a cuckoo-filter index.

Every text gets a content key: SHA-256, a 64-bit hash and the length of its normalised
form.  The index is split into shards by digest.  A shard holds a cuckoo filter of
16-bit marks and, beside it, the full keys it stands for.  A key that misses the filter
is new and inserted; a hit is verified against the stored keys.  When an insertion
finds no place the filter is rebuilt twice as large from those keys.  Keys count their
documents, so deleting the last one takes the mark out of the filter again.

Rows are combined within each batch before the shuffle, so a text that a third of all
rows share reaches its shard as one row per batch.

Defined cases: null counts as the empty text, all empty texts are equal; of equal texts
the one with most code points stays, then the smallest doc_id, a null doc_id after every
other (it stays only alone at the most code points; its group's ``keep_id`` is null then); ``kept``
is null for a row with a null doc_id; rows that repeat a
doc_id and its text share their decision; an empty table gives an empty result; only
``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.runtime import materialize

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def _order(chars: int, doc_id: int | None) -> tuple:
    """Which of equal texts stays: most code points, then the smallest id, a null id last."""
    return (-chars, doc_id is None, doc_id or 0)
SHARD_ROWS = 250_000

KEYS = "doc_id long, digest binary, check long, bytes int, chars int"
LIVE = "shard int, digest binary, check long, bytes int, chars int, keep_id long, group_size long"


class CuckooFilter:
    """Sets of 64-bit hashes: four 16-bit marks per bucket, two buckets per hash."""

    SLOTS, KICKS = 4, 200

    def __init__(self, capacity: int) -> None:
        buckets = 1 << max(4, (max(1, int(capacity / (self.SLOTS * 0.9))) - 1).bit_length())
        self.mask = buckets - 1
        self.marks = np.zeros((buckets, self.SLOTS), np.uint16).tolist()
        self.turn = 0

    def _places(self, h: int) -> tuple[int, int, int]:
        mark = (h >> 48) or 1
        first = h & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self.mask)

    def __contains__(self, h: int) -> bool:
        mark, a, b = self._places(h)
        return mark in self.marks[a] or mark in self.marks[b]

    def insert(self, h: int) -> bool:
        """False if there is no place; the filter is then to be rebuilt from its keys."""
        mark, a, b = self._places(h)
        for bucket in (a, b):
            row = self.marks[bucket]
            if 0 in row:
                row[row.index(0)] = mark
                return True
        bucket = b
        for _ in range(self.KICKS):
            self.turn = (self.turn + 1) % self.SLOTS
            row = self.marks[bucket]
            mark, row[self.turn] = row[self.turn], mark
            bucket = self._other(bucket, mark)
            row = self.marks[bucket]
            if 0 in row:
                row[row.index(0)] = mark
                return True
        return False

    def delete(self, h: int) -> bool:
        mark, a, b = self._places(h)
        for bucket in (a, b):
            row = self.marks[bucket]
            if mark in row:
                row[row.index(mark)] = 0
                return True
        return False


class Shard:
    """One shard: the filter and the keys it stands for."""

    def __init__(self, capacity: int = 1024) -> None:
        self.capacity = capacity
        self.filter = CuckooFilter(capacity)
        self.keys: dict[tuple, list] = {}  # content -> [chars, keep_id, documents]

    @staticmethod
    def _hash(content: tuple) -> int:
        return int.from_bytes(content[0][8:16], "little")

    def add(self, content: tuple, chars: int, doc_id: int, documents: int = 1) -> None:
        h = self._hash(content)
        if h in self.filter:
            entry = self.keys.get(content)  # a hit may be false: the stored key decides
            if entry is not None:
                if _order(chars, doc_id) < _order(entry[0], entry[1]):
                    entry[0], entry[1] = chars, doc_id
                entry[2] += documents
                return
        self.keys[content] = [chars, doc_id, documents]
        if not self.filter.insert(h):
            self._grow()

    def remove(self, content: tuple, documents: int = 1) -> bool:
        """Takes documents away; False if the content is not live."""
        h = self._hash(content)
        entry = self.keys.get(content) if h in self.filter else None
        if entry is None:
            return False
        entry[2] -= documents
        if entry[2] <= 0:
            del self.keys[content]
            self.filter.delete(h)
        return True

    def _grow(self) -> None:
        while True:
            self.capacity *= 2
            self.filter = CuckooFilter(self.capacity)
            if all(self.filter.insert(self._hash(k)) for k in self.keys):
                return


def content_keys(docs: DataFrame) -> DataFrame:
    """``KEYS`` of every row, from the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.translate(text, WHITE, "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain.alias("plain"),
                       F.length(text).alias("chars")).select(
        "doc_id", F.unhex(F.sha2("plain", 256)).alias("digest"), F.xxhash64("plain").alias("check"),
        F.octet_length("plain").alias("bytes"), "chars")


def _combine(batches: Iterator) -> Iterator:
    """One row per content and batch: the best copy and the number of copies."""
    import pyarrow as pa

    for batch in batches:
        best: dict[tuple, list] = {}
        for doc_id, digest, check, size, chars, shard in zip(*(c.to_pylist() for c in batch.columns)):
            content = (digest, check, size)
            entry = best.get(content)
            if entry is None:
                best[content] = [chars, doc_id, 1, shard]
                continue
            if _order(chars, doc_id) < _order(entry[0], entry[1]):
                entry[0], entry[1] = chars, doc_id
            entry[2] += 1
        rows = [(e[3], *k, *e[:3]) for k, e in best.items()]
        yield _live_batch(rows, pa)


def _live_batch(rows: list, pa) -> object:
    types = [pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    names = ["shard", "digest", "check", "bytes", "chars", "keep_id", "group_size"]
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _build(batches: Iterator) -> Iterator:
    """Adds rows to the shards of this partition, then emits the live keys."""
    import pyarrow as pa

    shards: dict[int, Shard] = {}
    for batch in batches:
        for shard, digest, check, size, chars, keep_id, n in zip(*(c.to_pylist() for c in batch.columns)):
            if shard not in shards:
                shards[shard] = Shard()
            shards[shard].add((digest, check, size), chars, keep_id, n)
    for shard, held in shards.items():
        rows = [(shard, *k, *e) for k, e in held.keys.items()]
        for start in range(0, len(rows), 10_000):
            yield _live_batch(rows[start:start + 10_000], pa)


def with_shard(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def build_index(keys: DataFrame, shards: int) -> DataFrame:
    """The live keys of the index, each with the document that stays and its copies."""
    rows = with_shard(keys.select("doc_id", "digest", "check", "bytes", "chars"), shards).mapInArrow(_combine, LIVE)
    return rows.repartition(shards, "shard").mapInArrow(_build, LIVE)


def change_index(index: DataFrame, inserts: DataFrame, deletes: DataFrame, shards: int) -> DataFrame:
    """The index after inserting and deleting documents given by their content keys.

    Deletions only say how many documents of a content go; when none is left, the key
    and its mark go too.  While some are left, ``keep_id`` stays as it was.
    """
    def combined(keys: DataFrame) -> DataFrame:
        return with_shard(keys.select("doc_id", "digest", "check", "bytes", "chars"), shards).mapInArrow(_combine, LIVE)

    gone = combined(deletes).withColumn("group_size", -F.col("group_size"))
    rows = index.select("*", F.lit(0).alias("step")).unionByName(combined(inserts).select("*", F.lit(1).alias("step")))
    rows = rows.unionByName(gone.select("*", F.lit(2).alias("step")))
    return rows.repartition(shards, "shard").sortWithinPartitions("shard", "step").mapInArrow(_change, LIVE)


def _change(batches: Iterator) -> Iterator:
    import pyarrow as pa

    shards: dict[int, Shard] = {}
    for batch in batches:
        for shard, digest, check, size, chars, keep_id, n, _ in zip(*(c.to_pylist() for c in batch.columns)):
            held = shards.setdefault(shard, Shard())
            if n > 0:
                held.add((digest, check, size), chars, keep_id, n)
            else:
                held.remove((digest, check, size), -n)
    for shard, held in shards.items():
        rows = [(shard, *k, *e) for k, e in held.keys.items()]
        for start in range(0, len(rows), 10_000):
            yield _live_batch(rows[start:start + 10_000], pa)


def shard_count(rows: int, least: int) -> int:
    """Shards of at most about ``SHARD_ROWS`` keys."""
    return max(least, -(-rows // SHARD_ROWS))


def exact_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    spark = docs.sparkSession
    keys = materialize(content_keys(docs), "keys")
    shards = shard_count(keys.count(), spark.sparkContext.defaultParallelism)
    # Stored, so that the join below shuffles both sides and a hot digest can be split.
    groups = materialize(build_index(keys, shards).where("group_size > 1")
                         .select("digest", "keep_id", "group_size"), "groups")
    joined = keys.select("doc_id", "digest").join(groups, "digest", "left")
    # A row without copies keeps itself; a group's keeper may be a row with a null id.
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("doc_id").isNotNull(), keep.eqNullSafe(F.col("doc_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
