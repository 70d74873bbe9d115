"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint takes the majority of each bit over the hashes of its word
shingles.  The 64 bits are cut into segments.  Two fingerprints within ``distance``
bits differ in few bits of at least one segment, so each fingerprint looks up a small
Hamming ball around its own value in the tables of the segments, and every match is
verified on all 64 bits.  Of two neighbours in a segment only the larger one needs to
look for the smaller, which halves the ball.

Equal fingerprints are one node.  Crowded table entries are cut into blocks on both
sides; a block compares its fingerprints in memory and emits a spanning forest of its
links, never all pairs.  Components come from star contraction.

Defined cases: null and empty texts have fingerprint zero and are linked like any
other; fewer words than a shingle make one shingle of the whole sequence; repeated rows
fall into one component; an empty table gives an empty result; only ``doc_id`` and
``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.components import components, find_roots
from winnow.runtime import materialize

WORDS, DISTANCE, SEED, BITS = 4, 4, 42, 64
CROWDED = 64
BLOCK = 1024
FINGERPRINTS = "doc_id long, bits long"
# Shingles of a very long text are hashed in runs of this many.
RUN = 200_000


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit number."""
    import xxhash

    # bytes.lower() changes A-Z only and bytes.split() cuts at ASCII white space only.
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n = max(1, len(parts) - words + 1)
    ends = ends[min(words, len(parts)) - 1:]
    h, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, RUN):
        spans = zip(starts[at:min(n, at + RUN)].tolist(), ends[at:at + RUN].tolist())
        hashes = np.array([h(joined[a:b], SEED) for a, b in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n).view(">u8")[0]
    return int(np.uint64(bits).astype(np.int64))


def _fingerprints(words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            bits = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int64())], names=["doc_id", "bits"])

    return run


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints(words), FINGERPRINTS)


def segment_plan(rows: int, distance: int = DISTANCE) -> list[tuple[int, int, int]]:
    """Segments as ``(first bit, width, radius)``.

    With m segments, ``distance = m * a + b``: b + 1 of them are searched to radius a and
    the others to a - 1, which no pair within the distance escapes.  Segments are about as
    wide as the number of fingerprints has bits, so that table entries stay short however
    many there are; the links found are the same for every m.
    """
    m = max(1, min(distance + 1, round(BITS / max(1.0, math.log2(max(2, rows))))))
    a, b = divmod(distance, m)
    plan, first = [], 0
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        plan.append((first, width, a if i <= b else a - 1))
        first += width
    return [s for s in plan if s[2] >= 0]


def ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` bits among ``width``."""
    return [sum(1 << i for i in flips) for r in range(radius + 1) for flips in combinations(range(width), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _lookups(nodes: DataFrame, plan: list[tuple[int, int, int]]) -> tuple[DataFrame, DataFrame]:
    """Table rows and probes ``(segment, entry, bits, id)``."""
    tables, probes = [], []
    for i, (first, width, radius) in enumerate(plan):
        value = F.shiftrightunsigned("bits", first).bitwiseAND(F.lit(_signed((1 << width) - 1)))
        own = nodes.select(F.lit(i).alias("segment"), value.alias("entry"), "bits", "id")
        tables.append(own)
        masks = F.array(*[F.lit(m).cast("long") for m in ball(width, radius)])
        looked = own.withColumn("mask", F.explode(masks)).withColumn("near", F.col("entry").bitwiseXOR(F.col("mask")))
        # width < 64 except with a single segment, where the sign bit only turns the order round
        probes.append(looked.where("near <= entry").select("segment", F.col("near").alias("entry"), "bits", "id"))
    table, probe = tables[0], probes[0]
    for t, p in zip(tables[1:], probes[1:]):
        table, probe = table.unionByName(t), probe.unionByName(p)
    return table, probe


def block_links(table: np.ndarray, probe: np.ndarray, table_ids: np.ndarray, probe_ids: np.ndarray,
                distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two blocks."""
    table, probe = table.view(np.uint64), probe.view(np.uint64)  # bit counts of signed numbers drop the sign
    us, vs = [], []
    for at in range(0, len(probe), 256):
        near = np.bitwise_count(probe[at:at + 256, None] ^ table[None, :]) <= distance
        p, t = np.nonzero(near)
        us.append(probe_ids[at:at + 256][p])
        vs.append(table_ids[t])
    u, v = np.concatenate(us), np.concatenate(vs)
    keep = u != v
    nodes, roots = find_roots(u[keep], v[keep])
    own = nodes != roots
    return nodes[own], roots[own]


def _crowded_links(distance: int):
    def run(rows):
        import pandas as pd

        table, probe = rows[rows.role == 0], rows[rows.role == 1]
        if not len(table) or not len(probe):
            return pd.DataFrame({"u": np.array([], np.int64), "v": np.array([], np.int64)})
        u, v = block_links(table.bits.to_numpy(), probe.bits.to_numpy(), table.id.to_numpy(), probe.id.to_numpy(), distance)
        return pd.DataFrame({"u": u, "v": v})

    return run


def links(nodes: DataFrame, distance: int = DISTANCE, plan: list[tuple[int, int, int]] | None = None,
          crowded: int = CROWDED, block: int = BLOCK) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of all links within ``distance``.

    ``nodes`` is a stored table ``(bits, id)`` of distinct fingerprints.
    """
    plan = plan or segment_plan(nodes.count(), distance)
    table, probe = _lookups(nodes, plan)
    hot = materialize(table.groupBy("segment", "entry").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded)
                      .select("segment", "entry", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "crowded")
    left = table.join(hot, ["segment", "entry"], "left_anti").withColumnRenamed("bits", "t_bits").withColumnRenamed("id", "t_id")
    far = F.bit_count(F.col("bits").bitwiseXOR(F.col("t_bits")))
    plain = left.join(probe, ["segment", "entry"]).where((F.col("id") != F.col("t_id")) & (far <= distance)).select(
        F.col("id").alias("u"), F.col("t_id").alias("v"))
    own = F.pmod(F.xxhash64("bits"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = table.join(hot, ["segment", "entry"]).select(
        "segment", "entry", own.alias("i"), every.alias("j"), F.lit(0).alias("role"), "bits", "id").unionByName(
        probe.join(hot, ["segment", "entry"]).select(
            "segment", "entry", every.alias("i"), own.alias("j"), F.lit(1).alias("role"), "bits", "id"))
    blocks = cells.groupBy("segment", "entry", "i", "j").applyInPandas(_crowded_links(distance), "u long, v long")
    # Stored, so that no stage runs two Python steps, and with them twice the workers.
    return materialize(plain.unionByName(blocks), "links")


def near_groups(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    prints = materialize(fingerprints(docs, words), "prints")
    nodes = materialize(prints.groupBy("bits").agg(F.min("doc_id").alias("id")), "nodes")
    # A node without a doc_id cannot name a component; it takes its fingerprint for that.
    roots = components(links(nodes.where("id is not null"), distance))
    named = materialize(nodes.join(roots, F.col("id") == F.col("node"), "left")
                        .select("bits", F.coalesce("root", "id").alias("component_id")), "named")
    return prints.join(named, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row of each component; columns as in ``docs``.

    Rows are told apart by ``doc_id`` and a hash of their text, so a row whose text has
    no near copy stays even if another row with the same doc_id is a near copy of
    something.  A component keeps a row whose doc_id is the component's id, the one with
    the smallest fingerprint, then text hash; of identical rows (same doc_id and text)
    the smallest by its other columns stays, so reruns agree.  Rows without a doc_id stay.
    """
    text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    keyed = docs.withColumn("__text_key", text_key)
    rows = materialize(keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "__text_key")
                       .mapInArrow(_keyed_fingerprints(words), "doc_id long, bits long, text_key long")
                       .dropDuplicates(["doc_id", "bits", "text_key"]), "keyed_prints")
    nodes = materialize(rows.groupBy("bits").agg(F.min("doc_id").alias("id")), "nodes")
    roots = components(links(nodes.where("id is not null"), distance))
    named = nodes.join(roots, F.col("id") == F.col("node"), "left").select("bits", F.coalesce("root", "id").alias("component_id"))
    grouped = rows.join(named, "bits")
    keepers = materialize(grouped.where(F.col("doc_id") == F.col("component_id")).groupBy("component_id").agg(
        F.min(F.struct("bits", "text_key")).alias("k")).select(
        F.col("component_id").alias("doc_id"), F.col("k.text_key").alias("__text_key")), "keepers")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # Identical rows collapse before the join, so a row repeated a third of the time is one row here.
    one_each = keyed.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "__text_key").agg(
        F.min(F.struct(F.col("text"), *[F.col(f"`{c}`") for c in others])).alias("__r"))
    kept = one_each.join(keepers, ["doc_id", "__text_key"], "left_semi").select(
        "doc_id", *[F.col("__r").getField(c).alias(c) for c in ["text", *others]])
    loose = keyed.where(F.col("doc_id").isNull()).drop("__text_key")
    return kept.unionByName(loose).select(*[F.col(f"`{c}`") for c in docs.columns])


def _keyed_fingerprints(words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            bits = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int64()), batch.column(2)],
                                             names=["doc_id", "bits", "text_key"])

    return run
