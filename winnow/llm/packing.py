"""Best-fit packing of token sequences by hierarchical residual merging.

Documents become pieces of at most ``capacity`` tokens.  Every task packs its pieces
best-fit, largest first, and emits the sequences that are nearly full.  The others
become items of the next round: they are dealt anew over fewer tasks, together with
the underfull sequences of other tasks, and packed again.  The tree ends when one task
holds the rest or a round no longer saves sequences; a task never holds more than
about ``task_items`` items.

Defined cases: a null or empty text is the single end token; texts of any length are
cut into full pieces and a last one that may be shorter; repeated rows are packed each;
an empty table gives an empty result; only ``doc_id`` and ``text`` are read, so other
columns may have any name.  Equal lengths are ordered by document and piece, so a
repeated task packs alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.llm.tokens import word_tokens
from winnow.runtime import materialize

CAPACITY = 2048
END_ID = 0
TASK_ITEMS = 200_000
FULL = 0.985
SAVING = 0.002

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
ITEMS = T.StructType([
    T.StructField("task", T.IntegerType()), T.StructField("round", T.IntegerType()), T.StructField("fill", T.IntegerType()),
    T.StructField("done", T.BooleanType()),
    T.StructField("pieces", T.ArrayType(T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType())]))),
])


def _cut(path: str, capacity: int):
    """Task: texts to pieces."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tokens = word_tokens(path)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokens.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_cut(path, capacity), PIECES)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places of items in bins, for items in falling order of size.

    Bins are kept by their free room, with one bit per room that some bin has, so the
    tightest bin that fits is the lowest bit set at or above the size.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    present, bins = 0, []
    for place, size in enumerate(sizes):
        above = present >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            bin_ = rooms[room].pop()
            if not rooms[room]:
                present &= ~(1 << room)
            bins[bin_].append(place)
        else:
            room, bin_ = capacity, len(bins)
            bins.append([place])
        room -= size
        rooms[room].append(bin_)
        present |= 1 << room
    return bins


def _pack(round_: int, capacity: int, full: int, task_items: int):
    """Task: items to bins; those filled to at least ``full`` are done."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                                   ("length", pa.int64()), ("ids_crc32", pa.int64())]))

        def packed(items: list) -> Iterator:
            items.sort(key=lambda x: (-x[0], x[1][0]["doc_id"] is None, x[1][0]["doc_id"] or 0, x[1][0]["piece"]))
            sizes = [x[0] for x in items]
            found = best_fit(sizes, capacity)
            for at in range(0, len(found), 5_000):
                bins = found[at:at + 5_000]
                fills = [sum(sizes[p] for p in b) for b in bins]
                yield pa.RecordBatch.from_arrays([
                    pa.array([task] * len(bins), pa.int32()), pa.array([round_] * len(bins), pa.int32()),
                    pa.array(fills, pa.int32()), pa.array([f >= full for f in fills], pa.bool_()),
                    pa.array([[x for p in b for x in items[p][1]] for b in bins], kind),
                ], names=["task", "round", "fill", "done", "pieces"])

        held: list = []
        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if len(held) >= task_items:
                yield from packed(held)
                held = []
        yield from packed(held)

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, full: float = FULL, fan_in: int = 8,
         task_items: int = TASK_ITEMS, saving: float = SAVING) -> DataFrame:
    """Sequences as rows ``(task, round, fill, done, pieces)`` from stored pieces."""
    one = F.array(F.struct("doc_id", "piece", "start", "length", "ids_crc32"))
    items = cut.select(F.col("length").cast("int").alias("fill"), one.alias("pieces"))
    first, finished, round_, given = F.col("pieces")[0], None, 0, None
    while True:
        work = _pack(round_, capacity, int(full * capacity), task_items)
        packed = materialize(items.select("fill", "pieces").mapInArrow(work, ITEMS), "packed")
        row = packed.agg(
            F.count(F.lit(1)).alias("bins"), F.count_if(~F.col("done")).alias("left"),
            F.count_distinct("task").alias("tasks"), F.coalesce(F.sum(F.size("pieces")), F.lit(0)).alias("pieces"),
        ).first()
        given = row["pieces"] if given is None else given
        few = given - row["bins"] <= saving * given
        if row["tasks"] <= 1 or row["left"] == 0 or few:
            return packed if finished is None else finished.unionByName(packed)
        done = packed.where("done")
        finished = done if finished is None else finished.unionByName(done)
        given, round_ = row["left"], round_ + 1
        tasks = max(1, -(-row["left"] // task_items), row["tasks"] // fan_in)
        items = packed.where("not done").repartition(tasks, F.xxhash64(F.lit(round_), first["doc_id"], first["piece"]))


def _place(batches: Iterator) -> Iterator:
    """One row per piece of a sequence, laid end to end."""
    import pyarrow as pa

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    for batch in batches:
        rows = []
        for sequence, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            offset = 0
            for x in held:
                rows.append((*x.values(), sequence, offset))
                offset += x["length"]
        columns = list(zip(*rows)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def placed(sequences: DataFrame) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    numbered = sequences.select(F.monotonically_increasing_id().alias("sequence_id"), "pieces")
    return numbered.mapInArrow(_place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """``PIECES`` with ``sequence_id`` and ``offset``."""
    cut = materialize(pieces(docs, path, capacity), "pieces")
    return placed(pack(cut, capacity, **options))
