"""Hard negatives for anchors, scored by Four-Russians tables over bit planes.

Scores are integer inner products of quantised vectors (``floor(256 * x)``).  Every
component is shifted by the smallest value of the table so that it is non-negative and
written as ``PLANES`` bits.  For a group of eight dimensions and one bit plane, a
candidate's eight bits form one byte.  An anchor's table holds, for each group, the
sums of its components over all 256 subsets of the group; a candidate's score is then
read from the tables at its plane bytes and the planes are shifted and added:

    score = sum_b 2**b * sum_g T[g, byte(c, b, g)] + offset * sum(anchor)

which is exact in integers.  Anchors meet candidates in blocks: anchor blocks of about
``ANCHOR_BLOCK`` rows are paired with candidate blocks of about ``CANDIDATE_BLOCK`` rows
(fewer where the session would be idle), each pair scored in one task, a strip of
anchors after the other.  A first pass keeps each anchor's best five rows of its label per
block, a window keeps the best five of all blocks; the second pass scores again and
keeps, per anchor and positive, the best three rows of other labels inside the band of
that positive's score, and a window keeps the best three of all blocks.  Blocks are
dealt by a hash of a row number, so repeated ids or a hot label do not crowd a block;
no side is broadcast and nothing is collected.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part; vectors of different lengths are compared with zeros in the
missing places; repeated rows are separate rows (a copy of an anchor can be its
positive), ties go to the smaller ``vec_id``, then the earlier row; an anchor with
fewer rows of its label has fewer positives, a positive with fewer rows in its band
fewer negatives; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.operators.ranks import top_k
from winnow.runtime import materialize

# Fixed values of the contract.
SCALE = 256
ANCHOR_EVERY = 50
RELABEL_EVERY = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
BAND = (50, 95)  # percent of the positive's score
# Block sizes: they bound a task's memory, not the work.  Every block is copied once per
# block of the other side, so what is shuffled, and the number of pairs, falls with them.
ANCHOR_BLOCK = 2_048
CANDIDATE_BLOCK = 65_536
LEAST_BLOCK = 4_096  # candidates of a block that more tasks would not make smaller
PAIR_PARTITIONS = 8_192  # pairs beyond share partitions
STRIP = 64  # anchors scored at once against a block
_CHUNK = 2_048  # candidates scored at once, a size that stays in the cache
GROUP = 8

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(emb: DataFrame) -> DataFrame:
    """Valid rows: ``row`` (a stored row number), ``vec_id``, relabelled ``label``, integer vector ``q``."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(CAST(x AS DOUBLE)) < CAST('Infinity' AS DOUBLE))"
    return emb.where(f"vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {finite}").select(
        F.monotonically_increasing_id().alias("row"), "vec_id",
        F.expr(f"CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END").cast("long").alias("label"),
        F.expr(f"transform(embedding, x -> CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT))").alias("q"),
    )


def _padded(lists, width: int) -> np.ndarray:
    """A list<long> Arrow array as rows of ``width`` values, zeros after each row's end."""
    offsets = lists.offsets.to_numpy().astype(np.int64)  # index the unsliced child values
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)[offsets[0]:offsets[-1]]
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    cols = np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    out[rows, cols] = values
    return out


def plane_bytes(u: np.ndarray, planes: int) -> np.ndarray:
    """Bytes ``(rows, planes, groups)`` of non-negative ``u``: bit t of byte (b, g) is bit b of ``u[8g + t]``."""
    rows, width = u.shape
    bits = (u[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    grouped = bits.reshape(rows, planes, width // GROUP, GROUP)
    return (grouped << np.arange(GROUP)).sum(axis=3).astype(np.uint8)


def subset_tables(anchors: np.ndarray) -> np.ndarray:
    """``(anchors, groups, 256)``: the sum of each group's components over every subset of it."""
    members = ((np.arange(256)[:, None] >> np.arange(GROUP)) & 1).astype(np.int64)
    grouped = anchors.reshape(len(anchors), -1, GROUP)
    return np.einsum("agt,st->ags", grouped, members)


def four_russians(tables: np.ndarray, bytes_: np.ndarray, offset: int, anchor_sums: np.ndarray) -> np.ndarray:
    """Exact scores ``(anchors, candidates)`` from subset tables and candidates' plane bytes."""
    n_a, groups, _ = tables.shape
    planes = bytes_.shape[1]
    largest = int(np.abs(tables).max(axis=2, initial=0).sum(axis=1).max(initial=0)) << planes
    # A candidate's byte picks a row of the anchors' sums, which lie side by side.
    sums = np.ascontiguousarray(tables.transpose(1, 2, 0), np.int32 if largest < 1 << 31 else np.int64)
    out = np.empty((n_a, len(bytes_)), np.int64)
    for at in range(0, len(bytes_), _CHUNK):
        picks = np.ascontiguousarray(bytes_[at: at + _CHUNK].transpose(1, 2, 0), np.intp)
        scores = np.zeros((picks.shape[2], n_a), sums.dtype)
        picked = np.empty_like(scores)
        for b in reversed(range(planes)):
            scores <<= 1
            for g in range(groups):
                scores += np.take(sums[g], picks[b, g], axis=0, out=picked, mode="clip")
        out[:, at: at + _CHUNK] = scores.T
    return out + offset * anchor_sums[:, None]


def _best(order_scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, mask: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` masked entries by score descending, then id, then row."""
    where = np.flatnonzero(mask)
    if len(where) > k:
        cut = np.partition(order_scores[where], len(where) - k)[len(where) - k]
        where = where[order_scores[where] >= cut]
    return where[np.lexsort((rows[where], ids[where], -order_scores[where]))][:k]


def _pair_tasks(width: int, planes: int, offset: int, second: bool):
    """Scores one anchor block against one candidate block per input row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = (["a_row", "row", "vec_id", "score"] if not second else
                 ["a_row", "anchor_id", "p_row", "positive_id", "positive_score", "n_row", "negative_id", "negative_score"])
        for batch in batches:
            for i in range(batch.num_rows):
                a = batch.column("anchors")[i].values
                c = batch.column("candidates")[i].values
                a_row = a.field("row").to_numpy(); a_id = a.field("vec_id").to_numpy(); a_label = a.field("label").to_numpy()
                a_vec = _padded(a.field("q"), width)
                c_row = c.field("row").to_numpy(); c_id = c.field("vec_id").to_numpy(); c_label = c.field("label").to_numpy()
                c_bytes = np.frombuffer(b"".join(c.field("planes").to_pylist()), np.uint8).reshape(len(c_row), planes, width // GROUP)
                out: list[list] = [[] for _ in names]

                def put(at: np.ndarray, scores: np.ndarray, *same) -> None:
                    for column, value in zip(out, same):
                        column.append(np.full(len(at), value, np.int64))
                    for column, values in zip(out[len(same):], (c_row, c_id, scores)):
                        column.append(values[at])

                for lo in range(0, len(a_row), STRIP):
                    part = a_vec[lo: lo + STRIP]
                    scored = four_russians(subset_tables(part), c_bytes, offset, part.sum(axis=1))
                    for j, scores in enumerate(scored, lo):
                        if not second:
                            mask = (c_label == a_label[j]) & (c_row != a_row[j])
                            put(_best(scores, c_id, c_row, mask, POSITIVES), scores, a_row[j])
                            continue
                        other = c_label != a_label[j]
                        for pos in a.field("positives")[j].as_py() or []:
                            ps = pos["score"]
                            low, high = -(-BAND[0] * ps // 100), BAND[1] * ps // 100
                            band = other & (low <= scores) & (scores <= high)
                            put(_best(scores, c_id, c_row, band, NEGATIVES), scores, a_row[j], a_id[j], pos["row"], pos["vec_id"], ps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(column) if column else [], pa.int64()) for column in out], names=names)

    return run


def _pack(width: int, planes: int, offset: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            u = _padded(batch.column("q"), width) - offset
            packed = plane_bytes(u, planes).reshape(len(u), -1)
            column = pa.array([r.tobytes() for r in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), batch.column("label"), column],
                                             names=["row", "vec_id", "label", "planes"])

    return run


def _block_count(rows: int, most: int, least: int, tasks: int) -> int:
    """Blocks of at most about ``most`` rows; smaller ones, down to ``least`` rows, as long as they are fewer than ``tasks``."""
    return max(1, -(-rows // most), min(-(-rows // least), tasks))


def _blocks(rows: DataFrame, n_blocks: int, name: str, fields: list[str]) -> DataFrame:
    keyed = rows.withColumn(name, F.pmod(F.xxhash64("row", F.lit(name)), F.lit(n_blocks)))
    return keyed.groupBy(name).agg(F.collect_list(F.struct(*fields)).alias(name.split("_")[0] + "s"))


def _paired(anchors: DataFrame, candidates: DataFrame, n_a: int, n_c: int) -> DataFrame:
    """One row per (anchor block, candidate block), each in a partition of its own as far as hashing and their number allow."""
    spread = anchors.withColumn("candidate_block", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    return spread.join(candidates, "candidate_block").repartition(
        min(n_a * n_c, PAIR_PARTITIONS), "anchor_block", "candidate_block")


def mine(emb: DataFrame) -> DataFrame:
    """Hard negatives of every anchor and positive, ``OUT`` columns."""
    valid = materialize(quantised(emb), "hard_negative_rows")
    stats = valid.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("width"),
                      F.min(F.array_min("q")).alias("low"), F.max(F.array_max("q")).alias("high"),
                      F.sum(F.expr(f"CAST(vec_id % {ANCHOR_EVERY} = 0 AS INT)")).alias("anchors")).first()
    if not stats.n or not stats.anchors:
        return emb.sparkSession.createDataFrame([], OUT)
    width = max(GROUP, -(-(stats.width or 0) // GROUP) * GROUP)
    offset = min(stats.low if stats.low is not None else 0, 0)
    planes = max(1, (max(stats.high if stats.high is not None else 0, 0) - offset).bit_length())
    packed = materialize(valid.select("row", "vec_id", "label", "q").mapInArrow(
        _pack(width, planes, offset), "row long, vec_id long, label long, planes binary"), "hard_negative_planes")
    tasks = 3 * emb.sparkSession.sparkContext.defaultParallelism
    n_c = _block_count(stats.n, CANDIDATE_BLOCK, min(LEAST_BLOCK, CANDIDATE_BLOCK), tasks)
    n_a = _block_count(stats.anchors, ANCHOR_BLOCK, ANCHOR_BLOCK, 1)
    candidates = _blocks(packed, n_c, "candidate_block", ["row", "vec_id", "label", "planes"])
    candidates = materialize(candidates, "hard_negative_blocks")
    anchors = valid.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    a_blocks = _blocks(anchors, n_a, "anchor_block", ["row", "vec_id", "label", "q"])

    first = _paired(a_blocks, candidates, n_a, n_c).mapInArrow(
        _pair_tasks(width, planes, offset, second=False), "a_row long, row long, vec_id long, score long")
    positives = top_k(first, ["a_row"], [F.desc("score"), F.asc("vec_id"), F.asc("row")], POSITIVES, "p_rank")
    positives = materialize(positives.groupBy("a_row").agg(F.collect_list(F.struct(
        "row", "vec_id", "score")).alias("positives")), "hard_negative_positives")

    with_pos = anchors.join(positives, anchors["row"] == positives["a_row"], "left").drop("a_row")
    a_blocks = _blocks(with_pos, n_a, "anchor_block", ["row", "vec_id", "label", "q", "positives"])
    second = _paired(a_blocks, candidates, n_a, n_c).mapInArrow(
        _pair_tasks(width, planes, offset, second=True),
        "a_row long, anchor_id long, p_row long, positive_id long, positive_score long, n_row long, negative_id long, negative_score long")
    best = top_k(second, ["a_row", "p_row"], [F.desc("negative_score"), F.asc("negative_id"), F.asc("n_row")], NEGATIVES)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                       "positive_score", "negative_score")


def brute_force(rows: list[tuple]) -> list[tuple]:
    """The contract by plain loops over ``(vec_id, label, vector)`` rows; for tests."""
    import math

    valid = []
    for n, (vec_id, label, vec) in enumerate(rows):
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % LABELS if vec_id % RELABEL_EVERY == 0 else label
        valid.append((vec_id, n, label, [math.floor(SCALE * float(x)) for x in vec]))

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a_id, a_n, a_label, a_vec in valid:
        if a_id % ANCHOR_EVERY:
            continue
        scored = sorted(((-dot(a_vec, v), i, n, lab) for i, n, lab, v in valid))
        pos = [(-s, i) for s, i, n, lab in scored if lab == a_label and n != a_n][:POSITIVES]
        for ps, p_id in pos:
            neg = [(-s, i) for s, i, n, lab in scored if lab != a_label and BAND[0] * ps <= -100 * s <= BAND[1] * ps][:NEGATIVES]
            out += [(a_id, p_id, r + 1, i, ps, s) for r, (s, i) in enumerate(neg)]
    return out

