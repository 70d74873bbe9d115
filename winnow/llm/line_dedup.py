"""Fuzzy line deduplication by MinHash over character shingles.

Lines are compared in lower case with white space collapsed.  Equal lines are one node,
known by a 64-bit hash.  Every distinct line gets a MinHash signature over its character
shingles, and lines that agree in one of its bands are candidates: with 12 bands of 5
rows a pair of Jaccard similarity 0.8 is found with probability 0.991, and with more above.

Candidates are verified by the exact Jaccard similarity of their shingle sets (shingles
are known by 64-bit hashes there), in two steps.  First each line of a band entry is held against the entry's smallest line, whose
copies are spread if it has many partners.  Components of those links follow by
union-find within tasks and star contraction between them.  Then entries whose other lines
still belong to several components are compared across components, cut into blocks on both
sides; entries of the same lines are compared once, and a block emits a spanning forest of
its links.  Each component keeps the line that comes first by (doc_id, line number).

Defined cases: a null text has no lines; lines without a visible character are not
compared and stay; lines shorter than a shingle have one shingle, the whole line; ties
of position do not occur except for rows that repeat doc_id and text, which share their
decisions; lines whose 64-bit hash clashes with a different line are left alone; an
empty table gives an empty result.  A document whose lines all repeat others keeps its
row with an empty text.  Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.components import components
from winnow.runtime import materialize

SHINGLE, BANDS, ROWS, SIMILARITY = 6, 12, 5, 0.8
# Partners of one line that are verified in one run, and lines per block side.
SPREAD, BLOCK = 256, 256
# Characters whose shingles are held at once, rows up to which pairs are compared one by one, and distinct
# lines of an entry whose smallest is known before any is passed on.
HELD, FEW, ENTRY = 1_000_000, 8, 1_000_000
LINES = "doc_id long, text_hash long, line_no int, h long, h2 long, fresh boolean, line string"
SEED = 11


def plain_line(line: str) -> str:
    return " ".join(line.lower().split())


def runs_of(lines: list[str], chars: int = 50_000) -> Iterator[list[str]]:
    """Consecutive lines of about ``chars`` characters together, or one longer line."""
    run, held = [], 0
    for line in lines:
        run.append(line)
        held += len(line) + SHINGLE
        if held >= chars:
            yield run
            run, held = [], 0
    if run:
        yield run


def shingle_sets(lines: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each line as sorted 64-bit hashes."""
    out: list[np.ndarray] = []
    gap = "\0" * size
    for run in runs_of(lines):
        sizes = np.fromiter(map(len, run), np.int64, len(run))
        code = np.frombuffer((gap.join(run) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
        x = np.zeros(len(code) - size + 1, np.uint64)
        for i in range(size):
            x = (x ^ code[i:i + len(x)]) * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(29)
        starts, count = np.cumsum(sizes + size) - (sizes + size), np.maximum(1, sizes - size + 1)
        for a, n in zip(starts.tolist(), count.tolist()):
            x[a:a + n].sort()
        first = np.cumsum(count) - count
        x = x[np.arange(count.sum()) + np.repeat(starts - first, count)]
        new = np.concatenate([[True], x[1:] != x[:-1]])
        new[first] = True
        out += np.split(x[new], np.cumsum(np.add.reduceat(new, first, dtype=np.int64))[:-1])
    return out


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the exact Jaccard similarity of two shingle sets is at least ``least``."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < least * len(large):
        return False
    at = np.minimum(large.searchsorted(small), len(large) - 1)
    both = np.count_nonzero(large[at] == small)
    return both >= least * (len(a) + len(b) - both)


def line_hashes(lines: Iterable[str]) -> np.ndarray:
    """``lines x 2``: the signed 64-bit halves of a 128-bit hash of each line."""
    import xxhash

    digests = [xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass")) for line in lines]
    return np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)


def signatures(lines: list[str], size: int = SHINGLE, count: int = BANDS * ROWS) -> np.ndarray:
    """``lines x count`` minima of hashed shingles."""
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    turn = rng.integers(0, 1 << 32, count, dtype=np.uint32)
    place = rng.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    out, at = np.empty((len(lines), count), np.uint32), 0
    for part in runs_of(lines):
        end = at + len(part)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        gap = "\0" * size
        code = np.frombuffer((gap.join(part) + gap + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
        x = np.zeros(len(code) - size, np.uint32)
        for i in range(size):
            x += code[i:i + len(x)] * place[i]
            x ^= x >> np.uint32(13)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(16)
        starts = np.concatenate([[0], np.cumsum(sizes + size)[:-1]])
        edges = np.stack([starts, starts + np.maximum(1, sizes - size + 1)], 1).ravel()
        v = np.empty_like(x)
        for k in range(count):
            np.bitwise_xor(x, turn[k], out=v)
            np.multiply(v, odd[k], out=v)
            out[at:end, k] = np.minimum.reduceat(v, edges)[::2]
        at = end
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """``lines x bands`` 64-bit keys; the number of the band is part of the key."""
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(sig), 1), np.uint64)
    for r in range(rows):
        key ^= sig.reshape(len(sig), bands, rows)[:, :, r].astype(np.uint64)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _lines(batches: Iterator) -> Iterator:
    """Texts to their visible lines; of equal lines of 1,000 texts, one is fresh."""
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 1_000):
            part = batch.slice(at, 1_000)
            count, numbers, lines = [], [], []
            for text in part.column(2):
                before = len(numbers)
                for line_no, line in enumerate((text.as_py() or "").split("\n")):
                    line = plain_line(line)
                    if line:
                        numbers.append(line_no)
                        lines.append(line)
                count.append(len(numbers) - before)
            rows = pa.array(np.repeat(np.arange(part.num_rows), count))
            halves = line_hashes(lines)
            fresh = np.zeros(len(lines), bool)
            fresh[np.unique(halves[:, 0], return_index=True)[1]] = True
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), part.column(1).take(rows), pa.array(numbers, pa.int32()),
                 pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(fresh), pa.array(lines, pa.string())],
                names=["doc_id", "text_hash", "line_no", "h", "h2", "fresh", "line"])


def _bands(batches: Iterator) -> Iterator:
    """Rows ``(h, line)`` to the band keys of the distinct lines of a batch."""
    import pyarrow as pa

    for batch in batches:
        h, at = np.unique(batch.column(0).to_numpy(), return_index=True)
        for k in range(0, len(h), 2_000):
            keys = band_keys(signatures(batch.column(1).take(pa.array(at[k:k + 2_000])).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(h[k:k + 2_000], BANDS))], names=["key", "h"])


def _members(batches: Iterator) -> Iterator:
    """Rows ``(key, h)`` sorted by key to ``(key, h, rep)``: the lines of an entry besides its representative.

    That is the entry's smallest line, or the smallest of its first ``ENTRY`` lines or so; past
    them, lines may come repeatedly.
    """
    import pyarrow as pa

    def members(keys: np.ndarray, hs: np.ndarray) -> tuple:
        order = np.lexsort((hs, keys))
        keys, hs = keys[order], hs[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        reps = hs[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
        more = ~new & np.concatenate([[False], hs[1:] != hs[:-1]])
        return keys[more], hs[more], reps[more]

    key, held, size, rep, limit = None, [], 0, None, ENTRY
    for batch in batches:
        keys, hs = (c.to_numpy() for c in batch.columns)
        if not len(keys):
            continue
        out = []
        head = int(np.searchsorted(keys, key, "right")) if key is not None else 0
        if head and rep is not None:
            out.append((keys[:head][hs[:head] != rep], hs[:head][hs[:head] != rep], np.full(np.count_nonzero(hs[:head] != rep), rep)))
        elif head:
            held.append(hs[:head])
            size += head
            if size > 2 * limit:
                held = [np.unique(np.concatenate(held))]
                size = len(held[0])
                if size > limit:
                    rep = held[0][0]
                    out.append((np.full(size - 1, key), held[0][1:], np.full(size - 1, rep)))
                    held, size = [], 0
        if head < len(keys):
            if held:
                together = np.concatenate(held)
                out.append(members(np.full(len(together), key), together))
            key, rep = keys[-1], None
            tail = int(np.searchsorted(keys, key, "left"))
            held, size = [hs[tail:].copy()], len(keys) - tail
            k, n = keys[head:tail], np.zeros(tail - head, bool)
            if len(k) > 1:
                pairs = k[1:] == k[:-1]
                n[1:] |= pairs
                n[:-1] |= pairs
            if n.any():
                out.append(members(k[n], hs[head:tail][n]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names=["key", "h", "rep"])
    if held:
        together = np.concatenate(held)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in members(np.full(len(together), key), together)],
                                         names=["key", "h", "rep"])


def _slices(batch, column: int) -> Iterator:
    """Parts of a batch of at most 1,000 rows and about ``HELD`` characters of a column."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy()
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:at + 1_000], dtype=np.int64), HELD, "right")))
        yield batch.slice(at, n)
        at += n


def _against_first(batches: Iterator) -> Iterator:
    """Rows ``(rep, salt, own, h, line)``, each run led by the rep's own line, to links."""
    import pyarrow as pa

    run, held = None, None
    for batch in batches:
        for part in _slices(batch, 4):
            reps, salts, owns, hs, lines = (c.to_pylist() for c in part.columns)
            us, vs = [], []
            for rep, salt, own, h, found in zip(reps, salts, owns, hs, shingle_sets(lines)):
                if own:
                    run, held = (rep, salt), found
                elif run == (rep, salt) and similar(held, found):
                    us.append(h)
                    vs.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def across(cell: list[tuple]) -> list[tuple[int, int]]:
    """Spanning links between lines of different components in the two blocks of a cell.

    ``cell`` holds ``(side, h, root, line, shingles or None)``; the rows of one side alone are
    compared among themselves.  Shingles that are not given are made for parts of a side.
    """
    if len({x[2] for x in cell}) == 1:
        return []
    part = np.unique(np.array([x[2] for x in cell], np.int64), return_inverse=True)[1]
    left, right = ([k for k, x in enumerate(cell) if x[0] == side] for side in (0, 1))

    def sets(rows: np.ndarray) -> list[np.ndarray]:
        given = [cell[k][4] for k in rows]
        return given if given[0] is not None else shingle_sets([cell[k][3] for k in rows])

    def parts(rows: list[int]) -> list[np.ndarray]:
        runs = runs_of([cell[k][3] for k in rows], HELD)
        return np.split(np.array(rows), np.cumsum([len(r) for r in runs])[:-1])

    lefts = parts(left) if left else []
    rights, links = parts(right) if right else lefts, []
    for i, ours in enumerate(lefts):
        own = sets(ours)
        for j, theirs in enumerate(rights if right else rights[i:]):
            same = not right and j == 0
            links += [(cell[a][1], cell[b][1]) for a, b in _joined(ours, theirs, own, own if same else sets(theirs), part, same)]
    return links


def _joined(ours: np.ndarray, theirs: np.ndarray, own: list, others: list, part: np.ndarray, same: bool) -> Iterator[tuple[int, int]]:
    """Pairs of similar rows of different components; ``part``, the rows' components, is joined on the way."""
    if len(others) <= FEW:
        theirs = theirs.tolist()
        for i, (k, mine) in enumerate(zip(ours.tolist(), own)):
            for j in range(i + 1 if same else 0, len(others)):
                there = theirs[j]
                if part[there] != part[k] and similar(mine, others[j]):
                    part[part == part[there]] = part[k]
                    yield k, there
        return
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    names = at = starts = None
    for i, (k, mine) in enumerate(zip(ours.tolist(), own)):
        n = len(mine)
        open_ = (part[theirs] != part[k]) & (np.minimum(sizes, n) >= SIMILARITY * np.maximum(sizes, n))
        if same:
            open_[:i + 1] = False
        found = np.flatnonzero(open_)
        if len(found) > FEW:
            if names is None:
                names, at = np.unique(np.concatenate(others), return_inverse=True)
                starts = np.cumsum(sizes) - sizes
            place = np.minimum(names.searchsorted(mine), len(names) - 1)
            held = np.zeros(len(names), bool)
            held[place[names[place] == mine]] = True
            both = np.add.reduceat(held[at], starts, dtype=np.int64)[found]
            found = found[both >= SIMILARITY * (n + sizes[found] - both)]
        else:
            found = [j for j in found if similar(mine, others[j])]
        for j in found:
            there = theirs[j]
            if part[there] != part[k]:
                part[part == part[there]] = part[k]
                yield k, int(there)


def _across(batches: Iterator) -> Iterator:
    """Rows ``(key, i, j, side, h, root, line)`` sorted by cell to links."""
    import pyarrow as pa

    def links(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    cell, rows, held = None, [], 0
    for batch in batches:
        for part in _slices(batch, 6):
            out, columns = [], [c.to_pylist() for c in part.columns]
            for key, i, j, side, h, root, line, found in zip(*columns, shingle_sets(columns[6])):
                if (key, i, j) != cell:
                    out += across(rows) if rows else []
                    cell, rows, held = (key, i, j), [], 0
                held += len(line)
                if held > HELD:  # made again, part by part
                    rows = [(*x[:4], None) for x in rows] if rows and rows[0][4] is not None else rows
                    found = None
                rows.append((side, h, root, line, found))
            yield links(out)
    yield links(across(rows) if rows else [])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def line_links(texts: DataFrame) -> DataFrame:
    """``(node, root)`` for the lines that are similar to another one; ``texts`` is a stored table ``(h, line)``."""
    # Sorted by one number only, which Spark does by its digits.
    bands = texts.mapInArrow(_bands, "key long, h long").repartition("key").sortWithinPartitions("key")
    members = materialize(bands.mapInArrow(_members, "key long, h long, rep long"), "members")
    pairs = materialize(members.select("rep", "h").distinct(), "pairs")
    wanted = pairs.select("h").unionByName(pairs.select(F.col("rep").alias("h"))).distinct()
    lines = materialize(texts.join(wanted, "h", "left_semi").dropDuplicates(["h"]), "lines")

    # The first line of an entry goes to as many places as its partners need.
    parts = pairs.groupBy("rep").agg(F.ceil(F.count(F.lit(1)) / SPREAD).cast("int").alias("parts"))
    parts = materialize(parts, "parts")
    own = parts.select(F.col("rep").alias("h"), "rep", F.lit(True).alias("own"),
                       F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    dealt = pairs.join(parts, "rep").select("h", "rep", F.lit(False).alias("own"),
                                            F.pmod(F.xxhash64("h"), F.col("parts")).cast("int").alias("salt"))
    dealt = dealt.unionByName(own)
    runs = dealt.join(lines, "h").select("rep", "salt", "own", "h", "line")
    runs = runs.repartition("rep", "salt").sortWithinPartitions("rep", "salt", F.desc("own"), "h")
    first = materialize(runs.mapInArrow(_against_first, "u long, v long"), "links")
    roots = materialize(components(first), "roots")

    # Entries in which several components are left besides the smallest line, which met all others above.
    placed = materialize(members.join(roots, F.col("h") == F.col("node"), "left")
                         .select("key", "h", F.coalesce("root", "h").alias("root")), "placed")
    several = placed.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("h")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "h")).alias("b"),
        F.sum(F.pmod(F.xxhash64(F.lit(2), "h"), F.lit(1 << 31))).alias("c")).where("low < high")
    several = several.groupBy("low", "high", "n", "a", "b", "c").agg(F.min("key").alias("key"))  # the same lines once
    several = materialize(several.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "several")
    mine = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cells = placed.join(several, "key").select("key", "h", "root", mine.alias("mine"), "blocks")
    # A cell (i, j) with i < j has block i on side 0 and block j on side 1; (i, i) has one side.
    later, earlier = F.sequence("mine", F.col("blocks") - 1), F.slice(every, F.lit(1), F.col("mine"))
    as_left = cells.select("key", F.col("mine").alias("i"), F.explode(later).alias("j"), F.lit(0).alias("side"), "h", "root")
    as_right = cells.select("key", F.explode(earlier).alias("i"), F.col("mine").alias("j"), F.lit(1).alias("side"), "h", "root")
    rows = as_left.unionByName(as_right).join(lines, "h").select("key", "i", "j", "side", "h", "root", "line")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "h")
    # Stored, so that no stage runs two Python steps, and with them twice the workers.
    linked = materialize(rows.mapInArrow(_across, "u long, v long"), "across")
    stars = roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    return components(stars.unionByName(linked))


def line_groups(docs: DataFrame) -> DataFrame:
    """Every visible line with its group: ``doc_id, text_hash, line_no, kept, keep_*, copies``."""
    lines = materialize(_keyed(docs).mapInArrow(_lines, LINES), "occurrences")
    roots = line_links(lines.where("fresh").select("h", "line"))
    position = F.struct("doc_id", "text_hash", "line_no")
    distinct = materialize(
        lines.groupBy("h").agg(F.min(position).alias("first"), F.count(F.lit(1)).alias("n"),
                               F.min("h2").alias("a"), F.max("h2").alias("b")).where("a = b").drop("a", "b"), "distinct")
    placed = distinct.join(roots, F.col("h") == F.col("node"), "left").select("h", "first", "n", F.coalesce("root", "h").alias("root"))
    placed = materialize(placed, "placed")
    groups = materialize(placed.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("copies"))
                         .where("copies > 1"), "groups")
    decided = materialize(placed.join(groups, "root").select("h", "root", "keep", "copies"), "decided")
    out = lines.join(decided, "h", "left")
    return out.select(
        "doc_id", "text_hash", "line_no",
        (F.col("keep").isNull() | position.eqNullSafe(F.col("keep"))).alias("kept"),
        F.coalesce(F.col("keep"), position).alias("keep"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies"))


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents without their repeated lines, with the columns of ``docs``."""
    gone = line_groups(docs).where("not kept").groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("gone"))
    gone = materialize(gone.select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), "gone"), "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("k_id"), F.xxhash64("text").alias("k_hash"))
    joined = rows.join(gone, F.col("k_id").eqNullSafe(F.col("g_id")) & (F.col("k_hash") == F.col("g_hash")), "left")
    numbered = F.transform(F.split(F.col("row")["text"], "\n", -1), lambda x, i: F.struct(x.alias("line"), i.alias("no")))
    left = F.filter(numbered, lambda x: ~F.array_contains(F.col("gone"), x["no"]))
    text = F.when(F.col("gone").isNull(), F.col("row")["text"]).otherwise(
        F.array_join(F.transform(left, lambda x: x["line"]), "\n"))
    return joined.withColumn("row", F.col("row").withField("text", text)).select("row.*")
