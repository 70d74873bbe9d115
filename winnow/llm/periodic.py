"""Periodic runs of words by seeding and extending diagonals.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart
are equal), at least ``max(12, 2q)`` words long, that no neighbouring word extends with
period ``q``.  Along the diagonal of lag ``q`` a run holds ``length - q`` consecutive
matches, at least ``SEED = 6`` for every run, so two equal 6-grams of one text are a
seed of every run.

Method, per document in its task: the 6-grams are indexed by a hash; for every
position in increasing order its later occurrences are paired with it; a pair of lag
``d`` whose position lies before the furthest point the lag ``d`` diagonal has been
covered to is not extended again.  Otherwise the matches are extended to both sides
(numpy, in growing steps), which yields a maximal stretch with period ``d``; if the
stretch holds ``d`` matches or more it is periodic with exponent 2 or more.  Inside
such a stretch the pairs at multiples of its lag give the same stretch again; when a
6-gram occurs there only at those multiples, all those pairs are passed over at once.
A stretch whose interval is found at several lags is a run of the smallest one (a
smaller period of a stretch at least twice its lag divides that lag).  Hash collisions
are caught by the extension, which compares word ids.

Work grows with the number of occurrence pairs of equal 6-grams in one text that the
bulk rule does not pass over; texts without long repeats cost one sort.

Defined cases: a null text has no words; a null ``doc_id`` is not mutated (it has no
decimal form) and is reported as null; texts of any length are read whole; repeated
rows give a row each; an empty table gives an empty result.  No run: ``n_runs`` 0, the
four figures null, ``runs_sha256`` the digest of the empty string, every word kept.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

# Fixed values of the contract: word expression, shortest run, seed length.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_LENGTH = 12
SEED = 6
MIX = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words after the contract's deterministic repetition of a tail."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _extend(ids: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """Largest ``[b, e)`` around ``i`` with ``ids[x] == ids[x + d]`` for all ``x`` in it."""
    n = len(ids)
    e, step = i, 64
    while e < n - d:
        hi = min(n - d, e + step)
        miss = np.flatnonzero(ids[e:hi] != ids[e + d:hi + d])
        if len(miss):
            e += int(miss[0])
            break
        e, step = hi, step * 2
    b, step = i, 64
    while b > 0:
        lo = max(0, b - step)
        miss = np.flatnonzero(ids[lo:b] != ids[lo + d:b + d])
        if len(miss):
            b = lo + int(miss[-1]) + 1
            break
        b, step = lo, step * 2
    return b, e


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of a sequence of word ids as ``(start, length, period)``, by start, then period."""
    n = len(ids)
    if n < MIN_LENGTH:
        return []
    m = n - SEED + 1
    key = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for t in range(SEED):
            key = key * MIX + ids[t:t + m].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    sizes = np.diff(np.r_[first, m])
    group_end = np.empty(m, np.int64)
    group_end[order] = np.repeat(first + sizes, sizes)
    next_slot = np.empty(m, np.int64)
    next_slot[order] = np.arange(1, m + 1)
    furthest = np.zeros(n, np.int64)  # per lag: the diagonal is covered below this position
    best: dict[tuple[int, int], int] = {}
    cover = None  # (start, end, lag) of a periodic stretch
    for i in np.flatnonzero(next_slot < group_end).tolist():
        later = order[next_slot[i]:group_end[i]]
        if cover is not None and cover[0] <= i and i + SEED <= cover[1]:
            s, t, q = cover
            inside = int(np.searchsorted(later, t - SEED, side="right"))
            if inside and inside == (t - SEED - i) // q:
                lags = later[:inside] - i  # exactly i+q, i+2q, ...: each gives the stretch [s, t-lag)
                np.maximum.at(furthest, lags, t - lags)
                later = later[inside:]
        if not len(later):
            continue
        lags = later - i
        for d in lags[furthest[lags] <= i].tolist():
            if furthest[d] > i:
                continue
            b, e = _extend(ids, i, d)
            furthest[d] = max(e, i + 1)
            if e - b >= d:
                interval = (b, e - b + d)
                if interval[1] >= MIN_LENGTH and best.get(interval, n) > d:
                    best[interval] = d
                if cover is None or d < cover[2] or not (cover[0] <= i and i + SEED <= cover[1]):
                    cover = (b, e + d, d)
    return sorted(((s, length, q) for (s, length), q in best.items()), key=lambda r: (r[0], r[2]))


def describe(doc_id: int | None, text: str | None) -> tuple:
    """One output row for one document."""
    words = planted(WORD.findall(text or ""), doc_id)
    table: dict[str, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
    runs = find_runs(ids)
    dropped = np.zeros(len(words), bool)
    for s, length, q in runs:
        dropped[s + q:s + length] = True
    kept = " ".join(w for w, gone in zip(words, dropped.tolist()) if not gone)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    figures = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *figures, hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest())


def _rows(batches: Iterator) -> Iterator:
    import pyarrow as pa

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    types = [pa.int64()] * 6 + [pa.string()] * 2
    for batch in batches:
        rows = [describe(d, t) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        columns = list(zip(*rows)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Run count, longest run and digests of all runs and of the collapsed text, one row per document."""
    return docs.select("doc_id", "text").mapInArrow(_rows, SCHEMA)
