from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from winnow.llm import periodic
from winnow.llm.sequence_queries import op11_periodic_runs


def smallest_period(seq):
    return next(q for q in range(1, len(seq) + 1) if all(seq[x] == seq[x + q] for x in range(len(seq) - q)))


def brute(words):
    """Runs by the definition: maximal stretches of every lag whose smallest period is that lag."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and words[y] == words[y + q]:
                y += 1
            length = y - x + q
            if length >= max(12, 2 * q) and smallest_period(words[x:x + length]) == q:
                out.append((x, length, q))
            x = y
    return sorted(out, key=lambda r: (r[0], r[2]))


def ids_of(words):
    table = {}
    return np.array([table.setdefault(w, len(table)) for w in words], np.int64)


def test_random_sequences_match_brute_force():
    rng = random.Random(7)
    for trial in range(1500):
        alphabet = rng.choice(["ab", "abc", "abcd", "abcdefgh"])
        n = rng.randrange(0, 90)
        if trial % 3 == 0:
            period = [rng.choice(alphabet) for _ in range(rng.randrange(1, 15))]
            words = [rng.choice(alphabet) for _ in range(rng.randrange(0, 20))]
            words += (period * 40)[: rng.randrange(len(period), 100)] + [rng.choice(alphabet) for _ in range(rng.randrange(0, 20))]
        else:
            words = [rng.choice(alphabet) for _ in range(n)]
        assert periodic.find_runs(ids_of(words)) == brute(words), words


def test_long_single_word_and_repeated_line_are_fast():
    words = ["a"] * 60_000
    assert periodic.find_runs(ids_of(words)) == [(0, 60_000, 1)]
    line = "one two three four five six seven eight nine ten".split()
    words = ["x"] + line * 3000 + ["y"]
    assert periodic.find_runs(ids_of(words)) == [(1, 30_000, 10)]


def test_planted_tail_rule():
    for doc_id in range(2000):
        words = [f"w{i}" for i in range(50)]
        got = periodic.planted(words, doc_id)
        h = zlib.crc32(str(doc_id).encode())
        if h % 10:
            assert got == words
        else:
            g = h // 10
            a = g % 50
            p = 1 + (50 - a) // (3 + g % 8)
            assert got[:a] == words[:a] and all(got[i] == words[a + (i - a) % p] for i in range(a, 50))
    assert periodic.planted([], 10) == [] and periodic.planted(["x"], None) == ["x"]


def expected_row(doc_id, text):
    words = periodic.planted(periodic.WORD.findall(text or ""), doc_id)
    runs = brute(words)
    dropped = set()
    for s, length, q in runs:
        dropped.update(range(s + q, s + length))
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (len(runs), *(top[:3] if top else (None,) * 3), top and 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{l},{q}\n" for s, l, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


TEXTS = [None, "", "a", "a b " * 6, "a b " * 5 + "a", "x\ty\nx\ty\rx y x y x y x y z", "é 🙂 " * 20,
         "the cat sat on the mat " * 4 + "and then left", " ".join("abcabcabcabcabcX") ]


@pytest.mark.parametrize("extra", [False, True])
def test_rows_of_a_table(documents, extra):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[3]), (20, TEXTS[5])]
    got = periodic.periodic_runs(documents(rows, extra)).collect()
    assert len(got) == len(rows)
    texts = {d: t for d, t in rows}
    for r in got:
        assert tuple(r)[1:] == expected_row(r.doc_id, texts[r.doc_id]), r
    assert periodic.periodic_runs(documents(rows).limit(0)).count() == 0


def test_query_on_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op11_periodic_runs(spark, sf).collect()
    assert len(got) == len(texts) and sum(r.n_runs for r in got) > 0
    for r in got:
        words = periodic.planted(periodic.WORD.findall(texts[r.doc_id] or ""), r.doc_id)
        if len(words) <= 3000:  # the brute force is cubic
            assert tuple(r)[1:] == expected_row(r.doc_id, texts[r.doc_id]), r.doc_id
