from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from winnow.llm import mixing
from winnow.llm.table_queries import op8_mixing


def slow_targets(sizes):
    """Caps and resharing by the letter."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        if not open_:
            return fixed
        left = total - sum(fixed.values())
        shares = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = [s for s in open_ if shares[s] >= 2 * sizes[s]]
        if not above:
            return fixed | shares
        fixed |= {s: 2.0 * sizes[s] for s in above}


def table(rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall("[^\x20\x09-\x0d]+", text or ""))
    return dict(sizes)


def rows_of(seed, n=3_000):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randrange(0, 40), "hot" if i % 3 == 0 else f"s{rng.randrange(9)}") for i in range(n)]
    return [*rows, (n, None, "empty"), (n + 1, "", "empty"), (n + 2, "a b\x0bc d", None), (n + 3, "x " * 20_000, "é")]


def test_targets_match_brute_force(documents):
    rows = rows_of(1)
    df = documents([(i, t, None, s) for i, t, s in rows])
    got = {r.source: (r.source_size, r.target) for r in mixing.source_targets(df.select("source", mixing.word_count("text").alias("size"))).collect()}
    want, sizes = slow_targets(table(rows)), table(rows)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s][0] == sizes[s] and got[s][1] == pytest.approx(want[s])
    assert sum(t for _, t in got.values()) == pytest.approx(1.5 * sum(sizes.values()))


@pytest.mark.parametrize("extra", [False, True])
def test_documents_are_repeated_by_rate(documents, extra):
    rows = rows_of(2)
    df = documents([(i, t, None, s) for i, t, s in rows], extra)
    out = mixing.repeat_documents(df)
    assert out.columns == df.columns
    taken, n = defaultdict(int), defaultdict(int)
    texts = {i: (t, s) for i, t, s in rows}
    for r in out.collect():
        assert (r.text, r.source) == texts[r.doc_id]
        n[r.doc_id] += 1
        taken[r.source] += len((r.text or "").split())
    assert max(n.values()) <= 2
    want = slow_targets(table(rows))
    for s in ("hot", *(f"s{i}" for i in range(9))):
        assert taken[s] == pytest.approx(want[s], rel=0.15)
    assert sorted(map(tuple, out.select("doc_id", "source").collect()), key=str) == sorted(map(tuple, mixing.repeat_documents(df).select("doc_id", "source").collect()), key=str)


def test_query(spark, small):
    got = op8_mixing(spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = slow_targets(table([(r.doc_id, r.text, r.source) for r in docs]))
    sizes = table([(r.doc_id, r.text, r.source) for r in docs])
    assert len(got) == len(docs)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        rate = r.target / r.source_size if r.source_size else 0
        assert r.taken in (int(rate) * r.size, (int(rate) + (rate > int(rate))) * r.size) and r.taken <= 2 * r.size


def test_draws_are_uniform(spark):
    mean = spark.range(20_000).select(mixing.unit_hash(17, "id").alias("u")).agg({"u": "avg"}).first()[0]
    assert mean == pytest.approx(0.5, abs=0.01)


def test_empty_table_and_empty_texts(documents):
    assert mixing.repeat_documents(documents([(1, "a", None, "s")]).limit(0)).count() == 0
    assert mixing.repeat_documents(documents([(1, None, None, "s"), (2, "", None, None)])).count() == 0
