from __future__ import annotations

import random

import pytest

from winnow.llm import line_dedup


def slow(rows):
    """The place that each visible line's group keeps."""
    places = [(i, n, line_dedup.plain_line(x)) for i, t in sorted(rows, key=lambda r: r[0]) for n, x in enumerate((t or "").split("\n"))]
    places = [p for p in places if p[2]]
    lines = list(dict.fromkeys(p[2] for p in places))
    sets = [{x[i:i + 6] for i in range(max(1, len(x) - 5))} for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    group = {x: find(k) for k, x in enumerate(lines)}
    keep = {}
    for i, n, x in places:
        keep.setdefault(group[x], (i, n))
    return {(i, n): keep[group[x]] for i, n, x in places}


def made(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = line(30)
    rows = [(0, None), (1, ""), (2, " \n\t\n"), (3, "hi\nHI\n hi \nho"), (4, "é\nÉ\nx" * 3)]
    for i in range(5, 40):
        own = [line(rng.randrange(1, 40)) for _ in range(4)]
        parts = shared.split()
        parts[rng.randrange(30)] = rng.choice(words)
        rows.append((i, "\n".join([*own, " ".join(parts), "all rights are kept by the owner"])))
    rows.append((40, "\n".join(line(12) for _ in range(2_000))))
    return rows


@pytest.mark.parametrize("extra", [False, True])
def test_groups_match_brute_force(documents, extra):
    rows = made()
    want = slow(rows[:-1])
    got = line_dedup.line_groups(documents(rows[:-1], extra)).collect()
    assert {(r.doc_id, r.line_no): (r.keep.doc_id, r.keep.line_no) for r in got} == want
    assert all(r.kept == ((r.doc_id, r.line_no) == want[r.doc_id, r.line_no]) for r in got)


def test_small_blocks_and_runs_give_the_same(documents, monkeypatch):
    rows = made(6)[:-1]
    monkeypatch.setattr(line_dedup, "BLOCK", 2)
    monkeypatch.setattr(line_dedup, "SPREAD", 2)
    got = line_dedup.line_groups(documents(rows)).collect()
    assert {(r.doc_id, r.line_no): (r.keep.doc_id, r.keep.line_no) for r in got} == slow(rows)


@pytest.mark.parametrize("extra", [False, True])
def test_texts_without_repeated_lines(documents, extra):
    rows = made(7)
    df = documents(rows, extra)
    out = line_dedup.drop_lines(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert len(got) == len(rows) and got[0] is None and got[1] == "" and got[2] == " \n\t\n"
    assert got[3] == "hi\nho"
    assert sum("all rights are kept" in (t or "") for t in got.values()) == 1
    assert got[40] == dict(rows)[40]


def test_empty_table(documents):
    assert line_dedup.line_groups(documents([(1, "a")]).limit(0)).count() == 0
    assert line_dedup.drop_lines(documents([(1, "a")]).limit(0)).count() == 0


def test_repeated_rows_share_decisions(documents):
    got = line_dedup.drop_lines(documents([(1, "one line here"), (1, "one line here"), (2, "one line here\nmore")])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "one line here"), (1, "one line here"), (2, "more")]


def test_bands_find_similar_lines():
    rng = random.Random(9)
    found = total = 0
    for _ in range(400):
        a = "".join(rng.choice("abcdefgh ") for _ in range(200))
        b = list(a)
        for _ in range(3):
            b[rng.randrange(200)] = "z"
        b = "".join(b)
        x, y = line_dedup.shingle_sets([a, b])
        if line_dedup.similar(x, y):
            total += 1
            keys = line_dedup.band_keys(line_dedup.signatures([a, b]))
            found += bool((keys[0] == keys[1]).any())
    assert total > 200 and found >= 0.97 * total


@pytest.mark.parametrize("entry", [2, 1_000])
def test_entries_over_several_batches(monkeypatch, entry):
    pa = pytest.importorskip("pyarrow")
    monkeypatch.setattr(line_dedup, "ENTRY", entry)
    rng = random.Random(3)
    rows = sorted(((rng.choice([1, 2, 2, 2, 5, 7, *range(20, 60)]), rng.randrange(12)) for _ in range(200)), key=lambda r: r[0])
    for width in (1, 3, 50, 200):
        batches = [pa.record_batch([[r[k] for r in rows[i:i + width]] for k in (0, 1)], names=["key", "h"]) for i in range(0, 200, width)]
        got = [tuple(r.values()) for b in line_dedup._members(iter(batches)) for r in b.to_pylist()]
        of = {key: {h for k, h in rows if k == key} for key, _ in rows}
        reps = {key: {r for k, _, r in got if k == key} for key in of}
        assert all(len(reps[key]) == (len(hs) > 1) and reps[key] <= hs for key, hs in of.items())
        assert set(got) == {(key, h, rep) for key, hs in of.items() for rep in reps[key] for h in hs - {rep}}
        if entry == 1_000:
            assert len(got) == len(set(got)) and all(rep == min(of[key]) for key, _, rep in got)


@pytest.mark.parametrize("held", [300, 1_000_000])
def test_cells_are_joined_as_pair_by_pair(monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD", held)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    lines = []
    for _ in range(12):
        base = [word() for _ in range(25)]
        for _ in range(4):
            lines.append(" ".join([*base, *(word() for _ in range(rng.randrange(6)))]))
    rng.shuffle(lines)
    sets = line_dedup.shingle_sets(lines)
    assert all(s.tolist() == sorted(set(s.tolist())) for s in sets)
    assert [len(s) for s in sets] == [len({x[i:i + 6] for i in range(max(1, len(x) - 5))}) for x in lines]
    for two in (False, True):
        cell = [(k % 2 if two else 0, k, k, x, s if held > 300 else None) for k, (x, s) in enumerate(zip(lines, sets))]
        near = {(a, b) for a in range(48) for b in range(48) if line_dedup.similar(sets[a], sets[b]) and (
            a % 2 == 0 and b % 2 == 1 if two else a < b)}
        links = line_dedup.across(cell)
        assert set(links) <= near

        def groups(edges):
            root = list(range(48))
            for a, b in edges:
                old, new = root[b], root[a]
                root = [new if r == old else r for r in root]
            return {frozenset(k for k in range(48) if root[k] == r) for r in root}

        assert groups(links) == groups(near) and len(links) == 48 - len(groups(near))
