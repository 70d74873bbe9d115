from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from winnow.llm import simhash
from winnow.llm.components import components, find_roots


def slow_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, distance=4):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "a b c d", "A É b\x0bC d e f", "w " * 300_000])
def test_fingerprint_matches_definition(text):
    assert simhash.fingerprint(text) % (1 << 64) == slow_print(text)


@pytest.mark.parametrize("extra", [False, True])
def test_query_matches_brute_force(documents, extra):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, "  ")]
    for base in range(12):
        text = [rng.choice(words) for _ in range(120)]
        for copy in range(6):
            if copy:
                text = [*text]
                text[rng.randrange(120)] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows.append((len(rows), " ".join(rng.choice(words) for _ in range(50_000))))
    prints = {i: slow_print(t) for i, t in rows}
    want = slow_groups(prints)
    got = simhash.near_groups(documents(rows, extra)).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == want
    kept = simhash.keep_one(documents(rows, extra))
    assert kept.columns == documents(rows, extra).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("rows", [10, 10**5, 10**7, 10**12, 10**15])
def test_every_plan_finds_all_links(spark, rows):
    plan = simhash.segment_plan(rows)
    assert sum(w for _, w, _ in plan) <= 64
    rng = random.Random(rows)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for p in list(prints):
        for flips in (1, 3, 4, 5):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), flips)))
    if max(w for _, w, _ in plan) > 32:
        pytest.skip("the ball of a single wide segment is too long to list in a test")
    nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "bits long, id long")
    want = slow_groups(dict(enumerate(prints)))
    for crowded, block in ((64, 1024), (1, 2)):
        roots = {r.node: r.root for r in components(simhash.links(nodes, 4, plan, crowded, block)).collect()}
        assert {i: roots.get(i, i) for i in want} == want


def test_large_group_is_linked_without_all_pairs(spark):
    rng = random.Random(2)
    center = rng.getrandbits(62)
    prints = list({center ^ sum(1 << b for b in rng.sample(range(62), 2)) for _ in range(1_500)})
    nodes = spark.createDataFrame(list(zip(prints, range(len(prints)))), "bits long, id long")
    edges = simhash.links(nodes, 4, block=512)
    assert edges.count() < len(prints) * (len(prints) - 1) / 2 / 4  # every pair is a link
    assert {r.root for r in components(edges).collect()} == {0}


def test_repeated_rows_leave_one(documents):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "other words come here now")]
    assert sorted(r.doc_id for r in simhash.keep_one(documents(rows)).collect()) == [1, 3]


def test_empty_table(documents):
    assert simhash.near_groups(documents([(1, "a")]).limit(0)).count() == 0
    assert simhash.keep_one(documents([(1, "a")]).limit(0)).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1_000, i) for i in range(1_001, 1_400)] + [(2_000, 2_001), (2_001, 2_002), (2_002, 2_000)]
    edges += [(5, 5), (7, 8), (8, 7), (None, 3)]
    random.Random(3).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    want = {i: 0 for i in range(201)} | {i: 1_000 for i in range(1_000, 1_400)} | {i: 2_000 for i in range(2_000, 2_003)}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_local_union_find():
    rng = np.random.default_rng(1)
    u, v = rng.integers(0, 500, 300), rng.integers(0, 500, 300)
    nodes, roots = find_roots(u, v)
    assert (roots <= nodes).all()
    at = dict(zip(nodes.tolist(), roots.tolist()))
    assert all(at[a] == at[b] for a, b in zip(u.tolist(), v.tolist()))


def test_a_clean_text_with_a_repeated_id_stays(documents):
    """Ids 1, 2 hold equal texts; a second row 2 holds a different, unique text: it stays."""
    rows = [(1, "the same five words here now"), (2, "the same five words here now"),
            (2, "entirely different words that match nothing else at all"), (None, "a b c d e"), (3, None)]
    kept = sorted((r.doc_id is None, r.doc_id, r.text) for r in simhash.keep_one(documents(rows, extra=True)).collect())
    assert kept == sorted([(False, 1, "the same five words here now"),
                           (False, 2, "entirely different words that match nothing else at all"),
                           (True, None, "a b c d e"), (False, 3, None)])
    again = sorted((r.doc_id is None, r.doc_id, r.text) for r in simhash.keep_one(documents(rows, extra=True, parts=5)).collect())
    assert again == kept
