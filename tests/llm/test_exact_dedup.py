from __future__ import annotations

import hashlib
import random
import re

import pytest

from winnow.llm import exact_dedup
from winnow.llm.exact_dedup import CuckooFilter, Shard


def brute(rows):
    plain = {i: re.sub("[\x20\x09-\x0d]", "", t or "") for i, t in rows}
    groups = {}
    for i, t in rows:
        groups.setdefault(plain[i], []).append((-len(t or ""), i))
    return {i: (min(groups[plain[i]])[1], len(groups[plain[i]]), hashlib.sha256(plain[i].encode()).hexdigest()) for i, _ in rows}


def result(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.exact_groups(df).collect()}


@pytest.mark.parametrize("extra", [False, True])
def test_groups_match_brute_force(documents, extra):
    rows = [(1, "a b"), (2, "ab"), (3, " a\tb\r"), (4, None), (5, ""), (6, " \n"), (7, "A b"), (8, "é" * 5), (9, "é é é é é"),
            (10, "a b"), (11, "x" * 200_000), (12, "x" * 100_000 + " " + "x" * 100_000)]
    assert result(documents(rows, extra)) == brute(rows)


def test_hot_group_over_many_partitions(documents):
    rows = [(i, "same text" if i % 3 else f"own {i}") for i in range(3_000)]
    assert result(documents(rows, parts=16)) == brute(rows)


def test_repeated_rows_share_a_decision(documents):
    got = exact_dedup.exact_groups(documents([(1, "a"), (1, "a"), (2, "a")])).collect()
    assert sorted((r.doc_id, r.kept, r.group_size) for r in got) == [(1, True, 3), (1, True, 3), (2, False, 3)]


def test_empty_table(documents, spark):
    assert exact_dedup.exact_groups(documents([(1, "a")]).limit(0)).count() == 0


def test_filter_never_forgets_and_deletes():
    rng = random.Random(1)
    keys = [rng.getrandbits(64) for _ in range(2_000)]
    f = CuckooFilter(3_000)
    assert all(f.insert(k) for k in keys)
    assert all(k in f for k in keys)
    assert sum(rng.getrandbits(64) in f for _ in range(5_000)) < 25
    assert all(f.delete(k) for k in keys[:1_000])
    assert all(k in f for k in keys[1_000:])
    assert sum(k in f for k in keys[:1_000]) < 20


def test_overflow_resizes_from_stored_keys():
    shard = Shard(capacity=16)
    keys = [(hashlib.sha256(str(i).encode()).digest(), i, i) for i in range(5_000)]
    for i, k in enumerate(keys):
        shard.add(k, 1, i)
    assert shard.capacity > 16 and len(shard.keys) == 5_000
    assert all(shard._hash(k) in shard.filter for k in keys)


def test_false_hits_are_verified():
    shard = Shard()
    a = (b"\1" * 32, 1, 5)
    shard.add(a, 3, 7)
    shard.add((b"\1" * 32, 2, 5), 3, 8)  # the same mark, other content
    assert len(shard.keys) == 2 and shard.remove(a) and not shard.remove(a)
    assert len(shard.keys) == 1


def test_index_takes_inserts_and_deletes(documents):
    keys = exact_dedup.content_keys
    index = exact_dedup.build_index(keys(documents([(1, "a"), (2, "a"), (3, "b")])), 2)
    changed = exact_dedup.change_index(index, keys(documents([(4, "a"), (5, "c")])), keys(documents([(2, "a"), (3, "b")])), 2)
    got = {(r.keep_id, r.group_size) for r in changed.collect()}
    assert got == {(1, 2), (5, 1)}


def test_null_ids_beside_equal_texts(documents):
    """A null id sorts after every id; it stays only when it alone has the most code points."""
    rows = [(None, ""), (5, None), (None, "a b"), (7, "ab"), (None, "long  text"), (9, "longtext")]
    got = sorted(((r.doc_id is None, r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(documents(rows)).collect()),
                 key=repr)
    # "" and null tie at 0 code points: 5 stays; "a b" and "long  text" have more code points than their copies.
    assert got == sorted([(True, None, 5, 2, None), (False, 5, 5, 2, True), (True, None, None, 2, None), (False, 7, None, 2, False),
                          (True, None, None, 2, None), (False, 9, None, 2, False)], key=repr)
