from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from winnow.llm import hard_negatives as hn
from winnow.llm.sequence_queries import OP12_SQL, op12_hard_negatives

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def test_four_russians_equals_products():
    rng = np.random.default_rng(3)
    for width, low, high in [(8, 0, 3), (64, -160, 160), (24, -1, 1), (16, -2000, 7)]:
        a = rng.integers(low, high + 1, (7, width))
        c = rng.integers(low, high + 1, (50, width))
        offset = min(low, 0)
        planes = max(1, (max(high, 0) - offset).bit_length())
        got = hn.four_russians(hn.subset_tables(a), hn.plane_bytes(c - offset, planes), offset, a.sum(axis=1))
        assert (got == a @ c.T).all()


def test_padded_rows_of_sliced_arrays():
    import pyarrow as pa

    arr = pa.array([[1, 2], [], [3, 4, 5], [6]], pa.list_(pa.int64())).slice(1, 3)
    assert hn._padded(arr, 4).tolist() == [[0, 0, 0, 0], [3, 4, 5, 0], [6, 0, 0, 0]]


def rows_for(seed, n, dims=16, labels=3, broken=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vec = [rng.uniform(-0.5, 0.5) for _ in range(dims)]
        label = rng.randrange(labels)
        if broken and i % 17 == 3:
            vec[rng.randrange(dims)] = rng.choice([None, math.nan, math.inf])
        if broken and i % 23 == 5:
            vec, label = (None, label) if i % 2 else (vec, None)
        rows.append((i * 5 if i % 9 else i * 50, vec, label))
    if broken:
        rows.append((None, [0.1] * dims, 1))
        rows += rows[:4]  # repeated rows
        rows.append((100_000, [0.25] * dims, 0))  # ties of scores
        rows.append((100_050, [0.25] * dims, 0))
    return rows


def as_tuples(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 4)
    monkeypatch.setattr(hn, "CANDIDATE_BLOCK", 64)
    rows = rows_for(seed, 400)
    df = spark.createDataFrame([(i, [None if v is None else float(v) for v in e] if e else e, l) for i, e, l in rows], SCHEMA)
    got = as_tuples(hn.mine(df.repartition(5)))
    # float32 storage: the brute force sees the stored values
    stored = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    want = sorted(hn.brute_force(stored))
    assert got == want and len(want) > 50


def test_extra_columns_and_empty(spark):
    rows = rows_for(5, 120, broken=False)
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.selectExpr("*", "1 AS row", "2 AS score", "'x' AS planes", "3 AS anchor_block", "4 AS q")
    assert as_tuples(hn.mine(clash)) == as_tuples(hn.mine(df))
    assert hn.mine(df.limit(0)).count() == 0
    assert hn.mine(df.where("vec_id % 50 <> 0")).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = as_tuples(op12_hard_negatives(spark, sf))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = sorted(tuple(r) for r in con.execute(OP12_SQL).fetchall())
    assert got == want and len(got) > 0


def test_pairs_of_blocks_stay_few_and_scores_exact_beyond_32_bits(spark):
    # 4 million vectors, 80,000 anchors: 40 x 62 pairs where blocks of 256 and 4,096 rows made 306,000.
    n_a, n_c = hn._block_count(80_000, hn.ANCHOR_BLOCK, hn.ANCHOR_BLOCK, 1), hn._block_count(4_000_000, hn.CANDIDATE_BLOCK, hn.LEAST_BLOCK, 36)
    assert n_a * n_c < 3_000 and hn._block_count(10_256, hn.CANDIDATE_BLOCK, hn.LEAST_BLOCK, 36) == 3
    anchors = spark.createDataFrame([(0, [1])], "anchor_block long, anchors array<long>")
    candidates = spark.createDataFrame([(0, [1])], "candidate_block int, candidates array<long>")
    assert hn._paired(anchors, candidates, 313, 977).rdd.getNumPartitions() <= hn.PAIR_PARTITIONS
    rng = np.random.default_rng(4)
    a, c = rng.integers(-2**22, 2**22, (70, 16)), rng.integers(-2**20, 2**20, (2 * hn._CHUNK + 5, 16))
    planes = (2 * 2**20).bit_length()
    got = hn.four_russians(hn.subset_tables(a), hn.plane_bytes(c + 2**20, planes), -2**20, a.sum(axis=1))
    assert (got == a @ c.T).all() and np.abs(got).max() > 2**31


def test_anchors_beyond_a_strip_match_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i) * 50, [float(x) for x in v], int(i) % 3) for i, v in enumerate(rng.uniform(-0.5, 0.5, (2 * hn.STRIP + 9, 8)))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert as_tuples(hn.mine(df)) == sorted(hn.brute_force([(r.vec_id, r.label, r.embedding) for r in df.collect()]))
