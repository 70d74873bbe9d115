from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from winnow.llm import langid, neighbours, quality
from winnow.llm.model_queries import op3_language_id, op4_neighbours, op9_quality
from winnow.llm.sampling import bounded_sample


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def talk(rng, letters, n=60):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def three_languages():
    rng = random.Random(1)
    kinds = {"aa": "abcde", "bb": "fghijé", "cc": "klmnß"}
    return [(i, talk(rng, kinds[lang]), lang, "s") for i in range(300) for lang in [rng.choice(list(kinds))]]


def test_languages_are_told_apart(documents, three_languages):
    long_text = three_languages[0][1] + " " + "1 2 3 " * 100_000 + three_languages[0][1]
    odd = [(1_000, None, "aa", "s"), (1_001, "", "aa", "s"), (1_002, "123 !?", "aa", "s"), (1_003, "ab", None, "s"), (1_004, "日本語", None, None),
           (1_005, long_text, None, "s"), (7, three_languages[7][1], "aa", "s")]
    got = {(r.doc_id): r for r in langid.identify(documents(three_languages + odd, extra=True)).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang, _ in three_languages if i != 7)
    assert all(got[i].held_out == (remainder(i, 3) == 1) and 0 <= got[i].score <= 1 for i in got)
    assert [got[i].lang_pred for i in (1_000, 1_001, 1_002)] == ["und"] * 3 and got[1_000].score == 0
    assert got[1_003].lang_pred in ("aa", "bb", "cc") and got[1_004].lang_pred in ("aa", "bb", "cc")
    assert got[1_005].lang_pred == three_languages[0][2]


def test_held_out_languages_teach_nothing(documents, three_languages):
    wrong = [(i, t, "zz" if remainder(i, 3) == 1 else lang, s) for i, t, lang, s in three_languages]
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents(three_languages)).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents(wrong)).collect()}


def test_nothing_learned_and_empty_table(documents):
    got = langid.identify(documents([(1, "abc", None, "s"), (2, None, None, "s")])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert langid.identify(documents([(1, "a", "aa", "s")]).limit(0)).count() == 0


def test_false_positives_are_corrected():
    rng = np.random.default_rng(1)
    masks = rng.integers(0, 2, 1 << 12, dtype=np.uint64).astype(np.uint8)
    model = langid.Model(["aa"], masks, np.array([masks.mean() ** 2]))
    data = rng.integers(97, 123, 200_000, dtype=np.uint8)
    share = langid.scores(model, data, np.array([0]), np.array([len(data)]))
    assert share[0, 0] < 0.02


def test_language_query_on_held_out_rows(spark, small):
    got = op3_language_id(spark, small).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    held = [r for r in got if r.held_out and langs[r.doc_id]]
    assert len(got) == len(langs) and np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.95


def test_sample_is_bounded(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 50, "rare").otherwise("common").alias("k"))
    n = {r["k"]: r["count"] for r in bounded_sample(df, "k", 500).groupBy("k").count().collect()}
    assert n["rare"] == 50 and 380 < n["common"] < 620


def test_network_gradients():
    rng = np.random.default_rng(2)
    net = quality.Network(1)
    for p in net.parameters():
        p += rng.normal(0, 0.3, p.shape).astype(np.float32)
    chunks = rng.integers(0, 256, (5, quality.CHUNK)).astype(np.uint8)
    doc, label, weight = np.array([0, 0, 1, 2, 2]), np.array([0.0, 1.0, 1.0], np.float32), np.array([1.0, 2.0, 1.0])

    def loss():
        pooled = net.pooled(chunks)
        out = 0.0
        for d in range(3):
            own = pooled[doc == d]
            p = net.probability(own.mean(0)[None], own.max(0)[None])[0]
            out -= weight[d] * np.log(p if label[d] else 1 - p) / 3
        return out

    grads = net.gradients(chunks, doc, label, weight)
    for p, g in zip(net.parameters(), grads):
        direction = g / (np.linalg.norm(g) + 1e-12)
        step = 1e-3
        p += step * direction
        up = loss()
        p -= 2 * step * direction
        down = loss()
        p += step * direction
        assert (up - down) / (2 * step) == pytest.approx(float(np.linalg.norm(g)), rel=0.08, abs=1e-3)


@pytest.mark.parametrize("size", [0, 1, 7, 8, 448, 511, 512, 513, 960, 961, 200_000])
def test_chunks_cover_every_byte(size):
    starts = quality.chunk_starts(size)
    covered = np.zeros(size, bool)
    for s in starts:
        covered[s:s + quality.CHUNK] = True
    assert len(starts) >= 1 and covered.all()
    assert all(b - a == quality.STEP for a, b in zip(starts, starts[1:]))


def test_score_is_that_of_all_chunks_at_once():
    net = quality.Network(4)
    net.out += np.random.default_rng(0).normal(size=net.out.shape).astype(np.float32)
    data = np.random.default_rng(1).integers(0, 256, 150_000).astype(np.uint8)
    pooled = net.pooled(quality.chunks_of(data, quality.chunk_starts(len(data))))
    assert net.score(data) == pytest.approx(float(net.probability(pooled.mean(0)[None], pooled.max(0)[None])[0]), abs=1e-4)


@pytest.mark.parametrize("extra", [False, True])
def test_classifier_learns_and_keeps(documents, spark, extra):
    rng = random.Random(3)
    rows = [(i, talk(rng, "abcdefg", 200) if i % 4 else talk(rng, "ABCDEFG!#", 200), None, None) for i in range(240)]
    rows += [(900, None), (901, ""), (902, talk(rng, "abcdefg", 60_000)), (1, rows[1][1])]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(240)] + [(None, 1), (950, None)], "doc_id long, label int")
    df = documents(rows, extra)
    got = {r.doc_id: r for r in quality.scored(df, labels, steps=150).collect()}
    held = [i for i in range(240) if remainder(i, 5) == 0]
    assert all(got[i].held_out == (i in held) for i in range(240))
    assert np.mean([got[i].predicted == int(i % 4 > 0) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values()) and got[902].predicted == 1
    kept = quality.kept(df, quality.learnt(df, labels, steps=150))
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if r.predicted}
    # Labels of held-out documents teach nothing.
    flipped = labels.withColumn("label", F.when(quality.remainder("doc_id", 5) == 0, 1 - F.col("label")).otherwise(F.col("label")))
    shares = [np.concatenate([p.ravel() for p in quality.learnt(df, x, steps=5).parameters()]) for x in (labels, flipped)]
    assert np.array_equal(*shares)


def test_training_sees_every_chunk(documents, spark):
    # Ten chunks each; what tells the labels apart stands in the fifth or the eighth only.
    rng, rows = random.Random(8), []
    for i in range(300):
        text = talk(rng, "abcdefg", 1_200)[:9 * quality.STEP + quality.CHUNK]
        at = (4 if rng.random() < 0.5 else 7) * quality.STEP + 100
        rows.append((i, text if i % 2 else text[:at] + "#!ABCDEF" * 25 + text[at + 200:]))
    assert {len(quality.chunk_starts(len(t))) for _, t in rows} == {10}
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, label int")
    got = quality.scored(documents(rows), labels, steps=100).where("held_out").collect()
    assert len(got) > 30 and np.mean([r.predicted == r.doc_id % 2 for r in got]) > 0.95


@pytest.mark.parametrize("longer", [False, True])
def test_held_out_accuracy_of_short_and_long_texts(spark, longer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    size = F.octet_length("text") - (quality.CHUNK - quality.STEP) > 4 * quality.STEP
    ids = {r.doc_id for r in docs.where(size == longer).select("doc_id").collect()} & marks.keys()
    got = [r for r in op9_quality(spark, "/root/testdata/sf0.01").where("held_out").collect() if r.doc_id in ids]
    assert len(got) >= 20 and np.mean([r.predicted == marks[r.doc_id] for r in got]) > 0.95


def test_classifier_without_labels_and_rows(documents, spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    got = quality.scored(documents([(1, "a"), (2, None)]), none).collect()
    assert [r.score for r in got] == [0.5, 0.5]
    assert quality.scored(documents([(1, "a")]).limit(0), none).count() == 0


def test_quality_query(spark, small):
    got = {r.doc_id: r for r in op9_quality(spark, small).collect()}
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{small}/documents.parquet").count()
    assert np.mean([got[i].predicted == q for i, q in marks.items() if not got[i].held_out]) > 0.9


def exact(rows, k, asks):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for i in {i for i in ids.tolist() if asks(i)}:
        score = (vectors * vectors[np.flatnonzero(ids == i)[0]]).sum(1)
        best = {}
        for j, s in zip(ids.tolist(), score.tolist()):
            if j != i:
                best[j] = max(best.get(j, -np.inf), s)
        out[i] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


@pytest.mark.parametrize("scale", [0.0, 1.0])
def test_neighbours_of_clustered_vectors(spark, scale):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(40, 24))
    vectors = centers[rng.integers(0, 40, 6_000)] + rng.normal(0, 0.25, (6_000, 24))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors *= np.exp(scale * rng.normal(0, 0.3, (6_000, 1)))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS role").repartition(4)
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, 20).collect()
    want = exact(rows, 20, lambda i: i % 20 == 0)
    near = {}
    for r in got:
        near.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert near.keys() == want.keys()
    hits = 0
    for q, found in near.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and [s for _, _, s in found] == sorted((s for _, _, s in found), reverse=True)
        assert len({v for _, v, _ in found} | {q}) == 21
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_the_search_ends_early_on_clustered_vectors():
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(200, 32))
    vectors = centers[rng.integers(0, 200, 20_000)] + rng.normal(0, 0.1, (20_000, 32))
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    projection = np.random.default_rng(1).normal(size=(33, 8))
    tree = neighbours.Tree(np.arange(20_000), vectors, 1.0, projection)
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    tree.points = tree.points.view(Counted)
    for i in range(20):
        q = vectors[i].astype(np.float64)
        tree.nearest(i, q, q @ projection[:-1], 1.0, 20, neighbours.chi_square_quantile(0.95, 8))
    assert sum(seen) / (20 * 20_000) < 0.3


def test_vectors_that_take_no_part_copies_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(20, 2_500)] + [(0, [1.0, 0.0, 0.5]), (5, [2.0, 0.0, 0.0]), (5, [2.0, 0.0, 0.0]), (3, [0.0, -0.0, 1.0])]
    bad = [(40_000, None), (40_020, [0.0, 0.0, -0.0]), (40_040, [1.0, None, 2.0]), (40_060, [nan, 1.0, 1.0]), (40_080, [inf, 1.0, 1.0]), (40_100, [1.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(5)
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, 20).collect()
    want = exact(rows, 20, lambda i: i % 20 == 0)
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == want


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(df, F.col("vec_id") == 0, 20).collect()] == [(0, 1, 1, 3.0)]
    assert neighbours.search(df.limit(0), F.col("vec_id") == 0, 20).count() == 0


def test_neighbours_query(spark, small):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = op4_neighbours(spark, small).collect()
    want = exact(rows, 20, lambda i: i % 20 == 0)
    hits = sum(r.vec_id in dict(want[r.query_id]) for r in got)
    assert len(got) == 20 * len(want) and hits >= 0.9 * len(got)
    assert all(r.score == pytest.approx(dict(want[r.query_id])[r.vec_id], abs=1e-12) for r in got if r.vec_id in dict(want[r.query_id]))


def test_sliced_arrow_columns():
    column = pa.array(["ab", "", None, "é", "z"])[1:]
    data, starts, sizes = langid.joined_bytes(column)
    assert [bytes(data[a:a + n]) for a, n in zip(starts, sizes)] == [b"", b"", "é".encode(), b"z"]
