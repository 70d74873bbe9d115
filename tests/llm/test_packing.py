from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from winnow.llm import packing
from winnow.llm.table_queries import op7_packing, word_vocabulary
from winnow.llm.tokens import WordTokens, word_tokens


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(word_vocabulary())


def check(rows, texts, whole, capacity):
    """Every document in full, every sequence gapless and within its capacity."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == texts.keys()
    for doc_id, own in pieces.items():
        ids = whole.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == list(range(0, len(ids), capacity))
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + capacity], "<u4").tobytes())
            assert r.length == len(ids[r.start:r.start + capacity])
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_query_on_all_documents(spark, small, whole):
    rows = op7_packing(spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    n = check(rows, texts, whole, packing.CAPACITY)
    least = -(-sum(r.length for r in rows) // packing.CAPACITY)
    assert n <= least * 1.02 + 1


@pytest.mark.parametrize("extra", [False, True])
def test_edge_texts(documents, whole, extra):
    texts = {1: None, 2: "", 3: " \n ", 4: "One word", 5: "long text " * 3_000, 6: "É x y\x1cz w", 7: "it's 12 o'clock <|endoftext|> x",
             8: "ẞ Σας ŒUVRE İstanbul é ﬁ İ", 9: "!!! ,,, ... 日本語 😀😀", 10: "a_b-c.d!e don't WE'LL"}
    df = documents(list(texts.items()), extra)
    check(packing.pack_documents(df, word_vocabulary()).collect(), texts, whole, packing.CAPACITY)
    # A text that fills its sequence to the last token leaves no empty piece.
    full = {1: " ".join(["the"] * 2047)}
    rows = packing.pack_documents(documents(list(full.items())), word_vocabulary()).collect()
    assert [r.length for r in rows] == [2048]


def test_direct_route_gives_the_library_ids(whole, spark, small):
    tokens = WordTokens(word_vocabulary())
    assert tokens.direct
    rng = random.Random(3)
    words = {w for r in spark.read.parquet(f"{small}/documents.parquet").collect() for w in (r.text or "").split()}
    words |= {"".join(rng.choice("abcdefghijklmnopqrstuvwxyzÀÉÖßÿ.,!") for _ in range(rng.randrange(1, 30))) for _ in range(5_000)}
    for word in sorted(words):
        assert np.frombuffer(tokens.encode(word), "<u4").tolist() == whole.encode(word, add_special_tokens=False).ids, word


def test_best_fit_takes_the_tightest_bin():
    assert packing.best_fit([6, 5, 4, 3, 2], 10) == [[0, 2], [1, 3, 4]]
    rng = random.Random(1)
    sizes = sorted((rng.randrange(1, 101) for _ in range(5_000)), reverse=True)
    bins = packing.best_fit(sizes, 100)
    assert sorted(p for b in bins for p in b) == list(range(5_000))
    assert max(sum(sizes[p] for p in b) for b in bins) <= 100
    assert len(bins) <= -(-sum(sizes) // 100) * 1.02


def pieces(spark, lengths, parts):
    rows = [(i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, packing.PIECES).repartition(parts)


def test_underfull_sequences_are_merged_over_rounds(spark):
    rng = random.Random(8)
    lengths = [rng.randrange(1, 700) for _ in range(3_000)]
    sequences = packing.pack(pieces(spark, lengths, 24), fan_in=4).collect()
    assert max(r.round for r in sequences) >= 2
    assert sum(len(r.pieces) for r in sequences) == 3_000 and max(r.fill for r in sequences) <= 2048
    assert len(sequences) <= -(-sum(lengths) // 2048) * 1.01 + 1


def test_items_that_never_fit_together_end_the_rounds(spark):
    sequences = packing.pack(pieces(spark, [1_100] * 500, 10), task_items=50).collect()
    assert len(sequences) == 500


def test_small_tasks_hold_few_items(spark):
    rng = random.Random(2)
    lengths = [rng.randrange(1, 300) for _ in range(2_000)]
    sequences = packing.pack(pieces(spark, lengths, 4), task_items=100).collect()
    assert sum(len(r.pieces) for r in sequences) == 2_000
    assert len(sequences) <= -(-sum(lengths) // 2048) * 1.15


def test_repeated_rows_and_empty_table(documents, whole):
    rows = packing.pack_documents(documents([(1, "same"), (1, "same"), (None, "x")]), word_vocabulary()).collect()
    assert len(rows) == 3
    assert packing.pack_documents(documents([(1, "a")]).limit(0), word_vocabulary()).count() == 0


def test_an_encoder_is_built_once_per_worker():
    assert word_tokens(word_vocabulary()) is word_tokens(word_vocabulary())
