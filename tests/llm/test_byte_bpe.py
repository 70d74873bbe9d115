from __future__ import annotations

import hashlib

import numpy as np
import pytest

from winnow.llm import byte_bpe
from winnow.llm.sequence_queries import multilingual_ranks, op13_byte_bpe

TEXTS = [
    None, "", " ", "hello  world\n\n  x", "🙂 é中文 12345 's 'll 'S", "a" * 5000, " " * 100 + "\t\n", "<|endoftext|> <s>",
    "\udcff broken surrogate", "x y\u0085z", "Ünïcödé ÀÉÎ", "x" * 70_000 + " tail",
]


@pytest.fixture(scope="module")
def codecs():
    import tiktoken

    path, pattern = multilingual_ranks()
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    return byte_bpe.ByteBPE(path, pattern), reference


def expected(reference, text):
    ids = reference.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), ids


@pytest.mark.parametrize("text", TEXTS[:8] + TEXTS[9:], ids=range(len(TEXTS) - 1))
def test_ids_equal_tiktoken_and_decode_back(codecs, text):
    codec, reference = codecs
    ids = codec.encode(text or "")
    assert ids == reference.encode_ordinary(text or "")
    assert codec.decode(ids) == (text or "").encode("utf-8")


def test_merges_without_the_direct_route(codecs):
    """Every distinct pre-token of the given documents goes through the model's merges alone."""
    import pyarrow.dataset as ds

    codec, reference = codecs
    texts = ds.dataset("/root/testdata/sf0.001/documents.parquet").to_table().column("text").to_pylist()
    pieces = sorted({p for t in texts for p in codec.split(t or "")})
    lettered = [p.encode("utf-8").decode("latin-1").translate(codec.letters) for p in pieces]
    for piece, ids in zip(pieces, codec.processor.encode(lettered)):
        want = reference._encode_single_piece(piece.encode()) if hasattr(reference, "_encode_single_piece") else reference.encode_ordinary(piece)
        assert codec.rank_of_piece[ids].tolist() == list(want), piece


def test_missing_byte_is_refused(tmp_path):
    import base64

    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(255)))
    with pytest.raises(ValueError):
        byte_bpe.model_proto(byte_bpe.read_ranks(str(path)))


@pytest.mark.parametrize("extra", [False, True])
def test_rows_of_a_table(documents, codecs, extra):
    _, reference = codecs
    rows = list(enumerate(TEXTS[:8])) + [(3, TEXTS[3]), (None, TEXTS[4]), (50, TEXTS[11])]
    path, pattern = multilingual_ranks()
    got = byte_bpe.encode_documents(documents(rows, extra), path, pattern).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        n, digest, ids = expected(reference, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (n, digest)
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert byte_bpe.encode_documents(documents(rows).limit(0), path, pattern).count() == 0


def test_query_on_all_documents(spark, codecs):
    _, reference = codecs
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op13_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256) == expected(reference, texts[r.doc_id])[:2]
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_full_cache_loses_nothing(codecs, monkeypatch):
    _, reference = codecs
    path, pattern = multilingual_ranks()
    monkeypatch.setattr(byte_bpe, "CACHE_LIMIT", 5)
    codec = byte_bpe.ByteBPE(path, pattern)
    for text in ["a b c d", "a b e f g h", "a b c d", " ".join(map(str, range(40)))]:
        assert codec.encode(text) == reference.encode_ordinary(text)
