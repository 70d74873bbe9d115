"""Byte-level BPE through a sentencepiece model written from a rank file.

Method.  Every entry of a tiktoken rank file is a byte string.  Bytes are written as
the printable letters of byte-level vocabularies (``tokens.byte_letters``), so each
entry becomes a sentencepiece piece.  The model is serialised directly as a
``ModelProto``: type BPE, the pieces in rank order scored by minus their rank, one
unknown piece after them, identity normalisation without dummy prefix, white-space
removal or escaping.  Sentencepiece merges the adjacent pair whose joint piece scores
highest, leftmost first on ties; with score = -rank that is the order in which tiktoken
merges (lowest rank, leftmost first).  A text is cut into pre-tokens by the pattern and
each pre-token is encoded on its own; a pre-token that is itself an entry is that entry,
as tiktoken does.  Piece ids are turned into ranks by a table, and decoding maps every
piece back to its bytes by the inverse of the byte letters.

Defined cases: a null text is empty (no ids, digests of empty input); texts of any
length are encoded whole; repeated rows give a row each; special-token strings in a
text are ordinary text; an empty table gives an empty result.  A rank file that lacks
a single byte cannot encode every text and is refused when the model is built.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from winnow.llm.tokens import byte_letters

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
UNKNOWN = "⁇unk"  # no byte letter is U+2047, so no entry can take this name
SEPARATOR = "\udcff"  # byte 0xFF under surrogateescape; valid UTF-8 text never holds it
SEPARATOR_LETTER = "⁇"  # not a letter of any byte
CACHE_LIMIT = 200_000  # distinct pre-tokens remembered per task, with their ids and decoded bytes


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ``i`` is the entry of ``i``-th lowest rank."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the rank file lacks {len(missing)} single bytes, e.g. {missing[0]}")
    letters = _letter_table()
    model = pb.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda kv: kv[1]):
        piece = model.pieces.add()
        piece.piece = token.decode("latin-1").translate(letters)
        piece.score = -float(rank)
        piece.type = pb.ModelProto.SentencePiece.NORMAL
    unknown = model.pieces.add()
    unknown.piece, unknown.score, unknown.type = UNKNOWN, 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    spec = model.trainer_spec
    spec.model_type = pb.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(model.pieces) - 1, -1, -1, -1
    spec.byte_fallback = False
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = False
    norm.remove_extra_whitespaces = False
    norm.escape_whitespaces = False
    return model.SerializeToString()


def _letter_table() -> dict[int, str]:
    """Byte value (as a Latin-1 character) to its letter, for ``str.translate``."""
    return {b: letter for letter, b in byte_letters().items()}


class ByteBPE:
    """Encodes and decodes texts with the ranks of one file."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        self.unknown_id = self.processor.unk_id()
        self.rank_of_piece = np.asarray(sorted(ranks.values()) + [-1], dtype=np.int64)
        self.letters = _letter_table() | {0xFF: SEPARATOR_LETTER}
        self.bytes_of_rank = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.bytes_of_rank[r] = t
        self.byte_length = np.fromiter(map(len, self.bytes_of_rank), np.int64, len(self.bytes_of_rank))
        self.split = regex.compile(pattern).findall
        self.packed: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}
        # Entries that their own merges do not reach are taken whole when a pre-token equals them.
        entries = sorted(ranks, key=ranks.get)
        table = _letter_table()
        lettered = [t.decode("latin-1").translate(table) for t in entries]
        ids = np.asarray(self.processor.encode(SEPARATOR_LETTER.join(lettered)), np.int64)
        cut = np.flatnonzero(ids == self.unknown_id)
        alone = np.diff(np.r_[-1, cut, len(ids)]) == 2  # exactly one id between separators
        first = self.rank_of_piece[ids[np.r_[0, cut + 1]]]
        reached = alone & (first == np.asarray([ranks[t] for t in entries]))
        self.unreachable = {s: ranks[t] for t, s, ok in zip(entries, lettered, reached.tolist()) if not ok}

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pre-tokens not seen yet, packed, and the bytes that decoding those ids gives.

        The new pre-tokens go to the model in one string, joined by byte 0xFF, which UTF-8
        never holds; it is written as a letter that no piece has, so no merge crosses it and
        it comes back as the unknown id, which marks where each pre-token's ids end.
        """
        distinct = set(pieces)
        packed = self.packed
        if len(packed) + len(distinct) > CACHE_LIMIT:
            packed.clear()  # before choosing what to encode, so that nothing chosen as known is lost
            self.decoded.clear()
        todo = [p for p in distinct if p not in packed]
        if not todo:
            return
        joined = SEPARATOR.join(todo).encode("utf-8", "surrogateescape").decode("latin-1").translate(self.letters)
        ids = np.asarray(self.processor.encode(joined), np.int64)
        cut = ids == self.unknown_id
        if int(cut.sum()) != len(todo) - 1:
            raise ValueError("a pre-token holds a character outside the byte letters")
        counts = np.diff(np.r_[-1, np.flatnonzero(cut), len(ids)]) - 1
        ranks = self.rank_of_piece[ids[~cut]]
        token_at = np.r_[0, np.cumsum(counts)]
        byte_at = np.r_[0, np.cumsum(self.byte_length[ranks])][token_at]
        every_id = ranks.astype("<u4").tobytes()
        every_byte = self.decode(ranks.tolist())
        for p, t0, t1, b0, b1 in zip(todo, token_at[:-1].tolist(), token_at[1:].tolist(), byte_at[:-1].tolist(), byte_at[1:].tolist()):
            packed[p] = every_id[4 * t0:4 * t1]
            self.decoded[p] = every_byte[b0:b1]
        if self.unreachable:
            for p in todo:
                rank = self.unreachable.get(p.encode("utf-8").decode("latin-1").translate(self.letters))
                if rank is not None:
                    packed[p], self.decoded[p] = struct.pack("<I", rank), self.bytes_of_rank[rank]

    def encode_packed(self, text: str) -> tuple[bytes, bytes]:
        """Ids of the text as little-endian unsigned 32-bit integers, and the bytes decoded from them.

        Decoding maps ids to bytes piece by piece, so the decoded text is the concatenation of
        what the ids of each pre-token decode to; that is computed once per distinct pre-token.
        """
        pieces = self.split(text)
        self._learn(pieces)
        return b"".join(map(self.packed.__getitem__, pieces)), b"".join(map(self.decoded.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        """Ranks of the text."""
        packed, _ = self.encode_packed(text)
        return np.frombuffer(packed, "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of_rank.__getitem__, ids))


def _codec_rows(path: str, pattern: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = ByteBPE(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed, decoded = codec.encode_packed(text or "")
                rows.append((doc_id, len(packed) // 4, hashlib.sha256(packed).hexdigest(),
                             hashlib.sha256(decoded).hexdigest()))
            columns = list(zip(*rows)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes, one row per document."""
    return docs.select("doc_id", "text").mapInArrow(_codec_rows(path, pattern), SCHEMA)
