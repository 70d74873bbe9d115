"""Token ids of a word-wise BPE vocabulary file, fast on text that repeats its words.

The vocabulary splits at white space first, so a text is cut there and every distinct
chunk is tokenised once per task.  Chunks of Latin letters with trailing punctuation
take a direct route through a byte-pair encoder built from the same file; everything
else goes through the ``tokenizers`` library.  Both give the ids of
``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``; that needs each
vocabulary entry to be reachable by its own merges, which is checked when it is built.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from struct import pack

MOST_CHUNKS = 200_000
# Letters that NFC leaves alone and that have one lower-case letter each.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
ASCII_SPACE = r"[\x20\x09-\x0D]+"
# str.split() also cuts at these, the vocabulary's own expression may not.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
PUNCTUATION = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """The encoder of a vocabulary file, built once per Python worker and kept for its later tasks."""
    return WordTokens(path)


class WordTokens:
    """Ids of whole texts as little-endian 32-bit bytes."""

    END = b"\xff"  # stands for the end of a word; never occurs in UTF-8

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix, letters = model["end_of_word_suffix"], byte_letters()
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        ranks: dict[bytes, int] = {}
        for name, i in model["vocab"].items():
            if name in special:
                continue
            ends = name.endswith(suffix) and name != suffix
            body = name[:-len(suffix)] if ends else name
            ranks[bytes(letters[c] for c in body) + (self.END if ends else b"")] = i
        known = len(ranks)
        ranks[self.END] = max(ranks.values()) + 10
        self.piece = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.direct = known >= 256 and self._reachable(model["vocab"], suffix, special)
        self.simple = re.compile(f"([{LATIN}]*)([{PUNCTUATION}]*)")
        self.chunks: dict[str, bytes] = {}

    def _reachable(self, vocab: dict[str, int], suffix: str, special: set[str]) -> bool:
        """Whether every word ending of the vocabulary is what its own merges lead to."""
        tokenize = self.whole.model.tokenize
        ends = ((n[:-len(suffix)], i) for n, i in vocab.items()
                if n.endswith(suffix) and n != suffix and n not in special)
        return all([t.id for t in tokenize(name)] == [i] for name, i in ends)

    def _chunk(self, chunk: str) -> bytes:
        m = self.simple.fullmatch(chunk) if self.direct else None
        if m:
            ids = [i for part in m.groups() if part for i in self.piece(part.lower().encode() + self.END)]
        else:
            ids = self.whole.encode(chunk, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        parts = re.split(ASCII_SPACE, text) if OTHER_SPACE.search(text) else text.split()
        chunks = self.chunks
        if len(chunks) > MOST_CHUNKS:
            chunks.clear()
        for chunk in set(parts):
            if chunk not in chunks:
                chunks[chunk] = self._chunk(chunk)
        return b"".join([chunks[p] for p in parts])
