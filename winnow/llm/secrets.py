"""Secret scan: keyword automaton, anchored expressions near its hits, checksums.

One pass of an Aho-Corasick automaton finds the keywords of every kind that has one.
Expressions are then tried only at those places, never along the text.  Runs of hex
digits have no keyword and are found by their own expression.  Tokens that carry a
checksum are reported only if it holds.

Work is done on the bytes of the text: every pattern is ASCII, so bytes of other
characters never match.  Positions are turned into code points at the end.

Defined cases: a null or empty text has no span; texts of any length are scanned as
a whole; repeated rows are reported each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

# Kinds and patterns of the contract.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
# Prefixes of published token formats whose last six characters are the
# base-62 CRC-32 of the thirty before.
CHECKED_PREFIXES = {"github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",)}
CHECKED_KINDS = tuple(CHECKED_PREFIXES)
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def base62_crc32(body: str) -> str:
    n, out = zlib.crc32(body.encode("ascii")), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


class Scanner:
    """Finds ``(start, kind order, kind, end)`` in one text, offsets in code points."""

    def __init__(self) -> None:
        import ahocorasick

        self.assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(HEX.encode())
        self.checked = re.compile(r"[A-Za-z]{3}_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
        self.order = {k: i for i, k in enumerate((*BASE_KINDS, *CHECKED_KINDS))}
        self.automaton = ahocorasick.Automaton()
        words = [("assign", w) for w in ASSIGN_WORDS] + [("access", "akia")]
        words += [(kind, p) for kind, prefixes in CHECKED_PREFIXES.items() for p in prefixes]
        for kind, word in words:
            self.automaton.add_word(word, (kind, len(word)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, str, int]]:
        data = text.encode("utf-8", "surrogatepass")
        found: list[tuple[int, int, str, int]] = []
        # Latin-1 gives one character per byte, and bytes.lower() touches A-Z only.
        hits = [(end + 1 - size, kind) for end, (kind, size) in
                self.automaton.iter(data.lower().decode("latin-1"))]
        if hits:
            plain = data.decode("latin-1")
            after = dict.fromkeys((*BASE_KINDS, *CHECKED_KINDS), 0)
            for start, kind in sorted(hits):
                if start < after[kind]:
                    continue  # inside the match before
                end = getattr(self, f"_{kind}", self._with_checksum)(plain, start, after, kind)
                if end:
                    found.append((start, self.order[kind], kind, end))
        found += [(m.start(), self.order["hex"], "hex", m.end()) for m in self.hex.finditer(data)]
        found.sort()
        if found and len(data) != len(text):
            starts = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
            place = lambda p: int(starts[p - 1]) if p else 0
            found = [(place(s), o, k, place(e)) for s, o, k, e in found]
        return found

    def _assign(self, plain: str, start: int, after: dict, kind: str) -> int:
        m = self.assign.match(plain, start)
        if not m:
            return 0
        after[kind] = m.end()  # a match that fails below is used up too
        return m.end() if m.end(2) - m.start(2) >= 6 else 0

    def _access(self, plain: str, start: int, after: dict, kind: str) -> int:
        m = self.access.match(plain, start)
        if not m:
            return 0
        after[kind] = m.end()
        return m.end() if m.end() - start >= 20 else 0

    def _with_checksum(self, plain: str, start: int, after: dict, kind: str) -> int:
        m = self.checked.match(plain, start)
        if not m or not plain.startswith(CHECKED_PREFIXES[kind], start) or base62_crc32(m[1]) != m[2]:
            return 0
        after[kind] = m.end()
        return m.end()


def _scan(batches: Iterator) -> Iterator:
    import pyarrow as pa

    scanner = Scanner()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            spans = scanner.spans(text.as_py() or "")
            base = [f"{k}:{s}:{e}" for s, o, k, e in spans if o < len(BASE_KINDS)]
            counts = [sum(o == i for _, o, _, _ in spans) for i in range(len(BASE_KINDS))]
            digest = hashlib.sha256(",".join(base).encode()).hexdigest()
            rows.append((doc_id, *counts, digest, ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)))
        columns = list(zip(*rows)) or [[]] * 6
        types = [pa.int64()] * 4 + [pa.string()] * 2
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans, one row per document."""
    return docs.select("doc_id", "text").mapInArrow(_scan, SCHEMA)
