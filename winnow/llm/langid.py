"""Language identification with bit-sliced Bloom filters of byte n-grams.

For every language the most typical n-grams of a training sample are put into a Bloom
filter.  The filters of all languages are sliced by bit: position p of the table holds
a mask with one bit per language, so one look at two positions returns the set of all
languages that contain an n-gram.  A text's masks are counted per language over all its
n-grams.  A count is corrected by the filter's own rate of false answers, which is the
square of its share of set bits; the largest corrected share decides.

Fitting is bounded: about ``sample_docs`` labelled documents per language, drawn by a
hash of their id, and ``most`` n-grams per language.  Prediction reads the
whole of every text.

Defined cases: ``und`` with score 0 for a null text or one without a letter, and when
nothing was learned; a text shorter than an n-gram, or without a known n-gram, gets the
first language with the score of an even guess; equal shares go to the first language;
repeated rows are predicted each; an empty table gives an empty result; only the named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.sampling import bounded_sample, remainder
from winnow.operators.ranks import top_k

GRAM = 4
SAMPLE_DOCS = 1_000
GRAMS = 20_000
TABLE_BITS = 18
# An n-gram belongs to a language if it is at least this often there, against the
# language where it is most frequent.
TYPICAL = 0.2
PREDICTIONS = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass(frozen=True)
class Model:
    """Bit-sliced filters; ``wrong`` is the rate of false answers per language."""

    langs: list[str]
    masks: np.ndarray
    wrong: np.ndarray


def joined_bytes(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column with the start and length of each value."""
    kind = np.int64 if str(column.type).startswith("large") else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets[:-1], np.diff(offsets)


def grams(data: np.ndarray) -> np.ndarray:
    """Mixed 32-bit hashes of the n-gram at every place of ``data``."""
    n = max(0, len(data) - GRAM + 1)
    code = np.zeros(n, np.uint32)
    for i in range(GRAM):
        code |= data[i:i + n].astype(np.uint32) << np.uint32(8 * i)
    code *= np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77)
    return code


def positions(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    second = codes * np.uint32(0xC2B2AE3D)
    shift = np.uint32(32 - bits)
    return codes >> shift, second >> shift


def _count(batches: Iterator) -> Iterator:
    """Sampled texts to counts ``(lang, gram, n)``."""
    import pyarrow as pa

    for batch in batches:
        data, starts, sizes = joined_bytes(batch.column(1))
        of: dict[str, list] = {}
        for lang, a, n in zip(batch.column(0).to_pylist(), starts.tolist(), sizes.tolist()):
            of.setdefault(lang, []).append(grams(data[a:a + n]))
        for lang, codes in of.items():
            found, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"])


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, most: int = GRAMS, bits: int = TABLE_BITS,
        typical: float = TYPICAL) -> Model:
    """Learns from ``(doc_id, text, lang)``; at most 64 languages, the most frequent n-grams of each."""
    usable = labelled.where("lang is not null and text is not null")
    sample = bounded_sample(usable, "lang", sample_docs).select("lang", F.lower("text").alias("text"))
    counts = sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = top_k(counts.where("n > 1"), ["lang"], [F.desc("n"), F.col("gram")], 2 * most).select("lang", "gram", "n").toPandas()
    langs = sorted(set(rows.lang))
    if len(langs) > 64:
        raise ValueError("at most 64 languages fit a mask")
    known, at = np.unique(rows.gram.to_numpy(np.int64), return_inverse=True)
    lang = np.searchsorted(langs, rows.lang.to_numpy(str)) if langs else np.zeros(0, int)
    share = np.zeros((len(langs), len(known)))
    share[lang, at] = rows.n
    share /= np.maximum(share.sum(1, keepdims=True), 1)
    member = (share > 0) & (share >= typical * share.max(0, initial=0))
    masks = np.zeros(1 << bits, np.uint64)
    for i in range(len(langs)):
        own = np.flatnonzero(member[i])
        own = own[np.argsort(-share[i, own], kind="stable")][:most]
        for place in positions(known[own].astype(np.uint32), bits):
            np.bitwise_or.at(masks, place, np.uint64(1 << i))
    width = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(t).itemsize * 8 >= max(1, len(langs)))
    fill = np.array([((masks >> np.uint64(i)) & np.uint64(1)).mean() for i in range(len(langs))])
    return Model(langs, masks.astype(width), fill ** 2)


def scores(model: Model, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Corrected share of known n-grams, ``texts x languages``."""
    out = np.zeros((len(starts), len(model.langs)))
    bits = int(len(model.masks)).bit_length() - 1
    one = model.masks.dtype.type(1)
    for row, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
        total, hits = n - GRAM + 1, np.zeros(len(model.langs))
        if total <= 0:
            continue
        for at in range(0, total, 1 << 16):
            first, second = positions(grams(data[a + at:a + min(n, at + (1 << 16) + GRAM - 1)]), bits)
            found = model.masks[first] & model.masks[second]
            for i in range(len(model.langs)):
                hits[i] += np.count_nonzero(found & (one << model.masks.dtype.type(i)))
        out[row] = np.maximum(0, hits / total - model.wrong) / (1 - model.wrong)
    return out


def _predict(model: Model):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, starts, sizes = joined_bytes(batch.column(3))
            share = scores(model, data, starts, sizes)
            letters = np.array(batch.column(2).to_pylist(), bool)
            if model.langs:
                best = share.argmax(1)
                total = share.sum(1)
                score = np.where(total > 0, share.max(1) / np.where(total > 0, total, 1), 1 / len(model.langs))
                names = [model.langs[b] if x else "und" for b, x in zip(best.tolist(), letters.tolist())]
            else:
                score, names = np.zeros(len(letters)), ["und"] * len(letters)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(np.where(letters, score, 0.0))],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """Predictions for every row, from its whole text alone."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"),
                       text.rlike(r"\p{L}").alias("letters"), F.lower(text).alias("text"))
    return rows.mapInArrow(_predict(model), PREDICTIONS)


def identify(docs: DataFrame, **options) -> DataFrame:
    """Fits on the documents that are not held out and predicts all."""
    held_out = remainder("doc_id", 3) == 1
    return predict(docs, fit(docs.where(~held_out), **options), held_out)
