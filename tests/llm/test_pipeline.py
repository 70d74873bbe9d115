from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tokenizers import Tokenizer

from test_line_dedup import slow as slow_lines
from test_mixing import slow_targets, table
from test_simhash import slow_groups, slow_print

from winnow.llm import packing
from winnow.llm.table_queries import word_vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_each_other(spark, small, tmp_path):
    """Each stage against a brute-force form of it, on what its predecessor kept."""
    read = lambda d: spark.read.parquet(d)
    docs, out = read(f"{small}/documents.parquet"), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        docs = read(f"{tmp_path}/{name}")
        out[name] = docs.collect()
        assert name == "packing" or docs.columns == COLUMNS
    before = {r.doc_id: r for r in read(f"{small}/documents.parquet").collect()}
    good = {r.doc_id: r for r in out["quality"]}
    assert all(before[i] == r for i, r in good.items()) and 0 < len(good) < len(before)
    marks = {r.doc_id: r.quality for r in read(f"{small}/labels.parquet").collect()}
    clean = [i for i, q in marks.items() if q == 1]
    assert sum(i in good for i in clean) > 0.95 * len(clean)

    want = slow_lines([(i, r.text) for i, r in good.items()])
    left = {}
    for i, r in good.items():
        lines = (r.text or "").split("\n")
        left[i] = "\n".join(x for n, x in enumerate(lines) if want.get((i, n), (i, n)) == (i, n))
    lined = {r.doc_id: r for r in out["lines"]}
    assert {i: r.text for i, r in lined.items()} == left
    assert all(r.n_chars == len(r.text) for r in lined.values())

    groups = slow_groups({i: slow_print(r.text) for i, r in lined.items()})
    single = {r.doc_id: r for r in out["near_duplicates"]}
    assert sorted(single) == sorted(set(groups.values())) and len(single) == len(out["near_duplicates"])
    assert all(lined[i] == r for i, r in single.items())

    rows = [(i, r.text, r.source) for i, r in single.items()]
    targets, sizes = slow_targets(table(rows)), table(rows)
    n = Counter(r.doc_id for r in out["mixing"])
    assert all(r == single[r.doc_id] for r in out["mixing"])
    for i, r in single.items():
        rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert int(rate) <= n[i] <= int(rate) + (rate > int(rate))

    # Packing gets documents more than once: their pieces are told apart by sequence and place.
    texts = {r.doc_id: r.text for r in out["mixing"]}
    pieces = Counter((r.doc_id, r.piece) for r in out["packing"])
    assert all(pieces[i, p] == n[i] for i, p in pieces) and {i for i, _ in pieces} == set(texts)
    once, seen = [], set()
    for r in out["packing"]:
        if (r.doc_id, r.piece) not in seen:
            seen.add((r.doc_id, r.piece))
            once.append(r)
    total = Counter()
    for r in out["packing"]:
        total[r.sequence_id] += r.length
    assert max(total.values()) <= packing.CAPACITY
    whole = Tokenizer.from_file(word_vocabulary())
    for i, text in texts.items():
        own = sorted((r.piece, r.length) for r in once if r.doc_id == i)
        assert sum(k for _, k in own) == len(whole.encode(text, add_special_tokens=False).ids) + 1



def test_run_returns_the_last_stage(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0 and corpus_pipeline.ORACLE_SQL is None
