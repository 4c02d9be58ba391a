import math
import random
from collections import Counter

import pytest

from tollcast.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def plain_matches(text, items, threshold=D.THRESHOLD, least=D.OVERLAP):
    """Every item scored against every passage."""
    words = [D.words_of(t) for _, t in items]
    n, mean = sum(map(bool, words)), sum(map(len, words)) / max(1, sum(map(bool, words)))
    df = Counter(w for ws in words for w in set(ws))
    span, doc, out = max(map(len, words)), D.words_of(text), {}
    for p in range(max(1, math.ceil(len(doc) / span) - 1)):
        passage = doc[p * span:(p + 2) * span]
        held = set(passage)
        for (item, t), ws in zip(items, words):
            if not ws:
                continue
            score = {w: math.log1p((n - df[w] + .5) / (df[w] + .5)) * f * (D.K1 + 1)
                     / (f + D.K1 * (1 - D.B + D.B * len(ws) / mean)) for w, f in Counter(ws).items()}
            s = sum(v for w, v in score.items() if w in held) / sum(score.values())
            q, a = D.question_and_answer(t)
            if len(ws) < D.SHINGLE:  # as one run of words
                q, a = ws, []
            if s >= threshold - 1e-9 and all(D.overlap(x, passage, D.shingles(passage)) >= least for x in (q, a)):
                out[item] = max(out.get(item, 0), min(s, 1.0))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")


def test_every_verbatim_item_is_found(tables):
    docs, items = tables
    texts, tests = docs.collect(), items.collect()
    want = {(d.doc_id, i.item_id) for d in texts for i in tests if i.text in d.text}
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()} == want and want


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 1500])
def test_scores_against_all_pairs(spark, tables, block_bytes):
    rnd = random.Random(5)
    items = [(r.item_id, r.text) for r in tables[1].collect()]
    docs = [(r.doc_id, r.text) for r in tables[0].limit(40).collect()]
    for k in range(60):  # planted, with some words changed and words around
        words = items[k % len(items)][1].split()
        for _ in range(k % 4):
            words[rnd.randrange(len(words))] = "changed"
        around = docs[k % 40][1].split()
        docs.append((10_000 + k, " ".join(around[:k * 7] + [w.upper() if k % 2 else w for w in words] + around[k * 7:])))
    # in a block the span is that of its own longest item, so passages and scores may differ, hits do not
    frame, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(
        items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in D.contaminated(frame, tests, block_bytes=block_bytes).collect()}
    want = {(d, i): s for d, t in docs for i, s in plain_matches(t, items).items()}
    assert set(got) == set(want) and len(want) > 30
    if block_bytes == D.BLOCK_BYTES:
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_filter_keeps_clean_documents(tables):
    docs, items = tables
    bad = {r.doc_id for r in D.contaminated(docs, items).collect()}
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in bad)


def test_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame(
        [(1, "same words in this text here"), (1, "same words in this text here"), (None, "no id on this row of text"),
         (3, None), (4, ""), (5, "one"), (6, "!!"), (7, "this row")], "item_id long, text string")
    rows = D.contaminated(odd_documents.withColumnRenamed("lang", "item_id"), items).collect()
    # two repeated rows and a copy, each with both repeated items; the row and the item without ids
    assert Counter((r.doc_id, r.item_id) for r in rows) == {(4, 1): 4, (5, 1): 2, (None, None): 1, (7, 5): 1,
                                                               (None, 7): 1}
    kept = D.drop_contaminated(odd_documents, items).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 3, 6, 8]
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(odd_documents, none).collect() == []
    assert D.drop_contaminated(odd_documents, none).count() == odd_documents.count()
    assert D.contaminated(no_documents, items).collect() == []


def test_short_items_inside_longer_documents(spark):
    docs = spark.createDataFrame([(1, "He asked: Who wrote it? Anna. And then more words came after that."),
                                  (2, "Anna wrote it, and who asked? He did."), (3, "Who wrote it? Anna."),
                                  (4, "Who wrote " + "filler words " * 40 + "it Anna")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Who wrote it? Anna."), (2, "a much longer item of more than five words here")],
                                  "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()} == {(1, 1), (3, 1)}
