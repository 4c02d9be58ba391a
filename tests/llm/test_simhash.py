from collections import defaultdict
from itertools import combinations, product

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tollcast.llm import simhash as S


def plain_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, bits=3):
    """Smallest index reachable, by all pairs."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= bits:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for t in ["", None, "one", "Two Words", "a b c", "A b c d É e\x1cf", "x y z " * 50]:
        assert S.text_fingerprint(t) == plain_fingerprint(t)


def test_allocation_is_optimal():
    rng = np.random.default_rng(0)
    costs = [np.r_[np.zeros((1, 6)), np.cumsum(rng.random((4, 6)) * 9, axis=0)] for _ in range(4)]
    got = S.allocate(costs, 0)
    assert (got.sum(axis=0) == 0).all()
    for i in range(6):
        best = min(sum(costs[p][t + 1, i] for p, t in enumerate(ts))
                   for ts in product(range(-1, 4), repeat=4) if sum(ts) == 0)
        assert sum(costs[p][got[p, i] + 1, i] for p in range(4)) == pytest.approx(best)


def test_parts_hold_every_bit_once_and_correlated_bits_together():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (500, 64)).astype(float)
    bits[:, 40] = bits[:, 7]
    groups = S.correlated_parts(bits.T @ bits, 500, 4)
    assert sorted(sum(groups, [])) == list(range(64)) and {len(g) for g in groups} == {16}
    assert any({7, 40} <= set(g) for g in groups)


@pytest.mark.parametrize("parts,tile", [(4, 4096), (3, 4096), (4, 5)])
def test_components_against_all_pairs(spark, parts, tile):
    rng = np.random.default_rng(parts)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set()
    for b in base.tolist():  # clusters around each, of up to 6 changed bits, and one large one
        for _ in range(60 if b == base[0] else 4):
            x = b
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    links = S.link_fingerprints(nodes, 3, parts, tile)
    roots = {r.node: r.component for r in S.connected_components(links).collect()}
    want = plain_components(fps)
    got = defaultdict(set)
    for i, f in enumerate(signed):
        got[roots.get(f, f)].add(i)
    plain = defaultdict(set)
    for i, r in enumerate(want):
        plain[r].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, plain.values()))


def test_documents(documents):
    docs = documents.orderBy("doc_id").collect()
    fps = [plain_fingerprint(d.text) for d in docs]
    comp = plain_components(fps)
    rows = {r.doc_id: r for r in S.near_duplicates(documents).collect()}
    assert len(rows) == len(docs)
    for d, f, c in zip(docs, fps, comp):
        assert rows[d.doc_id].fp & (2**64 - 1) == f
        assert rows[d.doc_id].component_id == docs[c].doc_id
    kept = S.one_per_component(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({docs[c].doc_id for c in comp})


def test_odd_rows(odd_documents, no_documents):
    rows = S.near_duplicates(odd_documents.withColumnRenamed("lang", "fp")).collect()
    assert len(rows) == odd_documents.count()
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    kept = S.one_per_component(odd_documents).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [1, 4, 6, 7, 8, None]
    assert S.near_duplicates(no_documents).collect() == []
    assert S.one_per_component(no_documents).collect() == []


def test_same_id_with_other_text_stays(spark):
    docs = spark.createDataFrame([(5, "alpha beta gamma delta"), (5, "quite another text it is"),
                                  (3, "quite another text it is")], "doc_id long, text string")
    kept = S.one_per_component(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text[:5]) for r in kept] == [(3, "quite"), (5, "alpha")]


def test_many_copies_of_one_text(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("one text for all").alias("text"))
    assert S.one_per_component(docs).select("doc_id").collect()[0].doc_id == 0
