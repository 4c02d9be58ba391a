import re
from collections import Counter
from itertools import permutations

import duckdb

from tollcast.llm import oracle
from tollcast.llm.filter_audit import audit, failing_ids, prefix_counts
from tollcast.llm.queries import QUERIES

from .conftest import SF001

COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley"]


def fails(docs):
    """Failing letters of each row, by the plain conditions."""
    out = []
    for d in docs:
        t = d.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        same = [x.doc_id for x in docs if (x.text or "") == t and x.doc_id is not None]
        out.append("".join(k for k, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search("[#$%&*|]", t),
            d.doc_id is not None and any(x < d.doc_id for x in same))) if bad))
    return out


def plain(docs, labels):
    """Every order and step applied to the rows one after the other."""
    good = {x.doc_id for x in labels if x.quality == 1 and x.doc_id is not None}
    toxic = {x.doc_id for x in labels if x.toxic == 1 and x.doc_id is not None}
    parts = Counter((d.source or "", f, d.doc_id in good, d.doc_id in toxic) for d, f in zip(docs, fails(docs)))
    rows, shapley = {}, Counter()
    for part in {p for p, *_ in parts}:
        own = [(f, g, x, n) for (p, f, g, x), n in parts.items() if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for i, k in enumerate(order):
                gone = [r for r in left if k in r[0]]
                failing = sum(r[3] for r in own if k in r[0])
                removed = sum(r[3] for r in gone)
                left = [r for r in left if k not in r[0]]
                rows[part, order, i + 1] = (
                    sum(r[3] for r in left), removed, failing - removed, sum(r[3] for r in own if r[0] == k),
                    sum(r[3] for r in gone if r[1]), sum(r[3] for r in gone if r[2]))
                shapley[part, k] += removed
    return {(p, o, i): (*v, shapley[p, o[i - 1]]) for (p, o, i), v in rows.items()}


def as_plain(rows):
    return {tuple(r[:3]): tuple(r[3:]) for r in rows}


def test_query_sql_and_plain(spark, documents):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    found = QUERIES["op11_filter_audit"](spark, SF001)
    assert found.columns == COLS
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == 600 * documents.select("source").distinct().count()
    assert as_plain(rows) == as_plain(con.sql(oracle.FILTER_AUDIT).select(*COLS).fetchall())
    labels = spark.read.parquet(f"{SF001}/labels.parquet").collect()
    assert as_plain(rows) == plain(documents.collect(), labels)


def test_odd_rows(spark, odd_documents, no_documents):
    more = spark.createDataFrame([(9, "A B " * 300, "en", "b", 1), (None, "A B " * 300, "en", "b", 1),
                                  (3, "A B " * 300, "en", "b", 1), (10, "x# " * 250, "en", "", 1),
                                  (None, "no id on this row of text", "en", None, 25)], odd_documents.schema)
    docs = odd_documents.unionAll(more).withColumnRenamed("lang", "rid").withColumnRenamed("n_chars", "prefix")
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (9, None, None), (None, 1, 1), (3, 1, None), (77, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    assert as_plain(audit(docs, labels).collect()) == plain(docs.collect(), labels.collect())
    assert audit(no_documents, labels).collect() == []
    assert audit(docs, labels.limit(0)).count() == 600 * 4


def test_one_table_of_failing_rows_per_filter(spark, documents):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows, tables = failing_ids(documents, labels)
    want = Counter("".join(fails(documents.collect())))
    assert {k: t.count() for k, t in tables.items()} == {k: want[k] for k in "ABCDE"}
    assert rows.select("rid").distinct().count() == documents.count()
    kept, cases = prefix_counts(rows, tables)
    assert kept.select("prefix").distinct().count() == 32
    # ids are dealt out once: no exchange stands between the explosion of prefixes and the join
    plan = cases._jdf.queryExecution().executedPlan().toString()
    assert "left_anti" in plan.lower().replace("leftanti", "left_anti") and "CartesianProduct" not in plan
    assert not re.search(r"Exchange hashpartitioning\(rid[^\n]*\n[^\n]*Generate", plan)
