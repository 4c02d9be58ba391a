import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tollcast.llm import decontaminate, language, packing, secrets, simhash
from tollcast.llm.common import written
from .test_decontaminate import plain_matches
from .test_packing import checked
from .test_secrets import plain_base, plain_entropy, plain_redacted
from .test_simhash import plain_components, plain_fingerprint

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], SF001), "test-stage"))
    return out


def test_stages_are_those_of_the_contract(steps):
    assert [n for n, _ in P.STAGES] == ["language ID", "SimHash near-dedup", "benchmark decontamination",
                                        "secret scans", "best-fit packing"]
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_each_stage_against_plain_python(spark, steps):
    docs, spoken, single, clean, redacted, packed = ([r for r in s.collect()] for s in steps)
    profiles = language.learn_profiles(steps[0])
    want = [d.doc_id for d in docs if profiles.predict(d.text)[0] != "und"
            and profiles.predict(d.text)[1] > P.MIN_LANGUAGE_SCORE]
    assert sorted(r.doc_id for r in spoken) == sorted(want)

    spoken.sort(key=lambda r: r.doc_id)
    firsts = set(plain_components([plain_fingerprint(r.text) for r in spoken]))
    assert sorted(r.doc_id for r in single) == sorted(spoken[i].doc_id for i in firsts)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = [r.doc_id for r in single if not plain_matches(r.text, items)]
    assert sorted(r.doc_id for r in clean) == sorted(want) and len(want) < len(single)

    text_of = {r.doc_id: r.text for r in clean}
    assert sorted(r.doc_id for r in redacted) == sorted(text_of)
    for r in redacted:
        base = plain_base(text_of[r.doc_id])
        assert r.text == plain_redacted(text_of[r.doc_id], base + plain_entropy(text_of[r.doc_id], base))
        assert r.n_chars == len(r.text) or r.text == text_of[r.doc_id]
    checked(packed, redacted)


def test_run_gives_the_last_stage(spark, steps):
    rows = P.run(spark, SF001)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(rows.select(key).collect()) == sorted(steps[-1].select(key).collect())


def test_odd_rows(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        out = docs
        for _, stage in P.STAGES:
            out = written(stage(spark, out, SF001), "test-odd")
        if docs is no_documents:
            assert out.collect() == []
        else:
            assert {r.doc_id for r in out.collect()} <= {1, 4, 5, 6, 7, None}
    clash = {c: c[::-1] for c in ("row", "id", "h", "p", "clean", "_id", "_th", "_lost", "__m", "__all", "__text", "key", "lang_pred")}
    wide = spark.read.parquet(f"{SF001}/documents.parquet").limit(30)
    for name, value in clash.items():
        wide = wide.withColumn(name, F.lit(value))
    out = wide
    for _, stage in P.STAGES[:-1]:
        out = written(stage(spark, out, SF001), "test-wide")
        assert out.columns == wide.columns
    assert all(r[c] == v for r in out.collect() for c, v in clash.items()) and out.count() > 10
    assert {f.__module__ for _, f in P.STAGES} == {"corpus_pipeline"}
    assert [decontaminate, packing, secrets, simhash]
