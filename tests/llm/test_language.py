import zlib
from collections import Counter

from tollcast.llm import language as L
from tollcast.llm.common import fold


def plain_ngrams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    if not words:
        return Counter()
    s = f" {' '.join(words)} "
    grams = [c for c in s if c != " "] + [s[i:i + 2] for i in range(len(s) - 1)]
    grams += [s[i:i + 3] for i in range(len(s) - 2) if s[i + 1] != " "]
    return Counter(sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g)) for g in grams)


def plain_predict(text, profiles, size):
    own = [g for g, _ in sorted(plain_ngrams(text).items(), key=lambda x: (-x[1], x[0]))][:size]
    if not own:
        return "und", 0.0
    sums = {n: sum(abs(p.index(g) - r) if g in p else size for r, g in enumerate(own))
            for n, p in profiles.items()}
    best = min(sorted(sums), key=sums.get)
    return best, 1 - sums[best] / (size * len(own))


def test_ngrams_and_distances_against_plain_python(documents):
    docs = [d for d in documents.orderBy("doc_id").collect()][:40]
    profiles = {}
    for name in ("en", "fr", "de", "es"):
        total = Counter()
        for d in docs:
            if d.lang == name:
                total += plain_ngrams(d.text)
        profiles[name] = [g for g, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))][:60]
    model = L.Profiles.of(profiles, 60)
    for d in docs:
        name, score = model.predict(d.text)
        want, want_score = plain_predict(d.text, profiles, 60)
        assert name == want and abs(score - want_score) < 1e-12


def test_learned_profiles_hold_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = L.learn_profiles(docs.filter(fold("doc_id", 4) != 2))
    found = {r.doc_id: r for r in L.identify(docs, profiles).collect()}
    held = [d for d in docs.collect() if zlib.crc32(str(d.doc_id).encode()) % 4 == 2]
    right = sum(found[d.doc_id].lang_pred == d.lang for d in held)
    assert right / len(held) > 0.97 and all(0 <= r.score <= 1 for r in found.values())


def test_letters_only_count():
    model = L.Profiles.of({"en": [1], "fr": [2]}, 60)
    for text in ("½ ² ٣", "12 _ !", "", None, "\u0301"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("ª")[0] == "en"


def test_sample_is_bounded_and_whole_when_large_enough(documents):
    whole = L.learn_profiles(documents, profile_size=50, sample_rows=10**6)
    again = L.learn_profiles(documents.repartition(7), profile_size=50, sample_rows=10**6)
    assert whole.languages == again.languages and (whole.ranks == again.ranks).all()
    small = L.learn_profiles(documents, profile_size=50, sample_rows=5)
    assert set(small.languages) <= set(whole.languages)


def test_odd_rows(odd_documents, no_documents, documents):
    profiles = L.learn_profiles(documents)
    rows = L.identify(odd_documents.withColumnRenamed("source", "score"), profiles).collect()
    assert len(rows) == odd_documents.count()
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3, 8)} == {("und", 0.0)}
    kept = L.keep_identified(odd_documents, profiles)
    assert kept.columns == odd_documents.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [4, 4, 5, 6, 7, None]
    assert L.identify(no_documents, profiles).collect() == []
    nothing = L.learn_profiles(no_documents)
    assert {r.lang_pred for r in L.identify(odd_documents, nothing).collect()} == {"und"}
