import bisect
import math
import string
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tollcast.llm import quality_compression as C
from tollcast.llm import toxicity as T
from tollcast.llm.common import fold

SF = "/root/testdata/sf0.01"


def area(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(rows, labels, column, parts, rest):
    of = {r.doc_id: r[column] for r in labels.collect()}
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % parts == rest and of.get(r.doc_id) is not None]
    return np.array([r.score for r in rows]), np.array([of[r.doc_id] for r in rows])


def test_compression_classifier_holds_out(tables):
    docs, labels = tables
    model = C.learn(docs.filter(fold("doc_id", 3) != 1), labels.filter(fold("doc_id", 3) != 1))
    rows = C.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in rows)
    s, y = held_out(rows, labels, "quality", 3, 1)
    assert area(s, y) > 0.9 and ((s >= .5) == y).mean() > max(y.mean(), 1 - y.mean()) + 0.03


def test_sizes_are_those_of_plain_compression(monkeypatch):
    monkeypatch.setattr(C, "CHUNK_CHARS", 10)
    good, bad = b"good words here and there " * 4, b"*** ### !!! $$$ " * 6
    text = "good words *** here é"
    want = 0
    for i in range(0, len(text), 10):
        for d, sign in ((good, -1), (bad, 1)):
            c = zstandard.ZstdCompressor(level=C.LEVEL, dict_data=zstandard.ZstdCompressionDict(d),
                                         write_checksum=False, write_content_size=False, write_dict_id=False)
            want += sign * len(c.compress(text[i:i + 10].encode()))
    assert C.size_difference(text, good, bad) == (want, len(text.encode()))
    assert C.size_difference(None, good, bad) == (0, 0)


def straight(x, xs, ys):
    """Linear between the points, flat beyond them."""
    if x <= xs[0]:
        return ys[0]
    if x >= xs[-1]:
        return ys[-1]
    k = bisect.bisect_right(xs, x) - 1
    return ys[k] if xs[k + 1] == xs[k] else ys[k] + (ys[k + 1] - ys[k]) * (x - xs[k]) / (xs[k + 1] - xs[k])


def test_compression_scores_of_the_whole_table_against_plain_python(spark, tables):
    """The registered query, and every score from the model's numbers by plain compression."""
    from tollcast.llm.queries import QUERIES
    docs, labels = tables
    model = C.learn(docs.filter(fold("doc_id", 3) != 1), labels.filter(fold("doc_id", 3) != 1))
    packers = [zstandard.ZstdCompressor(level=C.LEVEL, dict_data=zstandard.ZstdCompressionDict(d),
                                        write_checksum=False, write_content_size=False, write_dict_id=False)
               for d in (model.good, model.bad)]

    def plain(text):
        chunks = [text[i:i + C.CHUNK_CHARS].encode() for i in range(0, len(text), C.CHUNK_CHARS)]
        good, bad = (sum(len(p.compress(c)) for c in chunks) for p in packers)
        x = (bad - good + C.PRIOR_BYTES * model.usual) / (sum(map(len, chunks)) + C.PRIOR_BYTES)
        smooth = 1 / (1 + math.exp(-max(-30, min(30, model.slope * x + model.offset))))
        return (1 - C.FINE) * straight(x, *model.curve) + C.FINE * smooth

    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    rows = QUERIES["op8_quality_classifier"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.score == pytest.approx(plain(texts[r.doc_id]), abs=1e-9), r.doc_id
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_isotonic_is_the_best_rising_fit():
    from pyspark.ml.regression import IsotonicRegression  # noqa: F401  (same rule, other code)
    rng = np.random.default_rng(2)
    x, y, w = rng.random(200), rng.integers(0, 2, 200).astype(float), rng.random(200) + .1
    xs, ys = C.isotonic(x, y, w)
    assert all(a <= b for a, b in zip(xs, xs[1:])) and all(a <= b for a, b in zip(ys, ys[1:]))
    fit = np.interp(x, xs, ys)
    o = np.argsort(x)  # max-min formula
    cw, cy = np.r_[0, np.cumsum(w[o])], np.r_[0, np.cumsum((w * y)[o])]
    for k in range(0, 200, 17):
        best = max(min((cy[j + 1] - cy[i]) / (cw[j + 1] - cw[i]) for j in range(k, 200)) for i in range(k + 1))
        assert fit[o[k]] == pytest.approx(best)


def test_toxicity_holds_out(spark):
    # the table of a hundred held-out toxic documents; sf0.01 has six
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = T.learn(docs.filter(fold("doc_id", 5) != 0), labels.filter(fold("doc_id", 5) != 0))
    rows = T.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= .5) for r in rows)
    s, y = held_out(rows, labels, "toxic", 5, 0)
    assert y.sum() > 90 and area(s, y) > 0.95
    assert (s[y == 1] >= .5).mean() > 0.85 and (s[y == 0] >= .5).mean() < 0.01


def test_toxicity_features():
    lexicon = T.Lexicon({"idiot": 2.0, "scum": 1.0})
    f = dict(zip(T.FEATURES, T.text_features("You IDIOT, you 1d10t! Such sc.um and idiooot friends", lexicon)))
    n = 9
    assert f["lexicon_rate"] == 1 / n and f["hidden_rate"] == 3 / n and f["lexicon_top"] == 2.0
    assert f["near_rate"] == pytest.approx(4 / n) and f["second_person_rate"] == 2 / n
    assert f["obfuscation_rate"] == 2 / n and f["stretched_rate"] == 1 / n and f["shouted_rate"] == 1 / n
    assert T.text_features(None, lexicon) == T.text_features(" \n", lexicon) == (0.0,) * len(T.FEATURES)
    clean = dict(zip(T.FEATURES, T.text_features("A plain line about birds and trees", lexicon)))
    assert clean["lexicon_rate"] == clean["hidden_rate"] == clean["obfuscation_rate"] == 0


def plain_features(text, weights):
    """The toxicity features by their definitions, a character and a word at a time."""
    def letter(c):
        return c.isalnum() and not c.isdecimal()

    def runs(w, signs):
        """(start, end) of the longest runs of digits and ``signs``."""
        at, out = 0, []
        while at < len(w):
            end = at
            while end < len(w) and (w[end].isdecimal() or w[end] in signs):
                end += 1
            if end > at:
                out.append((at, end))
            at = max(end, at + 1)
        return out

    def obfuscated(w):
        between = any(a > 0 and b < len(w) and letter(w[a - 1]) and letter(w[b]) for a, b in runs(w, "@$!|*._-"))
        before = any(a == 0 and b < len(w) and letter(w[b]) for a, b in runs(w, "@$!|"))
        behind = any(a > 0 and b == len(w) and letter(w[a - 1]) for a, b in runs(w, "@$"))
        return between or before or behind

    def stretched(w):
        return any(a == b == c for a, b, c in zip(w, w[1:], w[2:]))

    def plain_form(w):
        w = "".join(dict(zip("013457@$!|", "oieastasil")).get(c, c) for c in w)
        kept = []
        for i, c in enumerate(w):
            k = i
            while k > 0 and w[k - 1] == c:
                k -= 1
            end = i
            while end + 1 < len(w) and w[end + 1] == c:
                end += 1
            if k == i or end - k + 1 < 3:
                kept.append(c)
        return "".join(c for c in kept if letter(c))

    def weight(w):
        return max(v for k, v in [("", 0.0), *weights.items()]
                   if k == "" or k == w or (k.endswith("*") and len(w) > len(k) - 1 and len(k) - 1 in T.STEMS
                                            and w.startswith(k[:-1])))

    text = text or ""
    words = text.lower().split()
    if not words:
        return [0.0] * len(T.FEATURES)
    cores = [w.strip(string.punctuation + "«»“”„’…") for w in words]
    shown = [weight(w) for w in cores]
    hidden = [0.0 if s or not (obfuscated(w) or stretched(w)) else weight(plain_form(w)) for w, s in zip(cores, shown)]
    hit = [max(a, b) for a, b in zip(shown, hidden)]
    you = [w in T.SECOND_PERSON for w in cores]
    near = [h > 0 and any(y for j, y in enumerate(you) if j != i and abs(i - j) <= T.NEAR) for i, h in enumerate(hit)]
    n, chars = len(words), len(text)
    small = [("a", "z"), ("ß", "ö"), ("ø", "ÿ")]
    capitals = sum(letter(c) and c != "_" and not any(a <= c <= b for a, b in small) for c in text)
    return [math.log1p(n), sum(s > 0 for s in shown) / n, sum(hit) / n, max(hit), math.log1p(sum(h > 0 for h in hit)),
            sum(h > 0 for h in hidden) / n, sum(near) / n, sum(w in T.SECOND_PERSON for w in words) / n,
            capitals / chars, sum(w.isupper() and len(w) > 2 for w in text.split()) / n,
            sum(c == "!" for c in text) / chars, sum(c in string.punctuation for c in text) / chars,
            sum(map(obfuscated, cores)) / n, sum(stretched(w) and w.isalpha() for w in cores) / n]


def test_toxicity_scores_of_the_whole_table_against_plain_python(spark, tables, odd_documents):
    """Features and scores of the registered query's rows, from the model's entries, trees and curve."""
    from pyspark.ml.linalg import Vectors
    from tollcast.llm.queries import QUERIES
    docs, labels = tables
    model = T.learn(docs.filter(fold("doc_id", 5) != 0), labels.filter(fold("doc_id", 5) != 0))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = T.score(docs, model).collect()
    asked = {r.doc_id: r.score for r in QUERIES["op9_toxicity"](spark, SF).collect()}
    assert sorted(r.doc_id for r in rows) == sorted(asked) == sorted(texts)
    xs, ys = (list(map(float, v)) for v in (model.curve.boundaries, model.curve.predictions))
    memo = {}
    for r in rows:
        want = plain_features(texts[r.doc_id], model.weights)
        assert r.features == pytest.approx(want, abs=1e-12), r.doc_id
        key = tuple(r.features)
        if key not in memo:
            p = float(model.trees.predictProbability(Vectors.dense(key))[1])
            memo[key] = (1 - T.FINE) * straight(p, xs, ys) + T.FINE * p
        assert r.score == pytest.approx(memo[key], abs=1e-9)
        assert asked[r.doc_id] == pytest.approx(r.score, abs=1e-9)
    tricky = ["You IDIOT, you 1d10t! sc.um idiooot", "a!!b 12ab ab12 x__y _z -a- 5 55 é9 ÄÖÜ ß 0x0 l33t$ $tup1d", "wwwow!!!  YOU\tur"]
    for t in tricky + [r.text for r in odd_documents.collect()]:
        assert list(T.text_features(t, T.Lexicon(model.weights))) == pytest.approx(plain_features(t, model.weights), abs=1e-12), t


@pytest.mark.parametrize("module,column", [(C, "quality"), (T, "toxic")])
def test_odd_rows(spark, module, column, tables, odd_documents, no_documents):
    docs, labels = tables
    odd = labels.withColumn(column, F.when(F.col("doc_id") % 7 != 0, F.col(column))).unionByName(
        labels.limit(3)).unionByName(spark.createDataFrame([(None, 1, 1), (10**9, 0, 0)], labels.schema))
    model = module.learn(docs.withColumnRenamed("lang", "y"), odd.withColumn("text", F.lit("clash")))
    rows = module.score(odd_documents.withColumnRenamed("lang", "score"), model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert module.score(no_documents, model).collect() == []
    for some, want in ((labels.filter(f"{column} = 1"), 1.0), (labels.limit(0), 0.5)):
        constant = module.learn(docs, some)
        assert {round(r.score, 3) for r in module.score(odd_documents, constant).collect()} == {want}
    nothing = module.learn(no_documents, labels)
    assert all(0 <= r.score <= 1 for r in module.score(odd_documents, nothing).collect())
