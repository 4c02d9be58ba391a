import random
import re

import numpy as np
import pytest

from tollcast.llm import quality_rules as Q


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(twice))


def test_statistics_against_plain_python(documents):
    rnd = random.Random(7)
    texts = ["", None, " \n\t", "a b c d e", "a b c d e f a b c d e", "x " * 9, "é\x1cü\x85 y\xa0z", "l\nl\n \nl\nm"]
    texts += ["".join(rnd.choice(["ab ", "c ", "\n", "d\x0b", "# ", "é "]) for _ in range(rnd.randrange(80)))
              for _ in range(300)]
    texts += [d.text for d in documents.limit(60).collect()]
    for t in texts:
        s = Q.text_statistics(t)
        assert (*s[:4], s[5]) == plain_statistics(t)
        assert s[6:8] == (sum(c.isalpha() and c.isupper() for c in t or ""), sum(map(str.isalpha, t or "")))
        assert s[9] == sum(any(map(str.isalpha, w)) for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_unequal_windows_with_equal_numbers_are_told_apart(monkeypatch):
    monkeypatch.setattr(Q, "hash", lambda w: 1, raising=False)
    assert Q.repeated_words(list("abcdefghij")) == 0
    assert Q.repeated_words(list("abcdeXabcde")) == 10


def test_em_recovers_accuracies_of_planted_rules():
    rng = np.random.default_rng(3)
    good = rng.random(80_000) < 0.85
    says_bad = np.where(good[:, None], [.01, .02, .005, .0], [.6, .5, .3, .0])  # rates of a bad vote
    says_good = np.where(good[:, None], [.95, .9, .5, .8], [.2, .3, .4, .7])
    draw = rng.random((len(good), 4))
    votes = np.where(draw < says_bad, -1, np.where(draw > 1 - says_good, 1, 0))
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = Q.LabelModel(4, prior=0.85).fit(patterns.astype(float), counts.astype(float))
    for rule in range(3):
        right = (~good)[votes[:, rule] == -1].mean()
        assert abs(model.accuracy(-1)[rule] - right) < 0.1
    kept = model.posterior(patterns.astype(float))[back] >= 0.5
    assert (kept == good).mean() > ((votes >= 0).all(axis=1) == good).mean()  # better than all must pass
    assert kept[good].mean() > 0.98


def test_verdicts_agree_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = Q.judge(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) / len(good) > 0.98
    assert sum(r.kept for r in bad) / len(bad) < 0.15
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.posterior <= 1


def test_odd_rows(odd_documents, no_documents):
    rows = Q.judge(odd_documents.withColumnRenamed("lang", "n_words")).collect()
    assert len(rows) == odd_documents.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert Q.judge(no_documents).collect() == []


@pytest.mark.parametrize("size", [5, 1000])
def test_equal_windows_of_a_repeated_word(size):
    assert Q.repeated_words(["w"] * size) == (size if size > 5 else 0)
