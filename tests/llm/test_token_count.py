import random

import pytest
from tokenizers import Tokenizer

from tollcast.llm.token_count import TokenCounter, count_tokens, default_vocabulary


@pytest.fixture(scope="module")
def both():
    path = default_vocabulary()
    return TokenCounter(path), Tokenizer.from_file(path)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(both):
    counter, library = both
    rnd = random.Random(1)
    texts = ["", " ", "a", "aaaa" * 999, "x" * 20_001, " " * 300 + "x", "<|endoftext|>a<|endoftext|>",
             "\n\n  \t x", "don't we'll I'VE"]
    texts += ["".join(rnd.choice("abc '\n1!é<|>好") for _ in range(150)) for _ in range(500)]
    assert counter.counts(texts) == expected(library, texts)


def test_white_space_and_letters_of_all_planes(both):
    counter, library = both
    texts = [f"ab{c}{c} {c}c 1{c}\n {c}" for c in map(chr, [*range(1, 0x3000), *range(0x1F300, 0x1F700)])]
    assert counter.counts(texts) == expected(library, texts)


def test_long_pieces_and_a_full_cache_change_nothing(both, monkeypatch):
    import tollcast.llm.token_count as m
    monkeypatch.setattr(m, "LONG_TEXT_CHARS", 50)
    monkeypatch.setattr(m, "CACHE_ENTRIES", 20)
    counter, library = m.TokenCounter(default_vocabulary()), both[1]
    texts = ["word number %d and more of it " % i * 5 for i in range(50)]
    assert counter.counts(texts) == expected(library, texts)


def test_documents(both, documents):
    rows = {r.doc_id: r for r in count_tokens(documents).collect()}
    docs = documents.collect()
    for d, n in zip(docs, expected(both[1], [d.text for d in docs])):
        r = rows[d.doc_id]
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(d.text.encode()), n > 512)


def test_odd_rows(odd_documents, no_documents):
    rows = count_tokens(odd_documents.withColumnRenamed("lang", "n_tokens")).collect()
    assert len(rows) == odd_documents.count()
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert count_tokens(no_documents).collect() == []


def test_long_words(both):
    """A word of 400,000 letters, and long runs of one or two letters, each in seconds."""
    import time
    counter, library = both
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000)), "a" * 100_001, "ab" * 50_000,
             "".join(rnd.choice("aab") for _ in range(50_000)), "\u00e9\u597d" * 20_000]
    t0 = time.time()
    assert counter.counts(texts) == expected(library, texts)
    assert time.time() - t0 < 60


def test_long_and_short_sequences_are_merged_alike(both):
    merger, rnd = both[0].merger, random.Random(8)
    words = ["".join(rnd.choice("aabcdeinst ") for _ in range(rnd.randrange(1, 200))).encode() for _ in range(300)]
    assert [merger.count_long(w) for w in words] == merger._count(words).tolist()
