import hashlib
import random
from functools import cache

import numpy as np
import pytest
import sentencepiece as spm

from tollcast.llm.pieces import (Normalizer, PieceCodec, _fields, character_map, default_model, encode_documents,
                                 encoding_digests)
from tollcast.llm.queries import QUERIES

from .conftest import SF001


@pytest.fixture(scope="module")
def both():
    return PieceCodec(default_model()), spm.SentencePieceProcessor(model_file=default_model())


def texts():
    rnd = random.Random(1)
    out = ["", " ", "  ", "a", " a", "\n", "\n a", "▁", "▁ ▁▁", " " * 100 + "x", "x" * 3000, "</s><s><unk> <0x41>",
           "\x00a\x00", "é" * 50, "   a", "a﻿b", "🙂🙂", "漢字かな"]
    out += ["".join(rnd.choice("abc the '\n1!é<|>好▁ \t\x00ſﬁ🙂") for _ in range(150)) for _ in range(400)]
    return out + ["".join(chr(rnd.choice([rnd.randrange(1, 0x250), rnd.randrange(0x250, 0xD800),
                                          rnd.randrange(0xE000, 0x1FFFF)])) for _ in range(60)) for _ in range(400)]


def test_ids_and_decoding_equal_the_library(both):
    codec, library = both
    for t, (ids, _, _, decoded) in zip(texts(), codec.encode_batch(texts())):
        want = library.encode(t, add_eos=True)
        assert [int(i) for i in ids.split()] == want
        assert decoded == library.decode(want) == codec.decode(want)


def test_spans_equal_the_librarys(both):
    codec, library = both
    for t in texts():
        ids, starts, ends, _ = codec.encode(t)
        want = [(p.id, p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]
        size = len(t.encode())
        assert list(zip(map(int, ids.split()), starts.tolist(), ends.tolist())) == want + [(2, size, size)]


def test_heap_and_rounds_merge_alike(both):
    codec, rnd = both[0], random.Random(2)
    words = ["".join(rnd.choice("▁▁aeinrstth") for _ in range(rnd.randrange(1, 60))) for _ in range(800)]
    flat, count = codec.merge_many(words)
    flat, at = flat.tolist(), 0
    for w, n in zip(words, count.tolist()):
        assert "".join(codec.pieces[i] for i in flat[at:at + n]) == w
        assert [codec.pieces[i] for i in flat[at:at + n]] == codec.merge(w)
        at += n


def test_a_full_table_and_small_batches_change_nothing(both, monkeypatch):
    import tollcast.llm.pieces as m
    monkeypatch.setattr(m, "CACHE_ENTRIES", 20)
    monkeypatch.setattr(m, "CACHE_CHARS", 5)
    monkeypatch.setattr(m, "BATCH_CHARS", 100)
    codec = m.PieceCodec(default_model())
    assert [r[0] for r in codec.encode_batch(texts())] == [
        " ".join(map(str, x)) for x in both[1].encode(texts(), add_eos=True)]


def test_a_word_of_400_000_letters(both):
    rnd = random.Random(3)
    t = "".join(rnd.choice("abcdefghij") for _ in range(400_000))
    assert [int(i) for i in both[0].encode(t)[0].split()] == both[1].encode(t, add_eos=True)


@cache
def rules(name: str) -> dict:
    """The character map of one of the library's built-in normalisations, from its compiled form."""
    spec = spm.SentencePieceNormalizer(rule_name=name).serialized_normalizer_spec()
    return character_map(dict(_fields(spec))[2])


@pytest.mark.parametrize("name", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("dummy,extra,escape", [(True, True, True), (False, False, False), (True, False, True),
                                                (False, True, False)])
def test_normalisation_through_a_compiled_map(name, dummy, extra, escape):
    library = spm.SentencePieceNormalizer(rule_name=name, add_dummy_prefix=dummy, remove_extra_whitespaces=extra,
                                          escape_whitespaces=escape)
    own = Normalizer(rules(name), dummy, extra, escape)
    rnd = random.Random(4)
    odd = ["ﬁn ① ｶﾞ x", "  a  b  ", "ẹ́", "각", "A  B", "\t x \n", "​", " "]
    odd += ["".join(rnd.choice("aẹ́ﬁ①ｶﾞ \t　각ÅẞIİ") for _ in range(30)) for _ in range(300)]
    for t in odd:
        form, at = own(t)
        want, offsets = library.Normalize(t, with_offsets=True)
        assert form == want
        byte = np.cumsum([0] + [len(c.encode()) for c in t])
        assert at.tolist() == [int(byte[i]) for i in offsets]


def test_documents(spark, documents, both):
    rows = {r.doc_id: r for r in QUERIES["op13_sentencepiece"](spark, SF001).collect()}
    assert len(rows) == documents.count()
    full = {r.doc_id: r for r in encode_documents(documents).collect()}
    for d in documents.collect():
        want, raw = both[1].encode(d.text or "", add_eos=True), (d.text or "").encode()
        r, f = rows[d.doc_id], full[d.doc_id]
        assert (r.n_tokens, r.covered) == (len(want), True) and f.ids == want
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(both[1].decode(want).encode()).hexdigest()
        # each byte of the text belongs to one piece
        assert b"".join(raw[a:z] for a, z in zip(f.starts, f.ends)) == raw


def test_odd_rows(odd_documents, no_documents, both):
    rows = encoding_digests(odd_documents.withColumnRenamed("lang", "n_tokens")).collect()
    assert len(rows) == odd_documents.count()
    assert {(r.n_tokens, r.decoded_sha256) for r in rows if r.doc_id in (1, 2)} == {(1, hashlib.sha256(b"").hexdigest())}
    assert encoding_digests(no_documents).collect() == encode_documents(no_documents).collect() == []
