"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch are held as one flat array of symbol ids with a
length per sequence.  In every round each sequence finds its lowest-ranked
adjacent pair and applies it at all its places at once; a sequence without a
known pair leaves the arrays, and its surviving symbols are its token count.

Pre-tokens are independent of each other, so a count is computed once per
distinct pre-token and kept in a table of the Python worker (emptied beyond
``CACHE_ENTRIES``); a document's count is the sum over its pre-tokens.  A
sequence of more than ``LONG_SEQUENCE`` symbols is merged alone: its symbols
stay in place, linked to their neighbours, and a round brings up to date only
the pairs beside its merges.

Defined cases: a NULL text counts as empty (0 bytes, 0 tokens); repeated rows
are counted once each; the added special string inside a text is one token,
as the library has it by default.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the byte-level pre-token pattern of the vocabulary's public model.
PRETOKEN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CACHE_ENTRIES = 1_000_000
#: Pre-tokens merged together, and characters matched in one go.
BATCH_CHARS = 4_000_000
LONG_SEQUENCE = 2_000
LONG_TEXT_CHARS = 4_000_000

_NONE = np.iinfo(np.int32).max


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[int, str]:
    """Byte -> printable character of the byte-level alphabet: printable
    Latin-1 bytes stand for themselves, the others take code points from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(rest)) for b in range(256)}


class RankMerger:
    """The merge table of a byte-level BPE file as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.first = np.array([vocab[c] for _, c in sorted(byte_symbols().items())], np.int64)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.bits = max(1, int(max(vocab.values())).bit_length())
        key = (left << self.bits) | right
        order = np.argsort(key, kind="stable")
        self.keys, self.rank, self.made = key[order], order.astype(np.int32), made[order]
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or none) of each pair, and the symbol it makes."""
        key = (left << self.bits) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE).astype(np.int32), self.made[at]

    def count_long(self, sequence: bytes) -> int:
        """Surviving symbols of one long byte string."""
        symbol = self.first[np.frombuffer(sequence, np.uint8)]
        n = alive = len(symbol)
        there = np.ones(n, bool)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank, made = np.full(n, _NONE, np.int32), np.zeros(n, np.int64)
        rank[:-1], made[:-1] = self._look_up(symbol[:-1], symbol[1:])
        while True:
            low = rank.min()
            if low == _NONE:
                return alive
            p = np.flatnonzero(rank == low)
            # of overlapping places of a pair (x, x), every second one from the left
            starts = np.r_[True, after[p[:-1]] != p[1:]]
            run = np.maximum.accumulate(np.where(starts, np.arange(len(p)), 0))
            p = p[(np.arange(len(p)) - run) % 2 == 0]
            gone = after[p]
            symbol[p], rank[gone], there[gone] = made[p], _NONE, False
            after[p] = after[gone]
            has = after[p] < n
            before[after[p[has]]] = p[has]
            rank[p] = _NONE
            alive -= len(p)
            for q in (p[has], before[p[before[p] >= 0]]):
                rank[q], made[q] = self._look_up(symbol[q], symbol[after[q]])
            if alive * 2 < len(symbol):  # close the gaps
                symbol, rank, made, n = symbol[there], rank[there], made[there], alive
                there = np.ones(n, bool)
                after, before = np.arange(1, n + 1), np.arange(-1, n - 1)

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Surviving symbols of each (non-empty) byte string."""
        is_long = np.fromiter((len(s) > LONG_SEQUENCE for s in sequences), bool, len(sequences))
        out = np.zeros(len(sequences), np.int64)
        for i in np.flatnonzero(is_long).tolist():
            out[i] = self.count_long(sequences[i])
        out[~is_long] = self._count([s for s in sequences if len(s) <= LONG_SEQUENCE])
        return out

    def _count(self, sequences: list[bytes]) -> np.ndarray:
        lens = np.fromiter(map(len, sequences), np.int64, len(sequences))
        out = np.zeros(len(sequences), np.int64)
        ids = np.arange(len(sequences))
        flat = self.first[np.frombuffer(b"".join(sequences), np.uint8)]
        while len(flat):
            seq = np.repeat(np.arange(len(lens)), lens)
            ends = np.cumsum(lens)
            key = (flat[:-1] << self.bits) | flat[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(flat), _NONE, np.int32)
            known = self.keys[at] == key
            known[ends[:-1] - 1] = False  # a pair across two sequences
            rank[:-1][known] = self.rank[at[known]]
            low = np.minimum.reduceat(rank, ends - lens)
            hit = (rank == low[seq]) & (rank < _NONE)
            # of overlapping places of a pair (x, x), every second one from the left
            p = np.flatnonzero(hit)
            starts = np.r_[True, np.diff(p) > 1] | np.r_[True, np.diff(seq[p]) > 0] if len(p) else p
            run = np.maximum.accumulate(np.where(starts, np.arange(len(p)), 0)) if len(p) else p
            p = p[(np.arange(len(p)) - run) % 2 == 0] if len(p) else p
            flat[p] = self.made[at[p]]
            stay = np.ones(len(flat), bool)
            stay[p + 1] = False
            lens = lens - np.bincount(seq[p], minlength=len(lens))
            done = low == _NONE
            out[ids[done]] = lens[done]
            stay &= ~done[seq]
            flat, lens, ids = flat[stay], lens[~done], ids[~done]
        return out


class TokenCounter:
    """Counts whole texts; one instance per Python worker and vocabulary."""

    def __init__(self, path: str):
        self.merger = RankMerger(path)
        self.find = regex.compile(PRETOKEN_PATTERN)
        self.special = (regex.compile("|".join(map(regex.escape, self.merger.specials)))
                        if self.merger.specials else None)
        self.known: dict[str, int] = {}

    def _learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known = {}
            new = list(tokens)
        for i in range(0, len(new), 200_000):
            part = new[i:i + 200_000]
            counts = self.merger.count([t.encode("utf-8") for t in part]).tolist()
            self.known.update(zip(part, counts))

    def _sum(self, tokens: list[str]) -> int:
        return sum(map(self.known.__getitem__, tokens))

    def _long(self, piece: str) -> int:
        """A very long piece in runs of pre-tokens, so memory stays bounded."""
        found, total = (m.group() for m in self.find.finditer(piece)), 0
        while run := list(islice(found, 500_000)):
            self._learn(set(run))
            total += self._sum(run)
        return total

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        group: list[tuple[int, list[str]]] = []
        chars = 0
        for i, text in enumerate(texts):
            pieces = [text]
            if self.special and self.special.search(text):
                pieces = self.special.split(text)
                out[i] += len(pieces) - 1
            for piece in pieces:
                if len(piece) > LONG_TEXT_CHARS:
                    out[i] += self._long(piece)
                    continue
                group.append((i, self.find.findall(piece)))
                chars += len(piece)
            if chars > BATCH_CHARS:
                self._finish(group, out)
                group, chars = [], 0
        self._finish(group, out)
        return out

    def _finish(self, group, out) -> None:
        self._learn(set(chain.from_iterable(t for _, t in group)))
        for i, tokens in group:
            out[i] += self._sum(tokens)


@lru_cache(maxsize=2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = 512,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    ``vocabulary`` is the path of a byte-level BPE file readable on every
    executor (default: the installed public file, resolved there).
    """
    @F.pandas_udf("n_bytes long, n_tokens long")
    def counted(texts: pd.Series) -> pd.DataFrame:
        values = ["" if t is None else t for t in texts]
        counter = _counter(vocabulary or default_vocabulary())
        return pd.DataFrame({"n_bytes": [len(t.encode("utf-8")) for t in values],
                             "n_tokens": counter.counts(values)})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", counted.asNondeterministic()("text").alias("c"))
    return rows.select("doc_id", "c.n_bytes", "c.n_tokens",
                       (F.col("c.n_tokens") > F.lit(limit)).alias("over_limit"))
