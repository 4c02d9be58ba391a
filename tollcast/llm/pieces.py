"""SentencePiece BPE encoding that keeps source offsets, and decoding.

A text is normalised by the longest prefix found in the model's compiled
character map; every normalised character records the byte of the source it
came from.  The normalised text is cut where no piece of the vocabulary spans
the cut, so stretches are encoded independently of each other (a table of
known stretches per Python worker, emptied beyond ``CACHE_ENTRIES``): symbols
are merged by score, the leftmost of equal ones first, one merge a round in
all new stretches of a batch at once or, in a long one, with a heap; a symbol
outside the vocabulary becomes its bytes.  Every piece is projected
through the alignment to the byte span of the original text it stands for; of
the bytes of one unknown symbol the last has its span, the others an empty one.

Defined cases: a NULL text is an empty one (the end id alone, empty text
decoded); repeated rows are encoded each; an empty table gives an empty
result; literal strings such as ``</s>`` in a text are ordinary text.  Models
that are not BPE with byte fallback, or that have user-defined or unused
pieces, are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE_ENTRIES = 500_000
#: Longer stretches are merged with a heap and not remembered.
CACHE_CHARS = 64
#: Characters of texts encoded together.
BATCH_CHARS = 2_000_000

_NO_PAIR = np.iinfo(np.int64).max

#: Piece types of the public model format.
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(raw: bytes):
    """(number, value) of the fields of one message in protocol buffer wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, raw[at:at + size]
        at += size


def character_map(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map: source string -> normalised string.

    The blob is the size of a double-array trie, the trie, and the zero-ended
    normalised strings that its values point to.
    """
    if not blob:
        return {}
    size, = struct.unpack_from("<I", blob)
    units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
    strings = blob[4 + size:]
    label = units & ((1 << 31) | 0xFF)
    offset = (units >> 10) << ((units & (1 << 9)) >> 6)
    leaf = (units >> 8) & 1
    every, rules = np.arange(256), {}
    todo = [(0, b"")]
    while todo:
        node, key = todo.pop()
        base = node ^ int(offset[node])
        at = base ^ every
        at_ok = at < len(units)
        for c in every[at_ok][label[at[at_ok]] == every[at_ok]].tolist():
            if c == 0:
                continue
            child = base ^ c
            if leaf[child]:
                value = int(units[child ^ int(offset[child])] & ((1 << 31) - 1))
                rules[(key + bytes([c])).decode("utf-8")] = strings[value:strings.index(b"\0", value)].decode("utf-8")
            todo.append((child, key + bytes([c])))
    return rules


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Normalizer:
    """Longest-prefix normalisation with the source byte of every character."""

    def __init__(self, rules: dict[str, str], dummy_prefix: bool = True, remove_extra: bool = False,
                 escape: bool = True):
        self.rules, self.dummy_prefix, self.remove_extra = rules, dummy_prefix, remove_extra
        self.space = SPACE if escape else " "
        self.longest: dict[str, int] = {}
        for key in rules:
            self.longest[key[0]] = max(self.longest.get(key[0], 0), len(key))

    def prefix(self, text: str, at: int) -> tuple[str, int]:
        """The normalised form of the longest rule at ``at`` and its length; else the character."""
        for n in range(self.longest.get(text[at], 0), 0, -1):
            found = self.rules.get(text[at:at + n])
            if found is not None and len(text) >= at + n:
                return found, n
        return text[at], 1

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text and, for its characters and its end, the source byte offset."""
        if not text:
            return "", np.zeros(1, np.int64)
        points = _points(text)
        widths = 1 + (points > 0x7F) + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)
        byte = np.concatenate(([0], np.cumsum(widths)))
        if not self.rules and not self.remove_extra:
            plain = text.replace(" ", self.space)
            return (self.space + plain, np.concatenate(([0], byte))) if self.dummy_prefix else (plain, byte)
        return self._mapped(text, byte)

    def _mapped(self, text: str, byte: np.ndarray) -> tuple[str, np.ndarray]:
        at, out, source = 0, [], []
        if self.remove_extra:
            while at < len(text):
                form, n = self.prefix(text, at)
                if form != " ":
                    break
                at += n
            if at == len(text):
                return "", byte[:1]
        if self.dummy_prefix:
            out.append(self.space)
            source.append(at)
        after_space = self.remove_extra
        while at < len(text):
            form, n = self.prefix(text, at)
            if after_space:
                form = form.lstrip(" ")
            if form:
                out += form.replace(" ", self.space)
                source += [at] * len(form)
                after_space = self.remove_extra and form.endswith(" ")
            at += n
        if self.remove_extra:
            while out and out[-1] == self.space:
                out.pop()
                at = source.pop()
        return "".join(out), byte[np.array([*source, at])]


class PieceCodec:
    """One model; one instance per Python worker."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        self.pieces: list[str] = []
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.kind: list[int] = []
        trainer, normal = {}, {}
        for number, value in _fields(raw):
            if number == 1:
                d = dict(_fields(value))
                piece, kind = d[1].decode("utf-8"), d.get(3, _NORMAL)
                if kind == _NORMAL:
                    self.score[piece], = struct.unpack("<f", d[2])
                    self.id_of[piece] = len(self.pieces)
                self.pieces.append(piece)
                self.kind.append(kind)
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24):
            raise ValueError("not a BPE model with byte fallback")
        if {_USER_DEFINED, _UNUSED} & set(self.kind):
            raise ValueError("a model with user-defined or unused pieces")
        self.byte_id = np.zeros(256, np.int64)
        self.byte_of = {}
        for i, kind in enumerate(self.kind):
            if kind == _BYTE:
                self.byte_of[i] = int(self.pieces[i][3:5], 16)
                self.byte_id[self.byte_of[i]] = i
        self.end_id = self.pieces.index(trainer.get(47, b"</s>").decode("utf-8"))
        self.dummy_prefix, self.remove_extra = bool(normal.get(3, 1)), bool(normal.get(4, 1))
        self.normalise = Normalizer(character_map(normal.get(2, b"")), self.dummy_prefix, self.remove_extra,
                                    bool(normal.get(5, 1)))
        self.cut = self._cut()
        self.known: dict[str, tuple[str, bytes, str]] = {}
        self.name = [str(i) for i in range(len(self.pieces))]
        self.shown = [p.replace(SPACE, " ") for p in self.pieces]
        self._pairs()

    def _cut(self) -> re.Pattern:
        """Stretches between places that no piece spans: characters found in no
        longer piece stand alone, and a space mark begins a stretch unless some
        piece has it after another character."""
        joined = [p for p in self.score if len(p) > 1]
        inner = set("".join(joined)) - {SPACE}
        chars = "".join(map(re.escape, sorted(inner))) or SPACE
        if any(a != SPACE and b == SPACE for p in joined for a, b in zip(p, p[1:])):
            return re.compile(f"[{SPACE}{chars}]+|.", re.DOTALL)
        return re.compile(f"{SPACE}*[{chars}]+|{SPACE}+|.", re.DOTALL)

    def _pairs(self) -> None:
        """Every pair of symbols that makes a piece: its key, rank and result as sorted arrays."""
        symbol = dict(self.id_of)  # a character that is no piece itself gets a number beyond the ids
        for p in self.score:
            for c in p if len(p) > 1 else ():
                symbol.setdefault(c, len(self.pieces) + len(symbol))
        self.other = len(self.pieces) + len(symbol)
        self.bits = self.other.bit_length()
        self.by_point = np.full(0x110000, self.other, np.int64)
        for c, i in symbol.items():
            if len(c) == 1:
                self.by_point[ord(c)] = i
        rank = {v: k for k, v in enumerate(sorted(set(self.score.values()), reverse=True))}
        rows = [((symbol[p[:k]] << self.bits) | symbol[p[k:]], rank[self.score[p]], self.id_of[p])
                for p in self.score for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        table = np.array(sorted(rows) or [(-1, 0, 0)], np.int64)
        self.keys, self.ranks, self.made = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (left << self.bits) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NO_PAIR), self.made[at]

    def merge_many(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all stretches, one after the other, and their number in each."""
        count = np.fromiter(map(len, stretches), np.int64, len(stretches))
        flat = self.by_point[_points("".join(stretches))]
        seq = np.repeat(np.arange(len(count)), count)
        rank, made = np.full(len(flat), _NO_PAIR), np.zeros(len(flat), np.int64)
        rank[:-1], made[:-1] = self._look_up(flat[:-1], flat[1:])
        rank[np.cumsum(count) - 1] = _NO_PAIR  # a stretch's last symbol has no right neighbour
        done_flat, done_seq = [], []
        while len(flat):
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            size = np.diff(np.r_[first, len(flat)])
            low = np.repeat(np.minimum.reduceat(rank, first), size)
            stay = low < _NO_PAIR
            if not stay.all():
                done_flat.append(flat[~stay])
                done_seq.append(seq[~stay])
                flat, seq, rank, made, low = flat[stay], seq[stay], rank[stay], made[stay], low[stay]
                if not len(flat):
                    break
            p = np.flatnonzero(rank == low)
            p = p[np.r_[True, seq[p[1:]] != seq[p[:-1]]]]
            flat[p] = made[p]
            keep = np.ones(len(flat), bool)
            keep[p + 1] = False
            p = p - np.arange(len(p))
            flat, seq, rank, made = flat[keep], seq[keep], rank[keep], made[keep]
            for q in (p, p - 1):  # the pairs on both sides of a new symbol
                q = q[(q >= 0) & (q < len(flat) - 1)]
                new, what = self._look_up(flat[q], flat[q + 1])
                rank[q], made[q] = np.where(seq[q] == seq[q + 1], new, _NO_PAIR), what
            rank[-1] = _NO_PAIR
        seq = np.concatenate(done_seq)
        order = np.argsort(seq, kind="stable")
        return np.concatenate(done_flat)[order], np.bincount(seq, minlength=len(count))

    def merge(self, stretch: str) -> list[str]:
        """Symbols of a stretch: the best-scored pair is merged first, the leftmost of equal ones."""
        score = self.score
        symbols: list[str | None] = list(stretch)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            s = score.get(symbols[i] + symbols[i + 1])
            if s is not None:
                heap.append((-s, i, i + 1, symbols[i] + symbols[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, j, made = heapq.heappop(heap)
            a = symbols[i]
            if a is None or right[i] != j or symbols[j] is None or len(a) + len(symbols[j]) != len(made):
                continue  # one side has been merged meanwhile
            symbols[i], symbols[j] = made, None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                s = score.get(made + symbols[k])
                if s is not None:
                    heapq.heappush(heap, (-s, i, k, made + symbols[k]))
            h = left[i]
            if h >= 0:
                s = score.get(symbols[h] + made)
                if s is not None:
                    heapq.heappush(heap, (-s, h, i, symbols[h] + made))
        return [s for s in symbols if s is not None]

    def _entry(self, symbols: list[str]) -> tuple[str, bytes, str]:
        """(ids as text, normalised characters that each id stands for, decoded text)."""
        ids, chars = [], bytearray()
        for s in symbols:
            i = self.id_of.get(s)
            if i is not None:
                ids.append(i)
                chars.append(len(s))
            else:
                raw = s.encode("utf-8", "surrogatepass")
                ids += self.byte_id[list(raw)].tolist()
                chars += bytes(len(raw) - 1) + b"\1"
        return " ".join(map(str, ids)), bytes(chars), self._text(ids)

    def _learn(self, stretches: set[str]) -> None:
        """Entries of new stretches of bounded length, merged together."""
        new = [s for s in stretches if s not in self.known]
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known = {}
            new = list(stretches)
        if not new:
            return
        flat, count = self.merge_many(new)
        ids, at, known, n = flat.tolist(), 0, self.known, len(self.pieces)
        name, shown, pieces = self.name, self.shown, self.pieces
        whole = np.add.reduceat(flat >= n, np.cumsum(count) - count) == 0
        for s, k, ok in zip(new, count.tolist(), whole.tolist()):
            own = ids[at:at + k]
            at += k
            if ok:
                known[s] = (" ".join([name[i] for i in own]), bytes([len(pieces[i]) for i in own]),
                            "".join([shown[i] for i in own]))
            else:  # characters outside the vocabulary
                symbols, here = [], 0
                for i in own:
                    size = len(pieces[i]) if i < n else 1
                    symbols.append(s[here:here + size])
                    here += size
                known[s] = self._entry(symbols)

    def _text(self, ids) -> str:
        out, run = [], bytearray()
        for i in ids:
            byte = self.byte_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if self.kind[i] == _NORMAL:
                out.append(self.pieces[i].replace(SPACE, " "))
            elif self.kind[i] == _UNKNOWN:
                out.append(" ⁇ ")
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def _begun(self, text: str) -> str:
        """Decoded text without the space that encoding put before it."""
        return text[1:] if (self.dummy_prefix or self.remove_extra) and text.startswith(" ") else text

    def decode(self, ids) -> str:
        return self._begun(self._text(int(i) for i in ids))

    def encode_batch(self, texts: list[str]):
        """For each text: ids as text with the end id, first and last source byte of each
        piece, decoded text."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size > BATCH_CHARS:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)

    def _encode(self, texts: list[str]):
        forms = [self.normalise(t) for t in texts]
        cuts = [self.cut.findall(form) for form, _ in forms]
        self._learn({s for c in cuts for s in c if len(s) <= CACHE_CHARS})
        known, end = self.known, str(self.end_id)
        for (_, at), c in zip(forms, cuts):
            found = [known.get(s) or self._entry(self.merge(s)) for s in c]
            chars = np.frombuffer(b"".join([x[1] for x in found]), np.uint8)
            ends = np.cumsum(chars, dtype=np.int64)
            last = int(at[-1])  # the end id stands where the encoded text ends
            yield (" ".join([x[0] for x in found] + [end]), np.append(at[ends - chars], last),
                   np.append(at[ends], last), self._begun("".join([x[2] for x in found])))

    def encode(self, text: str) -> tuple[str, np.ndarray, np.ndarray, str]:
        return next(self.encode_batch([text]))


@lru_cache(maxsize=2)
def _codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_documents(docs: DataFrame, model: str | None = None, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(doc_id, ids, starts, ends, decoded): the ids with the end id, and for each the bytes
    ``starts <= b < ends`` of the original text that it stands for.

    ``model`` is a path readable on every executor (default: the installed public file).
    """
    @F.pandas_udf("ids array<int>, starts array<long>, ends array<long>, decoded string")
    def encoded(texts: pd.Series) -> pd.DataFrame:
        codec = _codec(model or default_model())
        rows = list(codec.encode_batch([t or "" for t in texts]))
        return pd.DataFrame({"ids": [[int(i) for i in r[0].split()] for r in rows],
                             "starts": [r[1] for r in rows], "ends": [r[2] for r in rows],
                             "decoded": [r[3] for r in rows]})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.select("doc_id", encoded.asNondeterministic()("text").alias("e")).select("doc_id", "e.*")


def encoding_digests(docs: DataFrame, model: str | None = None, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32, covered) of what
    ``encode_documents`` gives: ``spans_crc32`` is that of all starts, then all ends, as
    little-endian 64-bit numbers, ``covered`` whether the spans follow each other without a
    gap over the whole text."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long, covered boolean")
    def digests(texts: pd.Series) -> pd.DataFrame:
        codec, rows = _codec(model or default_model()), []
        for ids, starts, ends, decoded in codec.encode_batch([t or "" for t in texts]):
            tiled = starts[0] == 0 and bool((starts[1:] == ends[:-1]).all())
            rows.append((len(starts), hashlib.sha256(ids.encode()).hexdigest(),
                         hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(),
                         zlib.crc32(ends.astype("<i8").tobytes(), zlib.crc32(starts.astype("<i8").tobytes())), tiled))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32", "covered"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.select("doc_id", digests.asNondeterministic()("text").alias("d")).select("doc_id", "d.*")
