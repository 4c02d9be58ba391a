"""Hierarchical residual packing of token sequences.

Round 0 runs in the scan itself: every task tokenizes its documents, cuts the
longer ones and packs its pieces by best fit, longest first.  Bins whose free
room is within the round's slack are emitted; the others go up a tree, where
the underfull bins of ``fan_in`` children are packed again as single items.
Slack grows by round, the root emits all.  A node passes on at most
``max_open`` bins, those with the most room, and emits the others as they are,
so no task's input grows with the corpus and every piece is placed.  The bound
costs no sequence: best fit never opens a bin for an item of at most half the
capacity while a bin is half empty, so a call leaves at most one bin that is
at most half full, and any two others do not fit together.  A node's bins come
from few calls, so it holds few half-empty ones; each of them needs one
partner, and the bins with the most room, which are passed on, hold one if any
bin does.

Every round is written to the shared checkpoint folder before it is read by
the next one, so a lost task repeats its own round only and all readers see
the same bins.

Defined cases: a NULL text is an empty one (the end id alone); repeated rows
are packed once each; an empty table gives an empty result; a document of
more than ``capacity`` ids is cut into full pieces, of which the first may be
shorter.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .token_count import PRETOKEN_PATTERN, byte_symbols, default_vocabulary

#: Free tokens up to which a bin of round 0 is emitted; four times that a round later, and so on.
SLACK = 8
FAN_IN = 8
MAX_OPEN = 2048
#: Pieces that a task of round 0 packs together.
LOCAL_PIECES = 200_000

_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
           "sequence_id long, offset long, node long, open boolean")


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The file's vocabulary in two libraries that give the same ids.

    ``tiktoken`` runs the merges several times faster; texts that it refuses
    go to ``tokenizers``.
    """
    import tiktoken
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    byte_of = {c: b for b, c in byte_symbols().items()}
    ranks = {bytes(byte_of[c] for c in token): i
             for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("packing", pat_str=PRETOKEN_PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)
    return fast, Tokenizer.from_file(path)


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a whole text as little-endian unsigned 32-bit numbers."""
    fast, slow = _encoders(path)
    try:
        ids = fast.encode_to_numpy(text, allowed_special="all")
    except (ValueError, OverflowError, UnicodeError):
        ids = np.array(slow.encode(text, add_special_tokens=False).ids)
    return ids.astype("<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be short."""
    first = n if n <= capacity else (n % capacity or capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def best_fit(sizes, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best fit, longest first: (bin, offset) per item and the number of bins.

    Bins are kept by free room; a bit mask of the rooms in use finds the
    tightest one that holds an item.
    """
    sizes = np.asarray(sizes, np.int64)
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = bins = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            room, b, bins = capacity, bins, bins + 1
        where[i], offset[i] = b, capacity - room
        if room > size:
            by_room[room - size].append(b)
            mask |= 1 << (room - size)
    return where, offset, bins


def _stay_open(fill: np.ndarray, capacity: int, slack: int, max_open: int) -> np.ndarray:
    open_ = capacity - fill > slack
    if open_.sum() > max_open:
        most = np.argsort(fill, kind="stable")[:max_open]
        open_ = np.zeros(len(fill), bool)
        open_[most] = True
    return open_


def _first_round(capacity: int, end_id: int, path: str | None, slack: int, max_open: int):
    def pack(rows: list[tuple], pid: int, made: int) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        where, offset, n = best_fit(out["length"], capacity)
        fill = np.bincount(where, out["length"], minlength=n).astype(np.int64)
        stay = _stay_open(fill, capacity, slack, max_open)
        return out.assign(sequence_id=(pid << 32) + made + where, offset=offset, node=pid,
                          open=stay[where])

    def run(batches):
        pid, made, rows = TaskContext.get().partitionId(), 0, []
        vocabulary = path or default_vocabulary()
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = np.append(token_ids(text or "", vocabulary), np.uint32(end_id)).astype("<u4")
                raw = ids.tobytes()
                key = None if pd.isna(doc_id) else int(doc_id)
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((key, k, start, length,
                                 zlib.crc32(raw[4 * start:4 * (start + length)])))
            if len(rows) >= LOCAL_PIECES:
                yield pack(rows, pid, made)
                made, rows = made + len(rows), []
        if rows:
            yield pack(rows, pid, made)
    return run


def _merge_round(level: int, capacity: int, slack: int, max_open: int):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sequence_id", "offset"], kind="stable")
        old, item = np.unique(pdf["sequence_id"].to_numpy(), return_inverse=True)
        sizes = np.bincount(item, pdf["length"]).astype(np.int64)
        where, offset, n = best_fit(sizes, capacity)
        fill = np.bincount(where, sizes, minlength=n).astype(np.int64)
        stay = _stay_open(fill, capacity, slack, max_open)
        node = int(pdf["node"].iloc[0])
        return pdf.assign(sequence_id=(level << 56) + (node << 32) + where[item],
                          offset=pdf["offset"].to_numpy() + offset[item],
                          open=stay[where[item]])
    return merge


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2,
                   vocabulary: str | None = None, fan_in: int = FAN_IN, slack: int = SLACK,
                   max_open: int = MAX_OPEN, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rounds = [written(rows.mapInPandas(
        _first_round(capacity, end_id, vocabulary, slack, max_open), _SCHEMA), "pack-0")]
    nodes = int(rounds[0].agg(F.max("node")).first()[0] or 0) + 1
    level = 0
    while nodes > 1:
        level, nodes = level + 1, -(-nodes // fan_in)
        room = capacity if nodes == 1 else slack * 4 ** level
        up = (rounds[-1].filter("open")
              .withColumn("node", F.floor(F.col("node") / F.lit(fan_in)).cast("long")))
        rounds.append(written(up.groupBy("node").applyInPandas(
            _merge_round(level, capacity, room, max_open), _SCHEMA), f"pack-{level}"))
    last = len(rounds) - 1
    closed = [t if i == last else t.filter(~F.col("open")) for i, t in enumerate(rounds)]
    return reduce(DataFrame.unionAll, closed).drop("node", "open")
