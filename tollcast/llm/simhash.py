"""SimHash near-duplicates with a generalised pigeonhole search.

Fingerprints: 64 majority bits over the XXH64 values of a text's word
shingles.  The search works on distinct fingerprints only:

1. Bits are grouped: starting from the most even bit, a part takes the bits
   most correlated with it, until the 64 bits are dealt into ``parts`` parts.
   Correlations come from one 64 x 64 table of co-occurrence counts.
2. A histogram per part (at most ``parts * 2**width`` numbers, a bound that
   does not depend on the corpus) gives for each projection how many
   fingerprints lie within 0, 1, 2 ... bits of it.
3. For every fingerprint a dynamic program allocates a threshold to each part
   (-1: not probed) with ``sum(thresholds) = max_bits - parts + 1``, at the
   least estimated candidates plus probes.  By the generalised pigeonhole
   principle a fingerprint within ``max_bits`` agrees within its threshold in
   at least one part.
4. Fingerprints are indexed by their own projections and probe all those
   within their thresholds; both meet in a shuffle on (part, projection).
   A projection that holds more than ``TILE`` fingerprints is cut into tiles
   on both sides.  Candidates are compared in arrays and never become rows:
   a stretch of the shuffle yields its links, and where they outnumber its
   fingerprints, one row per fingerprint that joins it to the smallest
   fingerprint it is linked with directly or through others.
5. Components by star contraction, then the smallest doc_id of each.

Defined cases: a NULL or empty text, or one of white space, has fingerprint
zero and links like any other; a NULL doc_id is never the smallest, and a
component of such rows only has a NULL id; repeated rows get equal results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, written
from .graph import connected_components

PARTS = 4
#: Fingerprints a side in one comparison of a frequent projection.
TILE = 4096
_CHUNK = 2_000_000
_SEED = 42


def text_fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and \x09-\x0D, \x20 only
    if not words:
        return 0
    buf = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = len(words) - k + 1
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        j = min(n, i + (1 << 16))
        spans = zip(starts[i:j].tolist(), ends[i + k - 1:j + k - 1].tolist())
        hashes = np.array([h(buf[s:e], _SEED) for s, e in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle_words: int = 3, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash) per row; fp holds the fingerprint's bits as a signed long."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([text_fingerprint(t, shingle_words) for t in texts],
                                  np.uint64).view(np.int64))

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.select("doc_id", fp("text").alias("fp"), F.xxhash64("text").alias("text_hash"))


def correlated_parts(pairs: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits dealt into parts of near equal width, correlated ones together.

    ``pairs[i, j]`` counts the fingerprints with bits i and j set.
    """
    n = max(n, 1)
    p = np.diag(pairs) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((pairs / n - np.outer(p, p)) / np.outer(spread, spread))
    left, out = list(range(64)), []
    for k in range(parts):
        width = -(-len(left) // (parts - k))
        part = [max(left, key=lambda i: (spread[i], -i))]
        left.remove(part[0])
        while len(part) < width:
            best = max(left, key=lambda i: (corr[i, part].mean(), -i))
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def _project(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def _flips(width: int, r: int) -> np.ndarray:
    """All masks of exactly ``r`` of ``width`` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), r)], np.int64)


def within(hist: np.ndarray, width: int, most: int) -> np.ndarray:
    """[t, v]: fingerprints whose projection differs from v in at most t bits."""
    total, out = np.zeros_like(hist), []
    v = np.arange(len(hist))
    for r in range(most + 1):
        for mask in _flips(width, r).tolist():
            total = total + hist[v ^ mask]
        out.append(total)
    return np.stack(out)


def allocate(costs: list[np.ndarray], budget: int) -> np.ndarray:
    """Thresholds [part, fingerprint] of the least total cost.

    ``costs[p][t + 1]`` is the cost per fingerprint of threshold t in part p,
    t from -1 on; thresholds sum to ``budget``.  A dynamic program over parts.
    """
    parts, (levels, n) = len(costs), costs[0].shape
    target = budget + parts  # thresholds counted from 0 instead of -1
    best = np.full((target + 1, n), np.inf)
    best[0] = 0
    choice = []
    for c in costs:
        step = np.full((target + 1, n), np.inf)
        pick = np.zeros((target + 1, n), np.int8)
        for s in range(target + 1):
            for t in range(min(levels - 1, s) + 1):
                cost = best[s - t] + c[t]
                better = cost < step[s]
                step[s][better], pick[s][better] = cost[better], t
        best = step
        choice.append(pick)
    out, s = np.zeros((parts, n), np.int64), np.full(n, target)
    for p in range(parts - 1, -1, -1):
        out[p] = choice[p][s, np.arange(n)]
        s = s - out[p]
    return out - 1


def _bit_counts(batches):
    pairs, n = np.zeros((64, 64)), 0
    for pdf in batches:
        fps = pdf["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(fps, axis=1, bitorder="little").astype(np.float64)
        pairs += bits.T @ bits
        n += len(pdf)
    if n:
        yield pd.DataFrame({"i": np.arange(4097), "c": np.r_[pairs.ravel(), n].astype(np.int64)})


def _part_counts(groups: list[list[int]]):
    def run(batches):
        hist = [np.zeros(1 << len(g), np.int64) for g in groups]
        for pdf in batches:
            fps = pdf["fp"].to_numpy(np.int64).view(np.uint64)
            for h, g in zip(hist, groups):
                h += np.bincount(_project(fps, g), minlength=len(h))
        for p, h in enumerate(hist):
            v = np.flatnonzero(h)
            yield pd.DataFrame({"p": np.full(len(v), p), "v": v, "c": h[v]})
    return run


def _probes(groups, hist, max_bits: int, tile: int):
    """Index rows and probe rows of each fingerprint, keyed by a bucket number."""
    widths = [len(g) for g in groups]
    budget = max_bits - len(groups) + 1
    most = min(max_bits, max(budget + len(groups) - 1, 0))
    flips = [[_flips(w, r) for r in range(most + 1)] for w in widths]
    near = [within(h, w, most) for h, w in zip(hist, widths)]

    def run(batches):
        for pdf in batches:
            fps = pdf["fp"].to_numpy(np.int64)
            u = fps.view(np.uint64)
            spot = [_project(u, g) for g in groups]
            costs = []
            for p, w in enumerate(widths):
                probes = np.cumsum([len(f) for f in flips[p]])[:, None]
                costs.append(np.r_[np.zeros((1, len(fps))), near[p][:, spot[p]] + probes])
            t = allocate(costs, budget)
            salt = (u * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64)
            for p in range(len(groups)):
                # own projection: indexed always, a query if the part is probed at all
                yield from _tiles(p, spot[p], fps, salt, hist[p], tile, True, t[p] >= 0)
                for r in range(1, most + 1):
                    who = np.flatnonzero(t[p] >= r)
                    if len(who):
                        for lo in range(0, len(who), max(1, 500_000 // len(flips[p][r]))):
                            w = who[lo:lo + max(1, 500_000 // len(flips[p][r]))]
                            v = (spot[p][w][:, None] ^ flips[p][r][None, :]).ravel()
                            f, s = np.repeat(fps[w], len(flips[p][r])), np.repeat(salt[w], len(flips[p][r]))
                            some = hist[p][v] > 0  # empty projections hold no partner
                            yield from _tiles(p, v[some], f[some], s[some], hist[p], tile, False,
                                              np.ones(int(some.sum()), bool))
    return run


def _tiles(p, v, fps, salt, hist, tile, data, query):
    """A row per bucket; (query tile, data tile) of a frequent projection are buckets of their own."""
    k = -(-hist[v] // tile)
    one = k <= 1
    base = (np.int64(p) << 58) | (v << 28)
    out = [(base[one], fps[one], np.full(int(one.sum()), data), query[one])]
    for i in np.flatnonzero(~one):
        own, n = int(salt[i] % k[i]), int(k[i])
        if query[i]:
            b = base[i] | (own << 14) | np.arange(n)
            out.append((b, np.full(n, fps[i]), np.zeros(n, bool), np.ones(n, bool)))
        if data:
            b = base[i] | (np.arange(n) << 14) | own
            out.append((b, np.full(n, fps[i]), np.ones(n, bool), np.zeros(n, bool)))
    b, f, d, q = (np.concatenate(x) for x in zip(*out))
    use = d | q
    if use.any():
        yield pd.DataFrame({"bucket": b[use], "fp": f[use], "data": d[use], "query": q[use]})


def _smallest_linked(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Links as they are, or where they outnumber their ends, each end with the
    smallest fingerprint reachable over these links."""
    nodes, at = np.unique(np.r_[a, b], return_inverse=True)
    if len(a) > len(nodes):
        x, y = at[:len(a)], at[len(a):]
        label = np.arange(len(nodes))
        while True:
            low = label.copy()
            np.minimum.at(low, x, label[y])
            np.minimum.at(low, y, label[x])
            low = low[low]
            if (low == label).all():
                break
            label = low
        own = np.flatnonzero(label != np.arange(len(nodes)))
        a, b = nodes[own], nodes[label[own]]
    return pd.DataFrame({"a": a, "b": b})


def _verify(max_bits: int):
    """Compare the probes and index rows of each bucket; rows come sorted by bucket."""
    def links(pdf: pd.DataFrame):
        bucket, fps = pdf["bucket"].to_numpy(), pdf["fp"].to_numpy(np.int64)
        d, q = np.flatnonzero(pdf["data"].to_numpy()), np.flatnonzero(pdf["query"].to_numpy())
        first = np.searchsorted(bucket[d], bucket[q], "left")
        count = np.searchsorted(bucket[d], bucket[q], "right") - first
        cuts = np.searchsorted(np.cumsum(count), np.arange(_CHUNK, int(count.sum()), _CHUNK))
        held: list[np.ndarray] = []
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(q)]):
            c = count[lo:hi]
            if not c.sum():
                continue
            left = np.repeat(fps[q[lo:hi]], c)
            ramp = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
            right = fps[d[np.repeat(first[lo:hi], c) + ramp]]
            ok = (left != right) & (np.bitwise_count((left ^ right).view(np.uint64)) <= max_bits)
            if ok.any():
                held.append(_smallest_linked(np.minimum(left[ok], right[ok]),
                                             np.maximum(left[ok], right[ok])))
        if held:
            every = pd.concat(held).drop_duplicates()
            yield _smallest_linked(every["a"].to_numpy(), every["b"].to_numpy())

    def run(batches):
        carry = None
        for pdf in batches:
            pdf = pdf if carry is None else pd.concat([carry, pdf], ignore_index=True)
            if not len(pdf):
                continue
            bucket = pdf["bucket"].to_numpy()
            last = int(np.searchsorted(bucket, bucket[-1], "left"))  # its rows may go on
            if last:
                yield from links(pdf.iloc[:last])
            carry = pdf.iloc[last:].reset_index(drop=True)
        if carry is not None and len(carry):
            yield from links(carry)
    return run


def link_fingerprints(nodes: DataFrame, max_bits: int = 3, parts: int = PARTS,
                      tile: int = TILE) -> DataFrame:
    """(a, b) links of distinct fingerprints ``fp`` that span all pairs within ``max_bits``."""
    if not 2 <= parts <= max_bits + 1:
        raise ValueError("parts must lie between 2 and max_bits + 1")
    if -(-64 // parts) > 22:
        raise ValueError("parts of more than 22 bits have no bounded histogram")
    pairs = np.zeros(4097, np.int64)
    for i, c in nodes.select("fp").mapInPandas(_bit_counts, "i long, c long").groupBy("i").agg(
            F.sum("c")).collect():  # 4,097 numbers
        pairs[i] = c
    groups = correlated_parts(pairs[:4096].reshape(64, 64).astype(float), int(pairs[4096]), parts)
    hist = [np.zeros(1 << len(g), np.int64) for g in groups]
    counts = nodes.select("fp").mapInPandas(_part_counts(groups), "p int, v long, c long").groupBy(
        "p", "v").agg(F.sum("c").alias("c")).toPandas()  # at most parts * 2**width rows
    for p, h in enumerate(hist):
        mine = counts[counts["p"] == p]
        h[mine["v"].to_numpy()] = mine["c"].to_numpy()
    probes = nodes.select("fp").mapInPandas(_probes(groups, hist, max_bits, tile),
                                            "bucket long, fp long, data boolean, query boolean")
    met = probes.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInPandas(_verify(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3,
                    parts: int = PARTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash, component_id, component) per row.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, ``component`` the component's fingerprint key.
    """
    fps = written(fingerprints(docs, shingle_words, doc_id, text), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fp")
    roots = connected_components(link_fingerprints(nodes, max_bits, parts))
    joined = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    joined = written(joined, "fp-component")
    low = joined.groupBy("component").agg(F.min("low").alias("component_id"))
    label = joined.select("fp", "component").join(low, "component")
    return fps.join(label, "fp").select("doc_id", "fp", "text_hash", "component_id", "component")


def one_per_component(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3,
                      parts: int = PARTS) -> DataFrame:
    """The rows of ``docs`` with one document of each component left: the one of the
    smallest doc_id, NULL ids last, ties by text hash; of equal rows one stays."""
    found = written(near_duplicates(docs, shingle_words, max_bits, parts).select(
        "component", F.struct("doc_id", "text_hash").alias("k")), "near-duplicates")
    rank = F.struct(F.col("k.doc_id").isNull().alias("n"), "k")
    best = found.groupBy("component").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    # written: a large component is then one side of a plain join, which may be split
    best = written(best.filter("n > 1").select("component", F.col("best.k").alias("best")), "dedup-best")
    lost = found.join(best, "component").filter("k <> best").select("k").distinct()
    again = found.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k")
    lost = written(lost, "dedup-lost")
    again = written(again.join(lost, "k", "left_anti"), "dedup-repeated")
    rows = docs.select(packed(docs).alias("row"), F.struct(
        F.col("doc_id"), F.xxhash64("text").alias("text_hash")).alias("k"))
    # a merge join at any size: what is dropped grows with the corpus and is never broadcast
    kept = rows.join(lost.unionAll(again).hint("merge"), "k", "left_anti").select("row.*")
    # equal rows of a kept document: rare, so only these are brought together
    repeated = rows.join(again, "k").dropDuplicates(["k"]).select("row.*")
    return kept.unionAll(repeated)
