"""Conversation structure repair with an audit of the cheapest edits.

The edits of a conversation's rows that make its roles read ``(s?(ua)+)?`` are
found by a dynamic programme over four states (nothing yet, after a system
row, after a user row, after an assistant row).  An audit is a path of linked
nodes: states that go on from the same edits share them, every node holds a
rolling hash of its path and its ancestors at powers of two, and audits of
equal cost are ordered by a search for their longest common prefix along these
ancestors; nodes that the hashes call equal are compared character by
character up to the node they share.

No conversation needs to fit into a task.  Equal rows are counted first; all
rows are numbered in the order (conversation, turn, role, text digest) and cut
into chunks of ``CHUNK`` rows whatever conversations they belong to.  A chunk
gives, for the part of a conversation in it, the cheapest audit from every
state to every state; parts of conversations that touch a chunk's border are
put together in order.  Texts are only joined to the repaired lines, which are
hashed in order as a stream (a SHA-256 has no parts, so one conversation's
digest is one task's stream, never its memory).

Defined cases: NULL role or text is one space, NULL turn comes first, NULL
conversation is a conversation; rows of one turn are in order of role and text
digest; a row whose role is empty, or begins with another letter, cannot be
kept; repeated rows are duplicates; a conversation without rows has zeros and
an empty audit; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import add_sequence
from .common import written

BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
#: Rows of a chunk; equal rows are unfolded so many at a time.
CHUNK = 4096

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
#: State -> role initial -> state: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTING = (0, 3)
NEXT_ROLE = ("user", "user", "assistant", "user")
LEGAL_PAIRS = ("su", "ua", "au")

_HASH_BASE, _HASH_MOD = 1_000_003, (1 << 61) - 1


class Audits:
    """Edit strings as linked nodes that share prefixes; node 0 is the empty one."""

    def __init__(self, base: int = _HASH_BASE, mod: int = _HASH_MOD):
        self.base, self.mod = base, mod
        self.edit, self.depth, self.hash = [""], [0], [0]
        self.up: list[tuple[int, ...]] = [()]  # ancestors 1, 2, 4, ... steps above

    def add(self, parent: int, edit: str) -> int:
        node, ups, a, k = len(self.edit), [parent], parent, 0
        while k < len(self.up[a]):
            a = self.up[a][k]
            ups.append(a)
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.base + ord(edit)) % self.mod)
        self.up.append(tuple(ups))
        return node

    def ancestor(self, node: int, depth: int) -> int:
        """The node of the first ``depth`` edits."""
        while (rest := self.depth[node] - depth) > 0:
            node = self.up[node][rest.bit_length() - 1]
        return node

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix."""
        least = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, least), self.ancestor(b, least)
        if self.hash[a] != self.hash[b]:
            for k in range(least.bit_length() - 1, -1, -1):
                if k < len(self.up[a]) and k < len(self.up[b]):
                    x, y = self.up[a][k], self.up[b][k]
                    if self.hash[x] != self.hash[y]:
                        a, b = x, y
            a, b = self.up[a][0], self.up[b][0]
        found = self.depth[a]
        while a != b:  # equal hashes of different nodes: look at the edits themselves
            if self.edit[a] != self.edit[b]:
                found = self.depth[a] - 1
            a, b = self.up[a][0], self.up[b][0]
        return found

    def less(self, a: int, b: int) -> bool:
        n = self.common(a, b)
        if n == self.depth[a] or n == self.depth[b]:
            return self.depth[a] < self.depth[b]
        return self.edit[self.ancestor(a, n + 1)] < self.edit[self.ancestor(b, n + 1)]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def cheapest_edits(rows, start: int) -> list[tuple[int, str] | None]:
    """(cost, audit) of the cheapest edits of (initial, must go, truncated) rows that lead
    from ``start`` to each state; of equal cost the ASCII-least audit."""
    audits = Audits()
    best: list[tuple[int, int] | None] = [None] * len(MOVES)
    best[start] = (0, 0)

    def better(old, cost: int, parent: int, edit: str):
        if old is not None and cost > old[0]:
            return old
        new = (cost, audits.add(parent, edit))
        return new if old is None or cost < old[0] or audits.less(new[1], old[1]) else old

    def inserted(states):
        """Cheapest ways with rows put in here: a user row, then an assistant row."""
        after_user, after_assistant = states[2], states[3]
        for s in (0, 1, 3):
            if states[s]:
                after_user = better(after_user, states[s][0] + COST[INSERT], states[s][1], INSERT)
        if after_user:
            after_assistant = better(after_assistant, after_user[0] + COST[INSERT], after_user[1], INSERT)
        return [states[0], states[1], after_user, after_assistant]

    for initial, gone, truncated in rows:
        best = inserted(best)
        new: list[tuple[int, int] | None] = [None] * len(MOVES)
        extra = TRUNCATED_COST if truncated else 0
        for s, at in enumerate(best):
            if at is None:
                continue
            cost, node = at
            new[s] = better(new[s], cost + COST[DELETE], node, DELETE)
            if gone:
                continue
            if initial in MOVES[s]:
                to = MOVES[s][initial]
                new[to] = better(new[to], cost + COST[KEEP] + extra, node, KEEP)
            to = MOVES[s][NEXT_ROLE[s][0]]
            new[to] = better(new[to], cost + COST[REROLE] + extra, node, REROLE)
        best = new
    return [at and (at[0], audits.text(at[1])) for at in inserted(best)]


def repaired_lines(audit: str, start: int, roles) -> Iterator[tuple[int | None, str]]:
    """(row number or None for an inserted line, role) of every line that an audit leaves."""
    state, row = start, 0
    for edit in audit:
        if edit == DELETE:
            row += 1
            continue
        role = roles[row] if edit == KEEP else NEXT_ROLE[state]
        state = MOVES[state][role[0]]
        yield (None if edit == INSERT else row), role
        row += edit != INSERT


_PARTS = ("conv string, chunk long, edge boolean, first string, last string, blank long, duplicate long, "
          "truncated long, illegal long, costs array<long>, audits array<string>")
_N = len(MOVES)


def _parts(pdf: pd.DataFrame) -> pd.DataFrame:
    """A row per conversation in a chunk: counts and the table of audits."""
    pdf = pdf.sort_values("seq", kind="stable")
    out, chunk = [], int(pdf["chunk"].iloc[0])
    convs = pdf["conv"].to_numpy()
    cuts = [0, *[i for i in range(1, len(convs)) if convs[i] != convs[i - 1]], len(convs)]
    initials, blank, first, truncated = (pdf[c].tolist() for c in ("initial", "blank", "first", "truncated"))
    for a, z in zip(cuts, cuts[1:]):
        rows = [(initials[i], blank[i] or not first[i], truncated[i]) for i in range(a, z)]
        dup = sum(not first[i] and not blank[i] for i in range(a, z))
        cut = sum(truncated[i] and first[i] for i in range(a, z))
        bad = sum(initials[i - 1] + initials[i] not in LEGAL_PAIRS for i in range(a + 1, z))
        costs, audits = [None] * _N * _N, [None] * _N * _N
        for start in range(_N) if a == 0 else (0,):  # only the first may have begun in another chunk
            for to, found in enumerate(cheapest_edits(rows, start)):
                if found:
                    costs[start * _N + to], audits[start * _N + to] = found
        out.append((convs[a], chunk, a == 0 or z == len(convs), initials[a], initials[z - 1],
                    sum(blank[a:z]), dup, cut, bad, costs, audits))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _PARTS.split(", ")])


def _better(old, new):
    return new if old is None or new[:2] < old[:2] else old


def _join_parts(batches):
    """Conversations of several parts, as a stream in (conv, chunk) order: for each part the
    states it begins and ends in on the cheapest way, and illegal pairs across the border."""
    def closed(conv, parts, states):
        found = None
        for s in ACCEPTING:
            if states[s]:
                found = _better(found, (*states[s], s))
        rows, to = [], found[2]
        for chunk, back, crossing in reversed(parts):
            rows.append((conv, chunk, back[to], to, crossing))
            to = back[to]
        return rows

    conv, parts, states, last, out = None, [], [], None, []
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            if r.conv != conv:
                if conv is not None:
                    out += closed(conv, parts, states)
                conv, parts, last = r.conv, [], None
                states = [(0, ""), *[None] * (_N - 1)]
            new, back = [None] * _N, [None] * _N
            for s, at in enumerate(states):
                for to in range(_N):
                    cost, audit = r.costs[s * _N + to], r.audits[s * _N + to]
                    if at is not None and audit is not None:
                        way = _better(new[to], (at[0] + int(cost), at[1] + audit))
                        if way is not new[to]:
                            new[to], back[to] = way, s
            crossing = int(last is not None and last + r.first not in LEGAL_PAIRS)
            parts.append((r.chunk, back, crossing))
            states, last = new, r.last
        yield pd.DataFrame(out, columns=_WAY)
        out = []
    if conv is not None:
        yield pd.DataFrame(closed(conv, parts, states), columns=_WAY)


_WAY = ["conv", "chunk", "start", "to", "crossing"]


def _lines(rows: pd.DataFrame, ways: pd.DataFrame) -> pd.DataFrame:
    """The repaired lines of a chunk: (conv, chunk, line, rid or -1, role)."""
    out = []
    if len(rows):
        rows = rows.sort_values("seq", kind="stable")
        own = {c: g for c, g in rows.groupby("conv", sort=False)}
        for w in ways.itertuples(index=False):
            roles, rids = own[w.conv]["role"].tolist(), own[w.conv]["rid"].tolist()
            for k, (row, role) in enumerate(repaired_lines(w.audit, w.start, roles)):
                out.append((w.conv, w.chunk, k, -1 if row is None else rids[row], role))
    return pd.DataFrame(out, columns=["conv", "chunk", "line", "rid", "role"])


def _digests(batches):
    """SHA-256 of each conversation's lines, as a stream in order."""
    conv, state = None, None
    for pdf in batches:
        out = []
        for c, role, text in zip(pdf["conv"], pdf["role"], pdf["text"]):
            if c != conv:
                if conv is not None:
                    out.append((conv, state.hexdigest()))
                conv, state = c, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
    if conv is not None:
        yield pd.DataFrame([(conv, state.hexdigest())], columns=["conv", "repaired_sha256"])


def conversation_key(conv: Column) -> Column:
    """The conversation as text, NULL apart from every value."""
    return F.coalesce(F.concat(F.lit("c"), conv.cast("string")), F.lit("null"))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with known faults, by the checksum of conversation and turn."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn))) % 20
    out = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), shown(role).alias("role"),
                      shown(text).alias("text"), kind.alias("kind")).filter("kind <> 0")
    k = F.col("kind")
    out = out.select("conv", "turn", F.when(k == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                     F.when(k == 1, F.lit("")).when(k == 2, F.translate("text", STOPS, ""))
                     .otherwise(F.col("text")).alias("text"), k.alias("kind"))
    copies = F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.select("conv", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows (narrow, without texts) in the order of conversations, with their faults and chunk."""
    f = (rows.groupBy("conv", "role", "digest")
         .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))).alias("f"))
         .select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
                 F.col("f.turn").alias("t"), F.lit(True).alias("first")))
    narrow = rows.select("rid", "conv", "turn", "role", "digest", "initial", "blank", "truncated", "n")
    same = (narrow["conv"] == f["c"]) & (narrow["role"] == f["r"]) & (narrow["digest"] == f["d"]) & \
        narrow["turn"].eqNullSafe(f["t"])
    narrow = narrow.join(f, same, "left").drop("c", "r", "d", "t").fillna(False, ["first"])
    seq = add_sequence(narrow, ["conv", "turn", "role", "digest"], seq_col="base", weight="n")
    # copies of a row in two levels, so that no array grows with their number
    seq = seq.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / F.lit(CHUNK)).cast("long"))))
    low = F.col("lot") * CHUNK
    seq = seq.withColumn("i", F.explode(F.sequence(low, F.least(F.col("n") - 1, low + (CHUNK - 1)))))
    return seq.select("rid", "conv", "role", "initial", "blank", "truncated",
                      (F.col("first") & (F.col("i") == 0)).alias("first"), (F.col("base") + F.col("i")).alias("seq"),
                      F.floor((F.col("base") + F.col("i")) / F.lit(CHUNK)).cast("long").alias("chunk"))


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for rows
    (conv, turn, role, text); a row per conversation of ``conversations`` (column conv; default:
    those of the rows)."""
    ids = (rows if conversations is None else conversations).select("conv").distinct()
    ids = ids.withColumn("key", conversation_key(F.col("conv")))
    text = F.rtrim(F.col("text"), F.lit(BLANKS))
    known = rows.select(conversation_key(F.col("conv")).alias("conv"), "turn",
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    known = (known.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
             .select("*", F.unhex(F.sha2("text", 256)).alias("digest"), F.substring("role", 1, 1).alias("initial"),
                     (text == "").alias("blank"),
                     ((text != "") & ~F.substring(text, -1, 1).isin(*STOPS)).alias("truncated"),
                     F.monotonically_increasing_id().alias("rid")))
    known = written(known, "conv-rows")
    chunks = written(_numbered(known), "conv-chunks")
    narrow = chunks.select("conv", "initial", "blank", "truncated", "first", "seq", "chunk")
    parts = written(narrow.groupBy("chunk").applyInPandas(_parts, _PARTS), "conv-parts")

    inside = parts.filter("not edge").select(
        "conv", "chunk", F.lit(0).alias("start"), F.lit(0).alias("crossing"),
        F.array_min(F.filter(F.array(*[F.struct(F.col("costs")[s].alias("cost"), F.col("audits")[s].alias("audit"))
                                       for s in ACCEPTING]), lambda x: x["audit"].isNotNull())).alias("w"))
    edges = parts.filter("edge")
    ways = (edges.select("conv", "chunk", "first", "last", "costs", "audits").repartition("conv")
            .sortWithinPartitions("conv", "chunk")
            .mapInPandas(_join_parts, "conv string, chunk long, start int, to int, crossing int"))
    at = F.col("start") * _N + F.col("to") + 1
    outer = ways.join(edges.select("conv", "chunk", "costs", "audits"), ["conv", "chunk"]).select(
        "conv", "chunk", "start", "crossing", F.struct(F.element_at("costs", at).alias("cost"),
                                                       F.element_at("audits", at).alias("audit")).alias("w"))
    chosen = written(inside.unionAll(outer).select("conv", "chunk", "start", "crossing", "w.cost", "w.audit"),
                     "conv-edits")

    found = chosen.join(parts.select("conv", "chunk", "blank", "duplicate", "truncated", "illegal"),
                        ["conv", "chunk"])
    pieces = F.array_sort(F.collect_list(F.struct("chunk", "audit")))
    totals = found.groupBy("conv").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        F.sum(F.col("illegal") + F.col("crossing")).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda x: x["audit"]), "").alias("audit"))
    turns = known.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))

    lines = (chunks.select("conv", "role", "rid", "seq", "chunk").groupBy("chunk")
             .cogroup(chosen.select("conv", "chunk", "start", "audit").groupBy("chunk"))
             .applyInPandas(_lines, "conv string, chunk long, line long, rid long, role string"))
    texts = known.select("rid", "text")
    lines = lines.join(texts, "rid", "left").select("conv", "chunk", "line", "role",
                                                    F.coalesce("text", F.lit("")).alias("text"))
    digests = (lines.repartition("conv").sortWithinPartitions("conv", "chunk", "line")
               .mapInPandas(_digests, "conv string, repaired_sha256 string"))

    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    all_ = totals.join(turns, "conv", "left").join(digests, "conv", "left").withColumnRenamed("conv", "key")
    return ids.join(all_, "key", "left").select(
        "conv", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
