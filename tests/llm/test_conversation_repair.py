import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

import tollcast.llm.conversation_repair as m
from tollcast.llm import oracle
from tollcast.llm.queries import QUERIES

from .conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def every_audit(rows):
    """All edit strings with costs, of up to two inserted rows at a place, by plain enumeration."""
    def go(i, roles, cost, audit, inserts):
        if inserts < 2:
            for r in "ua":
                yield from go(i, roles + r, cost + 5, audit + "I", inserts + 1)
        if i == len(rows):
            if re.fullmatch(r"(s?(ua)+)?", roles):
                yield cost, audit
            return
        initial, gone, truncated = rows[i]
        yield from go(i + 1, roles, cost + 2, audit + "D", 0)
        if not gone:
            yield from go(i + 1, roles + (initial or "?"), cost + 5 * truncated, audit + "K", 0)
            for r in "ua":
                yield from go(i + 1, roles + r, cost + 1 + 5 * truncated, audit + "R", 0)

    return go(0, "", 0, "", 0)


def plain_best(rows):
    """The cheapest, ASCII-least audit by a table over whole strings."""
    best = {"": (0, "")}
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def put(to, s, value):
        if s not in to or value < to[s]:
            to[s] = value

    def spread(states):
        for _ in range(3):
            for s, (c, a) in list(states.items()):
                for r in "ua":
                    if (s, r) in step:
                        put(states, step[s, r], (c + 5, a + "I"))
        return states

    for initial, gone, truncated in rows:
        new = {}
        for s, (c, a) in spread(best).items():
            put(new, s, (c + 2, a + "D"))
            if gone:
                continue
            if (s, initial) in step:
                put(new, step[s, initial], (c + 5 * truncated, a + "K"))
            for r in "ua":
                if (s, r) in step:
                    put(new, step[s, r], (c + 1 + 5 * truncated, a + "R"))
        best = new
    best = spread(best)
    return min(best[s] for s in ("", "a") if s in best)


def plain(conversations):
    """The contract's result in plain Python."""
    convs = defaultdict(list)
    for c, t, r, x in conversations:
        rows = convs[c]
        shown = [" " if v is None else str(v) for v in (c, t)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if kind == 0:
            continue
        if kind == 1:
            x = ""
        if kind == 2:
            x = re.sub("[.!?]", "", x)
        if kind == 4:
            r = "user"
        rows += [(t, r, x)] * (2 if kind == 3 else 1)
    return {c: faults_and_repair(rows) for c, rows in convs.items()}


def faults_and_repair(rows):
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()))
    seen, marks, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
    for _, r, x in rows:
        end = x.rstrip(BLANK)
        fault = ("blank" if not end else "duplicate" if (r, x) in seen else
                 "truncated" if end[-1] not in ".!?" else None)
        seen.add((r, x))
        if fault:
            counts[fault] += 1
        marks.append((r[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
    cost, audit = plain_best(marks)
    lines, i, last = [], 0, ""
    for e in audit:
        if e == "D":
            i += 1
            continue
        role = rows[i][1] if e == "K" else "assistant" if last == "u" else "user"
        lines.append(f"{role}:{'' if e == 'I' else rows[i][2]}")
        last, i = role[0], i + (e != "I")
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"],
            counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def as_plain(rows):
    return {r[0]: tuple(r)[1:] for r in rows}


def marks(rnd, n):
    return [(rnd.choice(["s", "u", "u", "a", "a", "t", ""]), rnd.random() < 0.2, rnd.random() < 0.2) for _ in range(n)]


def own_best(rows):
    found = m.cheapest_edits(rows, 0)
    return min(found[s] for s in m.ACCEPTING if found[s])


def test_audits_against_enumeration():
    rnd = random.Random(1)
    for n, times in enumerate((1, 25, 40, 40, 3)):
        for _ in range(times):
            rows = marks(rnd, n)
            assert own_best(rows) == min(every_audit(rows)) == plain_best(rows)


def test_long_audits_against_whole_strings():
    rnd = random.Random(2)
    for n in (30, 200, 700):
        for _ in range(6):
            rows = marks(rnd, n)
            assert own_best(rows) == plain_best(rows)


@pytest.mark.parametrize("mod", [1, 2, 7, m._HASH_MOD])  # 1: every two paths of a length collide
def test_prefixes_and_order_of_linked_nodes(mod):
    rnd, audits = random.Random(mod), m.Audits(mod=mod)
    nodes = [0]
    for _ in range(400):
        nodes.append(audits.add(rnd.choice(nodes[-40:]), rnd.choice("DIKR")))
    for _ in range(3000):
        a, b = rnd.choice(nodes), rnd.choice(nodes)
        x, y = audits.text(a), audits.text(b)
        n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        # one string may stand on several nodes here
        assert audits.common(a, b) == n
        assert audits.less(a, b) == (x < y)
        if x:
            d = rnd.randrange(len(x) + 1)
            assert audits.text(audits.ancestor(a, d)) == x[:d]


def random_conversations(rnd, convs, rows):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["a.", "b!", "cut off", "", " \t", "what?\n", None, "x" * 40 + ".", "yes.", "no."]
    return [(rnd.choice([*range(convs), None]), rnd.choice([None, *range(40)]), rnd.choice(roles), rnd.choice(texts))
            for _ in range(rows)]


@pytest.mark.parametrize("chunk", [1, 3, 50, 4096])
def test_chunks_change_nothing(spark, monkeypatch, chunk):
    monkeypatch.setattr(m, "CHUNK", chunk)
    rows = random_conversations(random.Random(chunk), 12, 250)
    df = spark.createDataFrame(rows, SCHEMA)
    out = m.repair(m.damage(df), df.withColumnRenamed("conv_id", "conv")).collect()
    assert as_plain(out) == plain(rows)


def test_one_conversation_of_most_rows(spark):
    rnd = random.Random(5)
    roles = ["user", "assistant", "system"]
    rows = [(7, i, rnd.choice(roles), rnd.choice(["yes.", f"text {i}.", f"cut {i}", ""])) for i in range(9000)]
    rows += random_conversations(rnd, 5, 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    out = m.repair(m.damage(df), df.withColumnRenamed("conv_id", "conv"))
    assert as_plain(out.collect()) == plain(rows)


def test_one_row_many_times(spark):
    rows = [(1, 1, "user", "same."), (1, 2, "assistant", "b.")] + [(1, 1, "user", "same.")] * 5000
    df = spark.createDataFrame(rows, SCHEMA)
    assert as_plain(m.repair(m.damage(df)).collect()) == plain(rows)


def test_query_and_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    cols = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = QUERIES["op12_conversation_repair"](spark, SF001)
    assert found.columns == cols
    rows = as_plain(found.collect())
    assert rows == as_plain(con.sql(oracle.CONVERSATION_REPAIR).select(*cols).fetchall())
    assert rows == plain(con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall())


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (2, None, None, None), (None, 3, "assistant", "a."), (None, None, "user", "u."),
            (3, 0, "", "x."), (4, 5, "user", "hm."), (4, 5, "user", "hm."), (9 << 55, 1, "user", "big id.")]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", chunk int")
    out = m.repair(m.damage(df), df.withColumnRenamed("conv_id", "conv"))
    assert as_plain(out.collect()) == plain(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert m.repair(m.damage(empty)).collect() == []
    gone = [r for r in [(c, t, "user", "x.") for c in range(50) for t in range(3)]
            if zlib.crc32(f"{r[0]}:{r[1]}".encode()) % 20 == 0][:1]
    df = spark.createDataFrame(gone, SCHEMA)
    out = m.repair(m.damage(df), df.withColumnRenamed("conv_id", "conv")).collect()
    assert as_plain(out) == {gone[0][0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
