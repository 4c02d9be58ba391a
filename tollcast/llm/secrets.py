"""Secret scans in DataFrame functions only.

Three patterns give the base spans.  The method adds spans of high entropy:
candidates are runs of ``window`` or more characters of the base64 alphabet
with letters and digits; a window slides over each, its character counts and
the sum of c * log2(c) are updated by the entering and the leaving character,
and the windows whose Shannon entropy reaches the threshold of the candidate's
character class (hex, alphanumeric, base64) mark the span from the first to
the last of them.  Candidates that match the allow-list, and spans that lie in
a base span, are suppressed.  With ``parts`` the alphanumeric parts of a run
(split at + / _ - =, a leading 0x left out) are judged by their own class too, so
what is joined to a secret does not lift its threshold; a part with a hot window
is a span as a whole, and the run's own span is widened to its parts' ends.

Positions come without Python: splitting a text at a pattern gives the gaps
between its matches, whose lengths are added up.  A text without a match
costs the pattern search only.

Defined cases: a NULL text is an empty one; repeated rows are scanned each;
matches of one kind do not overlap, those of different kinds may.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed

#: Fixed patterns of the base kinds, in their order, with the least length of a hit.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # all of a run, 20 or more characters
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")
ENTROPY_KIND = "entropy"

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Bits by character class: random strings of 20 lie above, words and names below.
THRESHOLDS = {"hex": 3.0, "alphanumeric": 3.6, "base64": 3.8}
#: Strings that look random and are none: uuids, dates and numbers, paths, placeholders.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[0-9+/_=-]+$",
    r"^([A-Za-z]+[/_-])+[A-Za-z]*[0-9]{0,4}$",
    r"(?i)example|placeholder|dummy|xxxx",
    r"^0x0+$",
    r"^(md5-([0-9a-fA-F]{32}|[A-Za-z0-9+/_-]{22}=*)|sha256-([0-9a-fA-F]{64}|[A-Za-z0-9+/_-]{43}=?)"
    r"|sha384-([0-9a-fA-F]{96}|[A-Za-z0-9+/_-]{64})|sha512-([0-9a-fA-F]{128}|[A-Za-z0-9+/_-]{86}=*))$",
)

_SPANS = "array<struct<start:int,stop:int>>"


def _positions(text: Column, matches: Column, pattern: str) -> Column:
    """Spans of the given matches of ``pattern``, in code points."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    steps = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["gap"]
        z = a + x["size"]
        return F.struct(z.alias("at"), F.concat(
            acc["out"], F.array(F.struct(a.alias("start"), z.alias("stop")))).alias("out"))

    found = F.aggregate(steps, start, add, lambda acc: acc["out"])
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(_SPANS))


def hot_range(candidate: Column, window: int, threshold: Column) -> Column:
    """Struct (start, stop) of the windows at or above the threshold, NULL fields if none."""
    plogp = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])
    chars = F.filter(F.split(candidate, ""), lambda c: c != "")

    # the run's characters, alphabet and threshold are bound once, as the fields of an array's one element, and
    # the characters become numbers of that alphabet, so the cost is linear in the run's length
    def bound(x: Column) -> Column:
        code = F.transform(x["chars"], lambda c: F.array_position(x["alphabet"], c).cast("int"))
        return F.struct(code.alias("code"), F.size(x["alphabet"]).alias("letters"), x["threshold"].alias("threshold"))

    once = F.array(F.struct(chars.alias("chars"), F.array_distinct(chars).alias("alphabet"),
                            threshold.alias("threshold")))
    return F.element_at(F.transform(F.transform(once, bound), lambda x: _slide(x, window, plogp)), 1)


def _slide(run: Column, window: int, plogp: Column) -> Column:
    """The hot range of a run given as numbers (code) of an alphabet of so many letters, and its threshold."""
    code, threshold = run["code"], run["threshold"]
    state = F.struct(F.array_repeat(F.lit(0), run["letters"]).alias("count"),
                     F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("start"),
                     F.lit(None).cast("int").alias("stop"))

    def slide(acc: Column, i: Column) -> Column:
        enter = F.element_at(code, i)
        leave = F.when(i > window, F.element_at(code, F.greatest(i - window, F.lit(1)))).otherwise(0)
        had = F.element_at(acc["count"], enter)
        lost = F.when(leave > 0, F.element_at(acc["count"], F.greatest(leave, F.lit(1)))).otherwise(0)
        # equal characters entering and leaving change nothing
        same = leave == enter
        new = acc["sum"] + F.when(same, 0.0).otherwise(
            F.element_at(plogp, had + 2) - F.element_at(plogp, had + 1)
            + F.when(leave > 0, F.element_at(plogp, F.greatest(lost, F.lit(1))) - F.element_at(plogp, lost + 1))
            .otherwise(0.0))
        counts = F.when(same, acc["count"]).otherwise(F.transform(
            acc["count"], lambda c, k: c + F.when(k + 1 == enter, 1).when(k + 1 == leave, -1).otherwise(0)))
        hot = (i >= window) & (F.lit(math.log2(window)) - new / window >= threshold)
        return F.struct(counts.alias("count"), new.alias("sum"),
                        F.when(acc["start"].isNotNull() | ~hot, acc["start"]).otherwise(i - window).alias("start"),
                        F.when(hot, i).otherwise(acc["stop"]).alias("stop"))

    return F.aggregate(F.sequence(F.lit(1), F.size(code)), state, slide,
                       lambda acc: F.struct(acc["start"].alias("start"), acc["stop"].alias("stop")))


def _mixed(run: Column) -> Column:
    return run.rlike("[0-9].*[0-9]") & run.rlike("[A-Za-z].*[A-Za-z]")


def _threshold(run: Column, thresholds: dict) -> Column:
    return (F.when(run.rlike("^([0-9a-f]+|[0-9A-F]+)$"), thresholds["hex"])
            .when(run.rlike("^[A-Za-z0-9]+$"), thresholds["alphanumeric"])
            .otherwise(thresholds["base64"]))


def _hot_parts(run: Column, window: int, thresholds: dict, allowed) -> Column:
    """Spans in ``run`` of its alphanumeric parts with a hot window of the part's own class.

    A leading 0x belongs to the part and not to its class.  A pattern of the
    allow-list that begins with ^ excuses a whole run or a whole part, any
    other one the part it is found in."""
    pattern = f"[A-Za-z0-9]{{{window},}}"
    found = F.regexp_extract_all(run, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(_positions(run, found, pattern).alias("at"), found.alias("part"))

    def hot(x: Column) -> Column:
        body = F.regexp_replace(x["part"], "^0[xX]", "")
        ok = (F.length(body) >= window) & _mixed(body)
        for p in allowed:
            ok = ok & ~x["part"].rlike(p)
        return F.when(ok, hot_range(body, window, _threshold(body, thresholds))["stop"].isNotNull()).otherwise(False)

    whole = F.lit(True)
    for p in allowed:
        if p.startswith("^"):
            whole = whole & ~run.rlike(p)
    spans = F.transform(F.filter(pairs, hot), lambda x: x["at"])
    return F.when(whole & (F.size(found) > 0), spans).otherwise(F.array().cast(_SPANS))


def _to_part_ends(run: Column, hot: Column) -> Column:
    """``hot`` widened to the ends of the alphanumeric parts it begins and stops in."""
    cut = F.translate(run, "+/_=", "----")
    before = F.substring_index(F.substring(cut, F.lit(1), hot["start"]), "-", -1)
    after = F.substring_index(F.substring(cut, hot["stop"] + 1, F.length(run)), "-", 1)
    return F.struct((hot["start"] - F.length(before)).alias("start"), (hot["stop"] + F.length(after)).alias("stop"))


def _entropy_spans(text: Column, window: int, thresholds: dict, allowed, parts: bool) -> Column:
    found = F.regexp_extract_all(text, F.lit(CANDIDATE.replace("20", str(window))), F.lit(0))
    pairs = F.arrays_zip(_positions(text, found, CANDIDATE.replace("20", str(window))).alias("at"),
                         found.alias("run"))

    def wanted(x: Column) -> Column:
        run = x["run"]
        ok = _mixed(run)
        for pattern in allowed:
            ok = ok & ~run.rlike(pattern)
        return ok

    def moved(s: Column, by: Column) -> Column:
        return F.struct((by + s["start"]).alias("start"), (by + s["stop"]).alias("stop"))

    def span(x: Column) -> Column:
        run = x["run"]
        return moved(hot_range(run, window, _threshold(run, thresholds)), x["at"]["start"])

    def spans_of(x: Column) -> Column:
        """The run's own hot span and the hot parts outside it."""
        run = x["run"]
        own = F.when(wanted(x), hot_range(run, window, _threshold(run, thresholds)))
        both = F.array(F.struct(own.alias("own"), _hot_parts(run, window, thresholds, allowed).alias("parts")))

        def union(y: Column) -> Column:
            wide = F.filter(F.array(_to_part_ends(run, y["own"])), lambda s: s["start"].isNotNull())
            rest = F.filter(y["parts"], lambda s: ~F.exists(wide, lambda w: (w["start"] <= s["start"])
                                                            & (s["stop"] <= w["stop"])))
            return F.transform(F.concat(wide, rest), lambda s: moved(s, x["at"]["start"]))

        return F.flatten(F.transform(both, union))

    if parts:
        spans = F.flatten(F.transform(F.filter(pairs, lambda x: _mixed(x["run"])), spans_of))
    else:
        spans = F.filter(F.transform(F.filter(pairs, wanted), span), lambda s: s["start"].isNotNull())
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(_SPANS))


def with_spans(docs: DataFrame, text: str = "text", window: int = WINDOW, thresholds: dict | None = None,
               allowed=ALLOWED, prefix: str = "__", parts: bool = False) -> DataFrame:
    """``docs`` with a column of spans for each kind, named prefix + kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({f"{prefix}m": F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(0)),
                            f"{prefix}v": F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)),
                            f"{prefix}a": F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)),
                            f"{prefix}h": F.regexp_extract_all(t, F.lit(HEX), F.lit(0))})
    m, v = F.col(f"{prefix}m"), F.col(f"{prefix}v")
    assigned = F.arrays_zip(_positions(t, m, ASSIGN).alias("at"), v.alias("value"))
    assigned = F.transform(F.filter(assigned, lambda x: F.length(x["value"]) >= ASSIGN_VALUE), lambda x: x["at"])
    out = out.withColumns({
        f"{prefix}assign": F.when(F.size(m) > 0, assigned).otherwise(F.array().cast(_SPANS)),
        f"{prefix}access": _positions(t, F.col(f"{prefix}a"), ACCESS),
        f"{prefix}hex": _positions(t, F.col(f"{prefix}h"), HEX),
        f"{prefix}e": _entropy_spans(t, window, thresholds or THRESHOLDS, allowed, parts)})
    base = F.concat(*[F.col(f"{prefix}{k}") for k in BASE_KINDS])
    free = F.filter(F.col(f"{prefix}e"), lambda s: ~F.exists(
        base, lambda b: (b["start"] <= s["start"]) & (s["stop"] <= b["stop"])))
    out = out.withColumn(f"{prefix}{ENTROPY_KIND}", F.when(F.size(f"{prefix}e") > 0, free)
                         .otherwise(F.array().cast(_SPANS)))
    return out.drop(*[f"{prefix}{x}" for x in "mvahe"])


def _in_order(kinds, prefix: str) -> Column:
    """All spans of the kinds as (start, kind number, stop), sorted."""
    def of(k: int, kind: str) -> Column:
        return F.transform(F.col(f"{prefix}{kind}"), lambda s: F.struct(
            s["start"].alias("start"), F.lit(k).alias("kind"), s["stop"].alias("stop")))
    return F.array_sort(F.concat(*[of(k, kind) for k, kind in enumerate(kinds)]))


def _as_text(kinds, prefix: str) -> Column:
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(_in_order(kinds, prefix), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
         thresholds: dict | None = None, allowed=ALLOWED, parts: bool = False) -> DataFrame:
    """(doc_id, assign, access, hex, entropy: arrays of spans, base, spans: their listing as text)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = with_spans(rows, "text", window, thresholds, allowed, parts=parts)
    kinds = (*BASE_KINDS, ENTROPY_KIND)
    return found.select("doc_id", *[F.col(f"__{k}").alias(k) for k in kinds],
                        _as_text(BASE_KINDS, "__").alias("base"), _as_text(kinds, "__").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", text: str = "text", n_chars: str = "n_chars",
           window: int = WINDOW, thresholds: dict | None = None, allowed=ALLOWED, parts: bool = False) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark`` (spans that overlap by one) and
    ``n_chars``, where there is such a column, counted anew for the changed rows."""
    rows = docs.select(packed(docs).alias("row"), F.col(text).alias("text"))
    found = with_spans(rows, "text", window, thresholds, allowed, parts=parts)
    found = found.withColumn("__all", _in_order((*BASE_KINDS, ENTROPY_KIND), "__"))
    t, spans = F.col("text"), F.col("__all")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["at"], F.concat(
            F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    clean = F.aggregate(spans, state, step, lambda acc: F.concat(
        acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))
    found = found.withColumn("__text", F.when(F.size(spans) > 0, clean).otherwise(t))
    values = {text: F.col("__text")}
    if n_chars in docs.columns:
        old = F.col(f"row.`{n_chars}`")
        values[n_chars] = F.when(F.size(spans) > 0, F.length("__text").cast(
            docs.schema[n_chars].dataType)).otherwise(old)
    return found.select(*[values.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
