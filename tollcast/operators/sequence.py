"""Order-dependent scans that stay balanced under any key skew.

The traffic job's repairs, gap fill and lags are positional: "previous row",
"next row", "last good value before this one".  ``Window.partitionBy(key)``
would put every row of a hot key (say a third of the table) into one task.
``ordered_scan`` instead cuts each key's order into buckets, by a function of
the order columns that rises with them (a day of a timestamp, a range of an
integer), and works in two levels:

1. Windows over (key, bucket): everything that lies in the same bucket.
2. One summary row per (key, bucket): the last and first rows needed for lags
   and leads, the last and first non-NULL values, row counts.  Running values
   over a key's summaries are its carries, which one join brings back.

A task holds buckets, never a whole key.  Where one bucket may be hot itself,
``levels`` cut it further (seconds of an hour, ranges of a tie-breaker among
rows of one instant), and the carries are combined upwards level by level and
handed down again.  Buckets are computed from the rows
alone, so the plan is lazy: no job, no sampling and no cached frame, and any
recomputation gives the same rows.  Keys and buckets are compared as structs,
in which NULL equals NULL.  The order must be unique (add a tie-breaker such
as an id column), otherwise positions among ties are not reproducible.

Where keys are many and most are small, a bucket holds a row or two and there
are about as many summaries as rows.  ``whole_keys`` scans every key of at most
so many rows by windows over the key alone, and cuts only the larger ones.

``add_sequence`` numbers all rows by a range partitioning that is written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions

_PART_BITS = 33
_ROW_MASK = (1 << _PART_BITS) - 1

#: Hours of a timestamp order, and integers of an integer order, in a bucket.
BUCKET_HOURS = 24
BUCKET_WIDTH = 1 << 16

_TIMES = ("timestamp_ntz", "timestamp")
_INTEGERS = ("byte", "short", "integer", "long")


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def add_sequence(df: DataFrame, order, num_partitions: int | None = None,
                 seq_col: str = "_seq", weight: str | None = None) -> DataFrame:
    """Dense 0-based global position under ``order`` (a unique ordering).

    With ``weight``, a row counts for that many: its position is the sum of
    the weights before it.

    One range shuffle, written to ``spark.checkpoint.dir`` and read twice: for
    the partitions' sizes and for the rows.  Range bounds are sampled per
    shuffle, so both reads must be of one.  The offset table has one row per
    partition.
    """
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    oc = _cols(order)
    path = scratch_path(spark, "sequence")
    (df.repartitionByRange(n, *oc).sortWithinPartitions(*oc)
     .withColumn("_mid", F.monotonically_increasing_id()).write.parquet(path))
    t = spark.read.schema(df.withColumn("_mid", F.lit(0).cast("long")).schema).parquet(path)
    t = t.withColumns({"_pid": F.shiftright(F.col("_mid"), _PART_BITS),
                       "_rn": F.col("_mid").bitwiseAND(F.lit(_ROW_MASK))})
    size = F.sum(weight) if weight else F.count(F.lit(1))
    sizes = t.groupBy("_pid").agg(size.alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0))
                           .cast("long").alias("_off"))
    if weight:
        inner = Window.partitionBy("_pid").orderBy("_rn").rowsBetween(Window.unboundedPreceding, -1)
        t = t.withColumn("_rn", F.coalesce(F.sum(weight).over(inner), F.lit(0)))
    # offsets has at most `n` rows: a proven bound, so the broadcast is safe.
    out = t.join(F.broadcast(offsets), "_pid")
    return out.withColumn(seq_col, (F.col("_off") + F.col("_rn")).cast("long")).drop(
        "_mid", "_pid", "_rn", "_off")


def bucket_columns(df: DataFrame, order, hours: int = BUCKET_HOURS,
                   width: int = BUCKET_WIDTH) -> list[Column]:
    """Columns that rise with ``order`` and hold few distinct values.

    Columns before the first time column are taken as they are, the time by
    day or part of a day; without one, the first column must be an integer.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    out: list[Column] = []
    for c in order:
        if types[c] in _TIMES:
            part = [] if hours >= 24 else [F.floor(F.hour(c) / F.lit(hours)).cast("int")]
            return [*out, F.to_date(c), *part]
        if types[c] == "date":
            return [*out, F.col(c)]
        out.append(F.col(c))
    if types[order[0]] in _INTEGERS:
        return [F.floor(F.col(order[0]) / F.lit(width)).cast("long")]
    raise ValueError("name bucket columns for an order without a time or an integer first")


def time_levels(ts: str, tie: str | None = None, width: int = BUCKET_WIDTH) -> list[list[Column]]:
    """Levels of an order by time: hours, seconds and, where rows share an instant, ranges of
    ``width`` of the integer ``tie`` that comes next in the order."""
    out = [[F.to_date(ts), F.hour(ts)], [F.minute(ts), F.floor(F.second(ts)).cast("int")]]
    if tie:
        out.append([F.col(ts), F.floor(F.col(tie) / F.lit(width)).cast("long")])
    return out


def _is_prefix(name: str) -> bool:
    """Whether a summary column tells of what came before a row (else of what comes after)."""
    return not name.startswith(("_head", "_firstv"))


def _added(names, near, far, k_lag: int, k_lead: int) -> dict[str, Column]:
    """Summaries of two neighbouring stretches as one, the nearer to a row and the farther;
    ``near`` and ``far`` give a summary column by name."""
    out = {}
    for c in names:
        if c == "_tail":
            both = F.concat(far(c), near(c))
            out[c] = F.slice(both, F.greatest(F.size(both) - k_lag + 1, F.lit(1)), k_lag)
        elif c == "_head":
            out[c] = F.slice(F.concat(near(c), far(c)), 1, k_lead)
        elif c.startswith("_cnt"):
            out[c] = far(c) + near(c)
        elif c.startswith("_markat"):
            out[c] = F.coalesce(far(c.replace("_markat", "_cnt")) + near(c), far(c))
        else:
            out[c] = F.coalesce(near(c), far(c))
    return out


def _carries(summary: DataFrame, levels: list[str], names: list[str], k_lag: int, k_lead: int) -> DataFrame:
    """For each summary row, what all rows of its key before it (or after it) sum up to.

    Running values among the rows of one bucket of the level above, then that
    bucket's own summary from its last (first) row, whose carries come from one
    level further up and are handed down by a join.  A task holds the summaries
    of one bucket of the level above; at the top, those of a key.
    """
    *upper, last = levels
    w = Window.partitionBy("_key", *upper).orderBy(last)
    wd = Window.partitionBy("_key", *upper).orderBy(F.col(last).desc())
    earlier, later = (x.rowsBetween(Window.unboundedPreceding, -1) for x in (w, wd))
    summary = summary.withColumns({f"_sofar{c[4:]}": F.coalesce(F.sum(c).over(earlier), F.lit(0))
                                   for c in names if c.startswith("_cnt")})
    inner = {}
    for c in names:
        if c == "_tail":
            inner[c] = F.flatten(F.collect_list(c).over(w.rowsBetween(-k_lag, -1)))
        elif c == "_head":
            inner[c] = F.flatten(F.collect_list(c).over(w.rowsBetween(1, k_lead)))
        elif c.startswith("_cnt"):
            inner[c] = F.col(f"_sofar{c[4:]}")
        elif c.startswith("_markat"):
            inner[c] = F.last(F.col(f"_sofar{c[7:]}") + F.col(c), ignorenulls=True).over(earlier)
        else:
            inner[c] = F.last(c, ignorenulls=True).over(earlier if _is_prefix(c) else later)
    if not upper:
        return summary.select("_key", last, *[x.alias(c) for c, x in inner.items()])
    within = summary.withColumns({f"_in{c}": x for c, x in inner.items()})
    upto = _added(names, F.col, lambda c: F.col(f"_in{c}"), k_lag, k_lead)
    whole = within.groupBy("_key", *upper).agg(*[
        (F.max_by if _is_prefix(c) else F.min_by)(x, F.col(last)).alias(c) for c, x in upto.items()])
    outer = _carries(whole, upper, names, k_lag, k_lead)
    outer = outer.select("_key", *upper, *[F.col(c).alias(f"_out{c}") for c in names])
    down = _added(names, lambda c: F.col(f"_in{c}"), lambda c: F.col(f"_out{c}"), k_lag, k_lead)
    return within.join(outer, ["_key", *upper]).select("_key", *levels, *[x.alias(c) for c, x in down.items()])


def ordered_scan(df: DataFrame, keys, order, *, lags: dict | None = None,
                 leads: dict | None = None, ffill: dict | None = None,
                 bfill: dict | None = None, since: dict | None = None,
                 buckets: list | None = None, bucket_hours: int = BUCKET_HOURS,
                 bucket_width: int = BUCKET_WIDTH, levels: list | None = None,
                 whole_keys: int = 0) -> DataFrame:
    """Positional look-ups within each key, in ``order``.

    ``lags``/``leads``: ``{out: (column, k)}`` value ``k`` rows back/ahead in
    the same key (NULL past the key's ends).
    ``ffill``: ``{out: (column, include_current)}`` last non-NULL value of the
    column at or before (``True``) / strictly before (``False``) the row.
    ``bfill``: same, first non-NULL at or after / strictly after.
    ``since``: ``{out: (mark, counted)}`` how many rows with a non-NULL
    ``counted`` came after the last row where the boolean ``mark`` holds, up
    to and with this row (NULL before the first such row).
    ``keys`` may be empty: the scan then runs over the whole table's order, and
    its summaries (a row for each bucket) are the one thing that meets in a task.
    ``buckets``: columns that rise with ``order``; default ``bucket_columns``.
    ``levels``: such columns from coarse to fine, each a list that rises with
    ``order`` among rows equal in the lists before it (``time_levels``); rows
    meet by the finest, and summaries of a level by the one above it.  An empty
    list leaves every key whole.
    ``whole_keys``: keys of at most so many rows are not cut; counting them
    reads the keys of ``df`` once more (0: every key is cut).
    """
    lags, leads, ffill, bfill, since = (x or {} for x in (lags, leads, ffill, bfill, since))
    if whole_keys and keys:
        scan = {"lags": lags, "leads": leads, "ffill": ffill, "bfill": bfill, "since": since}
        keyed = df.withColumn("_whole", F.struct(*_cols(keys)))
        large = keyed.groupBy("_whole").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > whole_keys)
        # fewer than rows / whole_keys keys: a proven bound, so the broadcast is safe.
        large = F.broadcast(large.select("_whole"))
        small, rest = (keyed.join(large, "_whole", how).drop("_whole") for how in ("left_anti", "left_semi"))
        return ordered_scan(small, keys, order, levels=[], **scan).unionByName(
            ordered_scan(rest, keys, order, buckets=buckets, bucket_hours=bucket_hours,
                         bucket_width=bucket_width, levels=levels, **scan))
    orig = [F.col(f"`{c}`") for c in df.columns]
    made = {f"_o{i}": c for i, c in enumerate(order) if isinstance(c, Column)}
    df = df.withColumns(made) if made else df
    order = [f"_o{i}" if isinstance(c, Column) else c for i, c in enumerate(order)]
    if levels is None:
        levels = [buckets or bucket_columns(df, order, bucket_hours, bucket_width)]
    cut = [f"_b{i}" for i in range(len(levels))]
    at = ["_key", *cut]
    s = df.withColumns({
        "_key": F.struct(*_cols(keys)) if keys else F.struct(F.lit(0).alias("all")),
        **{b: F.struct(*[c.alias(f"c{i}") for i, c in enumerate(parts)]) for b, parts in zip(cut, levels)}})

    w = Window.partitionBy(*at).orderBy(*order)
    wd = Window.partitionBy(*at).orderBy(*[F.col(c).desc() for c in order])
    whole = Window.partitionBy(*at)
    upto, before = (w.rowsBetween(Window.unboundedPreceding, e) for e in (0, -1))
    onward, after = (wd.rowsBetween(Window.unboundedPreceding, e) for e in (0, -1))

    k_lag = max([k for _, k in lags.values()] + [0])
    k_lead = max([k for _, k in leads.values()] + [0])
    cols = {"_rn": F.row_number().over(w)}
    if k_lag or k_lead:
        cols["_n"] = F.count(F.lit(1)).over(whole)
    for i, (src, k) in enumerate(lags.values()):
        cols[f"_g{i}"] = F.lag(src, k).over(w)
    for i, (src, k) in enumerate(leads.values()):
        cols[f"_d{i}"] = F.lead(src, k).over(w)
    for i, (src, incl) in enumerate(ffill.values()):
        cols[f"_f{i}"] = F.last(src, ignorenulls=True).over(upto if incl else before)
    for i, (src, incl) in enumerate(bfill.values()):
        cols[f"_h{i}"] = F.last(src, ignorenulls=True).over(onward if incl else after)
    for i, (_, counted) in enumerate(since.values()):
        cols[f"_c{i}"] = F.count(counted).over(upto)
    s = s.withColumns(cols)
    if since:
        s = s.withColumns({f"_m{i}": F.max(F.when(F.col(mark), F.col(f"_c{i}"))).over(upto)
                           for i, (mark, _) in enumerate(since.values())})

    if not cut:  # a key is one bucket: nothing is carried
        found = [*zip(lags, (F.col(f"_g{i}") for i in range(len(lags)))),
                 *zip(leads, (F.col(f"_d{i}") for i in range(len(leads)))),
                 *zip(ffill, (F.col(f"_f{i}") for i in range(len(ffill)))),
                 *zip(bfill, (F.col(f"_h{i}") for i in range(len(bfill)))),
                 *zip(since, (F.col(f"_c{i}") - F.col(f"_m{i}") for i in range(len(since))))]
        return s.select(*orig, *[x.alias(out) for out, x in found])

    # one summary row per (key, bucket); _carries says how they add up
    lag_src, lead_src = (list(dict.fromkeys(c for c, _ in x.values())) for x in (lags, leads))
    f_src, b_src = (list(dict.fromkeys(c for c, _ in x.values())) for x in (ffill, bfill))
    rn, n = F.col("_rn"), F.col("_n")
    aggs = []
    if lags:  # at most k_lag rows
        tail = F.when(rn > n - k_lag, F.struct(rn.alias("r"), *_cols(lag_src)))
        aggs.append(F.array_sort(F.collect_list(tail)).alias("_tail"))
    if leads:
        head = F.when(rn <= k_lead, F.struct(rn.alias("r"), *_cols(lead_src)))
        aggs.append(F.array_sort(F.collect_list(head)).alias("_head"))
    # wrapped, so that a value found and no value differ
    aggs += [F.max_by(F.struct(F.col(c).alias("v")), F.when(F.col(c).isNotNull(), rn)).alias(f"_lastv{i}")
             for i, c in enumerate(f_src)]
    aggs += [F.min_by(F.struct(F.col(c).alias("v")), F.when(F.col(c).isNotNull(), rn)).alias(f"_firstv{i}")
             for i, c in enumerate(b_src)]
    for i, (_, counted) in enumerate(since.values()):
        aggs += [F.count(counted).alias(f"_cnt{i}"), F.max(f"_m{i}").alias(f"_markat{i}")]
    summary = s.groupBy(*at).agg(*aggs)

    names = [c for c in summary.columns if c not in at]
    s = s.join(_carries(summary, cut, names, k_lag, k_lead), at, "left")

    outs = []
    for i, (out, (src, k)) in enumerate(lags.items()):
        back = F.lit(k) - rn  # rows to go back beyond this bucket, less one
        old = F.when(F.size("_tail") > back, F.element_at(F.col("_tail"), F.least(-back - 1, F.lit(-1)))[src])
        outs.append(F.when(rn > k, F.col(f"_g{i}")).otherwise(old).alias(out))
    for i, (out, (src, k)) in enumerate(leads.items()):
        ahead = F.lit(k) - (n - rn)  # which of the later buckets' rows
        new = F.when(F.size("_head") >= ahead, F.element_at(F.col("_head"), F.greatest(ahead, F.lit(1)).cast("int"))[src])
        outs.append(F.when(n - rn >= k, F.col(f"_d{i}")).otherwise(new).alias(out))
    for i, (out, (src, _)) in enumerate(ffill.items()):
        outs.append(F.coalesce(F.col(f"_f{i}"), F.col(f"_lastv{f_src.index(src)}")["v"]).alias(out))
    for i, (out, (src, _)) in enumerate(bfill.items()):
        outs.append(F.coalesce(F.col(f"_h{i}"), F.col(f"_firstv{b_src.index(src)}")["v"]).alias(out))
    for i, out in enumerate(since):
        outs.append(F.coalesce(F.col(f"_c{i}") - F.col(f"_m{i}"), F.col(f"_cnt{i}") - F.col(f"_markat{i}") + F.col(f"_c{i}")).alias(out))
    return s.select(*orig, *outs)
