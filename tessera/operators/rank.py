"""Exact ordering without a single-partition window.

Three tools, all exact and independent of the data layout:

* ``rank_thresholds`` -- the row found at given positions of a seeded hash
  order.  Splits and folds only need a few cut points, not a rank for every
  row: count rows per hash bucket (map-side partial aggregation), locate the
  buckets holding the cut positions on that small table, and rank only the
  rows of those buckets.  The split itself is then a pure filter expression:
  no row is shuffled.
* ``exact_rank`` -- a 1-based rank for every row: a range-partitioned global
  sort on (order, unique tie-break), per-partition counts, and offsets
  broadcast back.  Hot values are split across partitions by the tie-break.
* ``exact_quantiles`` -- linear-interpolated quantiles by distributed
  selection: narrow [lo, hi] with equal-width bucket histograms until the
  wanted position lies in a bucket of one value or of few rows.
* ``grouped_quantiles`` -- the same for any number of groups, as a DataFrame:
  one scan counts the distinct values of every group, one range sort on
  (column, group, value) orders them, and prefix counts find the positions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expr import dlit
from tessera.operators.blocks import array_of, matrix
from tessera.session import materialize

# Rows of a hash bucket small enough to rank directly (one task).
TARGET_BUCKET_ROWS = 100_000
# Histogram width of one selection round, and the size at which a bucket is
# ranked directly.
SELECT_LEAF_ROWS = 50_000
# Each round shrinks the range at least SELECT_BUCKETS-fold, so ~256 rounds
# separate any two doubles; the cap is a guard, not a working limit.
BRACKET_ACCURACY = 10_000
# Distinct values that a task holds before it hands them on, and that the driver
# takes in all.
KEPT_VALUES = 20_000
MAX_SELECTED = 200_000


def hash_key(seed: int | str, key_cols: Sequence[str]) -> Column:
    """md5 of ``'seed|k1|k2…'``: a seeded, layout-independent row order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key_cols]))


def lex_le(cols: Sequence[Column], values: Sequence, types: Sequence | None = None) -> Column:
    """(c1, c2, …) <= (v1, v2, …) in lexicographic order.

    With ``types`` (the Spark types of the columns) this is one struct
    comparison, so an expensive first column (the md5) is evaluated once.
    """
    if types is not None:
        left = F.struct(*[c.alias(f"f{i}") for i, c in enumerate(cols)])
        right = F.struct(*[F.lit(v).cast(t).alias(f"f{i}") for i, (v, t) in enumerate(zip(values, types))])
        return left <= right
    expr = None
    for i in reversed(range(len(cols))):
        c, v = cols[i], F.lit(values[i])
        if expr is None:
            expr = c <= v
        else:
            expr = (c < v) | ((c == v) & expr)
    return expr


def rank_thresholds(
    df: DataFrame,
    h: Column,
    key_cols: Sequence[str],
    positions: Sequence[int],
    n: int,
) -> list[tuple]:
    """Order values ``(h, *keys)`` of the rows at 1-based ``positions``.

    Row ``x`` has rank <= p  iff  ``lex_le((h, *keys), threshold_p)``.

    Refinement over hex prefixes of the (uniform) md5: each level counts rows
    per next 3 hex digits (4096 groups, so map-side partial aggregation keeps
    each task's output small) inside the prefixes that hold a cut position;
    once such a bucket has at most ``TARGET_BUCKET_ROWS`` rows, its rows are
    ranked directly.  Typically 1 level up to ~4e8 rows, 2 up to ~1.6e12.
    """
    positions = sorted(set(int(p) for p in positions if 1 <= p <= n))
    if not positions:
        return []
    spark = df.sparkSession
    tagged = df.select(h.alias("_h"), *key_cols)
    # position -> (prefix, rows before the prefix)
    pending = {p: ("", 0) for p in positions}
    leaves: dict[int, tuple[str, int]] = {}
    dup_prefix: dict[int, str] = {}
    depth = 0
    while pending:
        if n <= TARGET_BUCKET_ROWS and depth == 0:
            leaves = {p: ("", p) for p in pending}
            break
        prefixes = sorted({pre for pre, _ in pending.values()})
        width = len(prefixes[0])
        scope = tagged if width == 0 else tagged.filter(F.substring("_h", 1, width).isin(prefixes))
        rows = (
            scope.groupBy(F.substring("_h", 1, width).alias("_pre"), F.substring("_h", width + 1, 3).alias("_c"))
            .agg(F.count(F.lit(1)).alias("_n"))
            .collect()
        )
        children: dict[str, list] = {}
        for r in rows:
            children.setdefault(r["_pre"] if width else "", []).append((r["_c"], r["_n"]))
        nxt = {}
        for p, (pre, base) in pending.items():
            before = base
            for c, cnt in sorted(children[pre]):
                if p <= before + cnt:
                    if cnt <= TARGET_BUCKET_ROWS:
                        leaves[p] = (pre + c, p - before)
                    elif width + 3 >= 32:
                        # the whole md5 is fixed: only duplicate keys remain, which
                        # are equal in the order -- no task has to rank them
                        dup_prefix[p] = pre + c
                    else:
                        nxt[p] = (pre + c, before)
                    break
                before += cnt
        pending = nxt
        depth += 1
    picked = []
    for p, pre in dup_prefix.items():
        first = tagged.filter(F.col("_h") == pre).agg(F.min(F.struct("_h", *key_cols)).alias("_m")).first()["_m"]
        picked.append({"_p": p, "_h": first["_h"], **{k: first[k] for k in key_cols}})
    for width in sorted({len(pre) for pre, _ in leaves.values()}):
        items = [(pre, int(local), int(p)) for p, (pre, local) in leaves.items() if len(pre) == width]
        # at most one leaf per cut position: literal predicates, no broadcast jobs
        scope = tagged.withColumn("_pre", F.substring("_h", 1, width) if width else F.lit(""))
        if width:
            scope = scope.filter(F.col("_pre").isin(sorted({pre for pre, _, _ in items})))
        w = Window.partitionBy("_pre").orderBy("_h", *key_cols)
        ranked = scope.withColumn("_rn", F.row_number().over(w))
        hit, pos = None, F.lit(None).cast("long")
        for pre, local, p in items:
            cond = (F.col("_pre") == pre) & (F.col("_rn") == local)
            hit = cond if hit is None else hit | cond
            pos = F.when(cond, F.lit(p)).otherwise(pos)
        picked += ranked.filter(hit).select(pos.alias("_p"), "_h", *key_cols).collect()
    by_pos = {r["_p"]: tuple([r["_h"], *[r[k] for k in key_cols]]) for r in picked}
    return [by_pos[p] for p in positions]


def exact_rank(
    df: DataFrame,
    order_cols: Sequence[Column | str],
    tiebreak_cols: Sequence[Column | str],
    rank_col: str = "rank",
) -> DataFrame:
    """Add a 1-based global rank by (order, tie-break) without a single-partition window.

    The sort is range-partitioned on the full key, so a value held by many
    rows is spread over partitions by the tie-break.  The sorted rows are
    checkpointed once so partition ids and positions are fixed, then
    per-partition counts (one small row per partition) give the offsets.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in (*order_cols, *tiebreak_cols)]
    ordered = df.orderBy(*keys).select(
        "*",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    ordered = materialize(ordered)
    offsets = (
        ordered.groupBy("_pid")
        .agg(F.count(F.lit(1)).alias("_cnt"))
        .withColumn(
            "_off",
            F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("_pid", F.coalesce(F.col("_off"), F.lit(0)).alias("_off"))
    )
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (
        ordered.join(F.broadcast(offsets), "_pid")
        .withColumn(rank_col, F.col("_off") + local + 1)
        .drop("_pid", "_mid", "_off")
    )


def exact_quantiles(
    df: DataFrame,
    value_cols: Sequence[str],
    qs: Sequence[float],
    group_col: str | None = None,
    stats: dict | None = None,
) -> dict[tuple, float | None]:
    """Exact linear-interpolation quantiles (pandas/R7 rule), NULLs skipped.

    Returns ``{(group, column, q): value}``; ``group`` is None without groups.
    Approximate percentiles bracket each position in one scan, a second counts
    exactly where it lies and reads the values inside the bracket; a bracket
    that holds too many (from about 10^8 rows on) is narrowed, one more scan for
    each factor of 50.  Columns x quantiles are the work items that the driver
    holds.  With ``group_col`` the result of :func:`grouped_quantiles` is
    collected (groups as text); for many groups use that function itself.
    ``stats`` may pass the result of :func:`column_stats` to skip its scan.
    """
    if group_col:
        rows = grouped_quantiles(df, value_cols, qs, group_col).collect()
        return {(None if r["group"] is None else str(r["group"]), r["feature"], r["q"]): r["value"] for r in rows}
    cols = list(value_cols)
    if stats is None:
        stats = column_stats(df, cols, qs)
    counts = {c: stats[c]["n"] for c in cols if stats[c]["n"]}
    # target: (column, position) -> values that part the column around it
    points = {}
    for c, n in counts.items():
        known = stats[c]
        for q in qs:
            for pos in {math.floor((n - 1) * q), math.ceil((n - 1) * q)}:
                points.setdefault((c, pos), set()).update(known["bracket"].get(q, (known["min"], known["max"])))
    found = {t: min(ends) for t, ends in points.items() if stats[t[0]]["min"] == stats[t[0]]["max"]}
    _select_in_one_scan(df, points, counts, found)
    if len(found) < len(points):
        stack = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in counts]))
        long = df.select(stack.alias("_s")).select(F.lit(None).cast("string").alias("_g"), F.col("_s.c").alias("_c"), F.col("_s.v").alias("_v"))
        _select_in_rounds(long.filter(F.col("_v").isNotNull() & ~F.isnan("_v")), {(None, *t): e for t, e in points.items() if t not in found}, found)
    result = {}
    for c, n in counts.items():
        for q in qs:
            h = (n - 1) * q
            lo_v, hi_v = found[c, math.floor(h)], found[c, math.ceil(h)]
            result[None, c, q] = lo_v + (h - math.floor(h)) * (hi_v - lo_v)
    return result


def column_stats(df: DataFrame, cols: Sequence[str], qs: Sequence[float] = ()) -> dict[str, dict]:
    """Per column n, mean, std, min, max, and for each quantile a bracket of two
    values around its position (approximate percentiles), in one scan."""
    edges = sorted({e for q in qs for e in (q, *_edges(q))})
    aggs = []
    for i, c in enumerate(cols):
        v = F.nanvl(F.col(c).cast("double"), F.lit(None))
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
                 F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
        if edges:
            aggs.append(F.percentile_approx(v, edges, BRACKET_ACCURACY).alias(f"p{i}"))
    row = df.agg(*aggs).first() if aggs else {}
    out = {}
    for i, c in enumerate(cols):
        out[c] = {k: row[f"{k}{i}"] for k in ("n", "mean", "std", "min", "max")}
        at = dict(zip(edges, row[f"p{i}"] or [])) if edges else {}
        out[c]["approx"] = {q: at.get(q) for q in qs}
        out[c]["bracket"] = {q: tuple(at[e] for e in _edges(q)) for q in qs} if at else {}
    return out


def _edges(q: float) -> tuple[float, float]:
    reach = 2 / BRACKET_ACCURACY
    return max(0.0, q - reach), min(1.0, q + reach)


def _select_in_one_scan(df: DataFrame, points: dict, counts: dict, found: dict) -> None:
    """Resolve positions whose bracket holds few rows: one scan counts the rows
    at and between the points of each column, and hands on the distinct values
    strictly inside a bracket (of a small column: all its values)."""
    cols = sorted({t[0] for t in points if t not in found})
    if not cols:
        return
    width = len(cols)
    ends = [np.array(sorted(set().union(*[e for t, e in points.items() if t[0] == c])), float) for c in cols]
    wanted = []  # per column the stretches whose values are handed on
    for c, at in zip(cols, ends):
        inside = np.zeros(2 * len(at) + 1, bool)
        for t, e in points.items():
            if t[0] == c:
                low, high = np.searchsorted(at, [min(e), max(e)])
                inside[2 * low + 1 : 2 * high + 2] = True
        wanted.append(inside | (counts[c] * width <= MAX_SELECTED))

    def run(batches):
        seen = [{} for _ in cols]  # per column: stretch -> [rows, least, largest]
        kept = [{} for _ in cols]
        for b in batches:
            x = matrix(b["_x"], width)
            for i, at in enumerate(ends):
                v = x[:, i][~np.isnan(x[:, i])]
                left, right = np.searchsorted(at, v, "left"), np.searchsorted(at, v, "right")
                stretch = left + right  # odd: equal to a point
                for k in np.unique(stretch):
                    part = v[stretch == k]
                    n, low, high = seen[i].get(int(k), (0, np.inf, -np.inf))
                    seen[i][int(k)] = (n + len(part), min(low, part.min()), max(high, part.max()))
                    if wanted[i][k] and k % 2 == 0:
                        for value, times in zip(*np.unique(part, return_counts=True)):
                            key = (int(k), float(value))
                            kept[i][key] = kept[i].get(key, 0) + int(times)
                if len(kept[i]) > KEPT_VALUES:
                    yield _selected([(i, k, value, n, value, value) for (k, value), n in kept[i].items()])
                    kept[i].clear()
        yield _selected(
            [(i, k, None, *s) for i, of in enumerate(seen) for k, s in of.items()]
            + [(i, k, value, n, value, value) for i, of in enumerate(kept) for (k, value), n in of.items()]
        )

    data = df.select(array_of([F.col(c) for c in cols]).alias("_x")).mapInArrow(run, _SELECTED)
    rows = (
        data.groupBy("c", "stretch", "v").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        .limit(MAX_SELECTED + 1).collect()
    )
    if len(rows) > MAX_SELECTED:
        return
    stretches: dict = {}
    values: dict = {}
    for r in rows:
        if r["v"] is None:
            stretches.setdefault(cols[r["c"]], []).append((r["stretch"], r["n"], r["low"], r["high"]))
        else:
            values.setdefault((cols[r["c"]], r["stretch"]), []).append((r["v"], r["n"]))
    for c, position in points:
        if (c, position) in found:
            continue
        need = position
        for k, n, low, high in sorted(stretches[c]):
            if need >= n:
                need -= n
                continue
            if low == high:
                found[c, position] = low
            for v, times in sorted(values.get((c, k), [])):
                if need < times:
                    found[c, position] = v
                    break
                need -= times
            break


_SELECTED = "c int, stretch int, v double, n long, low double, high double"


def _selected(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.float64(), pa.float64()]
    columns = list(zip(*rows)) if rows else [()] * 6
    names = [f.split()[0] for f in _SELECTED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def _select_in_rounds(long: DataFrame, points: dict, found: dict) -> None:
    """Narrow the stretches around the positions, one scan for each factor of
    fifty, until one holds a single value or few rows."""
    pending = dict(points)
    while pending:
        segments = _segments(long, pending)
        leaves = {}
        for t in list(pending):
            need = t[2]
            for r in segments[t[:2]]:
                if need < r["cnt"]:
                    break
                need -= r["cnt"]
            if r["bmin"] == r["bmax"]:
                found[t[1:]] = r["bmin"]
            elif r["cnt"] <= SELECT_LEAF_ROWS:
                leaves[t] = (r["bmin"], r["bmax"], need)
            else:
                # the ends become points of their own, so the stretch shrinks
                # even where a hot value fills the whole grid
                at, last = need / r["cnt"] * (len(r["grid"]) - 1), len(r["grid"]) - 1
                near = {r["grid"][max(0, math.floor(at) - 1)], r["grid"][min(last, math.ceil(at) + 1)]}
                pending[t] = {r["bmin"], r["bmax"], r["grid"][round(at)], *near}
                continue
            pending.pop(t)
        if leaves:
            resolved: dict = {}
            _resolve_leaves(long, leaves, resolved)
            found.update({t[1:]: v for t, v in resolved.items()})


def grouped_quantiles(df: DataFrame, value_cols: Sequence[str], qs: Sequence[float], group_col: str) -> DataFrame:
    """(group, feature, q, value): exact linear-interpolation quantiles of every
    column in every group, NULL and NaN skipped; NULL is a group of its own.

    No expression, broadcast or collect grows with the groups, and a group that
    holds most rows is sorted over many tasks.  Few distinct values in all (at
    most ``SELECT_LEAF_ROWS``) are counted off directly.
    """
    values = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in value_cols])
    long = df.select(F.col(group_col).alias("_g"), F.explode(values).alias("_s")).select("_g", "_s.c", "_s.v")
    long = long.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    counted = long.groupBy("_g", "c", "v").agg(F.count("*").alias("n"))
    schema = T.StructType(
        [
            T.StructField("group", df.schema[group_col].dataType),
            T.StructField("feature", T.StringType()),
            T.StructField("q", T.DoubleType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    few = counted.limit(SELECT_LEAF_ROWS + 1).collect()
    if len(few) <= SELECT_LEAF_ROWS:
        return df.sparkSession.createDataFrame(_count_off(few, qs), schema)
    ordered = materialize(counted.orderBy("c", "_g", "v").select("*", F.spark_partition_id().alias("_pid")))
    # a stretch of one group and column in one partition of the sort
    w = Window.partitionBy("c", "_g")
    runs = ordered.groupBy("c", "_g", "_pid").agg(F.sum("n").alias("m"))
    runs = runs.select(
        F.col("c").alias("_c"), F.col("_g").alias("_h"), F.col("_pid").alias("_at"), "m",
        (F.sum("m").over(w.orderBy("_pid")) - F.col("m")).alias("before"), F.sum("m").over(w).alias("total"),
    )
    ends = [e for q in qs for e in _ends(F.col("total"), q)[:2]]
    inside = F.filter(F.array_distinct(F.array(*ends)), lambda p: (p >= F.col("before")) & (p < F.col("before") + F.col("m")))
    wanted = runs.withColumn("at", inside).filter(F.size("at") > 0)
    same = (F.col("_pid") == F.col("_at")) & (F.col("c") == F.col("_c")) & F.col("_g").eqNullSafe(F.col("_h"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("c", "_g", "_pid").orderBy("v"))
    met = ordered.join(wanted, same).withColumn("upto", upto)
    here = F.filter("at", lambda p: (p >= F.col("upto") - F.col("n")) & (p < F.col("upto")))
    met = met.withColumn("pos", F.explode(here)).groupBy("_g", "c", "total")
    picked = []
    for q in qs:
        low, high, part = _ends(F.col("total"), q)
        low_v, high_v = (F.max(F.when(F.col("pos") == e, F.col("v"))) for e in (low, high))
        picked.append(F.struct(F.lit(float(q)).alias("q"), (low_v + part * (high_v - low_v)).alias("value")))
    found = met.agg(F.array(*picked).alias("s")).select(F.col("_g").alias("group"), F.col("c").alias("feature"), F.explode("s").alias("s"))
    return found.select("group", "feature", "s.q", "s.value")


def _ends(total: Column, q: float) -> tuple[Column, Column, Column]:
    """0-based positions around quantile ``q`` of ``total`` rows, and the weight
    of the upper one."""
    h = (total - 1) * F.lit(float(q))
    return F.floor(h).cast("long"), F.ceil(h).cast("long"), h - F.floor(h)


def _count_off(rows: Sequence, qs: Sequence[float]) -> list[tuple]:
    """Quantiles from (group, column, value, count) rows."""
    by_key: dict = {}
    for r in rows:
        by_key.setdefault((r["_g"], r["c"]), []).append((r["v"], r["n"]))
    out = []
    for (g, c), counts in by_key.items():
        counts.sort()
        upto = np.cumsum([n for _, n in counts])
        for q in qs:
            h = (int(upto[-1]) - 1) * q
            low, high = (counts[int(np.searchsorted(upto, e, side="right"))][0] for e in (math.floor(h), math.ceil(h)))
            out.append((g, c, float(q), low + (h - math.floor(h)) * (high - low)))
    return out


def _segments(long: DataFrame, points: dict) -> dict:
    """Per (group, column), in order of value: count, extremes and approximate
    grid of the rows at each point and between points (one scan)."""
    case = None
    for key in sorted({t[:2] for t in points}, key=repr):
        inner = None
        ends = sorted(set().union(*[e for t, e in points.items() if t[:2] == key]))
        for i, end in enumerate(ends):
            below, at = F.col("_v") < dlit(end), F.col("_v") == dlit(end)
            inner = F.when(below, F.lit(2 * i)) if inner is None else inner.when(below, F.lit(2 * i))
            inner = inner.when(at, F.lit(2 * i + 1))
        inner = inner.otherwise(F.lit(2 * len(ends)))
        same = (F.col("_c") == F.lit(key[1])) & (F.col("_g").isNull() if key[0] is None else F.col("_g") == F.lit(key[0]))
        case = F.when(same, inner) if case is None else case.when(same, inner)
    grid = [i / 100 for i in range(101)]
    rows = (
        long.withColumn("_seg", case)
        .filter(F.col("_seg").isNotNull())
        .groupBy("_g", "_c", "_seg")
        .agg(F.count("*").alias("cnt"), F.min("_v").alias("bmin"), F.max("_v").alias("bmax"),
             F.percentile_approx("_v", grid, BRACKET_ACCURACY).alias("grid"))
        .collect()
    )
    out: dict = {}
    for r in sorted(rows, key=lambda r: r["_seg"]):
        out.setdefault((r["_g"], r["_c"]), []).append(r)
    return out


def _resolve_leaves(long: DataFrame, leaves: dict, found: dict) -> None:
    """Read the distinct values of small ranges with their counts (one job) and
    count off the positions."""
    hit = None
    for (g, c, _), (lo, hi, _) in leaves.items():
        same = F.col("_g").isNull() if g is None else F.col("_g") == F.lit(g)
        cond = same & (F.col("_c") == F.lit(c)) & F.col("_v").between(dlit(lo), dlit(hi))
        hit = cond if hit is None else hit | cond
    values: dict = {}
    for r in long.filter(hit).groupBy("_g", "_c", "_v").agg(F.count("*").alias("n")).collect():
        values.setdefault((r["_g"], r["_c"]), []).append((r["_v"], r["n"]))
    for t, (lo, hi, need) in leaves.items():
        for v, n in sorted(x for x in values[t[:2]] if lo <= x[0] <= hi):
            if need < n:
                found[t] = v
                break
            need -= n
