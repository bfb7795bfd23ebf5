"""Exact global ranks, running sums and quantiles without a one-task window.

A window with ``orderBy`` and no ``partitionBy`` sorts everything in one task.
Instead ``repartitionByRange`` cuts the sort key space into as many ranges as
the row count asks for (no upper limit); the rows are written with their range
number into the checkpoint folder, so the cut points are fixed for all later
steps and survive lost executors.  The per-range totals are prefix-summed (one
row per range) and joined back, and each range is ranked by its own window.
Nulls sort where Spark sorts them, whatever the number of ranges.  The sort
key must be unique (add the id column) so ties can never straddle two ranges
in different orders.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

Order = Sequence  # of (column name, ascending: bool)

ROWS_PER_BUCKET = 200_000
#: a joined side of at most so many rows is broadcast (its rows are counted first)
BROADCAST_ROWS = 10_000


def _norm(order) -> list[tuple[str, bool]]:
    return [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def _sort_cols(order: list[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc() if a else F.col(c).desc() for c, a in order]


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the checkpoint folder, and its rows counted while they are written."""
    seen = Observation()
    df = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return df, seen.get["n"]


def join_counted(df: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """Null-safe inner join with a side that is broadcast if its counted rows are few."""
    small, n = _counted(small)
    names = {c: f"_on_{c}" for c in on}
    side = small.withColumnsRenamed(names)
    if n <= BROADCAST_ROWS:
        side = F.broadcast(side)
    cond = F.lit(True)
    for c in on:
        cond = cond & df[c].eqNullSafe(F.col(names[c]))
    return df.join(side, cond).drop(*names.values())


def bucketize(df: DataFrame, order, n_rows: int | None = None, rows_per_bucket: int | None = None,
              bucket_col: str = "_bkt") -> tuple[DataFrame, int]:
    """(rows with a range number that is monotone in ``order``, number of ranges)."""
    if n_rows is None:
        df, n_rows = _counted(df)  # then cut into ranges
    n = max(1, math.ceil(n_rows / (rows_per_bucket or ROWS_PER_BUCKET)))
    if n == 1:
        return df.withColumn(bucket_col, F.lit(0)), 1
    ranged = df.repartitionByRange(n, *_sort_cols(_norm(order)))
    return cut_lineage(ranged.withColumn(bucket_col, F.spark_partition_id())), n


def running_sum(df: DataFrame, order, weight=None, out="cum_before", n_rows: int | None = None,
                rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 per row by default) over all rows
    strictly before this one in ``order``.  ``order`` must be a unique key.
    ``weight``/``out`` may be lists to accumulate several columns in one pass."""
    order = _norm(order)
    weights = weight if isinstance(weight, (list, tuple)) else [weight]
    outs = list(out) if isinstance(out, (list, tuple)) else [out]
    if len(weights) != len(outs):
        raise ValueError("one output name per weight")
    ws = [F.col(w) if w else F.lit(1) for w in weights]
    bk, n_ranges = bucketize(df, order, n_rows, rows_per_bucket)
    win = (Window.partitionBy("_bkt").orderBy(*_sort_cols(order))
           .rowsBetween(Window.unboundedPreceding, -1))
    locs = [F.coalesce(F.sum(w).over(win), F.lit(0)) for w in ws]
    if n_ranges == 1:
        # one range (<= ROWS_PER_BUCKET rows): no offsets to add
        return bk.withColumns({o: l.cast("bigint") for o, l in zip(outs, locs)}).drop("_bkt")
    totals = bk.groupBy("_bkt").agg(*[F.sum(w).alias(f"_w{i}") for i, w in enumerate(ws)])
    # one row per range: prefix sum in one tiny task
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bkt", *[F.coalesce(F.sum(f"_w{i}").over(before), F.lit(0)).alias(f"_off{i}")
                                      for i in range(len(ws))])
    if n_ranges <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    res = bk.withColumns({f"_loc{i}": l for i, l in enumerate(locs)}).join(offsets, "_bkt")
    res = res.withColumns({o: (F.col(f"_off{i}") + F.col(f"_loc{i}")).cast("bigint") for i, o in enumerate(outs)})
    return res.drop("_bkt", *[f"_off{i}" for i in range(len(ws))], *[f"_loc{i}" for i in range(len(ws))])


def global_row_number(df: DataFrame, order, out: str = "rn", by: Sequence[str] = (),
                      n_rows: int | None = None) -> DataFrame:
    """Exact ``row_number()`` over ``order`` (per ``by`` group if given).

    Equals ``row_number().over(Window.partitionBy(*by).orderBy(*order))`` but
    no group or global sort is ever one task: hot groups are split into
    ranges like everything else.
    """
    by = list(by)
    full = [(c, True) for c in by] + _norm(order)
    ranked = running_sum(df, full, out="_cb", n_rows=n_rows)
    if not by:
        return ranked.withColumn(out, F.col("_cb") + 1).drop("_cb")
    starts = ranked.groupBy(*by).agg(F.min("_cb").alias("_gs"))
    return (
        join_counted(ranked, starts, by)
        .withColumn(out, F.col("_cb") - F.col("_gs") + 1)
        .drop("_cb", "_gs")
    )


def qcut_score(rn: Column, n: Column, q: int = 5) -> Column:
    """pandas ``qcut(rank(method='first'), q)`` label in 1..q, from the rank.

    Closed form of the interpolated, right-closed edges:
    ``max(1, ceil(q*(rn-1)/(n-1)))`` in integer arithmetic.  n = 1 has no
    valid edges (pandas raises) and fails here as a division by zero.
    """
    num = F.lit(q) * (rn - 1) + n - 2
    return F.greatest(F.lit(1), F.floor(num / (n - 1)).cast("int")).cast("int")


def exact_percentiles(df: DataFrame, col: str, qs: Sequence[float],
                      by: Sequence[str] = (), prefix: str = "p", weight: str | None = None) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas 'linear'), exact.

    Values are first counted per (group, value) with map-side combining, so
    the ranked table has one row per distinct value, not per input row
    (``weight``: a column with the number of times a row's value stands for).
    Output: one row per group with ``{prefix}{int(q*100)}`` columns.
    """
    by = list(by)
    glob = not by
    if glob:  # one implicit group
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    vc = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    cum = running_sum(vc, [(c, True) for c in by] + [(col, True)], weight="_n", out="_cb")
    g = cum.groupBy(*by).agg(F.min("_cb").alias("_gs"), F.sum("_n").alias("_gn"))
    cum = join_counted(cum, g, by)
    lo_r = F.col("_cb") - F.col("_gs")  # rank (0-based) of this value's first copy
    hi_r = lo_r + F.col("_n")
    aggs = []
    for q in qs:
        h = (F.col("_gn") - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        tag = f"{prefix}{int(round(q * 100))}"
        aggs.append(F.max(F.when((lo >= lo_r) & (lo < hi_r), F.col(col))).alias(f"_{tag}_lo"))
        aggs.append(F.max(F.when((hi >= lo_r) & (hi < hi_r), F.col(col))).alias(f"_{tag}_hi"))
        aggs.append(F.max(h - lo).alias(f"_{tag}_f"))
    res = cum.groupBy(*by).agg(*aggs)
    outs = []
    for q in qs:
        tag = f"{prefix}{int(round(q * 100))}"
        lo_v, hi_v, fr = (F.col(f"_{tag}_lo").cast("double"), F.col(f"_{tag}_hi").cast("double"),
                          F.col(f"_{tag}_f"))
        outs.append((lo_v + (hi_v - lo_v) * fr).alias(tag))
    res = res.select(*by, *outs)
    return res.drop("_all") if glob else res
