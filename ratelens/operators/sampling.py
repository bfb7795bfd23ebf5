"""Seeded, engine-independent sampling.

Selection is by the order of ``md5('<seed>:<key>')``: the same seed picks the
same rows on any cluster and any partitioning, which ``sample``/``randomSplit``
do not promise.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MOVIE
from ..session import cut_lineage

# Up to this many rows a top-n by sort key is a TakeOrderedAndProject (each
# task keeps n rows); beyond it the n-th hash is found and the rows filtered.
TOPN_LIMIT = 100_000
# So few rows are kept by every task without a threshold first.
DIRECT_ROWS = 100
# A hash prefix with at most this many rows of a group is ranked row by row.
PREFIX_ROWS = 50_000
_DIGITS = 4  # hex digits by which the prefix grows: at most 65,536 counts a group and pass


def seeded_hash(seed: int, keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def nth_hash(h: DataFrame, wanted: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The (_h, keys) of each group's ``_t``-th row in (_h, keys) order; ``wanted``: by, _t (at least 1, at most the group's rows).

    Rows are counted by hash prefix; the prefix in which the wanted row lies
    is known from the counts, and only its rows are counted by a longer one,
    until few are left to rank.  No row is sorted, exchanged or written but
    those few.
    """
    by = list(by)
    left = cut_lineage(wanted.select(*by, "_t", F.lit("").alias("_p"), F.lit(0).cast("long").alias("_before")))

    def inside(width: int) -> DataFrame:
        side = F.broadcast(left.withColumnsRenamed({c: f"_on_{c}" for c in by}))  # one row per group
        same = F.substring("_h", 1, width) == F.col("_p") if width else F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
        return h.join(side, same).drop(*[f"_on_{c}" for c in by])

    for width in range(_DIGITS, 33, _DIGITS):
        counts = inside(width - _DIGITS).groupBy(*by, "_t", "_before", F.substring("_h", 1, width).alias("_q")).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_q")) + F.col("_before")
        hit = counts.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_t")) & (F.col("_upto") - F.col("_n") < F.col("_t")))
        left = cut_lineage(hit.select(*by, "_t", F.col("_q").alias("_p"), (F.col("_upto") - F.col("_n")).alias("_before"), "_n"))
        if (left.agg(F.max("_n")).first()[0] or 0) <= PREFIX_ROWS:
            break
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_h", *keys)) + F.col("_before")
    return inside(width).withColumn("_place", place).filter("_place = _t").select(*by, "_h", *keys)


def up_to(h: DataFrame, last: DataFrame, by: Sequence[str], keys: Sequence[str], out: str) -> DataFrame:
    """``h`` with ``out``: whether the row stands at or before its group's row in ``last`` (false for groups without one)."""
    order = ["_h", *keys]
    side = F.broadcast(last.withColumnsRenamed({c: f"_on_{c}" for c in [*by, *order]}))  # one row per group
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    at = F.struct(*order) <= F.struct(*[F.col(f"_on_{c}").alias(c) for c in order])
    return h.join(side, same, "left").withColumn(out, F.coalesce(at, F.lit(False))).drop(*[f"_on_{c}" for c in [*by, *order]])


def first_n_by_hash(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: those with the smallest seeded hash.

    The hash is uniform, so rows whose first 32 hash bits fall under a
    threshold of about 1.25 n / N are a superset of the answer; every other
    row sorts after every candidate, so taking the n smallest candidates is
    exact.  The threshold doubles until at least n rows pass.  The final
    top-n therefore merges about 1.25 n rows, not n rows per partition
    (up to ``DIRECT_ROWS`` rows are simply kept by every task).
    """
    h = df.withColumn("_h", seeded_hash(seed, keys))
    if n <= min(DIRECT_ROWS, TOPN_LIMIT):
        return h.orderBy("_h", *keys).limit(n).drop("_h")
    total = h.count()
    if n >= total:
        return df
    cand = h
    if total > 2 * n:
        frac = min(1.0, 1.25 * n / total + 64.0 / total)
        while frac < 1.0:
            thr = format(min(int(frac * 16 ** 8), 16 ** 8 - 1), "08x")
            trial = h.filter(F.substring("_h", 1, 8) < F.lit(thr))
            if trial.count() >= n:
                cand = trial
                break
            frac = min(1.0, frac * 2)
    order = ["_h", *keys]
    if n <= TOPN_LIMIT:
        return cand.orderBy(*order).limit(n).drop("_h")
    cand = cut_lineage(cand.withColumn("_all", F.lit(0)))
    wanted = df.sparkSession.range(1).select(F.lit(0).alias("_all"), F.lit(n).cast("long").alias("_t"))
    last = nth_hash(cand, wanted, ["_all"], list(keys))
    return up_to(cand, last, ["_all"], list(keys), "_in").filter("_in").drop("_h", "_all", "_in")


def sample_rows(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """A seeded sample of exactly n rows (all rows if fewer)."""
    return first_n_by_hash(df, n, seed, keys)


def sample_items(ratings: DataFrame, fraction: float, seed: int = 42, item: str = MOVIE) -> DataFrame:
    """Keep all ratings of ``max(1, int(n_items * fraction))`` items."""
    if fraction >= 1.0:
        return ratings
    items = ratings.select(item).distinct()
    n_items = items.count()
    k = max(1, int(n_items * fraction))
    chosen = first_n_by_hash(items, k, seed, [item])
    return ratings.join(chosen, item, "left_semi")


def assign_folds(df: DataFrame, k: int, seed: int, keys: Sequence[str], out: str = "fold") -> DataFrame:
    """Shuffled k-fold id from the first 32 bits of the seeded hash."""
    h = seeded_hash(seed, keys)
    return df.withColumn(out, (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % k).cast("int"))
