"""Recency / frequency / monetary scoring and segment reports."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import segment_expr
from ..schemas import CUSTOMER, DATE, RATING
from .eda import describe_long
from .prep import resolve_reference_date
from .rank import exact_percentiles, global_row_number, join_counted, qcut_score


def rfm_base(ratings: DataFrame, reference=None) -> DataFrame:
    """customer_id, R (days since last rating), F (count), M (mean).

    R is negative for ratings after the reference date (no filter).
    """
    ref = resolve_reference_date(ratings, reference)
    return (ratings.groupBy(CUSTOMER)
            .agg(F.max(DATE).alias("_last"), F.count(F.lit(1)).alias("F"), F.avg(RATING).alias("M"))
            .select(CUSTOMER, F.datediff(ref, F.col("_last")).cast("int").alias("R"), "F", "M"))


def quintile(df: DataFrame, value: str, ascending: bool, out: str, n: int,
             id_col: str = CUSTOMER, q: int = 5) -> DataFrame:
    """W1+W2: qcut of rank(method='first') into q labels.

    Rank = exact global row number by (value, id) -- ties by ascending id,
    the order the reference's groupby produces -- computed in ranges, never
    in one task.
    """
    ranked = global_row_number(df, [(value, ascending), (id_col, True)], out="_rn", n_rows=n)
    return ranked.withColumn(out, qcut_score(F.col("_rn"), F.lit(n))).drop("_rn")


def rfm_scores(base: DataFrame) -> DataFrame:
    """R2: R_score (recent = high), F_score, M_score and RFM_score."""
    n = base.count()
    s = quintile(base, "R", False, "R_score", n)
    s = quintile(s, "F", True, "F_score", n)
    s = quintile(s, "M", True, "M_score", n)
    return s.withColumn("RFM_score", F.col("R_score") + F.col("F_score") + F.col("M_score"))


def rfm_segments(scores: DataFrame) -> DataFrame:
    """First-match rule cascade."""
    return scores.withColumn("segment", segment_expr("R_score", "F_score", "M_score"))


def segment_sizes(rfm: DataFrame, col: str = "segment") -> DataFrame:
    """Size and percentage share per segment (share over a tiny table)."""
    counts = rfm.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def rf_heatmap(rfm: DataFrame) -> DataFrame:
    """R_score x F_score counts, zero-filled, columns f_1..f_5."""
    p = rfm.groupBy("R_score").pivot("F_score", [1, 2, 3, 4, 5]).agg(F.count(F.lit(1)))
    return p.select("R_score", *[F.coalesce(F.col(str(i)), F.lit(0)).cast("bigint").alias(f"f_{i}")
                                 for i in range(1, 6)])


def box_stats(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """Box-plot numbers per group and column: quartiles (linear),
    whiskers = most extreme data inside 1.5 IQR fences, outlier count."""
    long = df.select(by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("kv")).select(by, "kv.metric", "kv.value")
    q = exact_percentiles(long, "value", [0.25, 0.5, 0.75], by=[by, "metric"])
    iqr = F.col("p75") - F.col("p25")
    lo_f, hi_f = F.col("p25") - 1.5 * iqr, F.col("p75") + 1.5 * iqr
    j = join_counted(long, q, [by, "metric"])
    inside = (F.col("value") >= lo_f) & (F.col("value") <= hi_f)
    return j.groupBy(by, "metric").agg(
        F.first("p25").alias("q1"), F.first("p50").alias("median"), F.first("p75").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outliers"),
    )


def score_histogram(rfm: DataFrame, col: str = "RFM_score", lo: int = 3, hi: int = 15) -> DataFrame:
    """Unit bins lo..hi (edges lo-0.5 .. hi+0.5), zero-filled."""
    bins = rfm.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("bin"))
    counts = rfm.groupBy(F.col(col).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return bins.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def segment_rollup(rfm: DataFrame, col: str = "segment", root: str = "All") -> DataFrame:
    """Treemap data (label, parent, n); the root carries the total."""
    r = rfm.rollup(col).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
    return r.select(
        F.when(F.col("_g") == 1, F.lit(root)).otherwise(F.col(col)).alias("label"),
        F.when(F.col("_g") == 1, F.lit("")).otherwise(F.lit(root)).alias("parent"),
        "n")


def rfm_describe(rfm: DataFrame) -> DataFrame:
    return describe_long(rfm, ["R", "F", "M"])


def rfm_with_cluster(rfm: DataFrame, user_clusters: DataFrame, default: str = "(not in 04)") -> DataFrame:
    """Attach cluster names (de-duplicated pairs), default when absent."""
    names = user_clusters.select(CUSTOMER, "cluster_name").dropDuplicates()
    return (rfm.join(names, CUSTOMER, "left")
            .withColumn("cluster_name", F.coalesce(F.col("cluster_name"), F.lit(default))))


def crosstab(df: DataFrame, a: str, b: str, total: str = "All") -> DataFrame:
    """Long-form cross-tab with margins: (a, b, n) plus 'All' rows/cols."""
    c = df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
    return c.select(
        F.when(F.col("_g").bitwiseAND(2) == 2, F.lit(total)).otherwise(F.col(a)).alias(a),
        F.when(F.col("_g").bitwiseAND(1) == 1, F.lit(total)).otherwise(F.col(b)).alias(b),
        "n")


def crosstab_pct(df: DataFrame, a: str, b: str) -> DataFrame:
    """Percent of each row (a) falling in each column (b); absent
    pairs are 0; margins excluded.  Dense grid of the distinct labels."""
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    # pivot fills absent pairs (the label set is small: clusters), then back to long
    wide = counts.groupBy(a).pivot(b).agg(F.first("n")).na.fill(0)
    labels = [c for c in wide.columns if c != a]
    long = wide.unpivot([a], labels, b, "n")
    tot = counts.groupBy(a).agg(F.sum("n").alias("_t"))
    return long.join(tot, a).select(a, b, (F.col("n") * 100.0 / F.col("_t")).alias("pct"))
