"""Mixing sources to target weights by Poisson replication (list item 8, DataFrame functions only).

Each document of a group g (a source with a given weight; all other sources,
null included, form one group that gets the remaining weight) is repeated
Poisson(r_g) times, r_g = weight_g * target_bytes / bytes_g, so every group's
expected share of the output bytes is its weight.  The draw inverts the
Poisson distribution function at a uniform number taken from a hash of seed
and id, so any cluster draws the same counts.  The distribution tables have
one row per *named weight* (a parameter), which bounds what is broadcast.
Rows are exploded by their counts and sorted globally by a hash of (seed, id,
copy): range partitions of a uniform key, whatever the sources' sizes.

Edge cases: null text counts 0 bytes plus 1; null ids hash as the empty
string; rows repeated under one id draw the same count; a group without rows
has no rate; an empty table gives no rows; input columns named like an
output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_others, quoted

OUT = ["copy", "copies", "shuffle_key", "__group", "__cdf"]
REST = "*"


def uniform(seed: int, *keys: Column) -> Column:
    """52 bits of an md5 as a number in [0, 1)."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def repetition_rates(docs: DataFrame, weights: dict[str, float], target_bytes: int | None = None,
                     source_col: str = "source", text_col: str = "text") -> DataFrame:
    """__group, rate: one row per named weight that has rows, and one for the rest."""
    if any(w < 0 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights must be non-negative and sum to 1 at most")
    size = (F.octet_length(F.coalesce(quoted(text_col).cast("string"), F.lit(""))) + 1).cast("long")
    by = (docs.select(_group(weights, source_col).alias("__group"), size.alias("__size"))
          .groupBy("__group").agg(F.sum("__size").alias("__bytes")))
    total = F.lit(int(target_bytes)) if target_bytes else F.sum("__bytes").over(Window.partitionBy())
    share = F.lit(max(0.0, 1.0 - sum(weights.values())))
    for name, w in weights.items():
        share = F.when(F.col("__group") == _key(name), F.lit(float(w))).otherwise(share)
    return by.select("__group", (share * total / F.col("__bytes")).alias("rate"))


def _key(name: str) -> Column:
    return F.lit("=" + name)


def _group(weights: dict[str, float], source_col: str) -> Column:
    src = quoted(source_col).cast("string")
    return F.when(src.isin(list(weights)), F.concat(F.lit("="), src)).otherwise(F.lit(REST))


def poisson_tables(rates: DataFrame) -> DataFrame:
    """__group, __cdf: P(X <= k) for k = 0, 1, ... until the rest is below the draw's 52 bits."""
    k = rates.select("__group", "rate", F.explode(F.expr(
        "sequence(0L, if(rate > 0, cast(ceil(rate + 12 * sqrt(rate) + 40) as bigint), 0L))")).alias("k"))
    upto = Window.partitionBy("__group").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("k") == 0, -F.col("rate")).otherwise(F.log(F.col("rate") / F.col("k")))
    pmf = k.withColumn("__p", F.exp(F.sum(step).over(upto)))
    cdf = pmf.select("__group", "k", F.sum("__p").over(upto).alias("__c"))
    return cdf.groupBy("__group").agg(F.sort_array(F.collect_list(F.struct("k", "__c"))).alias("__t")) \
        .select("__group", F.col("__t").getField("__c").alias("__cdf"))


def poisson_mix(docs: DataFrame, weights: dict[str, float], seed: int, target_bytes: int | None = None,
                id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` plus copies (drawn), copy (1 .. copies) and shuffle_key, in global shuffle order."""
    cdf = poisson_tables(repetition_rates(docs, weights, target_bytes, source_col, text_col))
    cols = keep_others(docs, OUT)
    drawn = (docs.select(*[quoted(c) for c in cols], _group(weights, source_col).alias("__group"))
             .join(F.broadcast(cdf), "__group")  # len(weights) + 1 rows
             .withColumn("__u", uniform(seed, quoted(id_col)))
             .withColumn("copies", F.expr("cast(size(filter(__cdf, c -> c <= __u)) as bigint)"))
             .filter("copies > 0")
             .withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))))
    key = F.md5(F.concat_ws(":", F.lit(f"shuffle{seed}"), F.coalesce(quoted(id_col).cast("string"), F.lit("")), F.col("copy")))
    return (drawn.select(*[quoted(c) for c in cols], "copies", "copy", key.alias("shuffle_key"))
            .orderBy("shuffle_key", quoted(id_col), "copy"))
