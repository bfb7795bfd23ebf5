"""Views over the driver's parquet tables that give the ratings data model.

The driver's tables hold no ratings log, so ``ratings``, ``movie_titles`` and
``probe`` are derived from ``lineitem``/``orders``/``part`` by one fixed
definition that the DuckDB oracle repeats verbatim (see FIXTURES.md).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import CUSTOMER, DATE, MOVIE, RATING


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .select(
            F.col("o_custkey").cast("bigint").alias(CUSTOMER),
            F.col("l_partkey").cast("bigint").alias(MOVIE),
            F.ceil(F.col("l_quantity") / 10).cast("int").alias(RATING),
            F.col("o_orderdate").cast("date").alias(DATE),
        )
    )


def movie_titles_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("bigint").alias(MOVIE),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("int"))
        .otherwise(F.lit(1950) + F.col("p_size")).cast("int").alias("year_of_release"),
        F.concat(F.col("p_name"), F.lit(", "), F.col("p_brand")).alias("title"),
    )


def probe_view(ratings: DataFrame) -> DataFrame:
    key = F.concat(F.col(CUSTOMER).cast("string"), F.lit(":"), F.col(MOVIE).cast("string"))
    return (
        ratings.select(CUSTOMER, MOVIE)
        .filter(F.md5(key) < F.lit("04"))
        .distinct()
    )


@dataclass
class Views:
    spark: SparkSession
    sf_dir: str

    @property
    def ratings(self) -> DataFrame:
        return ratings_view(self.spark, self.sf_dir)

    @property
    def movie_titles(self) -> DataFrame:
        return movie_titles_view(self.spark, self.sf_dir)

    @property
    def probe(self) -> DataFrame:
        return probe_view(self.ratings)

    @property
    def embeddings(self) -> DataFrame:
        return table(self.spark, self.sf_dir, "embeddings")


def views(spark: SparkSession, sf_dir: str) -> Views:
    return Views(spark, sf_dir)


# ---------------------------------------------------------------------------
# Raw text derived from the views (one line per row), for the parser queries.
# Every parse key must give back exactly the view its text came from.

def _h(*cols) -> "F.Column":
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in cols]))


def title_lines(titles: DataFrame) -> DataFrame:
    """``id,year,title`` lines (year ``NULL`` when absent), some padded with
    tabs/spaces/CR, plus blank lines: one ``movie_titles.txt``."""
    year = F.coalesce(F.col("year_of_release").cast("string"), F.lit("NULL"))
    line = F.concat_ws(",", F.col(MOVIE).cast("string"), year, F.col("title"))
    pad = F.substring(_h(MOVIE), 1, 1)
    line = F.when(pad < "4", F.concat(F.lit("\t "), line, F.lit(" \r"))).otherwise(line)
    body = titles.select(F.lit("movie_titles.txt").alias("file"), F.lit(0).cast("bigint").alias("block"),
                         (F.col(MOVIE) * 2).alias("pos"), line.alias("value"))
    blanks = titles.filter(pad == "f").select(
        F.lit("movie_titles.txt").alias("file"), F.lit(0).cast("bigint").alias("block"),
        (F.col(MOVIE) * 2 + 1).alias("pos"), F.lit("   ").alias("value"))
    return body.unionByName(blanks)


def _bad_variant(kind: "F.Column") -> "F.Column":
    """Malformed data lines the parser must skip (derived from real rows)."""
    c, r, d = (F.col(CUSTOMER).cast("string"), F.col(RATING).cast("string"), F.col(DATE).cast("string"))
    return (F.when(kind == 0, F.lit(""))
            .when(kind == 1, F.concat(F.lit("abc"), c, F.lit(","), r, F.lit(","), d))
            .when(kind == 2, F.concat(c, F.lit(",x,"), d))
            .otherwise(F.concat(c, F.lit(","), r)))


SECTION_SPAN = 1 << 32


def rating_section_lines(ratings: DataFrame, split_every: int = 97) -> DataFrame:
    """One ``mv_<id>.txt`` per item: ``<id>:`` then ``cust,rating,date`` lines.

    Every tenth file is cut into splits (``block``) every ``split_every``
    positions, mid-section, so header carry-in across splits is exercised.  About 5 % of rows also
    emit a malformed twin line that must be skipped.
    """
    file = F.concat(F.lit("mv_"), F.lpad(F.col(MOVIE).cast("string"), 7, "0"), F.lit(".txt"))
    pos = F.col(CUSTOMER) + 1
    # real splits hold many lines: only every tenth file is cut finely
    block = F.when(F.col(MOVIE) % 10 == 0, (pos / split_every).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    data = ratings.select(
        file.alias("file"), block.alias("block"), (pos * 4).alias("pos"),
        F.concat_ws(",", F.col(CUSTOMER).cast("string"), F.col(RATING).cast("string"),
                    F.col(DATE).cast("string")).alias("value"))
    h = _h(CUSTOMER, MOVIE, DATE, RATING)
    bad = ratings.filter(F.substring(h, 1, 2) < "0d").select(
        file.alias("file"), block.alias("block"), (pos * 4 + 1).alias("pos"),
        _bad_variant(F.conv(F.substring(h, 3, 1), 16, 10).cast("int") % 4).alias("value"))
    heads = ratings.select(MOVIE).distinct().select(
        file.alias("file"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("pos"),
        F.concat(F.col(MOVIE).cast("string"), F.lit(":")).alias("value"))
    return heads.unionByName(data).unionByName(bad)


def probe_section_lines(probe: DataFrame, split_every: int = 7 * SECTION_SPAN + 12345) -> DataFrame:
    """A single ``probe.txt``: sections ``<movie>:`` then bare customer ids,
    split every ``split_every`` positions (mid-section)."""
    base = F.col(MOVIE) * F.lit(SECTION_SPAN)
    rows = probe.select((base + F.col(CUSTOMER) + 1).alias("pos"),
                        F.col(CUSTOMER).cast("string").alias("value"))
    heads = probe.select(MOVIE).distinct().select(
        base.alias("pos"), F.concat(F.col(MOVIE).cast("string"), F.lit(":")).alias("value"))
    return rows.unionByName(heads).select(
        F.lit("probe.txt").alias("file"), (F.col("pos") / F.lit(split_every)).cast("bigint").alias("block"),
        "pos", "value")
