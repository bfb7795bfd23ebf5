"""Line-oriented text sources: item catalogue (S1), sectioned ratings (S2),
sectioned pairs (S3).

A sectioned file is ``<id>:`` header lines, each followed by data lines.
Lines are read with ``spark.read.text``, so a single huge file is read by many
tasks, each of which sees its split's lines in order.  The task that reads a
split carries the latest header forward itself (vectorised over the Arrow
batch; the lines go through an Arrow scan, they are not exchanged).  Only a
split that starts in the middle of a section lacks its header: it comes from
a table with one row per split, the last header of the splits before, which
is made by a scan for headers that is summed map-side -- and not at all when
no file is longer than a split.

Lines tables have columns ``file, block, pos, value``; any producer (files,
or fixtures derived from tables) can feed the parsers.  Lines that are not
in file order in their partitions are brought into it first.
"""

from __future__ import annotations

from hashlib import md5
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import clean_line, header_text, int_or_null, is_header, split_fields, try_int, try_long
from ..schemas import CUSTOMER, DATE, MOVIE, RATING
from ..session import cut_lineage

MODES = ("failfast", "drop")


#: a table of at most so many splits is broadcast (its rows are counted first)
BROADCAST_SPLITS = 100_000
#: names of the rating files in a raw folder
RATING_FILES = "mv_*.txt"


def rating_files(spark: SparkSession, path, fraction: float = 1.0, seed: int = 42) -> list[str]:
    """The rating files of a folder, or the ``max(1, int(n * fraction))`` first in seeded-hash order; no file is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", RATING_FILES).load(path).select("path")
    names = sorted(r["path"] for r in found.collect())  # one row per file
    if fraction >= 1.0 or not names:
        return names
    key = {n: md5(f"{seed}:{n.rsplit('/', 1)[-1]}".encode()).hexdigest() for n in names}
    return sorted(sorted(names, key=key.get)[:max(1, int(len(names) * fraction))])


def read_lines(spark: SparkSession, path, files: str | None = None) -> DataFrame:
    """Lines of text files with their order: (file, block, pos, value); ``files``: only names of that pattern."""
    reader = spark.read.option("pathGlobFilter", files) if files else spark.read
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def _check_mode(mode: str):
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def _header_id(text: Column, mode: str, what: str) -> Column:
    """Header text -> bigint; failfast raises on a non-integer header."""
    v = try_long(text)
    if mode == "drop":
        return v
    return F.when(v.isNotNull(), v).otherwise(
        F.raise_error(F.concat(F.lit(f"bad {what} header: "), text)).cast("bigint"))


def has_split_files(spark: SparkSession, path, files: str | None = None) -> bool:
    """Whether a file of the folder is longer than one split; only names and lengths are listed."""
    reader = spark.read.format("binaryFile")
    found = (reader.option("pathGlobFilter", files) if files else reader).load(path).agg(F.max("length")).first()[0]
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")
    return (found or 0) > spark.range(1).select(F.expr(_bytes(limit))).first()[0]


def _bytes(text: str) -> str:
    """A byte size such as 128m as an SQL number."""
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:].lower())
    return f"{text[:-1]} * {unit}" if unit else text


_CARRIED = "file string, block bigint, line string, section bigint, known boolean"


def _fill_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block, line, is_hdr, id in file order -> data lines with the latest header of their split (known: there was one)."""
    file, block, section, known = None, None, 0, False
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        files, blocks = b.column(0), b.column(1).to_numpy()
        start = np.zeros(n, bool)
        start[0] = (files[0].as_py(), int(blocks[0])) != (file, block)
        if n > 1:
            start[1:] = (blocks[1:] != blocks[:-1]) | pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        header = b.column(3).to_numpy(zero_copy_only=False)
        latest = np.maximum.accumulate(np.where(header | start, np.arange(n), -1))
        ids = b.column(4)  # null: a header without a good id
        told = ids.is_valid().to_numpy(zero_copy_only=False)
        values = pc.fill_null(ids, 0).to_numpy()
        before = latest < 0  # the previous batch's section goes on
        has = np.where(before, known, header[latest])
        good = np.where(before, section is not None, told[latest]) & has
        value = np.where(before, section or 0, values[latest])
        data = ~header
        yield pa.RecordBatch.from_arrays(
            [files.filter(pa.array(data)), pa.array(blocks[data]), b.column(2).filter(pa.array(data)),
             pa.array(value[data], pa.int64(), mask=~good[data]), pa.array(has[data])], names=["file", "block", "line", "section", "known"])
        file, block, known = files[n - 1].as_py(), int(blocks[n - 1]), bool(has[n - 1])
        section = int(value[n - 1]) if good[n - 1] else None


def carry_headers(lines: DataFrame, mode: str = "failfast", what: str = "section", ordered: bool = False, splits: bool = True) -> DataFrame:
    """The data lines (``line``, blank ones dropped) with ``section``, the id of the latest header, and ``known``.

    ``ordered``: every partition holds its splits' lines in file order, as a
    text scan does; else they are brought into it.  ``splits``: a file may be
    cut into several splits.  Lines before any header are not ``known``.  In
    drop mode a bad header yields a section whose id is null, so its lines
    are dropped rather than attached to the previous section.
    """
    _check_mode(mode)
    if not ordered:
        lines = lines.repartition("file", "block").sortWithinPartitions("file", "block", "pos")
    ln = lines.select("file", "block", "pos", clean_line("value").alias("line")).filter(F.length("line") > 0)
    ln = ln.withColumn("is_hdr", is_header("line"))
    ln = ln.withColumn("id", F.when(F.col("is_hdr"), _header_id(header_text("line"), mode, what)))
    filled = ln.select("file", "block", "line", "is_hdr", "id").mapInArrow(_fill_forward, _CARRIED)
    if not splits:
        return filled
    # one row per split: its last header; carry-in = last header of earlier splits
    last = ln.groupBy("file", "block").agg(F.max_by(F.struct("id"), F.when(F.col("is_hdr"), F.col("pos"))).alias("_last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = cut_lineage(last.select("file", "block", F.last("_last", ignorenulls=True).over(earlier).alias("_in")).filter("_in IS NOT NULL"))
    out = filled.join(F.broadcast(carry) if carry.count() <= BROADCAST_SPLITS else carry, ["file", "block"], "left")
    return out.select("file", "block", "line", F.when(F.col("known"), F.col("section")).otherwise(F.col("_in.id")).alias("section"),
                      (F.col("known") | F.col("_in").isNotNull()).alias("known"))


def parse_rating_sections(lines: DataFrame, mode: str = "failfast", ordered: bool = False, splits: bool = True) -> DataFrame:
    """``movie:`` sections of ``cust,rating,date`` lines.

    A data line needs >= 3 comma fields with integer customer and rating,
    else it is skipped; the date stays text (``date_text``) until
    :func:`to_ratings`.  Output: movie_id, customer_id, rating, date_text.
    """
    s = carry_headers(lines, mode, "movie", ordered, splits)
    parts = split_fields("line")
    rows = (s.filter(F.col("known") & F.col("section").isNotNull())
            .select(F.col("section").alias(MOVIE),
                    try_long(F.get(parts, 0)).alias(CUSTOMER),
                    try_int(F.get(parts, 1)).alias(RATING),
                    F.get(parts, 2).alias("date_text"),
                    F.size(parts).alias("_nf")))
    return (rows.filter((F.col("_nf") >= 3) & F.col(CUSTOMER).isNotNull() & F.col(RATING).isNotNull())
            .drop("_nf"))


def to_ratings(parsed: DataFrame, mode: str = "failfast") -> DataFrame:
    """Convert ``date_text`` to DATE: failfast raises on a bad date, drop
    mode drops the row (the reference fails at this step)."""
    _check_mode(mode)
    d = F.try_to_date(F.col("date_text"))
    if mode == "failfast":
        d = F.when(d.isNotNull(), d).otherwise(
            F.raise_error(F.concat(F.lit("bad date: "), F.col("date_text"))).cast("date"))
    out = parsed.withColumn(DATE, d).drop("date_text")
    if mode == "drop":
        out = out.filter(F.col(DATE).isNotNull())
    return out.select(CUSTOMER, MOVIE, RATING, DATE)


def parse_probe_sections(lines: DataFrame, mode: str = "failfast", ordered: bool = False, splits: bool = True) -> DataFrame:
    """S3: ``movie:`` sections of bare ``cust`` lines -> movie_id, customer_id."""
    s = carry_headers(lines, mode, "movie", ordered, splits)
    return (s.filter(F.col("known") & F.col("section").isNotNull())
            .select(F.col("section").alias(MOVIE), try_long("line").alias(CUSTOMER))
            .filter(F.col(CUSTOMER).isNotNull())
            .select(CUSTOMER, MOVIE))


def parse_movie_titles(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """``id,year,title`` with commas kept in the title (split limit 3).

    Two fields -> empty title; one field -> dropped; a year that is not all
    digits -> null; a non-integer id raises (failfast) or drops the line.
    """
    _check_mode(mode)
    v = clean_line("value")
    parts = split_fields(v, 3)
    t = lines.select(parts.alias("p")).filter(F.length(F.get("p", 0)) > 0)
    t = t.filter(F.size("p") >= 2)
    mid = _header_id(F.get("p", 0), mode, "title id")
    out = t.select(
        mid.alias(MOVIE),
        int_or_null(F.get("p", 1)).alias("year_of_release"),
        F.when(F.size("p") >= 3, clean_line(F.get("p", 2))).otherwise(F.lit("")).alias("title"),
    )
    if mode == "drop":
        out = out.filter(F.col(MOVIE).isNotNull())
    return out


def read_movie_titles(spark: SparkSession, path, mode: str = "failfast") -> DataFrame:
    return parse_movie_titles(read_lines(spark, path), mode)


def read_rating_sections(spark: SparkSession, path, mode: str = "failfast", sample_fraction: float = 1.0,
                         seed: int = 42) -> DataFrame:
    """S2 over a folder's ``mv_*.txt`` files; a fraction below 1 chooses files before any is read."""
    if sample_fraction < 1.0:
        path = rating_files(spark, path, sample_fraction, seed)
    lines = read_lines(spark, path, RATING_FILES)
    return to_ratings(parse_rating_sections(lines, mode, ordered=True, splits=has_split_files(spark, path, RATING_FILES)), mode)


def read_probe_sections(spark: SparkSession, path, mode: str = "failfast") -> DataFrame:
    return parse_probe_sections(read_lines(spark, path), mode, ordered=True, splits=has_split_files(spark, path))
