"""Contiguous byte-balanced shards from global prefix sums (list item 9).

Rows are range-partitioned and sorted by (id, text checksum, size); every
task numbers its rows and sums its bytes, the per-partition totals (one row
per partition) are prefix-summed and broadcast back, and each row's global
byte offset is cut at equal targets: a row belongs to the shard in which the
middle of its bytes lies, so shards are contiguous in id order and differ by
at most about one document.  With a seed the order is not the ids' but that
of a hash of (seed, id, text checksum, size, number among equal ones), so
shards are shuffled samples and the copies of a document lie apart, whatever
the cluster and the order of the input.  No task sees more than its own range; equal ids
are spread by the other sort keys.  The places are found from (id, text
checksum, size) alone; the texts are shuffled once, to their places.

Edge cases: null text counts 1 byte (like an empty one); null ids sort
first; repeated rows are separate rows; an empty table gives no rows; input
columns named like an output column are replaced.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep_others, quoted, written

OUT = ["size", "text_crc32", "shard", "slot", "__order", "__pid", "__idx", "__before"]


def row_sizes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """size (UTF-8 bytes plus 1) and text_crc32 beside the other columns."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    return docs.select(*[quoted(c) for c in keep_others(docs, OUT)],
                       (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def global_prefix(sized: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows in range partitions of ``keys`` with their place in the partition, and the partitions' offsets (one row each)."""
    by = [quoted(k) for k in keys]
    ranged = sized.repartitionByRange(*by).sortWithinPartitions(*by)
    schema = T.StructType([*ranged.schema.fields, *[T.StructField(c, T.LongType()) for c in ("__pid", "__idx", "__before")]])
    local = written(ranged.mapInArrow(_local_prefix, schema), "prefix")
    totals = local.groupBy("__pid").agg(F.sum("size").alias("__bytes"), F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__bytes0"),
                            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows0"),
                            F.sum("__bytes").over(Window.partitionBy()).alias("__total"))
    return local, offsets


def number_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` plus row: gapless global numbers from 0 in the order of ``keys``."""
    local, offsets = global_prefix(df.withColumn("size", F.lit(1).cast("long")), keys)
    return local.join(F.broadcast(offsets), "__pid").select(
        *[quoted(c) for c in df.columns], (F.col("__rows0") + F.col("__idx")).alias("row"))


def _local_prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    pid, rows, total = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        size = b.column(b.schema.get_field_index("size")).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = np.cumsum(size)
        extra = [pa.array(np.full(len(size), pid, np.int64)), pa.array(np.arange(rows, rows + len(size), dtype=np.int64)),
                 pa.array(total + upto - size)]
        yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=[*b.schema.names, "__pid", "__idx", "__before"])
        rows, total = rows + len(size), total + int(size.sum())


def shard_by_bytes(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int | None = None) -> DataFrame:
    """All columns of ``docs`` plus size, text_crc32, shard (0 .. n_shards-1) and slot (gapless from 0 in each shard).

    In id order, or shuffled by ``seed``.  ``docs`` is read twice, so it should be a table that reads the same again.
    """
    sized = row_sizes(docs, text_col)
    same = [quoted(id_col), F.col("text_crc32"), F.col("size")]
    narrow = sized.select(*same)
    if seed is None:
        return _with_places(sized, shard_sized(narrow, n_shards, id_col), same)
    number = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))  # one text's copies
    keys = [F.coalesce(c.cast("string"), F.lit("")) for c in same]
    order = F.md5(F.concat_ws(":", F.lit(f"shards{seed}"), *keys, number))
    return _with_places(sized, shard_sized(narrow.withColumn("__order", order), n_shards, id_col, ["__order"]), same)


def _with_places(sized: DataFrame, places: DataFrame, same: list[Column]) -> DataFrame:
    """Rows of ``sized`` with the shard and slot of the row of ``places`` that has the same key and number among equal keys.

    Both have each key equally often.  A join would shuffle the texts for the numbers and again for the keys with
    numbers; sorted together by key and number, every row follows its place, after one shuffle.
    """
    cols = keep_others(sized, ["shard", "slot", "__place", "__is_row", "__number"])
    place = F.struct(F.col("shard"), F.col("slot")).alias("__place")
    rows = sized.select(*[quoted(c) for c in cols]).withColumn("__is_row", F.lit(True))
    both = rows.unionByName(places.select(*same, place, F.lit(False).alias("__is_row")), allowMissingColumns=True).repartition(*same)
    number = F.row_number().over(Window.partitionBy(*same, "__is_row").orderBy(F.lit(0)))
    before = F.lag("__place").over(Window.partitionBy(*same).orderBy("__number", "__is_row"))
    return (both.withColumn("__number", number).withColumn("__place", before).filter("__is_row")
            .select(*[quoted(c) for c in cols], "__place.shard", "__place.slot"))


def shard_sized(sized: DataFrame, n_shards: int, id_col: str = "doc_id", before: list[str] | None = None) -> DataFrame:
    """The same for rows that carry size and text_crc32 (the text itself need not travel), in order of ``before`` and the id."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    local, offsets = global_prefix(sized, [*(before or []), id_col, "text_crc32", "size"])
    placed = (local.join(F.broadcast(offsets), "__pid")  # one row per partition
              .withColumn("__at", F.col("__bytes0") + F.col("__before"))
              .withColumn("__row", F.col("__rows0") + F.col("__idx"))
              .withColumn("shard", F.expr(f"cast(((2 * __at + size) * {int(n_shards)}) div (2 * __total) as int)")))
    starts = placed.groupBy("shard").agg(F.min("__row").alias("__first"))
    out = placed.join(F.broadcast(starts), "shard")  # n_shards rows
    return out.select(*[quoted(c) for c in keep_others(sized, OUT)], "size", "text_crc32", "shard",
                      (F.col("__row") - F.col("__first")).alias("slot"))
