"""Helpers of the training-data operators: written tables, packed text batches, hash folds."""

from __future__ import annotations

import uuid
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Text bytes a task holds as Python words at a time; one longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: upper-case ASCII to lower-case, all other bytes unchanged
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    The plan restarts from files that every executor sees, so a lost executor
    re-reads them instead of repeating the work before.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/llm-tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, m: int) -> Column:
    """crc32 of the id as text, modulo m (null id: the empty string)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(m)


def keep_others(df: DataFrame, taken: Sequence[str]) -> list[str]:
    """Columns of ``df`` whose names do not clash (in any case) with ``taken``."""
    t = {c.lower() for c in taken}
    return [c for c in df.columns if c.lower() not in t]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def blocks(batches: Iterator[pa.RecordBatch], text_index: int,
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most ``limit`` text bytes (one row at least), texts as bytes (null: empty)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(text_index).cast(pa.large_binary())
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < b.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield b.slice(at, to - at), [x if x is not None else b"" for x in col.slice(at, to - at).to_pylist()]
            at = to


def records(schema: pa.Schema, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, t.type) for a, t in zip(arrays, schema)],
                                      schema=schema)
