r"""Quality rules from cross-document line frequency (list item 1).

Every line is normalised (ASCII lower case, digits to 0, words joined by one
blank) and hashed (XXH64).  A line counts once per distinct text of a host,
so exact copies are one document: (host, line, text hash) are made distinct
and then counted, both with map-side sums.  Limits are
shares, so they mean the same at every size: a line is removed from a host's
documents that stands in more than ``HOST_PCT`` percent of them
(``MIN_DOCS`` at least), and from all documents if it stands in more than
``CORPUS_PCT`` percent of the corpus (``MIN_CORPUS_DOCS`` at least; a line of
``LONG_WORDS`` words, which seldom repeats by chance, ``LONG_PCT`` percent
and ``MIN_DOCS``).  ``max_docs`` sets a fixed limit per host in place of all
these.  A document that loses more than ``max_lost_pct`` percent of its words
is depleted and rejected.

Only hashes and word counts travel, never texts: one row per distinct line
of a document.  A line that stands in a third of all rows is one partial sum
per task in the count, and in the join back its few frequent rows meet the
documents' lines by broadcast or a skew-split join.

Base measures (per text): words are ``[^\x20\x09-\x0D]+``.

Edge cases: a null or blank text has no words and fails the base rule; null
hosts are one host; a repeated row counts once but is returned again; an
empty table gives no rows; clashing input columns are replaced.
"""

from __future__ import annotations

from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, blocks, keep_others, quoted, written

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MIN_DOCS = 10
HOST_PCT = 4
MIN_CORPUS_DOCS = 20
CORPUS_PCT = 1
LONG_WORDS = 50
LONG_PCT = 0.1
MAX_LOST_PCT = 50

_SYMBOLS = b"#*$%&|<>"
_NORMAL = bytes(48 if 48 <= b <= 57 else LOWER[b] for b in range(256))
OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_lines",
       "n_removed_words", "kept", "__row", "__copy", "__lines", "__host"]


def base_measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    blank = len(text) - sum(map(len, words))
    chars = len(text.decode("utf-8", "replace")) - blank
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    hit = np.zeros(len(words) + 3, np.int64)
    for i, w in enumerate(windows):
        if seen[w] > 1:
            hit[i] += 1
            hit[i + 3] -= 1
    return int((np.cumsum(hit) > 0).sum())


def line_words(text: bytes) -> dict[int, tuple[int, int]]:
    """Signed hash of each distinct normalised line with a word -> words in all its occurrences, words in one."""
    out: dict[int, tuple[int, int]] = {}
    for line in text.translate(_NORMAL).split(b"\n"):
        words = line.split()
        if words:
            h = xxhash.xxh64_intdigest(b" ".join(words))
            h -= (h >> 63) << 64
            out[h] = (out.get(h, (0, 0))[0] + len(words), len(words))
    return out


_LINE = ("hash", "words", "size")
_LINES = pa.list_(pa.struct([(c, pa.int64()) for c in _LINE]))
_LINES_T = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in _LINE]))


def measured(docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    """carry, __row (unique), the base measures, __copy (hash of the text) and __lines of every row."""
    src = docs.select(*[quoted(c) for c in carry], quoted(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 33
        for b, texts in blocks(batches, len(carry)):
            m = np.array([base_measures(t) for t in texts], np.int64).reshape(-1, 5)
            found = [line_words(t) for t in texts]
            offsets = np.cumsum([0, *map(len, found)])
            flat = pa.StructArray.from_arrays([pa.array([h for f in found for h in f], pa.int64()),
                                               *[pa.array([w[i] for f in found for w in f.values()], pa.int64()) for i in (0, 1)]], fields=list(_LINES.value_type))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(np.arange(row, row + len(texts))), *[pa.array(m[:, i]) for i in range(5)],
                 pa.array(np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat).cast(_LINES)],
                names=[*carry, "__row", *OUT[:5], "__copy", "__lines"])
            row += len(texts)

    schema = T.StructType([*src.schema.fields[:-1], *[T.StructField(c, T.LongType()) for c in ["__row", *OUT[:5], "__copy"]],
                           T.StructField("__lines", _LINES_T)])
    return src.mapInArrow(run, schema)


def frequent_lines(rows: DataFrame, lines: DataFrame, max_docs: int | None) -> DataFrame:
    """__host, hash of the lines to remove; rows: __host, __copy of every document, lines: also hash, size of its lines."""
    once = lines.groupBy("__host", "hash", "__copy").agg(F.max("size").alias("size"))
    counted = once.groupBy("__host", "hash").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    if max_docs is not None:
        return counted.filter(F.col("n") > max_docs).select("__host", "hash")
    counted = written(counted, "line_counts")
    hosts = written(rows.select("__host", "__copy").distinct().groupBy("__host").agg(F.count(F.lit(1)).alias("docs")), "hosts")
    total = hosts.agg(F.sum("docs")).first()[0] or 0
    large = hosts.filter(F.col("docs") * HOST_PCT > 100 * MIN_DOCS)  # others have the least limit
    per_host = (counted.filter(F.col("n") > MIN_DOCS).join(large, "__host", "left")
                .filter(100 * F.col("n") > HOST_PCT * F.coalesce("docs", F.lit(0))))
    limit = F.when(F.col("size") >= LONG_WORDS, max(MIN_DOCS, total * LONG_PCT / 100)).otherwise(max(MIN_CORPUS_DOCS, total * CORPUS_PCT / 100))
    everywhere = (counted.groupBy("hash").agg(F.sum("n").alias("n"), F.max("size").alias("size"))
                  .filter(F.col("n") > limit).select("hash"))
    pairs = per_host.select("__host", "hash").unionByName(counted.join(everywhere, "hash").select("__host", "hash"))
    return pairs.distinct()


def line_frequency_rules(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_docs: int | None = None,
                         max_lost_pct: int = MAX_LOST_PCT, carry: list[str] | None = None) -> DataFrame:
    """``carry`` (default: all but the text) plus the base measures, base_failed, removed lines and words, and kept."""
    carry = keep_others(docs, [*OUT, text_col]) if carry is None else carry
    read = list(dict.fromkeys([*carry, host_col]))
    rows = written(measured(docs, text_col, read), "measures")
    host = F.coalesce(F.concat(F.lit("="), quoted(host_col).cast("string")), F.lit(""))
    lines = rows.select("__row", "__copy", host.alias("__host"), F.explode("__lines").alias("l")).select("__row", "__host", "__copy", "l.*")
    frequent = frequent_lines(rows.select(host.alias("__host"), "__copy"), lines, max_docs)
    lost = lines.join(frequent, ["__host", "hash"]).groupBy("__row").agg(
        F.count(F.lit(1)).alias("n_removed_lines"), F.sum("words").alias("n_removed_words"))
    zero = F.lit(0).cast("long")
    out = (rows.drop("__lines", "__copy").join(lost, "__row", "left")
           .withColumn("n_removed_lines", F.coalesce("n_removed_lines", zero))
           .withColumn("n_removed_words", F.coalesce("n_removed_words", zero))
           .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                       | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
           .withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_removed_words") <= max_lost_pct * F.col("n_words"))))
    return out.select(*[quoted(c) for c in carry], *OUT[:5], "base_failed", "n_removed_lines", "n_removed_words", "kept")


def cleaned_texts(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_docs: int | None = None,
                  max_lost_pct: int = MAX_LOST_PCT) -> DataFrame:
    """``docs`` of kept rows with the frequent lines taken out of the text.

    The frequent lines (host, hash) are collected into each host's document by
    a join on the line, then the text is filtered line by line.
    """
    cols = keep_others(docs, OUT)
    src = docs.select(*[quoted(c) for c in cols], F.coalesce(F.concat(F.lit("="), quoted(host_col).cast("string")), F.lit("")).alias("__host"))
    rows = written(measured(src, text_col, [*cols, "__host"]), "texts")
    lines = rows.select("__row", "__copy", "__host", F.explode("__lines").alias("l")).select("__row", "__host", "__copy", "l.*")
    frequent = frequent_lines(rows, lines, max_docs)
    lost = lines.join(frequent, ["__host", "hash"]).groupBy("__row").agg(
        F.sum("words").alias("__lost"), F.collect_set("hash").alias("__gone"))  # at most the document's own lines
    kept = (rows.join(lost, "__row", "left")
            .filter((F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PCT * F.col("n_words"))
                    & (100 * F.coalesce("__lost", F.lit(0)) <= max_lost_pct * F.col("n_words"))))
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in blocks(batches, at):
            out = []
            for text, gone in zip(texts, b.column(len(cols)).to_pylist()):
                gone = set(gone or ())
                out.append(b"\n".join(x for x in text.split(b"\n") if not gone or not (gone & line_words(x).keys())).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(out, pa.string()), *b.columns[at + 1:len(cols)]], names=cols)

    return kept.select(*[quoted(c) for c in cols], "__gone").mapInArrow(run, docs.select(*[quoted(c) for c in cols]).schema)
