"""SimHash near-duplicates by Burkhard-Keller trees over fingerprint shards (list item 2).

A fingerprint bit is set if it is set in more than half of the XXH64 hashes
(seed 42) of the text's word shingles.  Fingerprints link at ``radius`` or
fewer differing bits; components of links are the near-duplicate groups.

Copies collapse first: one row per distinct fingerprint with its least id
(pre-aggregated before the shuffle).  Fingerprints that differ in at most r
of 64 bits agree in one of r+1 bit blocks, so each is sent to r+1 shards
keyed by (block, its bits), and every shard holds its own tree: children are
keyed by their integer Hamming distance to the parent and a query follows
only edges within the radius of its own distance.  Trees stay in the task of
their shard; broadcasting the trees of all shards would send every
fingerprint everywhere.  A shard of more than ``SHARD_ROWS`` is split again
by the same argument over the remaining bits (eight-bit blocks, of which all
but r agree), which bounds a tree by the free bits, 2**24 at radius 3,
whatever the number of documents; nothing is left out.  A shard emits a
spanning forest of its links, not its pairs.  Components come from repeated
contraction (hook to the least neighbour, follow the hooks to their root by
doubling, relabel the links, drop loops),
each round a written table.

Edge cases: null or blank text has fingerprint 0 and links like any other;
fewer words than a shingle: the whole sequence is one; null ids count as
larger than any id (a group of null ids only has a null component); repeated
rows share their fingerprint; an empty table gives no rows; clashing input
columns are replaced.
"""

from __future__ import annotations

import itertools
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, blocks, keep_others, quoted, written

SEED = 42
#: rows of a first-level shard from which it is split again
SHARD_ROWS = 4096
#: rows up to which a tree is grown one by one; above, whole levels at a time
SMALL_TREE = 48
_PART = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < width:
        return xxhash.xxh64_intdigest(joined, SEED)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    first, last = ends - lens, ends[width - 1:]
    digest, n, ones = xxhash.xxh64_intdigest, len(last), np.zeros(64, np.int64)
    for at in range(0, n, _PART):
        h = [digest(joined[a:b], SEED) for a, b in zip(first[at:at + _PART].tolist(), last[at:at + _PART].tolist())]
        bits = np.unpackbits(np.array(h, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, width: int = 3, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus simhash (the 64 bits as a signed long)."""
    cols = keep_others(docs, ["simhash"])
    at = cols.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in blocks(batches, at):
            h = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(h)], names=[*b.schema.names, "simhash"])

    src = docs.select(*[quoted(c) for c in cols])
    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("simhash", T.LongType())]))


class _Forest:
    """Union-find that remembers the links which joined two sets."""

    def __init__(self, n: int):
        self.up, self.links = list(range(n)), []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.up[ra] = rb
            self.links.append((a, b))


def _grow(values: list[int], radius: int, forest: _Forest) -> None:
    """Insert one by one; before each insertion search the tree so far."""
    children: list[dict[int, int]] = [{}]
    for i in range(1, len(values)):
        v, stack = values[i], [0]
        while stack:
            p = stack.pop()
            d = (values[p] ^ v).bit_count()
            if d <= radius:
                forest.join(p, i)
            stack += [c for e, c in children[p].items() if -radius <= e - d <= radius]
        p = 0
        while (e := (values[p] ^ v).bit_count()) in children[p]:
            p = children[p][e]
        children[p][e] = i
        children.append({})


def _levels(values: np.ndarray, radius: int, forest: _Forest) -> None:
    """The same tree a level at a time: (members, queries) pairs share one parent's distances."""
    every = np.arange(len(values))
    todo = [(every, every)]
    while todo:
        members, queries = todo.pop()
        if len(members) <= SMALL_TREE:
            # a bucket of few members: every query against each of them
            for k in members.tolist():
                for q in queries[np.bitwise_count(values[queries] ^ values[k]) <= radius].tolist():
                    forest.join(k, q)
            continue
        parent, rest = members[0], members[1:]
        to_query = np.bitwise_count(values[queries] ^ values[parent]).astype(np.int16)
        for q in queries[to_query <= radius].tolist():
            forest.join(int(parent), q)
        to_member = np.bitwise_count(values[rest] ^ values[parent]).astype(np.int16)
        for e in np.unique(to_member).tolist():
            child = rest[to_member == e]
            near = queries[np.abs(to_query - e) <= radius]
            if len(near) and not _one_set(forest, child, near):
                todo.append((child, near))


def _one_set(forest: _Forest, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all are joined already, so that a search could add no link."""
    r = forest.root(int(a[0]))
    return all(forest.root(x) == r for x in itertools.chain(a.tolist(), b.tolist()))


def tree_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Positions (a, b) of a spanning forest of the links between distinct uint64 values."""
    forest = _Forest(len(values))
    if len(values) <= SMALL_TREE:
        _grow(values.tolist(), radius, forest)
    else:
        _levels(values, radius, forest)
    return forest.links


def _link_shards(radius: int):
    """Rows (shard key ..., simhash) sorted by the key -> links (a, b)."""
    def links(values: np.ndarray):
        v = values.view(np.uint64)
        return [(int(values[a]), int(values[b])) for a, b in tree_links(v, radius)]

    def batch(found):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                                          names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, parts, found = None, [], []
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(b.num_columns - 1)], axis=1)
            h = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(h)]
            for lo, hi in itertools.pairwise(cuts):
                key = tuple(keys[lo].tolist())
                if key != open_key:
                    if sum(map(len, parts)) > 1:
                        found += links(np.concatenate(parts))
                    open_key, parts = key, []
                parts.append(h[lo:hi])
            if len(found) >= _PART:
                yield batch(found)
                found = []
        if sum(map(len, parts)) > 1:
            found += links(np.concatenate(parts))
        yield batch(found)

    return run


def _block(i: int, n: int) -> Column:
    """Bits of the i-th of n equal blocks of simhash."""
    width = 64 // n
    return F.shiftrightunsigned("simhash", i * width).bitwiseAND(F.lit((1 << width) - 1))


def fingerprint_links(prints: DataFrame, radius: int, shard_rows: int | None = None) -> DataFrame:
    """Links (a, b) that span every component of ``prints`` (distinct simhash) at ``radius`` or fewer bits."""
    if not 0 <= radius <= 3:
        raise ValueError("radius must be 0 to 3")
    limit = SHARD_ROWS if shard_rows is None else shard_rows
    n = 4  # 16-bit blocks: with at most 3 differing bits one of the four agrees
    keyed = prints.select("simhash", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), _block(i, n).alias("bits")) for i in range(n)])).alias("k"))
    keyed = keyed.select("k.block", "k.bits", "simhash")
    sizes = written(keyed.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shards")
    run = _link_shards(radius)
    small = keyed.join(sizes.filter(F.col("n") <= limit).select("block", "bits"), ["block", "bits"], "left_semi") \
        if not sizes.filter(F.col("n") > limit).isEmpty() else keyed
    links = (small.select("block", "bits", "simhash").repartition("block", "bits").sortWithinPartitions("block", "bits")
             .mapInArrow(run, "a bigint, b bigint"))
    big = sizes.filter(F.col("n") > limit)
    if not big.isEmpty():
        # the shard's 16 bits are two agreeing 8-bit blocks; of the other six at least three agree
        again = keyed.join(big.select("block", "bits"), ["block", "bits"], "left_semi")
        octets = F.array(*[_block(i, 8) for i in range(8)])
        tables = F.array(*[F.array(*[F.lit(x) for x in c]) for c in itertools.combinations(range(6), 3)])
        spread = again.withColumn("__o", octets).withColumn("t", F.explode(tables)).select(
            "block", "bits", F.expr("t[0] * 64 + t[1] * 8 + t[2]").cast("bigint").alias("three"),
            F.expr("aggregate(t, 0L, (s, i) -> s * 256 + __o[if(i < 2 * block, i, i + 2)])").alias("more"), "simhash")
        # a sub-shard has 24 free bits: 2**24 rows at most
        links = links.unionByName(spread.repartition("block", "bits", "three", "more")
                                  .sortWithinPartitions("block", "bits", "three", "more").mapInArrow(run, "a bigint, b bigint"))
    return links.distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (id, rep): one representative for the vertices of each component."""
    links = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("id"), F.col("b").alias("o")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("o")))
        rep = written(both.groupBy("id").agg(F.min("o").alias("o")).select("id", F.least("id", "o").alias("rep")), "hook")
        while True:  # hooks point to smaller ids: double the steps until all point to their tree's root
            up = rep.select(F.col("id").alias("rep"), F.col("rep").alias("__up"))
            rep = written(rep.join(up, "rep").select("id", F.col("__up").alias("rep"), (F.col("rep") != F.col("__up")).alias("moved")), "rep")
            if rep.filter("moved").isEmpty():
                break
            rep = rep.drop("moved")
        rep = rep.drop("moved")
        if labels is None:
            labels = rep
        else:
            new = rep.select(F.col("id").alias("rep"), F.col("rep").alias("__new"))
            labels = written(labels.join(new, "rep", "left").select("id", F.coalesce("__new", "rep").alias("rep")), "labels")
        ra = rep.select(F.col("id").alias("a"), F.col("rep").alias("ra"))
        rb = rep.select(F.col("id").alias("b"), F.col("rep").alias("rb"))
        links = written(links.join(ra, "a").join(rb, "b").filter("ra <> rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    return labels if labels is not None else links.select(F.col("a").alias("id"), F.col("b").alias("rep"))


def near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus simhash (long), component_id (least id reachable over links) and is_first."""
    return group_rows(with_fingerprints(docs, width, text_col), radius, id_col)


def group_rows(rows: DataFrame, radius: int = 3, id_col: str = "doc_id") -> DataFrame:
    """Rows with simhash -> the same plus component_id and is_first (the row or repeated rows that stand for the group)."""
    rows = written(rows, "prints")
    first = F.struct(quoted(id_col).isNull().alias("no_id"), quoted(id_col).alias("id"), F.col("simhash").alias("print"))
    prints = written(rows.groupBy("simhash").agg(F.min(first).alias("first")), "distinct")
    reps = components(fingerprint_links(prints.select("simhash"), radius)).withColumnRenamed("id", "simhash")
    groups = prints.join(reps, "simhash", "left").select("simhash", "first", F.coalesce("rep", "simhash").alias("rep"))
    least = groups.groupBy("rep").agg(F.min("first").alias("first"))
    group_of = groups.select("simhash", "rep").join(least, "rep").select("simhash", F.col("first.id").alias("component_id"), "first")
    kept = keep_others(rows, ["component_id", "is_first", "first"])
    # one row per fingerprint on the right; a hot fingerprint's documents are split by the skew join
    is_first = quoted(id_col).eqNullSafe(F.col("component_id")) & (F.col("simhash") == F.col("first.print"))
    return rows.select(*[quoted(c) for c in kept]).join(group_of, "simhash").select(
        *[quoted(c) for c in kept], "component_id", is_first.alias("is_first"))


def one_of_each(groups: DataFrame) -> DataFrame:
    """The first row of each group of :func:`near_duplicates` (least id, then least fingerprint; one of repeated rows)."""
    return groups.filter("is_first").dropDuplicates(["simhash"])
