r"""Language-model scores by context-tree weighting (list item 7).

A byte is eight binary decisions (a path in the byte's bit tree).  For each
of the 255 decision nodes a context tree over the last ``DEPTH`` bytes mixes
Krichevsky-Trofimov estimators of all depths: a context's weighted evidence is
half its own estimator's and half the product of its longer contexts'.  All
counts come from the training texts; a text is then coded with the mixture
predictions of the trained trees, bit by bit, so -log2 of the score is its
code length (``bits_per_byte``).

Counting: tasks count (context, next byte) of all texts in numpy and merge
equal ones, a shuffled sum joins the tasks.  Every context of the training
texts is in the trees, so the model grows with the corpus; it is a written
table and never one object.  What the scored texts hold besides stands in the
table with count zero: it adds nothing to any evidence and gets its mixture
prediction like the others, so no scored byte is without one.

Trees: grams are grouped by their ``SPLIT`` newest context bytes and sorted,
and tasks fold whole groups from the longest contexts upward.  Shorter
contexts are summed by a groupBy, and the driver mixes those of two bytes and
less (256 * 256 contexts at most, whatever the corpus).  A second pass over
the groups goes down again and writes gram -> log10 probability.

Scoring: grams seen most often (at most ``HEAD_GRAMS``, by count threshold)
are looked up in a broadcast hash table, which is a cache and no bound on the
model; the others travel as (row, gram, n) and meet the written table in a
join.  No frequent gram is among them, so that join has no hot key.

Base model: add-half unigram of words ``[^\x20\x09-\x0D]+`` and one end per
text over the training vocabulary.  Words counted most often (at most
``HEAD_WORDS``, by count threshold) are looked up in a broadcast table of
64-bit hashes; the others travel as (row, word, n) and meet the vocabulary in
a join.  No frequent word is among them, so that join has no hot key.

Edge cases: a null text is empty and scores its end alone; without training
rows the base score is 0 per token and every bit has probability 1/2;
repeated rows score alike; an empty table gives no rows; clashing input
columns are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, blocks, keep_others, quoted, written

DEPTH = 5
HEAD_WORDS = 500_000
HEAD_GRAMS = 500_000
SPLIT = 3
_WORD_SEED = 42  # of Spark's xxhash64
_MERGE_ROWS = 4 << 20
_GROUP_ROWS = 1 << 18
_NODES = 8  # decision nodes of a bit worked on at a time
OUT = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]


# ---------------------------------------------------------------- the word base

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = {}

    def out():
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                         names=["word", "n"])
        counts.clear()

    for _, texts in blocks(batches, 0):
        words, n = unique_words(texts)
        for w, k in zip(words, n.tolist()):
            counts[w] = counts.get(w, 0) + k
        if len(counts) > 400_000:
            yield from out()
    yield from out()


def unique_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    d = pa.array(b"\n".join(texts).translate(LOWER).split(), pa.binary()).value_counts()
    return d.field(0).to_pylist(), d.field(1).to_numpy()


@dataclass
class Head:
    """Hashes (sorted) and counts of the most frequent words, and the totals of the vocabulary."""
    hashes: np.ndarray
    counts: np.ndarray
    least: int
    tokens: int
    types: int
    texts: int

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Counts, -1 for words that are not held."""
        h = np.array([xxhash.xxh64_intdigest(w, _WORD_SEED) for w in words], np.uint64).view(np.int64)
        if not len(self.hashes):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.counts[at], -1)


def threshold(histogram: list[tuple[int, int]], most: int) -> int:
    """The least count such that at most ``most`` things are counted so often; histogram: (count, things)."""
    held, least = 0, None
    for n, things in sorted(histogram, reverse=True):
        if held + things > most:
            break
        held, least = held + things, n
    return least if least is not None else (max((n for n, _ in histogram), default=0) + 1)


def _histogram(df: DataFrame) -> list[tuple[int, int]]:
    """(n, rows): one row per distinct count, about the square root of all counted things at most."""
    return [tuple(r) for r in df.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).toArrow().to_pandas().itertuples(index=False)]


def vocabulary(texts: DataFrame) -> tuple[DataFrame, Head]:
    """(word, n) of the texts, as a written table, and its head."""
    words = written(texts.mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    total = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    n_texts = texts.count()
    least = threshold(_histogram(words), HEAD_WORDS)
    head = words.filter(F.col("n") >= least).select(F.xxhash64("word").alias("h"), "n").toArrow()
    h, n = head.column("h").to_numpy(), head.column("n").to_numpy()
    order = np.argsort(h)
    return words, Head(h[order], n[order], least, (total[0] or 0) + n_texts, total[1] + (n_texts > 0), n_texts)


# ---------------------------------------------------------------- the context trees

def stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with DEPTH zeros before and after every text, and the places to predict: each byte and one zero per text."""
    gap = b"\0" * DEPTH
    a = np.frombuffer(gap + b"".join(t.translate(LOWER) + gap for t in texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    start = DEPTH + np.cumsum(sizes + DEPTH) - sizes - DEPTH
    at = np.arange((sizes + 1).sum()) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1) + np.repeat(start, sizes + 1)
    return a, at


def _keys(a: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Grams as numbers: the newest context byte highest, then older ones, the next byte lowest."""
    key = np.zeros(len(at), np.int64)
    for d in [*range(1, DEPTH + 1), 0]:
        key = key << 8 | a[at - d]
    return key


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (text, train): distinct grams with one more bit for training texts, and their counts."""
    parts, held = [], 0

    def out():
        key, n = _merge(parts)
        for at in range(0, len(key), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(key[at:at + (1 << 17)]), pa.array(n[at:at + (1 << 17)].astype(np.int64))], names=["gram", "n"])

    for b, texts in blocks(batches, 0):
        train = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        key = _keys(*stream(texts)) | np.repeat(train << 8 * (DEPTH + 1), [len(t) + 1 for t in texts])
        parts.append(np.unique(key, return_counts=True))
        held += len(parts[-1][0])
        if held > _MERGE_ROWS:
            parts = [_merge(parts)]
            held = len(parts[0][0])
            if held > _MERGE_ROWS // 2:
                yield from out()
                parts, held = [], 0
    if parts:
        yield from out()


@dataclass
class Level:
    """Contexts of one length with a decision node each, as context << 8 | node (1 .. 255), in order.

    ``up`` is the place of each in the next shorter level, None at the last one.
    """
    code: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    weighted: np.ndarray
    stop: np.ndarray
    p1: np.ndarray
    up: np.ndarray | None = None


def _level(code: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None = None) -> Level:
    """``below``: summed evidence of the longer contexts, None for the longest ones."""
    own = _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - math.log(math.pi)
    weighted = own if below is None else np.logaddexp(own, below) - math.log(2)
    stop = np.ones(len(own)) if below is None else np.exp(own - math.log(2) - weighted)
    return Level(code, n0, n1, weighted, stop, (n1 + 0.5) / (n0 + n1 + 1))


def _climb(level: Level, steps: int) -> list[Level]:
    """The level and the next ``steps`` shorter ones."""
    levels = [level]
    for _ in range(steps):
        last = levels[-1]
        code, last.up = np.unique(last.code >> 16 << 8 | last.code & 255, return_inverse=True)
        n0, n1, below = (np.bincount(last.up, x, len(code)) for x in (last.n0, last.n1, last.weighted))
        levels.append(_level(code, n0, n1, below))
    return levels


def _descend(levels: list[Level], mixed: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixture probabilities of bit 1 at the first level and the weight that is left, from those above the last level."""
    for level in reversed(levels):
        if level.up is not None:
            mixed, left = mixed[level.up], left[level.up]
        mixed, left = mixed + left * level.stop * level.p1, left * (1 - level.stop)
    return mixed, left


def _bit(key: np.ndarray, n: np.ndarray, k: int) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Levels DEPTH .. SPLIT for bit k of the next byte of sorted grams; each gram's place in the first; its bit."""
    code = key >> 8 << 8 | 1 << k | (key & 255) >> (8 - k)
    first = np.concatenate([[True], code[1:] != code[:-1]])
    at = np.flatnonzero(first)
    bit = key >> (7 - k) & 1
    n1 = np.add.reduceat(n * bit, at)
    return _climb(_level(code[at], np.add.reduceat(n, at) - n1, n1), DEPTH - SPLIT), np.cumsum(first) - 1, bit


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of sorted (gram, ...) rows, cut between groups of the SPLIT newest bytes only."""
    low, parts, held, wait = 8 * (DEPTH + 1 - SPLIT), [], 0, _GROUP_ROWS
    for b in batches:
        parts.append([c.to_numpy() for c in b.columns])
        held += b.num_rows
        if held >= wait:
            cols = [np.concatenate(c) for c in zip(*parts)]
            cut = int(np.searchsorted(cols[0], cols[0][-1] >> low << low))
            if cut:
                yield tuple(c[:cut] for c in cols)
            parts, held = [[c[cut:] for c in cols]], held - cut
            wait = max(_GROUP_ROWS, 2 * held)
    if held:
        yield tuple(np.concatenate(c) for c in zip(*parts))


def _upward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Evidence of the contexts of SPLIT bytes."""
    for key, seen, _ in _whole_groups(batches):
        for k in range(8):
            top = _bit(key, seen.astype(np.float64), k)[0][-1]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (top.code, top.n0, top.n1, top.weighted)], names=["code", "n0", "n1", "weighted"])


def _downward(model):
    """gram, n, and score: log10 of the next byte's mixture probability."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, mixed, left = model.value
        for key, seen, n in _whole_groups(batches):
            score = np.zeros(len(key))
            for k in range(8):
                levels, place, bit = _bit(key, seen.astype(np.float64), k)
                above = np.searchsorted(code, levels[-1].code >> 16 << 8 | levels[-1].code & 255)
                p1 = _descend(levels, mixed[above], left[above])[0][place]
                score += np.log10(np.where(bit == 1, p1, 1 - p1))
            for at in range(0, len(key), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + (1 << 17)]) for x in (key, n, score)], names=["gram", "n", "score"])
    return run


def train_trees(texts: DataFrame) -> DataFrame:
    """gram, n (in all texts), score of every gram of (text, train): a written table."""
    counted = texts.mapInArrow(_count_grams, "gram bigint, n bigint")
    bits = 8 * (DEPTH + 1)
    grams = written(counted.groupBy(F.col("gram").bitwiseAND(F.lit((1 << bits) - 1)).alias("gram")).agg(
        F.sum(F.shiftright("gram", bits) * F.col("n")).alias("seen"), F.sum("n").alias("n")), "grams")
    grouped = grams.repartition(F.shiftright("gram", bits - 8 * SPLIT)).sortWithinPartitions("gram")
    shorter = F.shiftleft(F.shiftright("code", 16), 8).bitwiseOR(F.col("code").bitwiseAND(F.lit(255)))
    # contexts of SPLIT - 1 bytes: 256 ** 2 with 255 nodes at most, some thousands in texts
    second = (grouped.mapInArrow(_upward, "code bigint, n0 double, n1 double, weighted double").groupBy(shorter.alias("code"))
              .agg(F.sum("n0"), F.sum("n1"), F.sum("weighted")).toArrow())
    code, n0, n1, below = (second.column(i).to_numpy() for i in range(4))
    order = np.argsort(code)
    levels = _climb(_level(code[order], n0[order], n1[order], below[order]), SPLIT - 1)
    root = len(levels[-1].code)
    model = texts.sparkSession.sparkContext.broadcast((code[order], *_descend(levels, np.zeros(root), np.ones(root))))
    return written(grouped.mapInArrow(_downward(model), "gram bigint, n bigint, score double"), "predictions")


class GramTable:
    """Open hash table of grams: gram -> score."""

    def __init__(self, key: np.ndarray, score: np.ndarray):
        bits = max(4, (2 * len(key)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        at, todo = np.full(1 << bits, -1, np.int64), np.arange(len(key))
        slot = self._slot(key)
        while len(todo):
            free = at[slot] < 0
            at[slot[free]] = todo[free]
            off = at[slot] != todo
            todo, slot = todo[off], (slot[off] + 1) & self.mask
        self.key = np.where(at < 0, -1, key[at] if len(key) else -1)
        self.score = np.where(at < 0, 0.0, score[at] if len(key) else 0.0)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def lookup(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores (0 where not held), and which are held."""
        slot = self._slot(key)
        there = self.key[slot]
        go = np.flatnonzero((there != key) & (there >= 0))
        while len(go):
            slot[go] = (slot[go] + 1) & self.mask
            there = self.key[slot[go]]
            go = go[(there != key[go]) & (there >= 0)]
        held = self.key[slot] == key
        return np.where(held, self.score[slot], 0.0), held


# the same for few texts and given contexts, as one object: the tests' second form

def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (context, next byte) numbers: the oldest byte highest, the next byte lowest; and their counts."""
    a, at = stream(texts)
    key = np.zeros(len(at), np.int64)
    for d in range(DEPTH, -1, -1):
        key = key << 8 | a[at - d]
    return np.unique(key, return_counts=True)


@dataclass
class Trees:
    """Flat form: walk[node, older byte] -> node (a leaf stays), code[node, byte] -> log10 probability."""
    walk: np.ndarray
    code: np.ndarray


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive multiples of one half: a table below 64, Stirling's series above."""
    small = np.array([0.0, *[math.lgamma(k / 2) for k in range(1, 129)]])
    big = np.maximum(x, 64.0)
    series = (big - 0.5) * np.log(big) - big + 0.9189385332046727 + 1 / (12 * big) - 1 / (360 * big ** 3)
    return np.where(x < 64, small[np.minimum(2 * x, 128).astype(np.int64)], series)


def parents(contexts: list[tuple[int, int]]) -> np.ndarray:
    """Row of each context without its oldest byte (of the first, the empty one, itself)."""
    number = {c: i for i, c in enumerate(contexts)}
    return np.array([0] + [number[d - 1, c & ((1 << 8 * (d - 1)) - 1)] for d, c in contexts[1:]], np.int64)


def room(contexts: list[tuple[int, int]]) -> np.ndarray:
    """Zeros for the counts of next bytes: a row per context, then one per inner node (for :func:`weighted_trees`)."""
    return np.zeros((len(contexts) + len(np.unique(parents(contexts)[1:])), 256))


def weighted_trees(contexts: list[tuple[int, int]], counts: np.ndarray) -> Trees:
    """From (depth, context) in depth order, closed under dropping the oldest byte, with counts of next bytes.

    The first context is (0, 0), the empty one; ``counts`` is a filled :func:`room`, whose further rows are set here.
    """
    parent = parents(contexts)
    inner = np.unique(parent[1:])
    rest = counts[len(contexts):]
    rest[:] = counts[inner]  # what the held longer contexts of an inner node don't see
    for i in range(1, len(contexts)):
        rest[np.searchsorted(inner, parent[i])] -= counts[i]
    parent = np.concatenate([parent, inner])
    depth = np.array([d for d, _ in contexts] + [contexts[i][0] + 1 for i in inner.tolist()], np.int64)
    n, is_inner = len(parent), np.zeros(len(parent), bool)
    is_inner[inner] = True

    small = np.uint16 if n <= 1 << 16 else np.int32
    walk = np.repeat(np.arange(n).astype(small)[:, None], 256, axis=1)
    walk[inner] = np.arange(len(contexts), n).astype(small)[:, None]
    for i, (d, c) in enumerate(contexts[1:], 1):
        walk[parent[i], c >> 8 * (d - 1)] = i

    code = np.zeros((n, 256), np.float32)
    by_depth = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
    for k in range(8):
        width = 1 << (7 - k)
        for lo in range(0, 1 << k, _NODES):  # decision nodes lo .. of bit k
            span = slice(2 * width * lo, 2 * width * min(lo + _NODES, 1 << k))
            split = counts[:, span].reshape(n, -1, 2, width).sum(axis=3)
            n0, n1 = split[:, :, 0], split[:, :, 1]
            own = _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - math.log(math.pi)
            p1 = (n1 + 0.5) / (n0 + n1 + 1)
            weighted, below, stop = own.copy(), np.zeros_like(own), np.ones_like(own)
            for rows in reversed(by_depth):
                up = rows[is_inner[rows]]
                weighted[up] = np.logaddexp(own[up], below[up]) - math.log(2)
                stop[up] = np.exp(own[up] - math.log(2) - weighted[up])
                if rows[0]:
                    np.add.at(below, parent[rows], weighted[rows])
            mixed, left = stop * p1, 1 - stop  # at the root; below it what is left is shared out
            for rows in by_depth[1:]:
                mixed[rows] = mixed[parent[rows]] + left[parent[rows]] * stop[rows] * p1[rows]
                left[rows] = left[parent[rows]] * (1 - stop[rows])
            mixed = np.where(is_inner[:, None], 0.5, mixed)  # no walk ends at an inner node
            bit = np.log10(np.stack([1 - mixed, mixed], axis=2)).astype(np.float32)
            code[:, span] += np.repeat(bit.reshape(n, -1), width, axis=1)
    return Trees(walk, code)


# ---------------------------------------------------------------- scores

def score_texts(docs: DataFrame, train: Column, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, plus n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``train`` tells the rows both models learn from.
    """
    text = F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text")
    words, head = vocabulary(docs.filter(train).select(text))
    grams = train_trees(docs.select(text, F.coalesce(train, F.lit(False)).alias("train")))
    least = threshold(_histogram(grams), HEAD_GRAMS)
    often = grams.filter(F.col("n") >= least).select("gram", "score").toArrow()
    table = GramTable(often.column("gram").to_numpy(), often.column("score").to_numpy())
    sc = docs.sparkSession.sparkContext
    models = sc.broadcast((head, table))  # HEAD_WORDS and HEAD_GRAMS rows at most
    cols = keep_others(docs, [*OUT, text_col, "__row", "__rest", "__grams"])
    src = docs.select(*[quoted(c) for c in cols], quoted(text_col).cast("string").alias("__text"))
    rest_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
    gram_type = pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())]))

    def per_text(text: np.ndarray, of: np.ndarray, kinds: int, size: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Distinct (text, thing) pairs: the things, how often, and where each text's list begins."""
        pairs, times = np.unique(text * max(1, kinds) + of, return_counts=True)
        return pairs % max(1, kinds), times, pa.array(np.concatenate([[0], np.cumsum(np.bincount(pairs // max(1, kinds), minlength=size))]), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 33
        head, table = models.value
        for b, block in blocks(batches, len(cols)):
            size = len(block)
            tokens = [t.translate(LOWER).split() for t in block]
            flat = pa.array([w for t in tokens for w in t], pa.binary()).dictionary_encode()
            distinct, at = flat.dictionary.to_pylist(), flat.indices.to_numpy(zero_copy_only=False)
            count = head.lookup(distinct)
            n_tokens = np.array([len(t) + 1 for t in tokens], np.int64)
            text = np.repeat(np.arange(size), n_tokens - 1)
            held = count[at] >= 0 if len(at) else np.zeros(0, bool)
            logs = np.log10(np.maximum(count, 0) + 0.5)
            known = np.bincount(text[held], minlength=size) + (head.texts > 0)
            sums = np.bincount(text[held], weights=logs[at[held]], minlength=size) + math.log10(head.texts + 0.5)
            # the words that are not held: distinct per text
            which, times, offsets = per_text(text[~held], at[~held], len(distinct), size)
            rest = pa.StructArray.from_arrays([pa.array([distinct[i] for i in which.tolist()], pa.binary()),
                                               pa.array(times.astype(np.int64))], fields=list(rest_type.value_type))
            keys = _keys(*stream(block))
            p, there = table.lookup(keys)
            sizes = np.array([len(t) for t in block], np.int64)
            score = np.add.reduceat(p, np.cumsum([0, *(sizes[:-1] + 1)]))
            # the same for the grams
            rare, of = np.unique(keys[~there], return_inverse=True)
            which, times, gram_offsets = per_text(np.repeat(np.arange(size), sizes + 1)[~there], of, len(rare), size)
            more = pa.StructArray.from_arrays([pa.array(rare[which]), pa.array(times.astype(np.int64))], fields=list(gram_type.value_type))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(np.arange(row, row + size)), pa.array(n_tokens), pa.array(known.astype(np.int64)),
                 pa.array(sums), pa.array(score), pa.array(sizes),
                 pa.ListArray.from_arrays(offsets, rest).cast(rest_type), pa.ListArray.from_arrays(gram_offsets, more).cast(gram_type)],
                names=[*cols, "__row", "n_tokens", "__known", "__sum", "score", "__bytes", "__rest", "__grams"])
            row += size

    rows = written(src.mapInArrow(run, T.StructType([
        *src.schema.fields[:-1], T.StructField("__row", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("__known", T.LongType()), T.StructField("__sum", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("__bytes", T.LongType()),
        T.StructField("__rest", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]))),
        T.StructField("__grams", T.ArrayType(T.StructType([T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])))])), "scored")
    rare = words.filter(F.col("n") < head.least).withColumnRenamed("n", "c")
    rest = (rows.select("__row", F.explode("__rest").alias("r")).select("__row", "r.word", "r.n").join(rare, "word", "left")
            .withColumn("c", F.coalesce("c", F.lit(0)))
            .groupBy("__row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("__more"),
                                  F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("__also")))
    deep = (rows.select("__row", F.explode("__grams").alias("r")).select("__row", "r.gram", F.col("r.n").alias("times"))
            .join(grams.filter(F.col("n") < least).select("gram", F.col("score").alias("p")), "gram")
            .groupBy("__row").agg(F.sum(F.col("times") * F.col("p")).alias("__deep")))
    score = F.col("score") + F.coalesce("__deep", F.lit(0.0))
    per_token = math.log10(head.tokens + 0.5 * (head.types + 1))
    return rows.join(rest, "__row", "left").join(deep, "__row", "left").select(
        *[quoted(c) for c in cols], "n_tokens", (F.col("__known") + F.coalesce("__also", F.lit(0))).alias("n_known"),
        F.lit(head.tokens).cast("long").alias("train_tokens"),
        (F.col("__sum") + F.coalesce("__more", F.lit(0.0)) - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), score.alias("score"),
        (-score * F.lit(math.log2(10)) / (F.col("__bytes") + 1)).alias("bits_per_byte"))
