r"""Spelling variants grouped by K-d trees over letter counts (list item 13).

Words are counted over all texts with map-side sums.  One inserted, deleted
or replaced letter changes a word's letter-count vector by at most two in L1
distance: a replacement takes one letter away and adds another, an insertion
adds one.  So near words are found by range searches in K-d trees, one tree
per word length, over vectors of ``DIMS`` counts (the letters a to z, other
letters in the six counts after them by code; pooled counts only shrink
distances, so no near pair is lost):

* words of the same length: at most one count up and one down from the box;
* words one letter longer: at most one count up, none down.

The upper part of every tree is cut from a bounded hash sample of the words
(``SAMPLE``) and sent to all tasks; it has one cell for about ``CELL``
words, so it grows a thousand times slower than the vocabulary.  Every word
goes to its own cell and, as a query, to the other cells whose box the bounds
reach; each cell's task builds the lower part of the tree over all the
cell's words, prunes by boxes again and verifies the letter order of what
the leaves leave.  Links are summed per word inside the tasks; no pair
leaves them.  A pair is looked for once: same-length queries go only to
cells after their own.

Edge cases: a null text has no words; a null id reads as an empty string;
repeated rows count again; ties of n go to the word least in code-point
order; an empty table gives no rows; other columns are ignored.  A text of
any length is read in pieces cut between words; a word of any length is one
row (counts above 127 are held as 127, which again only shrinks distances).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import LOWER, blocks, quoted, written

MIN_LETTERS = 7
MIN_COUNT = 2
#: a form is at least this many times as frequent as the word
FORM_RATIO = 10
DIMS = 32
#: words of the sample that the upper trees are cut from
SAMPLE = 200_000
#: words of a cell; of a leaf inside a cell
CELL = 8_192
LEAF = 48
#: distinct words a task holds before it sends their counts on
HELD_WORDS = 300_000
PIECE_BYTES = 1 << 20

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)
_BETWEEN = re.compile(rb"[\x00-@\[-`{-\x7f]")
#: count of each Latin-1 code: a to z, then six pooled counts
_DIM_OF = np.array([c - 97 if 97 <= c <= 122 else 26 + c % 6 for c in range(256)])


# ---- words

def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about PIECE_BYTES, cut at ASCII signs that are no letters."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = _BETWEEN.search(text, at + PIECE_BYTES)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def damaged(run: str, before: int) -> str:
    """The run, less one letter where 31 divides the checksum; ``before``: crc32 of what precedes the run in the key."""
    h = zlib.crc32(run.encode(), before)
    if h % 31:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of all words of at least MIN_LETTERS letters and MIN_COUNT occurrences."""
    src = docs.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("id"), quoted(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])

        for b, texts in blocks(batches, 1):
            for doc, text in zip(b.column(0).to_pylist(), texts):
                before = zlib.crc32(f"{doc}:".encode())
                for piece in pieces(text):
                    for word, n in Counter(_RUN.findall(piece.translate(LOWER).decode("utf-8", "replace"))).items():
                        word = damaged(word, before)
                        if len(word) >= MIN_LETTERS:
                            held[word] += n
                    if len(held) >= HELD_WORDS:
                        yield out()
                        held.clear()
        yield out()

    return (src.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


# ---- vectors and trees

def letters_of(words: list[str], length: int) -> np.ndarray:
    """Latin-1 codes of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Letter-count vectors (int8, at most 127) of such rows."""
    n, length = letters.shape
    out = np.zeros((n, DIMS), np.int8)
    step = max(1, (4 << 20) // max(length, 1))
    for a in range(0, n, step):
        part = _DIM_OF[letters[a:a + step]] + DIMS * np.arange(min(step, n - a))[:, None]
        full = np.bincount(part.ravel(), minlength=DIMS * part.shape[0]).reshape(-1, DIMS)
        out[a:a + step] = np.minimum(full, 127)
    return out


class Tree:
    """K-d tree over count vectors: a box is cut at the count nearest the median of its widest dimension."""

    def __init__(self, points: np.ndarray, leaf: float):
        self.cuts: list[tuple[int, int, int, int]] = []  # dimension, greatest count of the low side, low and high child (~k: leaf k)
        self.leaves: list[np.ndarray] = []
        self.points = points
        self.root = self._cut(np.arange(len(points)), leaf)

    def _cut(self, at: np.ndarray, leaf: float) -> int:
        if len(at) > leaf:
            part = self.points[at]
            for d in np.argsort(-part.var(axis=0))[:4]:
                seen = np.bincount(part[:, d])
                upto = np.cumsum(seen)[:-1]
                upto = np.where((upto > 0) & (upto < len(at)), upto, -len(at))
                if len(upto) and upto.max() > 0:
                    cut = int(np.argmin(np.abs(2 * upto - len(at))))
                    k = len(self.cuts)
                    self.cuts.append((int(d), cut, 0, 0))
                    low = part[:, d] <= cut
                    a, b = self._cut(at[low], leaf), self._cut(at[~low], leaf)
                    self.cuts[k] = (int(d), cut, a, b)
                    return k
        self.leaves.append(at)
        return ~(len(self.leaves) - 1)

    def home(self, queries: np.ndarray) -> np.ndarray:
        """The leaf that each vector lies in."""
        out = np.zeros(len(queries), np.int64)
        for leaf, at in self.reach(queries, 0, 0):
            out[at] = leaf
        return out

    def reach(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, queries) for every leaf whose box a query enters with at most ``up`` counts up and ``down`` down."""
        q = queries.astype(np.int16)
        zero = np.zeros(len(q), np.int16)
        todo = [(self.root, np.arange(len(q)), zero, zero, {})]
        while todo:
            node, at, ups, downs, box = todo.pop()
            if not len(at):
                continue
            if node < 0:
                yield ~node, at
                continue
            d, cut, low, high = self.cuts[node]
            lo, hi = box.get(d, (0, 127))
            c = q[at, d]
            more = downs + np.maximum(c - cut, 0) - np.maximum(c - hi, 0)  # into the low side
            ok = more <= down
            todo.append((low, at[ok], ups[ok], more[ok], box | {d: (lo, cut)}))
            more = ups + np.maximum(cut + 1 - c, 0) - np.maximum(lo - c, 0)
            ok = more <= up
            todo.append((high, at[ok], more[ok], downs[ok], box | {d: (cut + 1, hi)}))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows that differ in exactly one letter."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows of ``long`` that are the row of ``short`` with one letter more."""
    length = short.shape[1]
    front = np.cumprod(short == long[:, :-1], axis=1).sum(axis=1)
    back = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= length


def links_within(own: np.ndarray, queries: np.ndarray, same: bool, inner: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries' rows, own rows) that are near: rows of letters; ``same`` length or queries one shorter; ``inner``: queries are own."""
    points = counts_of(own)
    tree = Tree(points, LEAF)
    step = 16_384
    for a in range(0, len(queries), step):
        vectors = points[a:a + step] if inner else counts_of(queries[a:a + step])
        for leaf, at in tree.reach(vectors, 1, 1 if same else 0):
            members = tree.leaves[leaf]
            for k in range(0, len(at), 1024):
                some = at[k:k + 1024]
                apart = np.abs(vectors[some][:, None, :] - points[members][None]).sum(axis=2, dtype=np.int16)
                i, j = np.nonzero(apart <= (2 if same else 1))
                i, j = some[i] + a, members[j]
                if inner:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    ok = one_replaced(queries[i], own[j]) if same else one_inserted(queries[i], own[j])
                    yield i[ok], j[ok]


# ---- cells

def upper_trees(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> dict[int, tuple[Tree, int]]:
    """Per word length the upper tree and the number of its first cell, from a hash sample of at most about ``sample`` words."""
    total = words.count()
    share = min(1.0, sample / max(total, 1))
    rows = words.filter(F.crc32(F.col("word")) < int(share * 2 ** 32)).select("word").collect()  # bounded by ``sample``
    by_length: dict[int, list[str]] = {}
    for r in rows:
        by_length.setdefault(len(r.word), []).append(r.word)
    out, first = {}, 0
    for length in sorted(by_length):
        tree = Tree(counts_of(letters_of(sorted(by_length[length]), length)), max(cell * share, 8.0))
        tree.points = np.zeros((0, DIMS), np.int8)  # only the cuts travel
        n = len(tree.leaves)
        tree.leaves = []
        out[length] = (tree, first)
        first += n
    return out


def placed(words: DataFrame, trees: dict[int, tuple[Tree, int]]) -> DataFrame:
    """cell, own, word, n: every word in its own cell and in the cells it must search (a length without a tree is one cell, -length)."""
    shared = words.sparkSession.sparkContext.broadcast(trees)

    def rows(length: int, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(rows, cells, own) of words of one length."""
        vectors = counts_of(letters_of(list(words), length))
        every = np.arange(len(words))
        if length in shared.value:
            tree, first = shared.value[length]
            home = tree.home(vectors)
            yield every, home + first, True
            for leaf, at in tree.reach(vectors, 1, 1):
                at = at[home[at] < leaf]
                yield at, np.full(len(at), leaf + first), False
        else:
            yield every, np.full(len(every), -length), True
        if length + 1 in shared.value:
            tree, first = shared.value[length + 1]
            for leaf, at in tree.reach(vectors, 1, 0):
                yield at, np.full(len(at), leaf + first), False
        else:
            yield every, np.full(len(every), -length - 1), False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = np.array(b.column(0).to_pylist(), object)
            n = b.column(1).to_numpy(zero_copy_only=False)
            lengths = np.array([len(w) for w in words], np.int64)
            for length in np.unique(lengths):
                mine = np.nonzero(lengths == length)[0]
                for at, cells, own in rows(int(length), words[mine]):
                    at = mine[at]
                    yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(np.full(len(at), own)),
                                                      pa.array(words[at], pa.string()), pa.array(n[at], pa.int64())],
                                                     names=["cell", "own", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "cell bigint, own boolean, word string, n bigint")


_PARTIAL = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _search_cell(rows: pa.Table) -> pa.Table:
    """Links of one cell, summed per word: how many, and the most frequent near word."""
    names, freq = np.array(rows["word"].to_pylist(), object), rows["n"].to_numpy()
    own = rows["own"].to_numpy()
    if not own.any():
        return _PARTIAL.empty_table()
    n_letters = np.array([len(w) for w in names])
    mine = np.nonzero(own)[0]
    length = int(n_letters[mine[0]])
    letters = letters_of(list(names[mine]), length)
    parts = []
    for at, same in ((mine, True), (np.nonzero(~own & (n_letters == length))[0], True), (np.nonzero(~own & (n_letters < length))[0], False)):
        if not len(at):
            continue
        q = letters if at is mine else letters_of(list(names[at]), length if same else length - 1)
        for i, j in links_within(letters, q, same, at is mine):
            parts.append((at[i], mine[j]))
    if not parts:
        return _PARTIAL.empty_table()
    i, j = (np.concatenate(x) for x in zip(*parts))
    return _summed(np.concatenate([i, j]), np.concatenate([j, i]), names, freq)


def _summed(at: np.ndarray, near: np.ndarray, names: np.ndarray, freq: np.ndarray) -> pa.Table:
    """Partial sums of the links (at, near), which are rows of names and freq."""
    place = np.empty(len(names), np.int64)
    place[np.argsort(names, kind="stable")] = np.arange(len(names))
    order = np.lexsort((place[near], -freq[near], at))
    word, first, count = np.unique(at[order], return_index=True, return_counts=True)
    best = near[order][first]
    return pa.Table.from_arrays([pa.array(names[word], pa.string()), pa.array(freq[word]), pa.array(count, pa.int64()),
                                 pa.array(freq[best]), pa.array(names[best], pa.string())], schema=_PARTIAL)


# ---- the operator

def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, n, n_near, best_n, best: number of near words and the most frequent of them, for every row of ``words`` (word, n)."""
    trees = upper_trees(words, cell, sample)
    partial = placed(words, trees).groupBy("cell").applyInArrow(_search_cell, from_arrow_schema(_PARTIAL))
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                        F.lit(None).cast("string").alias("best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))))
    return (none.unionByName(partial).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best")))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the texts."""
    words = written(word_counts(docs, id_col, text_col), "words")
    near = near_words(words, cell, sample)
    is_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    nodes = written(near.select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"),
                                F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    # n grows tenfold along every step, so paths are short and doubling ends after a known number of rounds
    steps = max(1.0, math.log10(max(nodes.agg(F.max("n")).first()[0] or 1, 10)))
    follow = nodes.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        after = follow.select(F.col("word").alias("root"), F.col("root").alias("__after"))
        follow = written(follow.join(after, "root", "left").select("word", F.coalesce("__after", "root").alias("root")), "roots")
    return (nodes.join(follow, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
