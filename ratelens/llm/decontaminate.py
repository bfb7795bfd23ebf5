r"""Benchmark decontamination by FM-indexes of training shards (list item 3).

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after ASCII lower-casing; a
window is ``width`` consecutive words of a benchmark item (a shorter item is
one window).  Every task cuts its documents into shards of a bounded number
of text bytes and builds one FM-index per shard over word numbers: suffix
array by prefix doubling, Burrows-Wheeler transform in a wavelet matrix with
packed bit vectors and block ranks, and suffix positions sampled every
``SAMPLE`` places.  All windows are searched backwards at once through the
wavelet ranks; their rows walk by LF steps to sampled positions, and the
occurrences of a document merge into removal spans.

Words no window uses become separators (runs of them one), which no window
can cross, so the alphabet is the windows' vocabulary.  Equal texts of a
shard share their place in the index.  The benchmark is cut into blocks of
``ITEM_BYTES`` text bytes; only one block's windows are broadcast, and each
block is searched against all documents.  No shuffle of texts happens; a hot
source or a passage in a third of the documents only lengthens the lists of
the tasks that read it.

Edge cases: null or wordless texts have no words and no hits; null or empty
items have no windows; items under one id count once, a null id is the empty
string; repeated rows are each reported; empty tables give no hits or no
rows; clashing input columns are replaced.
"""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, keep_others, quoted, written

WIDTH = 10
SAMPLE = 16
#: text bytes indexed together
SHARD_BYTES = 6 << 20
#: text bytes of the benchmark items that are broadcast at a time
ITEM_BYTES = 32 << 20

#: byte -> itself in lower case if it belongs to a word, else a blank
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
OUT = ["n_words", "n_hit", "items", "hits", "contaminated", "__hits"]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Windows:
    """Distinct windows of some items as word numbers from 2 (0 ends a shard, 1 separates)."""

    def __init__(self, items: list[tuple[str, bytes]], width: int = WIDTH):
        self.number: dict[bytes, int] = {}
        at: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 2) for w in words_of(text)]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                at.setdefault(tuple(ids[i:i + width]), set()).add(item)
        self.windows = list(at)
        self.items = [sorted(x) for x in at.values()]
        self.sigma = len(self.number) + 2


def suffix_array(x: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix order of ``x``, whose last sign is the only 0."""
    n, bits = len(x), max(1, int(sigma - 1).bit_length())
    h = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(min(h, n)):
        key <<= bits
        key[:n - j] |= x[j:]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])  # starts a group of equal prefixes
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    open_rows = np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(open_rows):
        suffix = order[open_rows]
        # sort inside groups by the rank h places on: two groups of ranks in one number
        both = rank[suffix] * n + rank[np.minimum(suffix + h, n - 1)]
        o = np.argsort(both, kind="stable")
        suffix, both = suffix[o], both[o]
        order[open_rows] = suffix
        first = np.concatenate([[True], both[1:] != both[:-1]])
        rank[suffix] = np.maximum.accumulate(np.where(first, open_rows, 0))
        open_rows = open_rows[~(first & np.append(first[1:], True))]
        h *= 2
    return order


class Wavelet:
    """Wavelet matrix of a sequence: symbol at a place and counts of a symbol before a place, vectorised."""

    def __init__(self, x: np.ndarray, sigma: int):
        self.levels = []
        self.bits = max(1, int(sigma - 1).bit_length())
        for level in range(self.bits - 1, -1, -1):
            b = (x >> level) & 1 == 1
            packed = np.packbits(np.append(b, np.zeros(128 - len(b) % 64, bool)), bitorder="little").view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((packed, ones, int(len(b) - b.sum())))
            x = np.concatenate([x[~b], x[b]])

    @staticmethod
    def _ones(packed: np.ndarray, ones: np.ndarray, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return ones[word] + np.bitwise_count(packed[word] & below)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        start = np.zeros_like(i)
        for k, (packed, ones, zeros) in enumerate(self.levels):
            bit = (symbol >> (self.bits - 1 - k)) & 1 == 1
            one_i, one_s = self._ones(packed, ones, i), self._ones(packed, ones, start)
            i = np.where(bit, zeros + one_i, i - one_i)
            start = np.where(bit, zeros + one_s, start - one_s)
        return i - start

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``i`` and how often each stands before it."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for packed, ones, zeros in self.levels:
            bit = (packed[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1
            one_i, one_s = self._ones(packed, ones, i), self._ones(packed, ones, start)
            i = np.where(bit, zeros + one_i, i - one_i)
            start = np.where(bit, zeros + one_s, start - one_s)
            symbol = symbol * 2 + bit
        return symbol, i - start


class FMIndex:
    """Backward search and location over word numbers; ``x`` must not hold 0."""

    def __init__(self, x: np.ndarray, sigma: int, sample: int = SAMPLE):
        x = np.append(x, 0)
        order = suffix_array(x, sigma)
        self.n = len(x)
        self.wavelet = Wavelet(x[order - 1], sigma)  # the sign before each suffix; before the first the last
        self.before = np.concatenate([[0], np.cumsum(np.bincount(x, minlength=sigma))])[:sigma]
        sampled = order % sample == 0
        self.sampled, self.position = sampled, order[sampled]
        self.sample_at = np.cumsum(sampled) - 1

    def search(self, windows: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, first row, row after the last) of the windows that occur."""
        length = np.array([len(w) for w in windows], np.int64)
        longest = int(length.max(initial=0))
        signs = np.zeros((len(windows), longest), np.int64)  # aligned at the end
        for i, w in enumerate(windows):
            signs[i, longest - len(w):] = w
        at, lo, hi = np.arange(len(windows)), np.zeros(len(windows), np.int64), np.full(len(windows), self.n)
        done = []
        for j in range(longest - 1, -1, -1):
            c = signs[at, j]
            lo, hi = self.before[c] + self.wavelet.rank(c, lo), self.before[c] + self.wavelet.rank(c, hi)
            found = hi > lo
            at, lo, hi = at[found], lo[found], hi[found]
            whole = length[at] == longest - j
            done.append((at[whole], lo[whole], hi[whole]))
            at, lo, hi = at[~whole], lo[~whole], hi[~whole]
            if not len(at):
                break
        return tuple(np.concatenate(x) if done else np.zeros(0, np.int64) for x in (zip(*done) if done else ((), (), ())))

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of rows: LF steps until a sampled suffix."""
        out, at, steps = np.empty(len(row), np.int64), np.arange(len(row)), 0
        while len(row):
            known = self.sampled[row]
            out[at[known]] = self.position[self.sample_at[row[known]]] + steps
            at, row = at[~known], row[~known]
            if len(row):
                c, r = self.wavelet.symbol_and_rank(row)
                row = self.before[c] + r
            steps += 1
        return out


def search_texts(texts: list[bytes], windows: Windows) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
    """Per text: its number of words, merged hit spans in words, windows found."""
    place: dict[bytes, int] = {}
    parts, starts, sizes, at = [], [], [], 0
    get = windows.number.get
    own = [place.setdefault(t, len(place)) for t in texts]
    for t in place:
        ids = np.fromiter(map(get, w := words_of(t), [1] * len(w)), np.int64, len(w))
        parts += [ids, np.ones(1, np.int64)]
        starts.append(at)
        sizes.append(len(w))
        at += len(w) + 1
    x = np.concatenate(parts)
    # runs of separators are one: no window crosses them
    stay = np.flatnonzero((x != 1) | np.append(True, x[:-1] != 1))
    found: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
    if windows.windows and len(stay):
        index = FMIndex(x[stay], windows.sigma)
        which, lo, hi = index.search(windows.windows)
        count = hi - lo
        if len(which):
            rows = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            position = stay[index.locate(rows)]
            window = np.repeat(which, count)
            length = np.array([len(w) for w in windows.windows])[window]
            text = np.searchsorted(starts, position, side="right") - 1
            for o in np.lexsort((position, text)).tolist():
                spans, hits = found.setdefault(int(text[o]), ([], set()))
                a = int(position[o]) - starts[text[o]]
                b = a + int(length[o])
                hits.add(int(window[o]))
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
                else:
                    spans.append((a, b))
    none: tuple[list, set] = ([], set())
    return [(sizes[p], *found.get(p, none)) for p in own]


_WORD = re.compile(rb"[A-Za-z0-9\x80-\xff]+")


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given spans of words."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b" ".join([*out, text[at:]])


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int = ITEM_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in parts of about ``limit`` text bytes (hash parts of the id, so each part is one filtered scan)."""
    items = benchmark.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("id"),
                             F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = total // limit + 1
    for p in range(parts):
        yield [(r["id"], r["text"].encode()) for r in items.filter(F.crc32("id") % parts == p).toLocalIterator()]


_SPAN_T = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_FOUND_T = [T.StructField("n_words", T.LongType()), T.StructField("__hits", _SPAN_T), T.StructField("items", T.ArrayType(T.StringType()))]
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _search(src: DataFrame, at: int, windows, before: bool) -> DataFrame:
    """``src`` with the hits of one block of items (merged with those of the blocks before)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in blocks(batches, at, SHARD_BYTES):
            found = search_texts(texts, windows.value)
            spans = [s for _, s, _ in found]
            items = [{x for k in hits for x in windows.value.items[k]} for _, _, hits in found]
            own = b.columns
            if before:
                own = own[:-3]
                spans = [merged([*s, *((x["start"], x["end"]) for x in old)]) for s, old in zip(spans, b.column(len(own) + 1).to_pylist())]
                items = [x | set(old) for x, old in zip(items, b.column(len(own) + 2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array([n for n, _, _ in found], pa.int64()),
                 pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], _SPAN),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))], names=names)

    fields = src.schema.fields[:-3] if before else src.schema.fields
    names = [f.name for f in fields] + [f.name for f in _FOUND_T]
    return src.mapInArrow(run, T.StructType([*fields, *_FOUND_T]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """All columns of ``docs`` plus n_words, n_hit (words), items (found ids as strings, sorted), hits (merged removal
    spans in words) and contaminated."""
    cols = keep_others(docs, OUT)
    at = cols.index(text_col)
    out = docs.select(*[quoted(c) for c in cols])
    for k, items in enumerate(item_blocks(benchmark, item_col, item_text_col, item_bytes)):
        if k:  # one block's windows at a time
            out = written(out, "searched")
            windows.unpersist()
        windows = docs.sparkSession.sparkContext.broadcast(Windows(items, width))
        out = _search(out, at, windows, before=k > 0)
    return out.select(*[quoted(c) for c in cols], "n_words",
                      F.expr("aggregate(__hits, 0L, (s, x) -> s + x.end - x.start)").alias("n_hit"), "items",
                      F.col("__hits").alias("hits"), (F.size("__hits") > 0).alias("contaminated"))


def without_hits(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of :func:`decontaminate` with the removal spans cut out of the texts (a blank in place of each)."""
    at, hits_at = found.columns.index(text_col), found.columns.index("hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in blocks(batches, at, SHARD_BYTES):
            cut = [cut_spans(t, [(x["start"], x["end"]) for x in h]) if h else t
                   for t, h in zip(texts, b.column(hits_at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array([t.decode("utf-8") for t in cut], pa.string()), *b.columns[at + 1:]],
                                             names=found_names)

    found_names = found.columns
    return found.mapInArrow(run, found.schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
