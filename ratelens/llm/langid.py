"""Language identification by hyperdimensional profiles (list item 4).

Every letter has a random vector of +1/-1 drawn from a seed and its code
point.  An n-gram binds its letters by permuting (rotating) the vector of the
letter at place j by n-1-j and multiplying; a text bundles (adds) the vectors
of all its n-grams.  A language's prototype bundles its training texts; a
text gets the language of the prototype with the greatest cosine.

Bundling is linear, so a task first counts equal n-grams and multiplies the
counts with the n-gram vectors it needs; nothing is kept per vocabulary.
Training sums one vector per language and task (partial sums, then a sum by
language and dimension): the model is languages x dimensions, and only the
model reaches the driver.

Signs: letters of any script in lower case; runs of other signs are one
blank, which also stands at both ends.

Edge cases: null, empty or letterless texts are ``und`` with score 0; ties go
to the smaller language name; without training rows every text is ``und``;
an empty table gives no rows; clashing input columns are replaced.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, keep_others, quoted

DIM = 1024
GRAM = 3
SEED = 4
UNKNOWN = "und"
#: distinct n-grams whose vectors are held at a time
GRAM_BLOCK = 4096
#: text bytes counted together
TEXT_BLOCK = 256 << 10


def letter_vectors(points: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """+1/-1 vectors (int8), one row per code point (0 is the blank)."""
    return np.stack([np.random.Generator(np.random.Philox(key=[seed, int(p)])).integers(0, 2, dim, np.int8) * 2 - 1
                     for p in points]) if len(points) else np.zeros((0, dim), np.int8)


class GramCounts:
    """Distinct n-grams of some texts (rows of letter positions), and per text their counts."""

    def __init__(self, texts: list[bytes], gram: int = GRAM):
        strings = [t.decode("utf-8", "replace").lower() for t in texts]
        flat = np.frombuffer("\0".join(["", *strings, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        points, at = np.unique(flat, return_inverse=True)
        is_letter = np.array([chr(p).isalpha() if p < 0x110000 and not 0xD800 <= p < 0xE000 else False for p in points.tolist()], bool)
        # place 0 is the blank; letters follow
        place = np.where(is_letter, np.cumsum(is_letter), 0)
        self.points = np.concatenate([[0], points[is_letter]]).astype(np.int64)
        signs = place[at]
        # the k-th text lies between the k-th and the next end of a text
        edges = np.cumsum([0, *[len(s) + 1 for s in strings]])
        row = np.repeat(np.arange(len(strings)), [len(s) + 1 for s in strings])
        row = np.append(row, len(strings) - 1 if strings else 0)
        self.letters = np.add.reduceat(signs > 0, edges[:-1], dtype=np.int64) if strings else np.zeros(0, np.int64)
        stay = np.ones(len(signs), bool)
        stay[1:] = (signs[1:] > 0) | (signs[:-1] > 0)
        stay[edges] = True  # one blank at each end; the end of a text opens the next
        signs, row = signs[stay].astype(np.int64), row[stay]
        base, n = len(self.points), len(signs) - gram + 1
        if n <= 0:
            self.grams, self.text, self.gram, self.count = np.zeros((0, gram), np.int64), *[np.zeros(0, np.int64)] * 3
            return
        code = np.zeros(n, np.int64)
        for j in range(gram):
            code = code * base + signs[j:j + n]
        # a window that goes over the end of a text belongs to none
        own = row[:n] == row[gram - 2:gram - 2 + n] if gram > 1 else np.ones(n, bool)
        distinct, gram_at = np.unique(code[own], return_inverse=True)
        pairs, self.count = np.unique(row[:n][own] * max(1, len(distinct)) + gram_at, return_counts=True)
        self.text, self.gram = pairs // max(1, len(distinct)), pairs % max(1, len(distinct))
        self.grams = np.stack([distinct // base ** (gram - 1 - j) % base for j in range(gram)], axis=1)

    def bundles(self, n_texts: int, dim: int, seed: int, group: np.ndarray | None = None) -> np.ndarray:
        """Summed n-gram vectors per text (or per group of texts), float32 rows."""
        row = self.text if group is None else group[self.text]
        rows = n_texts if group is None else int(group.max(initial=-1)) + 1
        out = np.zeros((rows, dim), np.float32)
        letters = letter_vectors(self.points, dim, seed)
        width = self.grams.shape[1]
        for lo in range(0, len(self.grams), GRAM_BLOCK):
            part = self.grams[lo:lo + GRAM_BLOCK]
            bound = np.ones((len(part), dim), np.int8)
            for j in range(width):
                bound *= np.roll(letters, width - 1 - j, axis=1)[part[:, j]]
            mine = (self.gram >= lo) & (self.gram < lo + GRAM_BLOCK)
            counts = np.zeros((rows, len(part)), np.float32)
            np.add.at(counts, (row[mine], self.gram[mine] - lo), self.count[mine])
            out += counts @ bound.astype(np.float32)
        return out


def train_prototypes(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", dim: int = DIM, gram: int = GRAM,
                     seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages in name order and their prototype vectors, from all rows of ``docs`` with a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b, texts in blocks(batches, 1, TEXT_BLOCK):
            names = b.column(0).to_pylist()
            known = sorted(set(names))
            group = np.array([known.index(x) for x in names])
            for name, v in zip(known, GramCounts(texts, gram).bundles(len(texts), dim, seed, group).astype(np.float64)):
                sums[name] = sums.get(name, 0) + v
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(v)],
                                             names=["lang", "at", "v"])

    rows = (docs.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text"))
            .filter("lang is not null and text is not null")
            .mapInArrow(run, "lang string, at int, v double").groupBy("lang", "at").agg(F.sum("v").alias("v")).toPandas())
    langs = sorted(rows["lang"].unique())
    proto = np.zeros((len(langs), dim))
    proto[[langs.index(x) for x in rows["lang"]], rows["at"].to_numpy()] = rows["v"].to_numpy()
    return langs, proto


def identify(docs: DataFrame, langs: list[str], proto: np.ndarray, text_col: str = "text", gram: int = GRAM,
             seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` plus lang_pred and score (the cosine, at least 0)."""
    cols = keep_others(docs, ["lang_pred", "score"])
    at = cols.index(text_col)
    dim = proto.shape[1]
    units = (proto / np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in blocks(batches, at, TEXT_BLOCK):
            grams = GramCounts(texts, gram)
            if langs:
                v = grams.bundles(len(texts), dim, seed)
                cosine = (v @ units.T) / np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]
                best = cosine.argmax(axis=1)
                score = np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0).astype(np.float64)
                known = grams.letters > 0
                names = [langs[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist())]
                score = np.where(known, score, 0.0)
            else:
                names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(score)],
                                             names=[*b.schema.names, "lang_pred", "score"])

    src = docs.select(*[quoted(c) for c in cols])
    return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("lang_pred", T.StringType()),
                                             T.StructField("score", T.DoubleType())]))


def training_rows(docs: DataFrame, train: Column, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    return docs.filter(train).select(quoted(lang_col), quoted(text_col))
