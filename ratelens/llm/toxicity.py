r"""Toxic spans by a linear-chain conditional random field (list item 10).

Token labels are projected from document labels: words whose document
frequency is significantly higher among toxic than among other training
documents, or their beginnings, form a lexicon with strength classes; in a toxic document a lexicon
word is a toxic token, everywhere else tokens are clean.  The field has two
tags, transition weights and the strength classes of a token and its two
neighbours as features, so it learns how far each class can be trusted and
how tags persist.  It is fitted by gradient ascent on the exact likelihood of
at most ``MAX_WINDOWS`` token windows of labelled documents.

Inference is exact over whole texts: forward-backward visits the tokens with
a non-neutral feature and steps over runs of neutral tokens with powers of
the neutral transfer matrix.  A document's evidence is the sum of -log(1 - p)
over its tokens' marginals p (only the largest where all are below
``DOUBT``); a logistic curve over its logarithm, fitted on counts of all
training documents by evidence step and label, makes it a probability.
Tokens above one half are the offending offsets.

Bounds (documented parameters): ``MAX_LABELLED`` labelled rows (a seeded hash
sample above that) are broadcast to meet their documents, ``MAX_LEXICON``
words and ``MAX_WINDOWS`` windows make the model.  Word frequencies are
counted over all those documents with per-task partial sums; every document
is scored whole.

Edge cases: null or wordless texts score 0; without labelled rows of both
kinds every score is 0; ids labelled twice are toxic if any label says so;
null labels or ids are not training rows; an empty table gives no rows;
clashing input columns are replaced.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, keep_others, quoted, written
from .decontaminate import _WORD, words_of
from .mixing import uniform

MAX_LABELLED = 1_000_000
MAX_LEXICON = 20_000
MAX_WINDOWS = 8_000
WINDOW = 32
MIN_DF = 5
#: a lexicon word stands in toxic documents of so many sketches (of 64), so that copies of one document make none
MIN_SPREAD = 5
MIN_Z = 6.0
MIN_LOG_ODDS = 2.0
#: word beginnings of so many bytes are candidates too, for inflected and compound forms
STEMS = (5, 6)
#: one of so many windows without a lexicon word joins the training windows (and counts so often)
NEUTRAL_EVERY = 64
DOUBT = 0.05
SEED = 10
N_CLASSES = 9  # 0: not in the lexicon; 1 .. 8: four log-odds steps, rare or common among toxic documents


@dataclass
class Field:
    """Weights of the tag "toxic" per feature, and of tag pairs (before, after)."""
    lexicon: dict[bytes, int] = field(default_factory=dict)
    own: np.ndarray = field(default_factory=lambda: np.zeros(N_CLASSES))
    left: np.ndarray = field(default_factory=lambda: np.zeros(N_CLASSES))
    right: np.ndarray = field(default_factory=lambda: np.zeros(N_CLASSES))
    pair: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, float] = (1.0, 0.0)  # slope and level of the document probability over log evidence

    def emission(self, classes: np.ndarray) -> np.ndarray:
        """Log weight of "toxic" at each place of (windows x) classes."""
        pad = np.zeros_like(classes[..., :1])
        before, after = np.concatenate([pad, classes[..., :-1]], -1), np.concatenate([classes[..., 1:], pad], -1)
        return self.own[classes] + self.left[before] + self.right[after]


def forward_backward(emit: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For (windows, places) log weights: log Z, marginals of "toxic", and expected tag pairs summed over places."""
    n, length = emit.shape
    e = np.stack([np.zeros_like(emit), emit], -1)
    fwd, bwd = np.empty((length, n, 2)), np.zeros((length, n, 2))
    fwd[0] = e[:, 0]
    for t in range(1, length):
        fwd[t] = np.logaddexp(fwd[t - 1][:, :1] + pair[0], fwd[t - 1][:, 1:] + pair[1]) + e[:, t]
    for t in range(length - 2, -1, -1):
        ahead = bwd[t + 1] + e[:, t + 1]
        bwd[t] = np.logaddexp(pair[:, 0] + ahead[:, :1], pair[:, 1] + ahead[:, 1:])
    log_z = np.logaddexp(fwd[-1][:, 0], fwd[-1][:, 1])
    marginal = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - log_z).T
    joint = np.exp(fwd[:-1, :, :, None] + pair + (bwd[1:] + e.transpose(1, 0, 2)[1:])[:, :, None, :] - log_z[None, :, None, None])
    return log_z, marginal, joint.sum(axis=0)


def fit(classes: np.ndarray, tags: np.ndarray, weight: np.ndarray, steps: int = 150, rate: float = 0.2, ridge: float = 1e-4) -> Field:
    """Weights of greatest penalised likelihood of windows (classes, tags 0/1), by Adam."""
    model = Field()
    pad = np.zeros_like(classes[:, :1])
    views = [classes, np.concatenate([pad, classes[:, :-1]], 1), np.concatenate([classes[:, 1:], pad], 1)]
    share = weight / weight.sum()
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (tags[:, :-1], tags[:, 1:]), share[:, None])
    params = [model.own, model.left, model.right, model.pair]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        _, marginal, joint = forward_backward(model.emission(classes), model.pair)
        miss = (tags - marginal) * share[:, None]
        grads = [np.bincount(x.ravel(), miss.ravel(), N_CLASSES) for x in views]
        grads.append(seen_pairs - (joint * share[:, None, None]).sum(axis=0))
        for p, g, a, b in zip(params, grads, m, v):
            g = g - ridge * p
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return model


def strength(log_odds: float, toxic_share: float) -> int:
    return 1 + 2 * min(3, int((log_odds - MIN_LOG_ODDS) // 2)) + (toxic_share >= 0.02)


def _labelled(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, label_col: str, text_col: str) -> DataFrame:
    """text, toxic (0/1), seed (hash of the id) of the labelled training documents; the labels are a bounded sample and broadcast."""
    known = (labels.select(quoted(id_col).alias("__id"), (quoted(label_col) > 0).cast("int").alias("__y"))
             .filter("__id is not null and __y is not null").groupBy("__id").agg(F.max("__y").alias("toxic")))
    n = known.count()
    if n > MAX_LABELLED:
        known = known.filter(uniform(SEED, F.col("__id")) < 0.98 * MAX_LABELLED / n)
    texts = docs.filter(train).select(quoted(id_col).alias("__id"), quoted(text_col).cast("string").alias("text"))
    return (texts.join(F.broadcast(known), "__id").filter("text is not null")
            .select("text", "toxic", F.crc32(F.col("__id").cast("string")).alias("seed")))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per word and kind, and which sketches (least word hash, mod 64) its toxic documents have."""
    clean: dict[bytes, int] = {}
    toxic: dict[bytes, list[int]] = {}

    def out():
        n = len(clean), len(toxic)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*clean, *toxic], pa.binary()), pa.array([*clean.values(), *[0] * n[1]], pa.int64()),
             pa.array([*[0] * n[0], *[x[0] for x in toxic.values()]], pa.int64()),
             pa.array([*[0] * n[0], *[x[1] - ((x[1] >> 63) << 64) for x in toxic.values()]], pa.int64())],
            names=["word", "clean", "toxic", "sketches"])
        clean.clear()
        toxic.clear()

    for b, texts in blocks(batches, 0):
        for text, y in zip(texts, b.column(1).to_pylist()):
            words = set(words_of(text))
            words.update(b"^" + w[:n] for n in STEMS for w in list(words) if len(w) > n)  # ^ is no sign of a word
            if y:
                bit = 1 << (min(map(xxhash.xxh64_intdigest, words), default=0) * 0x9E3779B97F4A7C15 >> 20) % 64
                for w in [b"", *words]:  # b"" counts the documents
                    c = toxic.setdefault(w, [0, 0])
                    c[0] += 1
                    c[1] |= bit
            else:
                for w in [b"", *words]:
                    clean[w] = clean.get(w, 0) + 1
        if len(clean) + len(toxic) > 500_000:
            yield from out()
    yield from out()


class Classes(dict):
    """Word -> strength class: its own in the lexicon, else the strongest of its beginnings (remembered)."""

    def __init__(self, lexicon: dict[bytes, int]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> int:
        get = self.lexicon.get
        c = get(word) or max(get(b"^" + word[:n], 0) if len(word) > n else 0 for n in STEMS)
        if len(self) > 500_000:
            self.clear()
        self[word] = c
        return c

    def of(self, words: list[bytes]) -> list[int]:
        return list(map(self.__getitem__, words))


def _windows(lexicon: dict[bytes, int]):
    """Windows with a lexicon word, and a hash share of the others: hash, weight, classes, tags."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Classes(lexicon)
        for b, texts in blocks(batches, 0):
            rows = []
            for text, y, seed in zip(texts, b.column(1).to_pylist(), b.column(2).to_pylist()):
                classes = table.of(words_of(text))
                whole = zlib.crc32(text, seed)
                for at in range(0, len(classes), WINDOW):
                    part = classes[at:at + WINDOW]
                    if len(part) < WINDOW and at:
                        part = classes[-WINDOW:]
                    part = part + [0] * (WINDOW - len(part))
                    h = zlib.crc32(at.to_bytes(8, "little"), whole)
                    if any(part):
                        rows.append((h, 1.0, part, [int(bool(y and c)) for c in part]))
                    elif h % NEUTRAL_EVERY == 0:
                        rows.append((h, float(NEUTRAL_EVERY), part, [0] * WINDOW))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())))], names=["h", "weight", "classes", "tags"])
    return run


def train_field(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", label_col: str = "toxic",
                text_col: str = "text") -> Field:
    """The fitted field; ``train`` tells the rows of ``docs`` whose labels may be used."""
    rows = _labelled(docs, labels, train, id_col, label_col, text_col)
    freq = rows.mapInArrow(_document_frequencies, "word binary, clean bigint, toxic bigint, sketches bigint") \
        .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.bit_or("sketches").alias("sketches")) \
        .filter((F.col("toxic") >= MIN_DF) & (F.bit_count("sketches") >= MIN_SPREAD))
    freq = written(freq, "words")  # the documents themselves are counted under the empty word
    both = freq.filter(F.length("word") == 0).select(F.col("clean").alias("n0"), F.col("toxic").alias("n1"))
    d = freq.filter(F.length("word") > 0).join(F.broadcast(both), F.lit(True))  # one row
    z = (F.col("toxic") / F.col("n1") - F.col("clean") / F.col("n0")) / F.sqrt(
        (F.col("toxic") + F.col("clean")) / (F.col("n0") + F.col("n1")) * (1 / F.col("n0") + 1 / F.col("n1")))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("n1") + 1)) - F.log((F.col("clean") + 0.5) / (F.col("n0") + 1))
    words = (d.filter("n0 > 0 and n1 > 0").select("word", z.alias("z"), odds.alias("odds"), (F.col("toxic") / F.col("n1")).alias("share"))
             .filter((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_LOG_ODDS))
             .orderBy(F.col("z").desc(), "word").limit(MAX_LEXICON).collect())
    lexicon = {bytes(r["word"]): strength(r["odds"], r["share"]) for r in words}
    if not lexicon:
        return Field()
    windows = written(rows.mapInArrow(_windows(lexicon), "h bigint, weight double, classes array<bigint>, tags array<bigint>"), "windows")
    # a hash share of about MAX_WINDOWS first, so that no task sends more than its part of the sample to the driver
    n = windows.count()
    if n > MAX_WINDOWS:
        windows = windows.filter(F.col("h") < F.lit(int(2 ** 32 * (MAX_WINDOWS + 4 * math.sqrt(MAX_WINDOWS)) / n)))
    sample = windows.orderBy("h", "weight", "classes", "tags").limit(MAX_WINDOWS).collect()
    model = fit(np.array([r["classes"] for r in sample]), np.array([r["tags"] for r in sample]), np.array([r["weight"] for r in sample]))
    model.lexicon = lexicon
    steps = rows.mapInArrow(_evidence(model), "tenths bigint, toxic bigint") \
        .groupBy("tenths").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).collect()  # a few hundred steps
    model.curve = fit_curve(*(np.array([r[c] / d for r in steps], float) for c, d in (("tenths", 10), ("toxic", 1), ("n", 1))))
    return model


class Tagger:
    """Exact marginals of the tokens that have a non-neutral feature."""

    def __init__(self, model: Field):
        self.model = model
        neutral = float(model.own[0] + model.left[0] + model.right[0])
        self.pair = np.exp(model.pair)
        step = self.pair * np.array([1.0, math.exp(neutral)])  # from a tag over a neutral token to the next tag
        values, vectors = np.linalg.eig(step)
        top = int(np.argmax(values.real))
        back = np.linalg.inv(vectors)
        self.ratio = float((values[1 - top] / values[top]).real)
        self.parts = [np.real(np.outer(vectors[:, k], back[k])) for k in (top, 1 - top)]
        self.start = np.array([1.0, math.exp(neutral)])
        self.plain = float(self.parts[0][1, 1])  # marginal inside a long neutral run

    def _over(self, k: int) -> np.ndarray:
        """Transfer over k neutral tokens, scaled."""
        return self.parts[0] + self.ratio ** k * self.parts[1]

    def marginals(self, classes: list[int]) -> tuple[list[int], list[float]]:
        """Places with a non-neutral feature and their marginals."""
        n = len(classes)
        hits = [i for i, c in enumerate(classes) if c]
        places = sorted({j for i in hits for j in (i - 1, i, i + 1) if 0 <= j < n})
        if not places:
            return [], []
        m = self.model
        at = lambda i: classes[i] if 0 <= i < n else 0
        emit = [np.array([1.0, math.exp(m.own[at(i)] + m.left[at(i - 1)] + m.right[at(i + 1)])]) for i in places]
        fwd = []
        for k, i in enumerate(places):
            if k:
                gap = i - places[k - 1] - 1
                a = fwd[-1] @ self._over(gap) @ self.pair * emit[k]
            elif i == 0:
                a = emit[k]
            else:
                a = self.start @ self._over(i - 1) @ self.pair * emit[k]
            fwd.append(a / a.sum())
        b = self._over(n - 1 - places[-1]) @ np.ones(2)
        out = [0.0] * len(places)
        for k in range(len(places) - 1, -1, -1):
            p = fwd[k] * b
            out[k] = float(p[1] / p.sum())
            if k:
                b = self._over(places[k] - places[k - 1] - 1) @ (self.pair @ (emit[k] * b))
                b = b / b.sum()
        return places, out


def log_evidence(marginals: list[float], plain: float) -> float:
    """Logarithm of a document's evidence."""
    sure = [p for p in marginals if p >= DOUBT] or [max([plain, *marginals])]
    return math.log(sum(-math.log1p(-min(p, 1 - 1e-12)) for p in sure) + 1e-9)


def probability(x: float, curve: tuple[float, float]) -> float:
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, curve[0] * x + curve[1]))))


def fit_curve(x: np.ndarray, toxic: np.ndarray, n: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Logistic slope and level for n documents at x of which ``toxic`` are toxic, by damped Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((toxic - n * p) * x).sum() - ridge * a, (toxic - n * p).sum() - ridge * b])
        w = n * p * (1 - p)
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + ridge]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a, 0.0)), float(b)


def _evidence(model: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger, table = Tagger(model), Classes(model.lexicon)
        for b, texts in blocks(batches, 0):
            x = [round(10 * log_evidence(tagger.marginals(table.of(words_of(t)))[1], tagger.plain)) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), b.column(1).cast(pa.int64())], names=["tenths", "toxic"])
    return run


def score_documents(docs: DataFrame, model: Field, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus score, predicted and spans (offending tokens in code points, end exclusive)."""
    cols = keep_others(docs, ["score", "predicted", "spans"])
    at = cols.index(text_col)
    src = docs.select(*[quoted(c) for c in cols])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_LEXICON words at most
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value.lexicon else None
        table = Classes(shared.value.lexicon)
        for b, texts in blocks(batches, at):
            scores, spans = [], []
            for text in texts:
                words = words_of(text) if tagger else []
                classes = table.of(words)
                if not words:
                    scores.append(0.0)
                    spans.append([])
                    continue
                places, p = tagger.marginals(classes) if any(classes) else ([], [])
                scores.append(probability(log_evidence(p, tagger.plain), shared.value.curve))
                spans.append(offsets(text, [i for i, x in zip(places, p) if x >= 0.5]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(spans, span)],
                names=[*cols, "score", "predicted", "spans"])

    return src.mapInArrow(run, T.StructType([
        *src.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))]))


def offsets(text: bytes, places: list[int]) -> list[dict[str, int]]:
    """Code-point offsets of the words at ``places`` (ascending)."""
    if not places:
        return []
    wanted, out, chars, last = set(places), [], 0, 0
    for i, m in enumerate(_WORD.finditer(text)):
        if i in wanted:
            chars += len(text[last:m.start()].decode("utf-8", "replace"))
            end = chars + len(m[0].decode("utf-8", "replace"))
            out.append({"start": chars, "end": end})
            chars, last = end, m.end()
    return out
