import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.llm import decontaminate, langid, lm, mixing, sharding, simhash, toxicity
from ratelens.llm.common import fold

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF01 = "/root/testdata/sf0.01"
LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# ---- language ID

def brute_bundle(text, dim, seed, gram):
    signs = []
    for c in text.lower():
        s = ord(c) if c.isalpha() else 0
        if s or (signs and signs[-1]):
            signs.append(s)
    if signs and signs[-1] == 0:
        signs.pop()
    signs = [0, *signs, 0] if signs else [0]
    v = np.zeros(dim)
    for i in range(len(signs) - gram + 1):
        one = np.ones(dim)
        for j in range(gram):
            one *= np.roll(langid.letter_vectors(np.array([signs[i + j]]), dim, seed)[0], gram - 1 - j)
        v += one
    return v


def test_bundles_match_brute_force():
    texts = ["Hello, World", "", "12 34", "a", "Straße  ÉÉ é", "x\0y", "aaaa aaaa", "日本語 text"]
    got = langid.GramCounts([t.encode() for t in texts], 3).bundles(len(texts), 128, 7)
    for t, v in zip(texts, got):
        want = brute_bundle(t, 128, 7, 3) if any(c.isalpha() for c in t) else None
        if want is not None:
            assert np.allclose(v, want), t


def test_language_held_out_accuracy_and_unknown(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    langs, proto = langid.train_prototypes(langid.training_rows(docs, fold("doc_id", 4) != 2))
    assert langs == ["de", "en", "es", "fr"]
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", None, None, None), (-3, "12 #!", None, None, None),
                                 (-4, "the thing " * 30_000, None, None, None)], DOCS)
    got = langid.identify(docs.filter(fold("doc_id", 4) == 2).unionByName(odd).withColumn("SCORE", F.lit(1)), langs, proto).collect()
    real = [r for r in got if r.doc_id >= 0]
    assert np.mean([r.lang == r.lang_pred for r in real]) > 0.98 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id < 0}
    assert by[-1] == by[-2] == by[-3] == ("und", 0.0) and by[-4][0] == "en"


def test_language_without_training_rows(spark):
    df = spark.createDataFrame([(1, "some text", None, "s", 1)], DOCS)
    langs, proto = langid.train_prototypes(df)
    assert langs == [] and [(r.lang_pred, r.score) for r in langid.identify(df, langs, proto).collect()] == [("und", 0.0)]
    assert langid.identify(df.limit(0), langs, proto).collect() == []


# ---- language model

def kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


def brute_ctw(train, texts, depth):
    """Plain recursion over all contexts, a dictionary of next-byte counts per context and no bound on contexts."""
    counts = {}
    for t in train:
        s = b"\0" * depth + t + b"\0"
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                counts.setdefault(s[i - d:i], Counter())[s[i]] += 1
    kids = {}
    for c in counts:
        if c:
            kids.setdefault(c[1:], []).append(c)

    def bits(c, prefix, k):
        n = [0, 0]
        for byte, m in counts.get(c, {}).items():
            if byte >> (8 - k) == prefix:
                n[byte >> (7 - k) & 1] += m
        return n

    memo = {}

    def weighted(c, prefix, k):
        if (c, prefix, k) not in memo:
            own = kt(*bits(c, prefix, k))
            memo[c, prefix, k] = own if c not in kids else np.logaddexp(
                own, sum(weighted(x, prefix, k) for x in kids[c])) - math.log(2)
        return memo[c, prefix, k]

    def one(context, prefix, k, d=0):
        c = context[len(context) - d:]
        n0, n1 = bits(c, prefix, k)
        p = (n1 + .5) / (n0 + n1 + 1)
        if c not in kids:
            return p
        stop = math.exp(kt(n0, n1) - math.log(2) - weighted(c, prefix, k))
        return stop * p + (1 - stop) * one(context, prefix, k, d + 1)

    out = []
    for t in texts:
        s, total = b"\0" * depth + t + b"\0", 0.0
        for i in range(depth, len(s)):
            for k in range(8):
                p = one(s[i - depth:i], s[i] >> (8 - k), k)
                total += math.log10(p if s[i] >> (7 - k) & 1 else 1 - p)
        out.append(total)
    return out


TRAIN = ["abracadabra abra", "the cat the hat", "", "é the É", "zz" * 20]
TEST = ["abra the", "", "qq é", "zzzz", "the cat the hat"]


def test_context_trees_match_brute_force(spark):
    rows = [(i, t, True) for i, t in enumerate(TRAIN)] + [(100 + i, t, False) for i, t in enumerate(TEST)] + [(200, None, False)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean").repartition(3)
    got = {r.doc_id: r for r in lm.score_texts(df, F.col("train")).collect()}
    low = [t.encode().translate(LOW) for t in TRAIN]
    want = brute_ctw(low, [t.encode().translate(LOW) for t in TEST], lm.DEPTH)
    for i, w in enumerate(want):
        assert abs(got[100 + i].score - w) < 1e-4, TEST[i]
    assert got[200].score == got[101].score and got[200].n_tokens == 1


@pytest.mark.parametrize("head", [500_000, 40])
def test_context_trees_hold_every_context(spark, head, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_GRAMS", head)  # 40: most grams take the join
    monkeypatch.setattr(lm, "_GROUP_ROWS", 500)  # several blocks of groups in a task
    rng = random.Random(8)
    train = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789-+*/", k=3000)) for _ in range(5)]
    contexts = {s[i - d:i] for t in train for s in ["\0" * lm.DEPTH + t + "\0"] for i in range(lm.DEPTH, len(s)) for d in range(1, lm.DEPTH + 1)}
    assert len(contexts) > 32_768
    test = [train[0][50:57], "qzqz", train[2][:6], train[0][50:57]]
    rows = [(i, t, True) for i, t in enumerate(train)] + [(100 + i, t, False) for i, t in enumerate(test)] + [(200, test[0], None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean").repartition(3)
    got = {r.doc_id: r.score for r in lm.score_texts(df, F.col("train")).collect()}
    want = brute_ctw([t.encode() for t in train], [t.encode() for t in test], lm.DEPTH)
    for i, w in enumerate(want):
        assert abs(got[100 + i] - w) < 1e-6, test[i]
    assert abs(got[200] - got[100]) < 1e-9 and abs(got[103] - got[100]) < 1e-9


@pytest.mark.parametrize("contexts", [1, 7, 10_000])
def test_probabilities_of_the_next_byte_sum_to_one(contexts):
    key, n = lm._grams([t.encode() for t in TRAIN])
    held, counts = [(0, 0)], []
    for d in range(1, lm.DEPTH + 1):
        c = Counter()
        for k, m in zip((key >> 8 & (1 << 8 * d) - 1).tolist(), n.tolist()):
            c[k] += m
        counts += [(d, k, m) for k, m in c.items()]
    least = lm.threshold(list(Counter(m for _, _, m in counts).items()), contexts)
    held += sorted((d, k) for d, k, m in counts if m >= least)
    assert len(held) - 1 <= contexts
    table = lm.room(held)
    for i, (d, c) in enumerate(held):
        mine = (key >> 8 & (1 << 8 * d) - 1) == c
        np.add.at(table[i], key[mine] & 255, n[mine])
    trees = lm.weighted_trees(held, table)
    leaves = trees.walk[:, 0] == np.arange(len(trees.walk))
    assert np.allclose((10.0 ** trees.code[leaves].astype(float)).sum(axis=1), 1, atol=1e-5)


@pytest.mark.parametrize("head", [500_000, 3])
def test_word_base_matches_brute_force(spark, head, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", head)  # 3: most words take the join
    rng = random.Random(4)
    texts = [None, "", " \n", "A a a"] + [" ".join(f"W{min(int(rng.expovariate(.1)), 60)}" for _ in range(rng.randrange(60))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, Score string").repartition(4)
    train = fold("doc_id", 5) != 1
    got = lm.score_texts(df, train).collect()
    tokens = [(t or "").encode().translate(LOW).split() for t in texts]
    learned = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for i in learned for w in [*tokens[i], None])
    n, v = sum(c.values()), len(c)
    assert len(got) == len(texts)
    for r in got:
        mine = [*tokens[r.doc_id], None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(mine), sum(c[w] > 0 for w in mine), n)
        assert abs(r.base_score - sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in mine)) < 1e-9


def test_language_model_without_rows(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id bigint, text string")
    r = lm.score_texts(df, F.lit(False)).collect()
    assert (r[0].n_known, r[0].train_tokens, r[0].base_score) == (0, 0, 0.0) and abs(r[0].score - 24 * math.log10(.5)) < 1e-5
    assert lm.score_texts(df.limit(0), F.lit(True)).collect() == []


# ---- toxicity

def test_forward_backward_and_run_skipping_match_enumeration():
    rng = np.random.default_rng(1)
    model = toxicity.Field(own=rng.normal(size=9), left=rng.normal(size=9), right=rng.normal(size=9), pair=rng.normal(size=(2, 2)))
    for classes in ([0, 3, 0, 0, 0, 5, 0], [2], [0, 0, 0, 0, 0, 0, 1], [4, 4, 0, 0, 0, 0, 0, 0, 0, 7]):
        e = model.emission(np.array([classes]))[0]
        n = len(classes)
        weight = np.zeros(2 ** n)
        for y in range(2 ** n):
            tags = [y >> i & 1 for i in range(n)]
            weight[y] = math.exp(sum(e[i] * t for i, t in enumerate(tags)) + sum(model.pair[a, b] for a, b in zip(tags, tags[1:])))
        exact = [sum(weight[y] for y in range(2 ** n) if y >> i & 1) / weight.sum() for i in range(n)]
        log_z, marginal, joint = toxicity.forward_backward(e[None], model.pair)
        assert np.allclose(marginal[0], exact) and abs(log_z[0] - math.log(weight.sum())) < 1e-9 and abs(joint.sum() - (n - 1)) < 1e-9
        places, p = toxicity.Tagger(model).marginals(classes)
        assert np.allclose(p, [exact[i] for i in places]) and {i for i, c in enumerate(classes) if c} <= set(places)


def test_toxicity_held_out_and_offsets(spark):
    rng = random.Random(6)
    clean = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(clean) for _ in range(rng.randrange(20, 200))]
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["Idiot!", "scum", "moronä"]))
        rows.append((i, "É " + " ".join(words), "en", "s", 1))
        labels.append((i, 0, int(toxic)))
    labels += [(0, 0, None), (None, 0, 1)]
    rows += [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "...", "en", "s", 0), (9004, "w1 " * 60_000 + "scum scum", "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("Spans", F.lit(0))
    y = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.train_field(df, y, fold("doc_id", 5) != 0)
    got = {r.doc_id: r for r in toxicity.score_documents(df, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == (i % 5 == 0) for i in held]) > 0.97
    assert got[9001].score == got[9002].score == got[9003].score == 0 and got[9004].predicted == 1
    found = {rows[i][1][s.start:s.end].lower() for i in held for s in got[i].spans}
    assert found == {"idiot", "scum", "moronä"}


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    y = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train_field(df, y, F.lit(True))
    assert [(r.score, r.predicted) for r in toxicity.score_documents(df, model).collect()] == [(0.0, 0)]
    assert toxicity.score_documents(df.limit(0), model).collect() == []


# ---- the pipeline

def test_pipeline_shards_keep_the_mix_and_part_copies(spark):
    import corpus_pipeline as cp
    rows = [(i, f"text {i}", "en", f"s{i // 200}", 8) for i in range(600) for _ in range(3)] + [(None, None, None, None, None)] * 2
    got = cp.shards(spark, spark.createDataFrame(rows, DOCS).repartition(4), SF01).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows) and set(got[0].asDict()) == {
        "doc_id", "text", "lang", "source", "n_chars", "size", "text_crc32", "shard", "slot"}
    place = {(r.shard, r.slot): r.doc_id for r in got}
    assert len(place) == len(rows)
    for s in range(cp.N_SHARDS):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert all(45 <= n <= 105 for n in (sum(r.source == f"s{k}" for r in mine) for k in range(3)))  # 75 expected
    assert sum(place.get((s, k + 1)) == d for (s, k), d in place.items()) < 10
    again = cp.shards(spark, spark.createDataFrame(rows[::-1], DOCS).repartition(7), SF01).collect()
    assert {(r.shard, r.slot): r.doc_id for r in again} == place


def test_pipeline_stages_match_brute_force(spark):
    import corpus_pipeline as cp
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_duplicates", "decontamination", "source_mix", "sharding"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "src0", 0), (-3, "42 !!", "en", "src0", 5)], DOCS)
    one = cp.language_id(spark, docs.unionByName(odd), SF01)
    assert one.columns == docs.columns
    kept = {r.doc_id: r for r in one.collect()}
    assert not {-1, -2, -3} & set(kept) and sum(r.text is not None and len(r.text) > 200 for r in docs.collect()) <= len(kept)

    two = cp.near_duplicates(spark, spark.createDataFrame(list(kept.values()), docs.schema), SF01)
    prints = {i: simhash.fingerprint(r.text.encode()) for i, r in kept.items()}
    ids, up = list(prints), {i: i for i in prints}
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, z = a, b
                while up[x] != x:
                    x = up[x]
                while up[z] != z:
                    z = up[z]
                up[max(x, z)] = min(x, z)
    assert sorted(r.doc_id for r in two.collect()) == sorted(i for i in ids if up[i] == i)

    three = cp.decontamination(spark, two, SF01)
    hits = decontaminate.decontaminate(two, spark.read.parquet(f"{SF01}/benchmark.parquet")).collect()
    assert three.columns == docs.columns
    clean = sorted(r.doc_id for r in hits if not r.contaminated)
    assert sorted(r.doc_id for r in three.collect()) == clean and 0 < len(clean) < len(hits)

    four = cp.source_mix(spark, three, SF01)
    again = mixing.poisson_mix(three, cp.MIX_WEIGHTS, cp.MIX_SEED).collect()
    assert four.columns == docs.columns and [r.doc_id for r in four.collect()] == [r.doc_id for r in again]

    five = cp.shards(spark, four, SF01).collect()
    assert Counter(r.doc_id for r in five) == Counter(r.doc_id for r in again)
    sizes = Counter()
    for r in five:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in five)
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF01).collect() == []
    assert sharding.OUT


def test_pipeline_keeps_columns_named_like_an_operators(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(120)
    names = ["lang_pred", "score", "simhash", "component_id", "is_first", "first", "n_words", "n_hit", "items", "contaminated", "copies", "copy",
             "shuffle_key", "size", "text_crc32", "shard", "slot", "__row", "__order", "a.b", "Score2"]
    own = docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id")).alias(n) for n in names])
    plain, mine = docs, own
    for name, stage in cp.STAGES:
        plain, mine = stage(spark, plain, SF01), stage(spark, mine, SF01)
        if name == "sharding":
            names = [f"own_{n}" if n in cp.ADDED else n for n in names]
        else:
            assert mine.columns == own.columns
        got = mine.collect()
        assert got and sorted(map(tuple, mine.select(plain.columns).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        for r in got:
            for n in names:
                assert r[n] == f"{n.removeprefix('own_')}:{r.doc_id}"
        plain, mine = (spark.createDataFrame(x.collect(), x.schema) for x in (plain, mine))


def test_windows_of_texts_with_one_beginning_are_drawn_apart():
    """The training sample's hash sees the whole text and the document."""
    import pyarrow as pa
    shared = b"same header words " * 400
    texts = [shared + b"neutral tail %d " % k * 40 for k in range(300)]

    def drawn(texts, seeds):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array([0] * len(texts)), pa.array(seeds, pa.int64())], names=["text", "toxic", "seed"])
        return sum(b.num_rows for b in toxicity._windows({b"absent": 1})(iter([batch])))
    one = drawn(texts[:1], [5])
    n = sum(drawn([t], [k]) > 0 for k, t in enumerate(texts))
    assert 0 < n  # windows of the shared beginning do not all enter or leave together
    assert len({drawn([t], [k]) for k, t in enumerate(texts)}) > 1 and len({drawn(texts[:1], [k]) for k in range(100)}) > 1 and one >= 0
