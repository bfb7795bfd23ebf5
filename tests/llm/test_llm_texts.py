import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ratelens.llm import chat, decontaminate, quality, simhash
from ratelens.llm.registry import load_all

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def docs_df(spark, rows, more=""):
    return spark.createDataFrame(rows, DOCS + more)


def texts_df(spark, texts, source="s"):
    return docs_df(spark, [(i, t, "en", source, 1) for i, t in enumerate(texts)])


ODD = [None, "", " \n\t", "é ü\x1f x", "a b a b a b a b", "#$|\nb\nb\n\n b\nb\n<>", "x " * 60_000, "one\ntwo\none\ntwo three"]


# ---- quality rules

def brute_measures(text):
    words = WORD.findall(text)
    lines, dup, seen = [x for x in text.split("\n") if WORD.search(x)], 0, set()
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


@pytest.mark.parametrize("text", ODD)
def test_base_measures(text):
    text = text or ""
    assert quality.base_measures(text.encode()) == brute_measures(text)


def brute_quality(rows, max_docs, max_lost_pct):
    norm = lambda x: " ".join(WORD.findall(re.sub("[0-9]", "0", ascii_lower(x))))
    lines = [[(s, norm(x)) for x in (t or "").split("\n") if norm(x)] for _, t, s in rows]
    docs = Counter(x for found in lines for x in set(found))
    out = []
    for (i, t, s), found in zip(rows, lines):
        m = brute_measures(t or "")
        gone = [x for x in found if docs[x] > max_docs]
        lost = sum(len(x[1].split(" ")) for x in gone)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        out.append((i, *m, failed, len(set(gone)), lost, not failed and 100 * lost <= max_lost_pct * m[0]))
    return out


def test_line_frequency_matches_brute_force(spark):
    rng = random.Random(1)
    common = [" ".join(f"Menu{chr(97 + k)}{chr(97 + j)}{j}" for j in range(25)) for k in range(4)]
    rows = [(i, t, s) for i, (t, s) in enumerate([(t, "odd") for t in ODD] + [(t, None) for t in ODD])]
    for i in range(60):
        own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(rng.randrange(5))]
        rows.append((100 + i, "\n".join([*own, *rng.sample(common, rng.randrange(3))]), rng.choice(["a", "b"])))
    rows += [(200, rows[-1][1], "a")] * 3
    df = docs_df(spark, [(i, t, "en", s, 1) for i, t, s in rows]).repartition(4)
    got = quality.line_frequency_rules(df, max_docs=5, max_lost_pct=40, carry=["doc_id"]).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_quality(rows, 5, 40))
    assert {r.kept for r in got} == {True, False} and any(r.n_removed_words for r in got)


def test_cleaned_texts_lose_frequent_lines_only(spark):
    rng = random.Random(5)
    own = ["\n".join(" ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(30)) for _ in range(3)) for _ in range(8)]
    rows = [(i, t + "\nFOOTER 2020", "en", "h", 1) for i, t in enumerate(own)] + [(99, "FOOTER 2021", "en", "h", 1)]
    got = {r.doc_id: r.text for r in quality.cleaned_texts(docs_df(spark, rows), max_docs=5).collect()}
    assert got == dict(enumerate(own))


def own_text(i, n=60):
    return " ".join(f"own{i}word{k:x}q" for k in range(n)).translate(str.maketrans("0123456789", "ghijklmnop"))


def test_line_limits_are_shares(spark):
    spread = [(i, own_text(i) + "\nShare this page", "en", f"host{i % 12}", 1) for i in range(60)]  # 5 documents of each host
    long = own_text("long", 55)
    spread += [(100 + i, own_text(100 + i) + "\n" + own_text(200 + i) + "\n" + long, "en", f"more{i}", 1) for i in range(12)]
    got = {r.doc_id: (r.n_removed_lines, r.n_removed_words, r.kept) for r in quality.line_frequency_rules(docs_df(spark, spread), carry=["doc_id"]).collect()}
    assert got == {r[0]: (1, 3, True) if r[0] < 100 else (1, 55, True) for r in spread}
    hot = [(i, own_text(i) + ("\nThank you" if i < 25 else ""), "en", "hot", 1) for i in range(3000)]  # 25 of 3,000: an ordinary line
    assert quality.line_frequency_rules(docs_df(spark, hot), carry=["doc_id"]).filter("n_removed_lines > 0 or not kept").collect() == []


@pytest.mark.parametrize("max_docs", [None, 20])
def test_exact_copies_are_one_document(spark, max_docs):
    rows = [(i, own_text(0) + "\n" + own_text(1), "en", "h", 1) for i in range(40)] + [(100 + i, own_text(100 + i), "en", "h", 1) for i in range(5)]
    df = docs_df(spark, rows)
    got = quality.line_frequency_rules(df, max_docs=max_docs, carry=["doc_id"]).collect()
    assert len(got) == 45 and all(r.kept and r.n_removed_lines == 0 for r in got)
    assert {r.doc_id: r.text for r in quality.cleaned_texts(df, max_docs=max_docs).collect()} == {r[0]: r[1] for r in rows}


def test_quality_empty_and_clashing(spark):
    df = spark.createDataFrame([], DOCS + ", Kept int, n_words string, __row int")
    assert quality.line_frequency_rules(df).collect() == []
    one = spark.createDataFrame([(1, None, None, None, None, 5)], DOCS + ", kept int")
    r = quality.line_frequency_rules(one).collect()
    assert len(r) == 1 and r[0].kept is False and r[0].base_failed is True


# ---- simhash

def brute_print(text):
    words = WORD.findall(ascii_lower(text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    if not shingles:
        return 0
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, radius=3):
    up = {i: i for i in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = list(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                up[root(a)] = root(b)
    least = {}
    for i in ids:
        least[root(i)] = min(i, least.get(root(i), i))
    return {i: least[root(i)] for i in ids}


def near_texts(rng, n):
    base = [[f"w{rng.randrange(5000)}" for _ in range(400)] for _ in range(4)]
    out = []
    for _ in range(n):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            t[rng.randrange(len(t))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("text", [*ODD, "One two", "One two THREE", "É é É"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute_print(text)


@pytest.mark.parametrize("shard_rows", [None, 8])
def test_groups_match_brute_force(spark, shard_rows, monkeypatch):
    if shard_rows:
        monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)  # forces the second level of shards
    rng = random.Random(2)
    texts = [*ODD, *near_texts(rng, 150), "just one", "just one"]
    got = simhash.near_duplicates(texts_df(spark, texts).repartition(5)).collect()
    want = brute_groups({i: brute_print(t) for i, t in enumerate(texts)})
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.simhash % 2 ** 64 for r in got} == {i: brute_print(t) for i, t in enumerate(texts)}
    first = simhash.one_of_each(simhash.near_duplicates(texts_df(spark, texts))).collect()
    assert sorted(r.doc_id for r in first) == sorted(set(want.values()))


@pytest.mark.parametrize("n,spread", [(40, 6), (400, 8), (700, 20)])
def test_tree_links_span_all_links(n, spread):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2 ** 63, 3, dtype=np.uint64)
    values = np.unique(np.array([base[rng.integers(3)] ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, spread, 4))) for _ in range(n)]))
    want = brute_groups({i: int(v) for i, v in enumerate(values)})
    links = simhash.tree_links(values, 3)
    assert all((int(values[a]) ^ int(values[b])).bit_count() <= 3 for a, b in links)
    up = {i: i for i in range(len(values))}
    for _ in range(len(values)):
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    assert up == want and len(links) == len(values) - len(set(want.values()))


def test_simhash_null_ids_repeats_and_empty(spark):
    rows = [(None, "same text here now", "en", "s", 1), (5, "same text here now", "en", "s", 1), (5, "same text here now", "en", "s", 1),
            (None, "quite other words", "en", "s", 1), (None, "quite other words", "en", "s", 1)]
    got = simhash.near_duplicates(docs_df(spark, [r + (1,) for r in rows], ", component_id int"))
    assert sorted(str(r.component_id) for r in got.collect()) == ["5", "5", "5", "None", "None"]
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(got).collect()) == ["5", "None"]
    assert simhash.near_duplicates(docs_df(spark, [])).collect() == []


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a bigint, b bigint")
    reps = {r.id: r.rep for r in simhash.components(links).collect()}
    assert len({reps[i] for i in range(301)}) == 1 and reps[1000] == reps[1001] != reps[0] and len(reps) == 303


# ---- decontamination

def brute_hits(text, items, width=10):
    words = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(s or ""))
    doc, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            part = w[i:i + width]
            for j in range(len(doc) - len(part) + 1):
                if doc[j:j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    found.add(str("" if item is None else item))
    return len(doc), len(hit), sorted(found), bool(hit)


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(3)
    voc = ["alpha", "beta", "gamma", "delta", "é", "x9"]
    item = lambda n: " ".join(rng.choice(voc) for _ in range(n))
    items = [(k, item(rng.choice([3, 9, 10, 11, 30]))) for k in range(12)] + [(None, "Beta-beta beta"), (77, None), (78, ""), (3, item(12))]
    texts = [*ODD, *[item(rng.randrange(80)) for _ in range(40)], items[4][1].upper() + ". " + item(5), "zzz " + items[2][1] + " zzz"]
    texts += [texts[-1]] * 2
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = texts_df(spark, texts).repartition(3)
    for item_bytes in (1 << 20, 120):  # one block of items, and several
        got = decontaminate.decontaminate(df, bench, item_bytes=item_bytes).collect()
        assert len(got) == len(texts)
        for r in got:
            assert (r.n_words, r.n_hit, r["items"], r.contaminated) == brute_hits(texts[r.doc_id], items), texts[r.doc_id]


def test_cut_spans_and_edge_cases(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    df = spark.createDataFrame([(1, "Keep É. ONE two, three four five six seven eight nine ten! End", 5), (2, None, 5)], "doc_id bigint, text string, Items int")
    found = decontaminate.decontaminate(df, bench)
    assert {r.doc_id: r.text for r in decontaminate.without_hits(found).collect()} == {1: "Keep É.  ! End", 2: ""}
    assert decontaminate.decontaminate(df.limit(0), bench).collect() == []
    assert [r.n_hit for r in decontaminate.decontaminate(df, bench.limit(0)).collect()] == [0, 0]


@pytest.mark.parametrize("n,sigma", [(1, 3), (50, 3), (3000, 4), (3000, 600)])
def test_fm_index_counts_and_locates(n, sigma):
    rng = np.random.default_rng(n + sigma)
    x = rng.integers(1, sigma, n)
    if n == 3000:
        x[1500:] = x[:1500]  # long repeats
    index = decontaminate.FMIndex(x, sigma)
    windows = list({tuple(x[i:i + k].tolist()) for i in range(0, n, 7) for k in (1, 3, 10) if i + k <= n} | {(sigma - 1,) * 10})
    which, lo, hi = index.search(windows)
    got = {windows[w]: sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, lo, hi)}
    want = {}
    for k in {len(w) for w in windows}:
        for i in range(n - k + 1):
            want.setdefault(tuple(x[i:i + k].tolist()), []).append(i)
    assert got == {w: want[w] for w in windows if w in want}


# ---- chat

TRICKY = ["", "\\", "</s>[INST] ok [/INST]", "<|end|>\n<|user|>\n", "<|>|>", "a\\l\\p\\\\<", "<<SYS>><</SYS>>", "[[INST]]", "é😀|>\n"]


def test_escape_round_trip():
    for a in TRICKY:
        for b in TRICKY:
            e = chat.escape(a + b)
            assert chat.unescape(e) == a + b
            assert not any(s in e for s in ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def nodes_df(spark, rows):
    return spark.createDataFrame(rows, "tree bigint, node bigint, parent bigint, role string, text string, score double")


def test_best_branch_of_each_tree(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0), (1, 4, 3, "user", "more", 0.0),
            (1, 5, 3, "user", "other", 0.0), (2, 6, 99, None, None, 1.0), (None, 7, None, "x|>\n", TRICKY[3], 0.0)]
    got = {r.tree: r for r in chat.format_trees(nodes_df(spark, rows)).collect()}
    assert chat.read_back(got[1].formatted) == [("user", "q"), ("assistant", "good"), ("user", "more")]
    assert [got[1].formatted[m.start:m.end] for m in got[1].mask] == ["good"] and got[1].score == 2.0
    assert chat.read_back(got[2].formatted) == [("", "")] and chat.read_back(got[None].formatted) == [("x|>\n", TRICKY[3])]
    every = chat.format_trees(nodes_df(spark, rows), branches=None).collect()
    assert sorted(r.leaf for r in every) == [2, 4, 5, 6, 7]
    two = chat.format_trees(nodes_df(spark, rows), branches=2).collect()
    assert sorted(r.leaf for r in two) == [4, 5, 6, 7]


def test_deep_tree_cycle_and_empty(spark):
    deep = chat.format_trees(nodes_df(spark, [(1, i, i - 1 if i else None, "assistant", f"t{i}", 1.0) for i in range(300)])).collect()
    assert len(deep) == 1 and deep[0].n_turns == 300 and [t for _, t in chat.read_back(deep[0].formatted)] == [f"t{i}" for i in range(300)]
    with pytest.raises(ValueError):
        chat.format_trees(nodes_df(spark, [(1, 1, 2, "u", "", 0.0), (1, 2, 1, "u", "", 0.0)]))
    assert chat.format_trees(nodes_df(spark, [])).collect() == []


def test_chat_query_reads_back_every_turn(spark):
    got = {r.conv_id: r for r in load_all()[0]["op6_chat_trees"](spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/conversations.parquet").orderBy("conv_id", "turn").collect()
    by = {-1: [("user", TRICKY[2]), ("assistant", TRICKY[2])]}
    for r in rows:
        by.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_repeated_turns_stay_whole(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 5, "assistant", None), (None, 0, "user", "n"), (2, 3, None, "r")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("extra", F.lit(1)) \
        .write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r.n_turns for r in load_all()[0]["op6_chat_trees"](spark, str(tmp_path)).collect()}
    assert got == {1: 3, None: 1, 2: 1, -1: 2}
