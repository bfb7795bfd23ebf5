import math
import re
import zlib
from hashlib import md5, sha256

import pytest

from ratelens.llm import mixing, pii, sharding
from ratelens.llm.queries import PII_BASE_SQL
from ratelens.llm.registry import load_all

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF01 = "/root/testdata/sf0.01"


def docs_df(spark, rows, more=""):
    return spark.createDataFrame(rows, DOCS + more)


# ---- mixing

def brute_copies(rows, weights, seed):
    total, by = 0, {}
    for i, text, source in rows:
        g = source if source in weights else None
        size = len((text or "").encode()) + 1
        by[g] = by.get(g, 0) + size
        total += size
    out = {}
    for i, text, source in rows:
        g = source if source in weights else None
        w = weights[g] if g is not None else 1 - sum(weights.values())
        rate = w * total / by[g]
        u = int(md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        k, p, cdf = 0, math.exp(-rate), 0.0
        while True:
            cdf += p
            if u < cdf or k > 1000:
                break
            k += 1
            p *= rate / k
        out[i] = k
    return out


def test_mix_draws_poisson_counts_and_sorts_globally(spark):
    rows = [(i, "x" * (i % 50), "en", ["a", "b", "c", None][i % 4], 1) for i in range(400)]
    weights = {"a": 0.6, "b": 0.1}
    got = mixing.poisson_mix(docs_df(spark, rows), weights, seed=3).collect()
    want = brute_copies([(r[0], r[1], r[3]) for r in rows], weights, 3)
    count = {}
    for r in got:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
        assert r.copies == want[r.doc_id] and 1 <= r.copy <= r.copies
    assert count == {k: v for k, v in want.items() if v}
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)


def test_mix_reaches_the_target_shares(spark):
    rows = [(i, "abcdefghi", "en", "hot" if i % 3 else "cold", 1) for i in range(6000)]
    got = mixing.poisson_mix(docs_df(spark, rows), {"hot": 0.5, "cold": 0.5}, seed=1).groupBy("source").count().collect()
    n = {r.source: r["count"] for r in got}
    assert abs(n["hot"] - 3000) < 250 and abs(n["cold"] - 3000) < 250


def test_mix_edge_cases(spark):
    assert mixing.poisson_mix(docs_df(spark, []), {"a": 1.0}, 1).collect() == []
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "y" * 300_000, "en", "a", 1)]
    df = spark.createDataFrame([r + (7, 8) for r in rows], DOCS + ", copy int, Shuffle_Key int")
    got = mixing.poisson_mix(df, {"a": 1 - 1e-6}, seed=5, target_bytes=2_000_000).collect()
    assert {r.doc_id for r in got} <= {None, 1, 2} and any(r.doc_id == 2 for r in got)
    assert sum(r.doc_id == 1 for r in got) % 2 == 0  # repeated rows draw the same count
    assert set(got[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", "copies", "copy", "shuffle_key"}
    with pytest.raises(ValueError):
        mixing.poisson_mix(df, {"a": 1.5}, 1)
    big = mixing.poisson_mix(docs_df(spark, [(i, "z", "en", "a", 1) for i in range(20)]), {"a": 1.0}, 1, target_bytes=40_000)
    assert abs(big.count() - 20_000) < 1_000  # a rate of 1000 does not underflow


# ---- sharding

def brute_shards(rows, n):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode())))
    total = sum(len((t or "").encode()) + 1 for _, t in order)
    at, out, slots = 0, [], {}
    for i, t in order:
        size = len((t or "").encode()) + 1
        s = (2 * at + size) * n // (2 * total)
        out.append((i, size, s, slots.get(s, 0)))
        slots[s] = slots.get(s, 0) + 1
        at += size
    return out


def key(r):
    return tuple((x is None, x) if not isinstance(x, tuple) else x for x in r)


def test_shards_match_brute_force_and_balance(spark):
    rows = [(i // 2, "é" * (i * 37 % 101)) for i in range(500)] + [(None, None), (None, "x" * 900), (7, "")]
    df = docs_df(spark, [(i, t, "en", "s", 1) for i, t in rows]).repartition(5)
    got = sharding.shard_by_bytes(df, 8).collect()
    assert sorted(((r.doc_id, r["size"], r.shard, r.slot) for r in got), key=key) == sorted(brute_shards(rows, 8), key=key)
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_shards_edge_cases(spark):
    assert sharding.shard_by_bytes(docs_df(spark, []), 8).collect() == []
    df = spark.createDataFrame([(3, "a" * 200_000, 1, 2), (3, "a" * 200_000, 1, 2)], "doc_id bigint, text string, Shard int, slot int")
    got = sharding.shard_by_bytes(df, 2).collect()
    assert sorted(r.shard for r in got) == [0, 1] and [r.slot for r in got] == [0, 0]
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(df, 0)


@pytest.mark.parametrize("seed", [None, 3])
def test_shards_move_texts_once_and_not_through_python(spark, monkeypatch, seed):
    rows = [(None if i % 11 == 0 else i % 40, None if i % 9 == 0 else "w" * (i % 13), i) for i in range(400)]
    rows += [(7, "copy", 1000)] * 60
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, own int")
    kept, write = [], sharding.written
    monkeypatch.setattr(sharding, "written", lambda df, name: (kept.append(df.columns), write(df, name))[1])
    out = sharding.shard_by_bytes(docs, 4, seed=seed)
    assert kept and not any({"text", "own"} & set(c) for c in kept)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("RepartitionByExpression") == 1
    got = out.collect()
    assert sorted((str(r.doc_id), str(r.text), r.own) for r in got) == sorted((str(a), str(b), c) for a, b, c in rows)
    assert all(r.size == len(r.text or "") + 1 for r in got)
    for k in range(4):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    half = sum(r.size for r in got) / 4
    assert all(abs(sum(r.size for r in got if r.shard == k) - half) <= 14 for k in range(4))


def test_number_rows(spark):
    df = spark.createDataFrame([(x * 7 % 50,) for x in range(50)], "k bigint").repartition(7)
    assert sorted((r.k, r.row) for r in sharding.number_rows(df, ["k"]).collect()) == [(i, i) for i in range(50)]


# ---- personal data

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(d):
    s = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern, ok in (
            ("email", EMAIL, lambda m: True),
            ("ip", IP, lambda m: all(int(x) <= 255 for x in m.split("."))),
            ("card", CARD, lambda m: 13 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m))),
            ("phone", PHONE, lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if ok(m[0])]
    return out


TEXTS = [
    None, "", "a@b", "é😀 mail me: a.b+c@x-y.example.com, or q@r.s_t@u.v", "a@b.c.d@e.f @@ x@.y", "1.2.3.4 1.2.3.256 1.2.3.4.5.6.7.8.9",
    "007.000.0001.255 99999999999999999999999.1.1.1", "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111110000000000000",
    "4--111 1 1111111111111 5500005555555559 ", "call +1 (555) 010-2030. or +12 or +1......... +49 30 1234567890123456 +1 +2 (3) 4-5.6 78 90",
    "x" * 300 + "@" + "y" * 300 + ".zz", "1 " * 30, "1.1.1.1" * 3, "a@b.c" * 4, "+++1 234 567 890+1 234 567 8901",
]


def test_base_spans_match_brute_force(spark):
    got = pii.find_pii(docs_df(spark, [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)])).collect()
    for r in got:
        mine = [(s.kind, s.start, s.end) for s in r.spans if s.kind != "iban"]
        assert mine == brute_spans(TEXTS[r.doc_id] or ""), TEXTS[r.doc_id]
        assert all((TEXTS[r.doc_id])[s.start:s.end] == s.text and 0 < s.score <= 1 for s in r.spans)


def test_mod97_and_context(spark):
    texts = ["IBAN: GB82 WEST 1234 5698 7654 32.", "GB82WEST12345698765433", "my card is 4111111111111111", "n 4111111111111111"]
    got = {r.doc_id: r.spans for r in pii.find_pii(docs_df(spark, [(i, t, "", "", 1) for i, t in enumerate(texts)])).collect()}
    assert [(s.kind, s.start, s.end) for s in got[0] if s.kind == "iban"] == [("iban", 6, 33)]
    assert not [s for s in got[1] if s.kind == "iban"]
    assert got[2][0].score > got[3][0].score
    assert pii.find_pii(docs_df(spark, [(0, texts[3], "", "", 1)]), min_score=0.8).first().spans == []


def test_very_long_runs_neither_overflow_nor_stall(spark):
    n = 100_000
    texts = ["7" * n, "1 " * n, "a" * n, "a@b" + ".c" * n, "1" * n + ".1.1.1", "+1" + " " * n, "+1" + "(" * n + "2", "a." * n + "@b.c"]
    got = {r.doc_id: r.spans for r in pii.find_pii(docs_df(spark, [(i, t, "", "", 1) for i, t in enumerate(texts)])).collect()}
    for i in (0, 1, 2, 4, 5):
        assert got[i] == []
    assert [(s.start, s.end) for s in got[3]] == [(0, len(texts[3]))] and [(s.start, s.end) for s in got[7]] == [(0, len(texts[7]))]


def test_pii_query_matches_sql_and_digest(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    cur = con.execute(PII_BASE_SQL)
    names = [d[0] for d in cur.description]
    want = {r[0]: dict(zip(names, r)) for r in cur.fetchall()}
    got = load_all()[0]["op5_pii_spans"](spark, SF01).collect()
    assert len(got) == len(want) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got) > 20
    for r in got:
        assert {n: r[n] for n in names} == want[r.doc_id]
        assert sha256(",".join(x for x in r.spans.split(",") if not x.startswith("iban")).encode()).hexdigest() == r.base_sha256


def test_pii_empty_table_and_clashing_column(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, SPANS int, __text int")
    out = pii.find_pii(df)
    assert out.collect() == [] and out.columns == ["doc_id", "text", "spans"]


def test_pii_context_is_whole_words_on_both_sides(spark):
    texts = ["trip 10.2.3.4 done", "our ip 10.2.3.4 done", "hotel +49 30 1234567 x", "tel +49 30 1234567 x", "4111111111111111 is my card",
             "4111111111111111 is my cardboard", "card: 4111111111111111, 4111111111111111", "card " + "y" * 60 + " 4111111111111111"]
    got = pii.find_pii(docs_df(spark, [(i, t, "", "", 1) for i, t in enumerate(texts)])).collect()
    score = {r.doc_id: [round(s.score, 2) for s in r.spans if s.kind in ("ip", "card", "phone")] for r in got}
    assert score == {0: [0.5], 1: [0.7], 2: [0.5], 3: [0.7], 4: [0.9], 5: [0.7], 6: [0.9, 0.9], 7: [0.7]}
