import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from ratelens.llm import pages, repair, spelling
from ratelens.llm.queries_repair import REPAIR_SQL, SPELLING_SQL
from ratelens.llm.registry import load_all

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


# ---- pages: trees

def plain_matching(a, b):
    """Simple tree matching by its recursive definition."""
    if a[0] != b[0]:
        return 0

    def forest(x, y):
        if not x or not y:
            return 0
        return max(forest(x[:-1], y), forest(x, y[:-1]), forest(x[:-1], y[:-1]) + plain_matching(x[-1], y[-1]))
    return 1 + forest(a[1], b[1])


def random_tree(rnd, depth=3):
    return [rnd.choice("ab"), [random_tree(rnd, depth - 1) for _ in range(rnd.randrange(4) if depth else 0)], 0]


def test_tree_matching_equals_its_definition():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = random_tree(rnd), random_tree(rnd)
        a[0] = b[0] = "r"
        n, pairs = pages.match(a, b)
        assert n == plain_matching(a, b)

        def count(x, y, found):
            assert x[0] == y[0]
            assert [p[:2] for p in found] == sorted(p[:2] for p in found)
            return 1 + sum(count(x[1][i], y[1][j], inner) for i, j, inner in found)
        assert count(a, b, pairs) == n


def test_merged_wrapper_holds_every_shape():
    rnd = random.Random(3)
    shapes = [random_tree(rnd) for _ in range(12)]
    for s in shapes:
        s[0] = "r"
    wrapper = pages.tree_of(pages.written_tree(shapes[0]))
    for s in shapes[1:]:
        pages.merge(wrapper, pages.tree_of(pages.written_tree(s)))
    size = len(pages.json.loads(pages.written_tree(shapes[-1]))[0])
    assert plain_matching(wrapper, shapes[-1]) == size  # nothing of the last one is unpaired


# ---- pages: extraction

PAGES = "page_id bigint, url string, html string"
NOUNS = "river stone garden window market castle forest bridge harbour meadow lantern valley".split()


def prose(rnd, n):
    return " ".join(rnd.choice(NOUNS) for _ in range(n)) + "."


def extract(spark, rows, more=""):
    return {r.page_id: r for r in pages.extract_main_text(spark.createDataFrame(rows, PAGES + more)).collect()}


def test_unnamed_layout_is_told_apart_by_the_host_s_pages(spark):
    rnd, rows, want = random.Random(5), [], {}
    for k in range(40):
        title, paras = prose(rnd, 6), [prose(rnd, 40) for _ in range(rnd.randrange(2, 6))]
        body = "".join(f"<p>{p}</p>" for p in paras)
        if k % 2:
            body = body.replace("</p>", "</p><p>Subscribe to our letter for more of this.</p>", 1)
        links = "".join(f'<li><a href="/{rnd.random()}">{rnd.choice(NOUNS)}</a></li>' for _ in range(6))
        rows.append((k, "http://plain.example/a", f"<html><body><div>Plain Example Daily, the paper of record</div><div><ul>{links}</ul></div>"
                     f"<div><h1>{title}</h1>{body}</div><div>{prose(rnd, 4)}</div><div>All rights reserved &copy; Plain</div></body></html>"))
        want[k] = " ".join([title, *paras])
    got = extract(spark, rows)
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_copies_of_a_page_are_no_template(spark):
    rnd = random.Random(6)
    rows = [(k, "https://copies.example/x", "<body><article><h1>A title of it</h1><p>The same long text on all of these pages here.</p></article>"
             f"<footer>{prose(rnd, 5)}</footer></body>") for k in range(30)]
    assert {r.text for r in extract(spark, rows).values()} == {"A title of it The same long text on all of these pages here."}


FURNITURE = ('<header><h1>Site</h1></header><nav><a href="/">Home page</a></nav><aside>Side words</aside><div class="cookie-notice">We use them</div>'
             '<div id="ad-slot-3">Buy this</div><form><label>Your name</label><input></form><section class="comments"><article class="comment">'
             '<p>A very long and eager comment of a reader, longer than all the rest of the article on this page.</p></article></section>'
             '<div hidden>Hidden words</div><footer>Imprint</footer><script>var x = "<p>no</p>";</script><style>p{}</style><!-- <p>no</p> -->')


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("just words &amp; more", "just words & more"), ("<p>one<p>two", "one two"),
    (f"<body>{FURNITURE}<main><h1>Head</h1><p>a <b>bo</b>ld\n\t word&nbsp;&eacute;&#33;<br>next</p><ul><li>x<li>y</ul></main></body>",
     "Head a bold word é! next x y"),
    (f'<div class="page has-sidebar popup-ready">{FURNITURE}<article><header><h2>In it</h2></header><p>Body words</p><footer>by me</footer></article></div>',
     "In it Body words"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><p>end", "a b c end"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>cut</p", "cut"), ("<article><p>cut <a href='x", "cut"),
    ("<article><p>x</p><script>never ends <p>no</p>", "x"),
    ("<nav><a href='/'>only a menu</a></nav>", ""),
    ("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>", "deep"),
])
def test_one_page_by_its_names(spark, html, text):
    got = extract(spark, [(1, "http://one.example/", html)])
    assert got[1].text == text and got[1].n_chars == len(text)


def test_pages_edge_cases(spark):
    assert extract(spark, []) == {}
    long = "word " * 400_000
    rows = [(1, None, f"<article><p>{long}</p></article>", 7, "kept"), (1, None, f"<article><p>{long}</p></article>", 7, "kept"),
            (None, "no url", None, None, None)]
    got = pages.extract_main_text(spark.createDataFrame(rows, PAGES + ", n_chars int, __slots string")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, len(long) - 1), (1, len(long) - 1)]
    assert set(got[0].asDict()) == {"page_id", "url", "text", "n_chars"}  # clashing columns are replaced


def test_the_wrapper_does_not_depend_on_the_split(spark):
    rnd, rows = random.Random(8), []
    for k in range(300):  # more shapes than one merge takes
        parts = "".join(f"<{t}>{prose(rnd, 12)}</{t}>" for t in rnd.sample(["h2", "p", "blockquote", "pre", "h3", "dl", "ol", "figure"], rnd.randrange(1, 8)))
        rows.append((k, "http://many.example/", f"<body><div><div>{prose(rnd, 3)}</div><div>{parts}</div></div></body>"))
    df = spark.createDataFrame(rows, PAGES)
    one = {r.page_id: r.text for r in pages.extract_main_text(df.repartition(1)).collect()}
    assert one == {r.page_id: r.text for r in pages.extract_main_text(df.repartition(7, "page_id")).collect()}
    read = pages.parsed(df, ["page_id"], "url", "html")
    assert read.select("__shape").distinct().count() > pages.FAN_IN


def test_query_gives_the_articles(spark):
    import html as h
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    got = load_all()[0]["op11_wrapper_induction"](spark, SF01).collect()
    assert len(got) == len(rows)
    for r in got:
        article = re.search("<article>(.*?)</article>", rows[r.page_id], re.S).group(1)
        parts = [" ".join(h.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1|br)>", article)]
        assert r.text == " ".join(p for p in parts if p)


# ---- conversation repair

def cheapest(codes):
    """(cost, edits) by trying all edits."""
    best = [None]

    def go(i, state, cost, edits, inserted):
        if best[0] and cost > best[0][0]:
            return
        if i == len(codes) and state in (0, 3):
            best[0] = min(best[0] or (cost, edits), (cost, edits))
        after = 3 if state == 2 else 2
        if inserted < 3:
            go(i, after, cost + 5, edits + "I", inserted + 1)
        if i < len(codes):
            fault, initial = divmod(codes[i], 4)
            extra = 5 if fault == 3 else 0
            go(i + 1, state, cost + 2, edits + "D", 0)
            if fault in (0, 3):
                go(i + 1, after, cost + 1 + extra, edits + "R", 0)
                if (initial, state) in ((0, 0), (1, 0), (1, 1), (1, 3), (2, 2)):
                    go(i + 1, initial + 1, cost + extra, edits + "K", 0)
    go(0, 0, 0, "", 0)
    return best[0]


def test_reconstruction_is_cheapest_and_ascii_least():
    rnd = random.Random(1)
    for _ in range(400):
        codes = [rnd.randrange(16) for _ in range(rnd.randrange(6))]
        steps = [*(repair.ROW_STEPS[c] for c in codes), repair.END_STEP]
        states = repair.crossings(steps, 0, 0)
        taken = [s[a][b] for s, a, b in zip(steps, states, states[1:])]
        assert (sum(c for c, _ in taken), "".join(e for _, e in taken)) == cheapest(codes)


def test_segments_compose_to_the_whole():
    rnd = random.Random(4)
    for _ in range(60):
        codes = bytes(rnd.randrange(16) for _ in range(rnd.randrange(2, 60)))
        cuts = sorted(rnd.sample(range(1, len(codes)), min(3, len(codes) - 1)))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        states = repair.crossings([*(repair.segment_step(p) for p in parts), repair.END_STEP], 0, 0)
        whole = repair.crossings([*(repair.ROW_STEPS[c] for c in codes), repair.END_STEP], 0, 0)
        edits = "".join(repair.segment_edits(p, a, b) for p, a, b in zip(parts, states, states[1:]))
        assert edits == repair.segment_edits(codes, 0, whole[-2])


TURNS = "conv_id bigint, turn bigint, role string, text string"


def by_sql(rows, sql, name):
    con = duckdb.connect()
    con.register(name + "_arrow", rows.toArrow())
    con.sql(f"CREATE VIEW {name} AS SELECT * FROM {name}_arrow")
    return sorted(con.sql(sql).fetchall(), key=repr)


@pytest.mark.parametrize("segment", [4096, 3])
def test_repair_equals_sql(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rnd = random.Random(7)
    texts = ["Yes.", "No", "Why? ", " \t", "", None, "Well, then!\n", "same words."]
    roles = ["user", "assistant", "system", "tool", "", None, "ux"]
    rows = [(c, t, rnd.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rnd.choice(texts) if rnd.random() < .5 else f"text {c} {t}.")
            for c in [*range(60), None] for t in rnd.sample([*range(14), None], 9)]
    rows += rows[:40]  # repeated rows
    rows += [(77, t, "user" if t % 2 else "assistant", f"turn {t}{'.' * (t % 5)}") for t in range(900)]  # a long one
    df = spark.createDataFrame(rows, TURNS)
    clash = df.selectExpr("*", "1 AS row", "2 AS seg", "'q' AS code")
    got = repair.repair_report(clash, repair.damaged(clash)).collect()
    want = by_sql(df, REPAIR_SQL, "conversations")
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_repaired_rows_are_the_digests_rows(spark):
    rows = spark.read.parquet(f"{SF001}/conversations.parquet")
    hurt = repair.damaged(rows)
    _, edits, placed = repair.repair(hurt)
    text = {}
    for r in repair.repaired_rows(placed, edits).orderBy("row", "part").collect():
        text.setdefault(r["__conv"], []).append((r.role, r.text, r.edit))
    report = {f"={r.conv_id}": r for r in repair.repair_report(rows, hurt).collect()}
    for conv, r in report.items():
        said = text.get(conv, [])
        assert r.repaired_sha256 == sha256("\n".join(f"{a}:{b}" for a, b, _ in said).encode()).hexdigest()
        assert "".join(e for _, _, e in said) == r.audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(a[0] for a, _, _ in said))


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair.repair_report(empty, repair.damaged(empty)).collect() == []
    one = spark.createDataFrame([(5, t, "user", "x") for t in range(400) if zlib.crc32(f"5:{t}".encode()) % 20 == 0], TURNS)
    got = repair.repair_report(one, repair.damaged(one)).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


# ---- spelling variants

DOCS = "doc_id bigint, text string"


def words_of(rnd, n):
    return ["".join(rnd.choice("abeé") for _ in range(rnd.randrange(7, 10))) for _ in range(n)]


@pytest.mark.parametrize("cell, sample", [(8192, 200_000), (16, 200_000), (16, 60)])
def test_spelling_equals_sql(spark, cell, sample):
    rnd = random.Random(9)
    pool = words_of(rnd, 700)
    pool += [w[:3] + "z" + w[3:] for w in pool[:100]]
    freq = [int(1 + 400 * rnd.random() ** 8) for _ in pool]
    rows = [(d, " ".join(rnd.choices(pool, freq, k=60)).title() + " - " + rnd.choice(["shorts", "ÀÈÌ×÷øþÿ", "Ωmegaword", "long" * 60]))
            for d in [*range(150), None]]
    rows += [(3, None), (4, ""), *rows[:5]]
    for d, word, times, docs in ((1000, "abcdefghij", 40, 20), (2000, "abcdefghik", 20, 3), (3000, "abcdefgxik", 4, 1)):  # a path of two steps
        rows += [(d + k, f"{word} " * times) for k in range(docs)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS word", "'n' AS n")
    got = sorted((tuple(r) for r in spelling.spelling_variants(df, cell=cell, sample=sample).collect()), key=repr)
    want = by_sql(df.select("doc_id", "text"), SPELLING_SQL, "documents")
    assert got == want
    assert any(r[1] for r in got) and any(r[2] not in (r[0], r[1]) for r in got)


def test_box_pruning_loses_no_neighbour_and_visits_few_leaves():
    rnd = random.Random(11)
    words = sorted({"".join(rnd.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(6000)})
    letters = spelling.letters_of(words, 9)
    points = spelling.counts_of(letters)
    tree = spelling.Tree(points, spelling.LEAF)
    leaf_of = tree.home(points)
    reached = np.zeros((len(words), len(tree.leaves)), bool)
    for leaf, at in tree.reach(points, 1, 1):
        reached[at, leaf] = True
    for q in rnd.sample(range(len(words)), 200):
        close = np.abs(points.astype(int) - points[q]).sum(axis=1) <= 2
        assert reached[q, leaf_of[close]].all()
    assert reached.sum() < 0.25 * reached.size
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(words)))


def test_spelling_of_long_texts_and_long_words(spark, monkeypatch):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).collect() == []
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    giant = "x" * 3000
    text = " ".join(f"wordless{chr(97 + i % 26)}" for i in range(200_000)) + f" {giant} {giant}y {giant} {giant}y"
    want = Counter()
    for run in re.findall("[a-z]+", text):
        h = zlib.crc32(f"1:{run}".encode())
        want[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    got = {r.word: r for r in spelling.spelling_variants(spark.createDataFrame([(1, text)], DOCS)).collect()}
    assert {w: r.n for w, r in got.items()} == {w: n for w, n in want.items() if n >= 2 and len(w) >= 7}
    assert got["wordlessa"].n_near >= 24 and any(r.n_near == 1 for w, r in got.items() if len(w) > 100)


def test_pieces_cut_between_words(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE_BYTES", 40)
    text = "éèê words, and more words that follow one another in a line of text; unbroken" + "ß" * 60 + " end"
    parts = list(spelling.pieces(text.encode()))
    assert b"".join(parts) == text.encode() and len(parts) > 2
    assert [w for p in parts for w in re.findall(r"\w+", p.decode())] == re.findall(r"\w+", text)
