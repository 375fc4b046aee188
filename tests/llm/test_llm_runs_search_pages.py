"""Periodic runs, ranked search and page extraction: brute force, held-out layouts and odd inputs."""

import html
import itertools
import random
import re
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import dom, html_extraction, lexical_search, periodic_runs, queries
from tillroll.llm.common import schema_of
from tillroll.llm.page_layouts import Layout

SF = "/root/testdata/sf0.001"
EXTRA = ", id STRING, item INT, rank INT, score INT, runs INT, n INT, k0 INT, salt INT, html2 STRING"


# ---------------------------------------------------------------- periodic runs

def brute_runs(words, least=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, times * q):
                found.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def runs_of(docs, least, times):
    start = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    found = periodic_runs.find_runs(np.array(list(itertools.chain(*docs)), np.int64), start, least, times)
    out = [[] for _ in docs]
    for d, *run in zip(*(x.tolist() for x in found)):
        out[d].append(tuple(run))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 4)), max_size=4),
       st.sampled_from([2, 3, 5, 24]), st.sampled_from([2, 3]))
def test_runs_equal_brute_force(parts, least, times):
    docs = [words * n for words, n in parts]
    assert runs_of(docs, least, times) == [brute_runs(d, least, times) for d in docs]


def test_runs_of_long_documents():
    rng = random.Random(3)
    docs = [[0] * 5000, list(range(40)) * 100, [rng.randrange(3) for _ in range(3000)],
            [rng.randrange(50) for _ in range(500)] * 4]
    got = runs_of(docs, 24, 3)
    assert got[0] == [(0, 5000, 1)] and got[1] == [(0, 4000, 40)] and (0, 2000, 500) in got[3]
    for d, g in zip(docs[1:], got[1:]):
        assert g == brute_runs(d)


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs_of_odd_texts(spark):
    texts = [None, "", " \t\n ", "one", "a b " * 12, "a b " * 11 + "c", "Ünï 你好\x0b" * 30, "x " + "y\n" * 24 + "y",
             ("p q r " * 20 + "p q s ") * 8, "word " * 60_000, "<|im_end|> \x00 " * 30]
    rows = [(i, t, "en", "s", 0, *["z", *[7] * 7], "z") for i, t in enumerate(texts)]
    rows += [(None, "a b " * 30, *rows[0][2:]), rows[4]]
    d = spark.createDataFrame(rows, schema_of("documents") + EXTRA)
    got = periodic_runs.periodic_runs(d).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted([*map(str, range(len(texts))), "4", "None"])
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", "a b " * 30 if r.doc_id is None else texts[r.doc_id] or "")
        want = [(0, 60_000, 1)] if r.doc_id == 9 else brute_runs(words)
        assert ([tuple(x) for x in r.runs], r.n_words) == (want, len(words))
        assert r.collapsed == collapsed(words, want)
    assert periodic_runs.periodic_runs(d.limit(0)).collect() == []


def test_op11_holds_tails(spark):
    rows = queries.op11_periodic_runs(spark, SF).collect()
    assert len(rows) == 200 and sum(r.n_runs > 0 for r in rows) > 5
    assert all((r.n_runs == 0) == (r.start is None) for r in rows)


# ---------------------------------------------------------------- ranked search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute_search(docs, items, k):
    counts = [(d, Counter(fold(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts]
    n_docs, total = sum(n > 0 for *_, n in counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = {}
    for item, text in items:
        terms, scored = fold(text), []
        for d, c, n in counts:
            m = 75 + 25 * n * n_docs // max(total, 1)
            s = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out[item] = [(i, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def check_search(docs, items, k, **options):
    got = defaultdict(list)
    for r in lexical_search.search(docs, items, k, **options).collect():
        got[r.item_id].append((r["rank"], r.doc_id, r.score))
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    assert {i: sorted(x) for i, x in got.items()} == {i: x for i, x in want.items() if x}


def test_search_equals_brute_force_with_many_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(2)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(12)
    monkeypatch.setattr(lexical_search, "DOCS", 16)  # several blocks a task, so earlier blocks bound later ones
    for k in (1, 5, 20):
        check_search(docs, items, k)
    check_search(docs, items, 3, block_bytes=700)  # items in blocks too


@pytest.mark.parametrize("seed", range(4))
def test_search_of_ties_and_frequent_words(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(lexical_search, "DOCS", 20)
    words = ["the"] * 30 + [f"w{i}" for i in range(12)] + ["Rare", "É", "x1"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 30)))) for i in rng.sample(range(900), 120)]
    docs += [(d + 1000, t) for d, t in docs[:60]]  # equal scores
    items = [(i, "-".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(10)]
    check_search(spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(3),
                 spark.createDataFrame(items, "item_id BIGINT, text STRING"), 7)


def test_search_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "PIECE", 1 << 10)  # long texts are cut
    texts = [None, "", "  ", "!!", "Same words here", "same-words;HERE", "Ünï 你好 x1", "word " * 5000 + "tail", "y" * 9000]
    rows = [(i, t, "en", "s", 0, "z", *[7] * 7, "z") for i, t in enumerate(texts)]
    rows.append((None, "same words here", *rows[0][2:]))
    d = spark.createDataFrame(rows, schema_of("documents") + EXTRA)
    asked = [(1, "same here here word"), (2, None), (3, ""), (4, "ÜNÏ Ünï 你好 tail"), (None, "same"), (6, "y" * 9000)]
    items = spark.createDataFrame(asked, schema_of("benchmark"))
    check_search(d, items, 20)
    twice = lexical_search.search(d.unionByName(d.where("doc_id = 5")), items, 20).where("item_id = 1 AND doc_id = 5")
    assert twice.count() == 2  # every row is a document
    first = lexical_search.search(d, items.unionByName(spark.createDataFrame([(1, "zzz")], schema_of("benchmark"))), 20)
    assert first.where("item_id = 1").count() == lexical_search.search(d, items, 20).where("item_id = 1").count()
    assert lexical_search.search(d.limit(0), items).collect() == []
    assert lexical_search.search(d, items.limit(0)).collect() == []


def test_accumulators_are_limited(spark):
    """After the bound is reached no document is added, and survivors are exact."""
    block = lexical_search.Block.of([(np.arange(100), np.ones(100, bool), np.full(100, 10),
                                      [np.array([0, 1] if i < 3 else [1], "<i4").tobytes() for i in range(100)],
                                      [np.array([9, 1] if i < 3 else [1], "<i4").tobytes() for i in range(100)])], 2, 100, 1000)
    doc, score = lexical_search.best_of(block, np.array([0, 1]), np.array([5000, 1]), 2, 1)
    assert doc.tolist() == [0, 1, 2]
    assert score.tolist() == [5000 * (9 * 10**9 // (9000 + 1200)) + 10**9 // (1000 + 1200)] * 3


# ---------------------------------------------------------------- pages

def article_of(page):
    """The article of the tables' pages, by patterns."""
    text = re.sub(r"</?(h1|p)>|<br>", " ", re.search(r"<article>(.*)</article>", page, re.S)[1])
    return " ".join(html.unescape(re.sub("<[^>]*>", "", text)).split())


@pytest.fixture(scope="module")
def sample(spark):
    return html_extraction.sample(spark.read.parquet(f"{SF}/pages.parquet"))


@pytest.fixture(scope="module")
def model(sample):
    return html_extraction.fit_pages(sample)


def test_op13_gives_the_article_of_every_page(spark):
    sf = SF.replace("0.001", "0.01")
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op13_html_extraction(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article_of(pages[r.page_id].html), len(r.text))


def test_fit_depends_on_the_sample_alone(sample, model):
    again = html_extraction.fit_pages(sample)
    assert (again.trees.leaf == model.trees.leaf).all() and again.own == model.own


def overlap(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))


def test_held_out_layouts(model):
    draw = Layout(77, ["Another text that the model has not seen, with some words in it and an end. " * 6], ["Short entry"])
    pages = [draw.page() for _ in range(300)]
    trees = [dom.Tree(p, html_extraction.marked) for p in pages]
    want = [" ".join(x for leaf, x in t.texts.items() if t.label[leaf] == 1) for t in trees]
    got = html_extraction.main_texts([re.sub(r' data-main="\d"', "", p) for p in pages], model)
    assert np.mean([overlap(a, b) for a, b in zip(want, got)]) > 0.97


PROSE = ["The council met on Monday to talk about the new bridge, which many people in the town have asked for.",
         "It will cost four million and take two years, said the mayor, who hopes that work can start in spring.",
         "Not everyone agrees: shop owners fear that the street will be closed for months."]
PAGES = {
    "blog": '<html><body class="home"><div id="page"><header class="site-header"><h1>My blog</h1><nav class="main-nav"><ul>'
            '<li><a href="/">Home</a><li><a href="/a">About</a></ul></nav></header><div class="cookie-notice"><p>We use cookies to '
            'make this site better for you and for us.</p><button>Accept</button></div><div id="content"><div class="post">'
            '<h2>The bridge</h2><p>{0}</p><p>{1}</p><div class="advertisement"><p>Buy new shoes today, only here and only now.</p></div>'
            '<p>{2}</p></div><div id="comments"><h3>2 comments</h3><div class="comment"><p>I have lived here for years and I do not '
            'think that this is a good idea at all.</p></div></div></div><div class="sidebar"><h3>Popular</h3><ul><li>'
            '<a href="/x">Old news</a></li></ul></div><div id="footer">&copy; 2020 My blog, all rights reserved.</div></div></body></html>',
    "table": '<table><tr><td class="menu"><a href="a">One</a><br><a href="b">Two</a><br><a href="c">Three</a></td><td class="content">'
             '<h1>The bridge</h1><p>{0}<p>{1}<p>{2}</td></tr></table>',
    "semantic": '<main><article><h1>The bridge</h1><p>{0}</p><p>{1}</p><p>{2}</p></article></main><aside><h2>More</h2><p>Other stories '
                'that you may like to read today.</p></aside><footer><p>Contact us by mail.</p></footer><script>var x = "<p>no</p>";</script>',
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_hand_written_pages(model, name):
    got = html_extraction.main_texts([PAGES[name].format(*PROSE)], model)[0]
    assert got == " ".join(["The bridge", *PROSE])


def test_decoding_equals_all_consistent_choices():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randrange(1, 9)
        parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        page = dom.Tree.__new__(dom.Tree)
        page.parent, page.tokens, page.label = parent, [set()] * n, [None] * n
        page.depth = []
        for p in parent:
            page.depth.append(0 if p < 0 else page.depth[p] + 1)
        page.end, page.counts = list(range(1, n + 1)), [[0] * 8 for _ in range(n)]
        forest = dom.Forest([page])
        gain = np.array([rng.uniform(-2, 2) for _ in range(n)])
        chosen = forest.decode(gain)
        assert all(p < 0 or not c or chosen[p] for c, p in zip(chosen, parent))
        best = max(sum(gain[i] for i in range(n) if pick[i]) for pick in itertools.product((0, 1), repeat=n)
                   if all(p < 0 or not c or pick[p] for c, p in zip(pick, parent)))
        assert abs(gain[chosen].sum() - best) < 1e-9


def test_blocks_of_a_page():
    page = ("a<b>b</b> c<p>one<br>two &amp; &#233;&nbsp; x<p>three<div>four</b></div> five<ul><li>1<li>2<ul><li>3</ul></ul>"
            "<script>if (a < b) '<p>'</script><!-- <p>no</p> --><style>p{}</style><![if x]>z<table><tr><td>t<td>u<tr><td>v</table>")
    assert list(dom.Tree(page).texts.values()) == ["ab c", "one two & é x", "three", "four", "five", "1", "2", "3", "z", "t", "u", "v"]


def test_extraction_of_odd_pages(spark, model):
    deep = "<div>" * 3000 + PROSE[0] + "</div>" * 3000
    pages = [None, "", "plain text without any element", "<p", "<![CDATA[x]]>", "<!DOCTYPE", "</p></div>", "<a href='", deep,
             "<article><p>" + (" ".join(PROSE) + " ") * 3000, PAGES["blog"].format(*PROSE), PAGES["blog"].format(*PROSE)]
    rows = [(i, None if i == 2 else f"u{i}", p, "z", *[7] * 7, "z") for i, p in enumerate(pages)]
    rows += [(None, "n", pages[10], *rows[0][3:]), rows[10]]
    d = spark.createDataFrame(rows, schema_of("pages") + EXTRA)
    got = html_extraction.extract(d, model).collect()
    assert sorted(str(r.page_id) for r in got) == sorted([*map(str, range(len(pages))), "10", "None"])
    texts = {r.page_id: r.text for r in got}
    assert texts[0] == texts[1] == "" and texts[9] == " ".join(PROSE * 3000) and texts[10] == texts[11] == texts[None]
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extraction.extract(d.limit(0), model).collect() == []
    empty = html_extraction.fit(d.limit(0))  # no page to fit on: layouts of made words
    assert html_extraction.main_texts([PAGES["semantic"].format(*PROSE)], empty)[0].startswith("The bridge")
