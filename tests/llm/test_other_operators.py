"""Vectors, pages and the pipeline."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from cases import docs

from lattica.llm import ann, boosting, html_extract
from lattica.llm.queries import QUERIES

# --- nearest neighbours ---------------------------------------------------------------------------------------------


def brute(table, queries, k=10):
    out = {}
    for q, v in queries:
        d = sorted((math.sqrt(sum((float(a) - float(b)) ** 2 for a, b in zip(v, w, strict=True))), i) for i, w in table if i != q and len(w) == len(v))
        out[q] = d[:k]
    return out


def test_search_recall(spark):
    sf = "/root/testdata/sf0.01"
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(table, [(i, v) for i, v in table if i % 100 == 0])
    got: dict = {}
    for r in QUERIES["op5_hnsw_search"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11))
        true = {i for _, i in want[q]}
        hits += sum(r[1] in true for r in rows)
        assert [(s, i) for _, i, s in rows] == sorted((s, i) for _, i, s in rows)
        assert all(s == pytest.approx(dict((i, d) for d, i in want[q]).get(i, s), abs=1e-12) for _, i, s in rows)
    assert hits / (10 * len(want)) >= 0.95


def test_graph_recall_in_one_large_shard():
    rng = np.random.default_rng(3)
    v = rng.standard_normal((3000, 32))
    u = (np.arange(3000) * 0.6180339887 + 0.5) % 1
    graph = ann.Graph(v, np.floor(-np.log(u + 1e-9) / np.log(ann.M)).astype(np.int32))
    hits = 0
    for q in range(0, 3000, 60):
        d = ((v - v[q]) ** 2).sum(axis=1)
        hits += len(set(graph.search(v[q], 100)[:10].tolist()) & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits / 500 >= 0.93


def test_graph_recall_at_the_size_that_a_shard_may_have():
    """As hard as vectors get: Gaussian ones of 64 components, as many as build_index puts into a shard."""
    rng = np.random.default_rng(9)
    n = ann.SHARD_ROWS
    v = rng.standard_normal((n, 64)).astype(np.float32)
    u = ((ann.mix(np.arange(n).astype(np.uint64)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
    graph = ann.Graph(v, np.floor(-np.log(u) / np.log(ann.M)).astype(np.int32))
    hits = 0
    for q in range(0, n, n // 50):
        d = ((v - v[q]) ** 2).sum(axis=1)
        hits += len(set(graph.search(v[q], ann.EF_SEARCH)[:10].tolist()) & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits / 500 >= 0.9


def test_an_outlier_leaves_its_shard_alone():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(1500, 16)).astype(np.float32)
    v[700, 3] = 1e25
    graph = ann.Graph(v, np.floor(-np.log(rng.random(len(v)) + 1e-9) / np.log(ann.M)).astype(np.int32))
    hits = 0
    for q in v[:40]:
        want = np.argsort(((v.astype(float) - q.astype(float)) ** 2).sum(axis=1))[:10]
        hits += len(set(want.tolist()) & set(graph.search(q, ann.EF_SEARCH)[:10].tolist()))
    assert hits >= 390


def test_copies_and_unusable_vectors(spark):
    same = [1.0, 2.0]
    rows = [(i, same) for i in range(40, 0, -1)] + [(100, same), (200, [5.0, 5.0]), (None, same), (201, None), (202, [0.0, 0.0]), (203, [float("nan"), 1.0])]
    rows += [(204, [float("inf"), 1.0]), (205, [None, 1.0]), (206, []), (300, [1.0, 2.0, 3.0]), (40, same), (301, [1.0, 2.0, 4.0]), (302, [-0.0, 1.0]), (303, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = ann.build_index(table, shards=3)
    got = {}
    for r in ann.search(index, table.where("vec_id % 100 = 0"), k=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got[100]) == [(i, i, 0.0) for i in range(1, 11)]
    assert [x[1] for x in sorted(got[200])] == list(range(1, 11))
    assert sorted(got[300]) == [(1, 301, 1.0)]
    assert set(got) == {100, 200, 300}
    wide = table.selectExpr("*", "1 as shard", "2 as dim", "3 as id", "4 as score")
    assert ann.search(ann.build_index(wide, shards=2), wide.where("vec_id = 100")).count() == 10
    assert ann.search(ann.build_index(table.limit(0)), table).count() == 0
    assert ann.search(index, table.limit(0)).count() == 0


def test_queries_in_blocks(spark):
    rng = np.random.default_rng(1)
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((200, 8)))], "vec_id long, embedding array<double>")
    index = ann.build_index(table, shards=2)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(ann.search(index, table, block=30)) == key(ann.search(index, table))


# --- pages ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trees():
    return html_extract.model()


def text_of(page, trees):
    return html_extract.extract_pages([page], trees)[0]


P = [
    "The river rose for three days, and on the fourth the town moved its market up the hill.",
    "Nobody had asked the miller, who stayed where he was &amp; counted sacks.",
    "By evening the water stood at his door; he lit a lamp, and waited for the boat.",
]
SHOWN = [p.replace("&amp;", "&") for p in P]


@pytest.mark.parametrize(
    "page",
    [
        f'<html><head><title>t</title><script>var a = "</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><article><p>{P[0]}</p><p>{P[1]}</p><p>{P[2]}</p></article><footer>&copy; 2020 us</footer></body></html>',
        f'<body><div id="menu"><a href=1>One</a> <a href=2>Two</a></div><div class="post-content"><p>{P[0]}<p>{P[1]}<div class="advert">Buy a boat now!</div><p>{P[2]}</div><div class="comments"><div class="comment"><p>First! What a story, I liked it a lot.</p></div></div><div class="footer">Imprint</div>',
        f'<body><header><h2>The Paper</h2></header><aside class="sidebar"><h3>Related</h3><ul><li><a href=x>Ten boats</a></li></ul></aside><main><p>{P[0]}</p><form class="newsletter"><label>Mail</label><input><button>Go</button></form><p>{P[1]}</p><p>{P[2]}</p></main><div class="cookie-notice"><p>We use cookies to make this page better. Accept?</p></div></body>',
    ],
)
def test_main_text(page, trees):
    assert text_of(page, trees) == "\n\n".join(SHOWN)


def test_parser():
    page = html_extract.parse("<p>a\n  b<br>c<!-- x --><b>d</b><p>e &lt;f&gt; <script>if (1 < 2) x();</script>g<ul><li>h<li>i</ul>j<td>k")
    assert [line for _, line in page.runs] == ["a b cd", "e <f> g", "h", "i", "j", "k"]
    assert all(e >= 0 for e in page.end)
    for odd in ("", "<", "<p", "<p class='x>text", "</p></div>", "<!-- never closed", "a < b", "<script>never closed", "<a><a><a>", "\x00"):
        html_extract.parse(odd)


def lines(page):
    return [line for _, line in html_extract.parse(page).runs]


@pytest.mark.parametrize("name", ["select", "template"])
def test_unclosed_element_keeps_the_rest(name):
    assert lines(f"<p>a</p><{name} id='x'><p>b</p><{name}>hid</{name}><p>c</p>") == ["a", "b", "c"]
    assert lines(f"<p>a</p><{name}><{name}>x</{name}>y</{name}><p>b</p><!-- </{name}> --><{name}><p>c</p><!-- </{name}> --><p>d</p>") == ["a", "b", "c", "d"]
    assert lines(f"<p>a</p><{name}>x</{name}er><p>b</p></{name}><p>c</p>") == ["a", "c"]


@pytest.mark.parametrize("name", ["video", "audio", "svg", "math", "object", "canvas", "noscript"])
def test_text_that_no_rule_names_stays(name):
    assert lines(f"<p>Energy is <{name} a=b><mi>E</mi> = mc</{name}> as known.<p>b") == ["Energy is E = mc as known.", "b"]
    assert lines(f"<p>a</p><{name} id='x'><p>b</p><{name}>c</{name}><p>d</p>") == ["a", "b", "c", "d"]


def test_titles_are_dropped_wherever_they_stand(trees):
    assert lines("<title>My <!-- Title</title><p>a <svg><title>icon</title><text>b</text></svg></p>") == ["a b"]
    assert lines("<p>a</p><title>never closed<p>b</p><title>c") == ["a", "never closed", "b", "c"]
    page = "<title>My Title</title><article>" + "".join(f"<p>{p}</p>" for p in P) + "</article>"
    assert text_of(page, trees) == "\n\n".join(SHOWN)


def test_very_deep_pages_take_linear_time(trees):
    import time

    start = time.perf_counter()
    page = "<div>" * 100_000 + "deep" + "</div>" * 100_000
    assert lines(page) == ["deep"]
    assert lines("<div>" * 50_000 + "</section>" * 50_000 + "x") == ["x"]
    assert lines("<title>" * 50_000 + "x") == ["x"]
    assert time.perf_counter() - start < 10
    assert text_of(page, trees) in ("", "deep")


def test_head_without_its_end_tag():
    assert lines("<html><head><title>t</title><meta charset=utf-8><style>p{}</style><script>'</head>'</script><p>a</p><p>b</p>") == ["a", "b"]
    assert lines("<head><title>t</title><header>a</header><p>b</p>") == ["a", "b"]
    assert lines("<head><title>t</title></head ><header>a</header><p>b</p>") == ["a", "b"]
    assert lines("<head><link rel=x><body><p>a</p>") == ["a"]
    assert lines("<head><title>t</title>plain text") == ["plain text"]
    assert lines("<p>a</p><script>b<p>c</p>") == lines("<p>a</p><style>b<p>c</p>") == lines("<p>a</p><textarea>b<p>c</p>") == ["a"]


@pytest.mark.parametrize("word", ["comments", "cookie", "sidebar", "article"])
def test_long_attributes_are_read_whole(word):
    utility = "px-4 mt-2 flex " * 40
    assert html_extract.attribute_bits(f' class="{utility}{word}"')[0] == html_extract.attribute_bits(f' class="{word}"')[0] != 0


def test_labels_never_contradict(trees):
    rng = random.Random(4)
    for _ in range(40):
        page = html_extract.parse(html_extract._made_up(rng))
        label = html_extract.decode(page, trees.margin(html_extract.features([page])))
        assert all(label[page.parent[x]] <= label[x] for x in range(1, len(label)))


def test_decoding_is_optimal():
    """Against every labelling of small trees."""
    import itertools

    page = html_extract.parse("<div><p>a</p><div><p>b</p><p>c</p></div></div>")
    rng = np.random.default_rng(2)
    n = len(page.tag)
    texted = {x for x, _ in page.runs}
    for _ in range(30):
        z = rng.normal(0, 2, n)

        def cost(label):
            total = 0.0
            for x in range(n):
                up = label[page.parent[x]] if x else 0
                if label[x] < up:
                    return math.inf
                w = 1.0 if x in texted else html_extract.BARE
                if label[x] == 1:
                    total += w * math.log1p(math.exp(-z[x])) + (html_extract.ENTER_MAIN if up == 0 and x else 0)
                elif label[x] == 2:
                    total += w * math.log1p(math.exp(z[x])) + (html_extract.LEAVE_MAIN if up == 1 else 0)
                elif x in texted:
                    total += math.log1p(math.exp(z[x]))
            return total

        best = min(cost((0, *rest)) for rest in itertools.product((0, 1, 2), repeat=n - 1))
        got = html_extract.decode(page, z)
        if got[0] == 0:
            assert cost(tuple(got)) == pytest.approx(best)


def test_pages_query(spark, sf):
    import html as entities
    import re

    table = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op7_html_extraction"](spark, sf).collect()}
    assert set(got) == set(table)
    for i, page in table.items():
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.DOTALL)[1]
        parts = [" ".join(entities.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert got[i].text == "\n\n".join(p for p in parts if p) and got[i].n_chars == len(got[i].text)


def test_page_edge_cases(spark, trees):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (1, "u", None), (3, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (4, "u", "<article>" + "<p>word " * 20000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = html_extract.extract(pages).collect()
    assert len(got) == 6 and all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (1, 2))
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = boosting.train(x, y, trees=30, depth=3)
    assert (((model.margin(x) > 0) == y).mean()) > 0.95


# --- pipeline -------------------------------------------------------------------------------------------------------


def mixed_by_sql(docs):
    """(doc_id, text) as often as the mixture's SQL takes them."""
    import duckdb
    import pyarrow as pa

    from lattica.llm.queries import ORACLES

    con = duckdb.connect()
    con.register("documents", pa.table({c: [r[c] for r in docs] for c in ("doc_id", "text", "source")}))
    texts = {r.doc_id: r.text for r in docs}
    rows = con.sql(f"select doc_id, copies from ({ORACLES['op9_mixture']})").fetchall()
    return Counter({(i, texts[i]): n for i, n in rows if n})


def test_pipeline_stages(spark, sf, tmp_path):
    """Each stage against what brute force says of its own input."""
    import corpus_pipeline as c
    from test_text_operators import base_brute, components_brute, fingerprint_brute, rules_brute

    rows = spark.read.parquet(f"{sf}/documents.parquet")
    columns = rows.columns
    planted = " ".join(f"{w} walked home" for w in ("anna", "bert", "carl", "dora", "emil", "fay", "gus", "hal")) + ' with token = "abcdefgh12345678".'
    rows = rows.unionByName(spark.createDataFrame([(10**6, planted, "en", "src0", len(planted))], rows.schema))
    for i, (name, stage) in enumerate(c.STAGES):
        before = rows.collect()
        out = stage(spark, rows, sf)
        out.write.parquet(str(tmp_path / str(i)))
        rows = spark.read.parquet(str(tmp_path / str(i)))
        after = rows.collect()
        if i < 4:
            assert rows.columns == columns and all(r.n_chars == len(r.text) for r in after)
        if name == "quality_rules":
            failed = {r.doc_id for r in before if (w := rules_brute(r.text))[0] < 20 or 100 * w[4] > 30 * w[0]}
            assert not failed & {r.doc_id for r in after} and len(after) > 0.6 * len(before)
        elif name == "simhash_dedup":
            label = components_brute({r.doc_id: fingerprint_brute(r.text) for r in before})
            assert sorted(r.doc_id for r in after) == sorted(set(label.values()))
        elif name == "secret_scan":
            had = {r.doc_id for r in before if base_brute(r.text)}
            assert had and all(not base_brute(r.text) for r in after) and len(after) == len(before)
            assert {r.doc_id: r.text for r in before if r.doc_id not in had} == {r.doc_id: r.text for r in after if r.doc_id not in had}
        elif name == "mixture":
            assert Counter((r.doc_id, r.text) for r in after) == mixed_by_sql(before)
        else:
            from lattica.llm import pieces

            back = {r.doc_id: r.text for r in pieces.decode_pieces(rows).collect()}
            assert back == {r.doc_id: r.text for r in before}
    assert c.run(spark, sf).count() > 0


def test_pipeline_edge_cases(spark, tmp_path):
    """No rows; and rows of which only one document (twice) is long enough and repeats too little to be rejected."""
    import corpus_pipeline as c

    for rows, left in ((docs(spark, []), set()), (docs(spark), {1})):
        for i, (_, stage) in enumerate(c.STAGES):
            stage(spark, rows, "").write.parquet(str(tmp_path / f"{len(left)}-{i}"))
            rows = spark.read.parquet(str(tmp_path / f"{len(left)}-{i}"))
        assert {r.doc_id for r in rows.collect()} == left
