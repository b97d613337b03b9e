"""Mixing, url rules, page texts, search and the pipeline."""

from __future__ import annotations

import random

import corpus_pipeline
import duck
import duckdb
import pytest

import llm.brute as brute
from tidemark.llm.html_text import extract_text, visible_text
from tidemark.llm.mixing import mix
from tidemark.llm.oracle import OP7, ORACLE
from tidemark.llm.pivot_search import top_k_products
from tidemark.llm.queries import QUERIES
from tidemark.llm.url_rules import judge_urls, rules_frame

FOLDER = "/root/testdata/sf0.001"
RANDOM = random.Random(11)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_duckdb(spark, name):
    assert duck.differences(QUERIES[name](spark, FOLDER), duck.connect(FOLDER), ORACLE[name]) is None


def test_mix_of_awkward_sources_equals_sql(spark):
    texts = [None, "", " \n"] + [" ".join(["w"] * RANDOM.randrange(1, 60)) for _ in range(60)] + ["w " * 4000]
    texts += [(5, "same row"), (5, "same row"), (None, "no id"), (None, "no id")]
    sources = [RANDOM.choice(["a", "B", "é", None, "a", "a"]) for _ in texts]
    docs = brute.documents(spark, texts, sources)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    ours = mix(docs).select("doc_id", "size", "source_size", "target", "taken")
    assert duck.differences(ours, con, OP7) is None
    assert mix(docs.where("false")).count() == 0
    assert [r["taken"] for r in mix(docs.where("doc_id in (0, 1)")).collect()] == [0, 0]


def test_urls_equal_plain_rules(spark):
    rules = [("com", "/", "allow"), ("a.com", "/x", "block"), ("a.com", "/xy/", "allow"), ("w.a.com", "", "block"), ("net", "/q", "block"), ("", "/", "block")]
    hosts = ["com", "a.com", "w.a.com", "v.w.a.com", "b-a.com", "aa.com", "net", "x.NET", "com.", "org", "", "a.com:80", "A.Com"]
    urls = [f"http://{h}{p}" for h in hosts for p in ["", "/", "/x", "/xy/z?q", "/q#f", "?x", "/xyz"]] + [None, "", "no scheme", "://", "a://b://c.com/x"]
    pages = spark.createDataFrame([(i, u, "h", "p", "s", 0) for i, u in enumerate(urls)] + [(1, urls[1], "h", "p", "s", 0), (None, "http://a.com/x", "h", "p", "s", 0)],
                                  "page_id long, url string, host string, path string, stack string, range int")
    got = sorted(map(tuple, judge_urls(pages, rules_frame(spark, rules)).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    want = []
    for r in pages.collect():
        url = r["url"] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = brute.lower(rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        want.append((r["page_id"], host, path, rule, verdict))
    assert got == sorted(want, key=repr)
    assert judge_urls(pages.where("false"), rules_frame(spark, rules)).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, rules_frame(spark, [])).collect()} == {"allow"}


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<p>a<p>b", "a\n\nb"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>x", "- a\n- b\n  - c\n- d\n\nx"),
        ("<ol start=3><li>x<li value=7>y<li>z</ol>", "3. x\n7. y\n8. z"),
        ("<table><tr><th>name<th>n<tr><td>alpha<td>1<tr><td>b<td>22</table>after", "name   n\nalpha  1\nb      22\n\nafter"),
        ("<table><td>a<td rowspan=2>b<tr><td>c<tr><td colspan=2>wide</table>", "a  b\nc\nwide"),
        ("<div>a<b>b</b> c</div><div hidden>no</div><script>x<p></script>d", "ab c\nd"),
        ("<div style='display: none'>h</div><span style='visibility:hidden'>a<i style='visibility:visible'>b</i></span>", "b"),
        ("a &amp; b &lt;c&gt; 1 < 2", "a & b <c> 1 < 2"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("x<br>y<br><br>z", "x\ny\n\nz"),
        ("<head><title>t</title><body>b<!-- c --><![CDATA[d]]>", "bd"),
        ("<a href='x>y'>t</a></p>u", "t\n\nu"),
        ("<dl><dt>T<dd>D1<dd>D2</dl>", "T\n  D1\n  D2"),
        ("<div>" * 20_000 + "deep", "deep"),
        ("w " * 50_000, "w " * 49_999 + "w"),
    ],
)
def test_visible_text(html, text):
    assert visible_text(html) == text


def test_no_visible_word_is_lost(spark):
    pages = spark.createDataFrame([(1, "<p>a</p><p>b", "old"), (1, "<p>a</p><p>b", "old"), (None, None, "old")], "page_id long, html string, text string")
    assert sorted((r["page_id"] or 0, r["text"]) for r in extract_text(pages).collect()) == [(0, ""), (1, "a\n\nb"), (1, "a\n\nb")]
    for page in range(40):
        words = [f"w{page}x{i}" for i in range(60)]
        tags = "p div b li ul ol table tr td th h1 pre blockquote span dd dt dl br section".split()
        html = "".join(f"<{'/' if RANDOM.random() < 0.4 else ''}{RANDOM.choice(tags)}> {w} " for w in words)
        assert visible_text(html).split() != [] and set(words) <= set(visible_text(html).split())


def test_search_equals_brute_force(spark):
    vectors = [(i, [RANDOM.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    vectors += [(i, [0.5, 0.25, 0.0, 1.0, 0.0, 0.0]) for i in range(300, 420)]  # one vector many times
    bad = [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (550, [float("inf")] * 6), (None, [1.0] * 6)]
    odd = [(600, [1.0, 2.0]), (601, []), (650, [-3.0] * 6)]
    again = [(7, vectors[7][1])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors + bad + odd + again], "vec_id long, embedding array<double>, id long, ring int")
    import math

    plain = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors + odd]
    got = top_k_products(table, pivots=4)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(brute.top_k(plain))
    assert top_k_products(table.where("vec_id < 3"), k=5).count() == 2
    assert top_k_products(table.where("false")).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "text", "lang", "source", "n_chars", "epoch"} == set(rows.columns)
    kept = {r["doc_id"] for r in rows.select("doc_id").collect()}
    given = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    assert kept <= given and len(kept) > len(given) / 3


def test_stages_take_awkward_documents(spark):
    texts = [None, "", "one two", " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(50)), (None, None), (3, "same"), (3, "same"), (None, "x y")]
    docs = brute.documents(spark, texts)
    for _, stage in corpus_pipeline.STAGES[1:]:
        done = stage(spark, docs, FOLDER)
        assert set(docs.columns) <= set(done.columns)
        assert stage(spark, docs.where("false"), FOLDER).count() == 0
    kept = corpus_pipeline.drop_near_copies(spark, docs, FOLDER).select("doc_id", "text").collect()
    ids = sorted((r["doc_id"] for r in kept if r["doc_id"] is not None))
    assert ids == [0, 1, 2, 3, 3] and sum(r["text"] == "same" for r in kept) == 1
    taken = corpus_pipeline.mix_sources(spark, docs, FOLDER).groupBy("doc_id", "text", "epoch").count().collect()
    assert all(r["count"] <= 2 for r in taken)
