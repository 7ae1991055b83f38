"""HTML extraction and WARC archives."""

import hashlib
import math
import os
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tamarack.llm import html_extract
from tamarack.llm.common import shared_path
from tamarack.llm.html_extract import Page, host_of, main_text
from tamarack.llm.warc import archive, read_archives, records

PAGE = """<html><head><title>x</title></head><body><header><h1>Site</h1></header><div class="sidebar">s</div><main><article class="post"><header><h1>T &amp; U&nbsp;V</h1></header>
<p>One  <i>it</i>alic<p>Three &lt;b&gt;<ul><li>a<li>b</ul><div class="ad-box">buy</div><script>var a="<p>x</p>";</script><section id="comments"><p>no</p></section><form>f<input></form></article></main>
<div class="cookie-notice">c</div><footer>f</footer>"""


def pages(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, text string, n int")


def test_article():
    assert Page(PAGE).text() == "T & U V\nOne italic\nThree <b>\na\nb"
    assert Page("").text() == "" and Page("plain < 3 text").text() == "plain < 3 text"
    assert Page("<p>a<div>b</p>c<!-- x --><b>d</div>").text() == "a\nb\ncd"
    assert Page("<nav>n</nav><p>no end").text() == "no end"


def test_class_words_do_not_remove_the_whole():
    for tag in ("body class='right-sidebar'", "article class='post comments-open'", "main id='search'", "main role='search'"):
        assert Page(f"<html class='has-banner'><{tag}><p>kept</p><div class='sidebar'>s</div></{tag.split()[0]}></html>").text() == "kept"


def test_site_style_tree(spark):
    site = "<body><div class='k1'><p>Same words everywhere</p></div><div class='body'><p>text {} here</p><p>shared passage</p></div></body>"
    rows = [(k, f"http://h.x/{k}", site.format(k)) for k in range(30)] + [(50, "http://one.x/", site.format(0)), (51, None, None)] + [(60 + k, "http://copy.x/", site.format(1)) for k in range(30)]
    got = {r.page_id: r for r in main_text(pages(spark, rows)).collect()}
    assert got[3].text == "text 3 here\nshared passage" and got[3].n_chars == len(got[3].text)
    assert got[50].text.startswith("Same words") and got[60].text.startswith("Same words")  # one page, or copies of one, tell nothing
    assert (got[51].text, got[51].n_chars) == ("", 0)
    assert main_text(pages(spark, [])).count() == 0


def test_warc(spark):
    long = "é" * 5000
    rows = [(3, "http://a/ü?q=1", long), (1, "u", "x" * 100), (2, None, "x" * 100), (4, "u", None), (5, "u", ""), (6, "u", "y" * 99), (7, "u", "y" * 99), (8, "u", long), (9, "u", "WARC/1.1\r\n\r\n\r\n" * 20)]
    files = archive(pages(spark, rows), shared_path(spark, "t"), chunk=64, archive_bytes=500)
    got = {r.page_id: tuple(r)[1:] for r in records(files).collect()}
    for page, _, html in rows:
        data = (html or "").encode()
        kind = ("revisit", {2: 1, 8: 3}[page]) if page in (2, 8) else ("response", None)
        assert got[page] == (len(data), hashlib.sha256(data).hexdigest(), *kind)
    chunks = read_archives(files, chunk=50).where("record_type = 'response'").orderBy("record_id", "chunk").collect()
    joined = {}
    for r in chunks:
        assert len(r.data) <= 50
        joined[r.page_id] = joined.get(r.page_id, b"") + r.data
        assert r.digest == hashlib.sha256(joined[r.page_id]).hexdigest() and r.size == len(joined[r.page_id])
    assert {k: v.decode() for k, v in joined.items()} == {p: h or "" for p, _, h in rows if p not in (2, 8)}
    assert {r.page_id: r.url for r in chunks if r.last}[3] == "http://a/ü?q=1"
    assert records(archive(pages(spark, []), shared_path(spark, "t"))).count() == 0


SF = "/root/testdata/sf0.01"


def plain_tree(rows):
    """Removed paths of each host, by a tree in plain Python over (host, html)."""
    trees = {}
    for host, html in set(rows):
        page = Page(html)
        plain = {e.path for e in page.elements if e.plain or e.tag in ("html", "body", "main", "article")}
        for path, (style, features) in page.seen().items():
            node = trees.setdefault(host, {}).setdefault(path, {"m": 0, "styles": Counter(), "features": Counter(), "plain": path in plain})
            node["m"] += 1
            node["styles"][style] += 1
            node["features"].update(features)
    removed = {}
    for host, tree in trees.items():
        for path, node in tree.items():
            below = {p: n for p, n in tree.items() if p == path or p.startswith(path + "/")}
            weight = style = k = low = 0
            for p, n in below.items():
                if any(n["styles"]) and n["styles"].keys() != {0}:
                    w = n["m"] * 0.5 ** (p.count("/") - path.count("/"))
                    weight += w
                    style += w * (-sum(c / n["m"] * math.log(c / n["m"]) for c in n["styles"].values()) / math.log(n["m"]) if n["m"] > 1 else 1)
                k += sum(n["features"].values())
                low += sum(c * math.log(c) for c in n["features"].values())
            content = 1 if node["m"] == 1 else max(0, 1 - low / (k * math.log(node["m"]))) if k else 0
            found = 1 - (1 - (style / weight if weight else 0)) * (1 - content)
            name = path.rpartition("/")[2]
            value = 1 if node["plain"] else 1 - (1 - 1 / node["m"]) * (1 - found)
            value *= 0.25 ** (name.endswith(("!", "!~")) + name.endswith("~"))
            if value < 0.3:
                removed.setdefault(host, set()).add(path)
    return removed


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_same_as_a_plain_tree(spark):
    own = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.host, r.html or "") for r in own.select("page_id", host_of(F.col("url")).alias("host"), "html").collect()]
    removed = plain_tree([(host, html) for _, host, html in rows])
    got = {r.page_id: r.text for r in main_text(own).collect()}
    assert got == {i: Page(html).text(frozenset(removed.get(host, ()))) for i, host, html in rows}
    assert all(got[i] != Page(html).text(frozenset()) for i, _, html in rows)  # with the tree off


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_class_words_decide_nothing_here(monkeypatch):
    own = pq.read_table(f"{SF}/pages.parquet", columns=["html"])["html"].to_pylist()
    before = [Page(x or "").text() for x in own]
    monkeypatch.setattr(html_extract, "SIGNS", set())
    assert [Page(x or "").text() for x in own] == before


def test_neutral_names_and_odd_pages(spark):
    site = "<body><div class='top'><a href='/'>Home</a><a href='/n'>News</a></div><div class='k'><p>Story {} begins</p><div class='w-1/2'>and goes on {}</div></div><div class='end'>All rights</div></body>"
    rows = [(k, f"http://h.x/{k}", site.format(k, k * k)) for k in range(12)]
    deep = "<div>" * 300 + "deep" + "</div>" * 300
    rows += [(20, "http://d.x/", deep), (21, "http://d.x/", deep), (22, "http://e.x/", "<p>" + "long " * 200_000), (23, "", "no host")]
    got = {r.page_id: r.text for r in main_text(pages(spark, rows)).collect()}
    assert all(got[k] == f"Story {k} begins\nand goes on {k * k}" for k in range(12))
    assert got[20] == got[21] == "deep" and got[22] == ("long " * 200_000).strip() and got[23] == "no host"
