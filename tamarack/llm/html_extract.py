"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged into one tree. An element is named by the tags
and classes on the way to it; for each, the tree counts the presentations (tags of its
children) and the content features (runs of its own text) that pages give it. The
presentation importance of a branch is the mean entropy of its elements' presentations,
each weighing half of its parent; its content importance is 1 less the mean entropy
of its features over the pages, 0 where all pages share all of it and 1 where no two
pages share any. Both are combined to 1 - (1 - presentation) * (1 - content), and drawn
towards 1 where few pages tell (by 1 / pages).

Evidence counts on top, each by a factor of EVIDENCE: a tag, role or class word for
menus, headers, footers, sidebars, notices, adverts, forms or reader comments ("!" in
an element's name), and a place outside of the article (or else the main element) on a page that
has one ("~"). Branches whose importance is then under IMPORTANCE are removed from each
page; so what is marked always goes, by the formula, and what is not goes by its entropy.
Words never mark html, body, main or an article. Plain flow elements of
an article (headings, paragraphs, lists, tables without classes) are never removed for
their entropy: a passage that many pages share is still their text. Scripts, styles,
form controls, media and hidden elements are no text and never enter the tree.

The tree is a table of counts by (host, path, presentation or feature): combined
before each shuffle, so that no host's pages meet in one task; exact copies of a page
count once. Hosts with very many pages take their list of removed branches by broadcast
while the lists together are small (LISTS_BYTES), else by a join that Spark splits.

Text: character references decoded, white space within a block turned into one space, blocks
trimmed and joined by a line end. Elements deeper than DEPTH are judged with the one
at that depth. Null html gives an empty text; pages without a
host form a host of their own; repeated rows each give a row; an empty table gives
an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT, materialize, table, with_groups

IMPORTANCE, EVIDENCE, DEPTH, LISTS_BYTES = 0.3, 0.25, 40, 32 << 20

TOKEN = re.compile(r"""<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|</([a-zA-Z][^\s>/]*)[^>]*>|<([a-zA-Z][^\s>/]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp noembed noframes template".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose end tag closes all that is open within them, and past which an inline end tag does not reach.
HOLDS = BLOCK - {"p", "hr"}
FLOW = set("article main h1 h2 h3 h4 h5 h6 p b i em strong a span ul ol li dl dt dd blockquote pre code table thead tbody tfoot tr td th figure figcaption section div sup sub small u br q cite mark".split())
#: Elements that hold no text of the page, and those that say what they are.
NO_TEXT = RAW | set("button select dialog object svg canvas audio video applet head map datalist".split())
CHROME = set("nav aside footer form menu".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
SIGNS = set("ad ads adv advert adverts advertisement advertising adsense adbox adslot banner banners sponsor sponsored sponsors promo promos promotion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar cookie cookies consent gdpr notice notices notification disclaimer popup modal overlay newsletter subscribe subscription signup login search comment comments disqus respond replies reply share sharing social related recommended recommendations widget widgets toolbar pagination pager copyright paywall".split())
#: What holds a page's text: neither words of its classes nor its role remove it.
WHOLE = {"html", "body", "main", "article"}
#: Which open elements a start tag closes, up to an element that holds them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}

def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 1


class Element:
    __slots__ = ("up", "tag", "name", "marked", "region", "plain", "depth", "children", "holds", "path")

    def __init__(self, up: Element | None, tag: str, name: str, marked: bool, region: str, plain: bool):
        self.up, self.tag, self.name, self.marked, self.region, self.plain = up, tag, name, marked, region, plain
        self.depth = up.depth + 1 if up else 0
        self.children: list[str] = []
        #: Whether the page's article lies in it; its place in the tree.
        self.holds, self.path = False, ""


class Page:
    """One pass over a page: its pieces of text in order with their block and element, and its elements with their paths."""

    def __init__(self, html: str):
        self.block, self.hidden = 0, 0
        self.elements = [Element(None, "", "", False, "", False)]
        self.stack = [self.elements[0]]
        self.pieces: list[tuple[int, Element, str]] = []
        self._walk(html)
        self._name()

    def _name(self) -> None:
        """Paths of all elements, once it is known whether the page has an article or a main element."""
        regions = {e.region for _, e, text in self.pieces if e.region and not text.isspace()}
        self.wanted = "article" if "article" in regions else "main" if "main" in regions else ""
        for e in reversed(self.elements):
            e.holds = e.holds or bool(self.wanted) and e.region == self.wanted
            if e.holds and e.up:
                e.up.holds = True
        for e in self.elements:
            if e.up is None:
                e.path = self.wanted or "page"
            elif e.depth > DEPTH:
                e.path = e.up.path
            else:
                outside = self.wanted and not e.holds and e.up.holds and e.up.region != self.wanted
                e.path = f"{e.up.path}/{e.name}{'!' * e.marked}{'~' * bool(outside)}"

    def place(self, e: Element) -> str:
        """Where an element's own text stands in the tree; beside an article it is a branch of its own."""
        return f"{e.path}/#text~" if self.wanted and e.holds and e.region != self.wanted else e.path

    def seen(self) -> dict[str, tuple[int, list[int]]]:
        """Of each path: a hash of its elements' presentations (0 for none), and the features of its text."""
        styles: dict[str, int] = {}
        features: dict[str, set[int]] = {}
        for e in self.elements[1:]:
            styles[e.path] = (styles.get(e.path, 0) + (hash_of(" ".join(e.children)) if e.children else 0)) & (1 << 62) - 1
        for _, e, text in self.pieces:
            if own := " ".join(text.split()):
                features.setdefault(self.place(e), set()).add(hash_of(own))
        return {path: (styles.get(path, 0), sorted(features.get(path, ()))) for path in styles.keys() | features.keys()}

    def _walk(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            found = TOKEN.search(html, at)
            if found is None:
                self._text(html[at:])
                break
            if found.start() > at:
                self._text(html[at : found.start()])
            at = found.end()
            end, start = found.group(1), found.group(2)
            if start:
                tag = start.lower()
                self._open(tag, found.group(3) or "")
                if tag in RAW:
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s>/])[^>]*>", re.I).search(html, at)
                    self._close(tag)
                    at = close.end() if close else n
            elif end:
                self._close(end.lower())
            elif found.group().startswith("<![CDATA["):
                self._text(found.group()[9:-3], False)
        while len(self.stack) > 1:
            self._pop()

    def _text(self, text: str, decode: bool = True) -> None:
        if not self.hidden:
            self.pieces.append((self.block, self.stack[-1], unescape(text) if decode and "&" in text else text))

    def _pop(self) -> None:
        e = self.stack.pop()
        if e.tag in BLOCK:
            self.block += 1
        self.hidden -= e.name == ""

    def _open(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag in ("br", "hr"):
                self.block += 1
            return
        if tag in BLOCK:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == "p":
                    while len(self.stack) > k:
                        self._pop()
                    break
                if self.stack[k].tag in HOLDS:
                    break
            self.block += 1
        if tag in CLOSES:
            some, within = CLOSES[tag]
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in within:
                    break
                if self.stack[k].tag in some:
                    while len(self.stack) > k:
                        self._pop()
                    break
        up = self.stack[-1]
        up.children.append(tag)
        name, marked, hidden, region = tag, tag in CHROME or tag == "header" and not up.region, tag in NO_TEXT or self.hidden > 0, ""
        classed = False
        if attributes and not hidden:
            held = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            role = held.get("role", "").lower()
            mark = f"{held.get('class', '')} {held.get('id', '')}".strip()
            if mark:
                classed = True
                name = f"{tag}.{' '.join(sorted(held.get('class', '').split()))}".replace("/", "|")
                words = {w.lower() for w in WORD.findall(unescape(mark))}
                marked = marked or tag not in WHOLE and (bool(words & SIGNS) or "header" in words and not up.region)
            marked = marked or tag not in WHOLE and role in ROLES
            hidden = "hidden" in held or held.get("aria-hidden", "").lower() == "true" or "display:none" in held.get("style", "").replace(" ", "").lower()
            region = "main" if role == "main" else ""
        region = "article" if tag == "article" or up.region == "article" else "main" if tag == "main" or region or up.region == "main" else ""
        # Plain flow of an article: neither it nor anything between it and the article has a class.
        plain = tag == "article" or up.plain and tag in FLOW and not classed
        e = Element(up, tag, "" if hidden else name, marked, region, plain)
        self.hidden += hidden
        if not hidden:
            self.elements.append(e)
        self.stack.append(e)

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                while len(self.stack) > k:
                    self._pop()
                return
            if tag not in HOLDS and self.stack[k].tag in HOLDS:
                break
        if tag in BLOCK:
            self.block += 1

    def text(self, removed: frozenset[str] | None = None) -> str:
        """The text without the removed branches; of a page seen alone (None), without the marked ones."""
        gone: dict[str, bool] = {}

        def is_gone(path: str) -> bool:
            if path not in gone:
                up, _, name = path.rpartition("/")
                gone[path] = (name[-1:] in ("!", "~") if removed is None else path in removed) or bool(up) and is_gone(up)
            return gone[path]

        blocks: dict[int, list[str]] = {}
        for block, e, text in self.pieces:
            if not is_gone(self.place(e)):
                blocks.setdefault(block, []).append(text)
        return "\n".join(x for x in (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items())) if x)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def tree_rows(pages: DataFrame) -> DataFrame:
    """(host, page, path, plain, style, features) of each element path of pages (host, html)."""
    schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("path", pa.string()), ("plain", pa.bool_()), ("style", pa.int64()), ("features", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for host, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                html = value.as_py()
                page, number = Page(html), hash_of(html)
                plain = {e.path for e in page.elements if e.plain or e.tag in WHOLE}
                out += [(host, number, path, path in plain, style, features) for path, (style, features) in page.seen().items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return pages.select("host", "html").mapInArrow(run, "host string, page long, path string, plain boolean, style long, features array<long>")


def importances(pages: DataFrame) -> DataFrame:
    """(host, path, plain, importance) of each branch of the tree, evidence included, from pages (host, html)."""
    rows = materialize(tree_rows(pages).distinct(), "style-tree")
    n, sums = F.count(F.lit(1)).alias("c"), lambda a, b: [F.sum("c").alias(a), F.sum(F.col("c") * F.log("c")).alias(b)]
    styles = rows.groupBy("host", "path", "plain", "style").agg(n).groupBy("host", "path").agg(*sums("m", "s"), F.max("plain").alias("plain"), F.max(F.col("style") != 0).alias("inner"))
    features = rows.select("host", "path", F.explode("features").alias("f")).groupBy("host", "path", "f").agg(n).groupBy("host", "path").agg(*sums("k", "l"))
    nodes = styles.join(features, ["host", "path"], "left").na.fill(0, ["k", "l"])
    entropy = F.when(F.col("m") > 1, 1 - F.col("s") / F.col("m") / F.log("m")).otherwise(1.0)
    nodes = nodes.withColumn("weight", F.when(F.col("inner"), F.col("m")).otherwise(0)).withColumn("style", F.col("weight") * entropy)
    # Each element counts for all branches it lies in; the tree has a row for each path, and is as small as its sites' templates.
    depth = F.size(F.split("path", "/"))
    up = nodes.withColumn("depth", depth).withColumn("d", F.explode(F.sequence(F.lit(1), "depth"))).withColumn("branch", F.expr("substring_index(path, '/', d)"))
    share, own = F.pow(F.lit(0.5), F.col("depth") - F.col("d")), F.col("d") == F.col("depth")
    branches = up.groupBy("host", "branch").agg(
        F.max(F.when(own, F.col("m"))).alias("m"), F.max(F.when(own, F.col("plain"))).alias("plain"), F.sum("k").alias("k"), F.sum("l").alias("l"),
        F.sum(F.col("weight") * share).alias("weight"), F.sum(F.col("style") * share).alias("style"),
    ).where("m is not null")
    presentation = F.coalesce(F.try_divide("style", "weight"), F.lit(0.0))
    content = F.when(F.col("m") > 1, F.coalesce(1 - F.try_divide("l", F.col("k") * F.log("m")), F.lit(0.0))).otherwise(1.0)
    found = 1 - (1 - presentation) * (1 - F.greatest(content, F.lit(0.0)))
    trusted = 1 - (1 - F.lit(1.0) / F.col("m")) * (1 - found)
    name = F.substring_index("branch", "/", -1)
    marks = F.when(name.rlike("!~?$"), EVIDENCE).otherwise(1.0) * F.when(name.endswith("~"), EVIDENCE).otherwise(1.0)
    # Plain flow of an article stays whatever its entropy.
    return branches.select("host", F.col("branch").alias("path"), "plain", (F.when(F.col("plain"), 1.0).otherwise(trusted) * marks).alias("importance"))


def unimportant(pages: DataFrame, importance: float = IMPORTANCE) -> DataFrame:
    """(host, paths) of the branches to remove, the topmost ones, from pages (host, html)."""
    low = materialize(importances(pages).where(F.col("importance") < importance).select("host", "path"), "low")
    below = low.select("host", F.concat("path", F.lit("/")).alias("above"))
    parent = F.expr("substring(path, 1, length(path) - length(substring_index(path, '/', -1)))")
    top = low.withColumn("above", parent).join(below, ["host", "above"], "left_anti")
    return top.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def main_text(pages: DataFrame, importance: float = IMPORTANCE) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages (page_id, url, html)."""
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    lists = materialize(sizes.join(unimportant(rows, importance), "host"), "branches")
    total = sizes.agg(F.sum("n").alias("n")).first().n or 0
    hot = lists.where(F.col("n") > total / HOT).agg(F.sum(F.length(F.array_join("paths", " "))).alias("n")).first().n or 0
    joined = with_groups(rows, lists, ["host"], total, outer=True) if hot <= LISTS_BYTES else rows.join(lists.hint("merge"), "host", "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(html.as_py()).text(frozenset(paths or ())) for html, paths in zip(batch.column(2), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=schema)

    return joined.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", "paths").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
