"""Main text of web pages: site templates found by counting element subtrees per host, then page furniture."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtide.llm.common import WordHasher, shingle_set
from logtide.session import written

#: A subtree is a template if so many different articles of its host have it; a lone paragraph also needs this share of them.
MIN_PAGES, PROSE_SHARE, PROSE_PAGES = 4, 0.5, 10
SALTS = 16

# Fixed values of HTML and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul""".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figcaption caption td th tr".split())
SPACE = frozenset("br td th img".split())
REMOVED = frozenset("""script style noscript template head title nav footer aside form button select option optgroup datalist textarea input label
    iframe object embed applet svg canvas audio video map dialog menu search noembed noframes""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status log tablist note".split())
FURNITURE = frozenset("""ad ads adv advert advertisement adverts advertising adsense sponsor sponsored sponsors promo promos promotion banner banners
    cookie cookies consent gdpr notice notices disclaimer newsletter subscribe subscription signup sidebar sidebars aside menu menus nav navbar
    navigation breadcrumb breadcrumbs topbar masthead footer header toolbar comment comments commentlist reply replies respond disqus discussion
    share sharing social related recommended recommendations trending popup popups modal overlay login search pagination pager widget widgets""".split())
REMARKS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
OF_ARTICLE = frozenset("article post entry story content".split())

#: Which open element a start tag ends, and where the search for it stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}), "body": ({"head"}, set())}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:.-]*+)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    __slots__ = ("tag", "up", "items", "names", "hidden", "role", "size", "links", "linked", "digest", "heads")

    def __init__(self, tag: str, up: Node | None):
        self.tag, self.up, self.items = tag, up, []
        self.names, self.hidden, self.role = frozenset(), False, ""
        self.size = self.links = self.linked = 0
        self.digest, self.heads = 0, False


def _attributes(node: Node, text: str) -> None:
    for name, value in _ATTRIBUTE.findall(text):
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name in ("class", "id"):
            node.names |= {w.lower() for w in _WORDS.findall(value)}
        elif name in ("role", "itemprop"):
            node.role = node.role or value.strip().lower()
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            node.hidden = True


def parse(html: str) -> list[Node]:
    """The elements of a page in document order, the first standing for the whole; texts in ``items`` are decoded.

    Lenient as browsers are: missing end tags are implied, unmatched ones skipped, what is cut off at the end is closed.
    """
    top = Node("#page", None)
    nodes, stack, at = [top], [top], 0
    is_open: Counter[str] = Counter()
    last = html.rfind(">")

    def pop_to(depth: int) -> None:
        for n in stack[depth:]:
            is_open[n.tag] -= 1
        del stack[depth:]

    def put(text: str) -> None:
        if text:
            stack[-1].items.append(unescape(text))

    while at < len(html):
        lt = html.find("<", at)
        if lt < 0 or lt > last:
            put(html[at:] if lt < 0 else html[at:lt] + ("" if re.match(r"<[a-zA-Z/!?]", html[lt:lt + 2]) else html[lt:]))
            break
        put(html[at:lt])
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = len(html) if end < 0 else end + 3
            continue
        if html.startswith("<![CDATA[", lt):
            end = html.find("]]>", lt)
            at = len(html) if end < 0 else end + 3
            put(html[lt + 9:at - 3])
            continue
        if html[lt + 1:lt + 2] in ("!", "?") or re.match(r"</[^a-zA-Z]", html[lt:lt + 3]):
            at = html.find(">", lt) + 1
            continue
        m = _TAG.match(html, lt)
        if not m:
            put("<")
            at = lt + 1
            continue
        close, tag, rest = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        tag, at = tag.lower(), m.end()
        if close:
            if is_open[tag]:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    if stack[depth].tag in BLOCK and (tag not in BLOCK or tag == "p") or stack[depth].tag in ("table", "td", "th") and tag not in BLOCK - {"p"}:
                        break
                    depth -= 1
                else:
                    pop_to(depth)
            continue
        if tag in BLOCK and is_open["p"]:
            depth = len(stack) - 1
            while stack[depth].tag != "p" and stack[depth].tag not in BLOCK and stack[depth].up:
                depth -= 1
            if stack[depth].tag == "p":
                pop_to(depth)
        if tag in ENDS:
            ended, stops = ENDS[tag]
            if any(is_open[t] for t in ended):
                depth = len(stack) - 1
                while depth and stack[depth].tag not in ended and stack[depth].tag not in stops:
                    depth -= 1
                if stack[depth].tag in ended:
                    pop_to(depth)
        node = Node(tag, stack[-1])
        if rest and re.search(r"class|id|role|hidden|style|itemprop", rest, re.I):
            _attributes(node, rest)
        stack[-1].items.append(node)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            body, at = (html[at:], len(html)) if not end else (html[at:end.start()], html.find(">", end.start()) + 1 or len(html))
            if tag not in REMOVED and body:
                node.items.append(body)
        elif tag not in VOID and not rest.endswith("/"):
            stack.append(node)
            is_open[tag] += 1
        elif tag not in VOID and tag in BLOCK:
            stack.append(node)
            is_open[tag] += 1
    return nodes


def _measure(nodes: list[Node]) -> None:
    """Bottom up: letters, letters inside links, number of links, headings inside, and the hash of the subtree."""
    for n in reversed(nodes):
        h = hashlib.blake2b(n.tag.encode(), digest_size=8)
        for x in n.items:
            if isinstance(x, str):
                words = x.split()
                n.size += sum(map(len, words))
                if words:
                    h.update("\x00".join(words).encode(errors="replace") + b"\x01")
            else:
                n.size += x.size
                n.links += x.links
                n.linked += x.linked
                n.heads |= x.heads
                h.update(x.digest.to_bytes(8, "little", signed=True))
        if n.tag == "a":
            n.links, n.linked = n.links + 1, n.size
        n.heads |= n.tag in ("h1", "main") or n.role in ("main", "articlebody")
        n.digest = int.from_bytes(h.digest(), "little", signed=True)


def _furniture(n: Node, page: int) -> bool:
    """Menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments, by element, role and class names."""
    if n.tag in REMOVED or n.hidden or n.role in ROLES:
        return True
    if n.tag == "header" and not _inside(n, "article", "main"):
        return True
    names = n.names & FURNITURE
    if names and n.tag not in ("html", "body", "main") and not n.heads:
        if names & REMARKS:
            return True
        if not (names <= {"header", "banner"} and n.names & OF_ARTICLE) and 2 * n.size <= page:
            return True
    menu = n.tag in ("ul", "ol", "div", "section", "table") and n.links >= 2 and 10 * n.linked >= 8 * n.size and not n.heads
    return menu and n.size > 0 and not _inside(n, "article")


def _inside(n: Node, *tags: str) -> bool:
    n = n.up
    while n is not None:
        if n.tag in tags:
            return True
        n = n.up
    return False


class Article:
    """What is left of a page without its furniture: the article elements, else the main element, else the body."""

    def __init__(self, html: str):
        self.nodes = parse(html)
        _measure(self.nodes)
        page = self.nodes[0].size
        gone: set[int] = set()
        under: dict[int, bool] = {}
        mains, articles, heads = [], [], []
        for n in self.nodes:
            at = id(n)
            if n.up is not None and (id(n.up) in gone or _furniture(n, page)):
                gone.add(at)
                continue
            within = n.up is not None and under[id(n.up)]
            under[at] = within
            if n.tag == "article" and within:  # by the rules of HTML, comments on the outer one
                gone.add(at)
            elif n.tag == "article":
                articles.append(n)
                under[at] = True
            elif n.tag == "main" or n.role in ("main", "articlebody"):
                mains.append(n)
            elif n.tag == "h1" and not within:
                heads.append(n)
        self.gone = gone
        if articles:
            titled = any(a.heads for a in articles)
            self.roots = articles if titled else sorted(heads[:1] + articles, key=self.nodes.index) if heads else articles
        else:
            self.roots = mains[:1] or self.nodes[:1]
        self.size = sum(r.size for r in self.roots)

    def parts(self) -> Iterator[Node]:
        """Elements inside the roots that are not furniture, have text and are less than half of it."""
        stack = list(self.roots[::-1])
        while stack:
            n = stack.pop()
            if id(n) in self.gone:
                continue
            if n.up is not None and n not in self.roots and n.size and 2 * n.size <= self.size and (n.tag in BLOCK or n.tag in PROSE):
                yield n
            stack.extend(x for x in reversed(n.items) if not isinstance(x, str))

    def blocks(self, templates: frozenset[int] | set[int] = frozenset()) -> list[str]:
        """The texts of the blocks in page order, without furniture and subtrees in ``templates``."""
        out, run = [], []

        def end() -> None:
            text = " ".join("".join(run).split())
            if text:
                out.append(text)
            run.clear()

        for root in self.roots:
            stack: list = [root]
            while stack:
                x = stack.pop()
                if isinstance(x, str):
                    run.append(x)
                elif x is None:
                    end()
                elif x.tag in SPACE and x.tag in VOID:
                    run.append(" ")
                elif id(x) in self.gone or x.digest in templates and x not in self.roots and 2 * x.size <= self.size:
                    if x.tag in BLOCK:
                        end()
                    elif x.tag not in ("script", "style", "template"):
                        run.append(" ")
                else:
                    if x.tag in BLOCK:
                        end()
                        stack.append(None)
                    elif x.tag in SPACE:
                        run.append(" ")
                        stack.append(" ")
                    stack.extend(reversed(x.items))
            end()
        return out


FEATURES = "k1 long, k2 long, host string, article long, subtrees array<long>, prose array<boolean>"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct subtrees of each page, and one hash that near copies of an article mostly share: its least 5-word shingle."""
    hasher = WordHasher()
    for batch in batches:
        articles, subtrees, prose = [], [], []
        for html in batch.column(3):
            page = Article(html.as_py() or "")
            parts = {n.digest: n.tag in PROSE for n in page.parts()}
            shingles = shingle_set(hasher.words(" ".join(page.blocks()).encode(errors="replace")))
            articles.append(int(shingles[0].view("i8")) if len(shingles) else 0)
            subtrees.append(list(parts))
            prose.append(list(parts.values()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(articles, pa.int64()), pa.array(subtrees, pa.list_(pa.int64())), pa.array(prose, pa.list_(pa.bool_()))],
                                         names=["k1", "k2", "host", "article", "subtrees", "prose"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column(2), batch.column(3), strict=True)
        texts = ["\n".join(Article(h.as_py() or "").blocks(set(t.as_py() or ()))) for h, t in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([t.encode(errors="replace").decode() for t in texts], pa.string())],
                                         names=["page_id", "url", "text"])


def host(url):
    """The lower-case host of a URL; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def templates(features: DataFrame, min_pages: int = MIN_PAGES, prose_share: float = PROSE_SHARE, prose_pages: int = PROSE_PAGES) -> DataFrame:
    """``host, subtree``: subtrees in at least ``min_pages`` different articles of the host.

    Pages that carry copies of one article count as one, so a copied article is no template. A single paragraph, heading or
    list item must be in ``prose_pages`` articles and in ``prose_share`` of all of its host: less is a passage that
    documents share, not the site's.
    """
    known = features.where("host IS NOT NULL")
    sizes = known.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    each = known.select("host", "article", F.explode(F.arrays_zip("subtrees", "prose")).alias("s"))
    each = each.select("host", "article", F.col("s.subtrees").alias("subtree"), F.col("s.prose").alias("prose")).distinct()
    counts = each.groupBy("host", "subtree", "prose").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    sure = ~F.col("prose") | (F.col("n") >= F.greatest(F.lit(prose_pages), F.col("articles") * prose_share))
    return counts.join(sizes, "host").where(sure).select("host", "subtree")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, prose_share: float = PROSE_SHARE, prose_pages: int = PROSE_PAGES) -> DataFrame:
    """``page_id, url, text``: blocks of the article joined by line ends; character references decoded, blanks folded.

    Subtrees of elements are hashed (tags and texts, no attributes) and counted per host; those that recur in many
    different articles are deleted (see ``templates``). Page furniture that a host shows too rarely to be counted goes by its
    element, role or class. Nothing else is dropped.

    Null html counts as empty and gives an empty text; pages without a host have no templates; every row gives one row,
    repeated rows and null ids too; further columns are not read. Memory follows the longest page. Hot hosts: subtrees are
    counted with partial sums, and the lookup of a host's templates is salted.
    """
    cols = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    keys = [F.xxhash64("url", "html").alias("k1"), F.xxhash64(F.lit(1), "html", "url").alias("k2")]
    rows = pages.select(*cols)
    features = written(rows.select(*keys, host(F.col("url")).alias("host"), "html").mapInArrow(_features, FEATURES), "page-features")
    found = templates(features, min_pages, prose_share, prose_pages)
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = features.where("host IS NOT NULL").select("k1", "k2", "host", F.pmod("k1", F.lit(SALTS)).cast("int").alias("salt"), F.explode("subtrees").alias("subtree"))
    hits = written(each.join(salted, ["host", "subtree", "salt"]).groupBy("k1", "k2").agg(F.collect_set("subtree").alias("gone")), "page-templates")
    copies = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt")
    hits = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.select(*keys, copies, "page_id", "url", "html").join(hits, ["k1", "k2", "salt"], "left")
    return joined.select("page_id", "url", "html", "gone").mapInArrow(_texts, "page_id long, url string, text string")
