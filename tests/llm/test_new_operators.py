"""Hard negatives, collocations and main text: oracles, plain versions, odd tables, planted pages."""

import glob
import itertools
import math
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.llm import collocations, hard_negatives, html_text, queries
from logtide.sources.tables import table
from tests.llm import plain


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf, "*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_is_its_oracle(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf)
    want = duck.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    got = sorted(tuple(r[c] for c in columns) for r in df.collect())
    assert got and got == sorted(tuple(r[i] for i in at) for r in want.fetchall())


# -- 11: hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, v string, floor long, block int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "x", 1, 2) for i, v, y in rows], VECTORS)


def plain_mine(rows, anchors):
    """rows: (id, vector, label); ids may repeat, then the smallest (label, vector) counts."""
    one = {}
    for i, v, y in rows:
        if i is not None and y is not None and plain.usable(v):
            row = (y, [math.floor(256 * x) for x in map(float, v)])
            one[i] = min(one.get(i, row), row)
    out = []
    for a in sorted(i for i in one if anchors(i)):
        scored = sorted((-sum(x * y for x, y in zip(one[a][1], w, strict=True)), i, y) for i, (y, w) in one.items() if i != a and len(w) == len(one[a][1]))
        for s, p, _ in [x for x in scored if x[2] == one[a][0]][:5]:
            fits = [x for x in scored if x[2] != one[a][0] and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(a, p, r, i, -s, -n) for r, (n, i, _) in enumerate(fits[:3], 1)]
    return sorted(out)


def mined(df, **sizes):
    found = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **sizes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


SMALL = {"block_rows": 4, "anchor_rows": 2, "reader_blocks": 2, "page_blocks": 3}


def test_hilbert_curve_steps_to_neighbours():
    for d, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        index = hard_negatives.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_interval_products_hold_every_product():
    rng = np.random.default_rng(2)
    for scale in (10, 1 << 30, 1 << 45):
        a, m = rng.integers(-scale, scale, (5, 6)), rng.integers(-scale, scale, (40, 6))
        exact = np.array([[max(hard_negatives.LEAST, min(hard_negatives.MOST, sum(int(x) * int(y) for x, y in zip(r, c, strict=True)))) for c in m] for r in a])
        assert (hard_negatives.products(a, m) == exact).all()
        low, high = hard_negatives.interval_products(a, m.min(0)[None], m.max(0)[None])
        assert (low <= exact).all() and (exact <= high).all()


def test_hard_negatives_are_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((4, 6))
    rows = [(i, centres[i % 4] + 0.4 * rng.standard_normal(6), int(rng.integers(3))) for i in range(0, 700, 5)]
    want = plain_mine(rows, lambda i: i % 50 == 0)
    assert len(want) > 50
    assert mined(vectors(spark, rows), **SMALL) == want
    assert mined(vectors(spark, rows)) == want


def test_hard_negatives_odd_rows(spark):
    a, b = [1.0, 0.5], [0.6, 0.2]
    rows = [(0, a, 1), (0, a, 1), (0, b, 2), (50, b, 1), (1, a, 1), (2, a, 1), (3, b, 2), (4, b, 3), (5, b, 2), (6, b, 2), (None, a, 1), (7, a, None), (8, None, 1),
            (9, [None, 1.0], 1), (10, [math.nan, 1.0], 2), (11, [math.inf, 1.0], 2), (12, [], 1), (100, [0.0, 0.0], 2), (150, [1.0, 1.0, 1.0], 1),
            (13, [1.0, 1.0, 1.0], 1), (14, [0.7, 0.7, 0.7], 2), (200, [-1.0, -1.0], 9), (15, [1.0, 1.0], 9), (16, [1e30, 1.0], 4), (17, [-1e30, 2.0], 4)]
    rows += [(300 + i, a, 1) for i in range(30)]  # copies of one vector, more than a block
    want = plain_mine([r for r in rows if r[0] not in (16, 17)], lambda i: i % 50 == 0)
    assert want
    assert mined(vectors(spark, [r for r in rows if r[0] not in (16, 17)]), **SMALL) == want
    assert len(mined(vectors(spark, rows), **SMALL)) >= 1  # components past 64 bits do not fail
    assert mined(vectors(spark, [])) == []
    assert mined(vectors(spark, [(1, a, 1), (2, b, 2)])) == []


# -- 12: collocations

DOCS = "doc_id long, text string, lang string, n long, code long, w string, word string"


def plain_phrases(rows, least=30, top=2000):
    split, blank = ".,;:!?\n\x0b\x0c\r", " \t"
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else "\n" if c in split else " " if c in blank else c for c in text or "")
        for piece in text.split("\n"):
            words = [w for w in piece.split(" ") if w]
            n[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, *words[i:i + m]) for i in range(len(words) - m + 1))
    f = {k: a for k, a in f.items() if a >= least}
    above = {}
    for k, a in f.items():
        if len(k) > 3:
            for part in (k[:-1], k[:1] + k[2:]):
                above[part] = max(a, above.get(part, 0))
    out = []
    for k, a in f.items():
        if len(k) < 3 or 100 * above.get(k, 0) >= 80 * a:
            continue
        score, _, left, right = min((2000000 * a // (f[k[:c]] + f[k[:1] + k[c:]]), c, f[k[:c]], f[k[:1] + k[c:]]) for c in range(2, len(k)))
        out.append((k[0], -score, -a, " ".join(k[1:]).encode(), left, right))
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def phrases(df, **kw):
    found = collocations.collocations(df, **kw)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, found.collect()))


def test_collocations_of_odd_texts(spark):
    rng = random.Random(3)
    words = ["ab", "AB", "é", "É", "日本", "x", "yy", "z-z", "q\xa0q", "w" * 300]
    texts = [(" ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",", "\t", "\r\n", "\x0b"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und", ""]))
             for _ in range(2500)]
    texts += [(None, "en"), ("", "en"), (" .,;\n", None), ("same " * 3000, "en"), ("a b c d e. " * 40, "es"), ("a b c d e. " * 40, "es"), ("tail", "en"), ("head", "en")]
    texts += [("deep in the", "de"), ("forest", "de")] * 40
    df = spark.createDataFrame([(1, t, x, 5, 6, "w", "word") for t, x in texts], DOCS)
    want = plain_phrases(texts)
    assert len(want) > 100 and any("\xa0" in r[2] for r in want)
    assert phrases(df) == want
    assert phrases(df, top=3) == plain_phrases(texts, top=3)


def test_collocations_do_not_depend_on_sizes(spark):
    rng = random.Random(9)
    texts = [(" ".join(rng.choice("abcdefgh") for _ in range(200)), "en") for _ in range(60)]
    df = spark.createDataFrame([(1, t, x, 5, 6, "w", "word") for t, x in texts], DOCS).repartition(5)
    assert phrases(df) == plain_phrases(texts)
    # Slices, flushes, stripe rows and filters of the smallest size give the same counts.
    import pyarrow as pa
    for slice_bytes, flush, entries in ((16, 50, 2), (64, 1, 1)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(collocations, "SLICE_BYTES", slice_bytes)
            m.setattr(collocations, "FLUSH_WORDS", flush)
            m.setattr(collocations, "ROW_ENTRIES", entries)
            batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in texts] + [None, ""]), pa.array([x for _, x in texts] + ["en", None])], names=["text", "lang"])
            n = Counter()
            for b in collocations.count_words(0)(iter([batch])):
                n.update({c: k for c, k in zip(b.column(1).to_pylist(), [0] * b.num_rows, strict=True)})
                for c, k in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                    n[c] += k
            assert sorted(n.values()) == sorted(Counter(" ".join(t for t, _ in texts).split()).values())


def test_stripes_merge_across_batches_and_segments():
    import pyarrow as pa
    rng = np.random.default_rng(1)
    prefix, nxt = rng.integers(1, 6, 5000), rng.integers(0, 40, 5000)
    hot, parts = np.array([2, 3]), np.array([4, 2])
    rows = []
    for lo in range(0, 5000, 700):
        p, x = prefix[lo:lo + 700], nxt[lo:lo + 700]
        with pytest.MonkeyPatch.context() as m:
            m.setattr(collocations, "ROW_ENTRIES", 7)
            for b in collocations._stripe_rows([p], x, collocations._segments(p, x, hot, parts)):
                rows += b.to_pylist()
    rows.sort(key=lambda r: (r["p1"], r["p2"], r["p3"], r["segment"]))
    assert {r["segment"] for r in rows if r["p1"] == 2} == {0, 1, 2, 3}
    schema = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("p3", pa.int64()), ("segment", pa.int32()), ("next", pa.binary()), ("counts", pa.binary()), ("word", pa.string())])
    batches = [pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names} for r in rows[i:i + 13]], schema) for i in range(0, len(rows), 13)]
    merged = [r for b in collocations.merge_stripes(20, True)(iter(batches)) for r in b.to_pylist()]
    pairs = Counter(zip(prefix.tolist(), nxt.tolist(), strict=True))
    assert {(r["p1"], r["next"]): r["n"] for r in merged if r["next"] is not None} == {k: v for k, v in pairs.items() if v >= 20 and k[1]}
    sums = Counter()
    for r in merged:
        if r["next"] is None:
            sums[r["p1"]] += r["n"]
    assert sums == Counter(prefix.tolist())
    rare = [pa.RecordBatch.from_pylist([r for r in rows if r["p1"] == 2 or r["p1"] == 5][:9], schema)]
    left = [r for b in collocations.merge_stripes(10 ** 6, True)(iter(rare)) for r in b.to_pylist()]
    assert left and {r["p1"] for r in left} == {2}  # parts of a stripe stay, whole ones below the count go


def test_collocations_empty(spark):
    assert phrases(spark.createDataFrame([], DOCS)) == []
    assert phrases(spark.createDataFrame([(1, "a b", "en", 1, 1, "", "")] * 29, DOCS)) == []
    rows = spark.createDataFrame([(1, "a b. c", "en", 1, 1, "", "")] * 30, DOCS)
    assert phrases(rows) == [("en", 1, "a b", 30, 30, 30, 90, 1000000)]


# -- 13: main text

PAGES = "page_id long, url string, html string, text string, host string, gone int, n_chars int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", "h", 1, 2) for i, u, h in rows], PAGES)


def texts_of(df, **kw):
    return sorted(((r.page_id, r.url, r.text) for r in html_text.main_text(df, **kw).collect()), key=repr)


def one(html):
    return "\n".join(html_text.Article(html).blocks())


def test_main_text_of_given_pages(spark, sf):
    """In the given pages the article is one element of headings and paragraphs, of which all stays."""
    import html as h
    import re
    rows = queries.op13_main_text(spark, sf).collect()
    given = {r.page_id: r.html for r in table(spark, sf, "pages").collect()}
    assert len(rows) == len(given)
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", given[r.page_id], re.S).group(1)
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_main_text_markup():
    assert one("") == one("<p") == one("<!-- a") == "" and one("<") == "<"
    assert one("a &lt;b&gt; &amp;amp; &#233;&eacute;&nbsp; c") == "a <b> &amp; éé c"
    assert one("<p>one<p>two<ul><li>x<li>y</ul>z") == "one\ntwo\nx\ny\nz"
    assert one("<p>a <b>b<br>c</b>d<!-- no > --> e</p>") == "a b cd e"
    assert one("<table><tr><td>1<td>2<tr><td>3</table>") == "1 2\n3"
    assert one("<script>if (a</b) '<p>x</p>'</script>t<style>p{}</style><SCRIPT src=x></SCRIPT >u") == "tu"
    assert one('<p title="a > b" data-x=\'>\'>t</p><p title="broken>u</p>') == "t\nu"
    assert one("<div><p>a</div>b</section></p>c 3 < 4 & 5 > 2") == "a\nbc 3 < 4 & 5 > 2"
    assert one("<article><p>kept</p></article><p>cut") == "kept"
    assert one("<div>" * 5000 + "deep") == "deep"
    assert one("<a" * 50_000) == "" and one("<a \"" * 20_000 + ">t") in ("", "t")
    assert len(one("<p>" + "word " * 200_000)) == 999_999


def test_main_text_furniture():
    page = """<html><head><title>T</title></head><body class="has-sidebar"><header><a href=/>Site</a></header><div id="cookie-banner">We use cookies</div>
      <ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul><main><h1>Head</h1><div class="share-buttons">Tweet</div><p>First text of the article.</p>
      <div class="adBox ad">Buy</div><figure><img alt=x><figcaption>Caption</figcaption></figure><p>Second text, more of it, and a <a href=x>link</a>.</p>
      <form><label>Mail</label><input><button>Go</button></form><div role="note">Notice</div><p hidden>secret</p><section id="comments"><article class="comment"><p>Nice</p>
      </article></section></main><aside>Side</aside><footer>&copy; me</footer></body></html>"""
    assert one(page) == "Head\nFirst text of the article.\nCaption\nSecond text, more of it, and a link."
    assert one("<body><h1>Out</h1><article><p>in</p></article></body>") == "Out\nin"
    assert one("<article><header class='entry-header'><h1>H</h1></header><p>in</p><footer>by</footer></article>") == "H\nin"
    assert one("<body><article><p>kept kept</p></article><div class=comments><article><p>no</p></article></div>") == "kept kept"


def test_main_text_inside_the_article():
    assert one("<article><p>text</p><ul><li><a href=a>one</a><li><a href=b>two</a></ul><section><article><p>remark</p></article></section></article>") == "text\none\ntwo"
    assert one("<body><header><h1>Site</h1></header><main><header><h1>T</h1></header><p>text</p></main>") == "T\ntext"


def site(n, host="a.example", article=False):
    """Pages of one template without telling names: menu, teaser and imprint are plain boxes around a body of its own."""
    rng = random.Random(n)
    out = []
    for i in range(n):
        body = [" ".join(rng.choice("lorem ipsum dolor sit amet elit sed do".split()) + str(rng.randint(0, 99)) for _ in range(40)) for _ in range(3)]
        inner = f"<h1>T{i}</h1><p>{body[0]}</p><div>Read <i>more</i> of our best stories</div><p>{body[1]}</p><p>{body[2]}</p>"
        html = f"""<body><div><span>Start</span> <span>News</span></div><div>{inner}</div><div><p>Imprint of this site</p><p>Call us</p></div></body>"""
        out.append((i, f"https://{host}/p{i}", html, "\n".join([f"T{i}", *body])))
    return out


def test_site_templates_are_deleted(spark):
    many, few = site(12), site(2, "b.example")
    got = texts_of(pages(spark, [r[:3] for r in many + few]))
    want = [(i, u, t) for i, u, _, t in many]
    want += [(i, u, "\n".join(["Start News", *t.split("\n")[:2], "Read more of our best stories", *t.split("\n")[2:], "Imprint of this site", "Call us"])) for i, u, _, t in few]
    assert got == sorted(want, key=repr)


def test_copies_and_shared_passages_are_no_templates(spark):
    box = "<div>Box of the site</div>"
    rows = [(i, f"http://c.example/{i}", f"<body><article><h1>Same</h1><div>Part one of it</div><p>And the end of it all here</p>{box}</article><footer>{i}</footer></body>")
            for i in range(30)]
    rows += [(100 + i, f"http://c.example/{i}", f"<body><article><h1>Own {i}</h1><p>{i} words of its own here</p><p>Released under the MIT License.</p>{box}</article></body>")
             for i in range(9)]
    got = dict((r[0], r[2]) for r in texts_of(pages(spark, rows)))
    assert all(got[i] == "Same\nPart one of it\nAnd the end of it all here" for i in range(30))
    assert all(got[100 + i] == f"Own {i}\n{i} words of its own here\nReleased under the MIT License." for i in range(9))


def test_main_text_odd_rows(spark):
    rows = [(None, None, None), (1, "x", None), (1, "x", None), (2, None, "<p>a</p>"), (2, None, "<p>a</p>"), (3, "http:///x", "<p>b"), (4, "HTTP://U:P@Host.Example:80/x", ""),
            (5, "https://h", "\x00<p>퟿ c</p>")]
    assert texts_of(pages(spark, rows)) == sorted([(i, u, {2: "a", 3: "b", 5: "\x00\n퟿ c"}.get(i, "")) for i, u, _ in rows], key=repr)
    assert [r.h for r in pages(spark, rows).select(html_text.host(F.col("url")).alias("h")).collect()].count(None) == 6
    assert texts_of(pages(spark, [])) == []
