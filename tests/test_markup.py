"""Selectors and page jobs on markup written in many ways, against a plain-Python tree."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from comptoir.operators import extract as X
from comptoir.operators import markup as M


def run(spark, pages, f):
    d = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    return [r.x for r in d.select("i", f(M.canonical("html")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize(("html", "want"), [
    ("<p>it's = 'x'</p>", "<p>it's = 'x'</p>"),
    ("<a href='/b'>x</a>", '<a href="/b">x</a>'),
    ("<A HREF=/b>x</A>", '<a HREF="/b">x</a>'),
    ("<a title='say \"hi\"'>x</a>", '<a title="say &quot;hi&quot;">x</a>'),
    ('<a title="1 > 0 > -1" b>x</a>', '<a title="1 &gt; 0 &gt; -1" b>x</a>'),
    ("<a x = 'y' z>k = l</a>", '<a x="y" z>k = l</a>'),
    ("a<!-- <b c='d'> -->z", "az"),
    ("a < b and <c", "a < b and <c"),
    ("", ""), (None, None), ("no tags", "no tags"),
    ("<a b='x>y'>\u0001\u0003t</a>", '<a b="x&gt;y">t</a>'),
])
def test_canonical_form(spark, html, want):
    assert run(spark, [html], lambda h: h) == [want]


class Tree(HTMLParser):
    """Elements as (name, attributes, start, end) with their texts; a plain stand-in for a page library."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.open, self.all, self.n = [], [], 0
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.n += 1
        e = {"tag": tag, "attrs": dict(attrs), "parents": list(self.open), "text": [], "n": self.n}
        self.all.append(e)
        if tag not in M.VOID:
            self.open.append(e)

    def handle_endtag(self, tag):
        if self.open and self.open[-1]["tag"] == tag:
            self.open.pop()

    def handle_data(self, data):
        for e in self.open:
            e["text"].append(data)

    def select(self, test):
        return [e for e in self.all if test(e)]


def has(e, tag=None, cls=(), ident=None):
    have = (e["attrs"].get("class") or "").split()
    return (tag is None or e["tag"] == tag) and all(c in have for c in cls) and (ident is None or e["attrs"].get("id") == ident)


SELECTORS = {
    ".a": lambda e: has(e, cls=["a"]),
    "div.b.a": lambda e: has(e, "div", ["a", "b"]),
    "span": lambda e: has(e, "span"),
    "#k": lambda e: has(e, ident="k"),
    ".a .b": lambda e: has(e, cls=["b"]) and any(has(p, cls=["a"]) for p in e["parents"]),
    "div span.c": lambda e: has(e, "span", ["c"]) and any(has(p, "div") for p in e["parents"]),
    "div .a i": lambda e: has(e, "i") and any(has(p, cls=["a"]) and any(has(q, "div") for q in p["parents"]) for p in e["parents"]),
    "[data-x^='u']": lambda e: (e["attrs"].get("data-x") or "").startswith("u"),
    "img[src]": lambda e: e["tag"] == "img" and "src" in e["attrs"],
}


def page(r, depth=0):
    out = []
    for _ in range(r.randint(0, 3)):
        tag = r.choice(["div", "span", "i", "p", "img"])
        q = r.choice("'\"")
        attrs = [r.choice(["", f" class={q}{' '.join(r.sample('abc', r.randint(1, 3)))}{q}"]), r.choice(["", f" id={q}k{q}"]),
                 r.choice(["", f" data-x={q}u > v{q}", " hidden", f" src = {q}/i{q}"])]
        r.shuffle(attrs)
        inside = "" if tag == "img" else (page(r, depth + 1) if depth < 4 else "t") + r.choice(["", "x", " &amp; y"]) + f"</{tag}>"
        out.append(r.choice(["", "w", "<!-- <div class='a'> -->"]) + f"<{tag}{''.join(attrs)}>{inside}")
    return "".join(out)


def test_selectors_match_a_tree(spark):
    r = random.Random(7)
    pages = [page(r) for _ in range(150)] + [None, ""]
    for sel, test in SELECTORS.items():
        want = [[] if p is None else ["".join(e["text"]).strip() for e in Tree(p).select(test)] for p in pages]
        found = run(spark, pages, lambda h, s=sel: F.transform(M.all_elements(h, s), lambda e: M.inner_text(e["body"])))
        assert [x or [] for x in found] == want, sel
        first = run(spark, pages, lambda h, s=sel: M.first_text(h, s))
        assert first == [w[0] if w else None for w in want], sel
    d = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").withColumn("html", M.canonical("html"))
    names = {f"f{k}": s for k, s in enumerate(SELECTORS)}
    for x in M.with_texts(d, "html", names).collect():
        for k, test in enumerate(SELECTORS.values()):
            want = [] if pages[x.i] is None else Tree(pages[x.i]).select(test)
            assert x[f"f{k}"] == ("".join(want[0]["text"]).strip() if want else None)


def test_selectors_that_are_not_supported():
    for s in ("a > b", "a:first-child", "", "a + b", "a, b"):
        with pytest.raises(ValueError):
            M.selector(s)


def test_probed_faults_are_gone(spark):
    def pages(html):
        return spark.createDataFrame([(1, "https://x/dp/B000000001/", html)], "page_id long, url string, html string")
    listing = ("<div data-component-type='s-search-result' data-asin='B000000002'><span class='a-price'><span class='x a-offscreen'>£9</span></span></div>")
    assert X.extract_listing(pages(listing)).first().prix == "£9"
    assert X.extract_reviews(pages("<div data-hook='review'><span data-hook='review-body'>ok</span></div>")).first().comment == "ok"
    assert X.extract_specs(pages("<table id='productDetails_techSpec_section_1'><tr><th>A</th><td>1</td></tr></table>")).first().spec_value == "1"
    facet = ('<span class="a-size-base big a-color-base puis-bold-weight-text">Brand</span><ul class="a-unordered-list"><span class="x a-list-item">'
             "<a href='/s?a=1&amp;rh=p_1%3A2' class='a-link-normal s-navigation-item z'><b><span class='a-size-base a-color-base y'>V</span></b></a></span></ul>")
    assert [(r.category_name, r.name, r.url, r.filter_key) for r in X.extract_facets(pages(facet)).collect()] == [
        ("Brand", "V", "https://shop.example/s?a=1&rh=p_1%3A2", "p_1")]
    doc = X.facets_document(pages(facet), category=F.lit("laptops")).first()
    assert doc.category == "laptops" and doc.product_urls == [] and list(doc.filters) == ["Brand"]
    assert [r.href for r in X.page_links(pages("<a href='/b?x=1&amp;y=2'>l</a><a name=z>n</a>")).collect()] == ["/b?x=1&y=2"]


def test_blanks_beyond_ascii_are_stripped(spark):
    from comptoir.functions.text import strip_ws
    values = ["\u00a0 x \u3000", "\x1cy\u2029\n", "z", " \u2003 ", "", None]
    d = spark.createDataFrame([(i, v, f"<p>{v or ''}</p>") for i, v in enumerate(values)], "i int, s string, html string")
    assert [r.x for r in d.select("i", strip_ws("s").alias("x")).orderBy("i").collect()] == [v if v is None else v.strip() for v in values]
    assert [r.x for r in M.with_texts(d, "html", {"x": "p"}).orderBy("i").collect()] == [(v or "").strip() for v in values]


def test_pivot_takes_the_later_page(spark):
    html = "<table id='productDetails_techSpec_section_1'><tr><th>A</th><td>{}</td></tr></table>"
    pages = spark.createDataFrame([(1, "https://x/dp/B000000009/a", html.format("1")), (2, "https://x/dp/B000000009/b", html.format("2"))],
                                  "page_id long, url string, html string")
    assert X.spec_pivot(X.extract_specs(pages), ["A"]).first()["A"] == "2"


def test_next_page_stops_at_the_limit(spark):
    pages = spark.createDataFrame([(1, 3, '<li class="x a-last"><a href="/s?page=4">n</a></li>'), (2, 10, '<li class="a-last"><a href="/s?page=11">n</a></li>'),
                                   (3, 4, '<li class="a-last">end</li>')], "page_id int, n int, html string")
    assert [tuple(r) for r in X.next_pages(pages, number="n").collect()] == [(1, "https://shop.example/s?page=4")]


def test_fields_are_cut_out_in_one_pass(spark):
    pages = ["<span class='x'>a</span>", "<p>x</p><span class='x'></span>", "<span class='x'><span>a</span> b</span> c", "<span class='x'>a<span>b<span>c</span></span>d</span>e",
             "<span class='x'>open <span>b</span>", "<span class='x'>open", "<p title='x'>no</p>", "<b title='1 > 0' class='x'>q</b>", "<img class='x'>t</img>", "x", "", None,
             "<span title='x'>1</span><span class='xx'>2</span><span class='y x z'>3</span>", "<spanner class='x'>s</spanner><span class='x'>a<spanner>n</spanner></span>",
             "<p title='a <span' class='x'>in</p>", "<span\n  class\n=\n'x'>lines</span>", "<span class='x' title='<b'>v</span>"]
    d = spark.createDataFrame(list(enumerate(pages)), "i int, html string").select("i", M.canonical("html").alias("html"))
    fields = {"a": "span.x", "b": ".x", "c": "[class='x']", "e": "p .x", "f": "span span", "g": "span"}
    got = M.with_texts(d, "html", fields)
    want = d.select("i", *[M.first_text("html", s).alias(n) for n, s in fields.items()])
    assert [tuple(r) for r in got.orderBy("i").select("i", *fields).collect()] == [tuple(r) for r in want.orderBy("i").collect()]
    text = spark.createDataFrame([("<p>",)], "html string")
    plan = M.with_texts(text, "html", {"a": "span.x"})._jdf.queryExecution().optimizedPlan().toString()
    assert "instr(" not in plan and "Contains(html" in plan  # no second search for the tag, none without what it holds


def test_pages_in_canonical_form_are_left_alone(spark):
    pages = ['<a href="/s?k=">x</a>', '<!DOCTYPE html>\n<p a="b c" d\te="">it\'s = \'x\' "y"</p><br/>', '<b title="f=\'x\'">u  =v</b>']
    assert run(spark, pages, lambda h: h) == pages


def test_contents_are_those_of_the_elements(spark):
    r = random.Random(11)
    deep = ["".join("<div class='a'>" * n + "t" + "</div>" * n) for n in range(1, M.NESTED_LEVELS + 4)]
    pages = [page(r) for _ in range(100)] + deep + ["<div class='a'>open<div>", "<div class='a'></div>", "<div class='a'>x<divan></div>y", "<p>x</p>", "", None]
    for sel in ("div", "div.a", ".a", "span.b", "img"):
        part = M.selector(sel)[0]
        got = run(spark, pages, lambda h, p=part: M.contents(h, p))
        assert got == run(spark, pages, lambda h, p=part: F.transform(M.elements(h, p), lambda e: e["body"])), sel
    d = spark.createDataFrame(list(enumerate(deep)), "i int, html string").select("i", M.canonical("html").alias("html"))
    assert [x.t for x in M.with_texts(d, "html", {"t": "div.a"}).collect()] == ["t"] * len(deep)


@pytest.mark.parametrize(("sel", "holds"), [("span", "<span"), ("div#k.a", 'id="k"'), ("a[href]", "href"), ("[data-x^='u > v']", 'data-x="u &gt; v'),
                                            ("div[id$='-card']", '-card"'), ("[class*='a-star-']", "a-star-"), (".a", "a"), ("i[data-hook='r']", 'data-hook="r"')])
def test_what_a_tag_must_hold(sel, holds):
    assert M.selector(sel)[0].holds == holds
