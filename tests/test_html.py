"""Extraction against a small tree built with the standard library's tokenizer."""

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from showloom.functions import html as H
from showloom.functions.elements import VOID_TAGS
from showloom.functions.html import css


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, dict(attrs), parent, []

    def walk(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def strings(self):
        for child in self.children:
            if isinstance(child, Node):
                if child.tag not in ("script", "style"):
                    yield from child.strings()
            elif child is not None:
                yield child

    @property
    def text(self):
        return "".join(self.strings())


class Tree(HTMLParser):
    """An end tag closes up to the last open element of its name, others are ignored."""

    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.root = self.open = Node("root", [], None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, attrs, self.open)
        self.open.children.append(node)
        if tag not in VOID_TAGS:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.open.children.append(Node(tag, attrs, self.open))

    def handle_endtag(self, tag):
        self.open.children.append(None)  # parts texts also where it closes nothing
        node = self.open
        while node and node.tag != tag:
            node = node.parent
        if node and node.parent:
            self.open = node.parent

    def _string(self, text):
        children = self.open.children
        if children and isinstance(children[-1], str):
            children[-1] += text
        else:
            children.append(text)

    def handle_data(self, data):
        self._string(data)

    def handle_entityref(self, name):
        import html

        self._string(html.unescape(f"&{name};"))

    def handle_charref(self, name):
        import html

        self._string(html.unescape(f"&#{name};"))

    def handle_comment(self, data):
        self.open.children.append(None)  # parts the text in front from the text behind


def matches(node, sel):
    cls = node.attrs.get("class") or ""
    return (
        (sel.tag is None or node.tag == sel.tag)
        and (sel.cls is None or sel.cls in cls.split())
        and (sel.exact is None or sel.exact == " ".join(cls.split()))
        and (sel.ident is None or sel.ident == node.attrs.get("id"))
    )


def find_all(html, sel):
    return [n for n in Tree(html).root.walk() if matches(n, sel)]


def random_html(rng, depth=0):
    pieces = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.random()
        if kind < 0.35 or depth > 9:
            pieces.append(rng.choice(["text", " a &amp; b ", "&eacute;&nbsp;", "\n", "x < y", "1 > 0", "&lt;div class=&quot;x&quot;&gt;"]))
        elif kind < 0.45:
            pieces.append(rng.choice(["<br>", "<img src='/i.png' class=x>", "<!-- <div class='x'>no</div> -->", "<script>var a='<div class=\"x\">'</script>"]))
        else:
            tag = rng.choice(["div", "div", "div", "span", "p", "DIV"])
            attrs = rng.choice(["", ' class="x"', " class='a x b'", ' class="xy"', ' id="k"', " class=x", ' data-class="x"', ' class="a x"\n id="k"',
                ' title="a>b" class="x"', " title=it's class='x'", ' CLASS="x" title=\'div class="x">\'', ' class="a  x "', " class = 'x'",
                ' class="a > x"', ' data-x="1=2" class="xx x"', " id='x' title"])
            end = rng.choice([f"</{tag.lower()}>"] * 8 + ["", "</div>", "</p>", "</b>"])
            pieces.append(f"<{tag}{attrs}{'/' if rng.random() < 0.05 else ''}>{random_html(rng, depth + 1)}{end}")
    return "".join(pieces)


SELECTORS = [css("div"), css(cls="x"), css("div", cls="x"), css("div", exact="a x b"), css(ident="k"), css("p"), css("span", cls="x")]


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(7)
    texts = [random_html(rng) for _ in range(400)]
    deep = "<div class='x'>" * 40 + "deep" + "</div>" * 40 + "<div>tail</div>"
    wide = "<div class='x'><div>" + "<p>y</p>" * 3000 + "</div>end</div>"
    made = spark.createDataFrame(list(enumerate(texts + [deep, wide])), "i int, h string")
    return made.select("i", "h", H.page(F.col("h")).alias("p")).cache()


@pytest.mark.parametrize("sel", SELECTORS, ids=str)
def test_elements_match_the_tree(samples, sel):
    html = F.col("p")
    got = samples.select(
        "h", H.every(html, sel, H.node_text).alias("all"), H.node_text(H.first(html, sel)).alias("first"),
        H.count(html, sel).alias("n"), H.has(html, sel).alias("any"), H.texts(html, sel).alias("texts"),
    ).collect()
    for row in got:
        expected = [n.text for n in find_all(row.h, sel)]
        assert row["all"] == expected, row.h
        assert row["first"] == (expected[0] if expected else None), row.h
        assert (row["n"], row["any"]) == (len(expected), bool(expected))
        assert row["texts"] == [t.strip() for t in expected]


def test_neighbours_match_the_tree(samples):
    """Previous siblings and next elements of every match, at any depth."""

    def around(m):
        before, after = H.previous_sibling(m, "div"), H.next_element(m, css("p"))
        return F.struct(H.node_text(before).alias("before"), H.node_text(after).alias("after"))

    for row in samples.select("h", H.each_match(F.col("p"), css(cls="x"), around).alias("v")).collect():
        nodes = list(Tree(row.h).root.walk())
        for n, (before, after) in zip((n for n in nodes if matches(n, css(cls="x"))), row.v, strict=True):
            siblings = [s for s in n.parent.children if isinstance(s, Node)]
            earlier = [s for s in siblings[: siblings.index(n)] if s.tag == "div"]
            later = [s for s in nodes[nodes.index(n) + 1 :] if s.tag == "p"]
            assert before == (earlier[-1].text if earlier else None), row.h
            assert after == (later[0].text if later else None), row.h


def test_visible_text_matches_the_tree(samples):
    for row in samples.select("h", H.visible_text(F.col("h")).alias("t")).collect():
        expected = " ".join(s for s in (x.strip() for x in Tree(row.h).root.strings()) if s)
        assert row.t == expected, row.h


def test_visible_text_of_null(value):
    assert value(H.visible_text, None) == ""


@pytest.mark.parametrize("html, sel, expected", [
    # an element left open ends with the one around it
    ("<ul><li>a<li>b</ul>tail", css("li"), ["ab", "b"]),
    ("<article><p><b>one<br><p>two</p><p>three</p><p>four<p>five</p></article><p>out</p>", css("p"),
     ["onetwothreefourfive", "two", "three", "fourfive", "five", "out"]),
    # one that closes itself has no content
    ('<div class="x"><div class="clear"/>A</div>B<p>C</p>', css("div", cls="x"), ["A"]),
    ("<tr><td/><td>b</td></tr>", css("td"), ["", "b"]),
    ("<a href=/x/>link</a>", css("a"), ["link"]),
    # an end tag that closes nothing is ignored, one that closes more closes all of it
    ("<p>a</div>b</p>c", css("p"), ["ab"]),
    ("<div><p>a<i>b</div>c", css("i"), ["b"]),
    ("<DIV>a</Div><div >b</div\n>", css("div"), ["a", "b"]),
    ("<div title='a>b' class=x>1</div><div class='>'>2", css("div"), ["1", "2"]),
    ("a < b <3 <p>c", css("p"), ["c"]),
    ("<p>a<p", css("p"), ["a<p"]),
    ("", css("p"), []),
    (None, css("p"), None),
])
def test_pairing(paged, html, sel, expected):
    assert paged(lambda c: H.texts(c, sel), html) == expected


def test_the_end_of_a_long_element_is_found_whatever_stands_at_any_place(paged):
    text = "".join(rf"word{i} " for i in range(280))[:1976]
    for n in range(1960, 1976):
        got = paged(lambda c: H.node_text(H.first(c, css("article"))), f"<article>{text[:n]}</a> MORE</article>tail")
        assert got == text[:n] + " MORE"


def test_deep_neighbours(paged):
    """Twelve levels down, as well as at the top."""
    for depth in (0, 5, 6, 7, 12):
        nest, end = "<div>" * depth, "</div>" * depth
        html = f"<h3>x</h3>{nest}<p class='t'>A</p>{end}<p class='t'>B</p>"
        got = paged(lambda c: H.each_match(c, css("h3"), lambda m: H.node_text(H.next_element(m, css(cls="t")))), html)
        assert got == ["A"]
        html = f"<section>{nest}<b>N{end}</b><div>near{nest}{end}</div> <p class='row'>r</p></section>"
        got = paged(lambda c: H.each_match(c, css(cls="row"), lambda m: H.node_text(H.previous_sibling(m, "div"))), html)
        assert got == ["near"]


def test_time_grows_with_what_comes_out(spark, tmp_path):
    pages = {
        "open": "<ul>" + "<li>x" * 8000 + "</ul>", "closed": "<ul>" + "<li>x</li>" * 100_000 + "</ul>",
        "ends": "<ul>" + "<li>x</b>" * 4000 + "</ul>", "cut": "<a " * 50_000, "quotes": "<a x='" * 20_000 + ">",
    }
    df = spark.createDataFrame(list(pages.items()), "name string, h string")
    df.write.parquet(str(tmp_path / "p"))
    read = spark.read.parquet(str(tmp_path / "p")).select("name", H.page(F.col("h")).alias("p"))
    for name in pages:
        start = time.perf_counter()
        found = read.filter(F.col("name") == name).select(F.size(H.texts(F.col("p"), css("li"))).alias("n")).first().n
        assert time.perf_counter() - start < 10, name
        assert found == {"open": 8000, "closed": 100_000, "ends": 4000}.get(name, 0)


def test_attributes(paged):
    tags = {
        "<a href='/x?a=1&amp;b=2'>": "/x?a=1&b=2", '<a data-href="no" HREF = "/y z">': "/y z", "<a href=/z>": "/z",
        "<a href=''>": "", "<a name='href'>": None, "<a>": None, "<a href>": "", "<a href='1' href='2'>": "1",
        "<a href='/?a=1&copy=2&copy;&copyx &copy &#65'>": "/?a=1&copy=2©&copyx © A", "<a title=it's href='x'>": "x",
    }
    for tag, expected in tags.items():
        assert paged(lambda c: H.first_attribute(c, css("a"), "href"), tag) == expected, tag
        assert paged(lambda c: H.attribute(H.first(c, css("a")), "href"), tag) == expected, tag


def test_links_and_tables(paged):
    html = "<ul><li> <b>A</b> &amp; b <a href='/1'>x</a></li><li>none</li></ul>"
    got = paged(lambda c: H.link_structs(c, "n", "u", css("li")), html)
    assert [tuple(x) for x in got] == [("A & b x", "/1"), ("none", None)]
    table = "<table><tr><th>h</th></tr><tr><td> a</td><td><b>1</b></td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>"
    assert paged(H.table_rows, table) == [[], ["a", "1"], ["a", "b", "c"]]
    assert [tuple(r) for r in paged(lambda c: H.named_rows(c, ["A", "B"]), table)] == [("a", "1")]


@pytest.mark.parametrize("html, expected", [
    ("<h3>Related</h3><a href='1'>x</a><br> , <i>n<i>m</i></i><a href='2'>y</a><a href='3'>z</a>", ["1", "2"]),
    ("<h3><b>Related</b></h3></div><p><a href='1'>x</a></p><p><a href='2'>y</a></p>", None),
    ("<h3>Related</h3></div><p><a href='1'>x</a><a href='2'>y</a></p>", ["1", "2"]),  # behind the region
    ("<h3>Related</h3><a href='1'>x</a>", None),
    ("<h3> Related</h3><a href='1'>x</a><a href='2'>x</a>", "none"),
    ("<h3><i></i>Related</h3><a href='1'>x</a><a href='2'>x</a>", "none"),
    ("</div><h3>Related</h3><a href='1'>x</a><a href='2'>x</a>", "none"),
    ("none", "none"),
])
def test_next_and_sibling(paged, html, expected):
    links = lambda m: F.transform(H.next_and_sibling(m, "a"), lambda a: a["href"])
    got = paged(lambda c: H.each_match(c, css("h3"), links, string=["Related"], within=css(ident="box")), f"<div id=box>{html}</div>")
    assert got == ([] if expected == "none" else [expected])


def test_previous_sibling(paged):
    html = "<div class=box><div>N<b>1</b></div> <p>x</p><div class='row'><div>i</div></div><div class='row'>2</div></div>"
    got = paged(lambda c: H.each_match(c, css(cls="row"), lambda m: H.node_text(H.previous_sibling(m, "div"))), html)
    assert got == ["N1", "i"]
    first = "<div class=box><div class='row'>2</div></div>"
    assert paged(lambda c: H.each_match(c, css(cls="row"), lambda m: H.node_text(H.previous_sibling(m, "div"))), first) == [None]


def test_next_element(paged):
    html = "<h3>A</h3><p>x</p><h3>B</h3><div class='t'>1<div>2</div></div><h3>C</h3>"
    got = paged(lambda c: H.each_match(c, css("h3"), lambda m: H.node_text(H.next_element(m, css(cls="t")))), html)
    assert got == ["12", "12", None]


def test_pages_are_paired_in_pieces():
    import pyarrow as pa

    from showloom.functions import elements

    long = "<p class='a b' id=x>t<b>u</b></p>" * (elements.PIECE_BYTES // 50)
    html = pa.array([long, None, "", long, "<i>é</i>", long, None])
    pieces = list(elements.in_pieces(iter([html, html[:0], html[4:5]])))
    assert [len(p) for p in pieces] == [3, 2, 2, 0, 1]  # at most so many bytes at a time
    whole = elements.pages(html).to_pylist()
    assert [row for p in pieces for row in p.to_pylist()] == whole + whole[4:5]


def test_a_fragment_holds_what_is_inside_it(paged):
    html = "<i>0</i><div><p>1<b>2</b></p><p>3</p></div><p>4</p>"

    def shown(f):
        return F.struct(F.transform(f["elements"], lambda e: e["tag"]), f["texts"])

    got = paged(lambda c: H.each_match(H.first(c, css("div")), css("p"), lambda m: shown(H.element(m))), html)
    assert [tuple(r) for r in got] == [(["p", "b"], ["1", "2"]), (["p"], ["3"])]


def test_pairing_hides_what_markup_hides(value):
    import pyarrow as pa

    from showloom.functions import elements

    random.seed(4)
    bits = [
        "<p>", "</p>", "a", "<", "-", "--", "-->", "<!--", "<!-->", "<script>", "<SCRIPT a='<'>", "</Script >", "</scripts>",
        "<style>", "</style>", "<template\x0bx>", "</template>", "<!DocType a>", "<!doctype", "<ſcript>", "é", '<a title="<!-- b -->">',
    ]
    texts = ["".join(random.choices(bits, k=25)) for _ in range(400)]
    hidden = value(lambda c: F.transform(c, H.markup), texts, "array<string>")
    assert hidden != texts
    got = elements.pages(pa.array(texts)).to_pylist()
    assert got == elements.pages(pa.array(hidden)).to_pylist()


def test_a_kind_of_tag_is_read_once():
    from showloom.functions import elements

    batch = elements.Batch()
    batch.add("<p class='a  b'>x</p><P class='a  b'>y<br></p>" * 50)
    assert len(batch.kind) == 151 and batch.tag == ["", "p", "p", "br"] and batch.cls == [None, " a b ", " a b ", None]


@pytest.mark.parametrize("between", [0, 1, 14, 15, 16, 17, 270, 271, 272, 273, 900])
def test_neighbours_at_any_distance(paged, between):
    html = "<div>a<div>no</div></div>" + "<i>-</i>" * between + "<h3>b</h3>" + "<i>-</i>" * between + "<div>c</div><div>d</div>"

    def both(m):
        return F.array(H.node_text(H.previous_sibling(m, "div")), H.node_text(H.next_element(m, css("div"))))

    assert paged(lambda c: H.each_match(c, css("h3"), both), html) == [["ano", "c"]]
    lone = "<div><div>no</div>" + "<i>-</i>" * between + "<h3>b</h3></div>" + "<i>-</i>" * between
    assert paged(lambda c: H.each_match(c, css("h3"), both), lone) == [["no", None]]
    inner = "<div>out" + "<section>" + "<i>-</i>" * between + "<h3>b</h3></section></div>"
    assert paged(lambda c: H.each_match(c, css("h3"), both), inner) == [[None, None]]


def test_near_neighbours_do_not_cost_the_whole_page(paged):
    def seconds(n):
        html = "<section>" + "<div>a</div><b class='x'>b</b><p>c</p>" * n + "</section>"
        start = time.perf_counter()
        got = paged(lambda c: F.size(H.each_match(c, css("b"), lambda m: F.array(
            H.node_text(H.previous_sibling(m, "div")), H.node_text(H.next_element(m, css("p")))))), html)
        assert got == n
        return time.perf_counter() - start

    seconds(10)
    assert seconds(6000) < 2 + 6 * seconds(1500)  # 16 times as long where each looks through all
