import random
import time
from dataclasses import replace
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalog import layouts
from winnow.functions import nodes as N
from winnow.operators import profiles as P
from winnow.operators.extract import extract
from winnow.sources import html
from winnow.sources.html import _NodeColumns, html_nodes


def scan(*pages):
    columns = _NodeColumns()
    for page in pages:
        columns.add_page(page)
    nodes, errors = columns.arrays()
    nodes.validate(full=True)
    return nodes.to_pylist(), errors.to_pylist()


def outline(page):
    """Nested form: tag(children…), text in quotes."""
    nodes = scan(page)[0][0]

    def show(n):
        if n["tag"] == "#text":
            return repr(n["text"])
        inner = " ".join(show(c) for c in nodes if c["parent"] == n["pre"])
        return f"{n['tag']}({inner})"

    return " ".join(show(n) for n in nodes if n["parent"] == -1)


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a<p>b", "p('a') p('b')"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "ul(li('a') li('b' ul(li('c'))) li('d'))"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "dl(dt('a') dd('b') dt('c'))"),
        ("<a href=1>x<a href=2>y</a>z", "a('x') a('y') 'z'"),
        ("<p><b>x</p>y", "p(b('x')) 'y'"),
        ("a</i>b", "'ab'"),
        ("a<!-- x -->b", "'a' 'b'"),
        ("a<!doctype html>b<?x?>c", "'a' 'b' 'c'"),
        ("<br>a<img src=x>b<hr/>", "br() 'a' img() 'b' hr()"),
        ("<div/>a", "div('a')"),
        ("<script>if (a<b) '</p>'</script>x", "script() 'x'"),
        ("<style>p{}</STYLE >x", "style() 'x'"),
        ("<script>never closed <p>x", "script()"),
        ("<title>a <b> &amp; c</title>x", "title('a <b> & c') 'x'"),
        ("<template><p>x<a>y</a></p></template>z", "template(p(a())) 'z'"),
        ("<ruby>a<rt>b</rt></ruby>", "ruby('a' rt())"),
        ("<table><tr><td>a<td>b</div></tr><tr><th>c</table>d", "table(tr(td('a') td('b')) tr(th('c'))) 'd'"),
        ("<div><table><tr><td></div>x</table></div>", "div(table(tr(td('x'))))"),
        ("<h1>a<h2>b</h2>", "h1('a') h2('b')"),
        ("1 < 2 &lt; 3 &am &amp x", "'1 < 2 < 3 &am & x'"),
        ("\xa0 x \u2003", "'x'"),
        ("  \n\xa0", ""),
        ("a<p", "'a'"),
        ("", ""),
        ("<P>x</p>", "p('x')"),
        ("<!-->x", "'x'"),
        ("a<!-- open", "'a'"),
    ],
)
def test_tree(page, want):
    assert outline(page) == want


def test_attributes():
    (nodes,), _ = scan(
        """<a HREF="/x?a=1&amp;b=2&copy=3&amp" class='p  q' data-x=1/2 checked a="1" a="2" title=it's empty="">"""
    )
    assert dict(nodes[0]["attrs"]) == {
        "href": "/x?a=1&b=2&copy=3&", "class": "p  q", "data-x": "1/2", "checked": "",
        "a": "1", "title": "it's", "empty": "",
    }


def test_only_the_wanted_attributes():
    page = '<a href="x" class="c" STYLE="s">t</a><b href="y" href="z">'
    for wanted, want in [(None, 4), (frozenset(("href",)), 2), (frozenset(), 0), (frozenset(("style", "id")), 1)]:
        columns = _NodeColumns(wanted)
        columns.add_page(page)
        nodes = columns.arrays()[0].to_pylist()[0]
        found = [kv for n in nodes for kv in n["attrs"]]
        assert len(found) == want
        assert wanted is None or {k for k, _ in found} <= wanted
    assert dict(scan(page)[0][0][-1]["attrs"]) == {"href": "y"}


def test_profiles_name_the_attributes_they_need():
    assert P.SIMPLE.attributes() == {"href"}
    assert P.LEVER.attributes() == {"href", "class", "data-qa"}
    assert P.WORKDAY.attributes() == {"href", "data-automation-id"}
    assert P.TEAMTAILOR.attributes() == {"href", "class", "title"}
    assert P.WORKABLE.attributes() == {"href", "class", "data-ui"}


def check_shape(nodes):
    for i, n in enumerate(nodes):
        assert n["pre"] == i and i <= n["last"] < len(nodes)
        assert -1 <= n["parent"] < i
        if n["parent"] >= 0:
            up = nodes[n["parent"]]
            assert up["pre"] < i <= n["last"] <= up["last"] and n["depth"] == up["depth"] + 1
        else:
            assert n["depth"] == 0
        if n["tag"] == "#text":
            assert n["text"] and n["text"] == n["text"].strip() and n["last"] == i


PIECES = ["<a href=x>", "</a>", "<p>", "</p>", "<li>", "</li>", "<ul>", "</ul>", "<b>", "</b>", "<td>", "<tr>",
          "<table>", "</table>", "<div class='c d'>", "</div>", "<br>", "<script>", "</script>", "<title>", "</title>",
          "<template>", "</template>", "<!--", "-->", "<", ">", "&amp;", "&", " ", "text", '"', "'", "=", "/", "<h1>",
          "<h2>", "<dd>", "<dt>", "<dl>", "é", "\x00"]


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.sampled_from(PIECES), max_size=40))
def test_any_markup_gives_a_proper_tree(pieces):
    (nodes,), (error,) = scan("".join(pieces))
    assert error is None
    check_shape(nodes)


class Reference(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.starts = []

    def handle_starttag(self, tag, attrs):
        self.starts.append((tag, {k: v or "" for k, v in reversed(attrs)}))


def test_same_tags_as_the_standard_library():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist()
    got, errors = scan(*pages)
    assert not any(errors)
    for page, nodes in zip(pages, got):
        check_shape(nodes)
        ref = Reference()
        ref.feed(page)
        ref.close()
        assert [(n["tag"], dict(n["attrs"])) for n in nodes if n["tag"] != "#text"] == ref.starts


@pytest.mark.parametrize(
    "unit", ["<", "<!", "<!--", "<a b='1>' ", "<a ", '<a x="', "<b>", "<p>", "</p>", "<li><b>", "<a><table>", "&", "<title>", "<script>", "<p><table>"]
)
def test_hostile_pages_take_linear_time(unit):
    start = time.perf_counter()
    (nodes,), (error,) = scan(unit * 40_000)
    assert error is None and time.perf_counter() - start < 8


def test_many_attributes_take_linear_time():
    start = time.perf_counter()
    (nodes,), (error,) = scan("<a " + " ".join(f"a{i}=x" for i in range(100_000)) + ">")
    assert len(nodes[0]["attrs"]) == 100_000 and time.perf_counter() - start < 8


def test_depth_is_not_bounded():
    (nodes,), _ = scan("<div>" * 5000 + "x")
    check_shape(nodes)
    assert max(n["depth"] for n in nodes) >= 4999


def test_a_failing_page_leaves_the_others_alone(monkeypatch):
    columns = _NodeColumns()
    columns.add_page("<p class=x>a")
    scan_page = columns._scan

    def fail(page, base):
        scan_page(page, base)
        raise ValueError("bad page")

    columns._scan = fail
    columns.add_page("<div class=y>lost")
    columns._scan = scan_page
    columns.add_page("<b id=z>c")
    nodes, errors = columns.arrays()
    nodes.validate(full=True)
    assert [[n["tag"] for n in page] for page in nodes.to_pylist()] == [["p", "#text"], [], ["b", "#text"]]
    assert nodes.to_pylist()[2][0]["attrs"] == [("id", "z")]
    assert errors.to_pylist() == [None, "ValueError: bad page", None]


def test_as_table(spark):
    pages = spark.createDataFrame([(1, "<p>a<p> b "), (2, None), (3, "")], "page_id int, html string")
    texts = html_nodes(pages, "page_id").withColumn("text", N.page_text(F.col("nodes")))
    rows = texts.orderBy("page_id").collect()
    assert [(r.page_id, r.text, r.error) for r in rows] == [(1, "a\nb", None), (2, "", None), (3, "", None)]


def test_large_batches_are_cut(spark):
    body = "<p>" + "x" * 200_000
    pages = spark.range(60).selectExpr("id page_id", f"repeat('<i>', 2) || id html").coalesce(1)
    big = spark.range(60).selectExpr("id page_id", f"'{body}' || id html").coalesce(1)
    for df in (pages, big):
        rows = html_nodes(df, "page_id").select("page_id", N.page_text(F.col("nodes")).alias("t")).collect()
        assert len({r.page_id for r in rows}) == 60
        assert all(r.t.endswith(str(r.page_id)) for r in rows)


@pytest.mark.parametrize("unit", ["<p><button>", "<ul><li><ul>", "<table><tr><td><table>", "<select><option><select>"])
def test_implied_ends_take_linear_time(unit):
    """Open elements that none of the next ends: their tags' levels are looked at, not they themselves."""

    def seconds(n):
        page = unit + "<div>" * n + "</td></li>" * n
        start = time.perf_counter()
        (nodes,), (error,) = scan(page)
        assert error is None and len(nodes) == n + unit.count("<")
        return time.perf_counter() - start

    seconds(1000)
    few, many = min(seconds(5_000) for _ in range(3)), min(seconds(40_000) for _ in range(3))
    assert many < 24 * few and many < 4


def plain_parents(tags):
    """Parents of the elements, found by walking up from the innermost open one."""
    open_, parents = [], []

    def close(ends, shield):
        for i in range(len(open_) - 1, -1, -1):
            if open_[i][0] in ends:
                del open_[i:]
                return
            if open_[i][0] in shield:
                return

    for tag in tags:
        if tag.startswith("/"):
            if open_ and open_[-1][0] == tag[1:]:
                open_.pop()
            elif any(t == tag[1:] for t, _ in open_):
                close((tag[1:],), () if tag[1:] in html._TABLE_ENDS else html._CELLS)
            continue
        for ends, shield in html._IMPLIED_ENDS.get(tag, ()):
            close(ends, shield)
        if tag in html._HEADINGS and open_ and open_[-1][0] in html._HEADINGS:
            open_.pop()
        parents.append(open_[-1][1] if open_ else -1)
        open_.append((tag, len(parents) - 1))
    return parents


def test_implied_ends_equal_a_walk_over_open_elements():
    draw = random.Random(6)
    names = "p div ul li dl dd dt a b button table tr td th tbody thead caption select option optgroup h1 h2 object template".split()
    for _ in range(1500):
        tags = [draw.choice(["", "", "/"]) + draw.choice(names) for _ in range(draw.randrange(25))]
        (nodes,), _ = scan("".join(f"<{t}>" for t in tags))
        assert [n["parent"] for n in nodes] == plain_parents(tags), tags


def plain_nearest(nodes, tag):
    out = []
    for n in nodes:
        at = n["parent"]
        while at >= 0 and nodes[at]["tag"] != tag:
            at = nodes[at]["parent"]
        out.append(at)
    return out


def test_nearest_ancestors_and_next_matches(spark):
    draw = random.Random(7)
    pages = ["".join(draw.choice(["<li>", "<div>", "</div>", "</li>", "<ul>", "x<b>", "</ul>", "</b>"]) for _ in range(draw.randrange(40))) for _ in range(60)]
    pages += ["", "<li>" + "<div>" * 300 + "x", "<div>" * 257, "<li>"]
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    select = N.Select(tags=("b",))
    found = html_nodes(rows, "page_id").select(
        "page_id", N.enclosing(F.col("nodes"), "li").alias("up"), N.next_match(F.col("nodes"), select).alias("next"),
        F.transform("nodes", lambda n: N.first_below(F.col("nodes"), n, [N.next_match(F.col("nodes"), select)])["pre"]).alias("below"),
    )
    for r in found.collect():
        (nodes,), _ = scan(pages[r.page_id])
        hits = [n["pre"] for n in nodes if n["tag"] == "b"]
        assert r.up == plain_nearest(nodes, "li")
        assert r.next == [next((h for h in hits if h >= i), -1) for i in range(len(nodes))]
        assert r.below == [next((h for h in hits if n["pre"] < h <= n["last"]), None) for n in nodes]


def test_rows_of_many_links_take_linear_time(spark):
    """Links thousands of elements deep, all in one row or each in a row of its own within the last."""
    link = '<a data-automation-id="jobTitle" href="/{}">TD {}</a>'

    def page(n, nested):
        if nested:
            return "".join("<ul><li>" + link.format(i, i) for i in range(n)) + '<dd data-automation-id="locations">Lyon</dd>'
        return '<li><dl><dd data-automation-id="locations">Lyon</dd></dl>' + "<div>" * n + "".join(link.format(i, i) for i in range(n))

    def seconds(n, nested):
        rows = spark.createDataFrame([(1, "https://x.io", page(n, nested))], "page_id long, url string, html string")
        start = time.perf_counter()
        found = extract(rows, replace(P.WORKDAY, roles=None), keep=("page_id", "url")).collect()
        assert len(found) == n and {r.location for r in found} == {"Lyon"}
        return time.perf_counter() - start

    for nested in (False, True):
        seconds(100, nested)
        few, many = seconds(2_500, nested), seconds(10_000, nested)
        assert many < 8 * few + 1, (nested, few, many)


def test_deep_pages_of_one_small_file_are_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layouts, "_DEEP_PAGES", 3, raising=False)
    parts = [(i, f"name {i}") for i in range(30)]
    spark.createDataFrame(parts, "p_partkey long, p_name string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    scanned, scan = [], layouts.html_nodes

    def counted(pages, *args, **kwargs):
        scanned.append(pages.rdd.getNumPartitions())
        return scan(pages, *args, **kwargs)

    monkeypatch.setattr(layouts, "html_nodes", counted)
    monkeypatch.setattr("winnow.operators.extract.html_nodes", counted)
    found = layouts.deep_pages(spark, str(tmp_path))
    rows = sorted(tuple(r) for r in found.collect())
    assert rows == [(i, 1003 + i, f"name {i}", f"https://careers.smartrecruiters.com/{i}", 1002 + i) for i in range(30)]
    assert scanned == [10, 10]


def test_runs_of_tags_are_taken_as_one_by_one(monkeypatch):
    """Begins or ends in a row, whatever they end, shield or silence, between text, comments and broken markup."""
    draw = random.Random(8)
    names = "p div ul li dl dd a b span section button table tr td select option h1 h2 object template br img title script rt DIV x-y x1".split()
    other = [" ", "x &amp; y", "<!-- <div><div><div><div> -->", '<a href="<b><b><b><b>">', "<i class=x>", "<", "</", "<div", "<p/>", "\xa0"]

    def page():
        out, open_ = [], []
        for _ in range(draw.randrange(1, 12)):
            kind = draw.random()
            if kind < 0.4:
                some = draw.sample(names, draw.randrange(1, 4))
                new = draw.choices(some, k=draw.randrange(1, 9))
                out += [f"<{t}>" for t in new]
                open_ += new
            elif kind < 0.8:
                for _ in range(draw.randrange(1, 9)):
                    out.append(f"</{open_.pop() if open_ and draw.random() < 0.97 else draw.choice(names)}>")
            else:
                out.append(draw.choice(other))
        return "".join(out)

    pages = [page() for _ in range(3000)] + ["<div>" * 700 + "x" + "</div>" * 690 + "</p></div>" * 9 + "y", "</b></b></b></b>x", "<b><i><b><i>"]
    assert sum(html._RUN.search(p) is not None for p in pages) > 2000
    got = scan(*pages)
    monkeypatch.setattr(html, "_RUN", html.re.compile(r"(?!)"))
    assert got == scan(*pages)


def test_deep_markup_is_read_in_runs(monkeypatch):
    page = "".join(f"<{t}>" for t in ("div", "b", "section", "i")) * 2_000
    page += "x" + "".join(f"</{t}>" for t in ("i", "section", "b", "div")) * 2_000

    def seconds():
        start = time.perf_counter()
        _NodeColumns().add_page(page)
        return time.perf_counter() - start

    runs = min(seconds() for _ in range(5))
    monkeypatch.setattr(html, "_RUN", html.re.compile(r"(?!)"))
    assert runs < 0.7 * min(seconds() for _ in range(5))


@pytest.mark.parametrize("unit", ["<ul><li>", "</x>", "<b><b><b><b><br>", "<b><b><b><b></b></x></x></x>", "<ul><li><a>x</a></li></ul></div><div><b>"])
def test_runs_that_cannot_be_taken_take_linear_time(unit):
    def seconds(n):
        start = time.perf_counter()
        _NodeColumns().add_page(unit * n)
        return time.perf_counter() - start

    seconds(500)
    few, many = min(seconds(2_500) for _ in range(3)), min(seconds(20_000) for _ in range(3))
    assert many < 24 * few


def test_scanned_pages_are_extracted_without_another_scan(spark, monkeypatch):
    pages = spark.createDataFrame(
        [(1, "https://x.io", '<a href="/job/1">TD one</a><a href="/job/2">TD two</a>'), (2, "https://x.io", "none"), (3, "https://x.io", None)],
        "page_id long, url string, html string",
    )
    want = sorted(tuple(r) for r in extract(pages, P.SIMPLE, keep=("page_id", "url")).collect())
    scanned = html_nodes(pages, "page_id", "url", attributes=P.SIMPLE.attributes())
    monkeypatch.setattr(type(pages), "mapInArrow", None)
    assert len(want) == 2 and sorted(tuple(r) for r in extract(scanned, P.SIMPLE, keep=("page_id", "url")).collect()) == want
    every = extract(scanned, P.SIMPLE, keep=("page_id", "url"), every=True).select("page_id", "title").collect()
    assert sorted((r.page_id, r.title or "") for r in every) == [(1, "TD one"), (1, "TD two"), (2, ""), (3, "")]


def test_deep_pages_are_scanned_once(spark, tmp_path, monkeypatch):
    """Rows that share a key meet each other's depths; parts without a name list nothing."""
    parts = [(1, "a"), (1, "a"), (2, None), (3, "b"), (3, None), (4, "c</h4></a><li class='opening-job'><a href='/x'><h4>d"), (None, "e")]
    spark.createDataFrame(parts, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    scans, scan_ = [], type(spark.range(1)).mapInArrow

    def counted(df, *args, **kwargs):
        scans.append(df)
        return scan_(df, *args, **kwargs)

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", counted)
    rows = [(r.page_id, r.pos, r.title, r.depth) for r in layouts.deep_pages(spark, str(tmp_path)).collect()]
    assert sorted(rows, key=str) == [
        *[(1, 1004, "a", 1003)] * 4, (3, 1006, "b", 1005), (3, 1006, "b", None), (4, 1007, "c", 1006), (4, 1011, "d", 1006),
    ]
    assert len(scans) == 1
