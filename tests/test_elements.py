"""Elements found in one pass, compared with a document tree."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from joblark.functions import html
from joblark.functions.elements import _TAG, Scan, attributes, found, with_elements
from joblark.functions.html import Page, Selector
from joblark.operators import detail
from joblark.schemas import DETAIL_PAGE
from joblark.sources.sites import SITES
from tests.dom import select, tree
from tests.test_html import RAW_PAGES, pages

CARD = {"tag": "div", "classes": ("job-card",)}
RULES = {
    "div": lambda p: html.text(html.first(p, Selector("div"))),
    "span3": lambda p: html.text(html.first(p, Selector("span"), 3), "\n"),
    "card": lambda p: html.text(html.first(p, Selector(**CARD))),
    "salary": lambda p: html.text(html.first(p, Selector(**{"class": "salary"}))),
    "no_location": lambda p: html.first(p, Selector(**{"class": "location"})).isNull(),
    "cards": lambda p: F.size(html.open_tags(p, Selector(**CARD))),
    "links": lambda p: html.texts(html.flat(p, Selector("a"))),
    "keywords": lambda p: html.texts(html.flat(p, Selector("a", href="keyword="))),
    "hrefs": lambda p: F.transform(html.open_tags(p, Selector("a")), lambda t: html.attr(t, "href")),
    "boxes": lambda p: html.texts(html.outermost(p, Selector("div", ("page",)))),
    "dated": lambda p: html.raw_text(html.first_where(p, "span|section", lambda e: F.contains(html.raw_text(e), F.lit("5/3")))),
    "nested": lambda p: html.texts(html.within(p, Selector("nav"), Selector("div", ("page",)), Selector("a"))),
}


def expected(root):
    one = lambda found, sep="": found[0].text(sep) if found else ""
    links, boxes = select(root, "a"), select(root, "div", ("page",))
    dated = [n for n in root.walk() if n.tag in ("span", "section") and "5/3" in n.raw()]
    held = lambda n: any(b in boxes and any(a.tag == "nav" for a in b.ancestors()) for b in n.ancestors())
    return {
        "div": one(select(root, "div")), "span3": one(select(root, "span")[2:], "\n"), "card": one(select(root, **CARD)),
        "salary": one(select(root, **{"class": "salary"})), "no_location": not select(root, **{"class": "location"}),
        "cards": len(select(root, **CARD)), "links": [a.text() for a in links], "keywords": [a.text() for a in select(root, "a", href="keyword=")],
        "hrefs": [a.attrs["href"] for a in links], "boxes": [b.text() for b in boxes if not any(a in boxes for a in b.ancestors())],
        "dated": dated[0].raw() if dated else None, "nested": [a.text() for a in links if held(a)],
    }


@pytest.mark.parametrize("broken, how", [(0, ""), (0.1, "open"), (0.4, "open"), (0.1, "stray"), (0.4, "stray"), (0.1, "cross"), (0.4, "cross")])
def test_elements_agree_with_a_document_tree(spark, broken, how):
    made = pages(broken, how)
    df = spark.createDataFrame(list(enumerate(made)), "i int, html string")
    for row in with_elements(df, ["i"], **RULES).collect():
        want = expected(tree(made[row["i"]]))
        assert {n: row[n] for n in RULES} == want, made[row["i"]]


@pytest.mark.skipif(not RAW_PAGES.exists(), reason="no test tables")
def test_raw_pages(spark):
    rules = {
        "p2": lambda p: html.text(html.first(p, Selector("p"), 2), "\n"), "nav": lambda p: html.text(html.first(p, Selector("nav")), "|"),
        "outer": lambda p: F.size(html.outermost(p, Selector("p"))), "b": lambda p: html.texts(html.flat(p, Selector("b"))),
    }
    for row in with_elements(spark.read.parquet(str(RAW_PAGES)), ["html"], **rules).collect():
        root = tree(row["html"])
        paragraphs = select(root, "p")
        assert row["p2"] == (paragraphs[1].text("\n") if len(paragraphs) > 1 else "")
        assert row["nav"] == select(root, "nav")[0].text("|")
        assert row["outer"] == len([p for p in paragraphs if not any(a.tag == "p" for a in p.ancestors())])
        assert row["b"] == [b.text() for b in select(root, "b")]


def test_null_and_empty_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "no markup"), (4, "<b>x")], "i int, html string")
    rules = {"b": lambda p: html.text(html.first(p, Selector("b"))), "all": lambda p: html.flat(p, Selector("b"))}
    assert [tuple(r) for r in with_elements(df, ["i"], **rules).orderBy("i").collect()] == [(1, "", []), (2, "", []), (3, "", []), (4, "x", ["<b>x"])]


def test_places_count_characters_not_bytes(spark):
    df = spark.createDataFrame([("đ\U0001f600<b class='é'>\U0001f600é</b><i>x</i>",)], "html string")
    rules = {"b": lambda p: html.first(p, Selector("b")), "tag": lambda p: html.open_tags(p, Selector("b")), "i": lambda p: html.first(p, Selector("i"))}
    assert tuple(with_elements(df, [], **rules).first()) == ("<b class='é'>\U0001f600é", ["<b class='é'>"], "<i>x")


def test_attributes():
    assert attributes(""" a=1 B = 'x y' c="<" d a=2 /e=f hidden""") == {"a": "1", "b": "x y", "c": "<", "d": "", "e": "f", "hidden": ""}


def test_one_pass_takes_time_in_proportion():
    def took(n):
        page = "<ul>" + "<li class='x'>item " * n + "</ul>" + "</b>" * n + "<p>x" * n
        scan, best = Scan([Selector("li", ("x",)), Selector("p"), Selector(**{"class": "x"})]), 9.0
        for _ in range(3):
            start = time.perf_counter()
            found = scan.spans(page)
            best = min(best, time.perf_counter() - start)
        assert [len(f) for f in found] == [n, n, n]
        return best

    assert took(20_000) < 2
    assert took(80_000) < 12 * took(20_000) + 0.1


def test_pages_cross_to_python_once_and_do_not_come_back(spark):
    rows = spark.createDataFrame([("itviec", "u", "j", "<h1>x</h1>", None), ("topdev", "u", "j", "<h1>x</h1>", None)], DETAIL_PAGE)
    plan = detail.extract_details(rows, SITES)._jdf.queryExecution().executedPlan().toString()
    (line,) = [x for x in plan.splitlines() if "ArrowEvalPython" in x]
    assert line.count("run(") == len(SITES) and "MapIn" not in plan and "BatchEvalPython" not in plan.replace("ArrowEvalPython", "")
    page = Page(F.col("html"), F.col("places"))
    html.first(page, Selector("h1"))
    places = rows.withColumn("places", found(page.wanted, F.col("html"))).schema["places"].dataType.simpleString()
    assert places == "array<array<struct<a:int,o:int,b:int,outer:boolean>>>"


def test_plain_elements_are_passed_over_as_one():
    page = "<div class='x'>" + "<p>line</p><br>\n<b></b>" * 5000 + "<P>a</p><p>b<i>c</i></p><h1>t</h1></div>"
    scan = Scan([Selector("h1"), Selector("div", ("x",))])
    assert len(list(scan.tags.finditer(page))) < 20
    assert len(scan.spans(page)[0]) == 1 and scan.spans(page)[1][0][2] == len(page) - 6


@pytest.mark.parametrize("wanted", [
    [Selector("h1"), Selector("div", ("x",))], [Selector("p|b"), Selector(**{"class": "x"})], [Selector("br"), Selector("p"), Selector("i", inside=Selector("p"))],
])
def test_passing_over_changes_nothing(wanted):
    rng = random.Random(7)
    parts = ["<p>", "</p>", "<P>", "</P>", "<b>", "</b>", "<h1>", "</h1 >", "<br>", "<br/>", "</br>", "<p/>", "<i>", "</i>", "a < b", "<1", "t", "\n",
             "<div class=x>", "<div>", "</div>", "<p class='x'>", "<b", ">", "<p>q</p>", "<i>r</i>", "<h1>s</h1>"]
    scan, plain = Scan(wanted), Scan(wanted)
    plain.tags = re.compile(f"(?!)()|{_TAG}")
    for _ in range(3000):
        page = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        assert scan.spans(page) == plain.spans(page), page
