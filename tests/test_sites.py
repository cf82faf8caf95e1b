"""Hand-written listing and detail pages of both sites."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from joblark.functions.html import clean
from joblark.operators import detail, listing
from joblark.schemas import DETAIL_PAGE, LISTING_PAGE
from joblark.sources.sites import CHALLENGE_MARKERS, ITVIEC, SITES, TOPDEV, numbered_id

AT = datetime(2024, 3, 15, 12, 0, tzinfo=timezone.utc)


def card(slug):
    return f'<div class="ipy-2 job-card" data-search--job-selection-job-slug-value="{slug}"><h3>x</h3></div>'


def one_value(spark, page, rule):
    return spark.createDataFrame([(page,)], "html string").select(rule(clean(F.col("html"))).alias("x")).first()["x"]


def test_attribute_slugs_keep_order_and_repeats(spark):
    page = card("b") + card(" a ") + card("") + card(" \xa0") + "<div class=job-card>none</div>" + card("b") + card("x&amp;y")
    page += '<section class="job-card" data-search--job-selection-job-slug-value="no"></section>'
    assert one_value(spark, page, ITVIEC.slugs) == ["b", "a", "b", "x&y"]


def test_link_slugs(spark):
    page = "".join(
        f'<a class="c" href="{h}">t</a>'
        for h in [
            "/detail-jobs/dev-1?src=a", "https://topdev.vn/detail-jobs/dev-2/", "/detail-jobs/dev-1", "/detail-jobs/",
            "/x/detail-jobs/y/detail-jobs/dev-3//", "/jobs/other", "/go?to=/detail-jobs/q",
        ]
    )
    assert one_value(spark, page, TOPDEV.slugs) == ["dev-1", "dev-2", "dev-3", "go"]


@pytest.mark.parametrize(
    "page, count",
    [
        ("<nav><div class='page'><a>1</a><a> 12 </a><a>next</a></div></nav><nav><div><a>99</a></div></nav>", 12),
        ("<nav><ul><li><div class='x page'><div><a>3</a></div><a>2</a></div></li></ul></nav>", 3),
        ("<div class='page'><a>7</a></div>", 1),
        ("<nav><div class='page'><a>last</a></div></nav>", 1),
        ("", 1),
    ],
)
def test_page_count_of_site_1(spark, page, count):
    assert one_value(spark, page, ITVIEC.page_count) == count


@pytest.mark.parametrize(
    "page, count",
    [
        ("<a href='?page=2'>2</a><a href='/s?a=1&amp;page=10'><b>10</b></a><a href='?p=99'>99</a>", 10),
        ("<a href='?page=2'>next</a>", 1),
        ("<p>none</p>", 1),
    ],
)
def test_page_count_of_site_2(spark, page, count):
    assert one_value(spark, page, TOPDEV.page_count) == count


def test_numbered_ids(spark):
    df = spark.createDataFrame([(s,) for s in ["dev-12", "dev-12-a", "dev-a-007", "7", "dev12", "x-3-4"]], "s string")
    assert [r["x"] for r in df.select(numbered_id(F.col("s")).alias("x")).collect()] == ["12", "dev-12-a", "007", "7", "dev12", "4"]


def slugs_of(spark, rows, max_pages=0, specs=(ITVIEC,)):
    pages = spark.createDataFrame([(s, n, f"u{n}", h) for s, n, h in rows], LISTING_PAGE)
    facts = listing.listing_facts(pages, specs)
    return sorted((r["source"], r["slug"]) for r in listing.frontier(facts, max_pages).collect())


def box(n):
    return f"<nav><div class='page'><a>{n}</a></div></nav>"


def test_frontier_stops_before_the_first_empty_page(spark):
    pages = [("itviec", 1, card("a") + box(9)), ("itviec", 2, card("b")), ("itviec", 3, "<p>no cards</p>"), ("itviec", 4, card("d"))]
    assert slugs_of(spark, pages) == [("itviec", "a"), ("itviec", "b")]
    pages[2] = ("itviec", 3, "")
    assert slugs_of(spark, pages) == [("itviec", "a"), ("itviec", "b")]
    pages[2] = ("itviec", 3, None)
    assert slugs_of(spark, pages) == [("itviec", "a"), ("itviec", "b")]
    assert slugs_of(spark, pages[:2] + pages[3:]) == [("itviec", "a"), ("itviec", "b")]  # page 3 was never fetched


def test_frontier_bounds(spark):
    pages = [("itviec", n, card(f"s{n}") + card("all") + box(2)) for n in range(1, 5)]
    assert slugs_of(spark, pages) == [("itviec", "all"), ("itviec", "s1"), ("itviec", "s2")]
    assert [s for _, s in slugs_of(spark, pages, max_pages=3)] == ["all", "s1", "s2", "s3"]
    assert [s for _, s in slugs_of(spark, pages, max_pages=99)] == ["all", "s1", "s2", "s3", "s4"]
    assert [s for _, s in slugs_of(spark, pages, max_pages=1)] == ["all", "s1"]
    assert [s for _, s in slugs_of(spark, pages, max_pages=-1)] == ["all", "s1", "s2"]


def test_a_first_page_without_slugs_does_not_stop(spark):
    assert slugs_of(spark, [("itviec", 1, box(3)), ("itviec", 2, card("b"))]) == [("itviec", "b")]


def test_sources_stop_on_their_own(spark):
    link = "<a href='/detail-jobs/j-{0}'>x</a><a href='?page=3'>3</a>"
    rows = [("itviec", 1, card("a") + box(3)), ("itviec", 2, ""), ("itviec", 3, card("c"))]
    rows += [("topdev", n, link.format(n)) for n in (1, 2, 3)]
    assert slugs_of(spark, rows, specs=SITES) == [("itviec", "a"), ("topdev", "j-1"), ("topdev", "j-2"), ("topdev", "j-3")]


def test_a_missing_first_page_is_an_error(spark):
    pages = spark.createDataFrame([("itviec", 1, "u", ""), ("itviec", 2, "u", card("b"))], LISTING_PAGE)
    facts = listing.listing_facts(pages, SITES)
    with pytest.raises(listing.ListingError, match="itviec, topdev"):
        listing.require_first_pages(facts, SITES)
    assert listing.frontier(facts).count() == 0


def test_url_map(spark):
    slugs = spark.createDataFrame(
        [("itviec", "a-1"), ("topdev", "dev-7"), ("topdev", "other-7"), ("topdev", "plain"), ("topdev", "plain")], "source string, slug string"
    )
    got = sorted((r["url"], r["job_id"]) for r in listing.url_id_map(slugs, SITES).collect())
    assert got == [
        ("https://itviec.com/it-jobs/a-1", "itviec_a-1"),
        ("https://topdev.vn/detail-jobs/dev-7", "topdev_7"),
        ("https://topdev.vn/detail-jobs/other-7", "topdev_7"),
        ("https://topdev.vn/detail-jobs/plain", "topdev_plain"),
    ]


def record(spark, spec, page):
    rows = [(spec.name, "u", f"{spec.name}_x", page, AT)]
    return detail.extract_details(spark.createDataFrame(rows, DETAIL_PAGE), spec).first().asDict()


INFO = '<span class="normal-text text-rich-grey">{}</span>'


def test_site_1_record(spark):
    got = record(
        spark, ITVIEC,
        "<h1 class='job-name'>Senior <b>Data</b> &amp; ML</h1><h1>second</h1><div class='employer-name'>ACME<div> VN</div></div>"
        "<a class='sign-in-view-salary' href='#'>Sign in</a>" + INFO.format("HCM") + INFO.format("Hybrid <i>x</i>") + INFO.format(" 3 days ago ")
        + "<a class='itag'>Java</a><a class='itag'>Java</a><a class='itag'> </a>"
        "<section class='job-content'><h2>Do</h2><ul><li>one<li>two</ul></section>",
    )
    assert got == {
        "job_id": "itviec_x", "title": "SeniorData& ML", "company": "ACMEVN", "salary": "Sign in", "locations": "HCM",
        "working_method": "Hybridx", "posted_date": "2024-03-12", "skills": ["Java", "Java", ""], "description": "Do\none\ntwo",
        "source": "itviec", "url": "u", "crawled_at": "2024-03-15T12:00:00+00:00", "page_reject": None,
    }


@pytest.mark.parametrize("infos, want", [
    ([], ("", "", "")), (["HCM"], ("HCM", "", "")), (["HCM", "Office"], ("HCM", "Office", "")),
    (["HCM", "Office", "hôm nay"], ("HCM", "Office", "hôm nay")),
])
def test_site_1_info_spans(spark, infos, want):
    got = record(spark, ITVIEC, "<h1>t</h1>" + "".join(INFO.format(i) for i in infos))
    assert (got["locations"], got["working_method"], got["posted_date"]) == want
    assert (got["company"], got["salary"], got["skills"], got["description"]) == ("", "", [], "")


def test_site_1_needs_a_heading(spark):
    got = record(spark, ITVIEC, "<!-- <h1>x</h1> --><h2>no</h2>")
    assert got["page_reject"] == detail.NO_HEADING and got["title"] is None
    assert record(spark, ITVIEC, "<H1></H1>")["page_reject"] is None


def test_site_2_record(spark):
    got = record(
        spark, TOPDEV,
        "<h1>Dev</h1><a href='/companies/1'><img></a><a href='/companies/2'>x <span>Firm <span>A</span></span></a>"
        "<div class='job-salary-box'>5 <b>USD</b></div><i class='my-location'>Hue</i><div>1/1/2020</div>"
        "<p>Apply <b>before 5/</b>3/2024 <span>or 6/3/2024</span></p><a href='?keyword=b'>SQL</a><a href='/skills/a'>Go</a>"
        "<a href='/skills/sql'>SQL</a><article>no</article><div class='x-job-description'><p>a</p><div>b</div></div>",
    )
    assert got == {
        "job_id": "topdev_x", "title": "Dev", "company": "FirmA", "salary": "5USD", "locations": "Hue", "working_method": None,
        "posted_date": "2024-03-05", "skills": ["Go", "SQL"], "description": "a\nb", "source": "topdev", "url": "u",
        "crawled_at": "2024-03-15T12:00:00+00:00", "page_reject": None,
    }


def test_site_2_fallbacks(spark):
    got = record(
        spark, TOPDEV,
        "<a class='font-semibold text-brand-500 x'>Title</a><a href='https://t/companies/2'> Firm </a><span>a</span>"
        "<span>Mức <i>LƯƠNG</i>: 5</span><span>salary</span><article><p>x</p>y</article>",
    )
    assert (got["title"], got["company"], got["salary"], got["description"]) == ("Title", "Firm", "MứcLƯƠNG: 5", "x\ny")
    assert (got["locations"], got["posted_date"], got["skills"]) == ("", "", [])


def test_an_empty_heading_is_no_fallback(spark):
    assert record(spark, TOPDEV, "<h1> </h1><a class='text-brand-500 font-semibold'>x</a>")["title"] == ""


def test_a_void_element_has_no_text(spark):
    assert record(spark, TOPDEV, "<h1>t</h1><img class='salary'><b class='salary'>5</b>")["salary"] == ""


@pytest.mark.parametrize("marker", CHALLENGE_MARKERS)
def test_challenge_pages(spark, marker):
    page = f"<html><script>/* {marker.upper()} */</script><h1>t</h1></html>"
    assert record(spark, TOPDEV, page)["page_reject"] == detail.CHALLENGE
    assert record(spark, ITVIEC, page)["page_reject"] is None


@pytest.mark.parametrize("page", ["", None])
def test_pages_without_html(spark, page):
    assert record(spark, TOPDEV, page)["page_reject"] == detail.NO_HTML
    assert record(spark, ITVIEC, page)["page_reject"] == detail.NO_HTML


def test_a_site_is_a_set_of_rules(spark):
    """A new source needs no engine code."""
    from joblark.functions import html
    from joblark.sources.spec import Field, SourceSpec

    spec = SourceSpec(
        "mine", "https://mine.example", job_id=lambda s: F.concat(F.lit("mine_"), s), slugs=TOPDEV.slugs, page_count=TOPDEV.page_count,
        fields={"title": Field(lambda p: html.first(p, html.Selector("h2")))},
    )
    got = record(spark, spec, "<h2>Mine</h2>")
    assert (got["job_id"], got["title"], got["company"]) == ("mine_x", "Mine", None)


def test_a_rendered_text_has_a_paragraph_a_line(spark):
    from joblark.plans import site_pages

    texts = [None, "", "\n", " a <b> & c \n\nd\n", "&lt;\r\n x"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", site_pages._paragraphs(F.col("text")).alias("html"), site_pages.title_of(F.col("text")).alias("title")
    )
    found = {r.text: (r.html, r.title) for r in rows.collect()}
    mark = lambda t: t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    assert found == {
        t: (t if t is None else "<br>".join(f"<p>{mark(x)}</p>" for x in t.split("\n")), t if t is None else t.split("\n")[0].strip()) for t in texts
    }
    assert "transform" not in str(site_pages._paragraphs(F.col("text")))  # built-in functions on the whole text only
