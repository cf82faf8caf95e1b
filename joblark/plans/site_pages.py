"""Job-site pages written from the rows of a table.

The registered queries need pages in the markup of the two sites; these
functions make them with Spark from whole tables, so that the work of a query
grows with its table and the expected record follows from the row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.functions.text import before, strip
from joblark.sources.sites import ITVIEC, ITVIEC_SLUG_ATTRIBUTE, TOPDEV

BASE_SECONDS = 1704067200  # 2024-01-01 00:00:00 UTC
CARDS_PER_PAGE = 20

_HEAD = (
    '<!DOCTYPE html><html><head><style>p{margin:0}</style><script>var t="<h1>no</h1>";</script></head>'
    "<body><!-- <h1>no</h1> -->"
)
_TIP = '<div data-tip="<h1>no</h1>" class="ad">ad</div>'
_TAIL = "<footer>&copy; jobs &#169;</footer></body></html>"


def escape(c: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(ref))
    return c


def _join(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def title_of(text: Column) -> Column:
    return strip(before(text, "\n"))


def _paragraphs(text: Column) -> Column:
    """A paragraph a line."""
    return _join("<p>", F.replace(escape(text), F.lit("\n"), F.lit("</p><br><p>")), "</p>")


def seen_at(number: Column) -> Column:
    return F.timestamp_seconds(F.lit(BASE_SECONDS) + number * 60)


def itviec_pages(documents: DataFrame) -> DataFrame:
    """One site-1 detail page per document; every 11th lacks a heading and every
    7th a company."""
    key, text = F.col("doc_id"), F.col("text")
    unit = F.element_at(F.array(*[F.lit(u) for u in ("ngày trước", "weeks ago", "tháng trước", "giờ trước")]),
                        (key % 4 + 1).cast("int"))
    heading = F.when(key % 11 != 0, _join('<h1 class="ipt-xl-6">', escape(title_of(text)), "</h1>")).otherwise("")
    company = F.when(key % 7 != 0, F.upper("source")).otherwise(" &nbsp; ")
    html = _join(
        _HEAD, F.when(key % 5 == 0, F.lit(_TIP)).otherwise(""), heading,
        "<div class='box employer-name'><div><b>", company, "</b></div></div><div>other</div>",
        '<a href="/sign_in?a=1&amp;b=2" class="sign-in-view-salary ilink"> ', F.col("n_chars"), " USD </a>",
        '<span class="normal-text text-rich-grey">', F.col("lang"), "</span>",
        '<span class="ms-1 text-rich-grey normal-text"><i>Hybrid</i></span>',
        '<span class="normal-text text-rich-grey">\n', key % 40, "&nbsp;", unit, "</span>",
        '<a class="itag itag-light" href="/it-jobs/x">', F.col("source"), "</a>",
        '<a class="itag" href="/it-jobs/y"> ', F.col("lang"), "</a><a class='itags'>no</a>",
        '<section class="paragraph job-content"><section><h2>Role</h2></section>', _paragraphs(text),
        "</section><section>no</section>", _TAIL,
    )
    slug = _join("role-", key)
    return documents.select(
        F.lit(ITVIEC.name).alias("source"),
        _join(ITVIEC.detail_url + "/", slug).alias("url"),
        ITVIEC.job_id(slug).alias("job_id"),
        html.alias("html"),
        seen_at(key).alias("crawled_at"),
    )


def topdev_pages(conversations: DataFrame) -> DataFrame:
    """One site-2 detail page per turn; every 13th conversation shows a challenge."""
    key, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    title = escape(title_of(text))
    heading = F.when(turn % 3 == 0, _join("<h1>", title, "</h1>")).otherwise(
        _join('<a class="text-brand-500 font-semibold" href="/x">', title, "</a>")
    )
    company = F.when(
        key % 2 == 0, _join('<a href="/companies/', key, '"><img src="x.png">Firm <span>Co ', key, "</span></a>")
    ).otherwise(_join('<a href="https://topdev.vn/companies/', key, '">Firm ', key, "</a>"))
    salary = F.when(turn % 2 == 0, _join('<div class="job-salary"><b>', key, "</b> USD</div>")).otherwise(
        _join("<span>Mức <b>Lương:</b> ", key, " VND</span>")
    )
    box = F.when(key % 3 == 0, _join('<div class="x job-description-body"><div>', _paragraphs(text), "</div></div>"))
    html = _join(
        _HEAD,
        F.when(key % 13 == 0, "<p>Please wait while we verify you</p>").otherwise(""),
        heading, company, "<span>news</span>", salary,
        '<div class="job-location">City ', F.col("role"), "</div>",
        "<p>Closing <b>", key % 28 + 1, "/</b>", key % 12 + 1, "-2024 soon</p>",
        '<a href="/jobs/search?keyword=go&amp;p=1">go</a><a href="/skills/r">', F.col("role"), "</a>",
        '<a href="/skills/go">go</a>',
        F.coalesce(box, F.lit("")), "<article><h2>About</h2>", _paragraphs(text), "</article>", _TAIL,
    )
    slug = _join("job-", key, "-", key * 1000 + turn)
    return conversations.select(
        F.lit(TOPDEV.name).alias("source"),
        _join(TOPDEV.detail_url + "/", slug).alias("url"),
        TOPDEV.job_id(slug).alias("job_id"),
        html.alias("html"),
        seen_at(key).alias("crawled_at"),
    )


def listing_pages(rows: DataFrame, key: str = "p_partkey", slug: str = "part-") -> DataFrame:
    """Listing pages of both sites, twenty rows on each; the page after three
    quarters of them is empty on site 1, and site 2 names two thirds of them on its first page."""
    key = F.col(key)
    last = rows.agg(F.max(F.floor(key / CARDS_PER_PAGE) + 1)).first()[0] or 0
    empty, named = last * 3 // 4 + 1, max(1, last * 2 // 3)
    cards = rows.select(
        (F.floor(key / CARDS_PER_PAGE) + 1).cast("int").alias("page_no"),
        key.alias("key"),
        _join('<div class="card job-card" data-x="1" ', ITVIEC_SLUG_ATTRIBUTE, f'=" {slug}', key, ' "><h3>', key,
              "</h3></div>").alias("card"),
        _join('<a href="https://topdev.vn/detail-jobs/', f"{slug}x-", key, '/?src=list&amp;q=a/b"><b>', key,
              '</b></a><a href="/detail-jobs/', f"{slug}x-", key, '">again</a>').alias("link"),
    )
    pages = cards.groupBy("page_no").agg(  # at most CARDS_PER_PAGE rows each
        F.array_sort(F.collect_list(F.struct("key", "card", "link"))).alias("rows")
    )
    number = F.col("page_no")
    box = _join("<nav><ul><li>77777</li></ul><div class='page'><div><a>", number, "</a><a>", number + 4,
                "</a></div><a>next</a></div><a>88888</a></nav>")
    itviec = _join(_HEAD, F.when(number != empty, F.array_join(F.col("rows.card"), "\n")).otherwise(""),
                   F.when(number == 1, "<nav><div class='page'><a>1</a><a>1000000</a></div></nav>").otherwise(box),
                   _TAIL)
    count = F.when(number == 1, F.lit(named)).otherwise(number + 2)
    topdev = _join(_HEAD, F.array_join(F.col("rows.link"), "\n"), '<a href="?page=', count, '">', count,
                   '</a><a href="?page=2">next</a>', _TAIL)
    both = F.array(
        F.struct(F.lit(ITVIEC.name).alias("source"), itviec.alias("html")),
        F.struct(F.lit(TOPDEV.name).alias("source"), topdev.alias("html")),
    )
    return pages.select("page_no", F.explode(both).alias("p")).select(
        "p.source", "page_no", _join("https://list.example/", number).alias("url"), "p.html"
    )
