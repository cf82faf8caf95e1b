"""The two job sites as rules over pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from joblark.functions import dates, html
from joblark.functions.html import Page, Selector
from joblark.functions.text import after_last, all_digits, before, contains_any, let, strip
from joblark.sources.spec import Field, ListField, SourceSpec

# Addresses, markup and marker texts of the sites.
ITVIEC_JOBS = "https://itviec.com/it-jobs"
TOPDEV_JOBS = "https://topdev.vn/detail-jobs"
ITVIEC_SLUG_ATTRIBUTE = "data-search--job-selection-job-slug-value"
TOPDEV_LINK_MARK = "/detail-jobs/"
SALARY_WORDS = ("salary", "lương")
CHALLENGE_MARKERS = (
    "cf-browser-verification",
    "checking your browser",
    "please wait while we verify",
    "enable javascript and cookies",
    "captcha",
    "access denied",
    "unusual traffic",
)
DISCONNECT_MARKERS = (
    "target page, context or browser has been closed",
    "browser has been disconnected",
    "connection closed",
    "websocket",
    "playwright.async_api.error: target closed",
)


def _non_empty(values: Column) -> Column:
    return F.filter(values, lambda v: v != "")


# ---- listing rules -----------------------------------------------------------------


def attribute_slugs(page: Column | Page, sel: Selector, name: str) -> Column:
    """An attribute of each matching element, in order, repeats kept."""
    return _non_empty(F.transform(html.open_tags(page, sel), lambda t: strip(html.attr(t, name))))


def link_slugs(page: Column | Page, mark: str) -> Column:
    """What follows the last ``mark`` in each link address, first mention only."""

    def slug(tag: Column) -> Column:
        return F.btrim(after_last(before(html.attr(tag, "href"), "?"), mark), F.lit("/"))

    links = html.open_tags(page, Selector("a", href=mark))
    return F.array_distinct(_non_empty(F.transform(links, slug)))


def highest_number(texts: Column) -> Column:
    """The largest all-digit text, 1 when there is none."""
    numbers = F.transform(F.filter(texts, all_digits), lambda t: t.try_cast("bigint"))
    return F.coalesce(F.array_max(numbers), F.lit(1).cast("bigint"))


def _itviec_page_count(page: Column | Page) -> Column:
    return highest_number(html.texts(html.within(page, Selector("nav"), Selector("div", ("page",)), Selector("a"))))


def _topdev_page_count(page: Column | Page) -> Column:
    return highest_number(html.texts(html.flat(page, Selector("a", href="page="))))


def numbered_id(slug: Column) -> Column:
    """The number that ends a slug, or the slug."""
    number = F.regexp_extract(slug, "-([0-9]+)$", 1)
    return F.when(number != "", number).otherwise(slug)


# ---- detail rules ------------------------------------------------------------------


def _element(sel: Selector, nth: int = 1):
    return lambda page: html.first(page, sel, nth)


_INFO = Selector("span", ("normal-text", "text-rich-grey"))

ITVIEC_FIELDS = {
    "title": Field(_element(Selector("h1"))),
    "company": Field(_element(Selector("div", ("employer-name",)))),
    "salary": Field(_element(Selector("a", ("sign-in-view-salary",)))),
    "locations": Field(_element(_INFO)),
    "working_method": Field(_element(_INFO, 2)),
    "posted_date": Field(_element(_INFO, 3), then=dates.relative_date),
    "skills": ListField(lambda page: html.flat(page, Selector("a", ("itag",)))),
    "description": Field(_element(Selector("section", ("job-content",))), sep="\n"),
}


def _topdev_title(page: Column | Page) -> Column:
    link = Selector("a", ("text-brand-500", "font-semibold"))
    return F.coalesce(html.first(page, Selector("h1")), html.first(page, link))


def _topdev_company(page: Column | Page) -> Column:
    def pick(links: Column) -> Column:
        spans = F.transform(links, lambda link: html.first(link, Selector("span")))
        found = F.filter(spans, lambda s: s.isNotNull())
        return F.coalesce(F.get(found, F.lit(0)), F.get(links, F.lit(0)))

    return let(html.flat(page, Selector("a", href="/companies/")), pick)


def _topdev_salary(page: Column | Page) -> Column:
    named = html.first(page, Selector(**{"class": "salary"}))
    worded = html.first_where(page, "span", lambda e: contains_any(html.raw_text(e), SALARY_WORDS))
    return F.coalesce(named, worded)


def _first_dated(page: Column | Page) -> Column:
    """The first date text of the page; the site may show the closing date there."""
    return html.first_where(page, "span|p", lambda e: F.rlike(html.raw_text(e), F.lit(dates.DMY)))


def _topdev_skills(page: Column | Page) -> Column:
    return F.concat(
        html.flat(page, Selector("a", href="keyword=")), html.flat(page, Selector("a", href="/skills/"))
    )


def _topdev_description(page: Column | Page) -> Column:
    box = html.first(page, Selector(**{"class": "job-description"}))
    return F.coalesce(box, html.first(page, Selector("article")))


TOPDEV_FIELDS = {
    "title": Field(_topdev_title),
    "company": Field(_topdev_company),
    "salary": Field(_topdev_salary),
    "locations": Field(_element(Selector(**{"class": "location"}))),
    "posted_date": Field(_first_dated, raw=True, then=lambda t, at: dates.dmy_date(t)),
    "skills": ListField(_topdev_skills, then=lambda t: F.array_sort(F.array_distinct(t))),
    "description": Field(_topdev_description, sep="\n"),
}


ITVIEC = SourceSpec(
    name="itviec",
    detail_url=ITVIEC_JOBS,
    job_id=lambda slug: F.concat(F.lit("itviec_"), slug),
    slugs=lambda page: attribute_slugs(page, Selector("div", ("job-card",)), ITVIEC_SLUG_ATTRIBUTE),
    page_count=_itviec_page_count,
    fields=ITVIEC_FIELDS,
    batch_size=5,
    heading_required=True,
    disconnect_markers=DISCONNECT_MARKERS[:1],
)

TOPDEV = SourceSpec(
    name="topdev",
    detail_url=TOPDEV_JOBS,
    job_id=lambda slug: F.concat(F.lit("topdev_"), numbered_id(slug)),
    slugs=lambda page: link_slugs(page, TOPDEV_LINK_MARK),
    page_count=_topdev_page_count,
    fields=TOPDEV_FIELDS,
    batch_size=1,
    check_urls=False,  # the site blocks probes
    challenge_markers=CHALLENGE_MARKERS,
    disconnect_markers=DISCONNECT_MARKERS,
)

SITES = (ITVIEC, TOPDEV)
