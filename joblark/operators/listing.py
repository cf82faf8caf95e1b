"""Listing pages: slugs, page counts, the frontier and the URL map."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblark.functions.elements import found_by_source, pages_by_source
from joblark.functions.html import cut
from joblark.functions.text import or_empty
from joblark.sources.spec import SourceSpec, of_sources, per_source


class ListingError(RuntimeError):
    """The first listing page of a source has no HTML."""


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def listing_facts(pages: DataFrame, specs: tuple[SourceSpec, ...]) -> DataFrame:
    """``(source, page_no, has_html, slugs, page_count)`` in one scan, the HTML read once per page."""
    rules = _rules(specs, pages.sparkSession.sparkContext.applicationId)
    cleaned = pages.where(of_sources(specs)).select(
        "source",
        F.col("page_no").cast("bigint").alias("page_no"),
        (or_empty(F.col("html")) != "").alias("has_html"),
        rules["cut"].alias("html"),
    ).withColumns(rules["found"])
    first_page = F.when(F.col("page_no") == 1, rules["page_count"])
    return cleaned.select("source", "page_no", "has_html", rules["slugs"].alias("slugs"), first_page.alias("page_count"))


@lru_cache(maxsize=32)
def _rules(specs: tuple[SourceSpec, ...], application: str) -> dict:
    """The listing Columns of some sources, built once per application."""
    html = F.col("html")
    pages = pages_by_source(specs)
    slugs = per_source(specs, lambda s: s.slugs(pages[s.name]))
    page_count = per_source(specs, lambda s: s.page_count(pages[s.name]))
    return {"cut": cut(html), "found": found_by_source(pages), "slugs": slugs, "page_count": page_count}


def require_first_pages(facts: DataFrame, specs: tuple[SourceSpec, ...]) -> None:
    """Raise when a source has no first page to start from."""
    seen = facts.where((F.col("page_no") == 1) & F.col("has_html")).select("source").distinct()
    names = {row["source"] for row in seen.collect()}  # one row per specification at most
    missing = sorted(s.name for s in specs if s.name not in names)
    if missing:
        raise ListingError(f"no HTML for the first listing page of: {', '.join(missing)}")


def frontier(facts: DataFrame, max_pages: int = 0) -> DataFrame:
    """Distinct ``(source, slug)`` of the pages a crawl in page order would use.

    The crawl ends before the first page from page 2 on that has no HTML, has no
    slugs or was not fetched, and at ``max_pages``, or at the count on page 1
    when that is not positive. A first page without slugs does not end it.
    """
    usable = facts.where(F.col("has_html") & ((F.size("slugs") > 0) | (F.col("page_no") == 1)))
    numbers = usable.select("source", "page_no").distinct()
    # A page is the last one when the number after it is not usable.
    followed = numbers.select("source", (F.col("page_no") - 1).alias("page_no"))
    last = (
        numbers.join(followed, ["source", "page_no"], "left_anti")
        .groupBy("source")
        .agg(F.min("page_no").alias("last_page"))
    )
    limit = F.lit(max_pages).cast("bigint") if max_pages > 0 else F.col("page_count")
    bounds = (
        usable.where(F.col("page_no") == 1)
        .groupBy("source")
        .agg(F.max("page_count").alias("page_count"))
        .join(last, "source")
        .select("source", F.least("last_page", F.greatest(limit, F.lit(1))).alias("_last"))
    )
    return (
        usable.join(F.broadcast(bounds), "source")  # one row per specification at most
        .where(F.col("page_no") <= F.col("_last"))
        .select("source", F.explode("slugs").alias("slug"))
        .distinct()
    )


def url_id_map(slugs: DataFrame, specs: tuple[SourceSpec, ...]) -> DataFrame:
    """Distinct ``(source, slug, url, job_id)``: one row a URL, but two may share an id."""
    slug = F.col("slug")
    return slugs.where(of_sources(specs)).select(
        "source",
        "slug",
        per_source(specs, lambda s: F.concat(F.lit(s.detail_url + "/"), slug)).alias("url"),
        per_source(specs, lambda s: s.job_id(slug)).alias("job_id"),
    ).distinct()
