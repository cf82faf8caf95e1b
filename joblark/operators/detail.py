"""Detail pages: which ones count as content, and the record of each."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.functions.elements import found_by_source, pages_by_source
from joblark.functions.html import Page, cut, raw_text, text, texts
from joblark.functions.text import contains_any, or_empty, utc_iso
from joblark.schemas import BRONZE, DETAIL_PAGE
from joblark.sources.spec import Field, ListField, SourceSpec, of_sources, per_source

NO_HTML = "no_html"
CHALLENGE = "challenge_page"
NO_HEADING = "no_heading"


def fetch_reject(spec: SourceSpec, html: Column) -> Column:
    """Why a page as fetched is no content, else null; the marker test reads
    scripts and comments too."""
    reason = F.when(or_empty(html) == "", F.lit(NO_HTML))
    if spec.challenge_markers:
        reason = reason.when(contains_any(html, spec.challenge_markers), F.lit(CHALLENGE))
    return reason


def has_heading(page: Column) -> Column:
    return F.rlike(page, F.lit(r"(?i)<h1[\s/>]"))


def extract_details(pages: DataFrame, specs: SourceSpec | tuple[SourceSpec, ...]) -> DataFrame:
    """One row per page of some sources: the record's columns and ``page_reject``.

    A map over one scan of the pages without a shuffle, each page by the rules
    of its source; columns beside the page's own, such as a batch number, pass
    through. Fields of a rejected page are null.
    """
    specs = specs if isinstance(specs, tuple) else (specs,)
    extra = [c for c in pages.columns if c not in DETAIL_PAGE.fieldNames()]
    kept = ["source", "url", "job_id", *extra, "page_reject"]
    rules = _rules(specs, pages.sparkSession.sparkContext.applicationId)
    fetched = pages.where(of_sources(specs)).withColumn("page_reject", rules["fetch_reject"])
    cleaned = fetched.withColumn("html", rules["cut"]).withColumn("page_reject", rules["page_reject"]).withColumns(rules["found"])
    # Named apart from the record's text column, which Spark would else take for it.
    seen = F.col("crawled_at").alias("_seen_at")
    cut = cleaned.select(*kept, seen, rules["pieces"], *rules["lists"])
    read = cut.withColumn("_texts", rules["texts"])
    return read.select(*rules["record"], *extra, "page_reject")


@lru_cache(maxsize=32)
def _rules(specs: tuple[SourceSpec, ...], application: str) -> dict:
    """The Columns of some sources, built once per application: a stream would
    otherwise spend seconds of every micro-batch on building them.

    Four steps: where the wanted elements are, pieces of the page, their texts by one shared rule, values.
    """
    html, reject = F.col("html"), F.col("page_reject")
    pages = pages_by_source(specs)
    single = {s.name: [n for n, f in s.fields.items() if isinstance(f, Field)] for s in specs}
    lists = list(dict.fromkeys(n for s in specs for n, f in s.fields.items() if isinstance(f, ListField)))
    no_heading = F.when(~has_heading(html), F.lit(NO_HEADING))

    def elements(spec: SourceSpec, name: str) -> Column:
        rule = spec.fields.get(name)
        return texts(rule.elements(pages[spec.name])) if isinstance(rule, ListField) else F.lit(None).cast("array<string>")

    def value(spec: SourceSpec, name: str) -> Column:
        rule = spec.fields.get(name)
        if rule is None:
            return F.lit(None).cast(BRONZE[name].dataType)
        if isinstance(rule, ListField):
            return rule.then(F.col(name)) if rule.then else F.col(name)
        found = F.get("_texts", F.lit(single[spec.name].index(name)))
        return rule.then(found, F.col("_seen_at")) if rule.then else found

    def column(name: str) -> Column:
        if name == "crawled_at":
            return utc_iso(F.col("_seen_at"))
        if name in ("source", "url", "job_id"):
            return F.col(name)
        return per_source(specs, lambda spec: value(spec, name))

    pieces = per_source(specs, lambda s: F.array(*[_piece(s.fields[n], pages[s.name]) for n in single[s.name]]))
    found_lists = [F.when(reject.isNull(), per_source(specs, lambda s, n=n: elements(s, n))).alias(n) for n in lists]
    return {
        "fetch_reject": per_source(specs, lambda s: fetch_reject(s, html)),
        "cut": F.when(reject.isNull(), cut(F.when(reject.isNull(), html))),
        "found": found_by_source(pages),
        "page_reject": per_source(specs, lambda s: F.coalesce(reject, no_heading) if s.heading_required else reject),
        "pieces": F.when(reject.isNull(), pieces).alias("_pieces"),
        "lists": found_lists,
        "texts": F.transform("_pieces", _piece_text),
        "record": [column(n).alias(n) for n in BRONZE.fieldNames()],
    }


def _piece(rule: Field, page: Page) -> Column:
    return F.struct(
        rule.element(page).alias("html"), F.lit(rule.sep).alias("sep"), F.lit(rule.raw).alias("raw")
    )


def _piece_text(piece: Column) -> Column:
    as_is = or_empty(raw_text(piece["html"]))
    return F.when(piece["raw"], as_is).otherwise(text(piece["html"], piece["sep"]))
