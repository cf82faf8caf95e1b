"""What the engine has to know about one job site."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from joblark.functions.html import Page

# Values of the quality gate unless a site says otherwise.
CRITICAL_FIELDS = ("title", "company")
EMPTY_THRESHOLD = 0.5


@dataclass(frozen=True)
class Field:
    """A record column from one element of the page.

    ``element`` picks the element; its stripped texts are joined by ``sep``, or
    its text is taken as it stands when ``raw``; ``then`` turns that text and
    the fetch time into the value.
    """

    element: Callable[[Page], Column]
    sep: str = ""
    raw: bool = False
    then: Callable[[Column, Column], Column] | None = None


@dataclass(frozen=True)
class ListField:
    """A record column from the texts of many elements of the page."""

    elements: Callable[[Page], Column]
    then: Callable[[Column], Column] | None = None


@dataclass(frozen=True, eq=False)
class SourceSpec:
    """The extension point: a new site is a new set of rules, which make Columns of a page.

    ``fields`` maps record columns to rules of the detail page. ``slugs`` and ``page_count`` take a listing page.
    """

    name: str
    detail_url: str
    job_id: Callable[[Column], Column]
    slugs: Callable[[Page], Column]
    page_count: Callable[[Page], Column]
    fields: dict[str, Field | ListField] = field(default_factory=dict)
    batch_size: int = 5
    check_urls: bool = True
    heading_required: bool = False
    challenge_markers: tuple[str, ...] = ()
    disconnect_markers: tuple[str, ...] = ()
    critical_fields: tuple[str, ...] = CRITICAL_FIELDS
    threshold: float = EMPTY_THRESHOLD


def per_source(specs: tuple[SourceSpec, ...], value: Callable[[SourceSpec], Column], source: str = "source") -> Column:
    """Each row's value by the rules of its own source; null for other sources."""
    out = None
    for spec in specs:
        own = F.col(source) == spec.name
        out = F.when(own, value(spec)) if out is None else out.when(own, value(spec))
    return out


def of_sources(specs: tuple[SourceSpec, ...], source: str = "source") -> Column:
    return F.col(source).isin(*[s.name for s in specs])

