"""The elements of a page, found in one pass over its tags.

Rules written against a ``Page`` only name the selectors they need. ``index`` then sends a page's
HTML to Python once, where one scan with a stack of open elements notes for each selector where
its elements start and end: four numbers an element come back, the HTML does not. Texts are
cut by these places, and taken apart, in the JVM.

Tags need not nest: what is left open ends where an outer element does, an end tag that closes
nothing is passed over. Both take time in proportion to the page.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.functions.html import VOID_TAGS, Page, Selector, cut

FOUND = "array<array<struct<a:int,o:int,b:int,outer:boolean>>>"

# A tag up to its end or to the next tag: slash, name, rest, end.
_TAG = r"<(/?)([a-zA-Z](?:[^\s/><]++|<(?!/?[a-zA-Z]))*+)((?:[^<>]++|<(?!/?[a-zA-Z]))*+)(>?)"
# An element without attributes that holds nothing but text, and the text after it.
_PLAIN = r"<{}([a-zA-Z][a-zA-Z0-9]*+)>[^<]*+</\1>[^<]*+"
_ATTRIBUTE = re.compile(r"""[\s/]++([^\s=>"'/]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++))?+""")


def attributes(rest: str) -> dict[str, str]:
    """What follows a tag's name, as attributes; the first of a name counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        value = m[2] or ""
        out.setdefault(m[1].lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return out


class Scan:
    """The selectors of a page's rules, ready to be looked for."""

    def __init__(self, wanted: list[Selector]):
        self.wanted = wanted
        self.inside = [wanted.index(s.inside) if s.inside else None for s in wanted]
        names = {n for s in wanted if s.tag for n in s.tag.lower().split("|")}
        self.by_name = {n: [i for i, s in enumerate(wanted) if not s.tag or n in s.tag.lower().split("|")] for n in names}
        self.of_any = [i for i, s in enumerate(wanted) if not s.tag]
        self.tags = re.compile(f"{self._runs()}|{_TAG}")

    def _runs(self) -> str:
        """Elements that are passed over whole, as many as follow each other: they hold no other element, and no selector
        wants one of their name that has no attributes. The first group is theirs."""
        bare = [s for s in self.wanted if s.holds({})]
        if not all(s.tag for s in bare):
            return "(?!)()"
        names = {n for s in bare for n in s.tag.lower().split("|")}
        others = rf"(?!(?i:{'|'.join(sorted(names))})>)" if names else ""
        void = "|".join(n for n in VOID_TAGS if n not in names)
        return rf"(?:{_PLAIN.format(others)}|<(?:{void})>[^<]*+)++"

    def spans(self, page: str) -> list[list[list]]:
        """Per selector, in document order: where the opening tag starts and ends, where the
        content ends, and whether no element of the selector is around it."""
        wanted, inside = self.wanted, self.inside
        absent = {i for i, s in enumerate(wanted) if s.needle not in page}
        by_name = {n: kept for n, own in self.by_name.items() if (kept := [i for i in own if i not in absent])}
        of_any = [i for i in self.of_any if i not in absent]
        out: list[list[list]] = [[] for _ in wanted]
        if not by_name and not of_any:
            return out
        open_hits = [0] * len(wanted)
        stack: list[tuple[str, list[tuple[int, list]] | None]] = []
        depth: dict[str, int] = {}
        for tag in self.tags.finditer(page):
            if tag[3] is None:
                continue
            name = tag[3].lower()
            if tag[2]:
                if depth.get(name):
                    at = tag.start()
                    ended = None
                    while ended != name:
                        ended, hits = stack.pop()
                        depth[ended] -= 1
                        for i, span in hits or ():
                            span[2] = at
                            open_hits[i] -= 1
                continue
            hits = None
            if candidates := by_name.get(name, of_any):
                attrs = None
                for i in candidates:
                    if inside[i] is not None and not open_hits[inside[i]]:
                        continue
                    if wanted[i].tests:
                        if attrs is None:
                            attrs = attributes(tag[4])
                        if not wanted[i].holds(attrs):
                            continue
                    hits = hits or []
                    hits.append((i, [tag.start(), tag.end(), tag.end(), not open_hits[i]]))
                for i, span in hits or ():
                    out[i].append(span)
            if name in VOID_TAGS or (tag[5] and tag[4].endswith("/")):
                continue
            stack.append((name, hits))
            depth[name] = depth.get(name, 0) + 1
            for i, _ in hits or ():
                open_hits[i] += 1
        for _, hits in stack:
            for _, span in hits or ():
                span[2] = len(page)
        return out


def _array(found: list[list[list[list]] | None], n: int) -> pa.Array:
    """Spans of pages as one Arrow array; no spans of a page are null."""
    flat = [span for page in found if page for own in page for span in own]
    sizes, at = [0], 0
    for page in found:
        for own in page or ():
            at += len(own)
            sizes.append(at)
    fields = [pa.array([s[k] for s in flat], pa.bool_() if k == 3 else pa.int32()) for k in range(4)]
    spans = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(fields, ["a", "o", "b", "outer"]))
    ends, total = [0], 0
    for page in found:
        total += n if page is not None else 0
        ends.append(total)
    mask = pa.array([page is None for page in found])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans, mask=mask)


def found(wanted: list[Selector], html: Column) -> Column:
    """The places of each selector's elements, null for null pages."""
    scan = Scan(wanted)

    def run(pages: pa.Array) -> pa.Array:
        return _array([scan.spans(p.as_py()) if p.is_valid else None for p in pages], len(wanted))

    return F.arrow_udf(run, FOUND)(html)


def with_elements(df: DataFrame, keep: list[str], html: str = "html", **rules: Callable[[Page], Column]) -> DataFrame:
    """``keep`` and one column a rule, from raw pages."""
    page = Page(F.col("_page"), F.col("_found"))
    columns = [rule(page).alias(name) for name, rule in rules.items()]
    pages = df.withColumn("_page", cut(F.col(html)))
    if page.wanted:
        pages = pages.withColumn("_found", found(page.wanted, F.col("_page")))
    return pages.select(*keep, *columns)


def pages_by_source(specs: tuple) -> dict[str, Page]:
    """A page for the rules of each source, whose HTML is in ``html``."""
    return {s.name: Page(F.col("html"), F.col(f"_found{i}")) for i, s in enumerate(specs)}


def found_by_source(pages: dict[str, Page], source: str = "source") -> dict[str, Column]:
    """The columns these pages take their places from, once all rules are written: a page is searched
    for what its own source wants."""
    own = {name: F.when(F.col(source) == name, F.col("html")) for name in pages}
    return {f"_found{i}": found(page.wanted, own[name]) for i, (name, page) in enumerate(pages.items())}
