"""HTML rules as Column expressions.

A rule takes a ``Page``, whose elements one pass has found (see ``elements``), or a text: a part of
a page, or a ``clean`` page, in which tags nest. In a text, rules find an opening tag with a regular
expression and its end by counting tags of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblark.functions.text import let, or_empty, strip, unescape

TAG = r"<[/!?a-zA-Z][^>]*>"

# Elements that never have content or an end tag.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "param", "source", "track", "wbr",
)

_GAP = "<!---->"  # stands for markup that was cut, so that texts around it stay apart
_UNSEEN = (
    r"(?i)<(?:!--(?:[^-]++|-(?!->))*+-->"
    r"|(script|style)(?=[\s/>])[^>]*+>[^<]*+(?:<(?!/\1[\s/>])[^<]*+)*+</\1\s*>)"
)
_TEXTLESS = r"(?is)<(template|rt|rp)(?=[\s/>])[^>]*>.*?</\1\s*>"

# One attribute; possessive, so that a failed match does not try other splits.
_ATTR = r"""(?:[\s/]++[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+)"""
# Cheap and loose: a page that matches without need is only tokenised in vain.
_QUOTED_ANGLE = r"""=\s*+(?:"[^"<>]*+[<>]|'[^'<>]*+[<>])"""
_ALONE = rf"^(?:<[^>]*/>|<(?i:{'|'.join(VOID_TAGS)})[\s>])"
# A tag up to its end or to the next tag: slash, name, rest, end.
_TAG_PARTS = re.compile(r"<(/?)([a-zA-Z](?:[^\s/><]|<(?!/?[a-zA-Z]))*)((?:[^<>]|<(?!/?[a-zA-Z]))*)(>?)")
_TOKEN = r"""<[/!?a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^<]++|<"""


def cut(html: Column) -> Column:
    """Cut comments, scripts and styles, and escape angle brackets inside
    attribute values, so that later every ``<name`` opens a real tag."""

    def guard(token: Column) -> Column:
        body = F.substring(token, F.lit(2), F.length(token) - 2)
        body = F.replace(F.replace(body, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.when(
            F.startswith(token, F.lit("<")) & (F.length(token) > 1),
            F.concat(F.lit("<"), body, F.lit(">")),
        ).otherwise(token)

    def guarded(page: Column) -> Column:
        tokens = F.regexp_extract_all(page, F.lit(_TOKEN), F.lit(0))
        return F.when(
            F.rlike(page, F.lit(_QUOTED_ANGLE)), F.array_join(F.transform(tokens, guard), "")
        ).otherwise(page)

    return let(F.regexp_replace(or_empty(html), _UNSEEN, _GAP), guarded)


def clean(html: Column) -> Column:
    """A page ``cut`` and repaired, as a text for rules on texts.

    Tags that do not nest are repaired: what is left open closes where an outer
    element ends, stray end tags go. That takes a stack, which no built-in function
    keeps in time linear in the page, so the page goes through Python and comes back whole.
    ``elements`` finds parts of pages without that.
    """
    return _nested(cut(html))


def nested_page(page: str) -> str:
    """Put in the end tags that are missing before an outer end tag, and cut
    those that close nothing, so that tags nest. One pass: the open elements are
    a stack, with the number of each name beside it."""
    held: list[str] = []
    count: dict[str, int] = {}
    out: list[str] = []
    at = 0
    for tag in _TAG_PARTS.finditer(page):
        name = tag[2].lower()
        if not tag[1]:
            if name not in VOID_TAGS and not (tag[3].endswith("/") and tag[4]):
                held.append(name)
                count[name] = count.get(name, 0) + 1
            continue
        if not count.get(name):  # closes nothing
            out += (page[at : tag.start()], _GAP)
            at = tag.end()
            continue
        ends = []
        while held[-1] != name:
            ends.append(f"</{held[-1]}>")
            count[held.pop()] -= 1
        count[held.pop()] -= 1
        if ends:
            out += (page[at : tag.start()], *ends)
            at = tag.start()
    return "".join((*out, page[at:])) if at or out else page


@F.pandas_udf(T.StringType())
def _nested(pages: pd.Series) -> pd.Series:
    return pages.map(nested_page, na_action="ignore")


class Selector:
    """An element by tag name, class words and attribute substrings.

    ``tag=None`` stands for any element, ``"span|p"`` for several. ``attrs`` maps an attribute name to a
    text its value has to contain. ``inside`` is a selector one of whose elements has to be around
    it; only pages whose elements are indexed can tell.
    """

    def __init__(self, tag: str | None = None, classes: tuple[str, ...] = (), inside: Selector | None = None, **attrs: str):
        self.tag, self.classes, self.attrs, self.inside = tag, classes, attrs, inside
        name = f"(?i:{tag})" if tag else r"(?<tag>[a-zA-Z][^\s/>]*+)"
        self.same_name = f"(?i:{tag})" if tag else r"(?i:\k<tag>)"
        looks = ""
        for word in classes:
            looks += _has("class", rf"(?:[^{{q}}]*\s)?{re.escape(word)}(?:\s[^{{q}}]*)?", re.escape(word))
        for attr, part in attrs.items():
            looks += _has(attr, rf"[^{{q}}]*?{re.escape(part)}[^{{q}}]*", rf"[^\s>\"']*?{re.escape(part)}")
        self.open = rf"<{name}(?=[\s/>]){looks}[^>]*+>"
        # The longest literal every match contains: a cheap first test.
        self.needle = max([*classes, *attrs.values()], key=len, default="")

    def _key(self) -> tuple:
        return self.tag, self.classes, tuple(self.attrs.items()), self.inside

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Selector) and self._key() == other._key()

    def __hash__(self) -> int:
        return hash(self._key())

    @property
    def tests(self) -> bool:
        return bool(self.classes or self.attrs)

    def holds(self, attrs: dict[str, str]) -> bool:
        """Whether the attributes of an opening tag are those asked for."""
        words = attrs.get("class", "").split() if self.classes else ()
        return all(w in words for w in self.classes) and all(part in attrs.get(name.lower(), "") for name, part in self.attrs.items())

    def search(self, html: Column, body: Callable[[Column], Column], absent: Column) -> Column:
        """``body`` of the page from the tag that holds the needle on, ``absent``
        without one. Plain string search is far cheaper than the expression. The page is
        bound first: it may come from a Python function, which no lambda may hold."""

        def search_in(page: Column) -> Column:
            def from_tag(ahead: Column) -> Column:
                tag = F.concat(F.lit("<"), F.substring_index(ahead, "<", -1))
                rest = F.substring(page, F.length(ahead) + 1, F.lit(2**31 - 1))
                return F.when(F.contains(ahead, F.lit("<")), F.concat(tag, rest)).otherwise(page)

            near = let(F.substring_index(page, self.needle, 1), from_tag)
            return F.when(F.contains(page, F.lit(self.needle)), let(near, body)).otherwise(absent)

        return let(html, search_in if self.needle else body)


class Page:
    """A page as rules see it: its ``cut`` HTML and, per selector that rules ask for, the places
    ``(a, o, b, outer)`` of its elements. ``wanted`` fills as rules are written against it."""

    def __init__(self, html: Column, found: Column):
        self.html, self.found = html, found
        self.wanted: list[Selector] = []

    def hits(self, sel: Selector) -> Column:
        if sel.inside is not None:
            self.hits(sel.inside)
        if sel not in self.wanted:
            self.wanted.append(sel)
        return F.get(self.found, F.lit(self.wanted.index(sel)))

    def _from(self, start: Column, end: Column) -> Column:
        return F.substring(self.html, start + 1, end - start)

    def element(self, hit: Column) -> Column:
        """An element without its end tag."""
        return self._from(hit["a"], hit["b"])

    def opening(self, hit: Column) -> Column:
        return self._from(hit["a"], hit["o"])


def _has(attr: str, quoted: str, bare: str) -> str:
    """A look-ahead for an attribute value; ``{q}`` is the value's quote."""
    double, single = quoted.replace("{q}", '"'), quoted.replace("{q}", "'")
    value = rf"""(?:"{double}"|'{single}'|{bare}(?=[^"']*?[\s>]))"""
    return rf"(?={_ATTR}*?[\s/]++(?i:{re.escape(attr)})\s*+=\s*+{value})"


def attr(tag: Column, name: str) -> Column:
    """The decoded value of an attribute of an opening tag, ``""`` when absent."""
    value = F.regexp_extract(
        tag,
        rf"""(?is)^<[a-z][^\s/>]*+{_ATTR}*?[\s/]++{re.escape(name)}\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++)""",
        1,
    )
    return let(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"), unescape)


def _none() -> Column:
    return F.array().cast("array<string>")


def open_tags(html: Column | Page, sel: Selector) -> Column:
    """All matching opening tags in document order."""
    if isinstance(html, Page):
        return F.transform(html.hits(sel), html.opening)
    pattern = F.lit(f"(?s){sel.open}")
    return sel.search(html, lambda page: F.regexp_extract_all(page, pattern, F.lit(0)), _none())


def flat(html: Column | Page, sel: Selector) -> Column:
    """All matching elements of a kind that cannot nest, such as links."""
    if isinstance(html, Page):
        return F.transform(html.hits(sel), html.element)
    close = rf"</(?i:{sel.tag})\s*>"
    pattern = F.lit(rf"{sel.open}[^<]*+(?:<(?!/(?i:{sel.tag})[\s>])[^<]*+)*+(?:{close}|$)")
    return sel.search(html, lambda page: F.regexp_extract_all(page, pattern, F.lit(0)), _none())


def _pieces(html: Column, tag: Column) -> Column:
    """Cut before each opening or closing tag of a name."""
    mark = F.concat(F.lit(r"(?i)(?=</?(?:"), tag, F.lit(r")[\s/>])"))
    return F.split(html, mark)


def _closes(piece: Column) -> Column:
    return F.startswith(piece, F.lit("</"))


def _empty_element(piece: Column) -> Column:
    return F.rlike(piece, F.lit(r"^<[^>]*/>"))


def _head_element(rest: Column, tag: Column) -> Column:
    """The element whose opening tag starts ``rest``, without its end tag."""

    def cut(pieces: Column) -> Column:
        def step(acc: Column, piece: Column) -> Column:
            depth = acc["depth"] + F.when(_closes(piece), -1).when(_empty_element(piece), 0).otherwise(1)
            inside = F.when(depth > 0, 1).otherwise(0)
            return F.when(acc["depth"] == 0, acc).otherwise(
                F.struct(depth.alias("depth"), (acc["n"] + inside).alias("n"))
            )

        start = F.struct(F.lit(1).alias("depth"), F.lit(1).alias("n"))
        followers = F.slice(pieces, F.lit(2), F.size(pieces))
        end = F.aggregate(followers, start, step, lambda acc: acc["n"])
        return F.array_join(F.slice(pieces, F.lit(1), end), "")

    return let(_pieces(rest, tag), cut)


def first(html: Column | Page, sel: Selector, nth: int = 1) -> Column:
    """The ``nth`` matching element in document order, null when absent.

    In a text, one expression reads up to the next tag of the same name. When that opens
    another element, the end is found by counting.
    """
    if isinstance(html, Page):
        return html.element(F.get(html.hits(sel), F.lit(nth - 1)))
    skip = rf"(?:{sel.open}.*?){{{nth - 1}}}" if nth > 1 else ""
    inside = rf"[^<]*+(?:<(?!/?{sel.same_name}[\s/>])[^<]*+)*+"
    upto = rf"(?s){skip}({sel.open}{inside}(?:</?{sel.same_name}(?=[\s/>])|$))"

    def nested(page: Column) -> Column:
        rest = F.regexp_extract(page, f"(?s){skip}({sel.open}.*)", 1)
        if sel.tag:
            return _head_element(rest, F.lit(sel.tag))
        return let(rest, lambda r: _head_element(r, F.concat(F.lit(r"\Q"), _tag_name(r), F.lit(r"\E"))))

    def element(page: Column, found: Column) -> Column:
        return (
            F.when(found == "", F.lit(None).cast("string"))
            .when(F.rlike(found, F.lit(_ALONE)), F.regexp_extract(found, "^<[^>]*>", 0))
            .when(F.rlike(found, F.lit(r"<[a-zA-Z][^\s/><]*$")), nested(page))
            .otherwise(F.regexp_replace(found, r"</[^\s/><]*$", ""))
        )

    def found_in(page: Column) -> Column:
        return let(F.regexp_extract(page, upto, 1), lambda found: element(page, found))

    return sel.search(html, found_in, F.lit(None).cast("string"))


def _tag_name(element: Column) -> Column:
    return F.regexp_extract(element, r"^<([^\s/>]+)", 1)


def outermost(html: Column | Page, sel: Selector) -> Column:
    """All matching elements that lie in no other matching element.

    In a text, the pass notes between which pieces each lies; texts are put together after it.
    """

    if isinstance(html, Page):
        return F.transform(F.filter(html.hits(sel), lambda hit: hit["outer"]), html.element)

    def _state(i: Column, depth: Column, start: Column, out: Column) -> Column:
        return F.struct(i.alias("i"), depth.alias("depth"), start.alias("start"), out.alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        i, depth, out = acc["i"] + 1, acc["depth"], acc["out"]
        opens = F.rlike(piece, F.lit(f"(?s)^{sel.open}")) & ~_empty_element(piece)
        new_depth = depth + F.when(_closes(piece), -1).when(_empty_element(piece), 0).otherwise(1)
        span = F.struct(acc["start"].alias("a"), i.alias("b"))
        return (
            F.when((depth == 0) & opens, _state(i, F.lit(1), i, out))
            .when(depth == 0, _state(i, depth, acc["start"], out))
            .when(new_depth == 0, _state(i, F.lit(0), F.lit(0), F.array_append(out, span)))
            .otherwise(_state(i, new_depth, acc["start"], out))
        )

    def spans_of(pieces: Column) -> Column:
        none = F.array().cast("array<struct<a:int,b:int>>")
        return F.aggregate(
            pieces,
            _state(F.lit(0), F.lit(0), F.lit(0), none),
            step,
            lambda acc: F.when(
                acc["depth"] > 0, F.array_append(acc["out"], F.struct(acc["start"].alias("a"), (acc["i"] + 1).alias("b")))
            ).otherwise(acc["out"]),
        )

    def search(page: Column) -> Column:
        def cut(pieces: Column) -> Column:
            return F.transform(spans_of(pieces), lambda s: F.array_join(F.slice(pieces, s["a"], s["b"] - s["a"]), ""))

        return let(_pieces(page, F.lit(sel.tag)), cut)

    return sel.search(html, search, _none())


def within(html: Column | Page, *sels: Selector) -> Column:
    """All elements of the last selector that lie in one of the selector before it, and so on.

    In a text the last one must be of a kind that cannot nest.
    """
    if isinstance(html, Page):
        chain = None
        for sel in sels:
            chain = Selector(sel.tag, sel.classes, chain, **sel.attrs)
        return flat(html, chain)
    if len(sels) == 1:
        return flat(html, sels[0])
    return F.flatten(F.transform(outermost(html, sels[0]), lambda e: within(e, *sels[1:])))


def first_where(html: Column | Page, tags: str, test: Callable[[Column], Column]) -> Column:
    """The first element of some tag names (``"span|p"``) that passes ``test``.

    An element that holds a wanted text lies in outer elements that hold it too
    and start earlier; so only elements outside any other one need a test.
    """

    if isinstance(html, Page):
        return F.get(F.filter(outermost(html, Selector(tags)), test), F.lit(0))

    def search(pieces: Column) -> Column:
        def state(i: Column, depth: Column, start: Column, hit: Column) -> Column:
            return F.struct(i.alias("i"), depth.alias("depth"), start.alias("start"), hit.alias("hit"))

        def since(start: Column, end: Column) -> Column:
            return F.array_join(F.slice(pieces, start, end - start), "")

        def tested(start: Column, end: Column) -> Column:
            return let(since(start, end), lambda e: F.when(test(e), e))

        def step(acc: Column, piece: Column) -> Column:
            i, depth, start = acc["i"] + 1, acc["depth"], acc["start"]
            named = F.rlike(piece, F.lit(rf"(?i)^</?(?:{tags})[\s/>]"))
            new_depth = F.when(_closes(piece), F.greatest(depth - 1, F.lit(0))).when(
                _empty_element(piece) | ~named, depth
            ).otherwise(depth + 1)
            no_hit = F.lit(None).cast("string")
            return (
                F.when(acc["hit"].isNotNull(), acc)
                .when((depth == 0) & (new_depth == 1), state(i, new_depth, i, no_hit))
                .when((depth == 1) & (new_depth == 0), state(i, new_depth, start, tested(start, i)))
                .otherwise(state(i, new_depth, start, no_hit))
            )

        zero = state(F.lit(0), F.lit(0), F.lit(0), F.lit(None).cast("string"))

        def finish(acc: Column) -> Column:
            unclosed = F.when(acc["depth"] > 0, tested(acc["start"], acc["i"] + 1))
            return F.coalesce(acc["hit"], unclosed)

        return F.aggregate(pieces, zero, step, finish)

    return let(_pieces(html, F.lit(tags)), search)


def text(element: Column, sep: str | Column = "") -> Column:
    """The stripped texts of an element joined by ``sep``; ``""`` when it is null."""

    def joined(e: Column) -> Column:
        seen = F.when(
            F.rlike(e, F.lit(r"(?i)<(?:template|rt|rp)[\s/>]")), F.regexp_replace(e, _TEXTLESS, _GAP)
        ).otherwise(e)
        parts = F.transform(F.split(seen, TAG), lambda t: strip(unescape(t)))
        kept = F.filter(parts, lambda t: t != "")
        return F.call_function("array_join", kept, F.lit(sep) if isinstance(sep, str) else sep)

    return or_empty(let(element, joined))


def texts(elements: Column) -> Column:
    return F.transform(elements, lambda e: text(e))


def raw_text(element: Column) -> Column:
    """All text of an element as it stands, with the references decoded."""
    return let(F.regexp_replace(element, TAG, ""), unescape)
