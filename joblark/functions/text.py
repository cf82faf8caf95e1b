"""Text functions as Column expressions."""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() call space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same as a regular expression, in ranges, which match much faster.
_SPACES = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CLASS = f"[{_SPACES}]"
NON_SPACE_CLASS = f"[^{_SPACES}]"


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone removes blanks only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return strip(or_empty(c)) == ""


def contains_any(c: Column, needles: tuple[str, ...]) -> Column:
    """Case-blind test for any of some lower-case needles; false for null."""

    def test(low: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(low, F.lit(n)) for n in needles], F.lit(False))

    return let(F.lower(or_empty(c)), test)


def all_digits(c: Column) -> Column:
    return F.rlike(c, F.lit("^[0-9]+$"))


def pad2(c: Column) -> Column:
    """Zero-pad to two places; longer text stays whole."""
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def before(c: Column, mark: str) -> Column:
    """The part before the first ``mark``, or all of it."""
    return F.substring_index(c, mark, 1)


def after_last(c: Column, mark: str) -> Column:
    """The part after the last ``mark``, or all of it."""
    return F.substring_index(c, mark, -1)


def without_prefix(c: Column, prefix: str) -> Column:
    rest = F.substring(c, F.lit(len(prefix) + 1), F.length(c))
    return F.when(F.startswith(c, F.lit(prefix)), rest).otherwise(c)


def utc_iso(ts: Column) -> Column:
    """A timestamp as ISO-8601 text in UTC, whatever the session's zone."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    text = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.000000$", ""), F.lit("+00:00"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (lambdas defeat Spark's
    common-subexpression elimination, so repeated use would repeat the work)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# ---- character references ------------------------------------------------------

# References a browser writes when it serialises a page; "&amp;" has to come last.
_COMMON = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\xa0"), ("&#39;", "'"), ("&amp;", "&"))
_ONLY_COMMON = r"&(?!(?:lt|gt|quot|nbsp|#39|amp);)"
_REFERENCE = r"^&(#[xX]?[0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?"


# Names and their characters as one text to search: a literal map of some 250
# entries would weigh down every plan that decodes references.
_NAMED = "".join(f"\x01{name}\x02{chr(code)}" for name, code in {**name2codepoint, "apos": 39}.items())
# Numbers 128-159 stand for Windows-1252 characters.
_C1 = "".join(bytes([n]).decode("cp1252", errors="ignore") or chr(n) for n in range(128, 160))


def _named_char(name: Column) -> Column:
    at = F.instr(F.lit(_NAMED), F.concat(F.lit("\x01"), name, F.lit("\x02")))
    return F.when(at > 0, F.substring(F.lit(_NAMED), at + F.length(name) + 2, F.lit(1)))


def _numbered_char(code: Column) -> Column:
    bad = code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    return (
        F.when(bad, F.lit("\ufffd"))
        .when(code.between(128, 159), F.substring(F.lit(_C1), code - 127, F.lit(1)))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _decode_piece(piece: Column) -> Column:
    """``piece`` starts with "&" or holds no reference at all."""

    def char(name: Column) -> Column:
        hex_digits = F.regexp_extract(name, r"^#[xX]0*([0-9a-fA-F]{1,6})$", 1)
        dec_digits = F.regexp_extract(name, r"^#0*([0-9]{1,7})$", 1)
        code = F.when(
            hex_digits != "", F.conv(hex_digits, 16, 10).try_cast("int")
        ).otherwise(dec_digits.try_cast("int"))
        numeric = F.rlike(name, F.lit(r"^#(?:[0-9]+|[xX][0-9a-fA-F]+)$"))
        return F.when(numeric, let(code, _numbered_char)).otherwise(_named_char(name))

    def put(found: Column) -> Column:
        rest = F.regexp_replace(piece, _REFERENCE, "")
        return F.when(found.isNull(), piece).otherwise(F.concat(found, rest))

    return let(let(F.regexp_extract(piece, _REFERENCE, 1), char), put)


def unescape(c: Column) -> Column:
    """Decode HTML character references; one cheap test when there are none.

    ``c`` is used several times: bind a costly expression with ``let`` first.
    """
    common = c
    for ref, char in _COMMON:
        common = F.replace(common, F.lit(ref), F.lit(char))
    general = F.array_join(F.transform(F.split(c, "(?=&)"), _decode_piece), "")
    return (
        F.when(~F.contains(c, F.lit("&")), c)
        .when(~F.rlike(c, F.lit(_ONLY_COMMON)), common)
        .otherwise(general)
    )
