from datetime import datetime, timezone
from html import unescape

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joblark.functions import dates, text

ANCHOR = datetime(2024, 3, 15, 1, 30, tzinfo=timezone.utc)


def evaluate(spark, values, rule, name="c"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("i", T.LongType()), T.StructField(name, T.StringType())]))
    return [r["x"] for r in df.select("i", rule(F.col(name)).alias("x")).orderBy("i").collect()]


RELATIVE = [
    ("3 days ago", "2024-03-12"),
    ("Posted 2 weeks ago", "2024-03-01"),
    ("1 tháng trước", "2024-02-14"),
    ("2 năm trước", "2022-03-16"),
    ("1 year ago", "2023-03-16"),
    ("90 minutes ago", "2024-03-15"),
    ("91 minutes ago", "2024-03-14"),
    ("2 giờ trước", "2024-03-14"),
    ("5400 giây trước", "2024-03-15"),
    ("5401 seconds ago", "2024-03-14"),
    ("Đăng 10 NGÀY trước", "2024-03-05"),
    ("3\xa0phút　trước", "2024-03-15"),
    ("\t1\x1fweek\n", "2024-03-08"),
    ("007 days", "2024-03-08"),
    ("in 3 monthdays", "2023-12-16"),  # month is tried before day
    ("5 5 days", "5 5 days"),
    ("30+ days ago", "30+ days ago"),
    ("yesterday", "yesterday"),
    ("an hour ago", "an hour ago"),
    ("days 5", "days 5"),
    ("5", "5"),
    (" 3 moons ", " 3 moons "),
    ("   ", "   "),
    ("", ""),
    (None, ""),
    ("99999999999999999999 days ago", "99999999999999999999 days ago"),
    ("9999999 days ago", "9999999 days ago"),
]


def test_relative_dates(spark):
    got = evaluate(spark, [t for t, _ in RELATIVE], lambda c: dates.relative_date(c, F.lit(ANCHOR)))
    assert got == [want for _, want in RELATIVE]


DMY = [
    ("5/3/2024", "2024-03-05"),
    ("05-03-2024", "2024-03-05"),
    ("99-99-2024", "2024-99-99"),
    ("until 1/2-2024, then 3/4/2025", "2024-02-01"),
    ("12345/1/2024", "2024-01-45"),
    ("1/2/20245", "2024-02-01"),
    ("\xa0open \t", "open"),
    ("1/2/24", "1/2/24"),
    ("  ", ""),
    ("", ""),
    (None, ""),
]


def test_day_first_dates(spark):
    assert evaluate(spark, [t for t, _ in DMY], dates.dmy_date) == [want for _, want in DMY]


def test_key_dates(spark):
    values = ["2024-02-29", "2023-02-29", "2024-99-99", "2024-1-5", "30+ days ago", "", None]
    assert evaluate(spark, values, dates.key_date) == ["2024-02-29", "", "", "", "", "", ""]


def test_strip_matches_python(spark):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    values = [f"{s}a{s}b{s}{s}" for s in spaces] + ["".join(spaces), "", "x"]
    assert evaluate(spark, values, text.strip) == [v.strip() for v in values]
    assert evaluate(spark, [*values, None], text.is_blank) == [v.strip() == "" for v in values] + [True]


def test_unescape_matches_python(spark):
    values = [
        "plain", "a &amp; b", "&lt;b&gt;", "&amp;lt;", "&nbsp;x", "&eacute;&Eacute;&hearts;", "&#233;&#xe9;&#XE9;",
        "&#x1F600;", "&#128;&#150;", "&#0;", "&#xD800;", "AT&T & co", "&unknown;", "&;", "&", "&&amp;&", "&#;", "&#39;&apos;",
        "&quot;q&quot;", "&copy 2024", "&#8364", "&amp;amp;", "cut&amp",
    ]
    assert evaluate(spark, values, text.unescape) == [unescape(v) for v in values]


def test_pieces(spark):
    assert evaluate(spark, ["a?b?c", "a", "?x"], lambda c: text.before(c, "?")) == ["a", "a", ""]
    assert evaluate(spark, ["a/b/c", "a", "x/"], lambda c: text.after_last(c, "/")) == ["c", "a", ""]
    assert evaluate(spark, ["itviec_itviec_x", "x_itviec_"], lambda c: text.without_prefix(c, "itviec_")) == ["itviec_x", "x_itviec_"]
    assert evaluate(spark, ["5", "12", "123", ""], text.pad2) == ["05", "12", "123", "00"]
    assert evaluate(spark, ["5", "x5", "", "12"], text.all_digits) == [True, False, False, True]


def test_contains_any(spark):
    values = ["Please SOLVE this CAPTCHA", "fine", "", None]
    assert evaluate(spark, values, lambda c: text.contains_any(c, ("captcha", "denied"))) == [True, False, False, False]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_micros(1704067199000000) AS a, timestamp_micros(1704067199000042) AS b")
        row = df.select(
            text.utc_iso(F.col("a")).alias("xa"),
            text.utc_iso(F.col("b")).alias("xb"),
            dates.relative_date(F.lit("1 second ago"), F.col("a")).alias("xc"),
            F.unix_seconds(dates.ntz_as_utc(F.expr("TIMESTAMP_NTZ '2023-12-31 23:59:59'"))).alias("xd"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["xa"] == "2023-12-31T23:59:59+00:00"
    assert row["xb"] == "2023-12-31T23:59:59.000042+00:00"
    assert row["xc"] == "2023-12-31"
    assert row["xd"] == 1704067199
