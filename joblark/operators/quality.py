"""The quality gate and its report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.functions.text import is_blank
from joblark.operators.joins import Join, skew_join
from joblark.sources.spec import CRITICAL_FIELDS, EMPTY_THRESHOLD


class DataQualityError(RuntimeError):
    """Too many records of a group lack a critical field."""


def is_bad(fields: tuple[str, ...] = CRITICAL_FIELDS) -> Column:
    """Any critical field null, empty or blank."""
    return reduce(lambda a, b: a | b, [is_blank(F.col(f)) for f in fields])


def quality_report(
    records: DataFrame,
    by: list[str],
    fields: tuple[str, ...] = CRITICAL_FIELDS,
    threshold: float = EMPTY_THRESHOLD,
    bad: Column | None = None,
) -> DataFrame:
    """One row per group: ``total, bad, clean, ratio, passed, message``.

    Groups without records have no row, and so pass. Counts combine before the
    shuffle, so the size of a group does not matter.
    """
    present = [f for f in fields if f in records.columns]
    test = bad if bad is not None else is_bad(fields) if len(present) == len(fields) else F.lit(True)
    counts = records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(test).alias("bad")
    )
    return judged(counts, by, F.lit(", ".join(fields)), F.lit(threshold))


def judged(counts: DataFrame, by: list[str], fields: Column, threshold: Column) -> DataFrame:
    """The report of counts ``(*by, total, bad)``; a group without records passes."""
    name = F.concat_ws("/", *[F.col(c).cast("string") for c in by])
    ratio = F.when(F.col("total") > 0, F.col("bad") / F.col("total")).otherwise(0.0)
    failed = F.format_string(
        "Quality check failed for '%s': %d/%d records (%.0f%%) lack a critical field (%s)",
        name, F.col("bad"), F.col("total"), F.bround(ratio * 100, 0), fields,
    )
    passed = F.format_string(
        "[%s] %d of %d records have all critical fields", name, F.col("total") - F.col("bad"), F.col("total")
    )
    return counts.select(
        *by,
        "total",
        "bad",
        (F.col("total") - F.col("bad")).alias("clean"),
        ratio.alias("ratio"),
        (ratio <= threshold).alias("passed"),
        F.when(ratio <= threshold, passed).otherwise(failed).alias("message"),
    )


def enforce(report: DataFrame, failures: int | None = None) -> None:
    """Raise for a failed group; one row reaches the driver. A report known to have no failures is not read."""
    failed = report.where(~F.col("passed")).select("message").take(1) if failures != 0 else []
    if failed:
        raise DataQualityError(failed[0]["message"])


def passing_records(
    records: DataFrame, report: DataFrame, by: list[str], spread: list[str], join: Join = skew_join
) -> DataFrame:
    """The records of the groups that pass: a group is kept or left out whole."""
    failed = report.where(~F.col("passed")).select(*by)
    return join(records, failed, by, "left_anti", spread)
