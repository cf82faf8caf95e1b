"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblark.session import counted

# left, right, key columns, join type, columns that tell rows of one key apart
Join = Callable[[DataFrame, DataFrame, list[str], str, list[str]], DataFrame]

# Rows of one key that still make a comfortable task, and copies of a hot key's
# partner row. Keys at or above HOT_ROWS number at most total_rows / HOT_ROWS,
# which bounds the broadcast list: 10^12 rows give no more than 10^6 short keys.
HOT_ROWS = 1_000_000
SALTS = 64

# A narrow right side of up to this many rows (some 60 MB) is broadcast.
BROADCAST_ROWS = 1_000_000


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with at least ``hot_rows`` rows; counts are combined before the shuffle."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") >= hot_rows).select(*on)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread: list[str],
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """``left`` semi, anti or left-outer join ``right``, hot keys of ``left`` salted.

    ``right`` has to be distinct on ``on``. Rows of a hot key are told apart by
    ``spread`` (columns that differ between rows of one key, such as the URL) and
    spread over ``salts`` groups; only the partner rows of hot keys are copied.
    Exact for any choice of ``hot_rows``. The salt depends on row values alone,
    so a task that runs again after a lost executor makes the same choice.
    """
    if how not in ("left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    hot = F.broadcast(hot_keys(left.select(*on), on, hot_rows).withColumn("_hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    salted = left.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0))
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    partners = right.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted.drop("_hot").join(partners, [*on, "_salt"], how).drop("_salt")


def sized_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread: list[str],
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """The same result by a plan that fits the size of ``right``, which is narrow
    and written once to be counted: broadcast up to ``limit`` rows, so that
    ``left`` is not shuffled at all, and salted beyond."""
    written, count = counted(right, "right")
    if count <= limit:
        return left.join(F.broadcast(written), on, how)
    return skew_join(left, written, on, how, spread)
