"""URL checks over a fetch log, and the common error table."""

from __future__ import annotations

import traceback
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblark.functions.text import contains_any, or_empty
from joblark.schemas import ERROR

# Answers that will not change, and answers worth another try.
PERMANENT_CODES = (404, 410, 451)
TRANSIENT_CODES = (429, 500, 502, 503, 504)


def check_urls(log: DataFrame) -> DataFrame:
    """A fetch log ``(url, status_code, reason, error_type, tb_str)`` as check results.

    A final status of 2xx is valid (redirects have been followed by then). Any
    other answer is an ``HTTPError``; no answer has code 0 and the error's type.
    """
    code = F.coalesce(F.col("status_code"), F.lit(0)).cast("int")
    valid = code.between(200, 299)
    no_answer = F.coalesce(F.nullif(F.col("error_type"), F.lit("")), F.lit("URLError"))
    return log.select(
        *(c for c in ("source", "url") if c in log.columns),
        valid.alias("is_valid"),
        code.alias("status_code"),
        F.when(valid, "OK").otherwise(or_empty(F.col("reason"))).alias("reason"),
        F.when(valid, "").when(code != 0, "HTTPError").otherwise(no_answer).alias("error_type"),
        F.when(valid, "").otherwise(or_empty(F.col("tb_str"))).alias("tb_str"),
    )


def all_valid(urls: DataFrame) -> DataFrame:
    """The result for a source whose URLs are not checked."""
    return urls.select(
        "url",
        F.lit(True).alias("is_valid"),
        F.lit(200).alias("status_code"),
        F.lit("OK").alias("reason"),
        F.lit("").alias("error_type"),
        F.lit("").alias("tb_str"),
    )


def partition_urls(checks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, failed)``; every URL lies in exactly one of them."""
    ok = _valid()
    return checks.where(ok).select("url"), checks.where(~ok)


def _valid() -> Column:
    """A check without a verdict has failed."""
    return F.coalesce(F.col("is_valid"), F.lit(False))


def check_counts(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count_if(_valid()).alias("reachable"),
        F.count_if(~_valid()).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def severity(code: Column) -> Column:
    return F.when(code.isin(*TRANSIENT_CODES), "warning").otherwise("error")


def failure_class(code: Column) -> Column:
    return (
        F.when(code.isin(*PERMANENT_CODES), "permanent")
        .when(code.isin(*TRANSIENT_CODES), "transient")
        .otherwise("other")
    )


def error_records(failures: DataFrame, source: str | Column, at: Column | None = None) -> DataFrame:
    """Failed checks in the common error shape."""
    return failures.select(
        (at if at is not None else F.current_timestamp()).alias("timestamp"),
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        "error_type",
        # Both templates, which readers of the error area know.
        F.format_string("[%d] %s", F.col("status_code"), F.col("reason")).alias("error_msg"),
        F.concat(F.lit("url_validator: "), F.col("url")).alias("context"),
        F.col("tb_str").alias("traceback"),
    )


def exception_record(spark: SparkSession, error: BaseException, source: str, context: str = "") -> DataFrame:
    """One caught exception in the common error shape."""
    trace = "".join(traceback.format_exception(error))
    row = (datetime.now(timezone.utc), source, type(error).__name__, str(error), context, trace)
    return spark.createDataFrame([row], ERROR)


def error_class(message: Column, markers: tuple[str, ...]) -> Column:
    """``disconnect`` when the text names a lost browser, else ``generic``."""
    return F.when(contains_any(message, markers), "disconnect").otherwise("generic")
