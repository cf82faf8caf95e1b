"""Row types of the tables the engine reads and writes."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


LISTING_PAGE = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("page_no", T.IntegerType())]
    + _strings("url", "html")
)

DETAIL_PAGE = T.StructType(
    _strings("source", "url", "job_id", "html") + [T.StructField("crawled_at", T.TimestampType())]
)

# A raw record: dates are still text, absent fields are "".
BRONZE = T.StructType(
    _strings("job_id", "title", "company", "salary", "locations", "working_method", "posted_date")
    + [T.StructField("skills", T.ArrayType(T.StringType()))]
    + _strings("description", "source", "url", "crawled_at")
)

# The typed fact table; every column may be null.
SILVER = T.StructType(
    _strings("job_id", "title", "company", "salary", "locations", "working_method")
    + [
        T.StructField("posted_date", T.DateType()),
        T.StructField("skills", T.ArrayType(T.StringType())),
    ]
    + _strings("description", "source", "url")
    + [
        T.StructField("crawled_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# Partition column of the silver files, so that a look-back reads only its days.
SILVER_PARTITION = "crawled_date"
SILVER_FILES = T.StructType(SILVER.fields + [T.StructField(SILVER_PARTITION, T.DateType())])

KEYS = T.StructType(_strings("job_id", "posted_date"))

# What a run is about to save, until silver holds it.
CLAIM = T.StructType([SILVER[n] for n in ("source", "job_id", "posted_date", "crawled_at")])

# What a run saved from each of its sources; turns number the runs of a store in the order of their saves.
PROGRESS = T.StructType(
    _strings("run_id", "source") + [T.StructField(n, T.LongType()) for n in ("turn", "saved")]
)

FETCH_LOG = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("is_valid", T.BooleanType()),
        T.StructField("status_code", T.IntegerType()),
    ]
    + _strings("reason", "error_type", "tb_str")
)

ERROR = T.StructType(
    [T.StructField("timestamp", T.TimestampType())]
    + _strings("source", "error_type", "error_msg", "context", "traceback")
)

# What became of each page of a run; OUTCOMES in plans/ingest.py names the values.
OUTCOME = T.StructType(
    _strings("source", "url", "job_id")
    + [T.StructField("batch_no", T.LongType())]
    + _strings("outcome", "run_id")
)

REPORT = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("batch_no", T.LongType())]
    + [T.StructField(n, T.LongType()) for n in ("total", "bad", "clean")]
    + [T.StructField("ratio", T.DoubleType()), T.StructField("passed", T.BooleanType())]
    + _strings("message", "run_id")
)
