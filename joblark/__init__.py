"""joblark: a Spark-native engine for incremental job-posting tables.

Fetched web pages come in as tables; clean, de-duplicated, quality-gated job
records go out as JSONL and as a typed silver table, in batch or as a stream.
"""
