"""Pinned schemas. Spark never infers these; empty inputs still carry them."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the movement table (fixed).
MOVEMENT_COLUMNS = (
    "mov_id", "company", "item_code", "warehouse", "doc_date", "doc_time", "doc_ts",
    "create_date", "trans_type", "base_entry", "base_num", "doc_line", "in_qty", "out_qty",
    "trans_value", "retail_year",
)

# The twelve source columns a movement extract carries before finalisation.
SOURCE_COLUMNS = (
    "item_code", "warehouse", "doc_date", "doc_time", "create_date", "trans_type",
    "base_entry", "base_num", "doc_line", "in_qty", "out_qty", "trans_value",
)

MOVEMENT_SCHEMA = T.StructType([
    T.StructField("mov_id", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("item_code", T.StringType()),
    T.StructField("warehouse", T.StringType()),
    T.StructField("doc_date", T.DateType()),
    T.StructField("doc_time", T.ShortType()),
    T.StructField("doc_ts", T.TimestampNTZType()),
    T.StructField("create_date", T.DateType()),
    T.StructField("trans_type", T.LongType()),
    T.StructField("base_entry", T.LongType()),
    T.StructField("base_num", T.LongType()),
    T.StructField("doc_line", T.LongType()),
    T.StructField("in_qty", T.DoubleType()),
    T.StructField("out_qty", T.DoubleType()),
    T.StructField("trans_value", T.DoubleType()),
    T.StructField("retail_year", T.ShortType()),
])

STOCK_SCHEMA = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("item_code", T.StringType()),
    T.StructField("warehouse", T.StringType()),
    T.StructField("qty_sap", T.DoubleType()),
])

RUN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("job", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("trigger", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("detail", T.StringType()),
    T.StructField("correlation_id", T.StringType()),
    T.StructField("idempotency_key", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("finished_at", T.TimestampNTZType()),
])

_BASE = [
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("level", T.StringType()),
    T.StructField("correlation_id", T.StringType()),
    T.StructField("source", T.StringType()),
]
_ACTIVITY = [
    T.StructField("status", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("finished_at", T.TimestampNTZType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("detail", T.StringType()),
]
# event_id is the unique tie column that stands in for a storage rowid.
_TIE = [T.StructField("event_id", T.LongType())]

JOB_LOG_SCHEMA = T.StructType(_TIE + _BASE + _ACTIVITY + [
    T.StructField("job", T.StringType()), T.StructField("rows", T.LongType())])
API_LOG_SCHEMA = T.StructType(_TIE + _BASE + _ACTIVITY + [
    T.StructField("method", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("status_code", T.IntegerType())])
PERF_LOG_SCHEMA = T.StructType(_TIE + _BASE + [
    T.StructField("host", T.StringType()),
    T.StructField("cpu_pct", T.DoubleType()), T.StructField("rss_mb", T.DoubleType()),
    T.StructField("mem_pct", T.DoubleType()), T.StructField("disk_pct", T.DoubleType()),
    T.StructField("io_counter_mb", T.DoubleType())])

LOG_SCHEMAS = {"job": JOB_LOG_SCHEMA, "api": API_LOG_SCHEMA, "performance": PERF_LOG_SCHEMA}
