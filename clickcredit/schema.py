"""Schemas and fixed values of the hit data model."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being re-created, so they are
# stated here plainly and in their natural order.
# ---------------------------------------------------------------------------
# Query-string names that carry a search keyword; precedence is this order.
SEARCH_PARAMS = ("q", "query", "p", "search", "keywords", "k")
# The shop's own domain (after lower-casing and dropping one leading "www.").
DEFAULT_SITE = "esshopzilla.com"
# event_list value that marks a completed purchase.
PURCHASE_EVENT = "1"
# Report header, in output order.
REPORT_HEADER = ("Search Engine Domain", "Search Keyword", "Revenue")
# Size threshold of the two processing paths: 2 GiB, "<" is small.
SIZE_THRESHOLD_BYTES = 2 * 1024 ** 3
# File status values.
STATUS_RECEIVED, STATUS_COMPLETE, STATUS_FAILED, STATUS_ERROR = (
    "RECEIVED", "COMPLETE", "FAILED", "ERROR")
# Required status-event fields, in the order they are checked.
REQUIRED_EVENT_FIELDS = ("file_key", "file_status", "event_type", "file_date")
# Status-event types: a file arrived, or which processing path handled it
# (chosen by size class), or this package's Spark job.
EVENT_ARRIVAL, EVENT_SMALL_FILE, EVENT_LARGE_FILE, EVENT_SPARK = (
    "ARRIVAL", "SMALL_FILE", "LARGE_FILE", "SPARK")
# Defaults used when a status event carries no bucket / content type.
DEFAULT_CONTENT_TYPE = "text/csv"
DEFAULT_BUCKET = "source-bucket"

# Hit file columns, tab-separated with a header row. Everything the query
# does not compute on stays text; hit_time_gmt is the ordering key.
HIT_SCHEMA = StructType([
    StructField("hit_time_gmt", LongType()),
    StructField("date_time", TimestampType()),
    StructField("user_agent", StringType()),
    StructField("ip", StringType()),
    StructField("event_list", StringType()),
    StructField("geo_city", StringType()),
    StructField("geo_region", StringType()),
    StructField("geo_country", StringType()),
    StructField("pagename", StringType()),
    StructField("page_url", StringType()),
    StructField("product_list", StringType()),
    StructField("referrer", StringType()),
])
HIT_COLUMNS = tuple(f.name for f in HIT_SCHEMA.fields)

# One row of the processing-status log.
STATUS_EVENT_SCHEMA = StructType([
    StructField("file_date", StringType()),
    StructField("file_key", StringType()),
    StructField("file_datetime", StringType()),
    StructField("file_status", StringType()),
    StructField("event_type", StringType()),
    StructField("bucket", StringType()),
    StructField("content_type", StringType()),
    StructField("file_size", LongType()),
    StructField("file_size_gb", DoubleType()),
    StructField("error_message", StringType()),
    StructField("record_count", LongType()),
    StructField("output_location", StringType()),
])
