"""Messages as JSON text: arrival notifications of an object store, and completion payloads.

Both are read with a declared schema. What can't be read is kept as text with a reason, so a sink
can store it; nothing is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import STATUS_RECEIVED

# The notification's own field names.
NOTIFICATION_SCHEMA = (
    "Records array<struct<eventName: string, eventTime: string, s3: struct<bucket: struct<name: string>, "
    "object: struct<key: string, size: bigint, contentType: string>>>>, broken string")
COMPLETION_SCHEMA = (
    "file_date string, file_key string, bucket string, content_type string, event_type string, "
    "file_datetime string, file_size_gb string, file_status string, error_message string, broken string")
NOT_JSON, NO_RECORD, NO_KEY = "not JSON", "no record", "no object key"


def _decoded(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})


def _utc(text: Column) -> Column:
    """ISO time with a Z as a zone-less timestamp; null if it is none."""
    return F.regexp_replace(text, "Z$", "").try_cast("timestamp_ntz")


def read_notifications(messages: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per record of each message, with the message's other columns.

    Adds ``record`` (its place, from 0), ``event_name``, ``file_ts``, ``bucket``, ``raw_key``,
    ``file_size``, ``content_type`` and ``reject_reason``: null, or why there is no file in it. A message that is not
    JSON, null, or without records is one row with a reason.
    """
    own = [c for c in messages.columns if c != text_col]
    read = messages.withColumn("_m", _decoded(F.col(text_col), NOTIFICATION_SCHEMA))
    each = read.select(*own, text_col, "_m.broken", F.posexplode_outer("_m.Records").alias("record", "_r"))
    key = F.nullif(F.col("_r.s3.object.key"), F.lit(""))
    text = F.col(text_col)
    reason = (F.when(text.isNull() | (F.trim(text) == "") | F.col("broken").isNotNull(), NOT_JSON)
              .when(F.col("_r").isNull(), NO_RECORD).when(key.isNull(), NO_KEY))
    return each.select(
        *own, text_col, "record", F.col("_r.eventName").alias("event_name"),
        _utc(F.col("_r.eventTime")).alias("file_ts"), F.col("_r.s3.bucket.name").alias("bucket"),
        key.alias("raw_key"), F.col("_r.s3.object.size").alias("file_size"),
        F.col("_r.s3.object.contentType").alias("content_type"), reason.alias("reject_reason"))


def notified_files(notifications: DataFrame) -> DataFrame:
    """Records that name a file, as input of ``file_manifest`` (status RECEIVED)."""
    return (notifications.where(F.col("reject_reason").isNull()).drop("reject_reason")
            .withColumn("file_status", F.lit(STATUS_RECEIVED)))


def rejected_notifications(notifications: DataFrame) -> DataFrame:
    """Messages and records without a file, with the text and the reason."""
    return notifications.where(F.col("reject_reason").isNotNull())


def read_completions(messages: DataFrame, run_ts: str, text_col: str = "value") -> DataFrame:
    """Completion payloads as status events, the message's other columns kept.

    A missing time is ``run_ts`` (``YYYY-MM-DD HH:MM:SS`` text). Required fields are not
    checked here: the append does that. Text that is not JSON has none, so it is rejected there.
    """
    own = [c for c in messages.columns if c != text_col]
    read = messages.withColumn("_m", _decoded(F.col(text_col), COMPLETION_SCHEMA))
    return read.select(
        *own, "_m.file_date", "_m.file_key", "_m.bucket", "_m.content_type", "_m.event_type", "_m.file_status",
        "_m.error_message", F.lit(None).cast("long").alias("file_size"),
        F.nullif(F.col("_m.file_size_gb"), F.lit("")).try_cast("double").alias("file_size_gb"),
        F.coalesce(_utc(F.col("_m.file_datetime")), F.lit(run_ts).cast("timestamp_ntz")).alias("file_ts"))
