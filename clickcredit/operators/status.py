"""File manifest, processing-status events, validation and latest status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (content_type as content_type_of, decode_key, file_date_from_key, file_name, iso_utc,
                         size_class, size_gb)
from ..functions.files import file_name_sql
from ..schema import (DEFAULT_BUCKET, DEFAULT_CONTENT_TYPE, EVENT_ARRIVAL, EVENT_LARGE_FILE,
                      EVENT_SMALL_FILE, REQUIRED_EVENT_FIELDS, SIZE_THRESHOLD_BYTES,
                      STATUS_FAILED, STATUS_RECEIVED)


def file_manifest(files: DataFrame, run_date: str, *, key_col: str = "raw_key",
                  decode: str = "plus") -> DataFrame:
    """Key, name, date, size, size in GiB, size class and content type per file.

    A ``content_type`` that the input gives is kept unless blank; else the name's ending tells.

    ``decode``: ``plus`` for notification keys (``unquote_plus``), ``none`` for
    keys that are already plain text.
    """
    key = decode_key(key_col) if decode == "plus" else F.col(key_col)
    passthrough = [c for c in ("event_seq", "file_status", "file_ts", "modified_ts", "bucket", "event_type",
                               "record_count", "output_location", "error_message") if c in files.columns]
    given = F.nullif(F.col("content_type"), F.lit("")) if "content_type" in files.columns else F.lit(None)
    return files.withColumn("file_key", key).select(
        *passthrough,
        "file_key",
        file_name("file_key").alias("file_name"),
        file_date_from_key("file_key", run_date).alias("file_date"),
        F.col("file_size"),
        size_gb("file_size").alias("file_size_gb"),
        size_class("file_size").alias("size_class"),
        F.coalesce(given, content_type_of(file_name_sql("`file_key`"))).alias("content_type"),
    )


def processing_engine(file_size: Column) -> Column:
    """Which processing path a file's size selects (a label; both paths are this job)."""
    return F.when(file_size < SIZE_THRESHOLD_BYTES, EVENT_SMALL_FILE).when(
        file_size >= SIZE_THRESHOLD_BYTES, EVENT_LARGE_FILE)


def _blank_to_default(col: Column, default: str) -> Column:
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def status_events(manifest_events: DataFrame, *, bucket: str = DEFAULT_BUCKET,
                  content_type: str = DEFAULT_CONTENT_TYPE) -> DataFrame:
    """Status-log rows plus the completion payload as JSON.

    Input: manifest rows with ``file_status``, ``file_ts`` and optional
    ``bucket``/``content_type``/``error_message``/``event_type``/
    ``record_count``/``output_location``. A missing ``event_type`` is the
    arrival notification for RECEIVED, otherwise the engine chosen by size class.
    Null fields are left out of the JSON (``to_json`` drops nulls).
    """
    cols = set(manifest_events.columns)

    def opt(name: str) -> Column:
        return F.col(name) if name in cols else F.lit(None).cast("string")

    derived_type = F.when(F.col("file_status") == STATUS_RECEIVED, F.lit(EVENT_ARRIVAL)).otherwise(
        processing_engine(F.col("file_size")))
    ev = manifest_events.select(
        *[c for c in ("event_seq", "record_count", "output_location", "modified_ts") if c in cols],
        "file_date", "file_key", "file_status", "file_size", "file_size_gb", "file_ts",
        F.coalesce(F.nullif(opt("event_type"), F.lit("")), derived_type).alias("event_type"),
        _blank_to_default(opt("bucket"), bucket).alias("bucket"),
        _blank_to_default(opt("content_type"), content_type).alias("content_type"),
        iso_utc("file_ts").alias("file_datetime"),
        F.nullif(opt("error_message"), F.lit("")).alias("error_message"),
    )
    payload = F.to_json(F.struct(
        "file_date", "file_key", "bucket", "content_type", "event_type", "file_datetime",
        F.lit("").alias("file_size_gb"), "file_status", "error_message"))
    return ev.withColumn("payload", payload)


def reject_reason(fields: Sequence[str] = REQUIRED_EVENT_FIELDS) -> Column:
    """First missing (null or empty) required field, in check order; null if none."""
    out = F.lit(None).cast("string")
    for name in reversed(fields):
        missing = F.col(name).isNull() | (F.col(name).cast("string") == "")
        out = F.when(missing, F.lit(f"Missing required parameter: {name}")).otherwise(out)
    return out


def validate_status_events(events: DataFrame) -> DataFrame:
    return events.withColumn("reject_reason", reject_reason())


def accepted_status_events(events: DataFrame) -> DataFrame:
    return validate_status_events(events).where(F.col("reject_reason").isNull())


def rejected_status_events(events: DataFrame) -> DataFrame:
    return validate_status_events(events).where(F.col("reject_reason").isNotNull())


def new_files(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Listed files (path, modified_ts, file_size) that no event of the log is about yet.

    A file that was delivered again, with another time or size, is new.
    """
    known = (log.where(F.col("modified_ts").isNotNull())
             .select(F.col("file_key").alias("path"), "modified_ts", "file_size").distinct())
    return listing.join(known, ["path", "modified_ts", "file_size"], "left_anti")


def latest_file_status(log: DataFrame, *, keys: Sequence[str] = ("file_date", "file_key"),
                       order_by: Sequence[str] = ("file_ts", "event_seq"),
                       carry: Sequence[str] = ("file_status", "event_type", "file_datetime")
                       ) -> DataFrame:
    """Current state per file: the latest event by ``order_by`` (a keyed upsert).

    ``max(struct(order..., carried...))`` combines map-side, so a file with a
    huge event history never lands in one task as a whole.
    """
    # Among events of one time and sequence, a file is received before it is done.
    done = (F.col("file_status") != STATUS_RECEIVED).alias("_done")
    latest = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], done,
                            *[F.col(c) for c in carry]))
    agg = log.groupBy(*keys).agg(latest.alias("_l"), F.count(F.lit(1)).alias("n_events"))
    return agg.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in carry], "n_events")
