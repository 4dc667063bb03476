"""Registered queries that go through files: scan, listing, sinks, status log, jobs, stream.

Each one writes data Spark derives from the driver tables into a fresh folder
under the shared checkpoint root, then reads it back. Columns that hold the folder's random
name are left out or cut to the day, so that SQL over the tables gives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution as A
from ..operators.enrich import enrich_hits
from ..operators.status import file_manifest, latest_file_status
from ..session import scratch_path
from ..sinks.eventlog import (append_file_events, compact_file_events, read_file_events,
                              read_rejected_events)
from ..sinks.hits import by_day, write_hits_tsv
from ..sinks.report import read_report_lines, with_places, write_file_reports, write_report
from ..sources.files import read_file_listing
from ..sources.hits import load_event_hits, read_hits
from ..streaming.file_stream import read_stream_output, start_report_stream
from .catalog import ORDER, events_report_exact, orders_status_events, raw_status_events
from .job import route_new_files, run_pending
from .oracle import LANDING_SPLITS, RUN_DATE

RUN_TS = dt.datetime.fromisoformat(f"{RUN_DATE}T12:00:00")


def _day_of(path: str):
    return F.regexp_extract(path, "file_key=([0-9-]+)", 1)


def q_hits_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Event-derived hits written as landing files (TSV with header), scanned back."""
    path = scratch_path(spark, "hits-tsv")
    write_hits_tsv(load_event_hits(spark, sf), path)
    return read_hits(spark, path).select(
        "hit_time_gmt", F.substring(F.col("date_time").cast("string"), 1, 19).alias("date_time"), "ip",
        "event_list", "pagename", "product_list", "referrer")


def _landed(spark: SparkSession, sf: str, splits: int = LANDING_SPLITS) -> str:
    """Hits as landing files: a folder for each day, split by visitor."""
    landing = scratch_path(spark, "landing")
    write_hits_tsv(load_event_hits(spark, sf), landing, file_key=by_day(), splits=splits)
    return landing


def q_file_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The landing files of one day each, listed: size, size class, content type."""
    listing = read_file_listing(spark, _landed(spark, sf, splits=1), "*.csv")
    return file_manifest(listing, RUN_DATE, key_col="path", decode="none").select(
        _day_of("file_key").alias("day"), "file_date", "file_size", "file_size_gb", "size_class", "content_type")


def q_write_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report written as TSV with a header, read back."""
    path = scratch_path(spark, "report")
    write_report(events_report_exact(spark, sf), path)
    return spark.read.option("header", True).option("sep", "\t").csv(path)


def q_report_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of many inputs and dates in one job, one place each, as the lines of the files.

    An input is the hits of one visitor on one day, so many have no credit: their
    report is the header line.
    """
    root = scratch_path(spark, "reports")
    hits = load_event_hits(spark, sf).where("ip IS NOT NULL").withColumn(
        "source_file", F.concat_ws("/", F.lit("hits"), by_day(), "ip"))
    day = F.split_part("source_file", F.lit("/"), F.lit(2))
    counted = A.keyword_revenue_counted(enrich_hits(A.quiet_hits(hits)), order_by=ORDER,
                                        report_by=("source_file",)).checkpoint(eager=True)
    places = with_places(counted.select("source_file").distinct(), day)
    write_file_reports(with_places(A.credited_rows(counted), day), places, root)
    return read_report_lines(spark, root).withColumnRenamed("value", "line")


def q_file_event_log(spark: SparkSession, sf: str) -> DataFrame:
    """Status events appended to the log in batches, one of them twice, with a compaction in
    between; read back."""
    path = scratch_path(spark, "file-events")
    events = orders_status_events(spark, sf)
    part = lambda k: events.where(F.col("event_seq") % 3 == k)
    append_file_events(part(0), path, "batch-0")
    append_file_events(part(1), path, "batch-1")
    compact_file_events(spark, path)
    append_file_events(part(1), path, "batch-1")
    append_file_events(part(2), path, "batch-2")
    return read_file_events(spark, path).select(
        "event_seq", "file_date", "file_key", "file_status", "event_type", "bucket", "content_type",
        "file_datetime", "error_message")


def q_file_event_log_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Events with missing fields appended: what the log took and what it refused, with the reason."""
    path = scratch_path(spark, "checked-events")
    append_file_events(raw_status_events(spark, sf), path)
    taken = read_file_events(spark, path).select("event_seq", F.lit(None).cast("string").alias("reject_reason"))
    return taken.unionByName(read_rejected_events(spark, path).select("event_seq", "reject_reason"))


def q_report_job(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files routed twice and reported in one job; the current status of each file."""
    landing, log = _landed(spark, sf, splits=1), scratch_path(spark, "job-log")
    route_new_files(spark, landing, log, run_ts=RUN_TS, path_glob="*.csv")
    route_new_files(spark, landing, log, run_ts=RUN_TS, path_glob="*.csv")
    run_pending(spark, scratch_path(spark, "job-reports"), log, run_ts=RUN_TS + dt.timedelta(minutes=5))
    route_new_files(spark, landing, log, run_ts=RUN_TS + dt.timedelta(minutes=9), path_glob="*.csv")
    latest = latest_file_status(read_file_events(spark, log),
                                carry=("file_status", "event_type", "record_count", "file_datetime"))
    return latest.select(_day_of("file_key").alias("day"), "file_date", "file_status", "event_type",
                         "record_count", "file_datetime", "n_events")


def q_stream_keyword_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Hits landed as files per day and part of the visitors, streamed; the report texts of the
    files read back and added by day."""
    landing = _landed(spark, sf)
    out = scratch_path(spark, "stream-out")
    query = start_report_stream(spark, landing, out, max_files_per_trigger=64)
    query.awaitTermination()
    return (read_stream_output(spark, out, landing).groupBy(_day_of("source_file").alias("day"), "domain", "keyword")
            .agg(F.sum("revenue").cast("double").alias("revenue")))


def q_stream_file_events(spark: SparkSession, sf: str) -> DataFrame:
    """The status events of such a stream: files and hits of each day."""
    landing, log = _landed(spark, sf), scratch_path(spark, "stream-log")
    query = start_report_stream(spark, landing, scratch_path(spark, "stream-out"), max_files_per_trigger=64,
                                log_path=log)
    query.awaitTermination()
    return (read_file_events(spark, log).groupBy(_day_of("file_key").alias("day"), "file_status")
            .agg(F.sum("record_count").alias("hits"), F.count_if(F.col("output_location").isNull()).alias("n_without_report")))


IO_QUERIES = {
    "hits_scan": q_hits_scan,
    "file_listing": q_file_listing,
    "write_report": q_write_report,
    "report_partitioned": q_report_partitioned,
    "file_event_log": q_file_event_log,
    "file_event_log_checked": q_file_event_log_checked,
    "report_job": q_report_job,
    "stream_keyword_revenue": q_stream_keyword_revenue,
    "stream_file_events": q_stream_file_events,
}
