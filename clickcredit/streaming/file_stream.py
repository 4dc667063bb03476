"""File-arrival stream: one report and one status event per arriving file.

A stream over file metadata replaces the per-file notification handler. The stream reads no
contents; the batch job of a batch's files does (``plans.job.report_files``), so every file, with
credit or without, gets a report text and an event. Sessions are scoped to one file, so no
state is kept across micro-batches.

Both sinks are idempotent. A batch overwrites only the places of its own files (by date and digest
of the whole path, dynamic partition overwrite), and its events are one append with the batch's
own id, so a replayed batch changes nothing. The checkpoint lives under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.attribution import keyword_revenue_exact
from ..operators.enrich import enrich_hits
from ..operators.status import new_files
from ..plans.job import error_text, failed_events, report_files
from ..schema import DEFAULT_SITE
from ..session import scratch_path
from ..sinks.eventlog import append_file_events, read_file_events
from ..sinks.report import read_file_reports, source_id
from ..sources.files import empty_file_listing, file_arrivals, plain_path, read_file_listing

REPORT_KEYS = ("source_file",)


def per_file_report(hits: DataFrame, *, site: str = DEFAULT_SITE, attribution: str = "last",
                    strict: bool = True, order_by=("hit_time_gmt",)) -> DataFrame:
    """Report rows per (source file, domain, keyword) with exact revenue."""
    rep = keyword_revenue_exact(enrich_hits(hits, site=site), attribution=attribution,
                                strict=strict, order_by=order_by,
                                session_keys=("source_file", "ip"), report_by=REPORT_KEYS)
    path = plain_path(F.col("source_file"))
    return rep.withColumns({
        "source_file": path,
        "source_name": F.substring_index(path, "/", -1),
        # File names repeat across date folders; the partition key is the whole path.
        "source_id": source_id(path),
    })


def _report_each(spark: SparkSession, files: DataFrame, output_dir: str, run_ts: dt.datetime, options: dict) -> DataFrame:
    """Events of the files one by one: FAILED for those that can't be reported."""
    out = None
    for row in files.select("path").collect():  # no more than the trigger's files
        one = files.where(F.col("path") == row.path)
        try:
            events = report_files(spark, one, output_dir, run_ts=run_ts, **options).checkpoint(eager=True)
        except Exception as exc:
            events = failed_events(one, run_ts, error_text(exc))
        out = events if out is None else out.unionByName(events, allowMissingColumns=True)
    return out


def start_report_stream(spark: SparkSession, input_dir: str, output_dir: str, *,
                        checkpoint_dir: str | None = None, site: str = DEFAULT_SITE,
                        attribution: str = "last", strict: bool = True,
                        max_files_per_trigger: int = 1, log_path: str | None = None,
                        dated_by: str = "file", available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``available_now`` processes the backlog and stops.

    Every file has its report text under ``output_dir`` (``sinks.report.PLACE``), dated by its path
    or, with ``dated_by="run"``, by the day of the batch. With ``log_path`` it also gets a COMPLETE
    event with its number of hits. If a batch fails, its files are tried one by one: those that
    can't be read get a FAILED event with the message (without a log, the error is raised).

    Files without a byte are not in Spark's listings; the driver looks for them when a batch has
    fewer files than the trigger allows.
    """
    checkpoint_dir = checkpoint_dir or scratch_path(spark, "stream-ckpt")
    options = {"site": site, "attribution": attribution, "strict": strict, "dated_by": dated_by}
    own = hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:16]  # ids of one stream's batches

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        files = batch.checkpoint(eager=True)
        if files.count() < max_files_per_trigger:
            empty = empty_file_listing(spark, input_dir)
            if log_path:
                empty = new_files(empty, read_file_events(spark, log_path))
            files = files.unionByName(empty).checkpoint(eager=True)
        if files.isEmpty():
            return
        try:
            events = report_files(spark, files, output_dir, run_ts=run_ts, **options).checkpoint(eager=True)
        except Exception:
            if not log_path:
                raise
            events = _report_each(spark, files, output_dir, run_ts, options)
        if log_path:
            append_file_events(events, log_path, f"stream-{own}-{batch_id:010d}")

    writer = (file_arrivals(spark, input_dir, max_files_per_trigger).writeStream
              .foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def read_stream_output(spark: SparkSession, output_dir: str, input_dir: str | None = None) -> DataFrame:
    """Rows of all report texts: place columns, domain, keyword, revenue.

    With ``input_dir``, its listing adds ``source_file`` and ``source_name``.
    """
    rows = read_file_reports(spark, output_dir).toDF("domain", "keyword", "revenue", "year", "month", "date", "source_id")
    rows = rows.withColumn("revenue", F.col("revenue").cast("decimal(38,2)"))
    if input_dir is None:
        return rows
    files = read_file_listing(spark, input_dir).select(
        F.col("path").alias("source_file"), F.substring_index("path", "/", -1).alias("source_name"),
        source_id(F.col("path")).alias("source_id"))
    return rows.join(files, "source_id")
