"""End-to-end batch jobs: route arriving files, and build reports for them.

``run_report_job`` is the whole original flow for one input (a file or a folder of files): scan,
attribute, write the TSV report under ``year=/month=/date=/source_id=/source_name=``, summarize,
and append a COMPLETE (or FAILED) event to the status log. ``report_files`` does the same for many
files in one job, each with its own place, report and event. Differences from the original, on
purpose:

* the record count comes from the report's own scan: hits that earn nothing are counted in a
  row of their own (``keyword_revenue_counted``), which an empty report has too;
* an input without credited revenue gives a header-only report and COMPLETE;
* the report is cut from its lineage with ``checkpoint()`` (reliable, in the
  shared ``spark.checkpoint.dir``) before it is written and summarized, so a
  lost executor never re-runs the attribution for the summary;
* a failure is logged and then raised, so the caller sees it.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import file_date_from_key
from ..operators.attribution import credited_rows, keyword_revenue_counted, quiet_hits
from ..operators.enrich import enrich_hits
from ..operators.status import file_manifest, latest_file_status, new_files, status_events
from ..operators.summary import report_summary, top_domains, top_keywords
from ..schema import DEFAULT_SITE, EVENT_SPARK, STATUS_COMPLETE, STATUS_FAILED, STATUS_RECEIVED
from ..session import checkpoint_root
from ..sinks.eventlog import append_file_events, read_file_events
from ..sinks.report import place_path, with_places, write_file_reports, write_partitioned_report
from ..sources.files import literal_path, plain_path, read_file_listing
from ..sources.hits import read_hits


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path as file listings report it (scheme included), so log keys match."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return str(fs.makeQualified(hpath).toString())
    except Exception:  # no JVM gateway in this session type: keep the path as given
        return path


@dataclass
class JobResult:
    output_location: str
    record_count: int
    summary: dict
    inexact_lines: int = 0
    top_domains: list = field(default_factory=list)
    top_keywords: list = field(default_factory=list)


def _event(spark: SparkSession, *, file_key: str, run_ts: dt.datetime, status: str,
           engine: str, record_count: int | None = None, output_location: str | None = None,
           error_message: str | None = None) -> DataFrame:
    """One status event for this run (a one-row frame)."""
    schema = ("file_key string, file_ts timestamp_ntz, file_status string, event_type string, "
              "record_count long, output_location string, error_message string")
    row = [(file_key, run_ts, status, engine, record_count, output_location, error_message)]
    df = spark.createDataFrame(row, schema).withColumns({
        "file_date": file_date_from_key("file_key", run_ts.date().isoformat()),
        "file_size": F.lit(None).cast("long"),
        "file_size_gb": F.lit(None).cast("double"),
    })
    return status_events(df)


def run_report_job(spark: SparkSession, input_path: str, output_root: str, log_path: str, *,
                   run_ts: dt.datetime, source_name: str | None = None, site: str = DEFAULT_SITE,
                   attribution: str = "last", strict: bool = True,
                   case_sensitive: bool = False, engine: str = EVENT_SPARK) -> JobResult:
    """Report for one input; sessions are scoped per file (``source_file``, ``ip``).

    ``run_ts`` is a naive UTC datetime (it is logged zone-less as ISO ``...Z``).
    """
    run_date = run_ts.date().isoformat()
    # Partition values with characters like '=' or ':' are escaped in directory
    # names; keeping the name path-safe makes the reported location exact.
    name = re.sub(r"[^A-Za-z0-9._-]", "_", source_name or input_path.rstrip("/").split("/")[-1])
    checkpoint_root(spark)
    file_key = qualified_path(spark, input_path)
    try:
        hits = enrich_hits(quiet_hits(read_hits(spark, input_path)), site=site, case_sensitive=case_sensitive)
        counted = keyword_revenue_counted(hits, attribution=attribution, strict=strict).checkpoint(eager=True)
        counts = counted.agg(F.sum("n_hits").alias("hits"), F.sum("n_inexact").alias("inexact")).first()
        report, records = credited_rows(counted), counts.hits or 0
        location = write_partitioned_report(report, output_root, run_date, name, source_path=file_key)
        summary = report_summary(report).first().asDict()
        tops_d = [tuple(r) for r in top_domains(report).collect()]
        tops_k = [tuple(r) for r in top_keywords(report).collect()]
        append_file_events(_event(spark, file_key=file_key, run_ts=run_ts, status=STATUS_COMPLETE,
                                  engine=engine, record_count=records, output_location=location),
                           log_path)
        return JobResult(location, records, summary, counts.inexact or 0, tops_d, tops_k)
    except Exception as exc:
        append_file_events(_event(spark, file_key=file_key, run_ts=run_ts, status=STATUS_FAILED,
                                  engine=engine, error_message=error_text(exc)), log_path)
        raise


def report_files(spark: SparkSession, files: DataFrame, output_root: str, *, run_ts: dt.datetime,
                 site: str = DEFAULT_SITE, attribution: str = "last", strict: bool = True,
                 case_sensitive: bool = False, order_by: tuple[str, ...] = ("hit_time_gmt",),
                 dated_by: str = "run", engine: str = EVENT_SPARK) -> DataFrame:
    """Reports of many files in one job; returns their COMPLETE events.

    ``files`` is a listing (``path``, ``file_size``, optional ``modified_ts``); its paths go to the
    reader, so the driver holds them as it holds any listing. Each file is one closed world, has its
    own place under ``output_root`` (by run date, or with ``dated_by="file"`` by the date in its
    path) and an event with its number of hits. Files without credit or without a byte get a
    header-only report and an event too.
    """
    checkpoint_root(spark)
    run_date = run_ts.date().isoformat()
    files = files.withColumn("source_file", F.col("path"))
    date = file_date_from_key("source_file", run_date) if dated_by == "file" else F.lit(run_date)
    paths = [literal_path(r.path) for r in files.where("file_size > 0").select("path").collect()]
    places = with_places(files, date)
    counts = None
    if paths:
        hits = enrich_hits(quiet_hits(read_hits(spark, paths)), site=site, case_sensitive=case_sensitive)
        counted = keyword_revenue_counted(hits, attribution=attribution, strict=strict, order_by=order_by,
                                          report_by=("source_file",))
        # Paths are decoded here, where there is one row per file and keyword, not one per hit.
        counted = counted.withColumn("source_file", plain_path(F.col("source_file"))).checkpoint(eager=True)
        reports = with_places(credited_rows(counted), date)
        counts = counted.groupBy("source_file").agg(F.sum("n_hits").alias("record_count"))
    else:
        reports = places.select(*places.columns, *[F.lit(None).cast(t).alias(c) for c, t in (
            ("domain", "string"), ("keyword", "string"), ("revenue", "decimal(38,10)"))]).where(F.lit(False))
    write_file_reports(reports, places, output_root)
    done = places.join(counts, "source_file", "left") if counts is not None else places.withColumn(
        "record_count", F.lit(None).cast("long"))
    own = ["file_size", *[c for c in ("modified_ts",) if c in files.columns]]
    events = done.select(
        F.col("source_file").alias("file_key"), *own, F.lit(STATUS_COMPLETE).alias("file_status"),
        F.lit(engine).alias("event_type"), F.coalesce("record_count", F.lit(0)).alias("record_count"),
        place_path(output_root).alias("output_location"), _run_time(run_ts).alias("file_ts"))
    return status_events(file_manifest(events, run_date, key_col="file_key", decode="none"))


def _run_time(run_ts: dt.datetime):
    return F.expr(f"TIMESTAMP_NTZ '{run_ts.isoformat(sep=' ')}'")


def pending_files(spark: SparkSession, log_path: str) -> DataFrame:
    """Listing of the files whose latest status is RECEIVED."""
    log = read_file_events(spark, log_path)
    latest = latest_file_status(log, keys=("file_key",), carry=("file_status", "file_size", "modified_ts"))
    return latest.where(F.col("file_status") == STATUS_RECEIVED).select(
        F.col("file_key").alias("path"), "file_size", "modified_ts")


def run_pending(spark: SparkSession, output_root: str, log_path: str, *, run_ts: dt.datetime,
                batch_id: str | None = None, **options) -> DataFrame:
    """Report every received file that has no outcome yet, in one job, and log the events.

    If the job fails, each of its files gets a FAILED event with the message, and the error is raised.
    """
    checkpoint_root(spark)
    files = pending_files(spark, log_path).checkpoint(eager=True)
    try:
        events = report_files(spark, files, output_root, run_ts=run_ts, **options).checkpoint(eager=True)
        append_file_events(events, log_path, batch_id)
        return events
    except Exception as exc:
        append_file_events(failed_events(files, run_ts, error_text(exc)), log_path)
        raise


def error_text(exc: Exception) -> str:
    """The error's message without the frames of a Java stack."""
    lines = [line for line in str(exc).splitlines() if line.strip() and not line.lstrip().startswith(("at ", "... "))]
    return "\n".join(lines)


def failed_events(files: DataFrame, run_ts: dt.datetime, message: str, engine: str = EVENT_SPARK) -> DataFrame:
    """A FAILED event for each listed file."""
    own = ["file_size", *[c for c in ("modified_ts",) if c in files.columns]]
    rows = files.select(F.col("path").alias("file_key"), *own, _run_time(run_ts).alias("file_ts"),
                        F.lit(STATUS_FAILED).alias("file_status"), F.lit(engine).alias("event_type"),
                        F.lit(message).alias("error_message"))
    return status_events(file_manifest(rows, run_ts.date().isoformat(), key_col="file_key", decode="none"))


def route_new_files(spark: SparkSession, landing_root: str, log_path: str, *,
                    run_ts: dt.datetime, path_glob: str | None = None) -> DataFrame:
    """Log a RECEIVED event for every file under ``landing_root`` that the log doesn't hold yet;
    return their manifest.

    A file is known by path, modification time and size, so listing a folder again adds nothing and
    a file delivered anew is received again. The manifest carries ``size_class`` (``small`` < 2 GiB
    <= ``large``), the label the original used to pick a processing engine.
    """
    checkpoint_root(spark)
    listing = new_files(read_file_listing(spark, landing_root, path_glob), read_file_events(spark, log_path))
    arrived = listing.withColumns({"file_ts": _run_time(run_ts), "file_status": F.lit(STATUS_RECEIVED)})
    # Cut, so that what is returned is what was logged.
    manifest = file_manifest(arrived, run_ts.date().isoformat(), key_col="path", decode="none").checkpoint(eager=True)
    append_file_events(status_events(manifest), log_path)
    return manifest
