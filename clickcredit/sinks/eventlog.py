"""Processing-status log: checked, idempotent appends and compaction that loses nothing.

Layout under the log's folder::

    batches/batch_id=B/outcome=accepted|rejected/file_month=YYYY-MM/   rows of one append
    committed/batch_id=B/                                             written after B's rows
    generations/gen=G/outcome=.../file_month=.../                     rows of many batches, folded
    published/gen=G/                                                  batches that G holds

An append is a folder of its own, so appends never share a folder and a replayed one, known by its
batch id, is not written again once it is committed (and overwrites its own rows if it is not). Readers take the newest published
generation and the committed batches that it does not hold. A compaction writes a new generation
from exactly the batches it saw and publishes it by one small file afterwards: an append in the
meantime stays a batch of its own, and a compaction that dies leaves nothing that readers see.

"Current status" is a query over the log (``operators.status.latest_file_status``), not an
in-place update. Folders that a published generation has replaced are not read any more and are
left to the storage's clean-up rules.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.status import validate_status_events
from ..schema import STATUS_EVENT_SCHEMA
from ..session import path_exists

LOG_COLUMNS = [f.name for f in STATUS_EVENT_SCHEMA.fields] + ["file_ts", "event_seq", "modified_ts"]
ACCEPTED, REJECTED = "accepted", "rejected"


@dataclass
class Appended:
    """What an append did; counts are None where the batch had been committed before."""

    batch_id: str
    accepted: int | None = None
    rejected: int | None = None


def to_log_rows(events: DataFrame) -> DataFrame:
    """Project any status-event frame onto the log schema (missing columns are null)."""
    cols = set(events.columns)
    out = []
    for field in STATUS_EVENT_SCHEMA.fields:
        c = F.col(field.name) if field.name in cols else F.lit(None)
        out.append(c.cast(field.dataType).alias(field.name))
    # Event times are kept zone-less (as written in the ISO text, which is UTC).
    ts = (F.col("file_ts") if "file_ts" in cols
          else F.try_to_timestamp(F.regexp_replace("file_datetime", "Z$", "")).cast("timestamp_ntz"))
    seq = F.col("event_seq") if "event_seq" in cols else F.lit(None)
    modified = F.col("modified_ts") if "modified_ts" in cols else F.lit(None)
    out += [ts.cast("timestamp_ntz").alias("file_ts"), seq.cast("long").alias("event_seq"),
            modified.cast("timestamp").alias("modified_ts")]
    return events.select(*out)


def _committed(spark: SparkSession, log: str) -> set[str]:
    if not path_exists(spark, f"{log}/committed"):
        return set()
    found = spark.read.schema("batch_id string").parquet(f"{log}/committed")
    return {r.batch_id for r in found.distinct().collect()}


def _published(spark: SparkSession, log: str) -> tuple[str | None, set[str]]:
    """The newest published generation and the ids of the batches it holds."""
    if not path_exists(spark, f"{log}/published"):
        return None, set()
    found = spark.read.schema("seq long, folded string, gen string").parquet(f"{log}/published")
    newest = found.agg(F.max(F.struct("seq", "gen"))["gen"].alias("gen")).first().gen
    held = found.where(F.col("gen") == newest).where("folded IS NOT NULL").select("folded").collect()
    return newest, {r.folded for r in held}


def append_file_events(events: DataFrame, log_path: str, batch_id: str | None = None) -> Appended:
    """Check events and append them in one pass, accepted and rejected ones side by side.

    Events without a required field go to the log's rejected part with their reason. With a
    ``batch_id``, appending the same batch again changes nothing. Rows are range-partitioned on
    (outcome, month, key) before writing: a month lands in one or a few files, and one that holds
    a large share of the events is split over several tasks.
    """
    spark, log = events.sparkSession, log_path.rstrip("/")
    batch_id = batch_id or uuid.uuid4().hex
    if batch_id in _committed(spark, log):
        return Appended(batch_id)
    seen = Observation(f"status_events {batch_id}")
    rejected = F.col("reject_reason").isNotNull()
    rows = validate_status_events(to_log_rows(events)).withColumns({
        "outcome": F.when(rejected, REJECTED).otherwise(ACCEPTED),
        "file_month": F.substring("file_date", 1, 7)}).repartitionByRange("outcome", "file_month", "file_key")
    # Counted above the exchange: the sample that cuts the ranges runs what is below it once more.
    (rows.observe(seen, F.count(F.when(~rejected, 1)).alias(ACCEPTED), F.count(F.when(rejected, 1)).alias(REJECTED))
     .write.mode("overwrite").partitionBy("outcome", "file_month").parquet(f"{log}/batches/batch_id={batch_id}"))
    counts = seen.get  # nothing is observed where the plan is known to be empty
    spark.range(1, numPartitions=1).select(F.lit(batch_id).alias("id")).write.mode("overwrite").parquet(
        f"{log}/committed/batch_id={batch_id}")
    return Appended(batch_id, counts.get(ACCEPTED, 0), counts.get(REJECTED, 0))


def _read(spark: SparkSession, log_path: str, outcome: str) -> tuple[DataFrame, set[str], str | None]:
    """Rows of an outcome, the ids of the batches they come from, and the generation used."""
    log = log_path.rstrip("/")
    empty = to_log_rows(spark.createDataFrame([], STATUS_EVENT_SCHEMA)).withColumns(
        {"reject_reason": F.lit(None).cast("string"), "file_month": F.lit(None).cast("string")})
    schema = empty.drop("file_month").schema.add("outcome", "string").add("file_month", "string")
    # Ids first, the generation afterwards: one published in between holds more batches, never fewer.
    committed = _committed(spark, log)
    gen, folded = _published(spark, log)
    fresh = sorted(committed - folded)
    paths = [f"{log}/batches/batch_id={b}" for b in fresh] + ([f"{log}/generations/gen={gen}"] if gen else [])
    rows = [spark.read.option("basePath", p).schema(schema).parquet(p) for p in paths[-1:] if gen]
    if fresh:
        read = spark.read.option("basePath", f"{log}/batches").schema(schema)
        rows.append(read.parquet(*paths[:len(fresh)]).drop("batch_id"))
    out = empty
    for part in rows:
        out = out.unionByName(part.where(F.col("outcome") == outcome).drop("outcome"))
    return out, committed | folded, gen


def read_file_events(spark: SparkSession, log_path: str) -> DataFrame:
    """The log's accepted events with their declared schema (``file_month`` stays text); none
    for a log that does not exist yet."""
    return _read(spark, log_path, ACCEPTED)[0].drop("reject_reason")


def read_rejected_events(spark: SparkSession, log_path: str) -> DataFrame:
    """Events that lacked a required field, with ``reject_reason``."""
    return _read(spark, log_path, REJECTED)[0]


def compact_file_events(spark: SparkSession, log_path: str) -> str:
    """Fold all committed batches into a new generation and publish it; returns its name.

    Appends go on meanwhile. Files are as large as range partitioning makes them, so a large
    month is many files.
    """
    log = log_path.rstrip("/")
    newest, _ = _published(spark, log)
    seq = int(newest.split("-")[0]) + 1 if newest else 0
    gen = f"{seq:08d}-{uuid.uuid4().hex[:12]}"
    # One snapshot for both outcomes: ids are read before the rows.
    accepted, held, _ = _read(spark, log, ACCEPTED)
    rejected, held_too, _ = _read(spark, log, REJECTED)
    if held != held_too:  # an append was committed in between; start over with it
        return compact_file_events(spark, log_path)
    rows = accepted.withColumn("outcome", F.lit(ACCEPTED)).unionByName(rejected.withColumn("outcome", F.lit(REJECTED)))
    (rows.repartitionByRange("outcome", "file_month", "file_key").write.mode("overwrite")
     .partitionBy("outcome", "file_month").parquet(f"{log}/generations/gen={gen}"))
    folded = spark.createDataFrame([(seq, b) for b in sorted(held)] or [(seq, None)], "seq long, folded string")
    folded.coalesce(1).write.mode("overwrite").parquet(f"{log}/published/gen={gen}")
    return gen


def write_latest_status(spark: SparkSession, log_path: str, snapshot_path: str,
                        keys: tuple[str, ...] = ("file_date", "file_key")) -> None:
    """Materialize the current status per file (the keyed view of the log)."""
    from ..operators.status import latest_file_status
    (latest_file_status(read_file_events(spark, log_path), keys=keys)
     .write.mode("overwrite").parquet(snapshot_path))
