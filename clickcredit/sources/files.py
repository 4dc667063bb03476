"""File metadata sources: a real folder listing, and file records derived from ``orders``."""

from __future__ import annotations

import re
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

LISTING_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def plain_path(encoded: Column) -> Column:
    """``_metadata.file_path`` (percent-encoded) as listings show it."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A path for a reader, with the characters that it would take as a pattern escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _empty_files(spark: SparkSession, root: str, path_glob: str | None) -> list[tuple[str, int, int]]:
    """(path, 0, modified ms) of files without a byte, which Spark's readers leave out of
    listings. The driver walks the folder through Hadoop's file system, as readers do."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    found = []
    for top in fs.globStatus(path) or []:
        each = fs.listFiles(top.getPath(), True)
        while each.hasNext():
            status = each.next()
            name = status.getPath().getName()
            if status.getLen() == 0 and name[0] not in "._" and fnmatch(name, path_glob or "*"):
                found.append((status.getPath().toString(), 0, status.getModificationTime()))
    return found


def empty_file_listing(spark: SparkSession, root: str, path_glob: str | None = None) -> DataFrame:
    """The listing of empty files alone."""
    rows = spark.createDataFrame(_empty_files(spark, root, path_glob), "path string, file_size long, ms long")
    return rows.select("path", "file_size", F.timestamp_millis("ms").alias("modified_ts"))


def read_file_listing(spark: SparkSession, root: str, path_glob: str | None = None) -> DataFrame:
    """``(path, file_size, modified_ts)`` of every file under ``root``, empty ones included.

    ``binaryFile`` with only metadata columns selected never reads file
    contents (the content column is pruned from the scan). Recursive lookup
    keeps ``year=/month=/day=`` as path text instead of turning it into typed
    partition columns, which would lose zero padding.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return listing_columns(reader.load(root)).unionByName(empty_file_listing(spark, root, path_glob))


def listing_columns(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_ts"),
    )


def file_arrivals(spark: SparkSession, root: str, max_files_per_trigger: int = 1,
                  path_glob: str | None = None) -> DataFrame:
    """The listing as a stream: each file once, when it arrives. Contents are never read."""
    reader = (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA)
              .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files_per_trigger)
              .option("maxFileAge", "36500d"))  # late files with old times count too
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return listing_columns(reader.load(root))


def _order_date_parts():
    d = F.col("o_orderdate")
    return (F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string"))


def file_records_from_orders(orders: DataFrame) -> DataFrame:
    """One arriving file per order (the same rules are SQL in ``plans.oracle``).

    * ``raw_key`` = ``hits/year=Y/month=M/day=D/f<o_orderkey % 500>.csv``, month and
      day not padded; every 50th order (``% 50 = 7``) has no ``day=`` part and
      ``% 50 = 11`` has an encoded name ``f<n>+copy%201.csv``.
    * ``file_size`` = ``floor(o_totalprice * 16384)`` bytes (both size classes occur).
    * ``file_ts`` = ``o_orderdate``; ``event_seq`` = ``o_orderkey`` (tie-break).
    * ``file_status``: F -> COMPLETE, O -> RECEIVED, P -> FAILED.
    """
    y, m, d = _order_date_parts()
    n = (F.col("o_orderkey") % 500).cast("string")
    sel = F.col("o_orderkey") % 50
    name = F.when(sel == 11, F.concat(F.lit("f"), n, F.lit("+copy%201.csv"))).otherwise(
        F.concat(F.lit("f"), n, F.lit(".csv")))
    day_part = F.when(sel == 7, F.lit("")).otherwise(F.concat(F.lit("day="), d, F.lit("/")))
    raw_key = F.concat(F.lit("hits/year="), y, F.lit("/month="), m, F.lit("/"), day_part, name)
    status = (F.when(F.col("o_orderstatus") == "F", "COMPLETE")
              .when(F.col("o_orderstatus") == "O", "RECEIVED")
              .when(F.col("o_orderstatus") == "P", "FAILED")
              .otherwise("ERROR"))
    return orders.select(
        F.col("o_orderkey").alias("event_seq"),
        raw_key.alias("raw_key"),
        F.floor(F.col("o_totalprice") * 16384).cast("long").alias("file_size"),
        F.col("o_orderdate").alias("file_ts"),  # zone-less, as stored
        status.alias("file_status"),
    )


def load_file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_records_from_orders(read_table(spark, sf_dir, "orders"))
