"""Write hits in the landing format (tab-separated, header, twelve columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import HIT_COLUMNS


def write_hits_tsv(hits: DataFrame, path: str, *, file_key: Column | None = None,
                   splits: int = 1, visitor: str = "ip") -> None:
    """Write hit files; ``file_key`` groups rows into files: a folder for each key.

    Sessions are scoped to a file, so a visitor's rows of a key must land in one file: rows are
    clustered by the key, and by the visitor's hash modulo ``splits``, before the partitioned write
    (one writer task and file for each). With ``splits`` a hot key is many files; reports per
    key are then the sums of its files' reports.
    """
    # Times as text: the CSV writer's format option does not reach zone-less timestamps.
    columns = [F.substring(F.col(c).cast("string"), 1, 19).alias(c) if c == "date_time" else F.col(c)
               for c in HIT_COLUMNS]
    out = hits.select(*columns, *([file_key.alias("file_key")] if file_key is not None else []))
    if file_key is not None:
        out = out.withColumn("split", F.pmod(F.xxhash64(visitor), F.lit(splits)).cast("int"))
        out = out.repartition("file_key", "split")
        out = out if splits > 1 else out.drop("split")
    writer = (out.write.mode("overwrite").option("sep", "\t").option("header", True)
              .option("lineSep", "\n")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if file_key is not None:
        writer = writer.partitionBy("file_key", *(["split"] if splits > 1 else []))
    writer.csv(path)


def by_day(ts: str = "date_time") -> Column:
    return F.date_format(F.col(ts), "yyyy-MM-dd")
