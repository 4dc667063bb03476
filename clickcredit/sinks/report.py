"""Report sinks: formatted text, an ordered TSV, and one report per file in a partitioned tree."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.money import as_text, over_of
from ..schema import REPORT_HEADER
from ..session import checkpoint_root

# Partition columns of a report tree, outermost first.
PLACE = ("year", "month", "date", "source_id")
# Files that one task writes: opening a small file costs more than filling it.
FILES_PER_TASK = 100
# Of many reports, those with more rows may be divided among tasks.
LARGE_REPORT = 100_000
# Tasks that list the folders of a tree, where the session doesn't say.
LISTING_TASKS = 64


def revenue_text(revenue: Column, over: Column | None = None) -> Column:
    """Two decimals, half-even, as text (``480.00``); exact on decimal input."""
    return as_text(revenue, F.lit(0).cast("decimal(38,0)") if over is None else over)


def _text_columns(report: DataFrame) -> list[Column]:
    names = (F.col("domain"), F.col("keyword"), revenue_text(F.col("revenue"), over_of(report)))
    return [c.alias(n) for c, n in zip(names, REPORT_HEADER, strict=True)]


def report_text(report_exact: DataFrame) -> DataFrame:
    """The report as the file shows it: header names and 2-decimal revenue text."""
    return report_exact.select(*_text_columns(report_exact))


def source_id(path: Column) -> Column:
    """Partition value of an input: names repeat across folders, whole paths don't."""
    return F.sha2(path, 256)


def with_places(files: DataFrame, date: Column, source: str = "source_file") -> DataFrame:
    """Add the place (``PLACE``) of each input's report: a date as ``YYYY-MM-DD`` text, and the
    digest of the input's whole path."""
    part = lambda n: F.split_part(date, F.lit("-"), F.lit(n))
    return files.withColumns({"year": part(1), "month": part(2), "date": part(3), "source_id": source_id(F.col(source))})


def place_path(root: str) -> Column:
    """The folder of a row's place."""
    parts = [F.concat(F.lit(f"/{c}="), F.col(c)) for c in PLACE]
    return F.concat(F.lit(root.rstrip("/")), *parts)


def _order(report: DataFrame, where: Column | None = None) -> list[Column]:
    """Report order; ``where`` limits it to some rows, the others are all equal."""
    own = lambda c: c if where is None else F.when(where, c)
    return [own(over_of(report)).desc(), own(F.col("revenue")).desc(), own(F.col("domain")).asc(),
            own(F.col("keyword")).asc()]


_CSV = {"sep": "\t", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _csv(writer):
    return writer.options(**_CSV, lineSep="\n")


def write_report(report_exact: DataFrame, path: str, *, single_file: bool = False,
                 max_records_per_file: int = 0) -> None:
    """Write the report as tab-separated text with a header.

    Range partitions, each sorted, are written side by side as numbered files: their names in
    order give the report, and each has the header. A small report is one file, as adaptive
    execution merges small ranges; an empty one is a header-only file. ``single_file`` forces one
    file and with it one task.
    """
    out = report_text(report_exact.orderBy(*_order(report_exact)))
    if single_file:
        out = out.coalesce(1)
    writer = _csv(out.write.mode("overwrite").option("header", True))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.csv(path)


def write_partitioned_report(report_exact: DataFrame, root: str, run_date: str,
                             source_name: str, source_path: str | None = None) -> str:
    """Write one input's report under ``root/year=Y/month=M/date=D/[source_id=I/]source_name=S``
    and return that folder; only it is replaced.

    ``source_path``, the input's whole path, gives inputs of one name a place each. The folder
    itself is written, so an empty report leaves a header-only file and replaces an earlier report.
    """
    year, month, day = run_date.split("-")
    folder = f"{root.rstrip('/')}/year={year}/month={month}/date={day}"
    if source_path is not None:
        import hashlib

        folder += f"/source_id={hashlib.sha256(source_path.encode()).hexdigest()}"
    folder += f"/source_name={source_name}"
    write_report(report_exact, folder)
    return folder


def _dealt(rows: DataFrame, n_files: int, *ranges: Column | str) -> DataFrame:
    """Range partitions; of many files a fixed number, which adaptive execution doesn't merge."""
    tasks = -(-n_files // FILES_PER_TASK)
    if tasks <= 1:
        return rows.repartitionByRange(*ranges)
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(max(tasks, least), *ranges)


def _local_folder(spark: SparkSession, root: str) -> str | None:
    """The folder ``root`` of the local file system (or one mounted there); None if it is in another."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    where = files.makeQualified(path).toUri()
    return where.getPath() if where.getScheme() == "file" else None


def _staging(folder: str, header: str):
    """Writes the lines of each place to a folder of the task's attempt; a row for each place."""

    def stage(batches):
        import os

        from pyspark import TaskContext

        task = TaskContext.get()
        own = f"{folder}/{task.partitionId()}-{task.taskAttemptId()}"
        place, out, places = None, None, []
        for batch in batches:
            for at, line in zip(batch["place"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if at != place:
                    if out:
                        out.close()
                    place = at
                    places.append(at)
                    os.makedirs(f"{own}/{at}")
                    out = open(f"{own}/{at}/part-{task.partitionId():05d}-{os.path.basename(folder)[9:]}.c000.csv",
                               "w", encoding="utf-8", newline="")
                    out.write(header)
                out.write(line + "\n")
        if out:
            out.close()
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.string()),
                                          "staged": pa.array([own] * len(places), pa.string())})

    return stage


def _placing(folder: str):
    """Puts the staged files of each place where its last report was; may be repeated."""

    def put(batches):
        import os
        import shutil

        for batch in batches:
            for place, staged in zip(batch["place"].to_pylist(), batch["staged"].to_pylist(), strict=True):
                first, *rest = (f"{own}/{place}" for own in staged)
                for other in rest:
                    for name in os.listdir(other):
                        os.replace(f"{other}/{name}", f"{first}/{name}")
                if os.path.isdir(first):  # else a task before this one has put it
                    shutil.rmtree(f"{folder}/{place}", ignore_errors=True)
                    os.makedirs(os.path.dirname(f"{folder}/{place}"), exist_ok=True)
                    os.rename(first, f"{folder}/{place}")
            yield batch.select(["place"])

    return put


def _path_name(value: Column) -> Column:
    """A partition value as Spark names its folder."""
    odd = "[\\x01-\\x1f\"#%'*/:=?\\\\\\x7f{\\[\\]^]"
    parts = F.split(value, f"(?<={odd})|(?={odd})")
    escaped = F.array_join(F.transform(parts, lambda c: F.when(
        c.rlike(f"^{odd}$"), F.concat(F.lit("%"), F.lpad(F.hex(c), 2, "0"))).otherwise(c)), "")
    return (F.when(value == "", F.lit("__HIVE_DEFAULT_PARTITION__"))
            .when(value.rlike(odd), escaped).otherwise(value))


def _write_folders(rows: DataFrame, folder: str, by: Sequence[str], header: bool) -> None:
    """Write rows sorted by place to a folder each, as the CSV writer with dynamic overwrite does.

    For the local file system, where Hadoop (without its native library) starts ``chmod`` processes for each
    file and folder. Tasks write side by side to folders of their own; then each place is
    replaced at once.
    """
    spark, job = rows.sparkSession, uuid.uuid4().hex
    staging = f"{folder}/.staging-{job}"
    place = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), _path_name(F.col(c))) for c in by])
    lines = rows.select(place.alias("place"), F.to_csv(F.struct(*REPORT_HEADER), _CSV).alias("line"))
    head = "\t".join(REPORT_HEADER) + "\n" if header else ""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{folder}")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    child = lambda name: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, name)
    files.mkdirs(root)
    try:
        (lines.mapInArrow(_staging(staging, head), "place string, staged string")
         .write.parquet(f"file://{staging}/places"))
        staged = spark.read.schema("place string, staged string").parquet(f"file://{staging}/places")
        (staged.groupBy("place").agg(F.sort_array(F.collect_list("staged")).alias("staged"))
         .mapInArrow(_placing(folder), "place string").write.format("noop").mode("overwrite").save())
    finally:
        files.delete(child(f".staging-{job}"), True)
    files.create(child("_SUCCESS"), True).close()


def write_file_reports(reports: DataFrame, places: DataFrame, root: str, by: Sequence[str] = PLACE) -> None:
    """Write the reports of many inputs in one job, each to its own place under ``root``.

    ``reports`` holds domain, keyword and revenue with the place columns; ``places`` one row per
    expected place, also of inputs without credit: these get a header-only file. Only the places
    given are replaced (dynamic overwrite), so a repeated job writes the same tree. Rows are
    range-partitioned by place and report order: a place is not bound to one task, and the names of
    its files in order give its report. Many places are dealt by their number, however few their
    rows, as each costs a file; of these only large reports are divided.
    """
    by = list(by)
    # Partition columns that are never null, nor known constants, so that the writer takes the rows
    # as they are sorted; otherwise it sorts them once more, by those columns alone.
    reports, places = (df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by})
                       for df in (reports, places))
    checkpoint_root(reports.sparkSession)
    reports = reports.checkpoint(eager=True)
    filled = reports.groupBy(*by).agg(F.count("*").alias("n_rows")).checkpoint(eager=True)
    empty = places.select(*by).distinct().join(filled, by, "left_anti").checkpoint(eager=True)
    n_filled, n_empty = filled.count(), empty.count()
    if n_filled > FILES_PER_TASK:
        reports = reports.join(filled, by)
        ranges = _order(reports, F.col("n_rows") > LARGE_REPORT)
    else:
        ranges = _order(reports)
    rows = (_dealt(reports, n_filled, *by, *ranges).sortWithinPartitions(*by, *_order(reports))
            .select(*_text_columns(reports), *by))
    empty = (_dealt(empty, n_empty, *by).sortWithinPartitions(*by)
             .select(*[F.lit(n).alias(n) for n in REPORT_HEADER], *by))
    folder = _local_folder(reports.sparkSession, root)
    for part, header in ((rows, True), (empty, False)):  # of an empty place, the header is the row
        if folder is not None:
            _write_folders(part, folder, by, header)
            continue
        writer = part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
        _csv(writer.option("header", header)).csv(root)


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """List folders in ``LISTING_TASKS`` tasks, not up to 10,000 of one folder each."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(LISTING_TASKS))
    try:
        yield
    finally:
        spark.conf.unset(key)


def read_file_reports(spark: SparkSession, root: str, by: Sequence[str] = PLACE) -> DataFrame:
    """Rows of all reports under ``root`` as text, with their places; none for empty reports."""
    schema = ", ".join(f"`{n}` string" for n in (*REPORT_HEADER, *by))
    with _few_listing_tasks(spark):
        return spark.read.schema(schema).option("header", True).option("sep", "\t").csv(root)


def _places(folder: str, by: Sequence[str]):
    """The places under a folder, by its listing."""
    by = list(by)

    def find(batches):
        import os

        import pyarrow as pa

        def below(at, columns):
            if not columns:
                yield at
                return
            with os.scandir(f"{folder}/{at}") as found:
                names = [e.name for e in found if e.name.startswith(f"{columns[0]}=") and e.is_dir()]
            for name in names:
                yield from below(f"{at}/{name}" if at else name, columns[1:])

        places = []
        for _ in batches:
            for place in below("", by):
                places.append(place)
                if len(places) == 10_000:
                    yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.string())})
                    places = []
        yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.string())})

    return find


def _lines(folder: str, by: Sequence[str]):
    """The lines of the files of places, with the values of the place."""
    by = list(by)

    def read(batches):
        import os
        from urllib.parse import unquote

        import pyarrow as pa

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*rows) if rows else [()] * (1 + len(by)))],
                                              names=["value", *by])

        rows = []
        for places in batches:
            for place in places["place"].to_pylist():
                values = [v if (v := unquote(x.split("=", 1)[1])) != "__HIVE_DEFAULT_PARTITION__" else None
                          for x in place.split("/")]
                for name in sorted(os.listdir(f"{folder}/{place}")):
                    if name[0] in "._":
                        continue
                    with open(f"{folder}/{place}/{name}", encoding="utf-8") as lines:
                        for line in lines:
                            rows.append((line.removesuffix("\n"), *values))
                            if len(rows) == 10_000:
                                yield batch(rows)
                                rows = []
        yield batch(rows)

    return read


def read_report_lines(spark: SparkSession, root: str, by: Sequence[str] = PLACE) -> DataFrame:
    """The text lines of all files under ``root`` with their places, headers included."""
    schema = ", ".join(["value string", *(f"{c} string" for c in by)])
    folder = _local_folder(spark, root)
    if folder is not None:  # the driver would hold a listing of all files
        tasks = max(LISTING_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return (spark.range(0, 1, 1, 1).mapInArrow(_places(folder, by), "place string")
                .repartition(tasks, "place").mapInArrow(_lines(folder, by), schema))
    with _few_listing_tasks(spark):
        return spark.read.schema(schema).text(root)
