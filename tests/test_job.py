"""Batch job and router end to end on the sample files."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from conftest import write_sample

from clickcredit.operators.status import latest_file_status
from clickcredit.plans.job import route_new_files, run_report_job
from clickcredit.sinks.eventlog import read_file_events

RUN = dt.datetime(2026, 3, 6, 12, 0, 0)


def test_report_job_writes_report_summary_and_log(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing", "year=2026", "month=3", "day=5")
    os.makedirs(landing)
    src = write_sample(landing, "original")
    out, log = os.path.join(tmp_dir, "tgt"), os.path.join(tmp_dir, "log")
    res = run_report_job(spark, src, out, log, run_ts=RUN, case_sensitive=True)
    assert res.record_count == 12
    assert res.summary == {"total_records": 3, "total_revenue": 730.0, "unique_domains": 2,
                           "unique_keywords": 3}
    assert res.top_domains == [("google.com", 480.0), ("bing.com", 250.0)]
    parts = glob.glob(os.path.join(res.output_location, "part-*.csv"))
    assert len(parts) == 1 and os.path.isdir(res.output_location)
    assert open(parts[0]).read().splitlines() == [
        "Search Engine Domain\tSearch Keyword\tRevenue", "google.com\tIpod\t290.00",
        "bing.com\tZune\t250.00", "google.com\tipod\t190.00"]
    events = read_file_events(spark, log).collect()
    assert [(e.file_status, e.record_count, e.file_date, e.event_type) for e in events] == [
        ("COMPLETE", 12, "2026-03-05", "SPARK")]


def test_report_job_logs_failure(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    with pytest.raises(Exception):
        run_report_job(spark, os.path.join(tmp_dir, "missing.tsv"), os.path.join(tmp_dir, "tgt"),
                       log, run_ts=RUN)
    ev = read_file_events(spark, log).collect()
    assert len(ev) == 1 and ev[0].file_status == "FAILED" and ev[0].error_message


def test_router_then_job_latest_status(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing", "year=2026", "month=3", "day=6")
    os.makedirs(landing)
    src = write_sample(landing, "test")
    log = os.path.join(tmp_dir, "log")
    manifest = route_new_files(spark, os.path.join(tmp_dir, "landing"), log, run_ts=RUN)
    row = manifest.first()
    assert (row.file_name, row.file_date, row.size_class) == ("hits_test.tsv", "2026-03-06", "small")
    run_report_job(spark, src, os.path.join(tmp_dir, "tgt"), log, run_ts=RUN + dt.timedelta(minutes=5))
    latest = latest_file_status(read_file_events(spark, log)).collect()
    assert [(r.file_key.endswith("hits_test.tsv"), r.file_status, r.n_events) for r in latest] == [
        (True, "COMPLETE", 2)]


def test_report_job_on_a_folder_keeps_sessions_per_file(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing", "year=2026", "month=3", "day=5")
    os.makedirs(landing)
    write_sample(landing, "original")
    write_sample(landing, "test")
    res = run_report_job(spark, landing, os.path.join(tmp_dir, "tgt"), os.path.join(tmp_dir, "log"),
                         run_ts=RUN, case_sensitive=True)
    assert res.record_count == 24
    assert res.output_location.endswith("source_name=day_5")
    assert os.path.isdir(res.output_location)
    # per file: original gives Ipod 290 / Zune 250 / ipod 190, test gives Ipod 500 / ipod 75 / Zune 50
    assert res.top_keywords == [("Ipod", 790.0), ("Zune", 300.0), ("ipod", 265.0)]


def test_input_without_credit_gives_a_header_only_report(spark, tmp_dir):
    import glob

    from clickcredit.schema import HIT_COLUMNS
    lines = {
        "nothing": [],
        "buyer_without_touch": ["1\t2009-09-27 06:34:40\tua\t1.1.1.1\t1\tc\tr\tUS\tp\thttp://s/\tE;I;1;10;\t"],
    }
    out, log = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "log")
    for rows in lines.values():
        path = os.path.join(tmp_dir, "hits.tsv")
        with open(path, "w") as f:
            f.write("\n".join(["\t".join(HIT_COLUMNS), *rows]) + "\n")
        res = run_report_job(spark, path, out, log, run_ts=dt.datetime(2026, 3, 6))
        assert res.record_count == len(rows)
        (part,) = glob.glob(os.path.join(res.output_location, "part-*.csv"))
        with open(part) as f:
            assert len(f.read().splitlines()) == 1


def test_inputs_of_one_name_do_not_overwrite_each_other(spark, tmp_dir):
    out, log = os.path.join(tmp_dir, "tgt"), os.path.join(tmp_dir, "log")
    places = {}
    for day, variant in (("5", "original"), ("6", "test")):
        folder = os.path.join(tmp_dir, "landing", "year=2026", "month=3", f"day={day}")
        os.makedirs(folder)
        places[day] = run_report_job(spark, write_sample(folder, variant, "hits.tsv"), out, log,
                                     run_ts=RUN).output_location
    assert places["5"] != places["6"]
    text = {d: open(glob.glob(os.path.join(p, "part-*.csv"))[0]).read().splitlines()[1] for d, p in places.items()}
    assert text == {"5": "google.com\tipod\t480.00", "6": "google.com\tipod\t575.00"}


def test_routing_again_adds_nothing_and_keeps_the_outcome(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing", "year=2026", "month=3", "day=5")
    os.makedirs(landing)
    src, log = write_sample(landing, "original"), os.path.join(tmp_dir, "log")
    open(os.path.join(landing, "empty.tsv"), "w").close()
    root = os.path.join(tmp_dir, "landing")
    assert route_new_files(spark, root, log, run_ts=RUN).count() == 2
    run_report_job(spark, src, os.path.join(tmp_dir, "tgt"), log, run_ts=RUN + dt.timedelta(minutes=1))
    assert route_new_files(spark, root, log, run_ts=RUN + dt.timedelta(minutes=2)).count() == 0
    status = lambda: {r.file_key.split("/")[-1]: (r.file_status, r.n_events) for r in latest_file_status(
        read_file_events(spark, log)).collect()}
    assert status() == {"hits_original.tsv": ("COMPLETE", 2), "empty.tsv": ("RECEIVED", 1)}
    # Delivered anew with other content, the file is new again; so is a later one.
    write_sample(landing, "quantity", "hits_original.tsv")
    with open(src, "a") as f:
        f.write("\n")
    write_sample(landing, "test")
    again = route_new_files(spark, root, log, run_ts=RUN + dt.timedelta(minutes=3))
    assert sorted(r.file_name for r in again.collect()) == ["hits_original.tsv", "hits_test.tsv"]
    assert status()["hits_original.tsv"] == ("RECEIVED", 3)


def test_pending_files_are_reported_in_one_job(spark, tmp_dir):
    from clickcredit.plans.job import run_pending
    from clickcredit.sinks.report import read_file_reports
    for day, variant in (("5", "original"), ("6", "test")):
        folder = os.path.join(tmp_dir, "landing", "year=2026", "month=3", f"day={day}")
        os.makedirs(folder)
        write_sample(folder, variant, "hits.tsv")
    open(os.path.join(folder, "empty.tsv"), "w").close()
    log, out = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "out")
    route_new_files(spark, os.path.join(tmp_dir, "landing"), log, run_ts=RUN)
    done = run_pending(spark, out, log, run_ts=RUN + dt.timedelta(minutes=1), dated_by="file")
    assert sorted((r.file_date, r.record_count) for r in done.collect()) == [
        ("2026-03-05", 12), ("2026-03-06", 0), ("2026-03-06", 12)]
    rows = read_file_reports(spark, out).collect()
    assert sorted((r.date, r["Search Keyword"], r.Revenue) for r in rows) == [
        ("05", "ipod", "480.00"), ("05", "zune", "250.00"), ("06", "ipod", "575.00"), ("06", "zune", "50.00")]
    assert len(glob.glob(os.path.join(out, "year=2026", "month=03", "date=*", "source_id=*"))) == 3
    # Nothing is pending any more; a job of nothing is fine.
    assert run_pending(spark, out, log, run_ts=RUN + dt.timedelta(minutes=2)).count() == 0
    # A file that can't be read: its event says so, and the error is raised.
    with open(os.path.join(folder, "bad.tsv"), "w") as f:
        f.write("no\theader\n1\t2\n")
    route_new_files(spark, os.path.join(tmp_dir, "landing"), log, run_ts=RUN)
    with pytest.raises(Exception):
        run_pending(spark, out, log, run_ts=RUN + dt.timedelta(minutes=3))
    failed = read_file_events(spark, log).where("file_status = 'FAILED'").collect()
    assert [r.file_key.split("/")[-1] for r in failed] == ["bad.tsv"] and failed[0].error_message


def test_many_reports_in_parallel_ranges(spark, tmp_dir):
    """A place whose rows lie in several tasks: its files in the order of their names are the report."""
    from pyspark.sql import functions as F

    from clickcredit.sinks.report import with_places, write_file_reports
    reports = spark.range(4000).select(
        F.when(F.col("id") % 10 < 8, "a").otherwise("b").alias("source_file"), F.lit("d").alias("domain"),
        F.concat(F.lit("k"), "id").alias("keyword"),
        (F.hash("id") % 1000 + 1000).cast("decimal(38,10)").alias("revenue"))
    files = spark.createDataFrame([("a",), ("b",), ("none",)], "source_file string")
    out = os.path.join(tmp_dir, "out")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that small ranges stay apart
    try:
        for _ in range(2):  # a repeated job writes the same tree
            write_file_reports(with_places(reports, F.lit("2026-03-06")), with_places(files, F.lit("2026-03-06")), out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    sizes = {}
    for place in glob.glob(os.path.join(out, "year=2026", "month=03", "date=06", "source_id=*")):
        parts = sorted(glob.glob(os.path.join(place, "part-*.csv")))
        bodies = []
        for part in parts:
            head, *body = open(part).read().splitlines()
            assert head == "Search Engine Domain\tSearch Keyword\tRevenue"
            bodies += body
        key = [(-float(line.split("\t")[2]), line.split("\t")[1]) for line in bodies]
        assert key == sorted(key)
        sizes[len(bodies)] = len(parts)
    assert sorted(sizes) == [0, 800, 3200] and sizes[3200] > 2 and sizes[0] == 1


def test_many_small_reports_are_dealt_by_their_number(spark, tmp_dir, monkeypatch):
    """Many places are written by several tasks, however few their rows; a small report stays one
    file, and a large one among them is divided."""
    from pyspark.sql import functions as F

    from clickcredit.sinks import report as sink
    monkeypatch.setattr(sink, "FILES_PER_TASK", 10, raising=False)
    monkeypatch.setattr(sink, "LARGE_REPORT", 500, raising=False)
    reports = spark.range(1100).select(
        F.when(F.col("id") < 200, F.concat(F.lit("f"), (F.col("id") % 40).cast("string"))).otherwise("large")
        .alias("source_file"), F.lit("d").alias("domain"), F.concat(F.lit("k"), F.format_string("%04d", "id")).alias("keyword"),
        F.lit(5).cast("decimal(38,10)").alias("revenue"))
    files = spark.range(80).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("source_file"))
    day, out = F.lit("2026-03-06"), os.path.join(tmp_dir, "out")
    sink.write_file_reports(sink.with_places(reports, day), sink.with_places(files, day), out)
    tasks, sizes, large = {0: set(), 5: set()}, [], []
    for place in glob.glob(os.path.join(out, "year=2026", "month=03", "date=06", "source_id=*")):
        parts = sorted(glob.glob(os.path.join(place, "part-*.csv")))
        bodies = [open(part).read().splitlines() for part in parts]
        assert all(body[0] == "Search Engine Domain\tSearch Keyword\tRevenue" for body in bodies)
        lines = [line for body in bodies for line in body[1:]]
        assert lines == sorted(lines)
        if len(lines) in tasks:
            assert len(parts) == 1
            tasks[len(lines)].add(os.path.basename(parts[0]).split("-")[1])
            sizes.append(len(lines))
        else:
            large += [len(lines), len(parts)]
    assert sizes.count(0) == 40 and sizes.count(5) == 40 and large[0] == 900 and large[1] > 1
    assert len(tasks[0]) >= 4 and len(tasks[5]) >= 2
    rows = sink.read_report_lines(spark, out)
    assert rows.where("value NOT LIKE 'Search Engine Domain%'").count() == 1100


def test_job_scans_its_input_once(spark, tmp_dir):
    """The report and the record count come from one plan with one scan."""
    from clickcredit.operators.attribution import keyword_revenue_counted, quiet_hits
    from clickcredit.operators.enrich import enrich_hits
    from clickcredit.sources.hits import read_hits
    counted = keyword_revenue_counted(enrich_hits(quiet_hits(read_hits(spark, write_sample(tmp_dir, "original")))))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Join" not in plan
    assert sum(r.n_hits for r in counted.collect()) == 12
    source = open(os.path.join(os.path.dirname(__file__), "..", "clickcredit", "plans", "job.py")).read()
    assert "hits.count()" not in source


def tree(root):
    """Folder -> the texts of its files in the order of their names; the names of all other files."""
    places, others = {}, []
    for at, _, names in os.walk(root):
        parts = sorted(n for n in names if n.startswith("part-"))
        others += [n for n in names if n not in parts]
        if parts:
            places[os.path.relpath(at, root)] = [open(os.path.join(at, n), newline="").read() for n in parts]
    return places, others


def odd_reports(spark):
    odd = ["plain", "", None, "ta\tb", 'quo"te', "new\nline", "re\rturn", "back\\slash", " spaces ", "#hash", "é日", "a,b", "'", '"', "\\"]
    rows = [(f"f{k % 7}", w, v, k) for k, (w, v) in enumerate((w, v) for w in odd for v in odd)]
    reports = spark.createDataFrame(rows, "source_file string, domain string, keyword string, n int").selectExpr(
        "source_file", "domain", "keyword", "CAST(n + 0.005 AS decimal(38,10)) AS revenue")
    return reports, spark.createDataFrame([(f"f{k}",) for k in range(12)], "source_file string")


def test_local_reports_equal_those_of_the_csv_writer(spark, tmp_dir, monkeypatch):
    """Same folders, lines and header-only files, with values to escape; places not given stay, those
    given are replaced; no checksum file (made by a process each) and nothing staged is left."""
    from pyspark.sql import functions as F

    from clickcredit.sinks import report as sink
    reports, files = odd_reports(spark)
    by = ["day", "odd"]
    name = F.concat(F.lit("a:b/c=d%e f^g[h]{i}\\"), F.col("source_file"), F.lit("é'\"#*?\x01\x7f"))
    placed = lambda df: df.withColumns({
        "odd": F.when(F.col("source_file") != "f3", name).when(F.lit(False), ""), "day": F.lit("2026-03-06")})
    trees, lines = [], []
    for own in (True, False):
        if not own:
            monkeypatch.setattr(sink, "_local_folder", lambda *a: None)
        out = os.path.join(tmp_dir, f"out{own}")
        sink.write_file_reports(placed(reports), placed(files), out, by)
        before = tree(out)
        again = F.col("source_file").isin("f1", "f2", "f9")
        sink.write_file_reports(placed(reports.where(again).where("keyword = 'plain'")), placed(files.where(again)), out, by)
        trees.append((before, tree(out)))
        lines.append(sorted(map(str, sink.read_report_lines(spark, os.path.join(tmp_dir, "outTrue"), by).collect())))
    assert lines[0] == lines[1] and len(lines[0]) > 100 and "day='2026-03-06', odd=None" in str(lines[0])
    (first, second), (first_csv, second_csv) = trees
    assert first[0] == first_csv[0] and second[0] == second_csv[0] and first[0] != second[0]
    assert len(first[0]) == 12 and any("__HIVE_DEFAULT_PARTITION__" in at for at in first[0])
    assert {*first[1], *second[1]} == {"_SUCCESS", "._SUCCESS.crc"}


def test_a_place_is_put_once(tmp_dir):
    """Repeated after it was put, or broken off between two tasks' files, a place keeps all its files."""
    import pyarrow as pa

    from clickcredit.sinks import report as sink
    out, place = os.path.join(tmp_dir, "out"), "year=2026/source_id=x"
    for own, name in (("s/0-1", "part-0"), ("s/1-2", "part-1"), ("s/2-3", "part-2")):
        os.makedirs(os.path.join(tmp_dir, own, place))
        open(os.path.join(tmp_dir, own, place, name), "w").write(name)
    os.makedirs(os.path.join(out, place))
    open(os.path.join(out, place, "part-old"), "w").close()
    os.replace(os.path.join(tmp_dir, "s/1-2", place, "part-1"), os.path.join(tmp_dir, "s/0-1", place, "part-1"))
    batch = pa.RecordBatch.from_pydict({"place": [place], "staged": [[os.path.join(tmp_dir, s) for s in ("s/0-1", "s/1-2", "s/2-3")]]})
    for _ in range(2):
        assert [b.to_pydict() for b in sink._placing(out)(iter([batch]))] == [{"place": [place]}]
        assert sorted(os.listdir(os.path.join(out, place))) == ["part-0", "part-1", "part-2"]
