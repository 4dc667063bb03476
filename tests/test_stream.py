"""The file stream gives, per file, the same report as the batch job."""

from __future__ import annotations

import os

from conftest import write_sample

from clickcredit.sinks.eventlog import read_file_events
from clickcredit.sources.hits import read_hits
from clickcredit.streaming.file_stream import (per_file_report, read_stream_output,
                                               start_report_stream)


def _rows(df):
    return sorted((r.source_name, r.domain, r.keyword, float(r.revenue)) for r in df.collect())


def test_stream_equals_batch_per_file(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    for v in ("original", "quantity", "test"):
        write_sample(landing, v)
    out = os.path.join(tmp_dir, "out")
    ckpt = os.path.join(tmp_dir, "ckpt")
    log = os.path.join(tmp_dir, "log")
    q = start_report_stream(spark, landing, out, checkpoint_dir=ckpt, max_files_per_trigger=1,
                            log_path=log)
    q.awaitTermination()
    assert q.lastProgress is not None
    streamed = _rows(read_stream_output(spark, out, landing))
    batch = _rows(per_file_report(read_hits(spark, landing)))
    assert streamed == batch
    assert {s for s, *_ in streamed} == {"hits_original.tsv", "hits_quantity.tsv", "hits_test.tsv"}
    events = read_file_events(spark, log).collect()
    assert sorted((e.file_key.split("/")[-1], e.file_status, e.record_count) for e in events) == [
        ("hits_original.tsv", "COMPLETE", 12), ("hits_quantity.tsv", "COMPLETE", 12),
        ("hits_test.tsv", "COMPLETE", 12)]


def test_stream_restart_is_idempotent(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    write_sample(landing, "original")
    out = os.path.join(tmp_dir, "out")
    ckpt = os.path.join(tmp_dir, "ckpt")
    start_report_stream(spark, landing, out, checkpoint_dir=ckpt).awaitTermination()
    first = _rows(read_stream_output(spark, out, landing))
    # A new file arrives; the restarted stream handles only it and keeps earlier output.
    write_sample(landing, "test")
    start_report_stream(spark, landing, out, checkpoint_dir=ckpt).awaitTermination()
    second = _rows(read_stream_output(spark, out, landing))
    assert set(first) < set(second)
    assert len(second) == len(first) + 2


def test_landing_writer_makes_one_file_per_key(spark, tmp_dir):
    import glob

    from clickcredit.sinks.hits import by_day, write_hits_tsv
    from clickcredit.sources.hits import load_event_hits
    hits = load_event_hits(spark, "/root/testdata/sf0.001").repartition(12)
    out = os.path.join(tmp_dir, "landing")
    write_hits_tsv(hits, out, file_key=by_day())
    days = glob.glob(os.path.join(out, "file_key=*"))
    assert days and all(len(glob.glob(os.path.join(d, "*.csv"))) == 1 for d in days)
    assert read_hits(spark, out + "/*").count() == hits.count()


def test_stream_equals_batch_on_event_landing(spark, tmp_dir):
    from clickcredit.sinks.hits import by_day, write_hits_tsv
    from clickcredit.sources.hits import load_event_hits
    landing = os.path.join(tmp_dir, "landing")
    write_hits_tsv(load_event_hits(spark, "/root/testdata/sf0.001"), landing, file_key=by_day())
    out = os.path.join(tmp_dir, "out")
    start_report_stream(spark, landing + "/*", out, checkpoint_dir=os.path.join(tmp_dir, "ckpt"),
                        max_files_per_trigger=4).awaitTermination()
    streamed = sorted((r.source_file, r.domain, r.keyword, float(r.revenue))
                      for r in read_stream_output(spark, out, landing).collect())
    batch = sorted((r.source_file, r.domain, r.keyword, float(r.revenue))
                   for r in per_file_report(read_hits(spark, landing + "/*")).collect())
    assert streamed and streamed == batch


def _text(location):
    import glob
    path = location.removeprefix("file:")
    lines = []
    for part in sorted(glob.glob(os.path.join(path, "part-*.csv"))):
        with open(part, newline="") as f:
            lines += [f.read()]
    return lines


def test_every_file_has_a_report_text_and_an_event(spark, tmp_dir):
    from conftest import HEADER, write_hits
    landing = os.path.join(tmp_dir, "landing", "year=2026", "month=3", "day=5")
    other = os.path.join(tmp_dir, "landing", "year=2026", "month=3", "day=6")
    os.makedirs(landing), os.makedirs(other)
    write_sample(landing, "original", "hits.tsv")
    write_sample(other, "test", "hits.tsv")  # the same name on another day
    write_hits(landing, [{"ip": "a", "referrer": "http://x.com/?q=1"}], "nocredit.tsv")
    write_hits(landing, [], "header only + {odd} [name].tsv")
    open(os.path.join(landing, "empty.tsv"), "w").close()
    with open(os.path.join(other, "bad.tsv"), "w") as f:
        f.write("not\tthe\theader\n1\t2\t3\n")
    log, out, ckpt = (os.path.join(tmp_dir, x) for x in ("log", "out", "ckpt"))
    root = os.path.join(tmp_dir, "landing")
    start_report_stream(spark, root, out, checkpoint_dir=ckpt, max_files_per_trigger=3,
                        log_path=log).awaitTermination()
    events = {"/".join(e.file_key.split("/")[-2:]): e for e in read_file_events(spark, log).collect()}
    assert {k: (e.file_status, e.record_count, e.file_date) for k, e in events.items()} == {
        "day=5/hits.tsv": ("COMPLETE", 12, "2026-03-05"), "day=6/hits.tsv": ("COMPLETE", 12, "2026-03-06"),
        "day=5/nocredit.tsv": ("COMPLETE", 1, "2026-03-05"), "day=5/empty.tsv": ("COMPLETE", 0, "2026-03-05"),
        "day=5/header only + {odd} [name].tsv": ("COMPLETE", 0, "2026-03-05"),
        "day=6/bad.tsv": ("FAILED", None, "2026-03-06")}
    assert read_file_events(spark, log).count() == 6
    head = "Search Engine Domain\tSearch Keyword\tRevenue\n"
    assert _text(events["day=5/hits.tsv"].output_location) == [
        head + "google.com\tipod\t480.00\nbing.com\tzune\t250.00\n"]
    assert _text(events["day=6/hits.tsv"].output_location) == [
        head + "google.com\tipod\t575.00\nbing.com\tzune\t50.00\n"]
    for name in ("nocredit.tsv", "empty.tsv", "header only + {odd} [name].tsv"):
        assert _text(events[f"day=5/{name}"].output_location) == [head], name
    bad = events["day=6/bad.tsv"]
    assert bad.error_message and "\tat " not in bad.error_message and bad.output_location is None
    # A replayed batch (its commit was lost) changes nothing.
    for name in os.listdir(os.path.join(ckpt, "commits")):
        os.rename(os.path.join(ckpt, "commits", name), os.path.join(tmp_dir, f"gone-{name}"))
    start_report_stream(spark, root, out, checkpoint_dir=ckpt, max_files_per_trigger=3,
                        log_path=log).awaitTermination()
    assert read_file_events(spark, log).count() == 6
    assert _text(events["day=5/hits.tsv"].output_location) == [
        head + "google.com\tipod\t480.00\nbing.com\tzune\t250.00\n"]
    assert HEADER


def test_split_landing_files_add_up(spark, tmp_dir):
    """A day in several files, split by visitor, gives the day's report as the sum of theirs."""
    from pyspark.sql import functions as F

    from clickcredit.sinks.hits import by_day, write_hits_tsv
    from clickcredit.sources.hits import load_event_hits
    hits = load_event_hits(spark, "/root/testdata/sf0.001")
    one, many = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "many")
    write_hits_tsv(hits, one, file_key=by_day())
    write_hits_tsv(hits, many, file_key=by_day(), splits=3)
    day = F.regexp_extract("source_file", "file_key=([0-9-]+)", 1).alias("day")
    total = lambda path: sorted(tuple(r) for r in per_file_report(read_hits(spark, path)).groupBy(
        day, "domain", "keyword").agg(F.sum("revenue")).collect())
    assert total(one + "/*") == total(many + "/*/*") and total(one + "/*")
    assert read_hits(spark, many + "/*/*").select("source_file").distinct().count() > \
        read_hits(spark, one + "/*").select("source_file").distinct().count()
