"""Session form vs join form on replicated hits: wall time and shuffle volume.

    python tools/scale_check.py [--copies 100] [--sf-dir /root/testdata/sf0.1]

Hits derived from ``events`` are replicated ``--copies`` times as new
visitors (and once more with one visitor holding a third of all rows), written
as parquet under the shared checkpoint folder, and each attribution form is
run with the ``noop`` sink. Shuffle bytes and records come from Spark's event
log, written to a fresh folder under ``--scratch``. Prints one JSON line.

This is a single-machine measurement tool (``local[N]``): the event log is
written by the driver to a local folder; the replicated tables go to the
session's shared checkpoint folder like every other scratch output.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _read_event_log(folder: str) -> list[dict]:
    import zstandard
    events = []
    for path in sorted(glob.glob(os.path.join(folder, "*", "events_*")) +
                       glob.glob(os.path.join(folder, "app-*")) + glob.glob(os.path.join(folder, "local-*"))):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        for line in raw.decode().split("\n"):
            if line.strip():
                events.append(json.loads(line))
    return events


def _shuffle_by_group(events: list[dict]) -> dict[str, dict]:
    stage_group, out = {}, {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id")
            for sid in e["Stage IDs"]:
                stage_group[sid] = group
        elif e["Event"] == "SparkListenerTaskEnd":
            group = stage_group.get(e["Stage ID"])
            sw = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
            acc = out.setdefault(group, {"shuffle_mb": 0.0, "shuffle_records": 0})
            acc["shuffle_mb"] += sw.get("Shuffle Bytes Written", 0) / 1e6
            acc["shuffle_records"] += sw.get("Shuffle Records Written", 0)
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--copies", type=int, default=100)
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--scratch", default=tempfile.gettempdir())
    ap.add_argument("--cpus", type=int, default=8)
    args = ap.parse_args()

    from pyspark.sql import SparkSession

    log_dir = tempfile.mkdtemp(prefix="scale-eventlog-", dir=args.scratch)
    spark = (SparkSession.builder.master(f"local[{args.cpus}]").appName("clickcredit-scale")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(args.cpus))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from bench import replicated_hits
    from clickcredit.operators.attribution import keyword_revenue, keyword_revenue_join
    from clickcredit.operators.enrich import enrich_hits
    from clickcredit.session import scratch_path

    tables = {}
    for name, hot in (("even", 0.0), ("hot", 1 / 3)):
        path = scratch_path(spark, f"scale-hits-{name}")
        replicated_hits(spark, args.sf_dir, args.copies, hot_share=hot).write.parquet(path)
        tables[name] = path

    forms = {
        "session": lambda e: keyword_revenue(e),
        "join": lambda e: keyword_revenue_join(e),
    }
    result: dict[str, dict] = {}
    answers = {}
    for tname, path in tables.items():
        for fname, form in forms.items():
            group = f"{tname}:{fname}"
            runs = []
            for i in range(4):  # one warm-up run, then the median of three
                spark.sparkContext.setJobGroup(group if i == 3 else f"{group}:run{i}", group)
                t0 = time.perf_counter()
                form(enrich_hits(spark.read.parquet(path))).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            result[group] = {"sec": round(sorted(runs[1:])[1], 2)}
            answers[group] = sorted(tuple(r) for r in form(enrich_hits(spark.read.parquet(path))).collect())
    spark.stop()
    for group, acc in _shuffle_by_group(_read_event_log(log_dir)).items():
        if group in result:
            result[group].update({k: round(v, 2) if isinstance(v, float) else v for k, v in acc.items()})
    same = all(answers[f"{t}:{f}"] == answers[f"{t}:session"] for t in tables for f in forms)
    print(json.dumps({"copies": args.copies, "forms_agree": same, "results": result}))


if __name__ == "__main__":
    main()
