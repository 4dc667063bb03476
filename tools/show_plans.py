"""Write the physical plans of the main queries to docs/PLANS.md.

    python tools/show_plans.py [--sf-dir /root/testdata/sf0.01]

Hits are first written as parquet and as TSV (landing format) to a scratch
folder under the shared checkpoint root, so the plans show real file scans
with their pushed filters and read schemas. Long expression lines are cut.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WIDTH = 220


_NODE = re.compile(r"^\s*(\+-|:|\*|[A-Z][A-Za-z]+ ?[\[(]|AdaptiveSparkPlan)")


def _printable(text: str) -> str:
    return "".join(c if c.isprintable() else f"\\u{ord(c):04x}" for c in text)


def _plan(df) -> str:
    """Plan text, one node per line (literal whitespace inside expressions is escaped)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines: list[str] = []
    for raw in text.split("\n"):
        if lines and not _NODE.match(raw):
            lines[-1] += "\\n" + raw  # a newline that belongs to a string literal
        else:
            lines.append(raw)
    out = [_printable(line) for line in lines]
    return "\n".join(line if len(line) <= WIDTH or "FileScan" in line else line[:WIDTH] + " ..."
                     for line in out)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                                  "docs", "PLANS.md"))
    args = ap.parse_args()

    from clickcredit.operators import attribution as A
    from clickcredit.operators.enrich import enrich_hits, search_hits
    from clickcredit.operators.status import latest_file_status
    from clickcredit.operators.summary import report_rollup
    from clickcredit.plans.catalog import status_log
    from clickcredit.session import get_session, scratch_path
    from clickcredit.sinks.hits import write_hits_tsv
    from clickcredit.sources.hits import load_event_hits, read_hits

    spark = get_session()
    pq, tsv = scratch_path(spark, "plans-parquet"), scratch_path(spark, "plans-tsv")
    hits = load_event_hits(spark, args.sf_dir)
    hits.write.parquet(pq)
    write_hits_tsv(hits, tsv)
    hp = enrich_hits(spark.read.parquet(pq))
    ht = enrich_hits(read_hits(spark, tsv))
    sections = [
        ("keyword_revenue, parquet hits (session form, the default)", A.keyword_revenue(hp)),
        ("keyword_revenue, TSV hits, sessions per file", A.keyword_revenue(ht, session_keys=("source_file", "ip"))),
        ("keyword_revenue_join (join form)", A.keyword_revenue_join(hp)),
        ("search_hits (filter on a computed flag)", search_hits(hp).select("ip", "domain", "search_keyword")),
        ("report_rollup (grouping sets over the report)", report_rollup(A.keyword_revenue_exact(hp))),
        ("latest_file_status", latest_file_status(status_log(spark, args.sf_dir), keys=("file_key",))),
    ]
    with open(args.out, "w") as f:
        f.write("# Physical plans\n\nGenerated by `tools/show_plans.py` (plans before adaptive re-planning; "
                "long expression lines are cut).\n")
        for title, df in sections:
            f.write(f"\n## {title}\n\n```\n{_plan(df)}\n```\n")
    print(args.out)


if __name__ == "__main__":
    main()
