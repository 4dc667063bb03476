"""Command line and reader guards."""

from __future__ import annotations

import json
import os

import pytest
from conftest import HEADER, write_sample

from clickcredit.cli import main
from clickcredit.sources.hits import read_hits


def test_cli_route_and_report(spark, tmp_dir, capsys):
    landing = os.path.join(tmp_dir, "landing", "year=2026", "month=3", "day=5")
    os.makedirs(landing)
    src = write_sample(landing, "original")
    log = os.path.join(tmp_dir, "log")
    assert main(["route", os.path.join(tmp_dir, "landing"), log, "--run-ts", "2026-03-06T12:00:00Z"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"small": 1}
    assert main(["report", src, os.path.join(tmp_dir, "tgt"), log, "--run-ts", "2026-03-06T12:05:00Z",
                 "--case-sensitive"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["record_count"] == 12
    assert out["top_keywords"] == [["Ipod", 290.0], ["Zune", 250.0], ["ipod", 190.0]]


def test_header_mismatch_is_an_error(spark, tmp_dir):
    cols = HEADER.split("\t")
    cols[3], cols[4] = cols[4], cols[3]  # ip <-> event_list
    path = os.path.join(tmp_dir, "bad.tsv")
    with open(path, "w") as f:
        f.write("\t".join(cols) + "\n1\t2024-01-01 00:00:00\tua\t1\t1.2.3.4\t\t\t\t\t\t\t\n")
    with pytest.raises(Exception, match="(?i)header|schema|CSV"):
        read_hits(spark, path).collect()
