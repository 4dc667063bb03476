from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

FIXTURES = ROOT / "tests" / "fixtures"
SF_SMALL = "/root/testdata/sf0.001"

# Quantity / price of the three purchase rows in each sample variant.
VARIANTS = {
    "original": {"q1": 1, "p1": 250, "q2": 1, "p2": 190, "q3": 1, "p3": 290},
    "quantity": {"q1": 2, "p1": 250, "q2": 2, "p2": 190, "q3": 2, "p3": 290},
    "test": {"q1": 1, "p1": 50, "q2": 1, "p2": 75, "q3": 1, "p3": 500},
    "order": {"q1": 1, "p1": 250, "q2": 1, "p2": 190, "q3": 1, "p3": 100},
}


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only where the session has none.
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickcredit-ckpt-"))
    yield spark


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="clickcredit-test-")


def write_sample(folder: str, variant: str, name: str | None = None) -> str:
    """Write one sample hit file for ``variant``; returns its path."""
    text = (FIXTURES / "hits_template.tsv").read_text()
    for key, value in VARIANTS[variant].items():
        text = text.replace("{" + key + "}", str(value))
    path = os.path.join(folder, name or f"hits_{variant}.tsv")
    with open(path, "w") as f:
        f.write(text)
    return path


HEADER = ("hit_time_gmt\tdate_time\tuser_agent\tip\tevent_list\tgeo_city\tgeo_region\tgeo_country\t"
          "pagename\tpage_url\tproduct_list\treferrer")


def write_hits(folder: str, rows: list[dict], name: str = "hits.tsv") -> str:
    """Write a small hand-made hit file; missing columns are blank."""
    cols = HEADER.split("\t")
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(HEADER + "\n")
        for i, row in enumerate(rows):
            base = {"hit_time_gmt": 1000 + i, "date_time": "2024-01-01 00:00:00"}
            base.update(row)
            f.write("\t".join("" if base.get(c) is None else str(base.get(c)) for c in cols) + "\n")
    return path
