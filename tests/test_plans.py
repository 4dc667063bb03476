"""Physical-plan shape of the flagship: native, pruned, three exchanges."""

from __future__ import annotations

from clickcredit.operators.attribution import keyword_revenue, keyword_revenue_join
from clickcredit.operators.enrich import enrich_hits
from clickcredit.plans.catalog import ORDER
from clickcredit.sources.hits import load_event_hits

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_shape(spark):
    df = keyword_revenue(enrich_hits(load_event_hits(spark, SF)), order_by=ORDER)
    plan = _plan(df)
    # no Python worker anywhere
    for op in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert op not in plan
    # session agg + (domain, keyword) agg + final range sort, no join
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Exchange rangepartitioning") == 1
    assert "Join" not in plan
    # map-side partial aggregation on both group-bys
    assert "partial_max" in plan and "partial_sum" in plan
    # only the needed columns are read (value is needed for the price text)
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in scan


def test_cheap_prefilter_reaches_scan(spark, tmp_dir):
    import os
    path = os.path.join(tmp_dir, "hits.parquet")
    load_event_hits(spark, SF).write.parquet(path)
    df = keyword_revenue(enrich_hits(spark.read.parquet(path)))
    scan = [line for line in _plan(df).splitlines() if "FileScan parquet" in line][0]
    assert "PushedFilters: [IsNotNull(ip), Or(StringContains(referrer,?),EqualTo(event_list,1))]" in scan
    assert ("ReadSchema: struct<hit_time_gmt:bigint,ip:string,event_list:string,product_list:string,"
            "referrer:string>") in scan


def test_join_form_plan_has_one_join(spark):
    df = keyword_revenue_join(enrich_hits(load_event_hits(spark, SF)), order_by=ORDER)
    plan = _plan(df)
    assert plan.count("Join") >= 1
    assert "BatchEvalPython" not in plan


def test_flag_filters_do_not_inline_url_rules(spark):
    from clickcredit.operators.enrich import purchase_hits, search_hits
    e = enrich_hits(load_event_hits(spark, SF))
    for df in (search_hits(e), purchase_hits(e)):
        plan = _plan(df)
        filters = [line for line in plan.splitlines() if "Filter" in line]
        # the domain / keyword / decode rules stay out of every predicate
        assert not any(sig in line for line in filters
                       for sig in ("url_decode", "//([^/?#]*)", "[^&]+")), filters
        assert "Generate explode(array_repeat(true" in plan


def test_enrichment_rules_support_codegen(spark):
    # No rule forces interpreted evaluation (arrays + lambdas would).
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    plan = _plan(enrich_hits(load_event_hits(spark, SF)))
    projects = [line for line in plan.splitlines() if "Project [" in line]
    assert projects and all(line.lstrip(" +-:").startswith("*(") for line in projects), projects


def test_join_form_pushes_both_sides_to_the_scan(spark, tmp_dir):
    import os
    path = os.path.join(tmp_dir, "hits.parquet")
    load_event_hits(spark, SF).write.parquet(path)
    plan = _plan(keyword_revenue_join(enrich_hits(spark.read.parquet(path))))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2
    assert any("EqualTo(event_list,1)" in line for line in scans)
    assert any("StringContains(referrer,?)" in line for line in scans)


def test_keep_where_treats_null_as_false(spark):
    from clickcredit.operators.enrich import keep_where
    df = spark.createDataFrame([(1, True), (2, False), (3, None), (4, True)], "id int, f boolean")
    assert sorted(r.id for r in keep_where(df, "f").collect()) == [1, 4]
    assert keep_where(df, "f").columns == ["id", "f"]


def test_landing_root_prunes_partitions(spark, tmp_dir):
    import os

    from conftest import write_sample

    from clickcredit.sources.hits import read_hits
    for day, variant in (("5", "original"), ("6", "test")):
        folder = os.path.join(tmp_dir, "landing", "year=2026", "month=3", f"day={day}")
        os.makedirs(folder)
        write_sample(folder, variant)
    hits = read_hits(spark, os.path.join(tmp_dir, "landing")).where("day = 6")
    scan = [line for line in _plan(hits).splitlines() if "FileScan csv" in line][0]
    assert "PartitionFilters: [isnotnull(day" in scan and "(day#" in scan
    files = {r.source_file.split("/")[-1] for r in hits.select("source_file").distinct().collect()}
    assert files == {"hits_test.tsv"}
