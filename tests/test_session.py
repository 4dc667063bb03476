"""Scratch data and lineage cuts live under the session's shared checkpoint folder."""

from __future__ import annotations

from clickcredit.session import checkpoint_root, scratch_path


def test_scratch_paths_follow_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    root = checkpoint_root(spark)
    assert root == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root + "/") and b.startswith(root + "/") and a != b


def test_checkpoint_uses_a_reliable_folder(spark):
    checkpoint_root(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    df = spark.range(10).checkpoint(eager=True)
    assert df.count() == 10


def test_parallelism_is_set_on_a_local_master_only():
    from clickcredit.session import session_defaults
    assert session_defaults("local[4]")["spark.sql.shuffle.partitions"] == "8"
    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"):
        settings = session_defaults(master)
        assert "spark.sql.shuffle.partitions" not in settings
        assert settings["spark.sql.adaptive.enabled"] == "true"
    assert session_defaults("yarn", {"a": "b"})["a"] == "b"
