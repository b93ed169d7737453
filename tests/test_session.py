"""Scratch data lives under the session's shared checkpoint folder."""

from __future__ import annotations

from zoneflow.session import checkpoint_root, scratch_dir


def test_scratch_is_below_the_checkpoint_folder(spark):
    root = checkpoint_root(spark)
    configured = spark.sparkContext.getCheckpointDir()
    assert configured is not None and root == configured.rstrip("/")
    a, b = scratch_dir(spark, "t"), scratch_dir(spark, "t")
    assert a.startswith(root + "/zoneflow/t-") and b.startswith(root + "/zoneflow/t-") and a != b
