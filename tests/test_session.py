from __future__ import annotations

from pitchflow.session import new_run_dir, shared_dir


def test_run_dirs_live_under_the_checkpoint_dir(spark):
    root = shared_dir(spark)
    a, b = new_run_dir(spark, "x"), new_run_dir(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b
