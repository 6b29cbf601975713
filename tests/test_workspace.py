import os
from types import SimpleNamespace

from conftest import rows
from ticklake.sources import workspace


def fake(master, conf=None, checkpoint=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint),
    )


def test_the_cluster_names_the_folder():
    assert workspace.shared_folder(fake("yarn", conf="hdfs://x/shared/")) == "hdfs://x/shared"
    assert workspace.shared_folder(fake("yarn", checkpoint="hdfs://x/other")) == "hdfs://x/other"


def test_without_one_the_warehouse_is_shared(spark):
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: "hdfs://x/warehouse/" if key == "spark.sql.warehouse.dir" else default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
    )
    assert workspace.shared_folder(session) == "hdfs://x/warehouse/_shared"


def test_settled_rows_are_computed_once(spark):
    kept = workspace.settle(spark.range(10))
    assert rows(kept) == [(i,) for i in range(10)]
    assert "Range" not in kept._jdf.queryExecution().toString()
    assert workspace.scratch_path(spark, "x") != workspace.scratch_path(spark, "x")


def test_discarded_tables_are_gone(spark):
    kept = workspace.settle(spark.range(10))
    assert os.path.isdir(kept.settled_at)
    workspace.discard(kept)
    assert not os.path.isdir(kept.settled_at)


def test_sweep_takes_old_tables_only(spark):
    kept = workspace.settle(spark.range(10))
    workspace.sweep(spark, 1.0)
    assert kept.count() == 10
    assert workspace.sweep(spark, -1.0) > 0 and not os.path.isdir(kept.settled_at)
