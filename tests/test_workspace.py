from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from tessera import workspace


class Context(SimpleNamespace):
    folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, **conf):
    return SimpleNamespace(
        sparkContext=Context(master=master),
        conf=SimpleNamespace(get=lambda key, default=None: conf.get("folder", default)),
    )


def test_the_folder_named_by_the_session_is_used():
    cluster = session("yarn", folder="s3a://bucket/checkpoints")
    assert workspace.scratch_path(cluster, "t").startswith("s3a://bucket/checkpoints/t-")
    assert workspace.scratch_path(cluster, "t") != workspace.scratch_path(cluster, "t")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(session("yarn"))


def test_local_mode_writes_beside_the_warehouse():
    local = session("local[2]", folder=None)
    local.conf.get = lambda key, default=None: {"spark.sql.warehouse.dir": "file:/w/"}.get(key, default)
    assert workspace.shared_folder(local) == "file:/w/_scratch"


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    stored = workspace.materialize(df, "t")
    assert stored.dtypes == df.dtypes
    assert sorted(stored.collect()) == sorted(df.collect())


def test_shuffle_files_are_removed_inside_only(spark):
    before = spark.conf.get(workspace.CLEANUP)
    with workspace.shuffles_removed(spark):
        assert spark.conf.get(workspace.CLEANUP) == "true"
    assert spark.conf.get(workspace.CLEANUP) == before


def test_tables_on_the_way_are_deleted(spark):
    paths = {}

    def build():
        first = workspace.materialize(spark.range(10).toDF("v"), "first")
        inner = workspace.materialize_alone(
            lambda: workspace.materialize(first.where("v > 2"), "second").where("v > 4"), "inner"
        )
        paths.update(first=first.inputFiles()[0], inner=inner.inputFiles()[0])
        return first.join(inner, "v")

    kept = workspace.materialize_alone(build, "kept")
    assert sorted(r.v for r in kept.collect()) == [5, 6, 7, 8, 9]
    folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent.parent
    assert not [p for p in paths.values() if Path(p.removeprefix("file:")).exists()]
    assert not list(folder.glob("second-*"))
