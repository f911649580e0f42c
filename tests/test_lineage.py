"""The folder of intermediate tables."""

import pytest

from threadloom import lineage
from threadloom.operators.models import map_model


@pytest.fixture
def on_cluster(spark, tmp_path, monkeypatch):
    """The session as a cluster's, its checkpoint folder a path without a file system."""
    get = type(spark.conf).get
    named = {"spark.checkpoint.dir": str(tmp_path)}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *more: named.get(key) or get(self, key, *more))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    return tmp_path


def test_a_path_without_a_file_system_serves_on_a_cluster(spark, on_cluster):
    assert lineage.shared_folder(spark) == f"file:{on_cluster}"
    out = map_model(spark.createDataFrame([(1, "ab"), (2, "c")], "id long, text string"), lambda r: {"n": len(r["text"])}, ["id"], "struct<n:bigint>")
    assert sorted(tuple(r) for r in out.select("id", "result.n").collect()) == [(1, 2), (2, 1)]
    assert not [p for p in (on_cluster / "threadloom").iterdir() if p.name.startswith("shared-")]


def test_a_folder_of_each_machine_is_refused(spark, on_cluster, monkeypatch):
    monkeypatch.setattr(lineage, "is_shared", lambda *_: False)
    with pytest.raises(ValueError, match="each machine"):
        lineage.shared_folder(spark)


def test_files_that_are_missed_are_noticed(spark, tmp_path, monkeypatch):
    assert lineage.is_shared(spark, str(tmp_path))
    read = type(spark.range(1)).count
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: read(self) - 1)
    assert not lineage.is_shared(spark, str(tmp_path))
