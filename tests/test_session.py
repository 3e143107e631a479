"""The shared scratch folder."""

from types import SimpleNamespace

import pytest

from review_lens.session import remove, scratch_dir


def fake(master, folder):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_named_folder_is_used():
    first = scratch_dir(fake("yarn", "hdfs://shared/"), "rows")
    assert first.startswith("hdfs://shared/rows-")
    assert first != scratch_dir(fake("yarn", "hdfs://shared/"), "rows")


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(fake("spark://host:7077", None), "rows")
    assert scratch_dir(fake("local[2]", None), "rows")


def test_folders_are_removed(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "rows"))
    remove(spark, str(tmp_path / "rows"))
    remove(spark, str(tmp_path / "rows"))
    assert not (tmp_path / "rows").exists()
