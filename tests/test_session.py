from types import SimpleNamespace

import pytest

from martloom import session


def fake(master, shared=None):
    conf = SimpleNamespace(get=lambda name, default=None: shared if name == "spark.checkpoint.dir" else default)
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_is_the_shared_folder():
    assert session.scratch_root(fake("spark://host:7077", "/shared")) == "/shared/martloom/app-1"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(fake("spark://host:7077"))


def test_shuffles_grow_with_the_input_and_are_never_reduced(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, 1) == int(before)
        assert session.size_shuffles(spark, 10 * 2**30) == 40
        assert session.size_shuffles(spark, 100 * 2**40) == 400 * 2**10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_folder_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"12345")
    (tmp_path / "b").write_bytes(b"123")
    assert session.folder_bytes(spark, str(tmp_path)) == 8


def test_tasks_are_kept_small_unless_the_session_says_otherwise(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = {n: spark.conf.get(n, None) for n in session.PREFERRED_SETTINGS}
    try:
        for n in before:
            spark.conf.unset(n)
        spark.conf.set(name, "4MB")
        session.configure(spark)
        assert {n: spark.conf.get(n) for n in before} == session.PREFERRED_SETTINGS | {name: "4MB"}
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
