from pathlib import Path

import pytest

from refsync.session import (
    CHECKPOINT_DIR,
    configure,
    materialize,
    name_local_folder,
    scratch_tables,
    shared_dir,
)


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class FakeSession:
    def __init__(self, **conf):
        self.conf = Conf({key.replace("_", "."): value for key, value in conf.items()})


def test_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError):
        shared_dir(FakeSession(spark_master="yarn"))
    named = FakeSession(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert shared_dir(named) == "hdfs:///shared"


def test_no_session_gets_a_folder_by_itself():
    with pytest.raises(ValueError):
        shared_dir(FakeSession(spark_master="local[2]"))


def test_a_sandbox_may_name_one():
    session = name_local_folder(FakeSession(spark_master="local[2]"))
    assert shared_dir(session) == session.conf[CHECKPOINT_DIR]
    assert CHECKPOINT_DIR not in name_local_folder(FakeSession(spark_master="yarn")).conf


def test_scratch_tables_go_when_their_run_is_written(spark, tmp_path):
    with scratch_tables(spark):
        table = materialize(spark.range(3), "scratch")
        (path,) = {name.rpartition("/")[0] for name in table.inputFiles()}
        table.write.parquet(str(tmp_path / "result"))
    assert not Path(path.removeprefix("file://").removeprefix("file:")).exists()
    assert spark.read.parquet(str(tmp_path / "result")).count() == 3
    kept = materialize(spark.range(3), "kept")
    assert kept.count() == 3


def test_shuffle_partitions_fit_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        configure(spark, shuffled_bytes=10 * 1024**4)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 81920
        configure(spark, shuffled_bytes=1)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 81920
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_materialized_rows_are_read_back(spark):
    df = spark.range(5).selectExpr("id", "array(id) as list")
    assert materialize(df, "test").orderBy("id").collect() == df.collect()
