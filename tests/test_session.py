"""Scratch folders: refused where they would be machine-local, deleted on request."""

import os
from types import SimpleNamespace

import pytest

from sourcelens import session


class Unset:
    """A session on a cluster without a checkpoint dir."""

    conf = SimpleNamespace(get=lambda key, default=None: default)

    def __init__(self, master):
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: None)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Unset(master))


def test_released_tables_are_deleted(spark, monkeypatch):
    monkeypatch.setattr(session, "_WRITTEN", {})
    df = session.write_and_read(spark.range(3), "released")
    (path,) = session._WRITTEN[spark.sparkContext.applicationId]
    local = path.removeprefix("file://")
    assert df.count() == 3 and os.path.isdir(local)
    assert session.release_tables(spark) == 1 and not os.path.exists(local)
    assert session.release_tables(spark) == 0


def test_partitions_follow_the_data(spark):
    """A cluster's fixed number of shuffle partitions does not make a task's share grow with the input."""
    from pyspark.sql import functions as F

    session.apply_job_conf(spark)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        texts = spark.range(0, 40_000, numPartitions=4).select("id", F.sha2(F.col("id").cast("string"), 512).alias("t"))
        parts = lambda n: texts.where(F.col("id") < n).groupBy("t").agg(F.collect_list("id")).rdd.getNumPartitions()
        small, large = parts(400), parts(40_000)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert small == 1 and large > 2


@pytest.mark.parametrize("was,now", [("128MB", 1), ("134217728b", 1), ("1g", 1), ("8m", 0), ("8388608", 0), ("512k", 0)])
def test_a_task_is_dealt_bounded_bytes(was, now):
    conf = dict.fromkeys(session.TASK_BYTES, was)
    session.apply_job_conf(SimpleNamespace(conf=SimpleNamespace(get=conf.get, set=conf.__setitem__)))
    assert {k: conf[k] for k in session.TASK_BYTES} == {k: str(most) if now else was for k, most in session.TASK_BYTES.items()}


def test_a_stage_takes_its_input_in_bounded_tasks(spark):
    """Tables are compressed: at Spark's own sizes a task would take all of these rows."""
    from pyspark.sql import functions as F

    sizes = {"spark.sql.files.maxPartitionBytes": "128MB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB"}
    kept = {k: spark.conf.get(k) for k in (*sizes, "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    for k, v in (sizes | {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}).items():
        spark.conf.set(k, v)
    try:
        session.apply_job_conf(spark)
        rows = spark.range(0, 500_000, numPartitions=4).select("id", F.sha2(F.col("id").cast("string"), 512).alias("t"))
        assert rows.groupBy("t").agg(F.collect_list("id")).rdd.getNumPartitions() > 1
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
