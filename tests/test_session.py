import pytest
from pyspark.sql import functions as F

from windrow import session


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class _Session:
    def __init__(self, master, checkpoint=None, **conf):
        self.sparkContext, self.conf = _Context(master, checkpoint), _Conf(conf)


def test_the_named_folder_is_used():
    fake = _Session("spark://x:7077", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.work_root(fake) == "hdfs:///shared/"
    assert fake.sparkContext.checkpoint == "hdfs:///shared/"
    path = session.work_path(fake, "t")
    assert path.startswith("hdfs:///shared/t-") and path != session.work_path(fake, "t")


def test_a_folder_set_on_the_context_is_used():
    assert session.work_root(_Session("yarn", "hdfs:///cp/1")) == "hdfs:///cp/1"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(_Session("yarn"))


def test_one_process_makes_its_own_folder_once():
    fake = _Session("local[2]")
    assert session.work_root(fake) == session.work_root(fake)


def test_broadcast_needs_a_counted_bound(spark):
    df = spark.range(10)
    hinted = session.broadcast_if_small(df, 10)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert session.broadcast_if_small(df, 9) is df


def test_materialised_rows_have_no_lineage(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    kept = session.materialise(df, "t")
    assert sorted(r["x"] for r in kept.collect()) == [0, 2, 4, 6, 8]
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()
