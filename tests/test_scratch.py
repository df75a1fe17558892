from __future__ import annotations

import pytest

from daytally import scratch


class Settings(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Context:
    def __init__(self, master, conf=None, checkpoint=None):
        self.master, self._conf, self._dir = master, Settings(conf or {}), checkpoint

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


class Session:
    def __init__(self, context, conf=None):
        self.sparkContext, self.conf = context, Settings(conf or {})


def test_the_session_setting_is_used():
    context = Context("spark://host:7077")
    session = Session(context, {scratch.CHECKPOINT_KEY: "hdfs://shared/cp/"})
    assert scratch.shared_dir(session) == "hdfs://shared/cp"
    assert context.getCheckpointDir() == "hdfs://shared/cp/"


def test_a_folder_set_on_the_context_is_used():
    assert scratch.shared_dir(Session(Context("yarn", checkpoint="hdfs://cp/1"))) == "hdfs://cp/1"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Session(Context("k8s://host")))


def test_local_mode_makes_its_own_folder_once():
    session = Session(Context("local[8]"))
    assert scratch.shared_dir(session) == scratch.shared_dir(session)


def test_materialized_tables_cut_the_lineage(spark):
    df = spark.range(10).selectExpr("id", "id * 2 as `a.b`")
    stored = scratch.materialize(df)
    assert stored.dtypes == df.dtypes and stored.count() == 10
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()
    assert scratch.materialize(df).inputFiles() != stored.inputFiles()
