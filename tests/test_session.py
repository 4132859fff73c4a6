"""Shared-folder rules: never a machine-local folder on a cluster."""

import pytest

from candlewick.session import bounded_broadcast, checkpoint_root


class _Conf(dict):
    def get(self, k, default=None):
        return dict.get(self, k, default)

    def set(self, k, v):
        self[k] = v


class _Ctx:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Ctx(master)


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_root(_Session("yarn"))


def test_configured_folder_is_used_as_is():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert checkpoint_root(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt/"


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[4]")
    root = checkpoint_root(s)
    assert root and s.conf.get("spark.checkpoint.dir") == root


def test_bounded_broadcast_only_within_limit(spark):
    df = spark.range(3)
    assert "broadcast" in bounded_broadcast(df, 3)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in bounded_broadcast(df, 10 ** 9)._jdf.queryExecution().analyzed().toString().lower()
