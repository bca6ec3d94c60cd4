"""Shared-folder rules of the session helpers."""

import pytest

from transitlens.session import cluster_conf, shared_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, values=()):
        self.master = master
        self.conf = _Conf(values)
        self.dir = None

    def getConf(self):
        return self.conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, values=()):
        self.conf = _Conf(values)
        self.sparkContext = _Context(master)


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        shared_dir(_Session("spark://host:7077"))


def test_configured_folder_is_used_as_is():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert shared_dir(s) == "hdfs://nn/shared/ckpt" and s.sparkContext.dir == "hdfs://nn/shared/ckpt/"


def test_local_master_gets_its_own_folder():
    s = _Session("local[2]")
    d = shared_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d


def test_cluster_conf_scales_with_cores():
    c = cluster_conf(1000, 8)
    assert c["spark.sql.shuffle.partitions"] == "32000"
