"""Checkpoint-folder rules: configured folder wins; a scratch folder only on a
local master; a cluster without ``spark.checkpoint.dir`` is refused."""

from __future__ import annotations

import pytest

from voxlens.session import checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master)
        self.conf = _Conf(conf or {})


def test_configured_folder_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"


def test_cluster_without_setting_is_refused():
    with pytest.raises(ValueError):
        checkpoint_dir(_Session("spark://master:7077"))


def test_local_master_gets_scratch_folder():
    s = _Session("local[8]")
    d = checkpoint_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d and s.sparkContext.dir == d
