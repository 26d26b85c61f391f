"""Checkpoint-folder policy: configured folder first, own folder only where
none is configured, and never a machine-local fallback on a cluster."""

from __future__ import annotations

import pytest

from tradestar.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, current=None):
        self.master = master
        self.current = current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path

    def getConf(self):
        return _Conf({})


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Context(master, current)
        self.conf = _Conf(conf or {})


def test_existing_directory_is_kept():
    s = _Session("yarn", current="hdfs:///ckpt/app-1")
    assert ensure_checkpoint_dir(s, fallback="/tmp/x") == "hdfs:///ckpt/app-1"


def test_configured_directory_wins_over_fallback():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s, fallback="/tmp/x") == "hdfs:///shared/ckpt"


def test_fallback_only_when_unset():
    s = _Session("local[4]")
    assert ensure_checkpoint_dir(s, fallback="/tmp/mine") == "/tmp/mine"


def test_cluster_without_setting_refuses_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_local_session_without_setting_gets_a_temporary_folder():
    path = ensure_checkpoint_dir(_Session("local[2]"))
    assert "tradestar-ckpt-" in path
