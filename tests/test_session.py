"""Checkpoint folder lookup: read from the session, never guessed."""

from __future__ import annotations

import pytest

from pulsegrid.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, checkpoint=None, conf=None):
        self.checkpoint = checkpoint
        self.conf = _Conf(conf or {})

    def getCheckpointDir(self):
        return self.checkpoint

    def getConf(self):
        return self.conf

    def setCheckpointDir(self, path):
        self.checkpoint = path


class _Session:
    def __init__(self, checkpoint=None, conf=None):
        self.sparkContext = _Context(checkpoint, conf)
        self.conf = _Conf(conf or {})


def test_existing_checkpoint_dir_wins():
    assert ensure_checkpoint_dir(_Session(checkpoint="hdfs://x/ck"), fallback="/tmp/unused") == "hdfs://x/ck"


def test_configured_setting_is_applied():
    session = _Session(conf={"spark.checkpoint.dir": "s3a://bucket/ck"})
    assert ensure_checkpoint_dir(session) == "s3a://bucket/ck"


def test_unset_without_fallback_refuses_to_guess():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session())


def test_fallback_only_when_unset():
    assert ensure_checkpoint_dir(_Session(), fallback="/tmp/test-ck") == "/tmp/test-ck"
