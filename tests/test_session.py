"""Where intermediate files go: the session's shared checkpoint folder."""

import pytest

from logtally.session import checkpoint_root


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master):
        self.master, self.registered = master, None

    def getCheckpointDir(self):
        return self.registered

    def setCheckpointDir(self, path):
        self.registered = path


class _Session:
    def __init__(self, configured, master):
        self.conf, self.sparkContext = _Conf(configured), _Context(master)


def test_configured_folder_is_used():
    assert checkpoint_root(_Session("hdfs:///shared/ckpt/", "yarn")) == "hdfs:///shared/ckpt"


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session(None, "yarn"))


def test_local_mode_gets_a_registered_temporary_folder():
    session = _Session(None, "local[4]")
    root = checkpoint_root(session)
    assert session.sparkContext.registered == root
