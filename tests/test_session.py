"""Where written tables go."""

from types import SimpleNamespace

import pytest

from tagloom.session import scratch_path, shared_dir


def session(master, conf=None, folder=None):
    def set_folder(path):
        context.folder = path

    context = SimpleNamespace(master=master, folder=folder, setCheckpointDir=set_folder)
    context.getCheckpointDir = lambda: context.folder
    settings = SimpleNamespace(get=lambda name, default: conf or default)
    return SimpleNamespace(conf=settings, sparkContext=context)


def test_the_setting_of_the_cluster_is_used():
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(session("yarn", folder="hdfs:///set/x")) == "hdfs:///set/x"


def test_a_cluster_without_the_setting_is_refused():
    for master in ("yarn", "spark://host:7077", "k8s://https://host"):
        with pytest.raises(ValueError):
            shared_dir(session(master))


def test_a_local_session_gets_one_folder():
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    assert scratch_path(local, "x") != scratch_path(local, "x")
