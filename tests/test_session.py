"""Where results in progress are written."""

from types import SimpleNamespace

import pytest

from voltmart.session import shared_root, work_dir


def session(master: str, folder: str | None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, applicationId=f"test-{master}"),
    )


def test_the_clusters_folder_is_used():
    assert work_dir(session("yarn", "hdfs://shared/cut/"), "x").startswith("hdfs://shared/cut/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(session("yarn", None))


def test_a_local_session_gets_one_folder_of_its_own():
    local = session("local[2]", None)
    assert shared_root(local) == shared_root(local)
    assert work_dir(local, "x") != work_dir(local, "x")
