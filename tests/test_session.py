from types import SimpleNamespace

import pytest

from tillstar.__main__ import main
from tillstar.session import scratch_path


def session(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_scratch_lies_in_the_shared_checkpoint_folder():
    path = scratch_path(session("hdfs://nn/check/", "yarn"), "dim")
    assert path.startswith("hdfs://nn/check/app-1/dim-")
    assert path != scratch_path(session("hdfs://nn/check/", "yarn"), "dim")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session(None, "yarn"), "dim")


def test_a_local_session_falls_back_to_one_temporary_folder():
    first, second = (scratch_path(session(None, "local[2]"), "dim") for _ in range(2))
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] and first != second


def test_command_line_reports_a_failed_run(spark, tmp_path):
    assert main([str(tmp_path / "nothing"), str(tmp_path / "house")]) == 1
