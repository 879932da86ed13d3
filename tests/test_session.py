"""Shared checkpoint folder rules (no real session needed)."""

import pytest

from gazette.session import checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def setCheckpointDir(self, d):
        self.dir = d

    def getCheckpointDir(self):
        return self.dir


class _Session:
    def __init__(self, master, values):
        self.conf = _Conf(values)
        self.sparkContext = _Context(master)


def test_uses_the_cluster_setting():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.dir == "hdfs://shared/ckpt"


def test_refuses_a_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Session("spark://master:7077", {}))


def test_local_mode_gets_a_private_folder():
    s = _Session("local[2]", {})
    d = checkpoint_dir(s)
    assert d and s.sparkContext.dir == d
    assert checkpoint_dir(s) == d  # reused, not re-created


def test_entry_survives_a_missing_package():
    """Without a package of the corpus operators, all other queries are there."""
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['xxhash'] = None\n"
        "import __spark_entry__ as e\n"
        "from gazette.plans.registry import all_queries\n"
        "assert set(e.queries()) == set(all_queries()) == set(e.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
