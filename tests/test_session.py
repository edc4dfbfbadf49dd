import pytest

from lakeops import session


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class Fake:
    def __init__(self, directory, master):
        self.conf = Conf(directory)
        self.sparkContext = type("C", (), {"master": master})()


def test_scratch_is_below_the_shared_folder():
    a, b = (session.scratch_dir(Fake("hdfs:///shared/", "yarn"), "x") for _ in range(2))
    assert a.startswith("hdfs:///shared/x-") and a != b


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        session.scratch_dir(Fake(None, "spark://host:7077"), "x")


def test_local_session_may_use_a_temporary_folder():
    a, b = (session.scratch_dir(Fake(None, "local[4]"), "x") for _ in range(2))
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
