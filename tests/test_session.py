import pytest

from tickloom import session


class Conf(dict):
    pass


class Fake:
    """A session with a master and settings."""

    def __init__(self, master, **settings):
        self.conf = Conf(settings)
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return self.conf


def test_scratch_goes_below_the_named_folder():
    path = session.workspace(Fake("spark://x", **{"spark.checkpoint.dir": "hdfs:///shared/"}), "run")
    assert path.startswith("hdfs:///shared/run-")


def test_cluster_without_a_named_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.workspace(Fake("spark://x"), "run")


def test_local_session_may_use_a_local_folder():
    assert "tickloom-" in session.workspace(Fake("local[2]"), "run")


def test_stored_rows_are_the_same(spark):
    rows = spark.range(10).selectExpr("id", "cast(id as string) as name")
    again = session.stored(rows, "rows")
    assert again.dtypes == rows.dtypes and sorted(again.collect()) == sorted(rows.collect())
