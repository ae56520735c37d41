import os

import pytest

from martlet.sources.store import Store, in_parallel, shared_folder, state_of


class Session:
    """Just the settings that the shared folder depends on."""

    def __init__(self, master, folder=None, checkpoints=None):
        self.sparkContext = type("C", (), {"master": master, "getCheckpointDir": staticmethod(lambda: checkpoints)})()
        values = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "file:/tables"}
        self.conf = type("F", (), {"get": staticmethod(lambda key, default=None: values.get(key) or default)})()


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(ValueError):
        shared_folder(Session(master))
    assert shared_folder(Session(master, "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_folder(Session(master, None, "hdfs:///set")) == "hdfs:///set"


@pytest.mark.parametrize("master", ["local", "local[2]", "local[*]"])
def test_local_sessions_use_the_warehouse(master):
    assert shared_folder(Session(master)) == "file:/tables/_martlet"


def test_a_store_can_be_dropped(spark):
    store = Store(spark, "test")
    assert store.put(spark.range(3), "numbers").count() == 3
    before = state_of(spark, store.path("numbers"))
    store.put(spark.range(4), "numbers")
    assert state_of(spark, store.path("numbers")) != before
    store.drop()
    assert not os.path.exists(store.root) and state_of(spark, store.path("numbers")) == ()


def test_parallel_builds_keep_their_names_and_errors():
    assert in_parallel({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
    with pytest.raises(ZeroDivisionError):
        in_parallel({"a": lambda: 1 / 0})
