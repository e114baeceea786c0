"""Fixing intermediate results."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from labelloom.operators import pin as pinning


def session(master, named="", directory=None):
    state = SimpleNamespace(directory=directory)

    def remember(path):
        state.directory = f"{path}/job"

    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: state.directory, setCheckpointDir=remember
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named or default))


def test_the_named_folder_is_used():
    assert pinning.shared_folder(session("spark://host", "hdfs:///shared/")) == "hdfs:///shared"
    assert pinning.shared_folder(session("spark://host", directory="hdfs:///set")) == "hdfs:///set"


def test_only_local_sessions_make_their_own():
    local = session("local[2]")
    folder = pinning.shared_folder(local)
    assert folder.endswith("/job") and pinning.shared_folder(local) == folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        pinning.shared_folder(session("spark://host"))


def test_settled_frames_read_back(spark):
    df = spark.range(100).selectExpr("id", "id % 3 as k", "named_struct('a', id) as s")
    back = pinning.settle(df)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pinned_frames_are_broadcast_within_the_bound_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, big = spark.range(10).selectExpr("id as k"), spark.range(1000)
        within = big.join(pinning.pin(small, 10), F.col("id") == F.col("k"))
        beyond = big.join(pinning.pin(small, 9), F.col("id") == F.col("k"))
        assert "BroadcastHashJoin" in plan(within) and within.count() == 10
        assert "BroadcastHashJoin" not in plan(beyond) and beyond.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_released_files_are_gone(spark):
    from pathlib import Path

    folder = Path(pinning.shared_folder(spark).removeprefix("file:"))
    pinning.settle(spark.range(3))
    assert list(folder.glob("labelloom-*"))
    pinning.release(spark)
    assert not list(folder.glob("labelloom-*"))


def test_only_the_last_of_frames_settled_together_stays(spark):
    from pathlib import Path

    pinning.release(spark)
    folder = Path(pinning.shared_folder(spark).removeprefix("file:"))
    earlier = pinning.settle(spark.range(5))

    def make():
        first = pinning.settle(spark.range(3))
        second = pinning.settle(first.selectExpr("id + 1 as id"))
        return second.where("id > 1")

    kept = pinning.settle_alone(make)
    assert len(list(folder.glob("labelloom-*"))) == 2
    assert sorted(r.id for r in kept.collect()) == [2, 3] and earlier.count() == 5
    pinning.release(spark)
    assert not list(folder.glob("labelloom-*"))
