"""Verdicts on few texts: what they find, and what they move."""

import random

import pytest
from pyspark.sql import functions as F

from labelloom import Roles
from labelloom.functions.text import text_key
from labelloom.operators import bloom, groups, policies, split


def shuffled_bytes(spark, action):
    """Bytes that the stages of ``action`` write to shuffles."""
    tracker = spark.sparkContext._jsc.sc().statusTracker()
    store = spark.sparkContext._jsc.sc().statusStore()
    group = f"g{random.random()}"
    spark.sparkContext.setJobGroup(group, "measured")
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    total = 0
    for job in tracker.getJobIdsForGroup(group):
        for stage in tracker.getJobInfo(job).get().stageIds():
            total += store.lastStageAttempt(stage).shuffleWriteBytes()
    spark.sparkContext._jsc.sc().clearJobGroup()
    return total


def test_no_key_is_missed_and_few_others_hit(spark):
    df = spark.range(60_000).withColumn("key", F.sha2(F.col("id").cast("string"), 256))
    inside = df.where("id < 3000")
    found = bloom.bloom_filter(inside, "key", words=1 << 12)
    marked = bloom.possible(df, F.col("key"), found, words=1 << 12)
    assert marked.where("id < 3000 and not bloom_hit").count() == 0
    assert marked.where("id >= 3000 and bloom_hit").count() < 57_000 * 0.03
    assert marked.columns == ["id", "key", "bloom_hit"]


@pytest.fixture
def table(spark):
    """Long texts; of 4,000 rows some hundred carry texts that are conflicting."""
    rng = random.Random(11)
    rows = [(i, f"text {i} " + "x%08x" % rng.getrandbits(32) * 60, "a", "train") for i in range(3800)]
    rows += [(4000 + i, f"conflict {i % 60}", "ab"[i % 2 if i < 100 else 0], ("train", "val", "test")[i % 3]) for i in range(150)]
    rows += [(5000 + i, None, "a", "train") for i in range(5)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label string, split string").repartition(8)


def conflicting(table):
    texts = table.groupBy(text_key(F.col("text")).alias("text_key")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("label").alias("k")
    )
    return texts.where("text_key is not null and k > 1").select("text_key", "n_rows", F.lit(True).alias("bad"))


@pytest.mark.parametrize("max_broadcast", [0, 10_000])
def test_verdicts_reach_their_rows(table, max_broadcast):
    found = groups.attach_rare(table, Roles(), conflicting(table), "bad", max_broadcast=max_broadcast, words=64)
    expected = {r.text for r in table.groupBy("text").agg(F.count_distinct("label").alias("k")).where("k > 1").collect()}
    rows = found.collect()
    assert len(rows) == table.count() and found.columns == [*table.columns, "bad"]
    assert all((r.bad is True) == (r.text in expected) for r in rows)


def test_shuffles_follow_the_conflicts(spark, table, monkeypatch):
    table.write.mode("overwrite").format("noop").save()
    monkeypatch.setattr(groups.attach_rare, "__defaults__", (None, 0, 1 << 16))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    settled = groups.settle(table)
    try:
        bytes_of_texts = settled.agg(F.sum(F.length("text"))).first()[0]
        for job in (policies.policy_a, policies.policy_c, split.cross_split_dedup, policies.majority_resolved):
            moved = shuffled_bytes(spark, lambda job=job: job(settled).write.format("noop").mode("overwrite").save())
            assert 0 < moved < bytes_of_texts / 3, job.__name__
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_same_rows_as_by_broadcast(table, monkeypatch):
    jobs = (policies.policy_a, split.cross_split_dedup, policies.majority_resolved)
    by_broadcast = [sorted(map(tuple, job(table).collect()), key=str) for job in jobs]
    monkeypatch.setattr(groups.attach_rare, "__defaults__", (None, 0, 64))
    assert [sorted(map(tuple, job(table).collect()), key=str) for job in jobs] == by_broadcast
