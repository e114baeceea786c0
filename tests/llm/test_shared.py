import pytest
from pyspark.sql import functions as F

from labelloom.llm import shared


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(500).selectExpr("id", "id % 7 as k", "concat('text ', id) as text").repartition(6).write.parquet(path)
    return spark.read.parquet(path)


def test_rows_of_files_are_numbered_without_a_copy(spark, table, monkeypatch):
    found = {r.id: r[shared.ROW] for r in shared.numbered(table).collect()}
    assert len(set(found.values())) == 500
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    try:
        again = {r.id: r[shared.ROW] for r in shared.numbered(table.where("k > 2")).select("id", shared.ROW).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert again == {i: n for i, n in found.items() if i % 7 > 2}
    in_memory = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "id long, text string")
    rows = shared.numbered(in_memory)
    assert rows.columns == ["id", "text", shared.ROW] and rows.select(shared.ROW).distinct().count() == 3


@pytest.mark.parametrize("listed", [shared.MAX_LISTED, 3])
def test_rows_are_sifted_exactly(table, monkeypatch, listed):
    monkeypatch.setattr(shared, "MAX_LISTED", listed)
    keys = shared.settle(table.where("k = 3").select("id"))
    assert {r.id for r in shared.among(table, keys, "id").collect()} == {i for i in range(500) if i % 7 == 3}
    assert {r.id for r in shared.without(table, keys, "id").collect()} == {i for i in range(500) if i % 7 != 3}
    few = shared.settle(keys.withColumn("extra", F.col("id") * 2))
    found = {r.id: r.extra for r in shared.with_few(table, few, "id").collect()}
    assert found == {i: 2 * i if i % 7 == 3 else None for i in range(500)}
    assert shared.without(table, keys.where("false"), "id").count() == 500
