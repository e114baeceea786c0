"""CSV files that many tasks read, against the reader that takes a file as a whole."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from labelloom.sources import split_csv, tables

SCHEMA = "text string, label string"


@pytest.fixture
def small_ranges(spark):
    """Ranges of some tens of bytes, so that cuts fall everywhere."""

    def at(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def made(seed, n, line_end="\n"):
    """Rows of awkward texts, as a file."""
    rng = random.Random(seed)
    parts = ["word", '"', ",", "\n", "\n\n", " ", "é", "😀", "\\", '""', '",\n"', "x,y"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(12))), rng.choice("ab")) for _ in range(n)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end, quoting=csv.QUOTE_ALL)
    writer.writerow(["text", "label"])
    writer.writerows(rows)
    return rows, out.getvalue()


@pytest.mark.parametrize("size", [23, 150, 1 << 20])
def test_same_as_whole_files_wherever_the_cuts_are(spark, tmp_path, small_ranges, size):
    folder = tmp_path / "raw"
    folder.mkdir()
    expected = []
    for part in range(3):
        rows, text = made(part, 25)
        (folder / f"{part}.csv").write_text(text, "utf-8", newline="")
        expected += [((part << tables.ROWS_BITS) + k, *row) for k, row in enumerate(rows)]
    small_ranges(size)
    found = tables.read_csv(spark, str(folder), SCHEMA, order_column="place")
    assert [tuple(r) for r in found.orderBy("place").collect()] == expected
    whole = tables.read_csv(spark, str(folder), SCHEMA, order_column="place", whole_files=True)
    assert [tuple(r) for r in whole.orderBy("place").collect()] == expected
    if size < 1000:
        tasks = {r.task for r in found.select(F.spark_partition_id().alias("task")).collect()}
        assert len(tasks) > 3


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}, \"quoted\"" for i in range(60))
    path = tmp_path / "long.csv"
    out = io.StringIO()
    csv.writer(out).writerows([["text", "label"], ["before", "a"], [long, "b"], ["behind", "a"]])
    path.write_text(out.getvalue(), "utf-8", newline="")
    small_ranges(64)
    rows = tables.read_csv(spark, str(path), SCHEMA, order_column="place").orderBy("place").collect()
    assert [tuple(r) for r in rows] == [(0, "before", "a"), (1, long, "b"), (2, "behind", "a")]


@pytest.mark.parametrize(
    "content",
    [
        "text,label\n\n\na,b\n\n\"c\n\n\nd\",e\n\n",
        "text,label\r\n\"a\nb\",c\r\nd,e\r\n",
        "text,label\na,b",
        "text,label\na\n\"\",x,more\n,\n",
        "﻿text,label\na,b\n",
        'label,text\n"x","""quoted"""\n"y",""""\n',
        "te.xt,label,text\n1,2,3\n",
    ],
)
def test_odd_files(spark, tmp_path, small_ranges, content):
    path = tmp_path / "odd.csv"
    path.write_text(content, "utf-8", newline="")
    whole = [tuple(r) for r in tables.read_csv(spark, str(path), SCHEMA, order_column="place", whole_files=True).orderBy("place").collect()]
    for size in (7, 1 << 20):
        small_ranges(size)
        found = tables.read_csv(spark, str(path), SCHEMA, order_column="place").orderBy("place").collect()
        assert [tuple(r) for r in found] == whole


def test_breaks_inside_quotes_stay(spark, tmp_path, small_ranges):
    path = tmp_path / "windows.csv"
    path.write_bytes(b'text,label\r\n"a\r\nb\nc\r\n",d\r\n')
    small_ranges(5)
    assert [tuple(r) for r in tables.read_csv(spark, str(path), SCHEMA).collect()] == [("a\r\nb\nc\r\n", "d")]


def test_columns_in_paths(spark, tmp_path):
    rows = [("one\n\"x\"", "a", "tr ain/%+"), ("two", "b", "val"), ("three", "a", None)]
    df = spark.createDataFrame(rows, "text string, label string, split string")
    path = tables.write_splits(df, str(tmp_path / "s"), "csv") and str(tmp_path / "s")
    found = tables.read_csv(spark, path, "text string, label string, split string")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str)


def test_other_encodings(spark, tmp_path, small_ranges):
    path = tmp_path / "latin.csv"
    path.write_bytes('text,label\n"café\nà la",a\n'.encode("latin-1"))
    small_ranges(9)
    assert tables.read_csv(spark, str(path), encoding="ISO-8859-1").first()["text"] == "café\nà la"
    assert not split_csv.can_split("UTF-16")


def test_nothing_but_parts_is_shuffled(spark, tmp_path):
    rows, text = made(1, 50)
    (tmp_path / "a.csv").write_text(text, "utf-8", newline="")
    found = split_csv.records(spark, str(tmp_path / "a.csv"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
