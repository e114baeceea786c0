"""Tables that are replaced as a whole or not at all."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from labelloom.sources import commit, tables


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a\nb", "x"), (2, "c", "y")], "doc_id bigint, text string, label string")


def failing(df):
    return df.withColumn("text", F.when(F.col("doc_id") == 2, F.raise_error(F.lit("out of luck"))).otherwise(F.col("text")))


def names(folder):
    return sorted(p.name for p in Path(folder).iterdir() if not p.name.startswith("."))


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_a_failed_job_leaves_the_old_table(spark, rows, tmp_path, file_format):
    path = str(tmp_path / "t")
    tables.write_table(rows, path, file_format)
    before = names(path)
    with pytest.raises(Exception, match="out of luck"):
        tables.write_table(failing(rows), path, file_format)
    with pytest.raises(Exception, match="out of luck"):
        tables.write_splits(failing(rows).withColumn("split", F.lit("train")), path, file_format)
    assert names(path) == before and names(tmp_path) == ["t"]
    assert tables.write_table(rows.where("doc_id = 1"), path, file_format) == path
    assert names(tmp_path) == ["t"]


def test_a_table_may_be_replaced_by_what_is_made_of_it(spark, rows, tmp_path):
    path = tables.write_table(rows, str(tmp_path / "t"))
    for left in (1, 0):
        tables.write_table(tables.read_parquet(spark, path).where(f"doc_id <= {left}"), path)
        assert tables.read_parquet(spark, path).count() == left


def test_reports_are_replaced_as_well(spark, tmp_path):
    report = spark.createDataFrame([("s", "i", 1.0)], "section string, item string, value double")
    path = tables.write_report(report, str(tmp_path / "r"))
    with pytest.raises(Exception, match="out of luck"):
        tables.write_report(report.withColumn("value", F.raise_error(F.lit("out of luck")).cast("double")), path)
    assert tables.read_report(spark, path).count() == 1


@pytest.mark.parametrize("finished", [True, False])
def test_a_program_that_died_between_the_renames(spark, rows, tmp_path, finished):
    path = tmp_path / "t"
    tables.write_table(rows, str(path))
    path.rename(tmp_path / f"t{commit.OLD}1")
    tables.write_table(rows.where("doc_id = 1"), str(tmp_path / "other"))
    (tmp_path / "other").rename(tmp_path / f"t{commit.NEW}1")
    if not finished:
        (tmp_path / f"t{commit.NEW}1" / commit.DONE).unlink()
    assert tables.read_parquet(spark, str(path)).count() == (1 if finished else 2)
    tables.write_table(rows, str(path))
    assert names(tmp_path) == ["t"]


def test_a_rename_that_fails_puts_the_old_table_back(spark, rows, tmp_path, monkeypatch):
    path = tables.write_table(rows, str(tmp_path / "t"))
    rename = commit._rename

    def refuse(spark, source, target):
        if commit.NEW in source:
            raise OSError("refused")
        rename(spark, source, target)

    monkeypatch.setattr(commit, "_rename", refuse)
    monkeypatch.setattr(commit, "_beside", lambda spark, path, mark, of=commit._beside: [] if mark == commit.NEW else of(spark, path, mark))
    with pytest.raises(OSError, match="refused"):
        tables.write_table(rows.where("doc_id = 1"), path)
    assert tables.read_parquet(spark, path).count() == 2


def test_one_document_on_disk(spark, tmp_path):
    report = spark.createDataFrame([("s", "i", 1.0), ("s", "j", 2.5)], "section string, item string, value double")
    path = str(tmp_path / "report.json")
    for policy in "DA":
        assert tables.write_document(report, path, {"policy": policy}) == path
        assert json.loads(Path(path).read_text("utf-8")) == {"policy": policy, "report": {"s": {"i": 1, "j": 2.5}}}
    assert names(tmp_path) == ["report.json"]
