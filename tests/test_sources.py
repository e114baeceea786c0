"""Reading, writing and settings."""

import json

import pytest

from labelloom import Roles
from labelloom.operators import policies
from labelloom.sources import tables
from labelloom.sources.config import SplitSettings

AWKWARD = [
    (0, 'quote " inside', "a"),
    (1, "line\nbreak, comma", "b"),
    (2, "", "a"),
    (3, "  padded  ", "b"),
    (4, "back\\slash", "a"),
    (5, "NA", "b"),
    (6, "ünï😀", "a"),
]
SCHEMA = "doc_id bigint, text string, label string"


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_round_trip(spark, awkward, tmp_path, file_format):
    path = tables.write_table(awkward, str(tmp_path / "t"), file_format)
    back = tables.read_csv(spark, path, SCHEMA) if file_format == "csv" else tables.read_parquet(spark, path)
    assert sorted(map(tuple, back.collect())) == AWKWARD


def test_csv_from_elsewhere(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('label,text\na,"two\nlines with ""quotes"""\nb,NA\nc,\n', "utf-8")
    rows = tables.read_csv(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [('two\nlines with "quotes"', "a"), ("NA", "b"), (None, "c")]
    assert tables.read_csv(spark, str(path), null_value="NA").where("text is null").count() == 2
    path.write_bytes("text,label\ncafé,a\n".encode("latin-1"))
    assert tables.read_csv(spark, str(path), encoding="ISO-8859-1").first()["text"] == "café"


def test_missing_empty_and_incomplete_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        tables.read_parquet(spark, str(tmp_path / "none"))
    (tmp_path / "header.csv").write_text("text,label\n")
    with pytest.raises(ValueError, match="empty"):
        tables.read_csv(spark, str(tmp_path / "header.csv"))
    (tmp_path / "zero.csv").write_text("")
    with pytest.raises(ValueError, match="empty"):
        tables.read_csv(spark, str(tmp_path / "zero.csv"))
    (tmp_path / "short.csv").write_text("text\nx\n")
    with pytest.raises(ValueError, match="label"):
        tables.read_csv(spark, str(tmp_path / "short.csv"))


def test_clean_source(spark, awkward, tmp_path):
    good = tables.write_table(awkward, str(tmp_path / "good"))
    assert tables.read_clean(spark, good).count() == 7
    twice = tables.write_table(awkward.unionByName(awkward.limit(1)), str(tmp_path / "twice"))
    with pytest.raises(ValueError, match="not unique"):
        tables.read_clean(spark, twice)
    with pytest.raises(ValueError, match="other"):
        tables.read_clean(spark, good, Roles(label="other"))
    with pytest.raises(ValueError, match="empty"):
        tables.read_clean(spark, tables.write_table(awkward.limit(0), str(tmp_path / "nothing")))
    csv = tables.write_table(awkward, str(tmp_path / "csv"), "csv")
    assert tables.read_clean(spark, csv, file_format="csv", schema=SCHEMA).count() == 7


def test_unknown_formats(spark, awkward, tmp_path):
    with pytest.raises(ValueError):
        tables.write_table(awkward, str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError):
        tables.read_clean(spark, str(tmp_path), file_format="xml")


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_splits(spark, awkward, tmp_path, file_format):
    from pyspark.sql import functions as F

    df = awkward.withColumn("split", F.when(F.col("doc_id") < 4, "train").when(F.col("doc_id") == 4, "val").otherwise("test"))
    paths = tables.write_splits(df, str(tmp_path / "s"), file_format)
    back = tables.read_splits(spark, str(tmp_path / "s"), file_format, awkward.schema)
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    if file_format == "parquet":
        assert spark.read.parquet(paths["train"]).count() == 4


def test_report_documents(spark, tmp_path):
    rows = [("s1", "x", 1.0), ("s1", "y", 2.5), ("s2", "z", 0.0)]
    report = spark.createDataFrame(rows, "section string, item string, value double")
    path = tables.write_report(report, str(tmp_path / "r"), {"policy": "D"})
    assert sorted(map(tuple, tables.read_report(spark, path).collect())) == rows
    assert tables.read_notes(spark, tables.write_report(report, path, {"seed": 7, "flag": True, "policy": "D"})) == {
        "seed": 7.0, "flag": "True", "policy": "D",
    }
    text = tables.report_document(report, {"policy": "D"})
    assert "\n" in text and json.loads(text) == {"policy": "D", "report": {"s1": {"x": 1, "y": 2.5}, "s2": {"z": 0}}}
    clash = spark.createDataFrame([("c", "null", 1.0), ("c", "accuracy", 2.0), ("c", "accuracy", 3.0)], report.schema)
    assert tables.read_report(spark, tables.write_report(clash, path)).count() == 3


def test_settings(tmp_path):
    assert SplitSettings.from_json(tmp_path / "none.json") == SplitSettings()
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"random_seed": 7, "text_column": "t"}))
    settings = SplitSettings.from_json(path)
    assert (settings.random_seed, settings.train_ratio, settings.roles.text) == (7, 0.8, "t")
    theirs = {"stratify": True, "train_output": "a", "val_output": "b", "test_output": "c", "source_dataset": "x/clean.csv"}
    assert SplitSettings.from_mapping(theirs).format_of_source == "csv"
    with pytest.raises(ValueError, match="stratified"):
        SplitSettings.from_mapping({"stratify": False})
    with pytest.raises(ValueError, match="sed"):
        SplitSettings.from_mapping({"sed": 1})


def test_csv_files_give_an_order(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    rows = [(f"text {i}, \"quoted\"\nline", "ab"[i % 2]) for i in range(60)]
    for part in range(4):
        lines = [f'"{t.replace(chr(34), chr(34) * 2)}",{label}' for t, label in rows[part * 15 : part * 15 + 15]]
        (folder / f"{part}.csv").write_text("tweet,kind\n" + "\n".join(lines) + "\n", "utf-8")
    read = lambda: tables.read_csv(spark, str(folder), "tweet string, kind string", order_column="place")
    got = [tuple(r) for r in read().orderBy("place").collect()]
    assert [r[1:] for r in got] == rows and len({r[0] for r in got}) == 60
    assert [r[0] for r in got] == [(i // 15) * (1 << tables.ROWS_BITS) + i % 15 for i in range(60)]
    assert [tuple(r) for r in read().repartition(7).orderBy("place").collect()] == got


def test_parquet_files_give_an_order(spark, tmp_path):
    rows = [(f"text {i % 40}", "ab"[i % 2]) for i in range(400)]
    path = str(tmp_path / "t")
    for part in range(4):
        spark.createDataFrame(rows[part * 100 : part * 100 + 100], "text string, label string").coalesce(1).write.mode("append").parquet(path)

    def kept(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = tables.read_parquet(spark, path, order_column="place")
            assert df.columns == ["place", "text", "label"] and df.select("place").distinct().count() == 400
            return sorted(map(tuple, policies.policy_b(df, Roles(order="place")).collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

    first = kept(1 << 27)
    assert len(first) == 40 and first == kept(1 << 27) == kept(300)
    by_file = {r.place >> tables.ROWS_BITS for r in tables.read_parquet(spark, path, order_column="place").collect()}
    assert by_file == set(range(4))
    # Within a file the order is that of its rows.
    one = tables.read_parquet(spark, tables.write_table(spark.range(50).coalesce(1), str(tmp_path / "one")), ["place", "id"], "place")
    assert [tuple(r) for r in one.orderBy("place").collect()] == [(i, i) for i in range(50)]
    assert tables.read_parquet(spark, path, order_column="text").columns == ["text", "label"]
