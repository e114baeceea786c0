"""The commands from end to end on CSV files."""

import json
import subprocess
import sys
from pathlib import Path

import pytest

from labelloom.__main__ import main
from labelloom.sources import tables

REPO = str(Path(__file__).resolve().parent.parent)


@pytest.fixture
def raw(tmp_path):
    """Sixty texts, two of them contradictory and one repeated, in a file without an order column."""
    rows = [(f'text {i}, ""quoted""\nline', "abc"[i % 3]) for i in range(60)]
    rows += [('text 3, ""quoted""\nline', "b"), ('text 5, ""quoted""\nline', "a"), ('text 7, ""quoted""\nline', "b")]
    path = tmp_path / "raw.csv"
    path.write_text("tweet,kind\n" + "".join(f'"{t}",{k}\n' for t, k in rows), "utf-8", newline="")
    return path


COLUMNS = ["--text", "tweet", "--label", "kind"]


def test_clean_and_split(spark, raw, tmp_path):
    clean, report, document = (str(tmp_path / n) for n in ("clean", "report", "report.json"))
    assert main(["clean", str(raw), clean, report, *COLUMNS, "--document", document]) == 0
    table = spark.read.parquet(clean)
    assert table.count() == 58 and set(table.columns) == {"doc_id", "tweet", "kind"}
    found = json.loads(Path(document).read_text("utf-8"))
    assert found["policy"] == "D" and found["source_file"] == str(raw)
    values = {(r["section"], r["item"]): r["value"] for r in tables.read_report(spark, report).collect()}
    (section, item), value = next((k, v) for k, v in values.items() if v == 58)
    expected = tmp_path / "expected.json"
    for off, status in ((0, 0), (1, 1)):
        expected.write_text(json.dumps({section: {item: value + off}}))
        assert main(["clean", str(raw), clean, report, *COLUMNS, "--expected", str(expected)]) == status

    settings = tmp_path / "split.json"
    settings.write_text(
        json.dumps({"text_column": "tweet", "label_column": "kind", "source_dataset": clean, "split_output": str(tmp_path / "splits"), "report_output": str(tmp_path / "split_report")})
    )
    assert main(["split", str(settings), "--document", str(tmp_path / "split_report.json")]) == 0
    assert spark.read.parquet(str(tmp_path / "splits")).count() == 58
    assert json.loads((tmp_path / "split_report.json").read_text("utf-8"))["status"] == "COMPLETED"


def test_reports(spark, raw, tmp_path):
    assert main(["report", str(raw), str(tmp_path / "reports"), *COLUMNS, "--document", str(tmp_path / "all.json")]) == 0
    assert sorted(p.name for p in tmp_path.glob("all-*.json")) == ["all-duplicates.json", "all-policy_impact.json", "all-profile.json"]
    totals = json.loads((tmp_path / "all-profile.json").read_text("utf-8"))["report"]["totals"]
    assert totals["n_rows"] == 63 and totals["texts_with_conflicting_labels"] == 2


def test_what_is_wrong_gives_status_one(spark, raw, tmp_path, capsys):
    for wrong in (
        ["clean", str(tmp_path / "none.csv"), "a", "b"],
        ["clean", str(raw), str(tmp_path / "a"), str(tmp_path / "b")],
        ["split", str(tmp_path / "none.json")],
    ):
        assert main(wrong) == 1
        assert capsys.readouterr().err.strip()
    with pytest.raises(SystemExit) as usage:
        main(["tidy"])
    assert usage.value.code == 2


def test_as_a_module(raw):
    found = subprocess.run([sys.executable, "-m", "labelloom", "--help"], cwd=REPO, capture_output=True, text=True)
    assert found.returncode == 0 and all(name in found.stdout for name in ("clean", "split", "report"))
