"""Every registered query against its SQL, on the driver's tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
import oracle
from catalog import oracles, settings
from catalog import queries as registered
from labelloom.operators import features

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registered.all_queries(), oracles.all_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_names_agree():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"model_benchmark", "selected_model", "test_evaluation"}


def test_entry_imports_where_spark_has_no_jars(tmp_path):
    (tmp_path / "pyspark").mkdir()
    code = f"""import pyspark
pyspark.__file__ = {str(tmp_path / "pyspark" / "__init__.py")!r}
import __spark_entry__ as e
assert set(e.oracle_sql()) <= set(e.queries())
print(len(e.queries()), len(e.oracle_sql()))"""
    repo = str(Path(driver.__file__).resolve().parent)
    env = {k: v for k, v in os.environ.items() if k != "SPARK_HOME"} | {"PYTHONPATH": repo}
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
    n_queries, n_sql = map(int, found.stdout.split())
    assert n_queries >= len(QUERIES) and n_sql >= len(SQL)


def test_stop_words_are_the_operators_own(spark):
    assert settings.stop_words() == features.default_stop_words()


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["doc_id", "text", "label"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, duck, name):
    columns, types, rows = oracle.from_spark(QUERIES[name](spark, SF_DIR))
    duck_columns, duck_types, duck_rows = oracle.from_duckdb(duck, SQL[name])
    assert sorted(columns) == sorted(duck_columns)
    assert {c: TYPES[t] for c, t in zip(columns, types)} == dict(zip(duck_columns, duck_types))
    assert rows == duck_rows


@pytest.mark.parametrize("name, n", [("model_benchmark", 4), ("selected_model", 1), ("test_evaluation", 1)])
def test_models_run(spark, name, n):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert len(rows) == n and all(0 <= r["accuracy"] <= 1 for r in rows)
