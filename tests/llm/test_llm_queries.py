"""The registered queries against SQL, and the pipeline against its stages by brute force."""

import os
from pathlib import Path

import pytest

import corpus_pipeline
import oracle
from labelloom.llm import oracles, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(oracles.all_sql()))
def test_query_matches_its_sql(spark, name):
    columns, types, rows = oracle.from_spark(queries.all_queries()[name](spark, SF_DIR))
    duck_columns, duck_types, duck_rows = oracle.from_duckdb(oracle.connect(SF_DIR), oracles.all_sql()[name])
    assert {c: TYPES[t] for c, t in zip(columns, types, strict=True)} == dict(zip(duck_columns, duck_types, strict=True))
    assert rows == duck_rows


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.all_queries()) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    from llm.test_chosen_path import brute_force

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(out)
        docs = spark.read.parquet(out)
        rows = docs.collect()
        if name == "best-fit packing":
            assert {r.doc_id for r in rows} == set(before)
            continue
        assert docs.columns == columns
        after = {r.doc_id: r for r in rows}
        assert set(after) <= set(before) and len(after) == len(rows)
        if name == "quality rules":
            kept = {r.doc_id for r in queries.op2_host_quality(spark, SF_DIR).where("kept").collect()}
            assert set(after) == kept
        elif name == "exact dedup":
            assert set(after) == {min(i for i, o in before.items() if o.text.split() == r.text.split()) for r in before.values()}
        elif name == "n-gram Jaccard join":
            classes = brute_force([(i, r.text) for i, r in before.items()])
            assert set(after) == {least for least, _ in classes.values()}
        elif name == "substring dedup":
            assert all(len(r.text) <= len(before[i].text) and r.n_chars == len(r.text) for i, r in after.items())
    assert sorted(map(str, corpus_pipeline.run(spark, SF_DIR).select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(str, docs.select("doc_id", "piece", "ids_crc32").collect())
    )
