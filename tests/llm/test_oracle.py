"""Every query of the subpackage that has SQL, against it."""

from collections import Counter

import duckdb
import pytest

from sheetloom import scratch
from sheetloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, modules, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = Counter(tuple(r[c] for c in columns) for r in got.collect())
    found = database.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert rows == Counter(tuple(r[i] for i in places) for r in found.fetchall())
    assert rows


@pytest.mark.parametrize("name", ["op1_line_dedup", "op4_fingerprints", "op7_sharding", "op10_simhash", "op11_merkle"])
def test_nothing_is_left_of_a_query(spark, modules, tmp_path, name):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with scratch(spark, str(tmp_path)):
        assert QUERIES[name](spark, SF).count() == 200
        assert list(tmp_path.iterdir())
    assert not list(tmp_path.iterdir())
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
