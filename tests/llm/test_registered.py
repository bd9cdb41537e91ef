import duckdb
import pytest
from support import HAVE_TABLES, SF

import __spark_entry__ as registry
import corpus_pipeline
from marquee.llm.queries import QUERIES, SQL

pytestmark = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")


def plain(rows, order):
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result, want = QUERIES[name](spark, SF), con.sql(SQL[name])
    assert sorted(result.columns) == sorted(want.columns)
    assert plain(result.collect(), [result.columns.index(c) for c in want.columns]) == plain(
        want.fetchall(), range(len(want.columns)))


def test_all_are_registered():
    names = set(registry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(registry.oracle_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]
