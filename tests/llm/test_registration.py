"""Registration, the DuckDB forms, and plans of the training-data queries."""

import inspect
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from dimfold.llm import queries

DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels")


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, len(queries.QUERIES) + 1))
    registered = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered) and registered["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLE) <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS FROM read_parquet('{DIR}/{t}.parquet')")
    want = db.sql(queries.ORACLE[name]).to_arrow_table()
    got = queries.QUERIES[name](spark, DIR).toArrow()
    assert sorted(got.column_names) == sorted(want.column_names)
    types = lambda t: {f.name: str(f.type).replace("large_", "") for f in t.schema}
    assert types(got) == types(want)
    rows = lambda t: sorted((tuple(r[c] for c in sorted(r)) for r in t.to_pylist()), key=repr)
    assert rows(got) == rows(want) and got.num_rows


def test_no_query_limits_its_tables():
    """No query function samples, filters or caps what it reads."""
    for f in queries.QUERIES.values():
        body = inspect.getsource(f)
        assert not re.search(r"\.(limit|sample|where|filter)\(", body)
