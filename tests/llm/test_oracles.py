"""The SQL of this subpackage's queries, run by DuckDB, against the queries; and every query's columns."""

import duckdb
import pytest

from tidelake.llm import registry

SF = "/root/testdata/sf0.001"


def value(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(value(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(registry.ORACLE_SQL[name])
    want = rows([d[0] for d in found.description], found.fetchall())
    df = registry.QUERIES[name](spark, SF)
    assert want and rows(df.columns, df.collect()) == want
