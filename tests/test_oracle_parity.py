"""All Spark queries that have a DuckDB oracle against it, at sf0.001."""

import duckdb
import pytest

from listenlens.plans import all_queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
NAMES = [n for n, q in all_queries().items() if q.sql is not None]


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = [tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(norm, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    q = all_queries()[name]
    df = q.build(spark, SF)
    rel = con.sql(q.sql)
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(rel.fetchall(), rel.columns)
