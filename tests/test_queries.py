"""Every registered query against its SQL in DuckDB, or at least to its end."""

import duckdb
import pytest

from noticelake.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(round(float(v), 6) if type(v).__name__ in ("float", "Decimal") else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = plain(df.select(*columns).collect())
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        names = [d[0] for d in result.description]
        at = [names.index(c) for c in columns]
        assert sorted(names) == columns
        assert got == plain(tuple(r[k] for k in at) for r in result.fetchall())
    else:
        assert got
