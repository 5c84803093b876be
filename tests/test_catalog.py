import os

import duckdb
import pytest

from evigrid import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(getattr(v, "replace", lambda **_: v)(tzinfo=None) if hasattr(v, "tzinfo") else v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_same_rows_as_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    found = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in found.description]
    columns = sorted(df.columns)
    assert columns == sorted(names)
    want = sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def test_flagship(spark):
    assert catalog.flagship(spark, SF).count() > 0
