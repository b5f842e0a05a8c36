"""Every registered query of the library against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from civitas.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda x: None if x is None or x != x else round(float(x), 6) if isinstance(x, float) else x.item() if hasattr(x, "item") else x
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None)), key=repr)


def same(a, b):
    return all(x == y or (isinstance(x, (int, float)) and isinstance(y, (int, float)) and math.isclose(x, y, abs_tol=1e-6)) for x, y in zip(a, b, strict=True))


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    got = registry.queries()[name](spark, SF).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b) and all(map(same, a, b))
