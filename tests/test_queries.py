import glob
import os

import duckdb
import pytest

from roadweave.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    d = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        d.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return d


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(got)
        return
    want = duck.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = lambda df: sorted(map(str, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))
    same = lambda df: df.assign(**{c: df[c].astype(float) for c in columns if str(df[c].dtype).lower().startswith(("int", "float"))})
    assert rows(same(got)) == rows(same(want))
