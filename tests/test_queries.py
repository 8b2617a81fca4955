"""Every query of the catalog at sf0.001 against its SQL."""

import datetime
import decimal
import os
from pathlib import Path

import duckdb
import pytest

from annoforge.plans import catalog

DIR = Path(os.environ.get("TESTDATA_DIR", "/root/testdata")) / "sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DIR.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return f"{v:.9g}" if v else "0"
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, str(DIR))
    found = duck.sql(catalog.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    want = sorted(tuple(map(plain, r)) for r in found.select(*[f'"{c}"' for c in columns]).fetchall())
    assert got == want


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[:3] == ["threshold", "image_id", "prediction_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
