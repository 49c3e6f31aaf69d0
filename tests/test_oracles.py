"""Every query against its SQL in DuckDB on the smallest tables."""

import datetime
import decimal
import math
import os

import pytest

from terravane import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from pathlib import Path

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float) and math.isnan(x):
        return "nan"
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    names = want.columns
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(names, map(str, want.types), strict=True))
    a, b = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(names, want.fetchall())
    assert len(a) == len(b)
    different = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not different, different[:3]


def test_every_query_is_known():
    without = set(catalog.queries()) - set(catalog.oracle_sql())
    assert without == {"track_hypotheses", "intake_greedy_dedup", "match_scores", "ellipsoid_pairs", "kmeans_profiles", "identity_edges", "identity_assets"}
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


def test_names_are_unique():
    names = [n for m in catalog._MODULES for n in m.QUERIES]
    assert len(names) == len(set(names))
    assert all(set(m.SQL) <= set(m.QUERIES) for m in catalog._MODULES)
