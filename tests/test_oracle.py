"""Every registered query against its SQL on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

from forecourt.standins import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return db


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    return None if isinstance(v, float) and math.isnan(v) else v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in cursor.description], cursor.fetchall())
