"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_point
from tickstream.plans.oracle import ORACLE
from tickstream.plans.registry import QUERIES

DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows),
                  key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    ours = {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert ours == theirs

    got = ordered(df.select(*columns).collect())
    names = ", ".join(f'"{c}"' for c in columns)
    want = ordered(duck.sql(f"SELECT {names} FROM ({ORACLE[name]})").fetchall())
    assert len(got) == len(want) > 0
    assert got == want


def test_entry(spark):
    out = entry_point.entry(spark)
    assert out.count() == 20
    assert "is_anomaly" in out.columns
