"""Registered text queries against their SQL on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tests.conftest import SF_DIR
from tickstream.llm.queries import ORACLE, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_all_are_registered():
    names = sorted(QUERIES)
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == theirs
    names = ", ".join(f'"{c}"' for c in columns)
    got = ordered(df.select(*columns).collect())
    assert got == ordered(duck.sql(f"SELECT {names} FROM ({ORACLE[name]})").fetchall()) and got
