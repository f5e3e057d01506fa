"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""
from __future__ import annotations

import pytest

import __spark_entry__ as entry
from paths import SF_SMALL

from tools.check_oracle import digest

SQL = entry.oracle_sql()
# Spark simple type -> DuckDB type name
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    o_types = {d[0]: str(d[1]) for d in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert TYPES.get(t, t.upper()) == o_types[f.name], (f.name, t, o_types[f.name])
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_every_query_runs_and_sql_keys_are_queries(spark):
    qs = entry.queries()
    assert set(SQL) <= set(qs)
    for name in sorted(set(qs) - set(SQL)):
        assert qs[name](spark, SF_SMALL).count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["seller", "amount", "units"]
    assert df.count() > 0
