"""Every registered query against its SQL, run by DuckDB on the same files."""

import importlib.util
import math
import os
import re

import duckdb
import pytest
from conftest import ROOT, SMALL

_spec = importlib.util.spec_from_file_location(
    "spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
spark_entry = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(spark_entry)

# The training-data queries have tests of their own.
QUERIES = {n: q for n, q in spark_entry.queries().items()
           if n != "pipeline" and not re.match(r"op\d+_", n)}
ORACLE = {n: s for n, s in spark_entry.oracle_sql().items() if n in QUERIES}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    yield connection
    connection.close()


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if value is None or isinstance(value, float) and math.isnan(value):
            return ""
        return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    expected = duck.sql(ORACLE[name])
    assert {c: DUCK_TYPES[t] for c, t in frame.dtypes} \
        == dict(zip(expected.columns, map(str, expected.types)))
    got = normal(frame.columns, frame.collect())
    assert got == normal(expected.columns, expected.fetchall())
    assert got


def test_entry(spark):
    rows = spark_entry.entry(spark).orderBy("posicao").collect()
    assert len(rows) == 8 and rows[0].score == 100.0
