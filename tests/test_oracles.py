"""Every query against its SQL oracle on the smallest test tables."""

import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from presslens.catalog.inputs import DRIVER_TABLES
from presslens.catalog.models import stored_model
from presslens.plans import training

QUERIES, ORACLES = queries(), oracle_sql()
#: Optional text operators; what SQL cannot express there has tests of its own.
OPTIONAL = {n for n in QUERIES if re.match(r"op[0-9]+_|pipeline$", n)}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def cells(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = [tuple(None if r[i] is None else (r[i] + 0.0 if isinstance(r[i], float) else r[i]) for i in order) for r in rows]
    return sorted(clean, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    expected = cells(cursor.fetchall(), names)
    assert sorted(frame.columns) == sorted(names)
    assert cells([tuple(r) for r in frame.collect()], frame.columns) == expected


def test_every_query_is_checked():
    assert not set(QUERIES) - set(ORACLES) - OPTIONAL
    assert not set(ORACLES) - set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_trained_probabilities(spark, sf_dir):
    model, known = stored_model(spark, sf_dir)
    rows = training.predict(model, known, ["browser_id"]).collect()
    assert rows
    for row in rows:
        values = [v for k, v in row.asDict().items() if k.endswith("_probability")]
        assert abs(sum(values) - 1) < 1e-9 and all(0 <= v <= 1 for v in values)
        best = max((v, k) for k, v in row.asDict().items() if k.endswith("_probability"))[0]
        assert row[f"{row.predicted_outcome}_probability"] == pytest.approx(best)
