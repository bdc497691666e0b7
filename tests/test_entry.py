"""Driver contract: entry smoke check and every query against its DuckDB oracle (sf0.001)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# queries of the training-data subpackage are tested beside it
OWN = {n: f for n, f in entry.queries().items() if n not in entry._training_data()[0]}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "monthly_avg_temperature_normal" in df.columns


def test_every_query_has_oracle():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry._training_data()[1])


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    duck_types = {d[0]: str(d[1]).upper() for d in res.description}
    for col, spark_type in df.dtypes:
        assert SPARK_TO_DUCK.get(spark_type, spark_type.upper()) == duck_types[col], col
    assert canonical(df.columns, rows) == canonical(ocols, orows)


def test_month_slice_takes_the_latest_month_of_the_data(spark, monkeypatch):
    rows = spark.sql("""SELECT concat('S', s) AS station_id, concat('N', s) AS station_name,
        CAST(1 AS DECIMAL(8,2)) AS elevation, CAST(2 AS DECIMAL(10,6)) AS latitude,
        CAST(3 AS DECIMAL(10,6)) AS longitude, d AS norm_date,
        CAST(4 AS DECIMAL(7,2)) AS dly_tmin_normal, CAST(5 AS DECIMAL(7,2)) AS dly_tmax_normal,
        CAST(6 AS DECIMAL(10,2)) AS mtd_prcp_normal
        FROM (SELECT explode(array(1, 2)) AS s), (SELECT explode(array(DATE'2023-11-30',
        DATE'2024-01-02', DATE'2024-03-04', DATE'2024-03-05')) AS d)""")
    monkeypatch.setattr(entry, "event_staging", lambda spark, sf: {"staging": rows})
    got = entry.month_slice(spark, SF_SMALL).collect()
    assert sorted((r.station_id, r.date_key) for r in got) == [
        (s, d) for s in ("S1", "S2") for d in (20240304, 20240305)]
