"""Every query that has SQL, against DuckDB on the same files."""

import math

import duckdb
import pytest
from conftest import SF_DIR

from revenue_lens.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(rows):
    cell = lambda v: "NULL" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v)
    return sorted(tuple(cell(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    cursor = duck.execute(ORACLES[name])
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    columns = sorted(expected_types)
    order = [[d[0] for d in cursor.description].index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    result = QUERIES[name](spark, SF_DIR)
    assert {c: TYPES[t] for c, t in result.dtypes} == expected_types
    found = [tuple(r) for r in result.select(columns).collect()]
    assert canonical(found) == canonical(expected)
    assert expected, "an empty result checks nothing"


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["customer_features", "rfm_segments", "cohort_retention_long", "drift_report", "roc_auc", "stratified_split", "weekly_revenue_by_nation"])
def test_partition_count_does_not_change_results(spark, name):
    result = {}
    for partitions, coalesce in (("1", "true"), ("8", "false")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        df = QUERIES[name](spark, SF_DIR)
        result[partitions] = canonical(tuple(r) for r in df.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert result["1"] == result["8"]
