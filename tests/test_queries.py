"""Every registered query against its SQL twin, and rules about plans."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from testbed import oracle, registry
from tests.conftest import SF_DIR, plan_of

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return f"{value + 0.0:.6f}"
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    relation = duck.execute(ORACLE[name])
    expected = table([c[0] for c in relation.description], relation.fetchall())
    got = table(df.columns, [tuple(r) for r in df.collect()])
    assert got == expected
    assert got[1], "a query over the test tables must find something"


def test_entry(spark):
    assert entry.entry(spark).columns[-2:] == ["index_by_class", "scaled_index"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "NestedLoop", "Python", "MapInPandas"):
        assert node not in plan


def executed(plan: str) -> str:
    """The plan text without the initial plans that adaptive execution replaced."""
    kept, skipped = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth >= skipped:
            continue
        skipped = depth if "== Initial Plan ==" in line else None
        if skipped is None:
            kept.append(line)
    return "\n".join(kept)


def test_index_reads_the_large_table_once(spark, sf_dir):
    df = QUERIES["country_index_scaled"](spark, sf_dir)
    df.collect()
    final = executed(plan_of(df))
    assert final.count("FileScan parquet [l_orderkey") == 1
    assert "ReusedExchange" in final


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["code_counts"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan
