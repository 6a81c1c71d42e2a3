"""Every registered query against its DuckDB oracle, as the driver checks it.

sf0.01 is the driver's correctness scale; sf0.001 is checked as well because
rare classes can be empty there.
"""

import importlib.util
import os

import pytest

from starlens.plans.catalog import QUERIES
from starlens.plans.oracle import ORACLE_SQL
from starlens.plans.verify import compare, duckdb_connection
from tests.conftest import ROOT, SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def duck_small():
    return duckdb_connection(SF_SMALL)


@pytest.fixture(scope="module")
def duck_check():
    return duckdb_connection(SF_CHECK)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle_sf0_01(spark, duck_check, key):
    res = compare(QUERIES[key](spark, SF_CHECK).toArrow(), duck_check.sql(ORACLE_SQL[key]).to_arrow_table(), key)
    assert res.ok, res.detail


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle_sf0_001(spark, duck_small, key):
    res = compare(QUERIES[key](spark, SF_SMALL).toArrow(), duck_small.sql(ORACLE_SQL[key]).to_arrow_table(), key)
    assert res.ok, res.detail


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "customer_key", "customer_number", "customer_name", "customer_age", "age_groups",
        "customer_segment", "total_orders", "total_sales", "total_qty", "total_products",
        "last_order_date", "lifespan", "recency", "AVO", "AMS",
    ]
    assert set(QUERIES) <= set(mod.oracle_sql()) <= set(mod.queries())


OTHER_SESSION = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.session.timeZone": "America/Los_Angeles",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "200",
}


def test_results_do_not_depend_on_session_settings(spark, duck_small):
    """A driver session may differ from build_session; answers must not."""
    saved = {k: spark.conf.get(k, None) for k in OTHER_SESSION}
    try:
        for k, v in OTHER_SESSION.items():
            spark.conf.set(k, v)
        bad = []
        for key in sorted(QUERIES):
            res = compare(
                QUERIES[key](spark, SF_SMALL).toArrow(), duck_small.sql(ORACLE_SQL[key]).to_arrow_table(), key
            )
            if not res.ok:
                bad.append((key, res.detail))
        assert not bad, bad
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_every_query_on_an_unpartitioned_and_a_lazy_star(spark, duck_small, scratch):
    """The same answers whether the fact is year-partitioned, flat, or derived per query."""
    from starlens.plans.catalog import BY_STAR
    from starlens.sources.star import read_star, star_from_tables, write_star

    lazy = star_from_tables(spark, SF_SMALL)
    write_star(lazy, f"{scratch}/flat", partition_by_year=False)
    flat = read_star(spark, f"{scratch}/flat")
    assert flat.fact_by_year is None and lazy.fact_by_year is None
    bad = []
    for name, star in (("flat", flat), ("lazy", lazy)):
        for key, fn in BY_STAR.items():
            res = compare(fn(star).toArrow(), duck_small.sql(ORACLE_SQL[key]).to_arrow_table(), key)
            if not res.ok:
                bad.append((name, key, res.detail))
    assert not bad, bad
