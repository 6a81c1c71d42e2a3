"""Star sources and report sinks."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from starlens.operators import report_customers
from starlens.plans import catalog as cat
from starlens.session import checkpoint_root
from starlens.sources import (
    Star,
    drop_report,
    drop_view,
    materialize,
    publish_report,
    published,
    read_materialized,
    read_star,
    register,
    remove_superseded,
    star_from_tables,
    write_star,
)
from starlens.sources.schemas import DIM_CUSTOMERS, DIM_PRODUCTS, FACT_SALES
from tests.conftest import SF_SMALL


def test_derived_star_has_declared_schemas(spark):
    s = cat.star(spark, SF_SMALL)
    assert [f.name for f in s.fact_sales.schema] == FACT_SALES.fieldNames()
    assert [f.dataType for f in s.fact_sales.schema] == [f.dataType for f in FACT_SALES]
    assert [f.dataType for f in s.dim_products.schema] == [f.dataType for f in DIM_PRODUCTS]
    assert [f.dataType for f in s.dim_customers.schema] == [f.dataType for f in DIM_CUSTOMERS]


def test_write_then_read_star_roundtrip(spark, scratch):
    s = cat.star(spark, SF_SMALL)
    write_star(s, f"{scratch}/gold")
    g = read_star(spark, f"{scratch}/gold")
    assert g.fact_sales.count() == s.fact_sales.count()
    assert g.fact_sales.agg(F.sum("sales_amount")).first()[0] == s.fact_sales.agg(F.sum("sales_amount")).first()[0]
    assert sorted(map(str, g.dim_products.collect())) == sorted(map(str, s.dim_products.collect()))
    assert sorted(map(str, g.dim_customers.collect())) == sorted(map(str, s.dim_customers.collect()))


def test_register_is_create_or_replace(spark):
    s = cat.star(spark, SF_SMALL)
    s.register(prefix="t_")
    n = spark.sql("SELECT COUNT(*) FROM t_fact_sales").first()[0]
    assert n == s.fact_sales.count()
    rep = report_customers(s.fact_sales, s.dim_customers, cat.AS_OF)
    register(rep, "report_customers")
    register(rep, "report_customers")  # replacing an existing view is fine
    k4 = spark.sql("SELECT age_groups, COUNT(customer_number) AS c FROM report_customers GROUP BY age_groups")
    assert k4.count() >= 1
    assert drop_view(spark, "report_customers") is True
    assert drop_view(spark, "report_customers") is False


def test_materialize_writes_under_the_shared_folder(spark):
    s = cat.star(spark, SF_SMALL)
    rep = report_customers(s.fact_sales, s.dim_customers, cat.AS_OF)
    out = materialize(rep, "report_customers_snapshot")
    assert sorted(map(str, out.collect())) == sorted(map(str, rep.collect()))
    files = out.inputFiles()
    assert files and all(checkpoint_root(spark).replace("file:", "") in f for f in files)
    assert spark.table("report_customers_snapshot").count() == out.count()


def test_missing_column_fails_fast(spark, scratch):
    for name in ("fact_sales", "dim_products", "dim_customers"):
        spark.range(3).write.parquet(f"{scratch}/bad/{name}")
    with pytest.raises(ValueError, match="missing columns"):
        read_star(spark, f"{scratch}/bad")


def test_materialized_star_is_written_once_and_reused(spark):
    from starlens.sources.star import _fingerprint, materialized_star, star_from_tables

    key = _fingerprint(spark, SF_SMALL)
    assert key and key == _fingerprint(spark, SF_SMALL)
    assert _fingerprint(spark, f"{SF_SMALL}/no-such-folder") is None
    first = materialized_star(spark, SF_SMALL)
    root = f"{checkpoint_root(spark)}/starlens/gold/{key}"
    assert published(spark, root) is not None
    files = first.fact_sales.inputFiles()
    assert files and all(f"/starlens/gold/{key}/builds/" in f for f in files)
    again = materialized_star(spark, SF_SMALL)
    assert sorted(again.fact_sales.inputFiles()) == sorted(files)  # read, not rebuilt
    lazy = star_from_tables(spark, SF_SMALL)
    assert sorted(map(str, again.fact_sales.collect())) == sorted(map(str, lazy.fact_sales.collect()))
    assert published(spark, f"{root}-missing") is None


def _copied_inputs(folder):
    from starlens.sources.star import RAW_TABLES

    for name in RAW_TABLES:
        os.makedirs(f"{folder}/{name}.parquet")
        shutil.copy(f"{SF_SMALL}/{name}.parquet", f"{folder}/{name}.parquet/part-0.parquet")
    return folder


def test_changed_inputs_give_a_new_star_in_the_same_application(spark, scratch):
    data = _copied_inputs(f"{scratch}/inputs")
    total = lambda: cat.QUERIES["overall_sales"](spark, data).first()[0]
    before = total()
    spark.read.parquet(f"{data}/lineitem.parquet").limit(100).write.mode("append").parquet(f"{data}/lineitem.parquet")
    assert total() > before
    lazy = star_from_tables(spark, data).fact_sales.agg(F.sum("sales_amount")).first()[0]
    assert total() == lazy


def _gold(spark, folder, year_of):
    """A gold layer this library did not write, its fact in ``order_year`` folders by the given rule."""
    s = star_from_tables(spark, SF_SMALL)
    s.fact_sales.withColumn("order_year", year_of).write.partitionBy("order_year").parquet(f"{folder}/fact_sales")
    s.dim_products.withColumn("colour", F.lit("red")).write.parquet(f"{folder}/dim_products")
    s.dim_customers.write.parquet(f"{folder}/dim_customers")
    return s


@pytest.mark.parametrize(
    "rule",
    [
        lambda: F.coalesce(F.year("order_date"), F.lit(1900)),  # a sentinel folder for undated rows
        lambda: F.when(F.month("order_date") > 6, F.year("order_date")),  # dated rows in the NULL folder
    ],
)
def test_foreign_year_folders_lose_no_rows(spark, scratch, rule):
    s = _gold(spark, f"{scratch}/gold", rule())
    gold = read_star(spark, f"{scratch}/gold")
    assert gold.fact_by_year is None
    for mine, theirs in ((gold.dated_sales(), s.dated_sales()), (gold.undated_sales(), s.undated_sales())):
        assert mine.count() == theirs.count() > 0
    assert cat.BY_STAR["null_date_sales"](gold).count() == s.undated_sales().count()
    # SELECT * keeps what this library doesn't name
    assert "colour" in cat.BY_STAR["scan_products"](gold).columns
    assert "order_year" in gold.fact_sales.columns


def test_text_order_numbers_are_fine_and_unusable_types_fail_at_read(spark, scratch):
    s = star_from_tables(spark, SF_SMALL)
    for folder, change in (("text", F.concat(F.lit("SO"), F.col("order_number"))), ("bad", F.array("order_number"))):
        s.fact_sales.withColumn("order_number", change).write.parquet(f"{scratch}/{folder}/fact_sales")
        s.dim_products.write.parquet(f"{scratch}/{folder}/dim_products")
        s.dim_customers.write.parquet(f"{scratch}/{folder}/dim_customers")
    gold = read_star(spark, f"{scratch}/text")
    orders = lambda star: sorted(r["total_orders"] for r in cat.BY_STAR["report_customers"](star).collect())
    assert orders(gold) == orders(s)
    with pytest.raises(ValueError, match="order_number"):
        read_star(spark, f"{scratch}/bad")


def test_readers_go_on_while_newer_builds_are_published(spark, scratch):
    s = star_from_tables(spark, SF_SMALL)
    write_star(s, f"{scratch}/gold")
    old = read_star(spark, f"{scratch}/gold")
    n = old.fact_sales.count()
    write_star(Star(s.fact_sales.limit(10), s.dim_products, s.dim_customers), f"{scratch}/gold")
    assert old.fact_sales.count() == n
    assert read_star(spark, f"{scratch}/gold").fact_sales.count() == 10
    assert remove_superseded(spark, f"{scratch}/gold") == 1
    assert remove_superseded(spark, f"{scratch}/gold") == 0
    assert read_star(spark, f"{scratch}/gold").fact_sales.count() == 10

    first = materialize(spark.range(5), "chain", f"{scratch}/chain")
    second = materialize(first.union(first), "chain", f"{scratch}/chain")  # rebuilt from itself
    assert (first.count(), second.count()) == (5, 10)
    assert read_materialized(spark, "chain", f"{scratch}/chain").count() == 10


def test_two_builders_of_one_star_both_finish(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    s = star_from_tables(spark, SF_SMALL)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda _: write_star(s, f"{scratch}/gold"), range(2)))
    assert read_star(spark, f"{scratch}/gold").fact_sales.count() == s.fact_sales.count()


def test_published_reports_are_read_by_name_in_other_sessions(spark):
    other = spark.newSession()
    publish_report(spark.range(3).toDF("n"), "starlens_test_report")
    held = other.table("starlens_test_report")
    assert held.count() == 3
    publish_report(spark.range(4).toDF("n"), "starlens_test_report")  # drop and recreate
    assert held.count() == 3
    assert other.sql("SELECT COUNT(*) FROM starlens_test_report").first()[0] == 4
    drop_report(spark, "starlens_test_report")
    drop_report(spark, "starlens_test_report")
    assert not other.catalog.tableExists("starlens_test_report")


def test_report_views_answer_the_reference_ad_hoc_sql(spark):
    """The reference queries its report views with plain SQL; so can Spark."""
    from starlens.operators import register_reports

    s = cat.star(spark, SF_SMALL)
    register_reports(
        s.fact_sales, s.dim_products, s.dim_customers, cat.AS_OF,
        high=cat.HIGH_PERFORMER, mid=cat.MID_RANGE, min_months=cat.MIN_MONTHS, vip_spending=cat.VIP_SPENDING,
    )
    k3 = spark.sql("SELECT * FROM report_customers WHERE customer_age BETWEEN 30 AND 39")
    k4 = spark.sql(
        "SELECT age_groups, COUNT(customer_number) AS total_customers, SUM(total_sales) AS total_sales "
        "FROM report_customers GROUP BY age_groups"
    )
    top = spark.sql("SELECT * FROM report_products ORDER BY product_key NULLS LAST LIMIT 10")
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(k3) == as_rows(cat.QUERIES["customers_aged_30_39"](spark, SF_SMALL))
    assert as_rows(k4) == as_rows(cat.QUERIES["age_group_summary"](spark, SF_SMALL))
    assert as_rows(top) == as_rows(cat.QUERIES["preview_report_products"](spark, SF_SMALL))
    with pytest.raises(TypeError):
        register_reports(s.fact_sales, s.dim_products, s.dim_customers, cat.AS_OF, colour="red")


def test_concurrent_callers_share_one_star(spark):
    from concurrent.futures import ThreadPoolExecutor

    from starlens.sources.star import materialized_star

    with ThreadPoolExecutor(4) as pool:
        stars = list(pool.map(lambda _: materialized_star(spark, SF_SMALL), range(4)))
    assert all(s is stars[0] for s in stars)


class _Context:
    def __init__(self):
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"{folder}/app-1"


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    """A session whose spark.checkpoint.dir is unset (cannot be set at runtime)."""

    def __init__(self):
        self.conf = _Conf()
        self.sparkContext = _Context()


def test_checkpoint_fallback_only_when_unset(spark):
    from starlens.session import shared_folder

    unset = _Session()
    assert shared_folder(unset) is None
    with pytest.raises(RuntimeError):
        checkpoint_root(unset)
    assert checkpoint_root(unset, fallback="/shared/tests") == "/shared/tests/app-1"
    assert shared_folder(unset) == "/shared/tests/app-1"
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:  # a configured folder always wins over a fallback
        assert checkpoint_root(spark, fallback="/elsewhere") == configured.rstrip("/")


def test_unwritable_folder_falls_back_and_other_failures_are_raised(spark, scratch, monkeypatch):
    import warnings

    from starlens.sources import star as star_mod

    data = _copied_inputs(f"{scratch}/inputs")

    def fail(*args, **kwargs):
        raise OSError("read-only folder")

    with monkeypatch.context() as patched:
        patched.setattr(star_mod, "_probe", fail)
        with warnings.catch_warnings(record=True) as caught:
            warnings.simplefilter("always")
            got = star_mod.materialized_star(spark, data)
    assert any("deriving per query" in str(w.message) for w in caught)
    assert not any("/starlens/gold/" in f for f in got.fact_sales.inputFiles())
    assert got.fact_sales.count() == star_from_tables(spark, SF_SMALL).fact_sales.count()
    with monkeypatch.context() as patched:
        patched.setattr(star_mod, "write_star", fail)
        with pytest.raises(OSError, match="read-only"):
            star_mod.materialized_star(spark, data)


def test_session_conf_local_and_cluster():
    from starlens.session import CLUSTER_SHUFFLE_PARTITIONS, session_conf

    local = session_conf("local[8]", 8)
    assert local["spark.sql.shuffle.partitions"] == "8"
    assert "spark.sql.adaptive.coalescePartitions.parallelismFirst" not in local
    cluster = session_conf(None)
    assert cluster["spark.sql.shuffle.partitions"] == str(CLUSTER_SHUFFLE_PARTITIONS)
    assert cluster["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert cluster["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert session_conf("yarn", 100, {"spark.sql.ansi.enabled": "false"})["spark.sql.ansi.enabled"] == "false"


def test_the_derived_fact_is_shuffled_once(spark, monkeypatch, scratch):
    """Lines and orders meet in one shuffle; another one just for the year folders would move the whole fact again."""
    from starlens.sources import star as module

    found = {}
    monkeypatch.setattr(module, "write_star", lambda star, root, **how: found.update(how) or write_star(star, root, **how))
    monkeypatch.setattr(module, "shared_folder", lambda spark: scratch)
    derived = module.materialized_star(spark, SF_SMALL)
    assert found == {"rebalance": False}
    assert derived.fact_by_year is not None
    assert derived.fact_sales.count() == module.star_from_tables(spark, SF_SMALL).fact_sales.count()
