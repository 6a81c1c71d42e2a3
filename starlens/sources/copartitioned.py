"""A gold layout whose sales and dimension lie together: joins and aggregates on the key without an exchange.

:func:`write_copartitioned` stores, for one dimension and its key, a build of three tables:

| table | rows | how they lie |
| --- | --- | --- |
| ``sales`` | sales of known keys that aren't hot | bucketed and sorted by the key, one file a bucket |
| ``dimension`` | the dimension | the same buckets |
| ``apart`` | sales of hot keys and of unknown ones, with their grain key | spread evenly, whatever their key |

A join or an aggregate of ``sales`` on the key reads matching buckets and shuffles nothing, so
the one shuffle of the fact is paid when the layout is written and not by every query. A
key is hot if it has more than a ``HOT_SHARE``-th of the rows meant for a bucket; a bucket
then holds no key that could fill it, and a key with a third of all sales is spread over
all tasks. A grain key is either in ``sales`` or in ``apart``, never in both, so results of the
two are put together by ``union``. At most ``HOT_SHARE`` keys per bucket can be hot.

The dimension is part of the build: a sale is known by the dimension rows written with
it. Unknown and NULL keys have the grain key NULL.

Buckets are a property of catalog tables. A build names its own after its id;
:func:`open_copartitioned` names them again in a session whose catalog doesn't have
them (only metadata). Key columns have the dimension's type in both tables, since equal
numbers of different types hash differently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.operators.known_keys import MOST_WORDS, grain_sales
from starlens.sources.publish import build_folder, publish, published

#: Sales that a bucket should have, about 128 MB of the narrow fact.
ROWS_PER_BUCKET = 4_000_000
HOT_SHARE = 4
GRAIN = "starlens_grain"


@dataclass(frozen=True)
class CoPartitioned:
    key: str
    buckets: int
    sales: DataFrame
    dimension: DataFrame
    #: Sales of hot and unknown keys, with column ``GRAIN``.
    apart: DataFrame

    def joined(self, *columns: str) -> DataFrame:
        """Every sale with the dimension's ``columns``, as a left join gives them.

        Sales in buckets meet theirs without an exchange; the others meet the dimension rows of hot keys only.
        """
        own = F.col(self.key)
        attributes = self.dimension.select(own.alias("__own"), *columns)
        near = self.sales.join(attributes, own == F.col("__own")).drop("__own")
        hot = self.apart.select(F.col(GRAIN).alias("__own")).where(F.col("__own").isNotNull()).distinct()
        few = attributes.join(hot, "__own", "left_semi")
        far = self.apart.join(few, F.col(GRAIN) == F.col("__own"), "left").drop("__own", GRAIN)
        return near.unionByName(far)


_TABLES = "name string, columns string"


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _table(folder: str, name: str) -> str:
    return f"starlens_{folder.rsplit('/', 1)[1]}_{name}"


def _with_grain(fact: DataFrame, dim: DataFrame, key: str, most_words: int) -> DataFrame:
    found = grain_sales(fact, dim, key, GRAIN, most_words)
    if found is not None:
        return found
    keys = dim.select(F.col(key).alias(GRAIN)).where(F.col(GRAIN).isNotNull()).distinct()
    return fact.join(keys, F.col(key) == F.col(GRAIN), "left")


def write_copartitioned(
    fact: DataFrame, dim: DataFrame, key: str, root: str, rows_per_bucket: int = ROWS_PER_BUCKET, most_words: int = MOST_WORDS
) -> str:
    """Publish a co-partitioned build of ``fact`` and ``dim`` at ``root``; returns the build's folder."""
    spark = fact.sparkSession
    sales = _with_grain(fact, dim, key, most_words)
    buckets = max(1, -(-fact.count() // rows_per_bucket))

    def write(folder: str) -> None:
        many = sales.where(F.col(GRAIN).isNotNull()).groupBy(F.col(GRAIN).alias("__hot")).count()
        many.where(F.col("count") * HOT_SHARE > rows_per_bucket).select("__hot").write.parquet(f"{folder}/hot")
        hot = spark.read.parquet(f"{folder}/hot")  # at most HOT_SHARE rows a bucket
        marked = sales.join(hot, F.col(GRAIN) == F.col("__hot"), "left")
        away = F.col(GRAIN).isNull() | F.col("__hot").isNotNull()
        marked.where(away).drop("__hot").hint("rebalance").write.parquet(f"{folder}/apart")
        near = marked.where(~away).withColumn(key, F.col(GRAIN)).drop(GRAIN, "__hot")
        # a bucketed write of no rows leaves no file that would tell the columns
        columns = [(name, _columns(rows)) for name, rows in (("sales", near), ("dimension", dim), ("apart", sales))]
        spark.createDataFrame(columns, _TABLES).coalesce(1).write.parquet(f"{folder}/tables")
        for name, rows in (("sales", near), ("dimension", dim)):
            # partitions by the hash that buckets go by: each task writes one bucket's file
            writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
            writer.option("path", f"{folder}/{name}").format("parquet").saveAsTable(_table(folder, name))

    return publish(spark, root, write, f"{key}:{buckets}")


def open_copartitioned(spark: SparkSession, root: str) -> CoPartitioned | None:
    """The layout published at ``root``; None if there is none."""
    pointer = published(spark, root)
    if pointer is None:
        return None
    folder = build_folder(root, pointer)
    key, buckets = pointer["layout"].rsplit(":", 1)
    columns = dict(spark.read.schema(_TABLES).parquet(f"{folder}/tables").collect())  # three rows
    for name in ("sales", "dimension"):
        if not spark.catalog.tableExists(_table(folder, name)):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS `{_table(folder, name)}` ({columns[name]}) USING parquet "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}/{name}'"
            )
    sales, dimension = (spark.table(f"`{_table(folder, name)}`") for name in ("sales", "dimension"))
    return CoPartitioned(key, int(buckets), sales, dimension, spark.read.schema(columns["apart"]).parquet(f"{folder}/apart"))
