"""Helpers the operators of this package share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.session import writable_root

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows of an Arrow batch between Spark and a Python worker.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Settings of the session that the operators rely on.

    Python workers import this package from the driver's path (workers of a
    plain ``python`` driver inherit PYTHONPATH only; on a cluster the package
    is installed or shipped with ``--py-files`` as usual), and get at most
    ``BATCH_ROWS`` rows at once, since a row may hold a very long text.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    env = spark.sparkContext.environment
    paths = [p for p in (env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``, for one run of one operator."""
    return f"{writable_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here and nothing is computed twice."""
    prepare(df.sparkSession)
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def values(column: pa.Array) -> Iterator:
    """A column's Python values one by one; long texts aren't all held at once."""
    return (x.as_py() for x in column)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, usable: Column | None = None
) -> DataFrame:
    """At most ``per_class`` labelled documents of each class: (_id, text, label).

    A document's label is the largest one its rows in ``labels`` state; null
    labels and ids are skipped. The rows with the smallest id hashes are
    taken, so the sample doesn't depend on partitioning. Only ids are sorted
    (top-n per task); texts are fetched by a join with the chosen ids.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )
    if usable is not None:
        known = known.where(usable)
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("_label") == value).orderBy(*order).limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # 2 * per_class narrow rows, a bound set by the caller's parameter
    return (
        docs.select(F.col("doc_id").alias("_id"), F.col("text"))
        .join(F.broadcast(chosen), "_id")
        .groupBy("_id")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("_label").alias("label"))
    )


def table_sum(df: DataFrame, *columns: str) -> tuple:
    """Row count and an order-free sum of row hashes, to tell whether an iteration changed anything."""
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first())
