"""Report sinks: the reference's drop-and-recreate views, re-expressed.

The reference defines reports as views under fixed names, after dropping any
old one, so that others can query them.

- :func:`register` is that contract for one session: a temp view, re-evaluated
  on every read.
- :func:`materialize` writes the report once to shared storage, so many readers
  share one computation and a lost executor never recomputes it from the fact.
- :func:`publish_report` also creates or replaces a catalog view of that name
  over the written data, which every session of the catalog can read.

Each write is a build of its own (see :mod:`starlens.sources.publish`): earlier
readers go on reading, and a report may be rebuilt from itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starlens.session import writable_root
from starlens.sources.publish import build_folder, publish, published


def register(df: DataFrame, name: str) -> DataFrame:
    """Create or replace the temp view ``name`` and return the DataFrame."""
    df.createOrReplaceTempView(name)
    return df


def drop_view(spark: SparkSession, name: str) -> bool:
    """Drop the temp view if it exists; returns whether one was dropped."""
    return spark.catalog.dropTempView(name)


def _root(spark: SparkSession, name: str, path: str | None) -> str:
    return (path or f"{writable_root(spark)}/tables/{name}").rstrip("/")


def _write(df: DataFrame, name: str, path: str | None, fmt: str) -> str:
    return publish(df.sparkSession, _root(df.sparkSession, name, path), df.write.format(fmt).save, fmt)


def materialize(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` as a new build of the table ``name`` and return a DataFrame that reads it back.

    Without ``path`` the table goes under ``{spark.checkpoint.dir}/tables/``,
    the folder the cluster shares between executors. The temp view ``name``
    reads the new build.
    """
    out = df.sparkSession.read.format(fmt).load(_write(df, name, path, fmt))
    out.createOrReplaceTempView(name)
    return out


def read_materialized(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """The current build of a table that :func:`materialize` or :func:`publish_report` wrote, in any application."""
    root = _root(spark, name, path)
    pointer = published(spark, root)
    if pointer is None:
        raise ValueError(f"nothing is published at {root}")
    return spark.read.format(pointer["layout"]).load(build_folder(root, pointer))


def publish_report(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` and create or replace the catalog view ``name`` over it; returns ``spark.table(name)``.

    The view is visible to every session of the catalog. Replacing it is one
    catalog operation, and readers of the old data are not disturbed.
    """
    spark = df.sparkSession
    folder = _write(df, name, path, "parquet")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return spark.table(name)


def drop_report(spark: SparkSession, name: str) -> None:
    """Drop the catalog view if it exists; its data stay until ``remove_superseded`` or the folder's clean-up."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
