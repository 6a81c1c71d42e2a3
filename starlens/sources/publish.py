"""Publishing a dataset in its own folder, so that readers are never disturbed.

A build is written below ``{root}/builds/<id>`` and becomes the current one by a
one-row pointer, written last into a folder of its own. Nothing is overwritten:
readers of an older build go on, a build may read its predecessor, and two
applications that build at once both finish (the later pointer counts).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_POINTER = "published_at timestamp, layout string, build string"


def _pointers(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_POINTER).parquet(f"{root}/published")
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def published(spark: SparkSession, root: str) -> Row | None:
    """The current build's pointer (build, layout, published_at); None when nothing was published at ``root``."""
    rows = _pointers(spark, root.rstrip("/"))
    return None if rows is None else rows.orderBy(F.desc("published_at"), F.desc("build")).first()


def build_folder(root: str, pointer: Row) -> str:
    return f"{root.rstrip('/')}/builds/{pointer['build']}"


def publish(spark: SparkSession, root: str, write: Callable[[str], None], layout: str = "") -> str:
    """Let ``write(folder)`` fill a new folder, then point readers of ``root`` to it; returns the folder."""
    root, build = root.rstrip("/"), uuid.uuid4().hex
    folder = f"{root}/builds/{build}"
    write(folder)
    row = spark.range(1).select(F.current_timestamp().alias("published_at"), F.lit(layout).alias("layout"))
    row.coalesce(1).write.parquet(f"{root}/published/build={build}")
    return folder


def remove_superseded(spark: SparkSession, root: str) -> int:
    """Delete every published build of ``root`` but the current one; returns how many.

    For a time when nobody reads an older build. Builds that were never
    published (still being written, or left by a failed job) are not touched.
    """
    root = root.rstrip("/")
    current, rows = published(spark, root), _pointers(spark, root)
    if rows is None or current is None:
        return 0
    old = [r["build"] for r in rows.select("build").distinct().collect() if r["build"] != current["build"]]
    for build in old:
        for folder in (f"{root}/published/build={build}", f"{root}/builds/{build}"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(old)
