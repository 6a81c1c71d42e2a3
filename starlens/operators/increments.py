"""Incremental refresh of both reports: only files that were not read before are read.

What a report needs of the sales is a state that merges: per fact key the words of its
orders and of its other key's bitmap (:mod:`starlens.operators.distinct_bitmaps`), and
one row of sums and extremes of dates. A refresh lists the fact's files, reads those that its manifest
doesn't name, writes their state as one more *step* and publishes a new manifest (the
files folded in, the steps that hold them) by a pointer written last:

- a refresh that fails leaves a step that no manifest names, so a replay reads the same
  files again and nothing counts twice;
- of two refreshes at once both publish, and the later manifest counts: it names its own
  steps and files only, and what the other one read is read by the next refresh;
- a file that was replaced or removed can't be taken out of sums and bitmaps, so then all
  files are read anew; nothing of an older state is used;
- beyond ``MOST_STEPS`` steps the state is merged into one.

Order numbers and keys must be whole numbers (text ones have no code that stays the
same when values are added); others raise an error. An empty folder has the state of an
empty fact.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlens.functions.numeric import is_integral
from starlens.operators.distinct_bitmaps import coarser
from starlens.operators.reports import _mergeable, customer_report_of, product_report_of, sales_words
from starlens.sources.publish import build_folder, publish, published
from starlens.sources.star import read_table
from starlens.sources import schemas

GRAINS = ("product_key", "customer_key")
MOST_STEPS = 16
LAYOUT = "report-state-2"
PARTS = ("orders", "others", "sums")
_FILES = "path string, length long, modificationTime timestamp"


@dataclass(frozen=True)
class ReportState:
    """The published state at ``root``; ``files_read`` is how many files the refresh that returned it had to read."""

    spark: SparkSession
    root: str
    steps: tuple[str, ...]
    files_read: int = 0

    def words(self, grain: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """:func:`starlens.operators.reports.sales_words` of all files, steps side by side."""
        read = self.spark.read
        return tuple(read.parquet(*(f"{self.root}/steps/{s}/{grain}/{part}" for s in self.steps)) for part in PARTS)

    def report_products(self, products: DataFrame, as_of=None, **bounds) -> DataFrame:
        return product_report_of(self.words("product_key"), products, as_of, **bounds)

    def report_customers(self, customers: DataFrame, as_of=None, **bounds) -> DataFrame:
        return customer_report_of(self.words("customer_key"), customers, as_of, **bounds)


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet files below a folder, by Spark's own listing; their contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(folder).select("path", "length", "modificationTime")


def _write_step(spark: SparkSession, root: str, words: dict[str, tuple[DataFrame, DataFrame, DataFrame]]) -> str:
    step = uuid.uuid4().hex
    for grain, tables in words.items():
        for part, rows in zip(PARTS, tables, strict=True):
            rows.write.parquet(f"{root}/steps/{step}/{grain}/{part}")
    return step


def _merged(state: ReportState, grain: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All steps' words of a grain, one row per key and word, and its sums, one row per key."""
    orders, others, sums = state.words(grain)
    again = [how(c).cast(sums.schema[c].dataType).alias(c) for c, (_, how) in _mergeable(grain).items()]
    return coarser(orders, [grain]), coarser(others, [grain]), sums.groupBy(grain).agg(*again)


def open_state(spark: SparkSession, root: str) -> ReportState | None:
    """The state published at ``root``; None if there is none."""
    root = root.rstrip("/")
    pointer = published(spark, root)
    if pointer is None or pointer["layout"] != LAYOUT:
        return None
    # at most MOST_STEPS rows
    steps = spark.read.schema("at int, step string").parquet(f"{build_folder(root, pointer)}/steps").orderBy("at").collect()
    return ReportState(spark, root, tuple(r["step"] for r in steps))


def refresh(spark: SparkSession, fact_folder: str, root: str) -> ReportState:
    """Fold the files of ``fact_folder`` that are new since the last refresh into the state at ``root``."""
    fact_folder, root = fact_folder.rstrip("/"), root.rstrip("/")
    state = open_state(spark, root)
    files = _listed(spark, fact_folder)
    fresh = files
    if state is not None:
        known = spark.read.schema(_FILES).parquet(f"{build_folder(root, published(spark, root))}/files")
        if known.join(files, known.columns, "left_anti").isEmpty():
            fresh = files.join(known, known.columns, "left_anti")
        else:  # something was replaced or removed
            state = None
    # paths of the files to read, which any read of them would list on the driver
    new = fresh.collect()
    if state is not None and not new:
        return state
    whole = read_table(spark, fact_folder, schemas.STAR["fact_sales"])
    if wrong := [c for c in ("order_number", *GRAINS) if not is_integral(whole, c)]:
        raise ValueError(f"{fact_folder}: {wrong} must be whole numbers for an incremental refresh")
    rows = whole.limit(0)
    if new:
        rows = spark.read.schema(whole.schema).option("basePath", fact_folder).parquet(*(r["path"] for r in new))
    step = _write_step(spark, root, {grain: sales_words(rows, grain) for grain in GRAINS})
    steps = (*(state.steps if state else ()), step)
    if len(steps) > MOST_STEPS:
        all_steps = ReportState(spark, root, steps)
        steps = (_write_step(spark, root, {grain: _merged(all_steps, grain) for grain in GRAINS}),)
    now_known = spark.createDataFrame(new, _FILES)
    if state is not None:
        now_known = known.unionByName(now_known)

    def write(folder: str) -> None:
        now_known.write.parquet(f"{folder}/files")
        spark.createDataFrame(list(enumerate(steps)), "at int, step string").coalesce(1).write.parquet(f"{folder}/steps")

    publish(spark, root, write, LAYOUT)
    return ReportState(spark, root, steps, len(new))


def remove_unused_steps(spark: SparkSession, root: str) -> int:
    """Delete the steps that the current manifest doesn't name (failed or merged ones); returns how many.

    For a time when no refresh runs and nobody reads an older state.
    """
    state = open_state(spark, root)
    if state is None:
        return 0
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state.root}/steps")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName() not in state.steps]
    for path in old:
        system.delete(path, True)
    return len(old)
