"""Session construction and the shared checkpoint/materialisation folder.

Settings are chosen for a large cluster first; tests and the bench shrink
the shuffle partition count for ``local[N]``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Scale-oriented defaults. AQE re-plans at runtime from real shuffle sizes:
# it coalesces small partitions, splits skewed join partitions (a single
# customer or product key may hold a large share of the fact rows, and all
# unmatched keys of a left join land on one reducer) and can turn a
# sort-merge join into a broadcast join once the dimension side is measured.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Static broadcast only for sides *estimated* (from file sizes) under
    # 10 MB; anything else is sort-merge joined, and AQE may still convert
    # the join to a broadcast once the side's shuffle output is *measured*
    # under 64 MB.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # AQE may replace a sort-merge join by a shuffled hash join (no sort)
    # when every post-shuffle partition is measured under this size, so the
    # per-task hash map is bounded.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


# Initial shuffle width on a cluster. AQE coalesces partitions toward the
# advisory size but never creates more than this, so it must be large enough
# for the biggest shuffle (tens of TB for a report's distinct-count stage at
# 100 TB of input, i.e. a few hundred MB per partition at this width).
CLUSTER_SHUFFLE_PARTITIONS = 16384


def session_conf(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """The settings :func:`build_session` applies for ``master``.

    ``shuffle_partitions`` is the *initial* shuffle width; with AQE on it is
    an upper bound that gets coalesced toward the advisory partition size.
    Without a value, a cluster session gets :data:`CLUSTER_SHUFFLE_PARTITIONS`
    and a ``local[N]`` session keeps Spark's default; tests and the bench
    pass about N.
    """
    conf = dict(SCALE_CONF)
    cluster = not (master or "").startswith("local")
    if cluster:
        # Coalesce to the advisory size instead of to many ~1 MB partitions
        # (the default favours parallelism, which on a shared cluster means
        # floods of tiny tasks).
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    if shuffle_partitions is None and cluster:
        shuffle_partitions = CLUSTER_SHUFFLE_PARTITIONS
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    return conf


def build_session(
    master: str | None = None,
    app_name: str = "starlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :func:`session_conf` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in session_conf(master, shuffle_partitions, extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The cluster's shared folder: ``spark.checkpoint.dir``, else the context's checkpoint dir."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return root.rstrip("/") if root else None


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage that survives the
    loss of any executor, so materialised tables and checkpoints go there.
    Only when no folder is configured (tests, a laptop) is ``fallback``
    installed, through ``SparkContext.setCheckpointDir`` (the setting itself
    cannot change once the context runs).
    """
    root = shared_folder(spark)
    if root is None:
        if fallback is None:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; pass a shared folder as fallback"
            )
        spark.sparkContext.setCheckpointDir(fallback)
        root = shared_folder(spark)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def writable_root(spark: SparkSession) -> str:
    """:func:`checkpoint_root`, or on ``local[N]`` without a configured folder a new temporary one.

    Every task of a local session sees the driver's folders; on a cluster an
    unset ``spark.checkpoint.dir`` stays an error.
    """
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    fallback = tempfile.mkdtemp(prefix="starlens-") if local and shared_folder(spark) is None else None
    return checkpoint_root(spark, fallback)


def env_int(name: str, default: int) -> int:
    value = os.environ.get(name)
    return int(value) if value else default
