"""Session settings every job of this package relies on."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Runtime settings, safe to set on a session somebody else created. Partition
# counts and memory stay with the cluster; only semantics, skew handling and the
# most that a joined partition reads are fixed here.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange afterwards:
    # one account may hold a third of all rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


# Settings that only take effect when the session starts. Plans here are large;
# recording a Python call site for each expression costs more than planning them.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


# Joined partitions are filled up to this many MB, as written. The rows, sorts and totals that a task then holds side by side
# are several times larger; a cluster may ask for less.
ADVISORY, MOST_READ = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    asked = spark.conf.get(ADVISORY, "64m").lower()
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?|.*", asked).groups()
    if number is None or int(number) * 1024 ** " kmgtp".index(unit or " ") > MOST_READ * 1024 ** 2:
        spark.conf.set(ADVISORY, f"{MOST_READ}m")
    return spark


def build_session(app: str = "ledgertide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """The shared checkpoint folder of the cluster, or ``fallback`` where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    target = configured or fallback
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(target)
    return target
