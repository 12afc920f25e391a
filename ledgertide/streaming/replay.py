"""Replays dropped with memory that does not grow: a filter in front, the written images behind.

Images are stored by day of their commit and bucket of their key. In front of each such cell stands a bit table of fixed size.
A row whose bit is not set has never been seen and goes through at once. Only rows whose bit is set are compared
with the stored keys, and only with those of their own cells. Nothing is kept in a state store and nothing expires, so
a first image is kept however late it comes and a replay is dropped however late it comes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.ordered import join_same
from ..sources.sinks import table_exists
from .jobs import _start

WORDS = 1 << 14  # 64-bit words of a cell's bit table
BUCKETS = 64
CELL = ["day", "bucket"]


def _marked(rows: DataFrame, identity: list[str]) -> DataFrame:
    h = F.xxhash64(*[x for k in identity for x in (F.col(k), F.col(k).isNull())])
    return rows.withColumns({
        "day": F.coalesce(F.to_date("_commit_ts"), F.lit("1970-01-01").cast("date")), "bucket": F.pmod(h, F.lit(BUCKETS)).cast("int"),
        "_word": F.pmod(F.shiftright(h, 12), F.lit(WORDS)).cast("int"), 
        "_bit": F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int"))})


def _cells(rows: DataFrame) -> Column:
    """Which day and bucket folders to read: at most days of the batch times ``BUCKETS``."""
    found: dict = {}
    for r in rows.select(*CELL).distinct().collect():
        found.setdefault(r.day, []).append(r.bucket)
    out = F.lit(False)
    for day, buckets in found.items():
        out = out | ((F.col("day") == F.lit(day)) & F.col("bucket").isin(buckets))
    return out


def _before(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame | None:
    """What earlier batches wrote; a batch that runs again does not meet itself."""
    if not table_exists(spark, path):
        return None
    return spark.read.schema(schema + ", batch_id int, day date, bucket int").option("basePath", path).parquet(path).where(F.col("batch_id") < batch_id)


def new_images(batch: DataFrame, keys: Sequence[str], path: str, batch_id: int) -> DataFrame:
    """Rows of a batch that no earlier batch held, once each."""
    spark, identity = batch.sparkSession, [*keys, "_commit_ts", "_op"]
    rows = _marked(batch.dropDuplicates(identity), identity)
    bits = _before(spark, f"{path}/bits", "_word int, _mask bigint", batch_id)
    if bits is None:
        return rows
    bits = bits.where(_cells(rows)).groupBy(*CELL, "_word").agg(F.bit_or("_mask").alias("_mask"))
    rows = rows.join(bits, [*CELL, "_word"], "left").withColumn("_seen", F.coalesce(F.col("_mask").bitwiseAND(F.col("_bit")) != 0, F.lit(False))).drop("_mask")
    suspects = rows.where("_seen")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batch.select(*identity).schema)
    stored = _before(spark, f"{path}/images", schema, batch_id)
    if stored is not None:
        stored = stored.where(_cells(suspects)).select(*identity).distinct()
        replays = join_same(suspects, stored, identity).select(*identity)
        on = F.lit(True)
        for k in identity:
            on = on & F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}"))
        suspects = suspects.alias("s").join(replays.alias("r"), on, "left_anti")
    return rows.where("NOT _seen").unionByName(suspects.select(*rows.columns)).drop("_seen")


def replay_free_images(stream: DataFrame, keys: Sequence[str], path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Writes each image of a feed once to ``path/images``, with its bits in ``path/bits``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        staging = f"{path}/staging"
        rows = new_images(batch, keys, path, batch_id)
        rows.write.mode("overwrite").parquet(staging)
        rows = batch.sparkSession.read.schema(rows.schema).parquet(staging)
        for name, part in (("images", rows.drop("_word", "_bit")),
                           ("bits", rows.groupBy(*CELL, "_word").agg(F.bit_or("_bit").alias("_mask")))):
            part.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*CELL).parquet(f"{path}/{name}/batch_id={batch_id}")
    return _start(stream, each, checkpoint, interval)
