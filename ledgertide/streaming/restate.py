"""Late rows restate what was filed: the periods they fall into are opened again and an amendment is filed.

A row is late if its market's completeness instant has passed its own. Late rows go to the facts like all others; beside that
each batch finds the filed periods they touch, figures these periods anew from the facts of those periods alone, and
puts a new receipt over the older one (``sinks.log_replace``). A late row of a period that was never filed waits
for its first filing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from ..sources.sinks import log_replace
from .jobs import _start, _write_batch, split_late

PERIOD = ["jurisdiction", "report_date"]
LOG = "record_type string, record_key string, jurisdiction string, receipt_id string, submitted_at timestamp"


def period_key() -> Column:
    return F.concat_ws("|", "jurisdiction", F.col("report_date").cast("string"))


def read_log(spark, path: str, before: int | None = None) -> DataFrame:
    """The newest receipt of each record; ``before`` leaves out that batch and later ones."""
    rows = spark.read.schema(LOG + ", batch_id int").parquet(path)
    rows = (rows if before is None else rows.where(F.col("batch_id") < before)).drop("batch_id")
    return log_replace(rows, rows.limit(0))


def restate_late(stream: DataFrame, ts: str, watermarks: Callable[[], DataFrame], figures: Callable[[DataFrame], DataFrame],
                 facts_path: str, amended_path: str, log_path: str, filed_at: Callable[[], Column], checkpoint: str,
                 interval: str | None = None) -> StreamingQuery:
    """``watermarks()``: jurisdiction, complete_through. ``figures(facts)`` gives a row per jurisdiction and report_date. The log holds the
    filed periods as record type ``period``, key ``MKT|date``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*PERIOD).parquet(
            f"{facts_path.rstrip('/')}/batch_id={batch_id}")
        marks = F.broadcast(watermarks().select("jurisdiction", "complete_through"))  # a row per market
        _, late = split_late(batch.join(marks, "jurisdiction"), ts, F.col("complete_through"))
        log = read_log(spark, log_path, batch_id)
        filed = log.where("record_type = 'period'").select(F.col("record_key").alias("_key"), F.col("receipt_id").alias("_receipt"))
        touched = late.select(*PERIOD).distinct().withColumn("_key", period_key()).join(filed, "_key")
        periods = touched.collect()  # reopened periods of one batch: markets times days
        wanted = F.lit(False)
        for p in periods:
            wanted = wanted | ((F.col("jurisdiction") == p.jurisdiction) & (F.col("report_date") == F.lit(p.report_date)))
        stored = StructType([*batch.schema.fields, StructField("batch_id", IntegerType())])
        facts = spark.read.schema(stored).option("basePath", facts_path).parquet(facts_path)
        _write_batch(figures(facts.where(wanted)), amended_path, batch_id)
        revision = F.coalesce(F.regexp_extract("_receipt", "-R([0-9]+)$", 1).try_cast("int"), F.lit(0)) + 1
        new = spark.createDataFrame(periods, touched.schema).select(
            F.lit("period").alias("record_type"), F.col("_key").alias("record_key"), "jurisdiction",
            F.concat(F.regexp_replace("_receipt", "-R[0-9]+$", ""), F.lit("-R"), revision).alias("receipt_id"), filed_at().alias("submitted_at"))
        changed = log_replace(log, new).join(new.select("record_type", "record_key"), ["record_type", "record_key"], "left_semi")
        _write_batch(changed.select("record_type", "record_key", "jurisdiction", "receipt_id", "submitted_at"), log_path, batch_id)
    return _start(stream, each, checkpoint, interval)
