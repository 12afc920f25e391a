"""Streaming forms of the batch operators.

Everything that can be a micro-batch over written tables is one
(``foreachBatch``): the batch operator then serves both and stays skew-safe.
Keyed state with timers is used where time itself must trigger output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from .. import markets
from ..operators import exceptions
from ..operators.cdc import latest_image
from ..sources.sinks import table_exists

c = F.col
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ZONE_SPREAD = "26 hours"  # from UTC-12 to UTC+14


def replay_free(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Without exact replays: one image per key and commit instant, however late it
    arrives. The state store, on disk and split by key, keeps each image's key for as
    long as the query lives. ``stream`` must carry no watermark, which would drop late rows."""
    return stream.dropDuplicates([*keys, "_commit_ts", "_op"])


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Output of one batch in its own folder: a batch that runs again after a
    failure replaces what it wrote, also by nothing."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
           interval: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def latest_images(stream: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
                  buckets: int = 64) -> StreamingQuery:
    """Keeps the newest image of every key in ``path``, split into key buckets; a
    batch rewrites only the buckets it touches. Merging the same batch again gives
    the same rows, so a batch that fails half-way can simply run again."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        if table_exists(spark, path):
            touched = F.broadcast(new.select("bucket").distinct())  # at most ``buckets`` rows
            new = spark.read.parquet(path).join(touched, "bucket", "left_semi").unionByName(new)
        staging = f"{path}__staging"
        kept = latest_image(new, keys, drop_deletes=False)
        (kept.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("bucket").parquet(staging))
        (spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(path))
    return _start(stream, merge, checkpoint)


def deliver(stream: DataFrame, pending: Callable[[DataFrame, DataFrame], DataFrame], log_path: str,
            checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Finds pending records of each batch, delivers each once and logs it.
    ``pending(batch, log)`` gives the log rows to add; the log of the same batch is
    left out of the comparison, so a re-run writes the same rows again."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = "record_type string, record_key string, jurisdiction string, receipt_id string, submitted_at timestamp"
        if table_exists(spark, log_path):
            log = spark.read.schema(key + ", batch_id int").parquet(log_path).filter(c("batch_id") < batch_id)
        else:
            log = spark.createDataFrame([], key)
        new = pending(batch, log).dropDuplicates(["record_type", "record_key"])
        done = log.select("record_type", "record_key")
        _write_batch(new.join(done, ["record_type", "record_key"], "left_anti"), log_path, batch_id)
    return _start(stream, each, checkpoint, interval)


def session_windows(stream: DataFrame, user: str, ts: str, gap: str | Column, delay: str = "10 minutes") -> DataFrame:
    """Gap sessions. Spark closes a gap window at exactly the gap, so activity that
    comes precisely at the timeout starts a new session."""
    return (stream.withWatermark(ts, delay).groupBy(user, F.session_window(ts, gap).alias("w"))
            .agg(F.count("*").alias("activities"), F.max(ts).alias("last_activity_ts"))
            .select(user, c("w.start").alias("started_at"), "last_activity_ts", c("w.end").alias("closes_at"), "activities"))


def limit_windows(stream: DataFrame, account: str, ts: str, zone: str, amount: str, period: str,
                  delay: str = "1 hour") -> DataFrame:
    """Live totals per account and local day or Monday week (``zone`` is a column).
    Months are sums of days and come from the day rows. Local clocks differ by up to
    ``ZONE_SPREAD``; the watermark waits that much longer than ``delay``, so the
    easternmost zone can't close a window that others still fill."""
    length, offset = {"DAILY": ("1 day", "0 seconds"), "WEEKLY": ("7 days", "4 days")}[period]
    local = stream.withColumn("_local", F.from_utc_timestamp(c(ts), c(zone)))
    return (local.withWatermark("_local", f"{ZONE_SPREAD} {delay}")
            .groupBy(account, F.window("_local", length, length, offset).alias("w"))
            .agg(F.sum(amount).alias("total"))
            .select(account, F.lit(period).alias("period"), F.to_date("w.start").alias("window_start"), "total"))


def ready_rows(batch: DataFrame, watermarks: DataFrame, market: DataFrame) -> DataFrame:
    """Rows of a batch whose period is closed; a market without a watermark waits."""
    readiness = exceptions.period_readiness(batch.select("jurisdiction", "report_date"), watermarks, market)
    return batch.join(readiness.filter("is_ready").select("jurisdiction", "report_date"),
                      ["jurisdiction", "report_date"], "left_semi")


MARKS = 10_000  # rows of the watermark table: sources times markets


def heartbeat(stream: DataFrame) -> DataFrame:
    """``stream`` with a source beside it that has something new at every trigger but gives no rows: a batch starts
    although the stream is quiet."""
    beat = stream.sparkSession.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load().where("value < 0")
    return stream.unionByName(beat.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema]))


def gate_by_readiness(stream: DataFrame, watermark_path: str, market: DataFrame, ready_path: str,
                      waiting_path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Splits each batch, and what still waited after the batch before it, into rows
    ready to file and rows that wait. The watermark table is read again for every
    batch. The rows that wait now are those of the newest batch in ``waiting_path``.
    With an ``interval``, waiting rows are looked at that often, also when no new rows come."""
    period = ["jurisdiction", "report_date"]

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carried = f"{waiting_path.rstrip('/')}/batch_id={batch_id - 1}"
        if table_exists(spark, carried):
            batch = batch.unionByName(spark.read.schema(batch.schema).parquet(carried))
        # One reading of the watermarks decides both outputs, also if they move on meanwhile.
        stored = spark.read.parquet(watermark_path)
        rows = stored.limit(MARKS + 1).collect()
        if len(rows) > MARKS:
            raise ValueError(f"the watermark table has more than {MARKS} rows")
        open_periods = ready_rows(batch.select(*period).distinct(), spark.createDataFrame(rows, stored.schema), market)
        _write_batch(batch.join(open_periods, period, "left_semi"), ready_path, batch_id)
        _write_batch(batch.join(open_periods, period, "left_anti"), waiting_path, batch_id)
    return _start(heartbeat(stream) if interval else stream, each, checkpoint, interval)


def split_late(batch: DataFrame, ts: str, complete_through: Column) -> tuple[DataFrame, DataFrame]:
    """(on time, late) against a completeness instant. Late rows go to a side table;
    whether something exists is decided by its terminal state, never by absence."""
    late = c(ts) <= complete_through
    return batch.filter(~late), batch.filter(late)


class SessionTimeout(StatefulProcessor):
    """Ends a session that was idle for its market's timeout.

    Input: session_id, ts, minutes, kind (ACTIVITY or LOGOUT). Output on the end:
    session_id, ended_at, end_reason. The timer follows the latest activity.
    """

    SCHEMA = "session_id string, ended_at timestamp, end_reason string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_ms bigint, minutes int, closed boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.last.get() if self.last.exists() else (0, markets.DEFAULT_TIMEOUT, False)
        last_ms, minutes, closed = stored
        logout = None
        for row in rows:
            ms = int(row.ts.replace(tzinfo=row.ts.tzinfo or timezone.utc).timestamp() * 1000)
            last_ms, minutes = max(last_ms, ms), row.minutes
            if row.kind == "LOGOUT":
                logout = row.ts
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        if closed:
            return
        self.last.update((last_ms, minutes, logout is not None))
        if logout is not None:
            yield Row(session_id=key[0], ended_at=logout, end_reason="LOGOUT")
        else:
            self.handle.registerTimer(last_ms + minutes * 60_000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last_ms, minutes, closed = self.last.get()
        if not closed:
            self.last.update((last_ms, minutes, True))
            ended = datetime.fromtimestamp(last_ms / 1000, timezone.utc) + timedelta(minutes=minutes)
            yield Row(session_id=key[0], ended_at=ended.replace(tzinfo=None), end_reason="INACTIVITY")

    def close(self) -> None:
        pass


def session_timeouts(stream: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Needs the RocksDB state store (``ROCKSDB``)."""
    return (stream.withWatermark("ts", delay).groupBy("session_id")
            .transformWithState(SessionTimeout(), SessionTimeout.SCHEMA, "Append", "EventTime"))


class RetryState(StatefulProcessor):
    """Attempts of a transient failure. Input: entity_id, reason_code, ts, one row
    per run that shows the failure. An attempt counts when it is due; more than the
    allowed number quarantines. A failure not seen again by its next retry plus the
    same wait is resolved. The stored due instant moves only when it was due, so
    runs more frequent than the backoff do not push it away."""

    SCHEMA = ("entity_id string, reason_code string, attempt_count int, first_seen timestamp, "
              "next_retry_at timestamp, status string")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("retry", "attempts int, first_ms bigint, due_ms bigint")

    @staticmethod
    def _time(ms: int | None) -> datetime | None:
        return None if ms is None else datetime.fromtimestamp(ms / 1000, timezone.utc).replace(tzinfo=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        attempts, first_ms, due_ms = self.state.get() if self.state.exists() else (0, None, 0)
        seen = sorted(int(r.ts.replace(tzinfo=r.ts.tzinfo or timezone.utc).timestamp() * 1000) for r in rows)
        for ms in seen:
            first_ms = ms if first_ms is None else first_ms
            if attempts > markets.MAX_ATTEMPTS or ms < due_ms:
                continue
            attempts += 1
            wait = markets.BACKOFF_MINUTES * 2 ** (attempts - 1) * 60_000
            due_ms = ms + wait
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        self.state.update((attempts, first_ms, due_ms))
        spent = attempts > markets.MAX_ATTEMPTS
        if not spent:
            self.handle.registerTimer(due_ms + (due_ms - seen[-1]))
        yield Row(entity_id=key[0], reason_code=key[1], attempt_count=attempts, first_seen=self._time(first_ms),
                  next_retry_at=None if spent else self._time(due_ms),
                  status="QUARANTINED" if spent else "RETRYING")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        attempts, first_ms, _ = self.state.get()
        self.state.clear()
        yield Row(entity_id=key[0], reason_code=key[1], attempt_count=attempts, first_seen=self._time(first_ms),
                  next_retry_at=None, status="RESOLVED")

    def close(self) -> None:
        pass


def retry_states(stream: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Needs the RocksDB state store (``ROCKSDB``)."""
    return (stream.withWatermark("ts", delay).groupBy("entity_id", "reason_code")
            .transformWithState(RetryState(), RetryState.SCHEMA, "Append", "EventTime"))


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Current images kept by :func:`latest_images`, deletes left out."""
    return spark.read.parquet(path).filter("_op <> 'D'").drop("bucket")
