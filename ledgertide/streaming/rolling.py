"""Trailing sums of live deposits from keyed state.

The state of a player is one bucket for each day that a trailing window can still reach: the day's total, and its
deposits by instant. A window sums the totals of the days it covers whole and looks inside the two days at
its edges. No history table is read. A deposit is judged once the watermark has passed its instant, so deposits that
arrive in another order within the delay give the figures of the batch audit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import protection

DAY = 86_400_000_000  # microseconds
REACH = max(protection.SPANS.values())


class RollingSums(StatefulProcessor):
    """Input: account_id, payment_id, at (instant in microseconds), ts, cents. Output: account_id, payment_id, at and the
    trailing sums in cents, both ends of a window included.

    State: ``days`` maps a day to its total, the instants and amounts of its deposits and the ids not judged yet. A day
    goes once no window of a deposit that may still come can reach it, so state follows the windows and not the life of the query.
    """

    SCHEMA = "account_id string, payment_id string, at bigint, " + ", ".join(f"{n} bigint" for n in protection.SPANS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day bigint", "total bigint, at array<bigint>, cents array<bigint>, ids array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        for day, part in batch.groupby(batch["at"] // DAY):
            day = int(day)
            total, at, cents, ids = self.days.getValue((day,)) if self.days.containsKey((day,)) else (0, [], [], [])
            self.days.updateValue((day,), (total + int(part["cents"].sum()), [*at, *map(int, part["at"])],
                                           [*cents, *map(int, part["cents"])], [*ids, *part["payment_id"]]))
        self._wake(int(batch["at"].min()))
        yield pd.DataFrame()

    def _wake(self, at: int) -> None:
        """One timer, at the earliest deposit that is not judged."""
        due = -(-at // 1000)
        timers = list(self.handle.listTimers())
        if not timers or due < min(timers):
            for other in timers:
                self.handle.deleteTimer(other)
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        days = {k[0]: tuple(v) for k, v in self.days.iterator()}
        out, waiting = [], []
        for day in sorted(days):
            total, at, cents, ids = days[day]
            left = list(ids)
            for i, (instant, id_) in enumerate(zip(at, ids)):
                if id_ is None:
                    continue
                if instant > passed:
                    waiting.append(instant)
                    continue
                out.append((key[0], id_, instant, *(self._sum(days, instant - n * DAY, instant) for n in protection.SPANS.values())))
                left[i] = None  # judged; the amount stays for later windows
            if left != list(ids):
                self.days.updateValue((day,), (total, list(at), list(cents), left))
        oldest = (passed - REACH * DAY) // DAY
        for day in days:
            if day < oldest and not any(i is not None and a > passed for a, i in zip(days[day][1], days[day][3])):
                self.days.removeKey((day,))
        if waiting:  # the timer that has just expired is still listed, so it says nothing
            self.handle.registerTimer(-(-min(waiting) // 1000))
        yield pd.DataFrame(out, columns=["account_id", "payment_id", "at", *protection.SPANS])

    @staticmethod
    def _sum(days: dict[int, tuple], start: int, end: int) -> int:
        first, last = start // DAY, end // DAY
        total = sum(days[d][0] for d in range(first + 1, last) if d in days)
        for d in {first, last}:
            if d in days:
                at, cents = np.array(days[d][1], np.int64), np.array(days[d][2], np.int64)
                total += int(cents[(at >= start) & (at <= end)].sum())
        return total

    def close(self) -> None:
        pass


def rolling_totals(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Trailing 1, 7 and 30 day sums of each deposit, as account_id, payment_id, completed_ts and a column for each period. Rows later
    than ``delay`` behind the newest are left to the batch audit. Needs the RocksDB state store (``jobs.ROCKSDB``)."""
    rows = stream.where("completed_ts IS NOT NULL AND amount IS NOT NULL").select(
        "account_id", "payment_id", F.unix_micros("completed_ts").alias("at"), F.col("completed_ts").alias("ts"),
        (F.col("amount") * 100).cast("bigint").alias("cents"))
    sums = (rows.withWatermark("ts", delay).groupBy("account_id")
            .transformWithStateInPandas(RollingSums(), RollingSums.SCHEMA, "Append", "EventTime"))
    return sums.select("account_id", "payment_id", F.timestamp_micros("at").alias("completed_ts"),
                       *[(F.col(n).cast("decimal(20,0)") / 100).cast("decimal(28,2)").alias(n) for n in protection.SPANS])


def rolling_limits(stream: DataFrame, limits: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Deposits that take the trailing 1, 7 or 30 days over a limit, as they happen."""
    caps = protection._limit_rows(limits, "DEPOSIT")
    return protection._rolling_breaches(rolling_totals(stream, delay), caps, "payment_id", "completed_ts")
