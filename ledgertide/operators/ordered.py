"""Order-dependent operators that never put one key's whole history in a task.

A plain ``Window.partitionBy(account).orderBy(ts)`` sends every row of a hot
account to one task. Here rows are range-partitioned once by key and order, so a
hot key spreads over many tasks. Each task scans its sorted rows and says
with which key it opens and what its last key amounts to; these ends, one row per task,
give what every task has to add for the key it goes on with. The input is
read into one exchange and the result equals the plain window exactly, NULLs included.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import staged

_SCAN = [("_sum", "long"), ("_seen", "long"), ("_prev", "long"), ("_opens", "boolean"), ("_part", "int"), ("_end", "boolean"),
         ("_open", "long"), ("_first", "long")]


class Fragment:
    """What a scan carries from row to row: the key, its sum, how many values it had and the last instant."""

    def __init__(self) -> None:
        self.key, self.open, self.first = None, None, None
        self.sum = self.seen = 0
        self.last: int | None = None
        self.opening = True  # still at the key the task began with

    def scan(self, key: np.ndarray, value: pa.Array, instant: pa.Array, gap: int | None) -> dict[str, pa.Array]:
        n = len(key)
        if self.key is None:
            self.open, self.first = int(key[0]), instant[0].as_py()
        same = np.empty(n, bool)
        same[1:] = key[1:] == key[:-1]
        same[0] = self.key is not None and key[0] == self.key
        begins = self.key is None  # the very first row of a task may go on with the task before
        at = np.arange(n)
        before = pa.concat_arrays([pa.array([self.last], pa.int64()), instant[:-1]])
        none = before.is_null().to_numpy(zero_copy_only=False) | ~same
        if gap is not None:
            now, then = instant.fill_null(0).to_numpy(), before.fill_null(0).to_numpy()
            late = (now > then + gap) & instant.is_valid().to_numpy(zero_copy_only=False)
            value = pa.array(np.where(none | late, 1, 0))
        valid, amount = value.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), value.fill_null(0).to_numpy()
        start = np.maximum.accumulate(np.where(same, 0, at))
        carried = np.cumsum(~same) == 0
        out = {}
        for name, x, had in (("_sum", amount, self.sum), ("_seen", valid, self.seen)):
            run = np.cumsum(x)
            out[name] = run - np.where(carried, -had, (run - x)[start])
        still = carried if not begins else np.cumsum(~same) == 1
        opening = still & self.opening
        self.opening = bool(opening[-1])
        self.key, self.sum, self.seen, self.last = int(key[-1]), int(out["_sum"][-1]), int(out["_seen"][-1]), instant[-1].as_py()
        opens = np.zeros(n, bool)
        opens[0] = begins
        return {"_sum": pa.array(out["_sum"]), "_seen": pa.array(out["_seen"]), "_prev": pc.if_else(pa.array(none), pa.scalar(None, pa.int64()), before),
                "_opens": pa.array(opens)}


def carried_ends(ends: list) -> list[tuple]:
    """(task, key, sum, seen, last instant, joined) that each task adds for the key it opens with; ``ends`` has a row per task, in order."""
    out = []
    key, total, seen, last = None, 0, 0, None
    for end in ends:
        goes_on = key is not None and end._open == key
        joined = int(goes_on and last is not None and end._first is not None and end._gap is not None and end._first <= last + end._gap)
        if goes_on:
            out.append((end._part, key, total - joined, seen, last))
        if goes_on and end._open == end._k:
            total, seen = total - joined + end._sum, seen + end._seen
        else:
            total, seen = end._sum, end._seen
        key, last = end._k, end._prev
    return out


def dealt_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], **extra: Column) -> DataFrame:
    """Rows dealt by ranges of key number, key and order, and sorted so in each task, with the key number ``_k`` and ``extra``.
    The exchange holds the rows alone; key numbers and extra columns are worked out in front of it for the ranges and behind it for the task."""
    number = F.xxhash64(*[x for k in keys for x in (F.col(k), F.col(k).isNull())])
    within = [*[F.col(k) for k in keys], *order]  # numbers sort faster than keys, whose first letters are often the same
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, number, *within).withColumns({"_k": number, **extra}).sortWithinPartitions(F.col("_k"), *within)


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column | None = None, instant: Column | None = None,
         gap: Column | None = None, keep: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """Adds ``_sum`` and ``_seen`` (sum and number of the non-NULL values of the key up to this row) and ``_prev`` (microseconds of the
    instant of the row before). With ``gap`` (microseconds) a row that comes later than that after the one before counts 1, others 0.
    Every row is scanned; what is written can be held to the columns ``keep`` and the rows ``where`` (an expression over them)."""
    spark, kept = df.sparkSession, list(df.columns if keep is None else keep)
    nothing = F.lit(None).cast("long")
    dealt = dealt_by(df, keys, order, _v=nothing if value is None else value.cast("long"), _t=nothing if instant is None else F.unix_micros(instant),
                     _gap=nothing if gap is None else gap.cast("long")).select(*kept, "_k", "_gap", "_v", "_t")
    carried_on = [*kept, "_k", "_gap"]
    schema = T.StructType([T.StructField(n, dealt.schema[n].dataType, True) for n in carried_on] + [T.StructField(n, t, True) for n, t in (
        (n, {"long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType()}[t]) for n, t in _SCAN)])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part, gap_, fields = Fragment(), TaskContext.get().partitionId(), None, None
        for batch in batches:
            fields = pa.schema([batch.schema.field(n) for n in carried_on])
            n = batch.num_rows
            if not n:
                continue
            gap_ = batch.column("_gap")[0].as_py()
            new = state.scan(batch.column("_k").to_numpy(), batch.column("_v"), batch.column("_t"), gap_)
            extra = [*new.values(), pa.array(np.full(n, part, np.int32)), pa.array(np.zeros(n, bool)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carried_on)], *extra], names=[*carried_on, *[name for name, _ in _SCAN]])
        if state.key is not None:
            own = {"_k": pa.array([state.key], pa.int64()), "_gap": pa.array([gap_], pa.int64())}
            extra = [pa.array([x], t) for x, t in ((state.sum, pa.int64()), (state.seen, pa.int64()), (state.last, pa.int64()), (False, pa.bool_()),
                                                   (part, pa.int32()), (True, pa.bool_()), (state.open, pa.int64()), (state.first, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*[own.get(f.name, pa.nulls(1, f.type)) for f in fields], *extra],
                                             names=[*fields.names, *[name for name, _ in _SCAN]])

    scanned = dealt.mapInArrow(walk, schema)
    walked = staged(scanned if where is None else scanned.where(F.col("_end") | where), "scan")
    ends = walked.where("_end").select("_part", "_k", "_gap", "_sum", "_seen", "_prev", "_open", "_first").orderBy("_part").collect()
    carry = spark.createDataFrame(carried_ends(ends), "_part int, _k long, _sum0 long, _seen0 long, _prev0 long")  # at most one row per task
    rows = walked.where("NOT _end").join(F.broadcast(carry), ["_part", "_k"], "left")
    zero = F.lit(0).cast("long")
    return rows.select(*kept, (F.col("_sum") + F.coalesce("_sum0", zero)).alias("_sum"), (F.col("_seen") + F.coalesce("_seen0", zero)).alias("_seen"),
                       F.when(F.col("_opens"), F.col("_prev0")).otherwise(F.col("_prev")).alias("_prev"))


def units(df: DataFrame, value: Column) -> tuple[Column, int]:
    """An exact number as a whole number of its last digit, and how many digits follow the point."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, T.DecimalType):
        return (value * F.lit(10 ** kind.scale)).cast("decimal(38,0)"), kind.scale
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return value, 0
    raise TypeError(f"running sums are exact: whole numbers and decimals only, not {kind.simpleString()}")


def join_same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inner join on equality of ``cols`` where NULL equals NULL, so that a row
    without a key or an instant keeps its place. Columns of ``left`` stay."""
    renamed = right.withColumnsRenamed({c: f"_same_{c}" for c in cols})
    on = F.lit(True)
    for c in cols:
        on = on & left[c].eqNullSafe(renamed[f"_same_{c}"])
    return left.join(renamed, on).drop(*[f"_same_{c}" for c in cols])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str, keep: Sequence[str] | None = None,
                where: Column | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of ``keys`` up to and
    including this one in ``order``; NULL up to the first value. ``order`` must be total for a stable result.
    Sums are whole numbers of the last digit and must stay below 2^63 of them. ``keep`` and ``where``: the columns and rows given, as in :func:`scan`."""
    whole, digits = units(df, value)
    total = F.col("_sum")
    if digits:
        total = (total.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(38,{digits})")
    return scan(df, keys, order, value=whole, keep=keep, where=where).select(
        *[c for c in (df.columns if keep is None else keep) if c != out], F.when(F.col("_seen") > 0, total).alias(out))


def lowest_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """Each key once with ``out``, the lowest of its running sums in ``order``; NULL values are passed over, and a key that has no
    other is left out. Rows are dealt as in :func:`scan`, but a task gives one row per key: what the key amounts to there and its lowest
    sum from there. A key over several tasks adds up over these rows. Nothing is written."""
    whole, digits = units(df, value)
    dealt = dealt_by(df.where(whole.isNotNull()), keys, order, _v=whole.cast("long")).select(*keys, "_k", "_v")
    schema = T.StructType([*[dealt.schema[k] for k in keys], *[T.StructField(n, t) for n, t in (
        ("_part", T.IntegerType()), ("_total", T.LongType()), ("_lowest", T.LongType()))]])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, key, total, lowest = TaskContext.get().partitionId(), None, None, 0, 0

        def given(columns: list, totals: np.ndarray, lows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(totals), part, np.int32)), pa.array(totals), pa.array(lows)],
                                              names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            k, v = batch.column("_k").to_numpy(), batch.column("_v").to_numpy()
            start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            run = np.cumsum(v)
            before = (run - v)[start]
            last = np.r_[start[1:], len(k)] - 1
            totals, lows = run[last] - before, np.minimum.reduceat(run, start) - before
            columns = [batch.column(i).take(pa.array(start)) for i in range(len(keys))]
            if held is not None and k[0] == key:
                lows[0] = min(lowest, total + lows[0])
                totals[0] += total
            elif held is not None:
                yield given(held, np.array([total]), np.array([lowest]))
            yield given([x[:-1] for x in columns], totals[:-1], lows[:-1])
            held, key, total, lowest = [x[-1:] for x in columns], k[-1], int(totals[-1]), int(lows[-1])
        if held is not None:
            yield given(held, np.array([total]), np.array([lowest]))

    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_total").over(earlier), F.lit(0).cast("long"))
    low = F.min("_low")
    if digits:
        low = (low.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(38,{digits})")
    return (dealt.mapInArrow(walk, schema).withColumn("_low", F.col("_lowest") + before).groupBy(*keys).agg(low.alias(out)))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """1-based position within ``keys``, without one task per key."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), out)


def previous_instant(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[Column], out: str) -> DataFrame:
    """Adds ``out``: the instant of the row before this one within ``keys``."""
    return scan(df, keys, order, instant=F.col(ts)).select(*[c for c in df.columns if c != out], F.timestamp_micros("_prev").alias(out))


def gap_sessions(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[Column], minutes: int, out: str) -> DataFrame:
    """Adds ``out``: the number of the row's session within ``keys``, from 1; a gap longer than ``minutes`` starts a new
    one. One scan finds gaps and numbers; a session cut by the edge of a task is one fragment there and one behind,
    and is joined if the two lie within the gap."""
    gap = F.lit(minutes * 60_000_000).cast("long")
    return scan(df, keys, order, instant=F.col(ts), gap=gap).select(*[c for c in df.columns if c != out], F.col("_sum").alias(out))


def as_of(events: DataFrame, changes: DataFrame, keys: Sequence[str], at: str, since: str, values: Sequence[str],
          tie: Sequence[str] = ()) -> DataFrame:
    """Events with the ``values`` of the newest change of their key at or before their instant (NULL where there is none). Of
    changes at one instant the last by ``tie`` holds.

    Changes and events are merged into one sorted scan that counts the changes of a key; the count at an event names
    the change in force. The final join is on key and count, so no event meets a change that isn't its own, however many changes
    a key has. A change without instant never applies; an event without instant has none."""
    row = F.struct(*[F.col(x) for x in events.columns])
    held = F.struct(*[F.col(x) for x in values])
    ties = [F.col(x) for x in tie]
    right = changes.where(F.col(since).isNotNull()).select(*keys, F.col(since).alias("_at"), F.lit(0).alias("_kind"),
                                                           *[t.alias(f"_tie{i}") for i, t in enumerate(ties)], held.alias("_held"))
    left = events.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                         *[F.lit(None).cast(right.schema[f"_tie{i}"].dataType).alias(f"_tie{i}") for i in range(len(ties))], row.alias("_row"))
    both = left.unionByName(right, allowMissingColumns=True)
    order = [F.col("_at"), F.col("_kind"), *[F.col(f"_tie{i}") for i in range(len(ties))]]
    merged = scan(both, keys, order, value=F.when(F.col("_kind") == 0, 1).otherwise(0))
    known = merged.where("_kind = 0").select(*[F.col(k).alias(f"_known_{k}") for k in keys], F.col("_sum").alias("_known"), F.col("_held").alias("_now"))
    on = F.col("_sum") == F.col("_known")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_known_{k}"))
    found = merged.where("_kind = 1").drop("_held").join(known, on, "left")
    return found.select(*[F.col(f"_row.`{x}`").alias(x) for x in events.columns], *[F.col(f"_now.`{x}`").alias(x) for x in values])


def rolling_sums(events: DataFrame, points: DataFrame, key: str, ts: str, value: str, point_id: str,
                 spans: dict[str, int], asked: str | None = None) -> DataFrame:
    """For each point, the sum of event values of its key in the trailing days up
    to and including the point's instant (what ``RANGE BETWEEN n DAYS PRECEDING``
    gives). ``spans`` maps an output column to days.

    A point marks where each window opens and where it closes; the answer is the
    difference of two running totals over events and marks together. ``asked`` names an array column of the points with the
    spans that count for a point: the others are NULL and set no mark.
    Returns key, point_id, ts and the output columns.
    """
    nil = F.lit(None).cast("string")
    stream = events.select(key, nil.alias(point_id), F.col(ts).alias("at"), F.lit(1).alias("kind"),
                           nil.alias("span"), F.col(value).cast("decimal(18,2)").alias("v"))
    marks = [F.struct(F.col(ts).alias("at"), F.lit(2).alias("kind"), F.lit("_end").alias("span"))]
    marks += [F.struct((F.col(ts) - F.make_dt_interval(F.lit(d))).alias("at"), F.lit(0).alias("kind"),
                       F.lit(n).alias("span")) for n, d in spans.items()]
    set_for = F.array(*marks) if asked is None else F.array(marks[0], *[
        F.when(F.array_contains(asked, n), m) for n, m in zip(spans, marks[1:])])
    marked = points.select(key, point_id, F.explode(set_for).alias("m")).filter(F.col("m").isNotNull()).select(
        key, point_id, "m.*", F.lit(0).cast("decimal(18,2)").alias("v"))
    order = [F.col("at"), F.col("kind"), F.col(point_id), F.col("span")]
    run = running_sum(stream.unionByName(marked), [key], order, F.col("v"), "_run", [key, point_id, "at", "span"], F.col("span").isNotNull())
    total = F.max(F.when(F.col("span") == "_end", F.col("_run")))
    return (run.groupBy(key, point_id)
            .agg(F.max(F.when(F.col("span") == "_end", F.col("at"))).alias(ts),
                 *[(total - F.max(F.when(F.col("span") == n, F.col("_run"))))
                   .cast("decimal(28,2)").alias(n) for n in spans]))


def part_mark(part: Column) -> Column:
    """What sets the parts of one record apart in keys and ids: nothing for the
    first part, then ~2, ~3 and so on."""
    return F.when(part > 0, F.concat(F.lit("~"), (part + 1).cast("string"))).otherwise(F.lit(""))


def parts_of(rows: Column, part_rows: int) -> Column:
    """How many parts of ``part_rows`` hold ``rows`` rows."""
    return F.ceil(rows / part_rows).cast("int")


def ordered_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: Column, out: str,
                  part_rows: int, whole: Sequence[Column] = ()) -> DataFrame:
    """Items of each key in order, as lists of at most ``part_rows``. A key with
    no more than that has exactly one part; a larger one goes on in further
    parts, so no list outgrows a task and no item is dropped. ``whole`` are totals of the whole key, given beside each of its
    parts; they read the rows as numbered, so ``df`` is not worked out again for them."""
    numbered = row_numbers(df.withColumn("_item", item), keys, [F.col(c) for c in order], "_n")
    part = F.floor((F.col("_n") - 1) / part_rows).cast("int")
    grouped = (numbered.withColumn("part", part)
               .groupBy(*keys, "part")
               .agg(F.array_sort(F.collect_list(F.struct("_n", "_item"))).alias("_items")))
    lists = grouped.withColumn(out, F.transform("_items", lambda x: x["_item"])).drop("_items")
    return join_same(lists, numbered.groupBy(*keys).agg(*whole), keys) if whole else lists
