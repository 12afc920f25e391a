"""Sliced operators against the plain windows they replace, on skewed data."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgertide.operators import ordered


@pytest.fixture(scope="module")
def moves(spark):
    rng = random.Random(7)
    start = datetime(2026, 7, 1)
    rows = []
    for i in range(3000):
        user = "HOT" if i % 3 == 0 else f"U{rng.randrange(300)}"
        ts = start + timedelta(minutes=rng.randrange(60 * 24 * 40))
        rows.append((user, f"R{i:05d}", ts, Decimal(rng.randrange(-5000, 5000)) / 100))
    return spark.createDataFrame(rows, "user string, id string, ts timestamp, amount decimal(18,2)").cache()


def test_running_sum_equals_plain_window(moves):
    order = [F.col("ts"), F.col("id")]
    w = Window.partitionBy("user").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    got = ordered.running_sum(moves, ["user"], order, F.col("amount"), "run")
    want = moves.withColumn("run", F.sum("amount").over(w))
    assert sorted((r.id, r.run) for r in got.collect()) == sorted((r.id, r.run) for r in want.collect())


def test_row_numbers_are_dense_and_ordered(moves):
    got = ordered.row_numbers(moves, ["user"], [F.col("id")], "n")
    per = {}
    for r in got.collect():
        per.setdefault(r.user, []).append((r.id, r.n))
    for rows in per.values():
        assert [n for _, n in sorted(rows)] == list(range(1, len(rows) + 1))


def test_previous_instant_equals_lag(moves):
    order = [F.col("ts"), F.col("id")]
    got = ordered.previous_instant(moves, ["user"], "ts", order, "prev")
    want = moves.withColumn("prev", F.lag("ts").over(Window.partitionBy("user").orderBy(*order)))
    assert {r.id: r.prev for r in got.collect()} == {r.id: r.prev for r in want.collect()}


def test_rolling_sums_equal_range_frames(moves):
    got = ordered.rolling_sums(moves, moves, "user", "ts", "amount", "id", {"D1": 1, "D7": 7})
    sec = F.col("ts").cast("long")
    frame = lambda n: Window.partitionBy("user").orderBy(sec).rangeBetween(-86400 * n, 0)
    want = moves.select("id", F.sum("amount").over(frame(1)).alias("D1"), F.sum("amount").over(frame(7)).alias("D7"))
    assert {r.id: (r.D1, r.D7) for r in got.collect()} == {r.id: (r.D1, r.D7) for r in want.collect()}


def test_lists_are_whole_and_bounded(moves):
    got = ordered.ordered_lists(moves, ["user"], ["ts", "id"], F.col("id"), "ids", 100).collect()
    want = {}
    for r in moves.orderBy("ts", "id").collect():
        want.setdefault(r.user, []).append(r.id)
    joined = {}
    for r in sorted(got, key=lambda r: (r.user, r.part)):
        assert len(r.ids) <= 100
        joined.setdefault(r.user, []).extend(r.ids)
    assert joined == want


def test_rows_without_key_or_instant_keep_their_place(moves):
    odd = moves.withColumn("user", F.when(F.pmod(F.xxhash64("id"), F.lit(5)) != 0, F.col("user"))).withColumn(
        "ts", F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7)) != 0, F.col("ts")))
    order = [F.col("ts"), F.col("id")]
    w = Window.partitionBy("user").orderBy(*order)
    got = ordered.running_sum(odd, ["user"], order, F.col("amount"), "run")
    got = ordered.previous_instant(got, ["user"], "ts", order, "prev")
    want = odd.withColumn("run", F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("prev", F.lag("ts").over(w))
    both = [sorted((r.id, r.run, str(r.prev)) for r in x.collect()) for x in (got, want)]
    assert len(both[0]) == 3000 and both[0] == both[1]


def brute_sessions(rows, minutes):
    """(user, number) of each row, walking every user's rows in order."""
    out, by = {}, {}
    for r in rows:
        by.setdefault(r.user, []).append(r)
    for user, mine in by.items():
        n, before = 0, None
        for r in sorted(mine, key=lambda r: (r.ts is not None, r.ts or datetime.min, r.id)):
            n += before is None or (r.ts is not None and r.ts > before + timedelta(minutes=minutes))
            before, out[r.id] = r.ts, n
    return out


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_gap_sessions_join_over_task_edges(spark, moves, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = ordered.gap_sessions(moves, ["user"], "ts", [F.col("ts"), F.col("id")], 90, "no").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert {r.id: r.no for r in got} == brute_sessions(moves.collect(), 90)


def test_sessions_sums_and_numbers_with_nulls_and_one_key_over_all_tasks(spark):
    start = datetime(2026, 7, 1)
    rows = [(None if i % 3 == 0 else "HOT", f"R{i:04d}", None if i % 11 == 0 else start + timedelta(minutes=7 * (i % 90)),
             None if i % 5 == 0 else Decimal(i) / 100) for i in range(400)]
    df = spark.createDataFrame(rows, "user string, id string, ts timestamp, amount decimal(18,2)")
    order = [F.col("ts"), F.col("id")]
    w = Window.partitionBy("user").orderBy(*order)
    got = ordered.gap_sessions(df, ["user"], "ts", order, 5, "no").collect()
    assert {r.id: r.no for r in got} == brute_sessions(df.collect(), 5)
    got = ordered.running_sum(df, ["user"], order, F.col("amount"), "run").collect()
    want = df.withColumn("run", F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0))).collect()
    assert {r.id: r.run for r in got} == {r.id: r.run for r in want}
    assert ordered.running_sum(df.where("false"), ["user"], order, F.col("amount"), "run").collect() == []
    with pytest.raises(TypeError):
        ordered.running_sum(df.withColumn("f", F.lit(0.5)), ["user"], order, F.col("f"), "run")


def test_the_input_of_a_running_sum_is_read_into_one_exchange(spark, moves, tmp_path):
    moves.write.parquet(str(tmp_path / "moves"))
    stored = spark.read.parquet(str(tmp_path / "moves"))
    got = ordered.running_sum(stored, ["user"], [F.col("ts"), F.col("id")], F.col("amount"), "run")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "/moves" not in plan and "Window" not in plan


def test_as_of_join_with_many_changes(spark):
    rng, start = random.Random(11), datetime(2026, 7, 1)
    at = lambda: start + timedelta(minutes=rng.randrange(4000))
    who = lambda: "HOT" if rng.random() < 0.5 else rng.choice(["A", "B", None])
    events = [(who(), i, None if i % 50 == 0 else at()) for i in range(600)]
    changes = [(who(), i, None if i % 40 == 0 else at(), None if i % 7 == 0 else i) for i in range(300)]
    events += [(c[0], 1000 + c[1], c[2]) for c in changes[:60]]  # an event at the very instant of a change
    changes += [(c[0], 500 + c[1], c[2], 500 + c[1]) for c in changes[:20]]  # two changes at one instant
    e = spark.createDataFrame(events, "user string, id int, at timestamp")
    ch = spark.createDataFrame(changes, "user string, no int, since timestamp, cap int")
    got = ordered.as_of(e, ch, ["user"], "at", "since", ["no", "cap"], ["no"]).collect()
    want = {}
    for user, i, when in events:
        before = [(c[2], c[1], c[3]) for c in changes if c[0] == user and c[2] is not None and when is not None and c[2] <= when]
        want[i] = max(before)[1:] if before else (None, None)
    assert {r.id: (r.no, r.cap) for r in got} == want and len(got) == len(events)
