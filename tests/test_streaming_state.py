"""Streaming jobs with state of bounded size, against their batch twins."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from ledgertide import markets
from ledgertide.operators import protection
from ledgertide.streaming import jobs, replay, restate, rolling

from .test_streaming import collect_stream, land, t


DEPOSIT = "account_id string, payment_id string, completed_ts timestamp, amount decimal(18,2)"


def test_rolling_sums_from_state_equal_the_batch_audit(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKSDB)
    rng, start, path = random.Random(3), datetime(2026, 6, 1), str(tmp_path / "in")
    rows = []
    for i in range(240):
        at = start + timedelta(minutes=10 * rng.randrange(6 * 24 * 50))
        rows.append(("A1" if i % 3 == 0 else f"A{rng.randrange(2, 6)}", f"P{i:03d}", at, Decimal(rng.randrange(100, 5000)) / 100))
    rows.sort(key=lambda r: r[2])
    rows += [("A1", "P900", rows[40][2] - timedelta(days=1), Decimal("5.00"))]  # the same instant a day before another deposit
    rows.sort(key=lambda r: r[2])
    for k in range(0, len(rows), 60):
        part = rows[k:k + 60]
        rng.shuffle(part)
        stream = land(spark, path, part, DEPOSIT)
    end = [("ZZ", "END", rows[-1][2] + timedelta(days=5), Decimal("1.00"))]
    stream = land(spark, path, end, DEPOSIT)
    limits = spark.createDataFrame([("L1", f"A{k}", f"DEPOSIT_{p}", Decimal(a), None) for k in range(1, 6)
                                    for p, a in (("DAILY", "40"), ("WEEKLY", "90"), ("MONTHLY", "250"))],
                                   "limit_id string, account_id string, limit_type string, amount decimal(18,2), revoked_at timestamp")
    got = collect_stream(spark, rolling.rolling_limits(stream, limits), tmp_path)
    batch = spark.createDataFrame(rows, DEPOSIT).withColumns({"direction": F.lit("DEPOSIT"), "status": F.lit("COMPLETED")})
    want = protection.rolling_deposit_audit(batch, limits)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 20


IMAGE = "account_id string, kyc_status string, _op string, _commit_ts timestamp"


def test_replays_over_many_days_leave_no_state_and_late_first_images_stay(spark, tmp_path):
    rng, path, out = random.Random(5), str(tmp_path / "in"), str(tmp_path / "out")
    sent = []
    for day in range(1, 6):
        fresh = [(f"A{i}" if i else None, "PENDING", "I", datetime(2026, 7, day, 9, i % 60)) for i in range(30)]
        late = [(f"L{day}", "PENDING", "I", datetime(2026, 7, 1, 8, day))]  # a first image of the first day, days later
        replays = rng.sample(sent, min(len(sent), 25))
        sent += fresh + late
        stream = land(spark, path, fresh + late + replays + fresh[:5], IMAGE)
    query = replay.replay_free_images(stream, ["account_id"], out, str(tmp_path / "ck"))
    query.awaitTermination(180)
    assert not any(p.stateOperators for p in query.recentProgress)
    got = spark.read.schema(IMAGE).option("recursiveFileLookup", "true").parquet(out + "/images").collect()
    assert sorted(map(tuple, got), key=str) == sorted(sent, key=str)


def test_a_batch_that_runs_again_gives_the_same_images(spark, tmp_path):
    batch = spark.createDataFrame([("A1", "PENDING", "I", t("2026-07-01 10:00")), ("A2", "PENDING", "I", None)], IMAGE)
    assert replay.new_images(batch, ["account_id"], str(tmp_path / "none"), 0).count() == 2


def test_late_rows_restate_exactly_their_period(spark, tmp_path):
    facts, amended, log = (str(tmp_path / x) for x in ("facts", "amended", "log"))
    schema = "jurisdiction string, report_date date, slip_id string, settled_at timestamp, stake decimal(18,2)"
    day = t("2026-07-01").date()
    row = lambda m, i, at, stake, d=day: (m, d, i, t(at), Decimal(stake))
    first = [row("MT", "S1", "2026-07-01 10:00", "5"), row("ES", "S2", "2026-07-01 11:00", "7"),
             row("MT", "S3", "2026-07-02 10:00", "9", t("2026-07-02").date())]
    spark.createDataFrame(first, schema).write.partitionBy("jurisdiction", "report_date").parquet(facts + "/batch_id=-1")
    spark.createDataFrame([("period", f"{m}|2026-07-0{d}", m, f"{m}-70{d}", t("2026-07-03 06:00")) for m, d in (("MT", 1), ("ES", 1), ("MT", 2))],
                          restate.LOG).write.parquet(log + "/batch_id=-1")
    path = str(tmp_path / "in")
    land(spark, path, [row("MT", "S4", "2026-07-01 12:00", "11"), row("DK", "S5", "2026-07-01 12:00", "13"),
                       row("ES", "S6", "2026-07-04 12:00", "17", t("2026-07-04").date())], schema)
    stream = land(spark, path, [row("MT", "S7", "2026-07-01 13:00", "1")], schema)
    marks = spark.createDataFrame([(m, t("2026-07-03 00:00")) for m in ("MT", "ES", "DK")], "jurisdiction string, complete_through timestamp")
    figures = lambda df: df.groupBy("jurisdiction", "report_date").agg(F.sum("stake").alias("stake"), F.count("*").alias("slips"))
    restate.restate_late(stream, "settled_at", lambda: marks, figures, facts, amended, log,
                         lambda: F.lit("2026-07-05 06:00").cast("timestamp"), str(tmp_path / "ck")).awaitTermination(180)
    got = spark.read.parquet(amended).orderBy("batch_id").collect()
    assert [(r.batch_id, r.jurisdiction, r.report_date, r.stake, r.slips) for r in got] == [
        (0, "MT", day, Decimal("16.00"), 2), (1, "MT", day, Decimal("17.00"), 3)]
    receipts = {r.record_key: r.receipt_id for r in restate.read_log(spark, log).collect()}
    assert receipts == {"MT|2026-07-01": "MT-701-R2", "ES|2026-07-01": "ES-701", "MT|2026-07-02": "MT-702"}


def test_waiting_rows_are_filed_on_a_quiet_stream(spark, tmp_path):
    import time
    path, marks, day = str(tmp_path / "in"), str(tmp_path / "wm"), t("2026-07-01").date()
    schema = "source string, jurisdiction string, complete_through timestamp"
    stream = land(spark, path, [("MT", day, "S1")], "jurisdiction string, report_date date, slip_id string")
    spark.createDataFrame([("bet_settlement", "MT", t("2026-06-30 06:00"))], schema).write.parquet(marks)
    query = jobs.gate_by_readiness(stream, marks, markets.market_frame(spark), str(tmp_path / "ready"), str(tmp_path / "waiting"),
                                   str(tmp_path / "ck"), interval="1 second")
    ready = lambda: [r.slip_id for r in spark.read.schema("slip_id string").option("recursiveFileLookup", "true").parquet(str(tmp_path / "ready")).collect()]
    try:
        until = time.time() + 60
        while time.time() < until and not (tmp_path / "waiting" / "batch_id=0").exists():
            time.sleep(0.5)
        spark.createDataFrame([("bet_settlement", "MT", t("2026-07-02 06:00"))], schema).write.mode("append").parquet(marks)
        while time.time() < until and not ready():
            time.sleep(0.5)
        assert ready() == ["S1"]
    finally:
        query.stop()
