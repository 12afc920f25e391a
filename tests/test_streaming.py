"""Each streaming job against its batch twin, driven to completion."""

from datetime import datetime

from pyspark.sql import functions as F

from ledgertide import markets
from ledgertide.operators import cdc, sessions
from ledgertide.streaming import jobs


def t(text):
    return datetime.fromisoformat(text)


def land(spark, path, rows, schema, name="part"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def collect_stream(spark, df, tmp_path, mode="append"):
    query = (df.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ck")).outputMode(mode).trigger(availableNow=True).start())
    query.awaitTermination(120)
    return spark.read.parquet(str(tmp_path / "out"))


CDC = "account_id string, kyc_status string, _op string, _commit_ts timestamp"


def test_replays_are_dropped_and_latest_image_matches_batch(spark, tmp_path):
    rows = [("A1", "PENDING", "I", t("2026-07-01 10:00")), ("A2", "PENDING", "I", t("2026-07-01 10:00")),
            ("A1", "PENDING", "I", t("2026-07-01 10:00"))]
    more = [("A1", "VERIFIED", "U", t("2026-07-01 10:05")), ("A2", "PENDING", "D", t("2026-07-01 10:06")),
            ("A1", "VERIFIED", "U", t("2026-07-01 10:05"))]
    path = str(tmp_path / "in")
    land(spark, path, rows, CDC)
    stream = land(spark, path, more, CDC)
    once = collect_stream(spark, jobs.replay_free(stream, ["account_id"]), tmp_path / "dedup")
    assert once.count() == 4

    jobs.latest_images(stream, ["account_id"], str(tmp_path / "img"), str(tmp_path / "ck2")).awaitTermination(120)
    got = jobs.read_latest(spark, str(tmp_path / "img")).select("account_id", "kyc_status").collect()
    want = cdc.latest_image(spark.read.schema(CDC).parquet(path), ["account_id"]).select("account_id", "kyc_status").collect()
    assert sorted(got) == sorted(want) == [("A1", "VERIFIED")]


def test_late_first_images_are_kept_and_late_replays_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, [("A1", "PENDING", "I", t("2026-07-01 10:00"))], CDC)
    land(spark, path, [("A2", "PENDING", "I", t("2026-07-01 15:00"))], CDC)
    land(spark, path, [("A3", "PENDING", "I", t("2026-07-01 20:00"))], CDC)
    stream = land(spark, path, [("A4", "PENDING", "I", t("2026-07-01 09:00")), ("A1", "PENDING", "I", t("2026-07-01 10:00"))], CDC)
    once = collect_stream(spark, jobs.replay_free(stream, ["account_id"]), tmp_path / "dedup")
    assert sorted(r.account_id for r in once.collect()) == ["A1", "A2", "A3", "A4"]


def test_delivery_logs_each_key_once_over_batches(spark, tmp_path):
    schema = "slip_id string, jurisdiction string, terminal_at timestamp"
    path = str(tmp_path / "in")
    land(spark, path, [("S1", "MT", t("2026-07-01 10:00")), ("S2", "ES", t("2026-07-01 10:01"))], schema)
    stream = land(spark, path, [("S1", "MT", t("2026-07-01 10:00")), ("S3", "MT", t("2026-07-01 10:02"))], schema)

    def pending(batch, log):
        return batch.select(F.lit("bets").alias("record_type"), F.concat("slip_id", F.lit("|SETTLED")).alias("record_key"),
                            "jurisdiction", F.lit("R").alias("receipt_id"), F.col("terminal_at").alias("submitted_at"))
    jobs.deliver(stream, pending, str(tmp_path / "log"), str(tmp_path / "ck")).awaitTermination(120)
    log = spark.read.parquet(str(tmp_path / "log"))
    assert sorted(r.record_key for r in log.collect()) == ["S1|SETTLED", "S2|SETTLED", "S3|SETTLED"]


def test_session_timeout_and_logout(spark, tmp_path):
    schema = "session_id string, ts timestamp, minutes int, kind string"
    path = str(tmp_path / "in")
    land(spark, path, [("G1", t("2026-07-01 10:00"), 30, "ACTIVITY"), ("G2", t("2026-07-01 10:00"), 30, "ACTIVITY")], schema)
    land(spark, path, [("G1", t("2026-07-01 10:20"), 30, "ACTIVITY"), ("G2", t("2026-07-01 10:10"), 30, "LOGOUT")], schema)
    land(spark, path, [("G9", t("2026-07-01 12:00"), 30, "ACTIVITY")], schema)
    stream = land(spark, path, [("G9", t("2026-07-01 12:01"), 30, "LOGOUT")], schema)
    out = {r.session_id: (r.end_reason, r.ended_at) for r in
           collect_stream(spark, jobs.session_timeouts(stream), tmp_path).collect()}
    assert out["G1"] == ("INACTIVITY", t("2026-07-01 10:50"))
    assert out["G2"] == ("LOGOUT", t("2026-07-01 10:10"))


def test_retry_state_counts_due_attempts_and_resolves(spark, tmp_path):
    schema = "entity_id string, reason_code string, ts timestamp"
    path = str(tmp_path / "in")
    for text in ("2026-07-01 10:00", "2026-07-01 10:05", "2026-07-01 10:20"):
        stream = land(spark, path, [("A1", "region_not_found", t(text))], schema)
    land(spark, path, [("Z", "other", t("2026-07-03 10:00"))], schema)
    rows = collect_stream(spark, jobs.retry_states(stream), tmp_path).filter("entity_id = 'A1'").collect()
    by_status = sorted((r.attempt_count, r.status) for r in rows)
    assert (1, "RETRYING") in by_status and (2, "RETRYING") in by_status
    assert max(by_status)[0] == 2 and by_status[-1][1] == "RETRYING"
    assert (2, "RESOLVED") in by_status


def test_session_windows_match_batch_sessions(spark, tmp_path):
    schema = "account_id string, payment_id string, ts timestamp"
    path = str(tmp_path / "in")
    rows = [("A1", "P1", t("2026-07-01 10:00")), ("A1", "P2", t("2026-07-01 10:20")), ("A1", "P3", t("2026-07-01 11:30"))]
    stream = land(spark, path, rows, schema)
    land(spark, path, [("Z", "P9", t("2026-07-05 10:00"))], schema)
    land(spark, path, [("Z", "P8", t("2026-07-05 10:00"))], schema)
    out = collect_stream(spark, jobs.session_windows(stream, "account_id", "ts", "30 minutes"), tmp_path)
    got = sorted((r.started_at, r.last_activity_ts, r.activities) for r in out.filter("account_id = 'A1'").collect())
    batch = sessions.session_summary(sessions.sessionise(
        spark.createDataFrame(rows, schema), "account_id", "ts", "payment_id", 30), "account_id", "ts")
    want = sorted((r.started_at, r.last_activity_ts, r.activities) for r in batch.collect())
    assert got == want and len(want) == 2


def test_limit_windows_use_local_days_and_monday_weeks(spark, tmp_path):
    schema = "account_id string, ts timestamp, zone string, amount decimal(18,2)"
    path = str(tmp_path / "in")
    from decimal import Decimal as D
    # 23:30 UTC on Sunday 5 July is Monday 6 July in Madrid
    rows = [("A1", t("2026-07-05 23:30"), "Europe/Madrid", D("10")), ("A1", t("2026-07-06 10:00"), "Europe/Madrid", D("5"))]
    stream = land(spark, path, rows, schema)
    for day in ("2026-07-20 10:00", "2026-07-20 11:00"):
        land(spark, path, [("Z", t(day), "Europe/Madrid", D("1"))], schema)
    for period, start in (("DAILY", "2026-07-06"), ("WEEKLY", "2026-07-06")):
        out = collect_stream(spark, jobs.limit_windows(stream, "account_id", "ts", "zone", "amount", period), tmp_path / period)
        got = [(str(r.window_start), r.total) for r in out.filter("account_id = 'A1'").collect()]
        assert got == [(start, D("15.00"))]


def test_limit_windows_lose_nothing_across_zones(spark, tmp_path):
    schema = "account_id string, ts timestamp, zone string, amount decimal(18,2)"
    path = str(tmp_path / "in")
    from decimal import Decimal as D
    land(spark, path, [("L", t("2026-07-05 10:00"), "Europe/Lisbon", D("10"))], schema, "a")
    land(spark, path, [("G", t("2026-07-05 22:30"), "Pacific/Kiritimati", D("1"))], schema)
    land(spark, path, [("L", t("2026-07-05 22:31"), "Europe/Lisbon", D("5"))], schema)
    for day in ("2026-07-20 10:00", "2026-07-20 11:00"):
        stream = land(spark, path, [("Z", t(day), "Europe/Lisbon", D("1"))], schema)
    out = collect_stream(spark, jobs.limit_windows(stream, "account_id", "ts", "zone", "amount", "DAILY"), tmp_path)
    assert [(str(r.window_start), r.total) for r in out.filter("account_id = 'L'").collect()] == [("2026-07-05", D("15.00"))]


def test_waiting_rows_are_filed_once_their_period_opens(spark, tmp_path):
    schema = "jurisdiction string, report_date date, slip_id string"
    marks = "source string, jurisdiction string, complete_through timestamp"
    path, wm = str(tmp_path / "in"), str(tmp_path / "wm")
    d = t("2026-07-01").date()

    def run(rows, through):
        stream = land(spark, path, rows, schema)
        spark.createDataFrame([("bet_settlement", "MT", through)], marks).write.mode("overwrite").parquet(wm)
        jobs.gate_by_readiness(stream, wm, markets.market_frame(spark), str(tmp_path / "ready"), str(tmp_path / "waiting"),
                               str(tmp_path / "ck")).awaitTermination(120)
        return sorted(r.slip_id for r in spark.read.parquet(str(tmp_path / "ready")).collect())
    assert run([("MT", d, "S1")], t("2026-07-01 12:00")) == []
    assert run([("MT", d, "S2"), ("ES", d, "S3")], t("2026-07-02 06:00")) == ["S1", "S2"]
    assert run([("ES", d, "S4")], t("2026-07-02 06:00")) == ["S1", "S2"]
    waiting = spark.read.parquet(str(tmp_path / "waiting")).filter("batch_id = 2").collect()
    assert sorted(r.slip_id for r in waiting) == ["S3", "S4"]


def test_readiness_gate_waits_for_watermark_and_late_rows_split(spark, tmp_path):
    schema = "jurisdiction string, report_date date, slip_id string"
    path = str(tmp_path / "in")
    d = t("2026-07-01").date()
    stream = land(spark, path, [("MT", d, "S1"), ("ES", d, "S2"), ("DK", d, "S3")], schema)
    marks = [("bet_settlement", "MT", t("2026-07-02 06:00")), ("bet_settlement", "ES", t("2026-07-01 20:00"))]
    spark.createDataFrame(marks, "source string, jurisdiction string, complete_through timestamp").write.parquet(str(tmp_path / "wm"))
    jobs.gate_by_readiness(stream, str(tmp_path / "wm"), markets.market_frame(spark), str(tmp_path / "ready"),
                           str(tmp_path / "waiting"), str(tmp_path / "ck")).awaitTermination(120)
    assert [r.slip_id for r in spark.read.parquet(str(tmp_path / "ready")).collect()] == ["S1"]
    assert sorted(r.slip_id for r in spark.read.parquet(str(tmp_path / "waiting")).collect()) == ["S2", "S3"]
    rows = spark.createDataFrame([(t("2026-07-01 09:00"),), (t("2026-07-01 11:00"),)], "ts timestamp")
    fresh, late = jobs.split_late(rows, "ts", F.lit("2026-07-01 10:00").cast("timestamp"))
    assert fresh.count() == late.count() == 1
