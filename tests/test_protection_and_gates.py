"""Breaches, exceptions, rules, reconciliation, delivery and sinks."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgertide import markets
from ledgertide.operators import delivery, exceptions, ordered, protection, recon, rules, submissions
from ledgertide.sources import sinks

from .helpers import d, m, t

NOW = "2026-07-08 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def test_statutory_caps_fold_bands_by_age_and_date(spark):
    rows = spark.createDataFrame([("DE", 19, d("2026-06-30")), ("DE", 19, d("2026-07-01")), ("DE", 30, d("2026-07-01")),
                                  ("MT", 20, d("2026-09-15")), ("MT", 20, d("2026-09-14")), ("FR", 40, d("2026-09-15"))],
                                 "jurisdiction string, age int, day date")
    cap = protection.statutory_cap(F.col("jurisdiction"), F.col("age"), F.col("day")).alias("cap")
    got = {(r.jurisdiction, r.age, str(r.day)): r.cap for r in rows.select("*", cap).collect()}
    assert got == {("DE", 19, "2026-06-30"): m("1.00"), ("DE", 19, "2026-07-01"): m("1.00"), ("DE", 30, "2026-07-01"): m("3.00"),
                   ("MT", 20, "2026-09-15"): m("2.00"), ("MT", 20, "2026-09-14"): m("5.00"), ("FR", 40, "2026-09-15"): None}


def test_overspend_takes_credits_first_at_one_instant(spark):
    at = t("2026-07-01 10:00")
    rows = [("A1", at, "BET_STAKE", m("-10"), "S1"), ("A1", at, "DEPOSIT", m("10"), "P1"), ("A2", at, "BET_STAKE", m("-1"), "S2")]
    ledger = spark.createDataFrame(rows, "account_id string, ts timestamp, entry_type string, signed_amount decimal(18,2), ref string")
    assert [(r.account_id, r.running_balance) for r in protection.breach_wallet_overspend(ledger).collect()] == [("A2", m("-1.00"))]


def test_withdrawal_before_verification(spark):
    pay = spark.createDataFrame([("W1", "A1", "ES", t("2026-07-01 10:00")), ("W2", "A1", "ES", t("2026-07-03 10:00")), ("W3", "A2", "ES", t("2026-07-03 10:00"))],
                                "payment_id string, account_id string, jurisdiction string, completed_ts timestamp").withColumns(
        {"direction": F.lit("WITHDRAWAL"), "status": F.lit("COMPLETED"), "amount": F.lit(1)})
    checks = spark.createDataFrame([("A1", "IDENTITY", "VERIFIED", t("2026-07-02 10:00")), ("A2", "ADDRESS", "VERIFIED", t("2026-07-01 10:00"))],
                                   "account_id string, check_type string, status string, event_ts timestamp")
    got = protection.breach_unverified_withdrawals(pay, checks, markets.market_frame(spark))
    assert sorted(r.payment_id for r in got.collect()) == ["W1", "W3"]


def addresses(spark, rows):
    a = spark.createDataFrame([(r[0], r[2], "x") for r in rows], "account_id string, postcode string, city string")
    p = spark.createDataFrame([(r[0], r[1]) for r in rows], "account_id string, jurisdiction string")
    regions = spark.createDataFrame([("VLT", "Valletta")], "postcode_prefix string, region_name string")
    return exceptions.validate_addresses(a, p, regions, markets.market_frame(spark))


def test_bad_format_outranks_missing_region(spark):
    got = {r.account_id: (r.fail_reason, r.error_class) for r in addresses(
        spark, [("A1", "MT", "VLT 1234"), ("A2", "MT", "12345"), ("A3", "MT", "GZO 1234"), ("A4", "ES", "28001"), ("A5", "NL", "1234AB")]).collect()}
    assert got == {"A1": (None, None), "A2": ("postcode_format", "DATA"), "A3": ("region_not_found", "TRANSIENT"),
                   "A4": (None, None), "A5": ("postcode_format", "DATA")}


def test_retry_step_counts_due_attempts_escalates_and_resolves(spark):
    seen = addresses(spark, [("N1", "MT", "GZO 1111"), ("D1", "MT", "GZO 1112"), ("W1", "MT", "GZO 1113"), ("X1", "MT", "GZO 1114")])
    schema = ("entity_type string, entity_id string, reason_code string, error_class string, attempt_count int, "
              "first_seen timestamp, next_retry_at timestamp, status string")
    row = lambda e, n, due: ("ADDRESS", e, "region_not_found", "TRANSIENT", n, t("2026-07-01 00:00"), due, "RETRYING")
    state = spark.createDataFrame([row("D1", 2, t("2026-07-08 11:00")), row("W1", 2, t("2026-07-08 13:00")),
                                   row("X1", 5, t("2026-07-08 11:00")), row("GONE", 1, t("2026-07-08 11:00"))], schema)
    got = {r.entity_id: (r.attempt_count, r.status, r.next_retry_at) for r in exceptions.retry_step(seen, state, now()).collect()}
    assert got == {"N1": (1, "RETRYING", t("2026-07-08 12:15")), "D1": (3, "RETRYING", t("2026-07-08 13:00")),
                   "W1": (2, "RETRYING", t("2026-07-08 12:30")), "X1": (6, "QUARANTINED", None), "GONE": (1, "RESOLVED", None)}


def test_missing_watermark_fails_closed_and_null_ids_do_not_empty_a_file(spark):
    periods = spark.createDataFrame([("A1", "MT", d("2026-07-01")), ("A1", "ES", d("2026-07-01"))], "account_id string, jurisdiction string, report_date date")
    marks = spark.createDataFrame([("bet_settlement", "MT", t("2026-07-02 01:00"))], "source string, jurisdiction string, complete_through timestamp")
    ready = exceptions.period_readiness(periods, marks, markets.market_frame(spark))
    assert {r.jurisdiction: r.is_ready for r in ready.collect()} == {"MT": True, "ES": False}
    blocked = spark.createDataFrame([(None,), ("B1",)], "account_id string")
    rows = periods.unionByName(spark.createDataFrame([("B1", "MT", d("2026-07-01"))], periods.schema))
    assert [r.account_id for r in submissions.admissible(rows, blocked, ready).collect()] == ["A1"]


def test_isolation_gate_judges_open_periods_by_date(spark):
    file = spark.createDataFrame([("S1", d("2026-07-01"))], "slip_id string, report_date date")
    life = spark.createDataFrame([("S1", "A1")], "slip_id string, account_id string")
    schema = "block_scope string, status string, account_id string, report_date date"
    other_day = spark.createDataFrame([("PERIOD", "WAITING_DATA", "A1", d("2026-07-02"))], schema)
    assert exceptions.isolation_breaches(file, life, other_day).count() == 0
    same_day = spark.createDataFrame([("PERIOD", "WAITING_DATA", "A1", d("2026-07-01"))], schema)
    assert exceptions.isolation_breaches(file, life, same_day).count() == 1
    with pytest.raises(exceptions.GateClosed):
        exceptions.run_gate({"isolation": exceptions.isolation_breaches(file, life, same_day)})


CORRUPT = [("not_null", "slip_id", None, {"slip_id": None}), ("non_negative", "stake", None, {"stake": m("-1")}),
           ("max_value", "stake", 50000, {"stake": m("50001")}), ("in_set", "slip_status", ["SETTLED", "VOIDED"], {"slip_status": "OPEN"}),
           ("matches", "ref", "^TT-[0-9A-F]{8}$", {"ref": "TT-xyz"}), ("zero_when", "payout", ("slip_status", "VOIDED"), {"slip_status": "VOIDED"}),
           ("code_in_set", "sport_code", ["01", "99"], {"sport_code": None})]


@pytest.mark.parametrize("kind,field,arg,broken", CORRUPT, ids=[c[0] for c in CORRUPT])
def test_each_row_rule_finds_exactly_the_corrupted_row(spark, kind, field, arg, broken):
    good = dict(slip_id="S1", stake=m("5"), payout=m("3"), slip_status="SETTLED", ref="TT-0123ABCD", sport_code="01", report_date=d("2026-07-01"))
    schema = "slip_id string, stake decimal(18,2), payout decimal(18,2), slip_status string, ref string, sport_code string, report_date date"
    names = [x.split()[0] for x in schema.split(", ")]
    rows = [tuple(r[n] for n in names) for r in (good, {**good, "slip_id": "S2", **broken})]
    got = rules.row_rules(spark.createDataFrame(rows, schema), [("R", kind, field, arg)], "stake").collect()
    assert len(got) == 1 and got[0].rule_id == "R"


def test_rule_runs_in_one_scan_without_shuffle(spark):
    df = spark.createDataFrame([("S1", m("1"))], "slip_id string, stake decimal(18,2)").withColumn("report_date", F.current_date())
    plan = rules.row_rules(df, [("A", "not_null", "slip_id", None), ("B", "non_negative", "stake", None)], "slip_id")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_duplicate_keys_and_two_games_in_one_session(spark):
    df = spark.createDataFrame([("S1",), ("S1",), ("S2",)], "slip_id string")
    assert [r.row_key for r in rules.unique_rule(df, "U", "slip_id").collect()] == ["S1"]
    stamped = spark.createDataFrame([("A", "GS:1", "G1"), ("A", "GS:1", "OJ1"), ("A", "GS:2", "G1")], "account_id string, game_session_id string, game_id string")
    people = spark.createDataFrame([("A", "NL")], "account_id string, jurisdiction string")
    assert [r.row_key for r in rules.single_game_session(stamped, people, ["NL"]).collect()] == ["GS:1"]


def flows(spark, seed):
    """Random but consistent payments, slips and rounds of one market."""
    rng, start = random.Random(seed), datetime(2026, 7, 1)
    at = lambda: start + timedelta(minutes=rng.randrange(60 * 24 * 6))
    cash = lambda: Decimal(rng.randrange(1, 9000)) / 100
    market = rng.choice(["MT", "ES", "DE", "NL"])
    pay = [(f"P{i}", "A1", market, rng.choice(["DEPOSIT", "WITHDRAWAL"]), cash(), "COMPLETED", at()) for i in range(30)]
    bets = []
    for i in range(60):
        placed = at()
        settled = placed + timedelta(hours=rng.randrange(1, 40)) if rng.random() < 0.7 else None
        voided = placed + timedelta(hours=rng.randrange(41, 60)) if rng.random() < 0.3 else None
        bets.append((f"S{i}", "A1", market, placed, cash(), settled, cash() if settled else None, voided))
    plays = [(f"R{i}", "A1", market, rng.choice(["CASH", "GOLDEN_CHIP"]), cash(), cash(), at()) for i in range(40)]
    return (spark.createDataFrame(pay, "payment_id string, account_id string, jurisdiction string, direction string, amount decimal(18,2), status string, completed_ts timestamp"),
            spark.createDataFrame(bets, "slip_id string, account_id string, jurisdiction string, placed_at timestamp, stake decimal(18,2), settled_at timestamp, payout decimal(18,2), voided_at timestamp"),
            spark.createDataFrame(plays, "round_id string, account_id string, jurisdiction string, funding string, stake decimal(18,2), payout decimal(18,2), round_ts timestamp"))


@pytest.mark.parametrize("seed", [1, 2])
def test_bridge_residual_is_zero_for_any_flows(spark, seed):
    pay, bets, plays = flows(spark, seed)
    daily = recon.daily_reconciliation(recon.daily_flows(pay, bets, plays), markets.market_frame(spark), markets.betting_rate_frame(spark))
    rows = daily.collect()
    assert rows and all(r.residual == 0 for r in rows)
    month = recon.monthly_reconciliation(daily).collect()
    assert sum(r.duty for r in rows) == sum(r.duty for r in month) and all(r.days_off == 0 for r in month)
    total = recon.cash_flow(pay, bets, plays).agg(F.sum("amount")).first()[0]
    assert max(rows, key=lambda r: r.day).closing_balance == total


def test_worked_bridge_example(spark):
    day = "2026-07-01 "
    pay = spark.createDataFrame([("P", "A", "MT", "DEPOSIT", m("100"), "COMPLETED", t(day + "09:00"))],
                                "payment_id string, account_id string, jurisdiction string, direction string, amount decimal(18,2), status string, completed_ts timestamp")
    bets = spark.createDataFrame([("S1", "A", "MT", t(day + "10:00"), m("40"), t(day + "12:00"), m("60"), None), ("S2", "A", "MT", t(day + "11:00"), m("30"), None, None, None)],
                                 "slip_id string, account_id string, jurisdiction string, placed_at timestamp, stake decimal(18,2), settled_at timestamp, payout decimal(18,2), voided_at timestamp")
    plays = spark.createDataFrame([("R", "A", "MT", "CASH", m("10"), m("0"), t(day + "13:00"))],
                                  "round_id string, account_id string, jurisdiction string, funding string, stake decimal(18,2), payout decimal(18,2), round_ts timestamp")
    r = recon.daily_reconciliation(recon.daily_flows(pay, bets, plays), markets.market_frame(spark), markets.betting_rate_frame(spark)).first()
    assert (r.cash_ggr, r.open_movement, r.settlement_ggr, r.residual) == (m("20.00"), m("30.00"), m("-10.00"), m("0.00"))


def test_registers_add_up(spark):
    rows = [("ES", d("2026-07-01"), "n1", "SETTLED", m("50"), m("40")), ("ES", d("2026-07-02"), "n1", "SETTLED", m("10"), m("0"))]
    df = spark.createDataFrame(rows, "jurisdiction string, report_date date, national_id string, slip_status string, stake decimal(18,2), payout decimal(18,2)")
    reg = submissions.periodic_register(df)
    got = sorted((r.register_id, r.stake_sum, r.winnings_sum, r.ggr_sum) for r in reg.collect())
    assert got == [("RUD", m("10.00"), m("0.00"), m("10.00")), ("RUD", m("50.00"), m("40.00"), m("10.00")), ("RUT", m("60.00"), m("40.00"), m("20.00"))]
    daily, monthly = reg.filter("register_id = 'RUD'"), reg.filter("register_id = 'RUT'")
    assert submissions.register_completeness(daily, monthly).count() == 0
    assert submissions.register_completeness(daily.filter("stake_sum > 20"), monthly).count() == 1


def test_completeness_accepts_suffixed_files(spark):
    expected = spark.createDataFrame([("FR", "bets", "S1|SETTLED", "S1"), ("FR", "bets", "S2|SETTLED", "S2"), ("FR", "bets", "S3|SETTLED", "S3")],
                                     "jurisdiction string, record_type string, record_key string, record_id string")
    log = spark.createDataFrame([("bets", "S1|SETTLED", "R1"), ("bets", "S2|SETTLED", "R2")], "record_type string, record_key string, receipt_id string")
    paths = spark.createDataFrame([("file:/safe/FR/bets/000001-S1-GAIN.xml",)], "path string")
    got = {r.record_id: r.problem for r in recon.completeness_breaks(expected, log, recon.stored_files(paths)).collect()}
    assert got == {"S2": "FILE_MISSING", "S3": "NOT_SUBMITTED"}


def test_receipts_continue_the_sequence_and_envelopes_hold_their_size(spark):
    keys = spark.createDataFrame([("MT", "bets", f"S{i:06d}") for i in range(25)], "jurisdiction string, record_type string, record_key string")
    stored = spark.createDataFrame([("MT", "bets", 41)], "jurisdiction string, record_type string, last_seq bigint")
    got = delivery.assign_receipts(keys, stored).orderBy("record_key").collect()
    assert got[0].receipt_id == "MT-BETS-000042" and got[0].file_name == "000042-S000000.xml" and got[-1].seq == 66
    rows = keys.withColumn("report_date", F.lit("2026-07-01").cast("date"))
    packed = delivery.envelopes(rows, "record_key", {"MT": 10})
    assert sorted(r["count"] for r in packed.groupBy("batch_id").count().collect()) == [5, 10, 10]


def test_log_append_once_and_replace(spark):
    schema = "record_type string, record_key string, jurisdiction string, receipt_id string, submitted_at timestamp"
    log = spark.createDataFrame([("rud", "K1", "ES", "R1", t("2026-07-01 10:00"))], schema)
    new = spark.createDataFrame([("rud", "K1", "ES", "R2", t("2026-07-02 10:00")), ("rud", "K2", "ES", "R3", t("2026-07-02 10:00"))], schema)
    assert [r.record_key for r in sinks.log_append(log, new.unionByName(new)).collect()] == ["K2"]
    assert {r.record_key: r.receipt_id for r in sinks.log_replace(log, new).collect()} == {"K1": "R2", "K2": "R3"}


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    schema = "slip_id string, payout decimal(18,2), report_date date, version timestamp"
    path = str(tmp_path / "file")
    one = spark.createDataFrame([("S1", m("1"), d("2026-07-01"), t("2026-07-01 10:00")), ("S2", m("2"), d("2026-07-02"), t("2026-07-02 10:00"))], schema)
    sinks.upsert_partitions(spark, one, path, ["slip_id"], ["report_date"], "version")
    untouched = sorted((tmp_path / "file" / "report_date=2026-07-02").glob("*.parquet"))
    two = spark.createDataFrame([("S1", m("9"), d("2026-07-01"), t("2026-07-03 10:00")), ("S3", m("3"), d("2026-07-01"), t("2026-07-03 10:00"))], schema)
    for _ in range(2):
        sinks.upsert_partitions(spark, two, path, ["slip_id"], ["report_date"], "version")
    got = {r.slip_id: r.payout for r in spark.read.parquet(path).collect()}
    assert got == {"S1": m("9.00"), "S2": m("2.00"), "S3": m("3.00")}
    assert sorted((tmp_path / "file" / "report_date=2026-07-02").glob("*.parquet")) == untouched


def test_upsert_moves_a_key_to_another_partition(spark, tmp_path):
    schema = "slip_id string, payout decimal(18,2), report_date date, version timestamp"
    path = str(tmp_path / "file")
    one = spark.createDataFrame([("S1", m("1"), d("2026-07-01"), t("2026-07-01 10:00")), ("S2", m("2"), d("2026-07-01"), t("2026-07-01 10:00")),
                                 ("S3", m("3"), d("2026-07-03"), t("2026-07-03 10:00"))], schema)
    sinks.upsert_partitions(spark, one, path, ["slip_id"], ["report_date"], "version")
    two = spark.createDataFrame([("S1", m("9"), d("2026-07-02"), t("2026-07-04 10:00")), ("S3", m("4"), d("2026-07-02"), t("2026-07-04 10:00"))], schema)
    for _ in range(2):
        sinks.upsert_partitions(spark, two, path, ["slip_id"], ["report_date"], "version")
    got = sorted((r.slip_id, r.payout, str(r.report_date)) for r in spark.read.parquet(path).collect())
    assert got == [("S1", m("9.00"), "2026-07-02"), ("S2", m("2.00"), "2026-07-01"), ("S3", m("4.00"), "2026-07-02")]


def test_upsert_reads_only_partitions_that_may_hold_a_key(spark, tmp_path):
    schema = "slip_id string, payout decimal(18,2), report_date date, version timestamp"
    path = str(tmp_path / "file")
    rows = [(f"S{day}-{i}", m("1"), d(f"2026-07-{day:02d}"), t("2026-07-30 10:00")) for day in range(1, 21) for i in range(5)]
    sinks.upsert_partitions(spark, spark.createDataFrame(rows, schema), path, ["slip_id"], ["report_date"], "version")
    new = spark.createDataFrame([("S3-1", m("2"), d("2026-07-10"), t("2026-07-31 10:00")), ("X1", m("3"), d("2026-07-12"), t("2026-07-31 10:00"))], schema)
    bits = spark.read.schema("word int, mask bigint, report_date date").parquet(sinks.index_path(path))
    found = sinks.may_hold(bits, new, ["slip_id"], ["report_date"]).collect()
    assert [str(r.report_date) for r in found] == ["2026-07-03"]
    table = sinks.only_partitions(spark.read.parquet(path), found, ["report_date"]).select("slip_id")
    assert table.count() == 5
    table.collect()
    leaves = table._jdf.queryExecution().executedPlan().collectLeaves()
    folder = list((tmp_path / "file" / "report_date=2026-07-03").glob("*.parquet"))
    assert leaves.apply(0).metrics().get("numFiles").get().value() == len(folder)
    still = {f: f.stat().st_mtime_ns for day in (1, 2, 4, 20) for f in (tmp_path / "file" / f"report_date=2026-07-{day:02d}").glob("*.parquet")}
    for _ in range(2):
        sinks.upsert_partitions(spark, new, path, ["slip_id"], ["report_date"], "version")
    assert all(f.stat().st_mtime_ns == at for f, at in still.items())
    got = {r.slip_id: str(r.report_date) for r in spark.read.parquet(path).collect()}
    assert len(got) == 101 and got["S3-1"] == "2026-07-10" and got["X1"] == "2026-07-12"
    back = spark.createDataFrame([("S3-1", m("4"), d("2026-07-03"), t("2026-08-01 10:00"))], schema)
    sinks.upsert_partitions(spark, back, path, ["slip_id"], ["report_date"], "version")
    assert {r.slip_id: str(r.report_date) for r in spark.read.parquet(path).collect()}["S3-1"] == "2026-07-03"


def test_table_layout_and_pruned_read(spark, tmp_path):
    from ledgertide.sources import landing
    rows = spark.createDataFrame([("A1", "x", t("2026-07-01 10:00"), m("1")), ("A2", "x", t("2026-07-02 10:00"), m("1"))],
                                 "account_id string, entry_type string, ts timestamp, signed_amount decimal(18,2)")
    sinks.write_table(rows, str(tmp_path / "ledger"), "fct_ledger")
    assert {p.name for p in (tmp_path / "ledger").glob("dt=*")} == {"dt=2026-07-01", "dt=2026-07-02"}
    spark.createDataFrame([("MT", d("2026-07-01"), "S2"), ("MT", d("2026-07-01"), "S1"), ("ES", d("2026-07-02"), "S3")],
                          "jurisdiction string, report_date date, slip_id string").write.partitionBy("jurisdiction", "report_date").parquet(str(tmp_path / "f"))
    df = landing.report_rows(spark, str(tmp_path / "f"), "2026-07-01", "slip_id", "MT")
    assert [r.slip_id for r in df.collect()] == ["S1", "S2"]
    assert "PartitionFilters: [isnotnull" in df._jdf.queryExecution().executedPlan().toString()


def test_wager_gate_reports_the_first_reason(spark):
    from ledgertide.plans import queries
    models = queries.models(spark, "/root/testdata/sf0.001")
    got = queries.PLANS["wager_gate_audit"](models)
    assert {r.reason for r in got.select("reason").distinct().collect()} <= set(protection.WAGER_CHECKS)
    assert got.count() == got.select("wager_id", "ts").distinct().count()
