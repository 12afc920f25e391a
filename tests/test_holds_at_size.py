"""What the holds keep in one task: lowest balances, capped periods, stakes above a cap."""

import random
from datetime import timedelta

from pyspark.sql import functions as F

from ledgertide import markets, session
from ledgertide.operators import ordered, protection
from ledgertide.plans import derive, pipeline

from .helpers import m, t

LEDGER = "account_id string, ts timestamp, entry_type string, signed_amount decimal(18,2), ref string"


def moves(seed: int) -> list[tuple]:
    """One account has a third of all entries; instants, accounts and amounts may be missing."""
    rnd, start = random.Random(seed), t("2026-07-01 10:00")
    rows = []
    for i in range(600):
        account = "HOT" if rnd.random() < 0.33 else rnd.choice([None, *[f"A{n}" for n in range(60)]])
        at = None if rnd.random() < 0.05 else start + timedelta(minutes=rnd.randrange(40))
        amount = None if rnd.random() < 0.05 else m(f"{rnd.choice([-7, -3, 2, 4, 9, 30])}.50")
        rows.append((account, at, "X", amount, f"R{i:04d}"))
    return rows


def test_overspent_accounts_are_those_of_the_overspent_entries(spark):
    for seed in range(3):
        ledger = spark.createDataFrame(moves(seed), LEDGER)
        want = {r.account_id for r in protection.breach_wallet_overspend(ledger).select("account_id").distinct().collect()}
        got = [r.account_id for r in protection.overspent_accounts(ledger).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want


def test_lowest_sums_equal_a_plain_window(spark):
    rows = moves(7)
    ledger = spark.createDataFrame(rows, LEDGER)
    got = {r.account_id: r.low for r in ordered.lowest_sums(ledger, ["account_id"], [F.col("ts"), F.col("ref")], F.col("signed_amount"), "low").collect()}
    want, sums = {}, {}
    for account, _, _, amount, _ in sorted((r for r in rows if r[3] is not None), key=lambda r: (r[1] is not None, r[1], r[4])):
        sums[account] = sums.get(account, 0) + amount
        want[account] = min(want.get(account, sums[account]), sums[account])
    assert got == want


def test_loss_limits_add_up_capped_periods_alone(spark):
    at = t("2026-07-01 10:00")
    plays = spark.createDataFrame([("A1", "ES", at, m("9"), m("0")), ("A1", "ES", at + timedelta(days=1), m("2"), m("0")), ("A2", "ES", at, m("99"), m("0"))],
                                  "account_id string, jurisdiction string, occurred_at timestamp, stake decimal(18,2), payout decimal(18,2)")
    limits = spark.createDataFrame([("A1", "LOSS_DAILY", m("10")), ("A1", "LOSS_WEEKLY", m("10"))], "account_id string, limit_type string, amount decimal(18,2)")
    limits = limits.withColumn("revoked_at", F.lit(None).cast("timestamp"))
    found = protection.breach_loss_limits(plays, limits, markets.market_frame(spark))
    assert [(r.account_id, r.period, str(r.window_start), r.net_loss) for r in found.collect()] == [("A1", "WEEKLY", "2026-06-29", m("11.00"))]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2  # the caps and the totals: no days and no accounts beside them


def test_holds_read_neither_references_nor_all_games(spark, tmp_path):
    models = pipeline.build(spark, derive.sources(spark, "/root/testdata/sf0.001"), derive.RUN_TS)
    assert set(models["wallet_moves"].columns) == {"account_id", "ts", "signed_amount"}
    plan = models["breach_stake_limits"]._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 1)
    assert "stake#" in above and "least(_personal" in below.replace("coalesce", "")


def test_a_task_reads_little_and_a_cluster_may_ask_for_less(spark):
    asked = spark.conf.get(session.ADVISORY)
    try:
        for given, kept in (("64m", "16m"), ("1g", "16m"), ("67108864b", "16m"), ("8m", "8m"), ("262144", "262144")):
            spark.conf.set(session.ADVISORY, given)
            assert session.configure(spark).conf.get(session.ADVISORY) == kept
    finally:
        spark.conf.set(session.ADVISORY, asked)
