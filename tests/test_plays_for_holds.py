"""What the holds read of plays: one move for each, and caps worked out for the few stakes that may be above one."""

import random
from datetime import timedelta

from pyspark.sql import functions as F

from ledgertide.functions.scalars import age_years, local_date
from ledgertide.operators import core, protection
from ledgertide.plans import derive, pipeline

from .helpers import d, m, t

PLAYS = "activity_id string, account_id string, vertical string, stake decimal(18,2), payout decimal(18,2), occurred_at timestamp"


def plays(seed: int) -> list[tuple]:
    """Stakes, payouts, instants and accounts may be missing; several plays fall on one instant."""
    rnd, start = random.Random(seed), t("2026-07-01 10:00")
    money = lambda: rnd.choice([None, m("0.00"), m("3.50"), m("7.00"), m("11.25")])
    return [(f"P{i:03d}", rnd.choice([None, *"ABCDEFGHIJKLMNOP"]), rnd.choice(["CASINO_ROUND", "OPERATOR_JACKPOT"]), money(), money(),
             rnd.choice([None, *[start + timedelta(minutes=n) for n in range(9)]])) for i in range(120)]


def feeds(spark, seed: int):
    payments = spark.createDataFrame([(f"D{a}", a, "DEPOSIT", "COMPLETED", m("9.00"), t("2026-07-01 10:03")) for a in "ACEGIKMO"],
                                     "payment_id string, account_id string, direction string, status string, amount decimal(18,2), completed_ts timestamp")
    slips = spark.createDataFrame([("S1", "A", "SETTLED", t("2026-07-01 09:00"), t("2026-07-01 10:05"), m("2"), m("6"))],
                                  "slip_id string, account_id string, slip_status string, placed_at timestamp, settled_at timestamp, stake decimal(18,2), payout decimal(18,2)")
    wins = spark.createDataFrame([("W1", "B", t("2026-07-01 09:30"), m("50"))], "win_id string, account_id string, win_ts timestamp, amount decimal(18,2)")
    return payments, slips, spark.createDataFrame(plays(seed), PLAYS), wins


def test_moves_overspend_as_the_ledger_does(spark):
    for seed in range(3):
        given = feeds(spark, seed)
        moves = core.wallet_moves(*given)
        assert moves.count() < core.wallet_ledger(*given).count()
        want = {r.account_id for r in protection.breach_wallet_overspend(core.wallet_ledger(*given)).select("account_id").distinct().collect()}
        got = {r.account_id for r in protection.overspent_accounts(moves).collect()}
        assert got == want and 0 < len(want) < 17


def test_no_cap_is_below_the_least(spark):
    """Around every edge of a band, in the zones farthest east and west."""
    instants = [t(f"{day} {hour:02d}:30") + timedelta(days=n) for day in ("2021-07-01", "2026-07-01", "2026-08-01", "2026-09-15")
                for n in (-2, -1, 0, 1, 2) for hour in (0, 9, 14, 23)]
    rows = [(k, zone, born, at) for k in ("MT", "ES", "DE", "FR", None) for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago", "Europe/Berlin")
            for born in (d("2004-07-02"), d("1980-01-01"), None) for at in instants]
    df = spark.createDataFrame(rows, "jurisdiction string, timezone string, born date, at timestamp")
    day = local_date(F.col("at"), F.col("timezone"))
    found = df.select(protection.statutory_cap(F.col("jurisdiction"), age_years(F.col("born"), day), day).alias("cap"),
                      protection.least_statutory_cap(F.col("jurisdiction"), F.col("at")).alias("least")).where("cap IS NOT NULL")
    assert found.count() > 100
    assert not found.where("least IS NULL OR least > cap").count()


def test_no_filter_works_out_a_day_for_every_band(spark):
    models = pipeline.build(spark, derive.sources(spark, "/root/testdata/sf0.001"), derive.RUN_TS)
    plan = models["breach_stake_limits"]._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "from_utc_timestamp" in line]
    assert sum(line.count("from_utc_timestamp") > 0 for line in plan.splitlines()) == 1


def test_holds_read_plays_without_names(spark):
    assert "plays" in pipeline.FACTS and "fct_activity" not in pipeline.FACTS
    models = pipeline.build(spark, derive.sources(spark, "/root/testdata/sf0.001"), derive.RUN_TS)
    assert {"activity_id", "session_id", "jackpot_id"}.isdisjoint(models["plays"].columns)
    held = [models[n].select("account_id").distinct() for n in ("breach_activity_while_excluded", "breach_stake_limits")]
    kinds = ["activity_while_excluded", "stake_limit"]
    for df, kind in zip(held, kinds):
        assert {r[0] for r in df.collect()} == {r[0] for r in models["holds"].where(F.col("breach") == kind).select("account_id").collect()}
