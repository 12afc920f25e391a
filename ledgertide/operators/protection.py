"""Player protection: each breach operator returns the rows that break a rule."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import markets
from ..functions.scalars import age_years, local_date, money, period_start
from ..scratch import settled
from .core import active_limits, zero
from .nomenclature import in_force
from .ordered import as_of, lowest_sums, rolling_sums, running_sum

c = F.col
PERIODS = ["DAILY", "WEEKLY", "MONTHLY"]
SPANS = {"DAILY": 1, "WEEKLY": 7, "MONTHLY": 30}


def effective_deposit_limits(compliance: DataFrame, market: DataFrame) -> DataFrame:
    """Account and period with the lower of personal and statutory limit; NULL, no cap."""
    df = compliance.join(market.select("jurisdiction", "default_daily", "default_weekly", "default_monthly"),
                         "jurisdiction")
    rows = F.array(*[F.struct(F.lit(p).alias("period"),
                              c(f"personal_{p.lower()}_limit").alias("personal_limit"),
                              c(f"default_{p.lower()}").alias("default_limit")) for p in PERIODS])
    return (df.select("account_id", "jurisdiction", F.inline(rows))
            .withColumn("effective_limit", F.least("personal_limit", "default_limit")))


def _over_caps(events: DataFrame, caps: DataFrame, market: DataFrame, ts: str, value: Column, out: str, cap: str) -> DataFrame:
    """Totals per account over local days, Monday weeks and months that exceed the account's cap of that period. ``caps`` has
    ``account_id`` and a column per period. A row counts only in the periods its account has a cap for, and the caps
    travel in the key of the totals, so one aggregation on the join's own partitions does all: no task holds days and windows side by side."""
    day = local_date(c(ts), c("timezone"))
    watched = events.select("account_id", "jurisdiction", ts, value.alias("_value")).join(caps, "account_id")
    entries = F.array(*[F.struct(F.lit(p).alias("period"), period_start(c("_local"), p.lower()).alias("window_start"),
                                 c(p).alias(cap)) for p in PERIODS])
    return (watched.join(market.select("jurisdiction", "timezone"), "jurisdiction").withColumn("_local", day)
            .select("account_id", "jurisdiction", "_value", F.inline(entries)).filter(c(cap).isNotNull())
            .groupBy("account_id", "jurisdiction", "period", "window_start", cap).agg(F.sum("_value").alias(out))
            .filter(c(out) > c(cap))
            .select("account_id", "jurisdiction", "period", "window_start", out, cap))


def breach_deposit_limits(payments: DataFrame, limits: DataFrame, market: DataFrame) -> DataFrame:
    """``limits`` has one row per account and period."""
    deposits = payments.filter("direction = 'DEPOSIT' and status = 'COMPLETED'")
    caps = limits.filter("effective_limit is not null").groupBy("account_id").agg(
        *[F.max(F.when(c("period") == p, c("effective_limit"))).alias(p) for p in PERIODS])
    return _over_caps(deposits, caps, market, "completed_ts", c("amount"), "deposited", "effective_limit")


def breach_loss_limits(gambling: DataFrame, limits: DataFrame, market: DataFrame) -> DataFrame:
    # Only players with a limit can breach one: the join drops the others before adding up.
    caps = active_limits(limits, "max", ("LOSS",)).select("account_id", *[c(f"loss_{p.lower()}").alias(p) for p in PERIODS])
    caps = caps.filter(F.coalesce(*PERIODS).isNotNull())
    return _over_caps(gambling, caps, market, "occurred_at", c("stake") - c("payout"), "net_loss", "loss_limit")


def active_at(start: Column, end: Column, t: Column) -> Column:
    return (t >= start) & (end.isNull() | (t < end))


def breach_activity_while_excluded(payments: DataFrame, lifecycle: DataFrame, activity: DataFrame,
                                   exclusions: DataFrame) -> DataFrame:
    def rows(df: DataFrame, kind: str, ref: str, ts: str) -> DataFrame:
        return df.select("account_id", F.lit(kind).alias("activity_type"), c(ref).alias("activity_ref"),
                         c(ts).alias("activity_ts"))
    deposits = payments.filter("direction = 'DEPOSIT' and status = 'COMPLETED'")
    seen = (rows(deposits, "DEPOSIT", "payment_id", "completed_ts")
            .unionByName(rows(lifecycle, "BET_PLACED", "slip_id", "placed_at"))
            .unionByName(rows(activity, "GAMING_ACTIVITY", "activity_id", "occurred_at")))
    x = exclusions.select("account_id", c("source").alias("exclusion_source"), "start_ts", "end_ts")
    return (seen.join(x, "account_id").filter(active_at(c("start_ts"), c("end_ts"), c("activity_ts")))
            .select("account_id", "exclusion_source", "activity_type", "activity_ref", "activity_ts"))


def breach_unverified_withdrawals(payments: DataFrame, verifications: DataFrame, market: DataFrame) -> DataFrame:
    """Withdrawals completed before the first successful identity check. One row
    per account to join, however many checks it has."""
    first = (verifications.filter("check_type = 'IDENTITY' and status = 'VERIFIED'")
             .groupBy("account_id").agg(F.min("event_ts").alias("_verified")))
    needs = market.filter("withdrawal_needs_identity").select("jurisdiction")
    return (payments.filter("direction = 'WITHDRAWAL' and status = 'COMPLETED'")
            .join(needs, "jurisdiction", "left_semi").join(first, "account_id", "left")
            .filter(c("_verified").isNull() | (c("_verified") > c("completed_ts")))
            .select("payment_id", "account_id", "jurisdiction", "amount", "completed_ts"))


def breach_wallet_overspend(ledger: DataFrame) -> DataFrame:
    """Entries that leave the wallet below zero; at one instant credits come first."""
    order = [c("ts"), F.desc("signed_amount"), c("entry_type"), c("ref")]
    run = running_sum(ledger, ["account_id"], order, c("signed_amount"), "running_balance")
    return run.filter("running_balance < 0").select(
        "account_id", "ts", "entry_type", "signed_amount", "running_balance")


def overspent_accounts(ledger: DataFrame) -> DataFrame:
    """The accounts of :func:`breach_wallet_overspend`. As credits come first at one instant, a wallet is below zero at an
    entry only if it is so at the end of some instant: entries are told apart by instant and amount alone, and tasks
    give the lowest balance of an account, not its entries."""
    lowest = lowest_sums(ledger, ["account_id"], [c("ts"), F.desc("signed_amount")], c("signed_amount"), "lowest")
    return lowest.filter("lowest < 0").select("account_id")


def statutory_cap(jurisdiction: Column, age: Column, day: Column,
                  bands: list[tuple] = markets.STAKE_BANDS) -> Column:
    """Lowest cap among the market's bands whose ages and dates cover the stake. The
    few configured bands become one expression: no join, no shuffle, no lambda."""
    date = lambda d: F.lit(d).cast("date")
    caps = [F.when((jurisdiction == market) & (age >= low) & (F.lit(True) if high is None else age <= high)
                   & in_force(day, date(start), date(end)), F.lit(cap).cast("decimal(18,2)"))
            for market, cap, low, high, start, end in bands]
    none = F.lit(None).cast("decimal(18,2)")
    return F.least(none, none, *caps)


def least_statutory_cap(jurisdiction: Column, ts: Column, bands: list[tuple] = markets.STAKE_BANDS) -> Column:
    """What :func:`statutory_cap` is not below at an instant, whatever the age and the zone: the lowest cap of the market's bands whose
    dates, two days wider on either side, hold the instant. Plain comparisons, so it may stand in a filter over all plays."""
    edge = lambda d, wider: F.lit(date.fromisoformat(d) + timedelta(days=wider)).cast("timestamp")
    caps = [F.when((jurisdiction == market) & (ts >= edge(start, -2)) & (F.lit(True) if end is None else ts < edge(end, 2)),
                   F.lit(cap).cast("decimal(18,2)")) for market, cap, _, _, start, end in bands]
    none = F.lit(None).cast("decimal(18,2)")
    return F.least(none, none, *caps)


def personal_stake_caps(limits: DataFrame) -> DataFrame:
    return (limits.filter("limit_type = 'STAKE_CASINO' and revoked_at is null")
            .groupBy("account_id").agg(F.min("amount").alias("_personal")))


def breach_stake_limits(activity: DataFrame, accounts: DataFrame, games: DataFrame, limits: DataFrame,
                        market: DataFrame) -> DataFrame:
    """Stakes above the cap in force at their own instant: the statutory band on
    slots, the personal cap on every game. Only stakes above one that may apply at their instant meet the games; days and
    ages are worked out for them alone, once each: a filter would repeat them for every band it names."""
    people = accounts.select("account_id", "jurisdiction", "date_of_birth").join(
        personal_stake_caps(limits), "account_id", "left")
    day = local_date(c("occurred_at"), c("timezone"))
    cap = statutory_cap(c("jurisdiction"), age_years(c("date_of_birth"), day), day)
    df = (activity.join(people, "account_id")
          .join(market.select("jurisdiction", "timezone"), "jurisdiction")
          .filter(c("stake") > F.least(c("_personal"), least_statutory_cap(c("jurisdiction"), c("occurred_at"))))
          .withColumn("_cap", cap)
          .select("activity_id", "account_id", "jurisdiction", "vertical", "stake", "occurred_at", "game_id", "_personal", "_cap")
          .join(games.select("game_id", "canonical_game_type"), "game_id", "left"))
    on_slots = F.when(c("canonical_game_type") == "SLOT", c("_cap"))
    return (df.withColumn("effective_limit", F.least("_personal", on_slots))
            .filter("stake > effective_limit")
            .select("activity_id", "account_id", "jurisdiction", "vertical", "stake", "effective_limit",
                    "occurred_at"))


def _limit_rows(limits: DataFrame, family: str) -> DataFrame:
    wide = active_limits(limits, "min", (family,))
    return wide.select("account_id", F.inline(F.array(*[
        F.struct(F.lit(p).alias("period"), c(f"{family.lower()}_{p.lower()}").alias("limit_amount"))
        for p in PERIODS]))).filter("limit_amount is not null")


def _rolling_breaches(totals: DataFrame, caps: DataFrame, ref: str, ts: str) -> DataFrame:
    rows = totals.select("account_id", ref, ts, F.inline(F.array(*[
        F.struct(F.lit(p).alias("period"), c(p).alias("window_total")) for p in PERIODS])))
    return (rows.join(caps, ["account_id", "period"]).filter("window_total > limit_amount")
            .select("account_id", ref, ts, "period", "window_total", "limit_amount"))


def rolling_deposit_audit(payments: DataFrame, limits: DataFrame) -> DataFrame:
    """Deposits that took the trailing 1, 7 or 30 days over a limit."""
    caps = _limit_rows(limits, "DEPOSIT")
    deposits = (payments.filter("direction = 'DEPOSIT' and status = 'COMPLETED'")
                .select("account_id", "payment_id", "completed_ts", "amount")
                .join(caps.select("account_id").distinct(), "account_id", "left_semi"))
    totals = rolling_sums(deposits, deposits, "account_id", "completed_ts", "amount", "payment_id", SPANS)
    return _rolling_breaches(totals, caps, "payment_id", "completed_ts")


def loss_events(lifecycle: DataFrame, rounds: DataFrame) -> DataFrame:
    """What counts toward a loss limit: settled bets and cash rounds."""
    net = (c("stake") - c("payout")).alias("net")
    bets = lifecycle.filter("slip_status = 'SETTLED'").select(
        "account_id", c("slip_id").alias("ref"), c("settled_at").alias("ts"), net)
    cash = rounds.filter("funding = 'CASH'").select(
        "account_id", c("round_id").alias("ref"), c("round_ts").alias("ts"), net)
    return bets.unionByName(cash)


def rolling_loss_audit(lifecycle: DataFrame, rounds: DataFrame, limits: DataFrame) -> DataFrame:
    caps = _limit_rows(limits, "LOSS")
    events = loss_events(lifecycle, rounds).join(
        caps.select("account_id").distinct(), "account_id", "left_semi")
    totals = rolling_sums(events, events, "account_id", "ts", "net", "ref", SPANS)
    return _rolling_breaches(totals, caps, "ref", "ts")


def active_exclusions(exclusions: DataFrame, now: Column) -> DataFrame:
    return exclusions.filter(active_at(c("start_ts"), c("end_ts"), now)).select("account_id", "source")


def stake_cap_audit(rounds: DataFrame, accounts: DataFrame, limits: DataFrame) -> DataFrame:
    """Platform rounds over the personal cap, or over the dated slots cap of the
    player's market and age on the day of play (UTC, as the platform judges it)."""
    people = accounts.select("account_id", "jurisdiction", "date_of_birth").join(
        personal_stake_caps(limits), "account_id", "left")
    df = rounds.join(people, "account_id")
    day = F.to_date("round_ts")
    cap = F.when(c("game") == "SLOTS", statutory_cap(c("jurisdiction"), age_years(c("date_of_birth"), day), day))
    over_personal = c("stake") > c("_personal")
    return (df.withColumn("_cap", cap).filter(over_personal | (c("stake") > c("_cap")))
            .select("round_id", "account_id", "jurisdiction", "game", "stake",
                    F.when(over_personal, "PERSONAL").otherwise("STATUTORY").alias("cap_kind"),
                    F.when(over_personal, c("_personal")).otherwise(c("_cap")).alias("cap")))


def caps_in_force(limits: DataFrame) -> DataFrame:
    """``account_id, since, personal_cap``: a row for each instant at which an account's lowest cap may change. An account's
    changes are few (limits a person sets), so each meets the caps of its own account."""
    caps = limits.filter("limit_type = 'STAKE_CASINO'").select("account_id", "amount", "set_at", "revoked_at")
    instants = caps.select("account_id", F.explode(F.array("set_at", "revoked_at")).alias("since")).filter("since is not null").distinct()
    held = F.when(active_at(c("set_at"), c("revoked_at"), c("since")), c("amount"))
    return instants.join(caps, "account_id").groupBy("account_id", "since").agg(F.min(held).alias("personal_cap"))


def stakes_over_cap_then(rounds: DataFrame, limits: DataFrame) -> DataFrame:
    """Rounds over the personal cap in force at their own instant, whatever holds now (``stake_cap_audit`` judges by what is active now)."""
    judged = as_of(rounds.select("round_id", "account_id", "game", "stake", "round_ts"), caps_in_force(limits), ["account_id"],
                   "round_ts", "since", ["personal_cap"])
    return judged.filter("stake > personal_cap")


WAGER_CHECKS = ["NON_POSITIVE", "EXCLUDED", "BONUS_GAME", "INSUFFICIENT_BALANCE", "LOSS_LIMIT", "STAKE_CAP"]


def balances_before(cash_flow: DataFrame) -> DataFrame:
    """``wager_id, _before``: what an account held in front of each wager, written. ``cash_flow``: account_id, ref, ts, amount, is_wager,
    in the order money moved. The scan writes wagers alone, without account and instant."""
    moved = cash_flow.select("account_id", "ref", "ts", "amount", "is_wager")  # the scan sorts whole rows
    run = running_sum(moved, ["account_id"], [c("ts"), F.desc("amount"), c("ref")], c("amount"), "_run", ["ref", "amount", "is_wager"], c("is_wager"))
    return run.select(c("ref").alias("wager_id"), (c("_run") - c("amount")).alias("_before"))


def wager_gate_audit(wagers: DataFrame, balances: DataFrame, exclusions: DataFrame, optins: DataFrame,
                     losses: DataFrame, limits: DataFrame, caps: DataFrame) -> DataFrame:
    """Recorded wagers that the gate should have refused, with the first reason.

    Every check emits only its failing wagers; the lowest-ranked reason per wager
    wins, so the final shuffle carries failures, not wagers. Checks that move wagers are written one after the other, and the
    shuffles of one are gone before the next begins.
    ``wagers``: wager_id, account_id, ts, stake, net, casino, game, funding.
    ``balances``: :func:`balances_before`.
    """
    def fail(df: DataFrame, reason: str) -> DataFrame:
        return df.select("wager_id", "account_id", "ts", "stake",
                         F.lit(WAGER_CHECKS.index(reason)).alias("_rank"))
    cash = wagers.filter("funding = 'CASH'")
    positive = fail(wagers.filter("stake <= 0"), "NON_POSITIVE")
    bonus = fail(wagers.filter((c("funding") != "CASH") & ~c("game").isin(markets.BONUS_GAMES)), "BONUS_GAME")
    plain = settled(lambda: positive.unionByName(bonus), "failed-plain")

    # What a pool takes besides the stake matters to the few wagers that the balance covers with it or without it alone. A balance
    # that covers the highest stake of all doesn't meet its wager.
    pool = F.when(c("casino"), money(c("stake") * F.lit(markets.POOL_RATE))).otherwise(zero())
    most = F.broadcast(cash.agg(F.max(F.greatest("stake", c("stake") + pool)).alias("_most")))
    low = balances.join(most, c("_before") < c("_most")).drop("_most")
    close = settled(lambda: cash.select("wager_id", "account_id", "ts", "stake", "casino").join(low, "wager_id").withColumn("_pooled", c("stake") + pool)
                    .filter(F.greatest("stake", "_pooled") > c("_before"))
                    .select("wager_id", "account_id", "ts", "stake", (F.least("stake", "_pooled") > c("_before")).alias("_either"),
                            (c("_pooled") > c("stake")).alias("_opted")), "failed-balance")
    o = optins.select(c("account_id").alias("_player"), "opted_in_at", "opted_out_at")
    joined = (c("account_id") == c("_player")) & active_at(c("opted_in_at"), c("opted_out_at"), c("ts"))
    with_pool = close.filter("NOT _either AND _opted").join(o, joined, "left_semi")
    without = close.filter("NOT _either AND NOT _opted").join(o, joined, "left_anti")  # a stake below zero
    short = fail(close.filter("_either").unionByName(with_pool).unionByName(without), "INSUFFICIENT_BALANCE")

    x = exclusions.select("account_id", "start_ts", "end_ts")
    excluded = settled(lambda: fail(wagers.select("wager_id", "account_id", "ts", "stake").join(x, "account_id")
                                    .filter(active_at(c("start_ts"), c("end_ts"), c("ts"))), "EXCLUDED"), "failed-excluded")
    capped = settled(lambda: fail(wagers.select("wager_id", "account_id", "ts", "stake").join(
        settled(lambda: caps.select(c("round_id").alias("wager_id")).distinct(), "capped"), "wager_id", "left_semi"), "STAKE_CAP"), "failed-capped")

    def over_limit() -> DataFrame:
        loss_caps = _limit_rows(limits, "LOSS")
        watched = loss_caps.groupBy("account_id").agg(F.collect_set("period").alias("_asked"))
        points = settled(lambda: cash.select("wager_id", "account_id", "ts", "stake", "net", "casino").join(watched, "account_id"), "watched")
        totals = rolling_sums(losses.join(watched.select("account_id"), "account_id", "left_semi"), points, "account_id", "ts",
                              "net", "wager_id", SPANS, "_asked")
        rows = totals.select("account_id", "wager_id", F.inline(F.array(*[
            F.struct(F.lit(p).alias("period"), c(p).alias("_total")) for p in PERIODS])))
        # A round's own result falls on its own instant: take it out again.
        own = F.when(c("casino"), c("net")).otherwise(zero())
        return fail(points.join(rows, ["account_id", "wager_id"]).join(loss_caps, ["account_id", "period"])
                    .filter(c("_total") - own + c("stake") > c("limit_amount")), "LOSS_LIMIT")
    over = settled(over_limit, "failed-loss")

    failures = plain.unionByName(excluded).unionByName(short).unionByName(over).unionByName(capped)
    names = F.array(*[F.lit(n) for n in WAGER_CHECKS])
    return (failures.groupBy("wager_id", "account_id", "ts", "stake").agg(F.min("_rank").alias("_first"))
            .select("wager_id", "account_id", "ts", "stake",
                    F.element_at(names, c("_first") + 1).alias("reason")))
