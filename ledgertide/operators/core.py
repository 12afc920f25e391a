"""Facts shared by every market: slips, payments, activity, ledger, compliance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import MONEY, money


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def account_dimension(accounts: DataFrame) -> DataFrame:
    return accounts.select("account_id", "jurisdiction", "national_id", "date_of_birth",
                           "kyc_status", "opened_at")


def _when_event(kind: str, value: Column) -> Column:
    return F.when(F.col("event_type") == kind, value)


def slip_status(voided: Column, settled: Column) -> Column:
    return F.when(voided, "VOIDED").when(settled, "SETTLED").otherwise("OPEN")


def slip_lifecycle(events: DataFrame, slips: DataFrame) -> DataFrame:
    """One row per slip. A void wins over a settlement and takes the payout back.
    ``slips`` is the staged header: a replayed raw header would double slips."""
    ts = F.col("event_ts")
    pivot = events.groupBy("slip_id").agg(
        F.min(_when_event("PLACED", ts)).alias("placed_at"),
        F.min(_when_event("SETTLED", ts)).alias("settled_at"),
        F.min(_when_event("VOIDED", ts)).alias("voided_at"),
        F.max(F.coalesce(_when_event("PLACED", F.col("stake")), zero())).alias("stake"),
        F.max(F.coalesce(_when_event("SETTLED", F.col("payout")), zero())).alias("_payout"))
    return _with_header(pivot, slips)


def slip_images(feed: DataFrame) -> DataFrame:
    """One row per slip straight from the event feed: the newest image of each kind of
    event, taken as a maximum. One shuffle on the slip, combined map-side first, where
    staging and pivoting one after the other would shuffle every event twice."""
    image = F.struct("_commit_ts", "event_ts", "stake", "payout")
    newest = feed.groupBy("slip_id").agg(*[
        F.max(_when_event(kind, image)).alias(kind) for kind in ("PLACED", "SETTLED", "VOIDED")])
    known = F.coalesce("PLACED", "SETTLED", "VOIDED").isNotNull()
    return newest.filter(known).select(
        "slip_id", F.col("PLACED.event_ts").alias("placed_at"), F.col("PLACED.stake").alias("stake"),
        F.col("SETTLED.event_ts").alias("settled_at"), F.col("SETTLED.payout").alias("payout"),
        F.col("VOIDED.event_ts").alias("voided_at"))


def lifecycle_from_feed(feed: DataFrame, slips: DataFrame) -> DataFrame:
    """:func:`slip_lifecycle` of the staged events, computed from the feed."""
    wide = slip_images(feed)
    return _with_header(wide.withColumns({"stake": F.coalesce("stake", zero()),
                                          "_payout": F.coalesce("payout", zero())}).drop("payout"), slips)


def _with_header(pivot: DataFrame, slips: DataFrame) -> DataFrame:
    voided = F.col("voided_at").isNotNull()
    return (pivot.join(slips.select("slip_id", "account_id", "fixture_id"), "slip_id")
            .select("slip_id", "account_id", "fixture_id", "placed_at", "settled_at", "voided_at",
                    slip_status(voided, F.col("settled_at").isNotNull()).alias("slip_status"), "stake",
                    F.when(voided, zero()).otherwise(F.col("_payout")).alias("payout")))


def slip_status_by_rank(events: DataFrame) -> DataFrame:
    """The same status from the highest event seen."""
    rank = (F.when(F.col("event_type") == "VOIDED", 3).when(F.col("event_type") == "SETTLED", 2)
            .otherwise(1))
    top = events.groupBy("slip_id").agg(F.max(rank).alias("_top"))
    return top.select("slip_id", slip_status(F.col("_top") == 3, F.col("_top") == 2).alias("slip_status"))


def payments_fact(payments: DataFrame, accounts: DataFrame) -> DataFrame:
    return (payments.join(accounts.select("account_id", "jurisdiction"), "account_id")
            .select("payment_id", "account_id", "jurisdiction", "direction", "amount", "method",
                    "status", "requested_ts", "completed_ts"))


def gambling_activity(lifecycle: DataFrame, activity: DataFrame, accounts: DataFrame) -> DataFrame:
    """Settled bets and gaming plays on one grain; the account side joins once."""
    bets = lifecycle.filter("slip_status = 'SETTLED'").select(
        "account_id", F.col("settled_at").alias("occurred_at"), "stake", "payout",
        F.lit("BET").alias("source"))
    plays = activity.select("account_id", "occurred_at", "stake", "payout", F.col("vertical").alias("source"))
    return (bets.unionByName(plays).join(accounts.select("account_id", "jurisdiction"), "account_id")
            .select("account_id", "jurisdiction", "occurred_at", "stake", "payout", "source"))


def _entries(df: DataFrame, ref: str, *entries: tuple[Column, Column, Column, Column]) -> DataFrame:
    """Each source row to its ledger entries in one scan: (kept when, ts, type, amount)."""
    built = F.array(*[
        F.when(when, F.struct(ts.alias("ts"), kind.alias("entry_type"),
                              amount.cast(MONEY).alias("signed_amount")))
        for when, ts, kind, amount in entries])
    return (df.select("account_id", F.col(ref).alias("ref"), F.explode(built).alias("e"))
            .filter(F.col("e").isNotNull()).select("account_id", "ref", "e.*"))


def _ledger_beside_plays(payments: DataFrame, lifecycle: DataFrame, provider_wins: DataFrame) -> DataFrame:
    c = F.col
    paid = _entries(
        payments.filter("status = 'COMPLETED'"), "payment_id",
        (c("direction") == "DEPOSIT", c("completed_ts"), F.lit("DEPOSIT"), c("amount")),
        (c("direction") == "WITHDRAWAL", c("completed_ts"), F.lit("WITHDRAWAL"), -c("amount")))
    bets = _entries(
        lifecycle.filter("slip_status <> 'VOIDED'"), "slip_id",
        (F.lit(True), c("placed_at"), F.lit("BET_STAKE"), -c("stake")),
        ((c("slip_status") == "SETTLED") & (c("payout") > 0), c("settled_at"), F.lit("BET_PAYOUT"),
         c("payout")))
    wins = _entries(provider_wins, "win_id",
                    (F.lit(True), c("win_ts"), F.lit("PROVIDER_JACKPOT_WIN"), c("amount")))
    return paid.unionByName(bets).unionByName(wins)


def wallet_ledger(payments: DataFrame, lifecycle: DataFrame, activity: DataFrame,
                  provider_wins: DataFrame) -> DataFrame:
    """Every money movement of a player as one signed amount, with the source
    key kept as ``ref`` so that the order of the ledger is total."""
    c = F.col
    pool = c("vertical") == "OPERATOR_JACKPOT"
    plays = _entries(
        activity, "activity_id",
        (c("stake") > 0, c("occurred_at"),
         F.when(pool, "JACKPOT_CONTRIBUTION").otherwise("GAMING_STAKE"), -c("stake")),
        (c("payout") > 0, c("occurred_at"),
         F.when(pool, "JACKPOT_WIN").otherwise("GAMING_PAYOUT"), c("payout")))
    return _ledger_beside_plays(payments, lifecycle, provider_wins).unionByName(plays)


def wallet_moves(payments: DataFrame, lifecycle: DataFrame, activity: DataFrame, provider_wins: DataFrame) -> DataFrame:
    """The amounts of :func:`wallet_ledger` without references, for what reads balances at the end of an instant: a play's stake
    and payout fall on one instant and are one move; a move of nothing is left out."""
    c = F.col
    net = (F.coalesce(F.when(c("payout") > 0, c("payout")), zero()) - F.coalesce(F.when(c("stake") > 0, c("stake")), zero())).cast(MONEY)
    plays = activity.select("account_id", c("occurred_at").alias("ts"), net.alias("signed_amount")).filter("signed_amount <> 0")
    return _ledger_beside_plays(payments, lifecycle, provider_wins).select(*plays.columns).unionByName(plays)


def wallet_balance(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    total = ledger.groupBy("account_id").agg(F.sum("signed_amount").alias("_sum"))
    return (total.join(accounts.select("account_id", "jurisdiction"), "account_id")
            .select("account_id", "jurisdiction", money(F.col("_sum")).alias("balance")))


def platform_balance(payments: DataFrame, lifecycle: DataFrame, rounds: DataFrame) -> DataFrame:
    """Balance per account as the platform keeps it: a bonus-funded round takes
    no stake from the wallet and credits its payout."""
    c = F.col
    paid = payments.filter("status = 'COMPLETED'").select(
        "account_id", F.when(c("direction") == "DEPOSIT", c("amount")).otherwise(-c("amount")).alias("amt"))
    bets = lifecycle.filter("slip_status <> 'VOIDED'").select(
        "account_id", (c("payout") - c("stake")).alias("amt"))
    plays = rounds.select("account_id", F.when(c("funding") == "GOLDEN_CHIP", c("payout"))
                          .otherwise(c("payout") - c("stake")).alias("amt"))
    return (paid.unionByName(bets).unionByName(plays).groupBy("account_id")
            .agg(money(F.sum("amt")).alias("balance")))


def active_limits(limits: DataFrame, pick: str = "max", families: tuple[str, ...] = ("DEPOSIT",)) -> DataFrame:
    """Unrevoked limits per account as columns. Two limits of one type leave the
    higher (``max``, the reporting rule) or the lower (``min``, the front-door rule)."""
    best = {"max": F.max, "min": F.min}[pick]
    kinds = [f"{f}_{p}" for f in families for p in ("DAILY", "WEEKLY", "MONTHLY")]
    return (limits.filter("revoked_at is null").groupBy("account_id")
            .agg(*[best(F.when(F.col("limit_type") == k, F.col("amount"))).alias(k.lower()) for k in kinds]))


def player_compliance(accounts: DataFrame, verifications: DataFrame, exclusions: DataFrame,
                      limits: DataFrame) -> DataFrame:
    latest = (verifications.filter("check_type = 'IDENTITY'").groupBy("account_id")
              .agg(F.max(F.struct("event_ts", "verification_id", "status")).alias("_v")))
    open_exclusions = (exclusions.filter("end_ts is null").groupBy("account_id")
                       .agg(F.min("source").alias("open_exclusion_source")))
    return (accounts.select("account_id", "jurisdiction")
            .join(latest, "account_id", "left").join(open_exclusions, "account_id", "left")
            .join(active_limits(limits), "account_id", "left")
            .select("account_id", "jurisdiction",
                    F.coalesce("_v.status", F.lit("UNVERIFIED")).alias("verification_status"),
                    F.col("_v.event_ts").alias("verification_ts"), "open_exclusion_source",
                    F.col("deposit_daily").alias("personal_daily_limit"),
                    F.col("deposit_weekly").alias("personal_weekly_limit"),
                    F.col("deposit_monthly").alias("personal_monthly_limit")))
