"""Canonical records: pending rows in the shape the document formats read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .core import zero
from .delivery import balance_before_payment, balance_fields
from .ordered import part_mark

c = F.col


def _person(df: DataFrame, accounts: DataFrame, balances: DataFrame) -> DataFrame:
    """Adds the player's login, birth date and current wallet balance."""
    extra = accounts.select("account_id", "date_of_birth", "opened_at",
                            F.concat(F.lit("user"), F.substring("account_id", 2, 10)).alias("username"))
    drop = [n for n in ("date_of_birth", "opened_at", "username") if n in df.columns]
    return (df.drop(*drop).join(extra, "account_id")
            .join(balances.select("account_id", "balance"), "account_id", "left")
            .withColumn("balance", F.coalesce("balance", zero())))


def _status(include_voided: Column) -> Column:
    return F.when(include_voided, c("status"))


def bets(pending: DataFrame, fixtures: DataFrame, accounts: DataFrame, balances: DataFrame) -> DataFrame:
    names = fixtures.select("fixture_id", "canonical_sport", "competition_name", "home_name", "away_name")
    sport = F.create_map(*[F.lit(x) for x in ("FOOT", "Football", "TENN", "Tennis", "HORS", "Horse Racing",
                                              "BASK", "Basketball")])
    df = _person(pending.join(names, "fixture_id"), accounts, balances)
    credit = F.when(c("status") == "VOIDED", c("stake")).otherwise(c("payout"))
    voided = c("status") == "VOIDED"
    return df.select(
        "jurisdiction", c("slip_id").alias("record_key"), "slip_id", "player_ref", "username", "fixture_id",
        sport[c("canonical_sport")].alias("sport"),
        F.format_string("%s v %s (%s)", "home_name", "away_name", "competition_name").alias("event"),
        F.array(F.struct(c("home_name").alias("name")), F.struct(c("away_name").alias("name"))).alias("participants"),
        "selection", "odds", "stake", "payout", F.lit(None).cast("string").alias("session_id"),
        _status(c("include_voided")).alias("status"), F.when(voided, "voided").alias("void_reason"),
        "placed_at", "terminal_at", F.concat(c("placed_at").cast("string"), F.lit("+00:00")).alias("placed_text"),
        *[col.alias(n) for n, col in balance_fields(c("balance"), c("stake"), credit).items()])


def payments(pending: DataFrame, accounts: DataFrame, balances: DataFrame) -> DataFrame:
    df = _person(pending, accounts, balances)
    return df.select(
        "jurisdiction", c("payment_id").alias("record_key"), "payment_id", "player_ref", "direction", "amount",
        "method", F.lit(None).cast("string").alias("session_id"), c("completed_ts").alias("completed_at"),
        F.coalesce(F.nullif("method", F.lit("")), F.lit("OTHER")).alias("method_or_other"), "balance",
        balance_before_payment(c("balance"), c("direction"), c("amount")).alias("balance_before"))


def players(pending: DataFrame, accounts: DataFrame, balances: DataFrame) -> DataFrame:
    df = _person(pending, accounts, balances)
    return df.select(
        "jurisdiction", c("account_id").alias("record_key"), "player_ref", "kyc_status", "opened_at",
        "date_of_birth", "username", "balance", F.lit(None).cast("string").alias("session_id"),
        F.substring("player_ref", 1, 12).alias("player_short"), F.substring("player_ref", 1, 32).alias("player_half"))


def gaming(pending: DataFrame, accounts: DataFrame, balances: DataFrame) -> DataFrame:
    df = _person(pending, accounts, balances)
    own = F.when(c("funding") == "CASH", c("stake")).otherwise(zero())
    return df.select(
        "jurisdiction", c("round_id").alias("record_key"), "round_id", "player_ref", "username", "game",
        "game_type_code", "stake", "payout", "funding", "session_id", c("round_ts").alias("played_at"),
        F.coalesce("session_id", "round_id").alias("session_or_round"),
        F.date_format("round_ts", "yyyy-MM-dd").alias("played_day"),
        *[col.alias(n) for n, col in balance_fields(c("balance"), own, c("payout")).items()])


def platform_sessions(pending: DataFrame) -> DataFrame:
    def event(ts: str, kind: str) -> Column:
        return F.struct("player_ref", "session_id", c(ts).alias("at"), F.lit(kind).alias("tipo"))
    return pending.select(
        "jurisdiction", c("session_id").alias("record_key"), "session_id", "player_ref", "started_at", "ended_at",
        "end_reason", F.array(event("started_at", "LOGIN"), event("ended_at", "LOGOUT")).alias("events"))


def game_sessions(pending: DataFrame) -> DataFrame:
    """One record per part of a session's round list; ordinary sessions have one.
    Parts differ in key and record id and share the session's id and whole figures."""
    rounds = F.transform("round_ids", lambda r: F.struct(r.alias("round_id"), c("player_ref").alias("player_ref")))
    return pending.select(
        "jurisdiction", F.concat(F.concat_ws("-", "session_id", "game"), part_mark(c("part"))).alias("record_key"),
        "part", "session_id", "game", F.concat("game", part_mark(c("part"))).alias("game_part"), "player_ref",
        "first_played_at", "last_played_at", rounds.alias("rounds"), c("rounds").alias("rounds_played"), "rounds_won")


def register_records(filings: DataFrame) -> DataFrame:
    return filings.withColumns({"period_day": F.date_format("period_start", "yyyyMMdd"),
                                "period_month": F.date_format("period_start", "yyyyMM"),
                                "part_no": c("part") + 1, "part_mark": part_mark(c("part"))})
