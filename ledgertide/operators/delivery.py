"""What is pending for the regulators, how it is routed, numbered and counted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import markets
from ..functions.scalars import money
from .core import zero
from .ordered import part_mark, row_numbers, running_sum
from .submissions import player_reference

c = F.col
PLACEHOLDERS = ["SUPPRESSED-VOID", "SUPPRESSED-UNLICENSED", "VIA-SESSION"]


def not_logged(df: DataFrame, log: DataFrame, record_type: str, key: Column) -> DataFrame:
    """Rows whose log key is not in the delivery log yet."""
    done = log.filter(c("record_type") == record_type).select(c("record_key").alias("_key"))
    return df.withColumn("_key", key).join(done, "_key", "left_anti").withColumnRenamed("_key", "log_key")


def _person(market: DataFrame, accounts: DataFrame) -> DataFrame:
    ref = player_reference(c("hashed_ref"), c("national_id"), c("account_id"))
    return accounts.join(market.select("jurisdiction", "hashed_ref", "include_voided", "gaming_via_sessions",
                                       "session_grain", "timeout_minutes"), "jurisdiction").withColumn("player_ref", ref)


def pending_bets(slips: DataFrame, accounts: DataFrame, market: DataFrame, log: DataFrame) -> DataFrame:
    """Terminal slips not delivered in their present status; a void wins.
    ``slips`` has per-slip amounts with fixture, selection and odds."""
    voided = c("voided_at").isNotNull()
    df = (slips.filter(voided | c("settled_at").isNotNull()).drop("jurisdiction")
          .withColumn("status", F.when(voided, "VOIDED").otherwise("SETTLED"))
          .withColumn("payout", F.when(voided, zero()).otherwise(F.coalesce("payout", zero())))
          .withColumn("terminal_at", F.coalesce("voided_at", "settled_at")))
    df = not_logged(df, log, "bets", F.concat_ws("|", "slip_id", "status"))
    people = _person(market, accounts.select("account_id", "jurisdiction", "national_id"))
    route = F.when((c("status") == "VOIDED") & ~c("include_voided"), "SUPPRESSED-VOID").otherwise("DELIVER")
    return df.join(people, "account_id").withColumn("route", route)


def pending_payments(payments: DataFrame, accounts: DataFrame, market: DataFrame, log: DataFrame) -> DataFrame:
    done = not_logged(payments.filter("status = 'COMPLETED'"), log, "payments", c("payment_id"))
    people = _person(market, accounts.select("account_id", "jurisdiction", "national_id"))
    return done.drop("jurisdiction").join(people, "account_id").withColumn("route", F.lit("DELIVER"))


def pending_players(accounts: DataFrame, market: DataFrame, log: DataFrame) -> DataFrame:
    """Players not reported with their present identity status."""
    df = not_logged(accounts, log, "players", F.concat_ws("|", "account_id", "kyc_status"))
    return _person(market, df).withColumn("route", F.lit("DELIVER"))


def gaming_route(licensed: DataFrame, df: DataFrame) -> DataFrame:
    """Adds ``route``: unlicensed games and games filed inside sessions are logged, not sent."""
    listed = licensed.select("jurisdiction").distinct().withColumn("_listed", F.lit(True))
    ok = licensed.select("jurisdiction", "game").withColumn("_ok", F.lit(True))
    df = (df.join(F.broadcast(listed), "jurisdiction", "left")
          .join(F.broadcast(ok), ["jurisdiction", "game"], "left"))
    route = (F.when(c("_listed").isNotNull() & c("_ok").isNull(), "SUPPRESSED-UNLICENSED")
             .when(c("gaming_via_sessions"), "VIA-SESSION").otherwise("DELIVER"))
    return df.withColumn("route", route).drop("_listed", "_ok")


def pending_gaming(rounds: DataFrame, accounts: DataFrame, market: DataFrame, licensed: DataFrame,
                   log: DataFrame) -> DataFrame:
    df = not_logged(rounds, log, "gaming", c("round_id"))
    people = _person(market, accounts.select("account_id", "jurisdiction", "national_id"))
    codes = F.create_map(*[F.lit(x) for kv in markets.GAME_TYPE_CODES.items() for x in kv])
    df = df.join(people, "account_id").withColumn("game_type_code", codes[c("game")])
    return gaming_route(licensed, df)


def pending_platform_sessions(sessions: DataFrame, accounts: DataFrame, market: DataFrame,
                              log: DataFrame) -> DataFrame:
    df = not_logged(sessions.filter("ended_at is not null"), log, "sessions", c("session_id"))
    people = _person(market, accounts.select("account_id", "jurisdiction", "national_id"))
    return df.drop("jurisdiction").join(people.filter("session_grain = 'platform'"), "account_id")


def pending_game_sessions(lists: DataFrame, accounts: DataFrame, market: DataFrame, log: DataFrame) -> DataFrame:
    """``lists`` is the ordered round list per session and game; each part is logged under a key of its own."""
    key = F.concat(F.concat_ws("-", "session_id", "game"), part_mark(c("part")))
    df = not_logged(lists, log, "sessions", key)
    people = _person(market, accounts.select("account_id", "jurisdiction", "national_id"))
    return df.join(people.filter("session_grain = 'per_game'"), "account_id")


def balance_fields(balance: Column, stake: Column, credit: Column) -> dict[str, Column]:
    """Wallet before and after the stake and the credit, from the balance after both."""
    before = balance + stake - credit
    return {"balance_before_stake": money(before), "balance_after_stake": money(before - stake),
            "balance_before_credit": money(before - stake), "balance_after_credit": money(balance),
            "balance_net": money(credit - stake)}


def balance_before_payment(balance: Column, direction: Column, amount: Column) -> Column:
    return money(F.when(direction == "DEPOSIT", balance - amount).otherwise(balance + amount))


def as_of_balances(flows: DataFrame) -> DataFrame:
    """Balance of the wallet right after each movement."""
    order = [c("ts"), F.desc("amount"), c("kind"), c("ref")]
    return running_sum(flows, ["account_id"], order, c("amount"), "balance")


def routed_log(pending: DataFrame, record_type: str, at: Column) -> DataFrame:
    """Log rows of records that are not delivered, so that no pass looks at them again."""
    return pending.filter("route <> 'DELIVER'").select(
        F.lit(record_type).alias("record_type"), c("log_key").alias("record_key"), "jurisdiction",
        c("route").alias("receipt_id"), at.alias("submitted_at"))


def assign_receipts(deposits: DataFrame, stored: DataFrame) -> DataFrame:
    """Next receipt numbers per market and record type, in key order, after the
    highest number stored. ``stored`` has one row per market and record type, so it is broadcast:
    a join by market and type would put all rows of one file in one task."""
    key = ["jurisdiction", "record_type"]
    last = F.broadcast(stored.select(*key, c("last_seq")))
    df = row_numbers(deposits, key, [c("record_key")], "_n")
    df = df.join(last, key, "left").withColumn("seq", F.coalesce("last_seq", F.lit(0)) + c("_n"))
    return (df.withColumn("receipt_id", F.format_string("%s-%s-%06d", "jurisdiction", F.upper("record_type"), "seq"))
            .withColumn("file_name", F.format_string("%06d-%s.xml", "seq", "record_key"))
            .drop("last_seq", "_n"))


def stored_sequences(log: DataFrame) -> DataFrame:
    """Highest receipt number per market and type in the log; placeholders have none."""
    seq = F.regexp_extract("receipt_id", "-([0-9]+)$", 1)
    return (log.filter(c("jurisdiction").isNotNull() & (seq != ""))
            .groupBy("jurisdiction", "record_type").agg(F.max(seq.cast("bigint")).alias("last_seq")))


def receipt_totals(filed: DataFrame, receipt: str = "receipt_id") -> DataFrame:
    return filed.groupBy("jurisdiction", "report_date", receipt).agg(
        F.count("*").alias("row_count"), money(F.sum("stake")).alias("total_stake"))


def envelopes(rows: DataFrame, key: str, sizes: dict[str, int] | None = None,
              default: int = markets.DEFAULT_ENVELOPE_ROWS) -> DataFrame:
    """Adds ``batch_id``: rows of one market and date in key order, at most the
    market's envelope size each."""
    sizes = markets.ENVELOPE_ROWS if sizes is None else sizes
    size = F.lit(default)
    for market, n in sizes.items():
        size = F.when(c("jurisdiction") == market, n).otherwise(size)
    numbered = row_numbers(rows, ["jurisdiction", "report_date"], [c(key)], "_n")
    return numbered.withColumn("batch_id", F.floor((c("_n") - 1) / size).cast("bigint")).drop("_n")


def filed_per_market(log: DataFrame) -> DataFrame:
    """Documents filed per market and UTC day; a run is complete when none is missing."""
    return (log.filter(~c("receipt_id").isin(PLACEHOLDERS) & c("jurisdiction").isNotNull())
            .groupBy("jurisdiction", F.to_date("submitted_at").alias("filed_on"))
            .agg(F.count("*").alias("documents")))


def delivery_counts(log: DataFrame) -> DataFrame:
    """Deliveries per market and type; routing placeholders are shown apart."""
    routed = c("receipt_id").like("SUPPRESSED-%") | (c("receipt_id") == "VIA-SESSION")
    label = F.when(routed, c("receipt_id")).otherwise("DELIVERED")
    return log.groupBy("jurisdiction", "record_type", label.alias("outcome")).agg(F.count("*").alias("records"))


def in_flight(slips: DataFrame, events: DataFrame) -> DataFrame:
    """Slips placed and not ended, oldest first."""
    ended = events.filter("event_type in ('SETTLED', 'VOIDED')").select("slip_id")
    placed = events.filter("event_type = 'PLACED'").select("slip_id", c("event_ts").alias("placed_at"), "stake")
    return (slips.select("slip_id", "account_id", "fixture_id").join(placed, "slip_id")
            .join(ended, "slip_id", "left_anti").orderBy("placed_at", "slip_id"))


def operations_kpis(accounts: DataFrame, lifecycle: DataFrame, payments: DataFrame, seen: DataFrame,
                    now: Column) -> DataFrame:
    """Players, open bets, deposits of the last day, players seen in five minutes."""
    day, recent = now - F.make_dt_interval(F.lit(1)), now - F.make_interval(mins=F.lit(5))
    parts = [
        accounts.agg(F.count("*").cast("decimal(24,2)").alias("value")).withColumn("kpi", F.lit("players")),
        lifecycle.filter("slip_status = 'OPEN'").agg(F.count("*").cast("decimal(24,2)").alias("value"))
        .withColumn("kpi", F.lit("open_bets")),
        payments.filter((c("direction") == "DEPOSIT") & (c("status") == "COMPLETED") & (c("completed_ts") >= day))
        .agg(F.coalesce(F.sum("amount"), zero()).cast("decimal(24,2)").alias("value"))
        .withColumn("kpi", F.lit("deposits_last_day")),
        seen.filter(c("seen_at") >= recent).agg(F.countDistinct("account_id").cast("decimal(24,2)").alias("value"))
        .withColumn("kpi", F.lit("seen_recently"))]
    return reduce(DataFrame.unionByName, parts).select("kpi", "value")


def latest(df: DataFrame, ts: str, key: str, n: int = 12) -> DataFrame:
    """The newest ``n`` rows, a dashboard feature."""
    return df.orderBy(F.desc(ts), key).limit(n)


def odds_board(odds: DataFrame, keys: list[str]) -> DataFrame:
    """One row per fixture with its three prices."""
    price = lambda s: F.max(F.when(c("selection") == s, c("odds"))).alias(f"{s.lower()}_odds")
    return odds.groupBy(*keys).agg(price("HOME"), price("DRAW"), price("AWAY"))
