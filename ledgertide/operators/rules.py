"""Declarative rules: each selects the rows that break it, as
(rule_id, row_key, report_date). Row rules of a file run in one scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import markets
from ..functions.scalars import matches
from .nomenclature import dated_code

c = F.col
Rule = tuple[str, str, str, object]  # id, kind, field, argument
def no_date() -> Column:
    return F.lit(None).cast("date")


# Predicates of the kinds that look at one row. A NULL passes ``in_set`` and
# ``matches``; ``not_null`` is the rule that catches it.
ROW_KINDS = {
    "not_null": lambda f, _: c(f).isNull(),
    "non_negative": lambda f, _: c(f) < 0,
    "max_value": lambda f, v: c(f) > v,
    "in_set": lambda f, values: ~c(f).isin(values),
    "matches": lambda f, pattern: ~matches(c(f), pattern),
    "zero_when": lambda f, arg: (c(arg[0]) == arg[1]) & (c(f) != 0),
    "code_in_set": lambda f, values: c(f).isNull() | ~c(f).isin(values),
    "condition": lambda _, text: ~F.coalesce(F.expr(text), F.lit(True)),
}


def row_rules(df: DataFrame, rules: Sequence[Rule], key: str, date: str | None = "report_date",
              guard: dict[str, Column] | None = None) -> DataFrame:
    """All row rules in one pass over ``df``: no shuffle, one output row per break.
    ``guard`` limits a rule to some rows (its market, in a file of all markets)."""
    flags = []
    for rule_id, kind, field, arg in rules:
        broken = F.coalesce(ROW_KINDS[kind](field, arg), F.lit(False))
        if guard and rule_id in guard:
            broken = guard[rule_id] & broken
        flags.append(F.when(broken, F.lit(rule_id)))
    day = no_date() if date is None else c(date)
    # Most rows break nothing: they leave before the list of flags is built.
    return (df.filter(F.coalesce(*flags).isNotNull())
            .select(F.explode(F.array(*flags)).alias("rule_id"), c(key).alias("row_key"), day.alias("report_date"))
            .filter(c("rule_id").isNotNull()))


def unique_rule(df: DataFrame, rule_id: str, *fields: str) -> DataFrame:
    """Keys that occur more than once."""
    repeated = df.groupBy(*fields).count().filter("count > 1")
    key = c(fields[0]) if len(fields) == 1 else F.concat_ws("|", *fields)
    return repeated.select(F.lit(rule_id).alias("rule_id"), key.alias("row_key"), no_date().alias("report_date"))


def listed_rules(per_market: Sequence[tuple], common: Sequence[Rule], codes: dict[str, list[str]],
                 code_kind: str) -> tuple[list[Rule], dict[str, Column]]:
    """Row rules of every market for a file of all markets, and their guards.
    A published-code rule becomes a membership test of its market's codes."""
    rules = [r for r in common if r[1] in ROW_KINDS]
    guard = {}
    for market, rule_id, kind, field, arg in per_market:
        if kind == code_kind:
            kind, arg = "code_in_set", codes[market]
        if kind in ROW_KINDS:
            rules.append((rule_id, kind, field, arg))
            guard[rule_id] = c("jurisdiction") == market
    return rules, guard


def sport_codes_by_market() -> dict[str, list[str]]:
    return {m: markets.code_set(markets.SPORT_CODES, [(p[0], p[1]) for p in markets.SPORT_POLICY], m)
            for m in markets.MARKETS}


def game_codes_by_market() -> dict[str, list[str]]:
    return {m: markets.code_set(markets.GAME_CODES, markets.GAME_POLICY, m) for m in markets.GAMING_FILES}


def valid_code(df: DataFrame, known: DataFrame, field: str, rule_id: str, key: str) -> DataFrame:
    """Rows whose code is missing or not published by their market, as an anti join
    to the (market, code) list."""
    listed = F.broadcast(known.select("jurisdiction", c("regulator_code").alias(field)))
    return df.join(listed, ["jurisdiction", field], "left_anti").select(
        F.lit(rule_id).alias("rule_id"), c(key).alias("row_key"), "report_date")


def _for_markets(rule_ids: dict[str, str]) -> Column:
    pairs = [x for m, r in rule_ids.items() for x in (F.lit(m), F.lit(r))]
    return F.create_map(*pairs)[c("jurisdiction")]


def no_unmapped_fixtures(file: DataFrame, lifecycle: DataFrame, fixtures: DataFrame, sport_codes: DataFrame,
                         rule_ids: dict[str, str]) -> DataFrame:
    """Filed slips whose sport has no code of their market on their date."""
    own = file.select("jurisdiction", "slip_id", "report_date").filter(c("jurisdiction").isin(list(rule_ids)))
    df = (own.join(lifecycle.select("slip_id", "fixture_id"), "slip_id")
          .join(fixtures.select("fixture_id", "canonical_sport"), "fixture_id", "left"))
    df = dated_code(df, sport_codes, "canonical_sport", "report_date")
    return df.filter(c("regulator_code").isNull()).select(
        _for_markets(rule_ids).alias("rule_id"), c("slip_id").alias("row_key"), "report_date")


def no_unlicensed_games(file: DataFrame, activity: DataFrame, games: DataFrame, game_codes: DataFrame,
                        rule_ids: dict[str, str]) -> DataFrame:
    own = file.select("jurisdiction", "activity_id", "report_date").filter(
        c("jurisdiction").isin(list(rule_ids)))
    df = (own.join(activity.select("activity_id", "game_id"), "activity_id")
          .join(games.select("game_id", "canonical_game_type"), "game_id", "left"))
    df = dated_code(df, game_codes, "canonical_game_type", "report_date")
    return df.filter(c("regulator_code").isNull()).select(
        _for_markets(rule_ids).alias("rule_id"), c("activity_id").alias("row_key"), "report_date")


def no_voided_slips(file: DataFrame, lifecycle: DataFrame, rule_ids: dict[str, str]) -> DataFrame:
    voided = lifecycle.filter("slip_status = 'VOIDED'").select("slip_id")
    return (file.filter(c("jurisdiction").isin(list(rule_ids))).join(voided, "slip_id", "left_semi")
            .select(_for_markets(rule_ids).alias("rule_id"), c("slip_id").alias("row_key"), "report_date"))


def _in_markets(df: DataFrame, accounts: DataFrame, wanted: list[str]) -> DataFrame:
    own = accounts.select("account_id", "jurisdiction").filter(c("jurisdiction").isin(wanted))
    return df.join(own, "account_id")


def activity_within_session(activity: DataFrame, platform: DataFrame, accounts: DataFrame,
                            wanted: list[str], rule_id: str = "ST-201") -> DataFrame:
    """Plays outside their session's window; an open session has no end yet."""
    s = _in_markets(platform.select("session_id", "account_id", "started_at", "ended_at"), accounts, wanted)
    t = c("occurred_at")
    outside = (t < c("started_at")) | (c("ended_at").isNotNull() & (t > c("ended_at")))
    return (activity.select("session_id", "activity_id", "occurred_at")
            .join(s.drop("account_id"), "session_id").filter(outside)
            .select(F.lit(rule_id).alias("rule_id"), c("activity_id").alias("row_key"),
                    no_date().alias("report_date")))


def single_open_session(platform: DataFrame, accounts: DataFrame, wanted: list[str],
                        rule_id: str = "ST-202") -> DataFrame:
    open_ = _in_markets(platform.filter("ended_at is null").select("account_id"), accounts, wanted)
    return open_.groupBy("account_id").count().filter("count > 1").select(
        F.lit(rule_id).alias("rule_id"), c("account_id").alias("row_key"), no_date().alias("report_date"))


def end_reason_in_set(file: DataFrame, key: str, reasons: Sequence[str] = tuple(markets.END_REASONS),
                      rule_id: str = "ST-203") -> DataFrame:
    return row_rules(file, [(rule_id, "code_in_set", "end_reason", list(reasons))], key)


def single_game_session(stamped: DataFrame, accounts: DataFrame, wanted: list[str],
                        rule_id: str = "ST-204") -> DataFrame:
    """Derived sessions that hold more than one game. Two different games show as
    a smallest and a largest that differ, so no distinct count is shuffled."""
    own = _in_markets(stamped.select("account_id", "game_session_id", "game_id"), accounts, wanted)
    return (own.groupBy("game_session_id").agg(F.min("game_id").alias("_lo"), F.max("game_id").alias("_hi"))
            .filter("_lo <> _hi")
            .select(F.lit(rule_id).alias("rule_id"), c("game_session_id").alias("row_key"),
                    no_date().alias("report_date")))


def run_rules(df: DataFrame, rules: Sequence[Rule], key: str, date: str | None = "report_date",
              guard: dict[str, Column] | None = None) -> DataFrame:
    """Every rule of a file: row rules in one pass, key rules by grouping."""
    row = [r for r in rules if r[1] in ROW_KINDS]
    parts = [row_rules(df, row, key, date, guard)] if row else []
    parts += [unique_rule(df, r[0], r[2]) for r in rules if r[1] == "unique"]
    return reduce(DataFrame.unionByName, parts)


def count_by_rule(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule_id").agg(F.count("*").alias("violations"))


# Invariants of the facts, as conditions that must hold on every row.
LIFECYCLE_CONDITIONS = [
    ("L-1", "condition", "", "slip_status <> 'SETTLED' or settled_at is not null"),
    ("L-2", "condition", "", "slip_status <> 'VOIDED' or voided_at is not null"),
    ("L-3", "condition", "", "slip_status <> 'OPEN' or (settled_at is null and voided_at is null)"),
    ("L-4", "condition", "", "payout = 0 or slip_status = 'SETTLED'"),
    ("L-5", "condition", "", "stake >= 0 and payout >= 0"),
    ("L-6", "condition", "", "settled_at is null or settled_at >= placed_at"),
]
ACTIVITY_CONDITIONS = [
    ("A-1", "condition", "", "stake >= 0 and payout >= 0 and rake_or_fee >= 0"),
    ("A-2", "condition", "", "vertical <> 'CASINO_ROUND' or rake_or_fee = 0"),
    ("A-3", "condition", "", "vertical = 'CASINO_ROUND' or jackpot_contribution = 0"),
]
SESSION_CONDITIONS = [
    ("S-1", "condition", "", "ended_at is null or ended_at >= started_at"),
    ("S-2", "condition", "", "(ended_at is null) = (end_reason is null)"),
    ("S-3", "condition", "", "ended_at is null or last_activity_ts <= ended_at"),
]
PAYMENT_CONDITIONS = [
    ("P-1", "condition", "", "amount > 0"),
    ("P-2", "condition", "", "status <> 'COMPLETED' or completed_ts is not null"),
    ("P-3", "condition", "", "completed_ts is null or completed_ts >= requested_ts"),
]
POOL_CONDITIONS = [("J-1", "condition", "", "pool_balance >= 0")]
