"""The registered queries: name -> plan over the models of one data folder.

A query that reads facts shared by several models writes those facts once
(``Models.share``) and reads them back, which is what a production run does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import markets
from ..functions import scalars
from ..functions.frames import present
from ..operators import (cdc, core, delivery, document_formats, documents, exceptions, gaming, nomenclature,
                         ordered, protection, recon, records, rules, sessions, submissions)
from ..scratch import recorded, release, work_folder
from ..sources import sinks
from . import derive, pipeline
from .pipeline import Models

c = F.col
Plan = Callable[[Models], DataFrame]
PLANS: dict[str, Plan] = {}


def plan(fn: Plan) -> Plan:
    PLANS[fn.__name__] = fn
    return fn


def now() -> F.Column:
    return F.lit(derive.RUN_TS).cast("timestamp")


# Models that are a query as they stand, with the models they share first.
STRAIGHT: dict[str, tuple[str, ...]] = {
    **{f"stg_{feed}": () for feed in cdc.STAGING},
    "dim_account": (), "fct_lifecycle": (), "dim_fixture": (), "dim_game": (), "unmapped_sports": (),
    "unmapped_game_types": (), "stg_rounds": (), "fct_contributions": (), "fct_activity": (),
    "pool_liability": (), "operator_pool_liability": (), "platform_sessions": (), "session_activity": (),
    "game_sessions": (), "platform_session_file": ("fct_activity",), "game_session_file": ("fct_activity",),
    "fct_payments": (), "fct_gambling": (), "fct_ledger": (), "dim_balance": (), "dim_compliance": (),
    "deposit_limits": (), "breach_deposit_limits": (), "breach_loss_limits": (),
    "breach_activity_while_excluded": (), "breach_unverified_withdrawals": (),
    "breach_wallet_overspend": ("fct_ledger",), "breach_stake_limits": (), "addresses": (), "terminal_periods": (),
    "readiness": (), "retry_state": (),
    "gaming_file": (), "gaming_tax": (), "slip_amounts": (), "cash_flow": (), "daily_flows": (), "daily_recon": (),
}
for _name, _shared in STRAIGHT.items():
    PLANS[_name] = lambda m, n=_name, s=_shared: m.share(*s)[n]


# Models that stand on the holds, with the models they share after these.
for _name, _shared in {"holds": (), "fct_exceptions": (), "betting_file": ("blocked",), "betting_tax": ("blocked",), "registers": ("blocked",)}.items():
    PLANS[_name] = lambda m, n=_name, s=_shared: pipeline.withheld(m).share(*s)[n]


def gated(m: Models) -> Models:
    return pipeline.withheld(m).share("blocked", "readiness")


# ---- sources, references -----------------------------------------------------

@plan
def landing_scan(m: Models) -> DataFrame:
    """Rows and newest change per feed, as a scan of every change feed."""
    feeds = [n for n in cdc.STAGING]
    parts = [m[f"cdc_{n}"].agg(F.count("*").alias("images"), F.max("_commit_ts").alias("newest"))
             .select(F.lit(n).alias("feed"), "images", "newest") for n in feeds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@plan
def market_players(m: Models) -> DataFrame:
    """Accounts per market with its settings, through the configuration frames."""
    n = m["dim_account"].groupBy("jurisdiction").agg(F.count("*").alias("accounts"))
    return n.join(m["market"], "jurisdiction").select(
        "jurisdiction", "timezone", "currency", "tax_basis", "include_voided", "accounts")


@plan
def sport_alias_use(m: Models) -> DataFrame:
    """Fixtures per normalised spelling and canonical sport."""
    df = m["stg_fixtures"].withColumn("alias_norm", scalars.normalise_text(c("sport_name_raw")))
    df = df.join(m["ref_sport_aliases"].select("alias_norm", "canonical"), "alias_norm", "left")
    df = df.join(m["ref_sport_canonical"].select(c("code").alias("canonical"), "name"), "canonical", "left")
    return df.groupBy("alias_norm", "canonical", "name").agg(F.count("*").alias("fixtures"))


@plan
def participant_alias_use(m: Models) -> DataFrame:
    df = nomenclature.lookup_alias(m["stg_fixtures"], "home_raw", m["ref_participant_aliases"],
                                   {"canonical_id": "participant_id", "canonical_name": "participant"})
    return df.groupBy("home_raw", "participant_id", "participant").agg(F.count("*").alias("fixtures"))


@plan
def game_alias_use(m: Models) -> DataFrame:
    df = nomenclature.lookup_alias(m["stg_games"], "game_type_raw", m["ref_game_type_aliases"],
                                   {"canonical": "canonical"})
    return df.groupBy("game_type_raw", "canonical").agg(F.count("*").alias("games"))


@plan
def sport_code_on_date(m: Models) -> DataFrame:
    """Slips per market, sport and regulator code valid on the report date."""
    df = m["reportable"].join(m["dim_fixture"].select("fixture_id", "canonical_sport"), "fixture_id", "left")
    df = nomenclature.dated_code(df, m["map_sport_regulator"], "canonical_sport", "report_date")
    return df.groupBy("jurisdiction", "canonical_sport", "regulator_code").agg(
        F.count("*").alias("slips"), F.min("report_date").alias("first_date"), F.max("report_date").alias("last_date"))


@plan
def game_code_on_date(m: Models) -> DataFrame:
    df = m["gaming_reportable"].join(m["dim_game"].select("game_id", "canonical_game_type"), "game_id", "left")
    df = nomenclature.dated_code(df, m["map_game_regulator"], "canonical_game_type", "report_date")
    return df.groupBy("jurisdiction", "canonical_game_type", "regulator_code").agg(F.count("*").alias("plays"))


@plan
def stake_bands_met(m: Models) -> DataFrame:
    """Statutory bands with the players each one covers on the run date."""
    day = F.to_date(now())
    age = scalars.age_years(c("date_of_birth"), day)
    b = m["ref_stake_limits"]
    df = m["dim_account"].join(F.broadcast(b), "jurisdiction").filter(
        (age >= c("min_age")) & (c("max_age").isNull() | (age <= c("max_age"))))
    return df.groupBy("jurisdiction", "max_stake", "min_age", "max_age", "valid_from", "valid_to").agg(
        F.count("*").alias("players"))


@plan
def rate_on_date(m: Models) -> DataFrame:
    """The betting rate in force per market and month of settlement."""
    df = m["reportable"].select("jurisdiction", "report_date").distinct()
    df = nomenclature.dated_rate(df, m["betting_rates"], "report_date")
    return df.groupBy("jurisdiction", F.trunc("report_date", "month").alias("month"), "rate").agg(
        F.count("*").alias("days"))


@plan
def published_codes_used(m: Models) -> DataFrame:
    """Codes acceptable in any period, with the slips that carry each."""
    known = nomenclature.known_codes(m["map_sport_regulator"], m["sport_policy"], "default_sport_code")
    df = m["reportable"].join(m["dim_fixture"].select("fixture_id", "canonical_sport"), "fixture_id", "left")
    df = nomenclature.dated_code(df, m["map_sport_regulator"], "canonical_sport", "report_date")
    df = df.join(m["sport_policy"], "jurisdiction").withColumn(
        "regulator_code", nomenclature.with_bucket(c("regulator_code"), c("default_sport_code")))
    used = df.groupBy("jurisdiction", "regulator_code").agg(F.count("*").alias("slips"))
    return known.join(used, ["jurisdiction", "regulator_code"], "left").fillna(0, ["slips"])


@plan
def normalised_text(m: Models) -> DataFrame:
    """Text normalisation over every label the feeds carry."""
    labels = m["cdc_fixtures"].select(F.explode(F.array("sport_name_raw", "home_raw", "away_raw")).alias("raw"))
    return labels.groupBy("raw").agg(F.count("*").alias("uses")).withColumn(
        "normalised", scalars.normalise_text(c("raw")))


@plan
def event_names(m: Models) -> DataFrame:
    """Rendered event name of every fixture in every market's template."""
    templates = sorted({p[2] for p in markets.SPORT_POLICY})
    df = m["dim_fixture"].withColumn("event_template", F.explode(F.array(*[F.lit(x) for x in templates])))
    name = scalars.render_event_name(c("event_template"), c("home_name"), c("away_name"))
    return df.select("fixture_id", "event_template", name.alias("event_name"))


# ---- core --------------------------------------------------------------------

@plan
def slip_status_by_rank(m: Models) -> DataFrame:
    return core.slip_status_by_rank(m["stg_bet_slip_events"])


@plan
def lifecycle_from_staging(m: Models) -> DataFrame:
    """The lifecycle fact by staging first and pivoting then."""
    return core.slip_lifecycle(m["stg_bet_slip_events"], m["stg_bet_slips"])


@plan
def platform_balance(m: Models) -> DataFrame:
    return core.platform_balance(m["stg_payments"], m["fct_lifecycle"], m["cdc_play_rounds"])


@plan
def front_door_limits(m: Models) -> DataFrame:
    return core.active_limits(m["stg_player_limits"], "min", ("DEPOSIT", "LOSS"))


# ---- gaming ------------------------------------------------------------------

def _feed(name: str) -> Plan:
    return lambda m: gaming.normalise_feed(m[f"cdc_{name}"], gaming.FEEDS[name], m["stg_games"])


for _feed_name in gaming.FEEDS:
    PLANS[f"rounds_{_feed_name}"] = _feed(_feed_name)


@plan
def gaming_revenue_by_vertical(m: Models) -> DataFrame:
    revenue = gaming.gaming_revenue(c("deduct_contributions"))
    return m["gaming_reportable"].groupBy("jurisdiction", "vertical").agg(
        F.count("*").alias("plays"), F.sum(revenue).alias("ggr"))


@plan
def reseeding_pool(m: Models) -> DataFrame:
    return gaming.reseeding_pool(m["cdc_play_rounds"])


@plan
def contribution_rate_breaks(m: Models) -> DataFrame:
    return gaming.contribution_rate_breaks(m["stg_rounds"], m["cdc_jackpot_pools"])


@plan
def wallet_pool_check(m: Models) -> DataFrame:
    return gaming.wallet_pool_check(m["fct_ledger"], m["fct_contributions"])


@plan
def bonus_winnings(m: Models) -> DataFrame:
    df = m["cdc_play_rounds"].filter("funding = 'GOLDEN_CHIP'")
    return df.select("round_id", "account_id", "stake", "payout",
                     gaming.bonus_winnings(c("stake"), c("payout")).alias("winnings"))


@plan
def implied_contributions(m: Models) -> DataFrame:
    return gaming.implied_contributions(m["cdc_play_rounds"], m["stg_jackpot_optins"])


# ---- sessions ----------------------------------------------------------------

@plan
def sessions_timed_out(m: Models) -> DataFrame:
    return sessions.close_inactive(m["stg_gaming_sessions"], m["dim_account"], m["market"], now())


@plan
def activity_sessions(m: Models) -> DataFrame:
    """Sessions found in the payment activity by its gaps."""
    activity = m["cdc_payments"].select("account_id", "payment_id", "requested_ts")
    numbered = sessions.sessionise(activity, "account_id", "requested_ts", "payment_id", 8 * 60)
    return sessions.session_summary(numbered, "account_id", "requested_ts")


def _round_lists(m: Models, **size: int) -> DataFrame:
    df = sessions.session_round_lists(m["cdc_play_rounds"], m["stg_gaming_sessions"], **size)
    return df.withColumn("round_ids", F.array_join("round_ids", ","))


@plan
def session_round_lists(m: Models) -> DataFrame:
    return _round_lists(m)


@plan
def split_session_round_lists(m: Models) -> DataFrame:
    return _round_lists(m, part_rows=derive.SPLIT_ROUNDS)


@plan
def session_events(m: Models) -> DataFrame:
    return sessions.session_events(m["stg_gaming_sessions"])


@plan
def session_total_breaks(m: Models) -> DataFrame:
    m.share("fct_activity")
    return sessions.session_total_breaks(m["game_sessions"], m["platform_sessions"]).select("session_id")


# ---- files, tax, registers ---------------------------------------------------

for _market in markets.MARKETS:
    PLANS[f"betting_file_{_market.lower()}"] = (
        lambda m, k=_market: submissions.market_file(gated(m)["betting_file"], k))
for _market, _columns in markets.GAMING_FILES.items():
    PLANS[f"gaming_file_{_market.lower()}"] = lambda m, k=_market, cols=_columns: (
        m["gaming_file"].filter(c("jurisdiction") == k).select("jurisdiction", "report_date", *cols))


@plan
def filed_slips(m: Models) -> DataFrame:
    """Status and date rules of the betting file, before any account is withheld."""
    return submissions.filed_status(m["reportable"]).groupBy("jurisdiction", "report_date", "slip_status").agg(
        F.count("*").alias("slips"))


@plan
def carried_attributes(m: Models) -> DataFrame:
    return submissions.carried_attributes(m["stg_reg_attributes"], markets.CARRIED)


@plan
def winnings_withholding(m: Models) -> DataFrame:
    df = m["reportable"]  # NULL in markets that withhold nothing
    # the derived payouts are small, so the brackets are also met at ten times the amount
    return df.select("slip_id", "payout", submissions.withholding(c("payout"), c("jurisdiction")).alias("tax"),
                     submissions.withholding((c("payout") * 10).cast("decimal(18,2)"), c("jurisdiction"))
                     .alias("tax_on_tenfold"))


@plan
def vertical_tax(m: Models) -> DataFrame:
    return submissions.vertical_tax(m["cdc_settled_bets"], m["vertical_rates"])


@plan
def plain_submission(m: Models) -> DataFrame:
    return submissions.plain_submission(m["cdc_settled_bets"], m["market"])


@plan
def settled_on_local_day(m: Models) -> DataFrame:
    return submissions.settled_on(m["fct_lifecycle"], "2023-03-26", "Europe/Madrid").select(
        "slip_id", "settled_at", "stake", "payout")


@plan
def market_fan_out(m: Models) -> DataFrame:
    """Columns and rows of the file each market gets, as read back from one write of all markets' files."""
    file = submissions.betting_file(submissions.filed_status(m["reportable"]), m["dim_fixture"], m["stg_reg_attributes"],
                                    m["map_sport_regulator"], m["sport_policy"])
    spark, root = file.sparkSession, f"{work_folder(file.sparkSession)}/market-files-{uuid.uuid4().hex}"
    sinks.fan_out(file, root, list(markets.MARKETS), ("jurisdiction",))  # one folder a market: days would be some thousand folders here
    found = [r[0] for r in spark.read.parquet(root).select("jurisdiction").distinct().collect()]  # folder names alone
    counts = []
    for k in sorted(found):
        mine = sinks.market_rows(spark, root, k)
        counts.append(mine.agg(F.count("*").alias("rows")).select(F.lit(k).alias("jurisdiction"), "rows", F.lit(len(mine.columns) - 1).alias("columns")))
    return reduce(DataFrame.unionByName, counts).filter("rows > 0")


@plan
def register_completeness(m: Models) -> DataFrame:
    r = gated(m)["registers"]
    return submissions.register_completeness(r.filter("register_id = 'RUD'"), r.filter("register_id = 'RUT'"))


@plan
def register_rows(m: Models) -> DataFrame:
    return submissions.register_rows(m["fct_lifecycle"], m["dim_account"], m["market"])


def _filings(m: Models, **size: int) -> DataFrame:
    filed = submissions.register_filings(m["filing_rows"], **size)
    total = F.aggregate("rows", F.lit(0).cast("decimal(28,2)"),
                        lambda acc, r: (acc + r["stake_sum"]).cast("decimal(28,2)"))
    return filed.select("jurisdiction", "record_key", "part", "parts", "players", F.size("rows").alias("listed"),
                        total.alias("stake_sum"), c("rows")[0]["player_ref"].alias("first_player"))


@plan
def register_filings(m: Models) -> DataFrame:
    return _filings(m)


@plan
def split_register_filings(m: Models) -> DataFrame:
    return _filings(m, part_rows=derive.SPLIT_PLAYERS)


@plan
def daily_financial_summary(m: Models) -> DataFrame:
    return submissions.daily_financial_summary(m["fct_activity"], m["dim_account"], m["dim_game"], m["market"])


# ---- player protection -------------------------------------------------------

@plan
def statutory_defaults(m: Models) -> DataFrame:
    return m["deposit_limits"].groupBy("jurisdiction", "period", "default_limit").agg(
        F.count("*").alias("accounts"), F.count("effective_limit").alias("capped"))


@plan
def statutory_caps(m: Models) -> DataFrame:
    """The slots cap of every player on the run date, from age and bands."""
    day = F.to_date(now())
    df = m["dim_account"]
    age = scalars.age_years(c("date_of_birth"), day)
    return df.select("account_id", "jurisdiction", age.alias("age"),
                     protection.statutory_cap(c("jurisdiction"), age, day).alias("cap"))


@plan
def rolling_deposit_audit(m: Models) -> DataFrame:
    return protection.rolling_deposit_audit(m["stg_payments"], m["stg_player_limits"])


@plan
def rolling_loss_audit(m: Models) -> DataFrame:
    return protection.rolling_loss_audit(m["fct_lifecycle"], m["cdc_play_rounds"], m["stg_player_limits"])


@plan
def active_exclusions(m: Models) -> DataFrame:
    return protection.active_exclusions(m["stg_self_exclusions"], F.lit("2022-09-01").cast("timestamp"))


@plan
def stake_cap_audit(m: Models) -> DataFrame:
    return protection.stake_cap_audit(m["cdc_play_rounds"], m["dim_account"], m["stg_player_limits"])


@plan
def stakes_over_cap_then(m: Models) -> DataFrame:
    return protection.stakes_over_cap_then(m["cdc_play_rounds"], m["stg_player_limits"])


@plan
def wager_gate_audit(m: Models) -> DataFrame:
    rounds = m.share("slip_amounts", "cash_flow")["cdc_play_rounds"]
    flow = m["cash_flow"].withColumn("is_wager", c("kind").isin("BET_STAKE", "CASINO_NET"))
    with recorded() as folders:
        balances = protection.balances_before(flow)
    m.release("cash_flow")
    bets = m["slip_amounts"].select(
        c("slip_id").alias("wager_id"), "account_id", c("placed_at").alias("ts"), "stake",
        core.zero().alias("net"), F.lit(False).alias("casino"), F.lit(None).cast("string").alias("game"),
        F.lit("CASH").alias("funding"))
    plays = rounds.select(
        c("round_id").alias("wager_id"), "account_id", c("round_ts").alias("ts"), "stake",
        (c("stake") - c("payout")).cast(scalars.MONEY).alias("net"), F.lit(True).alias("casino"), "game", "funding")
    caps = protection.stake_cap_audit(rounds, m["dim_account"], m["stg_player_limits"])
    losses = protection.loss_events(m["fct_lifecycle"], rounds)
    audit = protection.wager_gate_audit(bets.unionByName(plays), balances, m["stg_self_exclusions"],
                                        m["stg_jackpot_optins"], losses, m["stg_player_limits"], caps)
    release(rounds.sparkSession, folders)  # what is returned reads the failures alone
    m.release("slip_amounts")
    return audit


# ---- exceptions --------------------------------------------------------------

@plan
def postcode_verdicts(m: Models) -> DataFrame:
    return m["addresses"].groupBy("jurisdiction", "postcode_valid", "fail_reason").agg(F.count("*").alias("addresses"))


@plan
def postcode_region_matches(m: Models) -> DataFrame:
    return m["addresses"].filter("region_name is not null").select("account_id", "postcode", "region_name")


@plan
def resolved_failures(m: Models) -> DataFrame:
    return exceptions.resolved_failures(m["addresses"], m["cdc_exception_state"])


@plan
def backoff_schedule(m: Models) -> DataFrame:
    return m["cdc_exception_state"].select(
        "entity_id", "attempt_count", exceptions.backoff_minutes(c("attempt_count")).cast("bigint").alias("minutes"),
        scalars.add_minutes(c("first_seen"), exceptions.backoff_minutes(c("attempt_count"))).alias("retry_at"))


@plan
def admissible_slips(m: Models) -> DataFrame:
    return gated(m)["admissible"].select("slip_id", "account_id", "jurisdiction", "report_date", "slip_status")


@plan
def isolation_breaches(m: Models) -> DataFrame:
    pipeline.withheld(m).share("fct_exceptions", "readiness", "filed")  # of the file, what the gate reads
    return exceptions.isolation_breaches(m["filed"], m["fct_lifecycle"], m["fct_exceptions"])


@plan
def run_gate_counts(m: Models) -> DataFrame:
    """Violations per gate; any row stops publication."""
    fact = rules.row_rules(m["fct_lifecycle"], rules.LIFECYCLE_CONDITIONS, "slip_id", None)
    paid = rules.row_rules(m["fct_payments"], rules.PAYMENT_CONDITIONS, "payment_id", None)
    twice = rules.unique_rule(m["cdc_bet_slips"], "SLIP-KEY", "slip_id")
    return rules.count_by_rule(fact.unionByName(paid).unionByName(twice))


# ---- rules -------------------------------------------------------------------

def betting_rule_set() -> tuple[list, dict]:
    return rules.listed_rules(markets.BETTING_RULES, markets.COMMON_BETTING_RULES,
                              rules.sport_codes_by_market(), "valid_sport_code")


def _one_kind(kind: str) -> Plan:
    def run(m: Models) -> DataFrame:
        listed, guard = betting_rule_set()
        chosen = [r for r in listed if r[1] == kind]
        return rules.row_rules(m["open_file"], chosen, "slip_id", "report_date", guard)
    return run


for _kind in ("not_null", "non_negative", "max_value", "in_set", "matches", "zero_when"):
    PLANS[f"rule_{_kind}"] = _one_kind(_kind)


@plan
def rule_strict_thresholds(m: Models) -> DataFrame:
    """The row kinds with tight arguments, so that every kind finds rows."""
    tight = [("T-NEG", "non_negative", "ggr", None), ("T-MAX", "max_value", "stake", 45),
             ("T-SET", "in_set", "slip_status", ["SETTLED"]), ("T-RE", "matches", "slip_id", "[02468]$"),
             ("T-ZERO", "zero_when", "payout", ("slip_status", "SETTLED"))]
    return rules.row_rules(m["open_file"], tight, "slip_id")


@plan
def rule_unique(m: Models) -> DataFrame:
    return rules.unique_rule(m["cdc_bet_slips"], "COM-005", "slip_id")


@plan
def rule_valid_sport_code(m: Models) -> DataFrame:
    known = nomenclature.known_codes(m["map_sport_regulator"], m["sport_policy"], "default_sport_code")
    return rules.valid_code(m["open_file"], known, "sport_code", "SPORT-CODE", "slip_id")


@plan
def rule_no_unmapped_fixtures(m: Models) -> DataFrame:
    ids = {r[0]: r[1] for r in markets.BETTING_RULES if r[2] == "no_unmapped_fixtures"}
    return rules.no_unmapped_fixtures(m["open_file"], m["fct_lifecycle"], m["dim_fixture"],
                                      m["map_sport_regulator"], ids)


@plan
def rule_valid_game_code(m: Models) -> DataFrame:
    known = nomenclature.known_codes(m["map_game_regulator"], m["game_policy"], "default_game_code")
    return rules.valid_code(m["gaming_file"], known, "game_code", "GAME-CODE", "activity_id")


@plan
def rule_no_unlicensed_games(m: Models) -> DataFrame:
    ids = {r[0]: r[1] for r in markets.GAMING_RULES if r[2] == "no_unlicensed_games"}
    m.share("fct_activity")
    return rules.no_unlicensed_games(m["gaming_file"], m["fct_activity"], m["dim_game"],
                                     m["map_game_regulator"], ids)


def _session_markets(kind: str) -> list[str]:
    return [r[0] for r in markets.SESSION_RULES if r[2] == kind]


@plan
def rule_activity_within_session(m: Models) -> DataFrame:
    m.share("fct_activity")
    return rules.activity_within_session(m["fct_activity"], m["platform_sessions"], m["dim_account"],
                                         _session_markets("activity_within_session"))


@plan
def rule_single_open_session(m: Models) -> DataFrame:
    return rules.single_open_session(m["platform_sessions"], m["dim_account"],
                                     _session_markets("single_open_session"))


@plan
def rule_end_reason_in_set(m: Models) -> DataFrame:
    m.share("fct_activity")
    return rules.end_reason_in_set(m["platform_session_file"], "session_id").unionByName(
        rules.end_reason_in_set(m["game_session_file"], "game_session_id"))


@plan
def rule_single_game_session(m: Models) -> DataFrame:
    return rules.single_game_session(m["session_activity"], m["dim_account"],
                                     _session_markets("single_game_session"))


@plan
def sessions_with_many_games(m: Models) -> DataFrame:
    """The single-game rule on platform sessions, where several games are normal."""
    stamped = m["session_activity"].withColumn("game_session_id", c("session_id"))
    return rules.single_game_session(stamped, m["dim_account"], markets.MARKETS)


@plan
def rule_no_voided_slips(m: Models) -> DataFrame:
    ids = {r[0]: r[1] for r in markets.BETTING_RULES if r[2] == "no_voided_slips"}
    everything = m["reportable"].select("jurisdiction", "slip_id", "report_date")
    return rules.no_voided_slips(everything, m["fct_lifecycle"], ids)


@plan
def key_assertions(m: Models) -> DataFrame:
    """Composite key uniqueness of feeds before and after staging."""
    raw = rules.unique_rule(m["cdc_reg_attributes"], "RAW", "entity_type", "entity_id", "attr_name")
    staged = rules.unique_rule(m["stg_reg_attributes"], "STAGED", "entity_type", "entity_id", "attr_name")
    return raw.unionByName(staged)


@plan
def null_assertions(m: Models) -> DataFrame:
    listed = [("NN-settled", "not_null", "settled_at", None), ("NN-placed", "not_null", "placed_at", None)]
    return rules.row_rules(m["fct_lifecycle"], listed, "slip_id", None)


@plan
def row_conditions(m: Models) -> DataFrame:
    sets = [(m["fct_lifecycle"], rules.LIFECYCLE_CONDITIONS, "slip_id"),
            (m["fct_activity"], rules.ACTIVITY_CONDITIONS, "activity_id"),
            (m["stg_gaming_sessions"], rules.SESSION_CONDITIONS, "session_id"),
            (m["fct_payments"], rules.PAYMENT_CONDITIONS, "payment_id"),
            (m["operator_pool_liability"], rules.POOL_CONDITIONS, "jackpot_id")]
    out = None
    for df, conditions, key in sets:
        part = rules.row_rules(df, conditions, key, None)
        out = part if out is None else out.unionByName(part)
    return out


@plan
def one_pass_rules(m: Models) -> DataFrame:
    """Every betting rule of every market over the file in one scan."""
    listed, guard = betting_rule_set()
    return rules.count_by_rule(rules.run_rules(m["open_file"], [*listed, ("COM-005", "unique", "slip_id", None)],
                                               "slip_id", "report_date", guard))


@plan
def gaming_rules(m: Models) -> DataFrame:
    listed, guard = rules.listed_rules(markets.GAMING_RULES, markets.COMMON_GAMING_RULES,
                                       rules.game_codes_by_market(), "valid_game_code")
    return rules.count_by_rule(rules.row_rules(m["gaming_file"], listed, "activity_id", "report_date", guard))


@plan
def register_rules(m: Models) -> DataFrame:
    listed = [*markets.COMMON_REGISTER_RULES, *[r[1:] for r in markets.REGISTER_RULES]]
    guard = {r[1]: c("register_id") == r[0] for r in markets.REGISTER_RULES}
    rows = m["open_registers"]
    return rules.row_rules(rows, [*listed, ("R-LOSS", "non_negative", "ggr_sum", None)], "player_ref",
                           "period_start", guard)


# ---- reconciliation ----------------------------------------------------------

@plan
def provider_breaks(m: Models) -> DataFrame:
    return recon.provider_breaks(m["stg_rounds"], m["cdc_provider_statements"])


def _new_pipe(m: Models) -> DataFrame:
    df = m["fct_lifecycle"].filter("settled_at is not null").join(
        m["dim_account"].select("account_id", "jurisdiction"), "account_id")
    return df.select("jurisdiction", c("slip_id").alias("bet_id"), F.to_date("settled_at").alias("report_date"),
                     "stake", "payout", (c("stake") - c("payout")).cast(scalars.MONEY).alias("ggr"))


@plan
def legacy_total_breaks(m: Models) -> DataFrame:
    return recon.legacy_total_breaks(m["cdc_legacy_capture"], _new_pipe(m)).drop("legacy_value", "new_value")


@plan
def legacy_total_values(m: Models) -> DataFrame:
    """The JSON text of both sides of a totals break."""
    df = recon.legacy_total_breaks(m["cdc_legacy_capture"], _new_pipe(m))
    return df.select("jurisdiction", "report_date", F.get_json_object("legacy_value", "$.row_count").cast("bigint")
                     .alias("legacy_rows"), F.get_json_object("new_value", "$.total_stake").cast("double").alias("new_stake"))


@plan
def legacy_row_breaks(m: Models) -> DataFrame:
    return recon.legacy_row_breaks(m["cdc_legacy_capture"], _new_pipe(m))


@plan
def legacy_field_breaks(m: Models) -> DataFrame:
    return recon.legacy_field_breaks(m["cdc_legacy_capture"], _new_pipe(m))


@plan
def submitted_breaks(m: Models) -> DataFrame:
    filed = m["cdc_legacy_capture"].withColumn("receipt_id", F.concat_ws(
        "-", "jurisdiction", F.date_format("report_date", "yyyyMMdd")))
    return recon.submitted_breaks(delivery.receipt_totals(filed), _new_pipe(m))


@plan
def cutover_breaks(m: Models) -> DataFrame:
    new = _new_pipe(m)
    legacy = m["cdc_legacy_capture"]
    every = recon.cutover_breaks(recon.legacy_total_breaks(legacy, new), recon.legacy_row_breaks(legacy, new),
                                 recon.legacy_field_breaks(legacy, new))
    return every.groupBy("jurisdiction", "break_type").agg(F.count("*").alias("breaks"))


@plan
def period_balances(m: Models) -> DataFrame:
    start, end = (F.lit(t).cast("timestamp") for t in ("2023-01-01", "2024-02-01"))
    return recon.period_balances(m["cash_flow"], start, end)


@plan
def open_stakes(m: Models) -> DataFrame:
    return recon.open_stakes_at(m["slip_amounts"], F.lit("2023-01-01").cast("timestamp"))


@plan
def deposits_and_withdrawals(m: Models) -> DataFrame:
    return m["daily_flows"].select("jurisdiction", "day", "deposits", "withdrawals").filter(
        "deposits <> 0 or withdrawals <> 0")


@plan
def settlement_view(m: Models) -> DataFrame:
    return m["daily_flows"].filter("settled_n > 0").select(
        "jurisdiction", "day", c("settled_n").cast("bigint").alias("settled_n"), "settled_stakes", "settled_payouts")


@plan
def void_reversals(m: Models) -> DataFrame:
    return m["daily_flows"].filter("void_n > 0").select(
        "jurisdiction", "day", c("void_n").cast("bigint").alias("void_n"), "void_stakes", "void_ggr_reversal")


@plan
def rounds_by_funding(m: Models) -> DataFrame:
    return m["market_rounds"].groupBy("jurisdiction", "funding", F.to_date("round_ts").alias("day")).agg(
        F.count("*").alias("rounds"), F.sum("stake").alias("stakes"), F.sum("payout").alias("payouts"))


@plan
def bonus_policy(m: Models) -> DataFrame:
    return m["daily_recon"].filter("golden_n > 0").select(
        "jurisdiction", "day", "golden_stakes", "golden_winnings", "golden_ggr", "bonus_bridge")


@plan
def monthly_recon(m: Models) -> DataFrame:
    return recon.monthly_reconciliation(m["daily_recon"])


@plan
def expected_records(m: Models) -> DataFrame:
    return recon.expected_records(m["slip_amounts"], m["fct_payments"], m["market_rounds"],
                                  m["market_sessions"], m["market"], m["licensed_games"])


@plan
def completeness_breaks(m: Models) -> DataFrame:
    expected = recon.expected_records(m["slip_amounts"], m["fct_payments"], m["market_rounds"],
                                      m["market_sessions"], m["market"], m["licensed_games"])
    log = m["cdc_delivery_log"]
    # stored documents of the deliveries, two thirds of them under a suffixed name
    stem = F.regexp_replace("record_key", r"\|.*$", "")
    kept = log.filter(F.right(stem, F.lit(1)) != "6").filter("jurisdiction is not null")
    suffix = F.when(F.substring(stem, -2, 1) > "3", "-GAIN").otherwise("")
    paths = kept.select(F.concat(F.lit("/safe/"), c("jurisdiction"), F.lit("/"), c("record_type"),
                                 F.lit("/000001-"), stem, suffix, F.lit(".xml")).alias("path"))
    return recon.completeness_breaks(expected, log, recon.stored_files(paths)).groupBy(
        "jurisdiction", "record_type", "problem").agg(F.count("*").alias("records"))


@plan
def active_markets(m: Models) -> DataFrame:
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-10", "2024-01-11"))
    return recon.active_markets(m["cash_flow"], start, end)


# ---- delivery and sinks ------------------------------------------------------

@plan
def pending_bets(m: Models) -> DataFrame:
    df = delivery.pending_bets(m["slip_amounts"], m["dim_account"], m["market"], m["cdc_delivery_log"])
    return df.select("slip_id", "jurisdiction", "player_ref", "status", "payout", "stake", "placed_at",
                     "terminal_at", "log_key", "route")


@plan
def pending_payments(m: Models) -> DataFrame:
    df = delivery.pending_payments(m["stg_payments"], m["dim_account"], m["market"], m["cdc_delivery_log"])
    return df.select("payment_id", "jurisdiction", "player_ref", "direction", "amount", "method", "completed_ts")


@plan
def pending_players(m: Models) -> DataFrame:
    df = delivery.pending_players(m["dim_account"], m["market"], m["cdc_delivery_log"])
    return df.select("account_id", "jurisdiction", "player_ref", "kyc_status", "log_key")


@plan
def pending_gaming(m: Models) -> DataFrame:
    df = delivery.pending_gaming(m["cdc_play_rounds"], m["dim_account"], m["market"], m["licensed_games"],
                                 m["cdc_delivery_log"])
    return df.select("round_id", "jurisdiction", "player_ref", "game", "game_type_code", "stake", "payout",
                     "funding", "route")


@plan
def pending_platform_sessions(m: Models) -> DataFrame:
    df = delivery.pending_platform_sessions(m["stg_gaming_sessions"], m["dim_account"], m["market"],
                                            m["cdc_delivery_log"])
    return df.select("session_id", "jurisdiction", "player_ref", "started_at", "ended_at", "end_reason")


@plan
def pending_game_sessions(m: Models) -> DataFrame:
    lists = sessions.session_round_lists(m["cdc_play_rounds"], m["stg_gaming_sessions"])
    df = delivery.pending_game_sessions(lists, m["dim_account"], m["market"], m["cdc_delivery_log"])
    return df.select("session_id", "game", "jurisdiction", "player_ref", "first_played_at", "last_played_at",
                     "rounds", "rounds_won", F.array_join("round_ids", ",").alias("round_ids"))


@plan
def routing_counts(m: Models) -> DataFrame:
    bets = delivery.pending_bets(m["slip_amounts"], m["dim_account"], m["market"], m["cdc_delivery_log"])
    plays = delivery.pending_gaming(m["cdc_play_rounds"], m["dim_account"], m["market"], m["licensed_games"],
                                    m["cdc_delivery_log"])
    cols = ["jurisdiction", "record_type", "route"]
    both = bets.withColumn("record_type", F.lit("bets")).select(*cols).unionByName(
        plays.withColumn("record_type", F.lit("gaming")).select(*cols))
    return both.groupBy(*cols).agg(F.count("*").alias("records"))


@plan
def player_references(m: Models) -> DataFrame:
    df = m["dim_account"].join(m["market"].select("jurisdiction", "hashed_ref"), "jurisdiction")
    return df.select("account_id", "jurisdiction", submissions.player_reference(
        c("hashed_ref"), c("national_id"), c("account_id")).alias("player_ref"))


@plan
def slip_balances(m: Models) -> DataFrame:
    """Wallet around the stake and the credit of every ended slip."""
    df = m["slip_amounts"].filter("settled_at is not null or voided_at is not null").join(
        m["dim_balance"].select("account_id", "balance"), "account_id")
    credit = F.when(c("voided_at").isNotNull(), c("stake")).otherwise(c("payout"))
    return df.select("slip_id", "account_id", *[
        col.alias(n) for n, col in delivery.balance_fields(c("balance"), c("stake"), credit).items()])


@plan
def payment_balances(m: Models) -> DataFrame:
    df = m["stg_payments"].filter("status = 'COMPLETED'").join(
        m["dim_balance"].select("account_id", "balance"), "account_id")
    return df.select("payment_id", "direction", "amount", "balance", delivery.balance_before_payment(
        c("balance"), c("direction"), c("amount")).alias("balance_before"))


@plan
def as_of_balances(m: Models) -> DataFrame:
    m.share("cash_flow")
    return delivery.as_of_balances(m["cash_flow"]).select("account_id", "ref", "kind", "ts", "amount", "balance")


@plan
def delivery_counts(m: Models) -> DataFrame:
    return delivery.delivery_counts(m["cdc_delivery_log"])


@plan
def in_flight_slips(m: Models) -> DataFrame:
    return delivery.in_flight(m["stg_bet_slips"], m["stg_bet_slip_events"])


@plan
def operations_kpis(m: Models) -> DataFrame:
    at = F.lit("2024-01-20 12:00:00").cast("timestamp")
    seen = m["cdc_payments"].select("account_id", c("requested_ts").alias("seen_at")).filter(c("seen_at") <= at)
    return delivery.operations_kpis(m["dim_account"], m["fct_lifecycle"],
                                    m["stg_payments"].filter(c("completed_ts") <= at), seen, at)


@plan
def latest_payments(m: Models) -> DataFrame:
    return delivery.latest(m["stg_payments"], "requested_ts", "payment_id").select(
        "payment_id", "account_id", "direction", "amount", "status", "requested_ts")


@plan
def odds_board(m: Models) -> DataFrame:
    return delivery.odds_board(m["platform_slips"], ["fixture_id"])


@plan
def receipts(m: Models) -> DataFrame:
    """Receipt numbers of the pending bets, after those already stored."""
    pending = m["slip_amounts"].filter("settled_at is not null").select(
        "jurisdiction", F.lit("bets").alias("record_type"), c("slip_id").alias("record_key"))
    stored = delivery.stored_sequences(m["cdc_delivery_log"])
    return delivery.assign_receipts(pending, stored).select(
        "jurisdiction", "record_type", "record_key", "seq", "receipt_id", "file_name")


@plan
def receipt_totals(m: Models) -> DataFrame:
    filed = m["cdc_legacy_capture"].withColumn("receipt_id", F.concat_ws(
        "-", "jurisdiction", F.date_format("report_date", "yyyyMMdd")))
    return delivery.receipt_totals(filed)


@plan
def envelope_batches(m: Models) -> DataFrame:
    """Envelope of every settled bet, with small envelopes so that several fill."""
    df = delivery.envelopes(m["cdc_settled_bets"].withColumn("report_date", F.trunc(F.to_date("settled_at"), "year")),
                            "bet_id", {"MT": 50, "NL": 12}, 30)
    return df.select("jurisdiction", "report_date", "bet_id", "batch_id")


@plan
def filed_per_market(m: Models) -> DataFrame:
    return delivery.filed_per_market(m["cdc_delivery_log"])


@plan
def log_append(m: Models) -> DataFrame:
    """Log rows this pass adds for completed payments: each key once."""
    new = m["fct_payments"].filter("status = 'COMPLETED'").select(
        F.lit("payments").alias("record_type"), c("payment_id").alias("record_key"), "jurisdiction",
        F.lit("NEW").alias("receipt_id"), c("completed_ts").alias("submitted_at"))
    return sinks.log_append(m["cdc_delivery_log"], new.unionByName(new))


@plan
def log_replace(m: Models) -> DataFrame:
    """The log after the bets of one market are filed again."""
    log = m["cdc_delivery_log"]
    again = log.filter("record_type = 'bets' and jurisdiction = 'MT'").withColumns(
        {"receipt_id": F.concat(F.lit("RE-"), c("receipt_id")), "submitted_at": c("submitted_at") + F.make_dt_interval(F.lit(1))})
    return sinks.log_replace(log, again)


@plan
def incremental_merge(m: Models) -> DataFrame:
    """Touched partitions of a file after some slips settle again with more payout, part of them a day later."""
    old = _new_pipe(m).withColumn("version", F.lit("2020-01-01").cast("timestamp"))
    later = F.when(F.substring("bet_id", -2, 2) == "13", F.date_add("report_date", 1)).otherwise(c("report_date"))
    new = old.filter(F.substring("bet_id", -1, 1) == "3").withColumns(
        {"payout": (c("payout") + 1).cast(scalars.MONEY), "version": F.lit("2021-01-01").cast("timestamp"),
         "report_date": later})
    return sinks.merge_incremental(old, new, ["jurisdiction", "bet_id"], ["jurisdiction", "report_date"],
                                   "version").drop("version")


@plan
def report_date_read(m: Models) -> DataFrame:
    """Ready rows of one market and date, in key order."""
    return _new_pipe(m).filter("jurisdiction = 'ES' and report_date = DATE '2023-05-10'").orderBy("bet_id")


# ---- scalar functions --------------------------------------------------------

@plan
def scalar_dates(m: Models) -> DataFrame:
    df = m["fct_lifecycle"].join(m["dim_account"].select("account_id", "jurisdiction", "date_of_birth"), "account_id")
    df = df.join(m["market"].select("jurisdiction", "timezone"), "jurisdiction")
    d = scalars.local_date(c("placed_at"), c("timezone"))
    return df.select("slip_id", d.alias("local_date"), scalars.local_datetime(c("placed_at"), c("timezone")).alias("local_ts"),
                     scalars.period_start(d, "weekly").alias("week_start"), scalars.period_start(d, "monthly").alias("month_start"),
                     scalars.add_minutes(c("placed_at"), F.lit(90)).alias("later"),
                     scalars.age_years(c("date_of_birth"), d).alias("age"),
                     F.datediff(d, c("date_of_birth")).alias("days_old"))


@plan
def scalar_text(m: Models) -> DataFrame:
    return m["dim_account"].select(
        "account_id", scalars.sha256_hex(c("national_id")).alias("sha256"), scalars.sha1_upper(c("account_id")).alias("sha1"),
        scalars.matches(c("national_id"), "^ID[0-9]*[02468]$").alias("even_id"),
        F.concat_ws("-", "jurisdiction", "account_id").alias("joined"), F.length("national_id").alias("len"),
        c("national_id").like("ID1%").alias("starts_1"))


@plan
def scalar_math(m: Models) -> DataFrame:
    rate = F.lit("0.0375").cast("decimal(9,4)")
    return m["fct_lifecycle"].select(
        "slip_id", scalars.money(c("stake") * rate).alias("rounded"), F.abs(c("stake") - c("payout")).alias("gap"),
        F.greatest("stake", "payout").alias("hi"), F.least("stake", "payout").alias("lo"),
        F.floor("stake").cast("bigint").alias("whole"), F.coalesce(F.nullif("payout", F.lit(0)), "stake").alias("paid"))


@plan
def document_codecs(m: Models) -> DataFrame:
    df = m["slip_amounts"].filter("placed_at is not null")
    k = scalars.CODECS
    return df.select(
        "slip_id", k["datetime"](c("placed_at")).alias("iso"), k["digits14"](c("placed_at")).alias("d14"),
        k["digits8"](c("placed_at")).alias("d8"), k["digits6"](c("placed_at")).alias("d6"),
        k["digits12-yy"](c("placed_at")).alias("d12"), k["digits14tz"](c("placed_at")).alias("d14tz"),
        k["money"](c("stake")).alias("money2"), k["money4"](c("odds")).alias("money4"),
        k["flag-positive"](F.coalesce("payout", core.zero())).alias("won"), k["sha1-upper"](c("account_id")).alias("sha1"),
        k["fr-canonique"](F.concat(c("selection"), F.lit("/x'y"))).alias("canonical"))


@plan
def deterministic_ids(m: Models) -> DataFrame:
    key = F.concat_ws("|", F.lit("bet"), "slip_id")
    return m["platform_slips"].select(
        "slip_id", scalars.uuid5("6ba7b811-9dad-11d1-80b4-00c04fd430c8", key).alias("uuid"))


@plan
def numeric_ids(m: Models) -> DataFrame:
    key = F.concat_ws("|", F.lit("bet"), "slip_id")
    return m["platform_slips"].select("slip_id", scalars.crc_id(key).alias("crc"), scalars.crc_id(key, 30000).alias("short"))


# ---- regulator documents -----------------------------------------------------

def _records(m: Models, kind: str, market: str | None = None, **size: int) -> DataFrame:
    """Pending deliveries of all markets as canonical records; ``size`` is that of a part of a long record. With ``market`` those of
    others may be left out where Spark can't see by itself that they are not needed."""
    accounts, balances, log = m["dim_account"], m["platform_wallet"], m["cdc_delivery_log"]
    if kind == "bets":
        pending = delivery.pending_bets(m["slip_amounts"], accounts, m["market"], log)
        return records.bets(pending.filter("route = 'DELIVER'"), m["dim_fixture"], accounts, balances)
    if kind == "payments":
        return records.payments(delivery.pending_payments(m["stg_payments"], accounts, m["market"], log), accounts, balances)
    if kind == "players":
        return records.players(delivery.pending_players(accounts, m["market"], log), accounts, balances)
    if kind == "gaming":
        pending = delivery.pending_gaming(m["cdc_play_rounds"], accounts, m["market"], m["licensed_games"], log)
        # rounds that travel inside sessions keep a record of their own as well
        return records.gaming(pending.filter("route <> 'SUPPRESSED-UNLICENSED'"), accounts, balances)
    if kind == "platform_sessions":
        return records.platform_sessions(
            delivery.pending_platform_sessions(m["stg_gaming_sessions"], accounts, m["market"], log))
    if kind == "game_sessions":
        filed = m["market"].filter("session_grain = 'per_game'").select("jurisdiction")
        if market:
            filed = filed.filter(c("jurisdiction") == market)
        players = accounts.join(F.broadcast(filed), "jurisdiction", "left_semi")
        lists = sessions.session_round_lists(m["cdc_play_rounds"], m["stg_gaming_sessions"], players=players, **size)
        return records.game_sessions(delivery.pending_game_sessions(lists, accounts, m["market"], log))
    return records.register_records(submissions.register_filings(m["filing_rows"], **size))


DOCUMENT_RECORDS = {"NL": {"sessions": "game_sessions"}, "PT": {"sessions": "platform_sessions"}}


def document_plan(market: str, record_type: str, **size: int) -> Plan:
    def run(m: Models) -> DataFrame:
        kind = DOCUMENT_RECORDS.get(market, {}).get(record_type, record_type)
        df = _records(m, kind, market, **size).filter(c("jurisdiction") == market)
        if kind in ("rud", "rut"):
            df = df.filter(c("register_id") == record_type.upper())
        if market == "GR":
            # the file number is the record's place in the market's receipt sequence
            wide = df.withColumn("record_type", F.lit(record_type))
            last = delivery.stored_sequences(m["cdc_delivery_log"])
            df = delivery.assign_receipts(wide, last)
        return documents.documents(df, market, record_type, document_formats.docs_for(market, record_type), now())
    return run


DOCUMENTS = [(k, t) for k, types in document_formats.FORMATS.items() for t in types]
DOCUMENTS += [("MT", "bets"), ("BG", "payments"), ("DE", "players"), ("MT", "gaming")]
for _market, _type in DOCUMENTS:
    PLANS[f"document_{_market.lower()}_{_type}"] = document_plan(_market, _type)
SPLIT_DOCUMENTS = {("NL", "sessions"): derive.SPLIT_ROUNDS, ("ES", "rud"): derive.SPLIT_PLAYERS,
                   ("ES", "rut"): derive.SPLIT_PLAYERS}
for (_market, _type), _rows in SPLIT_DOCUMENTS.items():
    PLANS[f"split_document_{_market.lower()}_{_type}"] = document_plan(_market, _type, part_rows=_rows)


def models(spark: SparkSession, sf_dir: str) -> Models:
    m = pipeline.build(spark, derive.sources(spark, sf_dir), derive.RUN_TS)
    # The rules are shown on files that nothing was withheld from.
    m._builders["open_file"] = lambda: submissions.betting_file(
        submissions.filed_status(m["reportable"]), m["dim_fixture"], m["stg_reg_attributes"],
        m["map_sport_regulator"], m["sport_policy"])
    m._builders["open_registers"] = lambda: submissions.periodic_register(m["reportable"])
    m._builders["platform_wallet"] = lambda: core.platform_balance(
        m["stg_payments"], m["fct_lifecycle"], m["cdc_play_rounds"])
    m._builders["filing_rows"] = lambda: submissions.register_rows(
        m["fct_lifecycle"], m["dim_account"], m["market"])
    return m


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, p=p: present(p(models(spark, sf_dir)))) for name, p in PLANS.items()}
