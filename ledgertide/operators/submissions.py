"""Files, tax summaries and registers: one plan for all markets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import markets
from ..functions.scalars import (local_date, local_datetime, local_day_bounds, money, period_start,
                                 render_event_name, sha256_hex)
from .core import zero
from .exceptions import on_days
from .gaming import gaming_revenue
from .nomenclature import dated_code, dated_rate, with_bucket

c = F.col


def reportable(lifecycle: DataFrame, accounts: DataFrame, market: DataFrame) -> DataFrame:
    """Terminal slips with their player, market settings and local report date."""
    done = lifecycle.filter("slip_status in ('SETTLED', 'VOIDED')")
    people = accounts.select("account_id", "jurisdiction", "national_id")
    df = done.join(people, "account_id").join(market, "jurisdiction")
    return df.withColumn("report_date", local_date(F.coalesce("settled_at", "voided_at"), c("timezone")))


def filed_status(df: DataFrame) -> DataFrame:
    """Settled slips everywhere, voided ones where the market files voids."""
    return df.filter((c("slip_status") == "SETTLED")
                     | (c("include_voided") & (c("slip_status") == "VOIDED")))


def admissible(df: DataFrame, blocked: DataFrame, readiness: DataFrame) -> DataFrame:
    """Without blocked accounts and periods that are not closed. An explicit anti
    join: a NULL id in the store cannot empty the file. Periods are looked up in the calendar, so slips do not move for them."""
    ids = blocked.filter(c("account_id").isNotNull()).select("account_id").distinct()
    ready = readiness.filter("is_ready").select("jurisdiction", "report_date")
    return on_days(df.join(ids, "account_id", "left_anti"), ready)


def carried_attributes(attributes: DataFrame, names: list[str], entity: str = "SLIP",
                       key: str = "slip_id") -> DataFrame:
    """The attribute carrier as one row per entity, one column per attribute."""
    return (attributes.filter((c("entity_type") == entity) & c("attr_name").isin(names))
            .groupBy(c("entity_id").alias(key))
            .agg(*[F.max(F.when(c("attr_name") == n, c("attr_value"))).alias(n) for n in names]))


def progressive(amount: Column, brackets: list[tuple]) -> Column:
    """Each bracket's rate on the slice of the amount inside it."""
    total = zero()
    for lower, upper, rate in brackets:
        top = amount if upper is None else F.least(amount, F.lit(upper).cast("decimal(18,2)"))
        part = F.greatest(top - F.lit(lower).cast("decimal(18,2)"), zero())
        total = total + part * F.lit(rate).cast("decimal(9,4)")
    return money(total)


def withholding(amount: Column, jurisdiction: Column) -> Column:
    tax = F.lit(None).cast("decimal(18,2)")
    for market in sorted({row[0] for row in markets.WITHHOLDING}):
        brackets = [row[1:] for row in markets.WITHHOLDING if row[0] == market]
        tax = F.when(jurisdiction == market, progressive(amount, brackets)).otherwise(tax)
    return tax


def betting_fields() -> dict[str, Column]:
    """Every column a betting file may carry."""
    zone, hashed = c("timezone"), sha256_hex(c("national_id"))
    return {
        "slip_id": c("slip_id"), "account_id": c("account_id"), "slip_status": c("slip_status"),
        "player_dni_hash": hashed, "stake": money(c("stake")), "payout": money(c("payout")),
        "ggr": money(c("stake") - c("payout")),
        "placed_at_local": local_datetime(c("placed_at"), zone),
        "settled_at_local": local_datetime(c("settled_at"), zone),
        "sport_code": with_bucket(c("regulator_code"), c("default_sport_code")),
        "event_name": render_event_name(c("event_template"), c("home_name"), c("away_name")),
        **{name: hashed for name in markets.HASH_NAMES},
        "winnings_withholding_tax": withholding(c("payout"), c("jurisdiction")),
        **{name: c(name) for name in markets.CARRIED},
    }


def betting_file(slips: DataFrame, fixtures: DataFrame, attributes: DataFrame, sport_codes: DataFrame,
                 sport_policy: DataFrame) -> DataFrame:
    """Filed slips of all markets with every column any market declares.
    ``slips`` is the admissible output of :func:`filed_status`."""
    names = fixtures.select("fixture_id", "canonical_sport", "home_name", "away_name")
    df = slips.join(names, "fixture_id", "left")
    df = dated_code(df, sport_codes, "canonical_sport", "report_date")
    df = df.join(sport_policy, "jurisdiction")
    df = df.join(carried_attributes(attributes, markets.CARRIED), "slip_id", "left")
    return df.select("jurisdiction", "report_date",
                     *[col.alias(name) for name, col in betting_fields().items()])


def market_file(df: DataFrame, market: str) -> DataFrame:
    """One market's file: its rows and exactly its declared columns."""
    declared = [*markets.BETTING_FILES[market], *markets.EXTENSIONS.get(market, [])]
    return df.filter(c("jurisdiction") == market).select("jurisdiction", "report_date", *declared)


def tax_base(basis: Column, stakes: Column, revenue: Column) -> Column:
    return F.when(basis == "turnover", stakes).otherwise(revenue)


def betting_tax(slips: DataFrame, rates: DataFrame) -> DataFrame:
    """Duty per market and local report date at that date's rate, settled slips only."""
    totals = (slips.filter("slip_status = 'SETTLED'")
              .groupBy("jurisdiction", "report_date", "tax_basis")
              .agg(F.count("*").alias("settled_slips"), F.sum("stake").alias("_stake"),
                   F.sum("payout").alias("_payout")))
    base = tax_base(c("tax_basis"), c("_stake"), c("_stake") - c("_payout")).cast("decimal(24,2)")
    return dated_rate(totals, rates, "report_date").select(
        "jurisdiction", "report_date", "settled_slips", money(c("_stake")).alias("total_stake"),
        money(c("_payout")).alias("total_payout"), money(base * c("rate")).alias("tax_due"))


def vertical_tax(bets: DataFrame, rates: DataFrame) -> DataFrame:
    """Turnover tax whose rate depends on the vertical; an unknown one pays nothing.
    Stakes add up per vertical before the rates join."""
    stakes = bets.groupBy("jurisdiction", "vertical").agg(F.sum("stake").alias("_stake"))
    listed = rates.select("jurisdiction").distinct()
    taxed = stakes.join(F.broadcast(listed), "jurisdiction", "left_semi").join(
        rates, ["jurisdiction", "vertical"], "left")
    due = c("_stake").cast("decimal(24,2)") * F.coalesce("rate", F.lit(0).cast("decimal(9,4)"))
    return taxed.groupBy("jurisdiction").agg(money(F.sum("_stake")).alias("total_stake"),
                                             money(F.sum(due)).alias("tax_due"))


def gaming_reportable(activity: DataFrame, accounts: DataFrame, market: DataFrame) -> DataFrame:
    """Plays of the markets that report gaming. No admissibility filter: gaming
    files list every play."""
    filed = [m for m in markets.GAMING_FILES]
    people = accounts.select("account_id", "jurisdiction", "national_id")
    df = activity.join(people, "account_id").join(market.filter(c("jurisdiction").isin(filed)), "jurisdiction")
    return df.withColumn("report_date", local_date(c("occurred_at"), c("timezone")))


def gaming_fields() -> dict[str, Column]:
    return {
        "activity_id": c("activity_id"), "account_id": c("account_id"),
        "player_dni_hash": sha256_hex(c("national_id")), "game_name": c("game_name"),
        "vertical": c("vertical"), "stake": money(c("stake")), "payout": money(c("payout")),
        "rake_or_fee": money(c("rake_or_fee")),
        "occurred_at_local": local_datetime(c("occurred_at"), c("timezone")),
        "game_code": with_bucket(c("regulator_code"), c("default_game_code")),
        "gaming_ggr": money(gaming_revenue(c("deduct_contributions"))),
    }


def gaming_file(plays: DataFrame, games: DataFrame, game_codes: DataFrame, game_policy: DataFrame) -> DataFrame:
    df = plays.join(games.select("game_id", "game_name", "canonical_game_type"), "game_id", "left")
    df = dated_code(df, game_codes, "canonical_game_type", "report_date")
    df = df.join(game_policy, "jurisdiction")
    return df.select("jurisdiction", "report_date",
                     *[col.alias(name) for name, col in gaming_fields().items()])


def gaming_tax(plays: DataFrame, rates: DataFrame) -> DataFrame:
    revenue = gaming_revenue(c("deduct_contributions"))
    totals = plays.groupBy("jurisdiction", "report_date").agg(
        F.count("*").alias("activities"), F.sum("stake").alias("_stake"),
        F.sum("payout").alias("_payout"), F.sum(revenue).alias("_ggr"))
    return dated_rate(totals, rates, "report_date").select(
        "jurisdiction", "report_date", "activities", money(c("_stake")).alias("total_stake"),
        money(c("_payout")).alias("total_payout"), money(c("_ggr")).alias("total_ggr"),
        money(c("_ggr").cast("decimal(24,2)") * c("rate")).alias("gaming_tax_due"))


def settled_on(df: DataFrame, day: str, zone: str, ts: str = "settled_at") -> DataFrame:
    """Rows settled on one local day, as a range filter on the stored instant."""
    start, end = local_day_bounds(F.lit(day).cast("date"), zone)
    return df.filter((c(ts) >= start) & (c(ts) < end))


def plain_submission(bets: DataFrame, market: DataFrame) -> DataFrame:
    """Settled bets without the game types a market leaves out."""
    excluded = F.lit(False)
    for code, kinds in markets.EXCLUDED_GAME_TYPES.items():
        excluded = excluded | ((c("jurisdiction") == code) & c("game_type").isin(kinds))
    df = bets.filter(~excluded).join(market.select("jurisdiction", "timezone"), "jurisdiction")
    return df.select(
        "jurisdiction", local_date(c("settled_at"), c("timezone")).alias("report_date"), "bet_id",
        "player_id", sha256_hex(c("player_national_id")).alias("player_dni_hash"), "game_type",
        money(c("stake")).alias("stake"), money(c("payout")).alias("payout"),
        money(c("stake") - c("payout")).alias("ggr"), "settled_at")


def periodic_register(slips: DataFrame, registers: list[tuple] = markets.REGISTERS) -> DataFrame:
    """Settled totals per player and period. Days add up first; a month is a sum
    of its days, so both registers read the slips once."""
    listed = sorted({r[0] for r in registers})
    daily = (slips.filter("slip_status = 'SETTLED'").filter(c("jurisdiction").isin(listed))
             .groupBy("jurisdiction", "report_date", "national_id")
             .agg(F.count("*").alias("_n"), F.sum("stake").alias("_s"), F.sum("payout").alias("_p")))
    entries = F.array(*[
        F.when(c("jurisdiction") == m, F.struct(F.lit(rid).alias("register_id"),
                                                period_start(c("report_date"), cadence).alias("period_start")))
        for m, rid, cadence in registers])
    return (daily.select("*", F.explode(entries).alias("r")).filter(c("r").isNotNull())
            .groupBy("jurisdiction", "r.register_id", "r.period_start", "national_id")
            .agg(F.sum("_n").alias("bets_settled"), F.sum("_s").alias("_stake"), F.sum("_p").alias("_won"))
            .select("jurisdiction", "register_id", "period_start",
                    sha256_hex(c("national_id")).alias("player_ref"), "bets_settled",
                    money(c("_stake")).alias("stake_sum"), money(c("_won")).alias("winnings_sum"),
                    money(c("_stake") - c("_won")).alias("ggr_sum")))


MEASURES = ["bets_settled", "stake_sum", "winnings_sum", "ggr_sum"]


def register_completeness(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """Player months whose monthly row and summed daily rows disagree."""
    key = ["jurisdiction", "player_ref", "period_start"]
    rolled = daily.groupBy("jurisdiction", "player_ref", F.trunc("period_start", "month").alias("period_start")).agg(
        *[F.sum(m).alias(f"_{m}") for m in MEASURES])
    joined = monthly.select(*key, *MEASURES).join(rolled, key, "full_outer")
    off = c(MEASURES[0]).isNull() | c("_" + MEASURES[0]).isNull()
    for m in MEASURES:
        off = off | (F.abs(c(m) - c("_" + m)) > F.lit(markets.TOLERANCE))
    return joined.filter(off).select("jurisdiction", c("player_ref").alias("row_key"), "period_start")


def register_window(cadence: str, day: Column) -> tuple[Column, Column]:
    """UTC bounds [start, end) of the register period that holds ``day``."""
    start = period_start(day, cadence)
    end = F.add_months(start, 1) if cadence == "monthly" else F.date_add(start, 1)
    return start.cast("timestamp"), end.cast("timestamp")


def register_rows(lifecycle: DataFrame, accounts: DataFrame, market: DataFrame,
                  registers: list[tuple] = markets.REGISTERS) -> DataFrame:
    """Register rows as filed on demand: UTC periods, voided slips left out."""
    people = accounts.select("account_id", "jurisdiction", "national_id", "opened_at")
    df = (lifecycle.filter("slip_status = 'SETTLED'").join(people, "account_id")
          .join(market.select("jurisdiction", "hashed_ref"), "jurisdiction")
          .withColumn("_day", F.to_date("settled_at")))
    entries = F.array(*[
        F.when(c("jurisdiction") == m, F.struct(
            F.lit(rid).alias("register_id"), register_window(cadence, c("_day"))[0].alias("period_start"),
            register_window(cadence, c("_day"))[1].alias("period_end")))
        for m, rid, cadence in registers])
    group = ["jurisdiction", "r.register_id", "r.period_start", "r.period_end", "account_id",
             "national_id", "opened_at", "hashed_ref"]
    return (df.filter(c("jurisdiction").isin(sorted({r[0] for r in registers})))
            .select("*", F.explode(entries).alias("r")).filter(c("r").isNotNull())
            .groupBy(*group)
            .agg(F.count("*").alias("bets_settled"), F.sum("stake").alias("stake_sum"),
                 F.sum("payout").alias("winnings_sum"), F.sum(c("stake") - c("payout")).alias("ggr_sum"))
            .withColumn("player_ref", player_reference(c("hashed_ref"), c("national_id"), c("account_id")))
            .drop("hashed_ref", "national_id"))


def player_reference(hashed: Column, national_id: Column, account_id: Column) -> Column:
    """SHA-256 of the national id (of the account id where there is none), or the
    account id in markets that file clear ids."""
    return F.when(hashed, F.sha2(F.coalesce(F.nullif(national_id, F.lit("")), account_id), 256)) \
        .otherwise(account_id)


def register_filings(rows: DataFrame, part_rows: int = markets.DEFAULT_ENVELOPE_ROWS) -> DataFrame:
    """All players of one register period as filing records of bounded size. Each of the
    ``parts`` has a key of its own and the number of ``players`` of the whole period."""
    from .ordered import ordered_lists, part_mark, parts_of
    key = ["jurisdiction", "register_id", "period_start", "period_end"]
    item = F.struct("player_ref", "opened_at", "bets_settled", "stake_sum", "winnings_sum", "ggr_sum")
    packed = rows.withColumn("_row", item)
    lists = ordered_lists(packed.select(*key, "account_id", "_row"), key, ["account_id"], c("_row"), "rows", part_rows,
                          [F.count("*").alias("players")])
    whole = lists.withColumn("parts", parts_of(c("players"), part_rows))
    day = F.date_format("period_start", "yyyy-MM-dd")
    return whole.withColumn("record_key", F.concat(F.concat_ws("-", "register_id", day), part_mark(c("part"))))


def daily_financial_summary(activity: DataFrame, accounts: DataFrame, games: DataFrame,
                            market: DataFrame) -> DataFrame:
    """Per market, local day and game type: stakes, winnings, commissions, refunds."""
    df = activity.join(accounts.select("account_id", "jurisdiction"), "account_id").join(
        market.select("jurisdiction", "timezone"), "jurisdiction")
    df = df.join(games.select("game_id", "canonical_game_type"), "game_id", "left")
    return (df.groupBy("jurisdiction", local_date(c("occurred_at"), c("timezone")).alias("report_date"),
                       F.coalesce("canonical_game_type", F.lit("UNMAPPED")).alias("game_type"))
            .agg(money(F.sum("stake")).alias("total_stakes"), money(F.sum("payout")).alias("total_winnings"),
                 money(F.sum("rake_or_fee")).alias("total_commissions"),
                 zero().alias("total_refunds")))
