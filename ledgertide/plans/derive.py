"""Change feeds derived from the star-schema tables, so that every registered
query runs on data that grows with them.

customer -> accounts and player records; part -> fixtures; supplier -> games;
orders -> bet slips; lineitem -> game rounds; events -> payments; nation -> pools
and postcode regions. Dates move forward 25 years, which puts the data across
the dated rates, codes and stake bands. Keys are fixed width, so they sort.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..markets import MARKETS

RUN_TS = "2026-07-08 12:00:00"
# Part sizes at which these data fill several parts, so that split records are compared too.
SPLIT_ROUNDS, SPLIT_PLAYERS = 1, 2

SPORT_LABELS = {"ECONOMY": "Soccer", "SMALL": "  FÚTBOL ", "MEDIUM": "Lawn  Tennis",
                "PROMO": "Basketball", "STANDARD": "Horses", "LARGE": "Padel"}
TEAM_LABELS = ["Man Utd", "Chelsea F.C.", "R. Madrid", " Barça ", "R. Nadal", "N. Djokovic",
               "Local United", "REAL  Madrid", "FC Barcelona", "Rovers"]
GAME_LABELS = [["Video Slots", "Table Games - Blackjack", "Slots"], ["Live Roulette", "Punto Banco"],
               ["Roulette", "Blackjack", "slot"], ["Crash", "Slot"], ["Poker - Cash", "Poker Tournament"]]
PLAY_GAMES = ["SLOTS", "BLACKJACK", "POKER", "SLOTS", "operator-jackpots"]
PAY_METHODS = ["CARD", "BANK", "WALLET"]
SELECTIONS = ["HOME", "DRAW", "AWAY"]
STUDIOS = ["Spribe", "Hacksaw"]


def pick(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast(({index}) % {len(values)} as int) + 1)"


def key(prefix: str, number: str, width: int) -> str:
    return f"concat('{prefix}', lpad(cast({number} as string), {width}, '0'))"


def account(number: str) -> str:
    return key("A", number, 10)


def money(minor: str) -> str:
    return f"cast(cast({minor} as decimal(16,0)) * 0.01 as decimal(18,2))"


def days(n: str) -> str:
    return f"make_dt_interval(cast({n} as int))"


def minutes(n: str) -> str:
    return f"make_dt_interval(0, 0, cast({n} as int))"


def later(ts: str, n: str) -> str:
    """``n`` seconds after an instant, in plain integer arithmetic."""
    return f"timestamp_micros(unix_micros({ts}) + ({n}) * 1000000)"


def row(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in fields.items()) + ")"


def when(condition: str, value: str) -> str:
    return f"if({condition}, {value}, null)"


def spread(df: DataFrame, keep: list[str], *structs: str) -> DataFrame:
    """One output row per struct that is not NULL, next to the kept columns."""
    wide = df.selectExpr(*keep, f"explode(array({', '.join(structs)})) as _i").filter("_i is not null")
    return wide.selectExpr(*wide.columns[:-1], "_i.*")


def sources(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    @cache
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    @cache
    def customers() -> DataFrame:
        return table("customer").selectExpr(
            "c_custkey as k", f"{account('c_custkey')} as account_id", f"{pick(MARKETS, 'c_custkey')} as jurisdiction",
            "c_nationkey as nation", "c_acctbal as bal",
            f"timestamp'2019-06-01' + {minutes('c_custkey * 61 % 200000')} as opened_at")

    def accounts() -> DataFrame:
        def image(op: str, kyc: str, lag: int) -> str:
            return row(kyc_status=f"'{kyc}'", _op=f"'{op}'", _commit_ts=f"opened_at + {days(str(lag))}")
        return spread(customers(), [
            "account_id", "jurisdiction", "concat('ID', cast(k * 7919 % 99999989 as string)) as national_id",
            "date_add(date'1955-01-01', cast(k * 37 % 18993 as int)) as date_of_birth", "opened_at"],
            image("I", "PENDING", 0), when("k % 3 <> 0", image("U", "VERIFIED", 1)),
            when("k % 97 = 96", image("D", "PENDING", 2)))

    def fixtures() -> DataFrame:
        labels = " ".join(f"when '{a}' then '{b}'" for a, b in SPORT_LABELS.items())

        def image(op: str, start: str, lead: int) -> str:
            return row(start_ts=start, _op=f"'{op}'", _commit_ts=f"start - {days(str(lead))}")
        dated = table("part").selectExpr("*", f"timestamp'2020-01-01' + {days('p_partkey % 2000')} as start")
        return spread(dated, [
            f"{key('F', 'p_partkey', 10)} as fixture_id", f"case p_type {labels} end as sport_name_raw",
            "p_brand as competition_raw", f"{pick(TEAM_LABELS, 'p_partkey')} as home_raw",
            f"{pick(TEAM_LABELS, 'p_partkey div 10 + 1')} as away_raw"],
            image("I", "start", 9), when("p_partkey % 10 = 0", image("U", f"start + {minutes('90')}", 2)),
            when("p_partkey % 101 = 100", image("D", "start", 1)))

    @cache
    def orders() -> DataFrame:
        return (table("orders").selectExpr(
            "o_orderkey as k", "o_custkey as cust", f"{key('S', 'o_orderkey', 12)} as slip_id",
            f"{account('o_custkey')} as account_id", f"{key('F', 'o_orderkey div 10', 10)} as fixture_id",
            f"{later('cast(o_orderdate as timestamp) + make_ym_interval(25, 0)', 'o_orderkey * 7919 % 86400')} as placed_at",
            "cast(floor(o_totalprice / 100) as bigint) as stake_c",
            "cast(floor(o_totalprice / 100) as bigint) * (o_orderkey * 31 % 9) * 25 div 100 as payout_c",
            "o_orderstatus = 'F' or (o_orderstatus = 'P' and o_orderkey % 5 <> 1) as settles",
            "o_orderstatus = 'P' and o_orderkey % 5 < 2 as voids")
            .selectExpr("*", f"{later('placed_at', '(k % 72 + 1) * 3600')} as settled_ts")
            .selectExpr("*", f"if(k % 5 = 0, settled_ts + {days('1')}, placed_at + {minutes('120')}) as voided_ts"))

    def bet_slips() -> DataFrame:
        def image(op: str, late: int) -> str:
            return row(_op=f"'{op}'", _commit_ts=f"placed_at + {minutes(str(late))}")
        return spread(orders(), [
            "slip_id", "account_id", "fixture_id", "'SINGLE' as product", f"{pick(SELECTIONS, 'k')} as selection",
            f"{money('k % 400 + 120')} as odds"], image("I", 0), when("k % 13 = 0", image("U", 1)))

    def bet_slip_events() -> DataFrame:
        nil = money("0")

        def image(kind: str, ts: str, stake: str = nil, payout: str = nil, late: int = 0) -> str:
            return row(event_type=f"'{kind}'", event_ts=ts, stake=stake, payout=payout, _op="'I'",
                       _commit_ts=f"{ts} + {minutes(str(late))}")
        return spread(orders(), ["slip_id"], image("PLACED", "placed_at", stake=money("stake_c")),
                    when("settles", image("SETTLED", "settled_ts", payout=money("payout_c"))),
                    when("settles and k % 11 = 0",
                         image("SETTLED", "settled_ts", payout=money("payout_c + 100"), late=5)),
                    when("voids", image("VOIDED", "voided_ts")),
                    when("k % 17 = 0", image("CASHOUT_QUOTE", "placed_at")))

    def reg_attributes() -> DataFrame:
        def attr(market: str, name: str, value: str) -> str:
            return when(f"m = '{market}'", row(attr_name=f"'{name}'", good=f"concat({value}, bad)"))
        named = orders().filter("k % 29 <> 0").selectExpr(
            "k", "placed_at", "slip_id", f"{pick(MARKETS, 'cust')} as m",
            "upper(md5(cast(slip_id as binary))) as h", "if(k % 31 = 0, 'x', '') as bad")
        good = spread(named, ["k", "placed_at", "slip_id"], *[
            attr("DK", "safe_tampertoken", "'TT-', left(h, 8)"),
            attr("BG", "nra_registration_id", key("BG-2024-", "k % 1000000000", 9)),
            attr("NL", "cruks_check_ref", "'CRUKS-', left(h, 8)"),
            attr("NL", "cdb_record_id", key("NL-CDB-", "k", 10)),
            attr("DE", "lugas_activity_id", "'LUGAS-', left(h, 12)")])
        stale = row(attr_value="'stale'", _op="'I'", _commit_ts=f"placed_at - {minutes('1')}")
        return spread(good, ["'SLIP' as entity_type", "slip_id as entity_id", "attr_name"],
                      when("k % 17 = 0", stale), row(attr_value="good", _op="'U'", _commit_ts="placed_at"))

    @cache
    def lines() -> DataFrame:
        """One row per game play; the feed is chosen by supplier."""
        stake = "cast(floor(l_extendedprice / 200) as bigint)"
        return (table("lineitem").selectExpr(
            "l_orderkey as ok", "l_suppkey as sk", "l_partkey as pk", "l_suppkey % 5 as feed",
            "concat(lpad(cast(l_orderkey as string), 12, '0'), '-', cast(l_linenumber as string)) as round_ref",
            "l_partkey * 3 div 4 as cust", f"{account('l_partkey * 3 div 4')} as player_ref",
            "concat('R', cast(l_suppkey as string)) as game_ref", f"{key('G', 'l_suppkey', 8)} as game_id",
            f"{later('cast(l_shipdate as timestamp) + make_ym_interval(25, 0)', '(l_orderkey * 131 + l_linenumber * 977) % 86400')}"
            " as ts",
            f"{stake} as stake_c", f"{stake} * (l_orderkey * 17 % 8) * 20 div 100 as payout_c",
            "if(l_orderkey % 53 = 52, 'D', 'I') as _op")
            .selectExpr("*", "if(ok % 7 <> 0, concat('GS', lpad(cast(cust as string), 10, '0'), "
                             "date_format(ts, 'yyyyMMdd')), null) as session_ref", "ts as _commit_ts"))

    def netent_rounds() -> DataFrame:
        return lines().filter("feed = 0").selectExpr(
            "round_ref", "player_ref", "game_ref", f"{money('stake_c')} as bet_amount",
            f"{money('payout_c')} as win_amount",
            f"{money('(stake_c + 50) div 100 + if(ok % 41 = 0, 1, 0)')} as jp_contribution",
            "concat('JP', cast(sk % 7 as string)) as jp_id", "session_ref", "ts as round_ts", "_op", "_commit_ts")

    def evolution_transactions() -> DataFrame:
        pair = (row(tx_type="'BET'", amount_cents="stake_c") + ", " + row(tx_type="'WIN'", amount_cents="payout_c"))
        return (lines().filter("feed = 1").selectExpr("*", f"inline(array({pair}))")
                .selectExpr("concat(round_ref, '-', tx_type) as tx_id", "round_ref", "player_ref",
                            "game_ref as table_ref", "tx_type", "amount_cents", "ts as tx_ts", "_op", "_commit_ts"))

    def playtech_rounds() -> DataFrame:
        return lines().filter("feed = 2").selectExpr(
            "round_ref", "player_ref", "game_ref as game_code", f"{money('stake_c')} as stake",
            f"{money('payout_c')} as payout", "ts as round_ts", "_op", "_commit_ts")

    def aggregator_rounds() -> DataFrame:
        return lines().filter("feed = 3").selectExpr(
            "round_ref", f"{pick(STUDIOS, 'sk div 5')} as sub_provider", "player_ref", "game_ref",
            f"{money('stake_c')} as bet", f"{money('payout_c')} as win", "ts as round_ts", "_op", "_commit_ts")

    def poker_activity() -> DataFrame:
        kind = pick(["CASH_HAND", "TOURNAMENT_ENTRY"], "sk div 5")
        return lines().filter("feed = 4").selectExpr(
            "concat('PK', round_ref) as activity_id", "player_ref as account_id", "game_id",
            f"if(ok % 19 = 0, 'PLAY_MONEY', {kind}) as kind", f"{money('stake_c')} as amount_in",
            f"{money('payout_c')} as amount_out", f"{money('stake_c * 5 div 100')} as rake_or_fee",
            "session_ref as session_id", "ts as activity_ts", "_op", "_commit_ts")

    @cache
    def sessions() -> DataFrame:
        """One platform session per player and day with stamped play."""
        return (lines().filter("feed in (0, 4) and session_ref is not null")
                .groupBy(F.col("session_ref").alias("session_id"), F.col("player_ref").alias("account_id"), "cust")
                .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))

    def gaming_sessions() -> DataFrame:
        opened = row(ended_at="cast(null as timestamp)", end_reason="cast(null as string)", _op="'I'",
                     _commit_ts=f"first_ts - {minutes('1')}")
        ended = (f"case when cust % 10 = 0 then null when cust % 10 < 7 then last_ts + {minutes('5')} "
                 f"when cust % 10 < 9 then last_ts + {minutes('30')} else last_ts - {minutes('1')} end")
        reason = ("case when cust % 10 = 0 then null when cust % 10 < 7 then 'LOGOUT' "
                  "when cust % 10 < 9 then 'INACTIVITY' else 'KICKED' end")
        closed = row(ended_at=ended, end_reason=reason, _op="'U'", _commit_ts=f"last_ts + {minutes('45')}")
        return sessions().selectExpr(
            "session_id", "account_id", f"first_ts - {minutes('1')} as started_at", "last_ts as last_activity_ts",
            f"inline(array({opened}, {closed}))")

    def games() -> DataFrame:
        raw = " ".join(f"when {n} then {pick(v, 's_suppkey div 5')}" for n, v in enumerate(GAME_LABELS))
        real = table("supplier").selectExpr(
            f"{key('G', 's_suppkey', 8)} as game_id", "concat('Game ', cast(s_suppkey as string)) as game_name",
            "case s_suppkey % 5 when 0 then 'NetEnt' when 1 then 'Evolution' when 2 then 'Playtech' "
            f"when 3 then {pick(STUDIOS, 's_suppkey div 5')} else 'PokerNet' end as provider",
            "concat('R', cast(s_suppkey as string)) as provider_game_ref",
            f"case s_suppkey % 5 {raw} end as game_type_raw")
        n = "cast(n_nationkey as string)"
        phantom = table("nation").filter("n_nationkey < 3").selectExpr(
            f"concat('OJ', {n}) as game_id", f"concat('Jackpot ', {n}) as game_name", "'Operator' as provider",
            f"concat('OJ', {n}) as provider_game_ref", "'Operator Jackpot' as game_type_raw")
        return real.unionByName(phantom).selectExpr("*", "'I' as _op", "timestamp'2019-01-01' as _commit_ts")

    def jackpot_pools() -> DataFrame:
        return table("nation").filter("n_nationkey < 7").selectExpr(
            "concat('JP', cast(n_nationkey as string)) as jackpot_id", "n_name as jackpot_name",
            "'NetEnt' as provider", f"{money('(n_nationkey + 1) * 100000')} as seed_amount",
            "cast(0.01 as decimal(9,4)) as contribution_rate")

    def jackpot_wins() -> DataFrame:
        return orders().filter("k % 500 = 7").selectExpr(
            f"{key('JW', 'k', 12)} as win_id", "concat('JP', cast(k % 7 as string)) as jackpot_id", "account_id",
            f"{money('stake_c * 3')} as amount", "placed_at as win_ts")

    def operator_jackpot_pools() -> DataFrame:
        return table("nation").filter("n_nationkey < 3").selectExpr(
            "concat('OJP', cast(n_nationkey as string)) as jackpot_id", "n_name as jackpot_name",
            f"{money('50000')} as seed_amount")

    def jackpot_optins() -> DataFrame:
        start = f"timestamp'2021-01-01' + {days('k % 365')}"
        return customers().filter("k % 4 = 0").selectExpr(
            f"{key('OPT', 'k', 10)} as optin_id", "account_id", "'OJP0' as jackpot_id", f"{start} as opted_in_at",
            f"{when('k % 8 = 0', start + ' + ' + days('365'))} as opted_out_at", "'I' as _op",
            f"{start} as _commit_ts")

    def operator_jackpot_contributions() -> DataFrame:
        slips = orders().filter("k % 6 = 0").selectExpr(
            f"{key('OC', 'k', 12)} as contribution_id", "account_id",
            "concat('OJP', cast(k % 3 as string)) as jackpot_id", "concat('OJ', cast(k % 3 as string)) as game_id",
            "'SPORTS_BET' as trigger_type", "slip_id as trigger_ref", f"{money('stake_c div 20 + 1')} as amount",
            "cast(null as string) as session_id", "placed_at as contributed_at", "'I' as _op",
            "placed_at as _commit_ts")
        rounds = lines().filter("feed = 0 and ok % 9 = 0").selectExpr(
            "concat('OR', round_ref) as contribution_id", "player_ref as account_id",
            "concat('OJP', cast(ok % 3 as string)) as jackpot_id", "concat('OJ', cast(ok % 3 as string)) as game_id",
            "'GAMING_ROUND' as trigger_type", "concat('NE:', round_ref) as trigger_ref",
            f"{money('stake_c div 100 + 1')} as amount", "session_ref as session_id", "ts as contributed_at",
            "_op", "_commit_ts")
        return slips.unionByName(rounds)

    def operator_jackpot_wins() -> DataFrame:
        return orders().filter("k % 400 = 9").selectExpr(
            f"{key('OW', 'k', 12)} as win_id", "concat('OJP', cast(k % 3 as string)) as jackpot_id", "account_id",
            "concat('OJ', cast(k % 3 as string)) as game_id", f"{money('stake_c * 2')} as amount",
            "cast(null as string) as session_id", "placed_at as win_ts", "'I' as _op", "placed_at as _commit_ts")

    def game_round_voids() -> DataFrame:
        return lines().filter("feed = 0 and ok % 27 = 0").selectExpr(
            "concat('NE:', round_ref) as round_id", f"ts + {minutes('60')} as voided_at")

    def player_limits() -> DataFrame:
        def limit(condition: str, tag: str, kind: str, units: str) -> str:
            return when(condition, row(limit_id=key(f"L{tag}", "k", 10), limit_type=f"'{kind}'",
                                       amount=money(f"({units}) * 100")))
        listed = [
            limit("k % 7 = 0", "A", "DEPOSIT_DAILY", "k % 200 + 40"),
            limit("k % 14 = 0", "B", "DEPOSIT_DAILY", "k % 90 + 20"),
            limit("k % 11 = 0", "C", "DEPOSIT_WEEKLY", "k % 300 + 60"),
            limit("k % 6 = 0", "D", "DEPOSIT_MONTHLY", "k % 500 + 90"),
            limit("k % 13 = 0", "E", "LOSS_DAILY", "k % 50 + 1"),
            limit("k % 9 = 1", "F", "LOSS_WEEKLY", "k % 60 + 5"),
            limit("k % 10 = 3", "G", "LOSS_MONTHLY", "k % 70 + 10"),
            limit("k % 17 = 0", "H", "STAKE_CASINO", "k % 4 + 1")]
        return spread(customers(), [
            "account_id", "timestamp'2019-12-01' as set_at", "'I' as _op", "timestamp'2019-12-01' as _commit_ts",
            f"{when('k % 5 = 0', 'timestamp' + repr('2023-06-01'))} as revoked_at"], *listed)

    def self_exclusions() -> DataFrame:
        start = f"timestamp'2022-01-01' + {days('k % 700')}"
        return customers().filter("k % 13 = 5").selectExpr(
            f"{key('X', 'k', 10)} as exclusion_id", "account_id",
            "if(k % 3 = 0, 'NATIONAL', 'OPERATOR') as source", f"{start} as start_ts",
            f"{when('k % 2 = 1', start + ' + ' + days('90'))} as end_ts", "'I' as _op", f"{start} as _commit_ts")

    def verifications() -> DataFrame:
        def check(tag: str, kind: str, status: str, ts: str) -> str:
            return row(verification_id=key(f"V{tag}", "k", 10), check_type=f"'{kind}'", status=f"'{status}'",
                       event_ts=ts)
        listed = [
            check("P", "IDENTITY", "PENDING", "opened_at"),
            when("k % 9 <> 7", check("V", "IDENTITY", "VERIFIED", f"opened_at + {days('k % 1700 + 1')}")),
            when("k % 4 = 0", check("A", "ADDRESS", "VERIFIED", f"opened_at + {days('2')}"))]
        return spread(customers(), ["account_id"], *listed).selectExpr(
            "*", "'I' as _op", "event_ts as _commit_ts")

    def payments() -> DataFrame:
        first = customers().selectExpr(
            f"{key('PC', 'k', 12)} as payment_id", "account_id", "'DEPOSIT' as direction",
            f"{money('greatest(cast(floor(bal * 5) as bigint), 1000L)')} as amount",
            f"{pick(PAY_METHODS, 'k')} as method", "'COMPLETED' as status", "opened_at as requested_ts",
            f"opened_at + {minutes('3')} as completed_ts")
        later = table("events").selectExpr("*", "cast(ts as timestamp) as at").selectExpr(
            f"{key('PE', 'event_id', 12)} as payment_id", f"{account('user_id')} as account_id",
            "case when event_type = 'signup' then 'WITHDRAWAL' when event_id % 50 = 7 then 'TRANSFER' "
            "else 'DEPOSIT' end as direction",
            f"{money('cast(floor(value * 100) as bigint)')} as amount", f"{pick(PAY_METHODS, 'event_id')} as method",
            "case event_type when 'error' then 'BLOCKED' when 'view' then 'HELD' else 'COMPLETED' end as status",
            "at as requested_ts", f"if(event_type in ('error', 'view'), null, at + {minutes('2')}) as completed_ts")
        return first.unionByName(later).selectExpr("*", "'I' as _op", "requested_ts as _commit_ts")

    def account_addresses() -> DataFrame:
        def digits(n: int) -> str:
            return f"lpad(cast(k % {10 ** n} as string), {n}, '0')"
        return customers().selectExpr(
            "account_id", "'Town' as city",
            "case when k % 19 = 3 then concat('BAD', cast(k as string)) "
            f"when jurisdiction = 'MT' then concat(char(nation % 26 + 65), 'XT ', {digits(4)}) "
            f"when jurisdiction in ('DK', 'BG') then {digits(4)} "
            f"when jurisdiction = 'GR' then concat({digits(3)}, ' ', {digits(2)}) "
            f"when jurisdiction = 'NL' then concat({digits(4)}, ' AB') "
            f"when jurisdiction = 'PT' then concat({digits(4)}, '-', {digits(3)}) else {digits(5)} end as postcode",
            "'I' as _op", "opened_at as _commit_ts")

    def postcode_regions() -> DataFrame:
        return table("nation").filter("n_nationkey % 6 <> 5").selectExpr(
            "concat(char(n_nationkey % 26 + 65), 'XT') as postcode_prefix", "n_name as region_name")

    def source_watermarks() -> DataFrame:
        done = orders().selectExpr(f"cust % {len(MARKETS)} as m", "placed_at").groupBy("m").agg({"placed_at": "max"})
        return done.selectExpr(
            "explode(array('bet_settlement', 'payments')) as source", f"{pick(MARKETS, 'm')} as jurisdiction",
            f"`max(placed_at)` - {days('m * 40')} as complete_through")

    def exception_state() -> DataFrame:
        tries = "cast(k div 18 % 6 + 1 as int)"
        return customers().filter("k % 18 = 0 and k % 19 <> 3").selectExpr(
            "'ADDRESS' as entity_type", "account_id as entity_id", "'region_not_found' as reason_code",
            "'TRANSIENT' as error_class", f"{tries} as attempt_count",
            f"timestamp'{RUN_TS}' - {days(tries)} as first_seen",
            f"timestamp'{RUN_TS}' + {minutes('(k % 5 - 2) * 60')} as next_retry_at", "'RETRYING' as status")

    def provider_statements() -> DataFrame:
        return lines().filter("feed < 4").selectExpr(
            "case feed when 0 then 'NetEnt' when 1 then 'Evolution' when 2 then 'Playtech' "
            f"else {pick(STUDIOS, 'sk div 5')} end as provider", "to_date(ts) as statement_date",
            "stake_c - payout_c as net_c").groupBy("provider", "statement_date").agg({"net_c": "sum"}).filter(
            "dayofmonth(statement_date) <> 17").selectExpr(
            "provider", "statement_date", f"{money('`sum(net_c)`')} as reported_ggr")

    def play_rounds() -> DataFrame:
        """Rounds as the operator's own platform keeps them, with their funding."""
        return lines().selectExpr(
            "ok", "concat('R', round_ref, '-', cast(pk as string), '-', cast(sk as string)) as round_id",
            "player_ref as account_id", f"{pick(PLAY_GAMES, 'sk')} as game", f"{money('stake_c')} as stake",
            f"{money('payout_c')} as payout", "session_ref as session_id", "ts as round_ts").selectExpr(
            "round_id", "account_id", "game", "stake", "payout",
            "if(game in ('BLACKJACK', 'POKER') and ok % 10 = 3, 'GOLDEN_CHIP', 'CASH') as funding",
            "session_id", "round_ts")

    def delivery_log() -> DataFrame:
        """What earlier passes already delivered."""
        def log(df: DataFrame, kind: str, record: str, market: str, receipt: str, at: str) -> DataFrame:
            return df.selectExpr(f"'{kind}' as record_type", f"{record} as record_key",
                                 f"{market} as jurisdiction", f"{receipt} as receipt_id", f"{at} as submitted_at")
        own, none = pick(MARKETS, "cust"), "cast(null as string)"
        parts = [
            log(orders().filter("settles and not voids and k % 4 = 0"), "bets", "concat(slip_id, '|SETTLED')", own,
                key("BETS-", "k", 12), "settled_ts"),
            log(orders().filter("voids and k % 10 = 0"), "bets", "concat(slip_id, '|VOIDED')", own,
                "'SUPPRESSED-VOID'", "voided_ts"),
            log(table("events").filter("event_id % 5 = 0"), "payments", key("PE", "event_id", 12),
                pick(MARKETS, "user_id"), key("PAY-", "event_id", 12), f"cast(ts as timestamp) + {minutes('9')}"),
            log(customers().filter("k % 6 = 1"), "players", "concat(account_id, '|VERIFIED')", "jurisdiction",
                key("PLAY-", "k", 12), f"opened_at + {days('3')}"),
            log(lines().filter("ok % 3 = 0"), "gaming",
                "concat('R', round_ref, '-', cast(pk as string), '-', cast(sk as string))", none,
                "'VIA-SESSION'", "ts"),
            log(sessions().filter("cust % 4 = 1"), "sessions", "session_id", none, "'SESS-1'", "last_ts")]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def legacy_capture() -> DataFrame:
        """A legacy system's file: some rows missing, some extra, some amounts off."""
        stake = "stake_c + if(k % 37 = 0, 7, 0)"
        return orders().filter("settles and k % 43 <> 0").selectExpr(
            f"{pick(MARKETS, 'cust')} as jurisdiction", "slip_id as bet_id", "to_date(settled_ts) as report_date",
            f"{money(stake)} as stake", f"{money('payout_c')} as payout", f"{money(stake + ' - payout_c')} as ggr")

    def settled_bets() -> DataFrame:
        """Flat settled bets, as the starter scaffold expects them."""
        return orders().filter("settles and k % 47 <> 0").selectExpr(
            f"{pick(MARKETS, 'cust')} as jurisdiction", "slip_id as bet_id", "account_id as player_id",
            "concat('ID', cast(cust * 7919 % 99999989 as string)) as player_national_id",
            f"{pick(['single', 'combo', 'free_spin', 'single'], 'k')} as game_type",
            f"{pick(['sports', 'casino', 'poker', 'lottery'], 'k div 3')} as vertical",
            f"{money('stake_c')} as stake", f"{money('payout_c')} as payout", "settled_ts as settled_at")

    feeds = [
        accounts, fixtures, bet_slips, bet_slip_events, reg_attributes, games, netent_rounds,
        evolution_transactions, playtech_rounds, aggregator_rounds, poker_activity, gaming_sessions,
        jackpot_pools, jackpot_wins, operator_jackpot_pools, jackpot_optins,
        operator_jackpot_contributions, operator_jackpot_wins, game_round_voids, player_limits,
        self_exclusions, verifications, payments, account_addresses, postcode_regions,
        source_watermarks, exception_state, provider_statements, play_rounds, delivery_log,
        legacy_capture, settled_bets]
    return {feed.__name__: feed for feed in feeds}
