"""The models of one reporting run as a lazy mapping name -> DataFrame.

Nothing runs until a result is written or counted, and a model that nobody asks
for is never planned. ``landing`` gives the feeds by name: a folder of change
feeds (``sources.landing``) or feeds derived from other tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import markets
from ..operators import (cdc, core, exceptions, gaming, nomenclature, protection, recon, sessions,
                         submissions)
from ..scratch import recorded, release, staged
from ..session import configure
from ..sources import landing as landing_source


class Models(Mapping[str, DataFrame]):
    """Builds each model once, on first use. ``parts`` names the models of which another is the union."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]], parts: Mapping[str, Sequence[str]]):
        self._builders, self._built, self._shared, self._parts = builders, {}, {}, parts

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def share(self, *names: str) -> Models:
        """Writes models that several others read and builds on the written
        tables from then on: columnar, pruned on read, and not lost with an
        executor. The folder is the cluster's shared checkpoint folder. A union is
        written part by part, so the shuffles of one part are gone before the next."""
        for name in names:
            if name in self._shared:
                continue
            if name in self._parts:
                self.share(*self._parts[name])
                self._built[name], self._shared[name] = self._builders[name](), []
                continue
            with recorded() as folders:
                self._built[name] = staged(self[name], name)
            self._shared[name] = folders
        return self

    def release(self, *names: str) -> Models:
        """Deletes what ``share`` wrote of models that nothing reads any more. Whatever was built on the way is forgotten, so a model
        asked for later is built anew, from its sources if need be."""
        for name in [*names, *[part for name in names for part in self._parts.get(name, ())]]:
            found = self._shared.pop(name, None)
            if found:
                release(self._built[name].sparkSession, found)
        self._built = {name: df for name, df in self._built.items() if name in self._shared}
        return self

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def build(spark: SparkSession, feeds: Mapping[str, Callable[[], DataFrame]], run_ts: str) -> Models:
    """All models over ``feeds``; ``run_ts`` is the instant retries are judged at."""
    configure(spark)
    now = F.lit(run_ts).cast("timestamp")
    b: dict[str, Callable[[], DataFrame]] = {f"cdc_{n}": f for n, f in feeds.items()}
    m = Models(b, PARTS)

    b.update({
        "market": lambda: markets.market_frame(spark),
        "map_sport_regulator": lambda: markets.sport_code_frame(spark),
        "map_game_regulator": lambda: markets.game_code_frame(spark),
        "sport_policy": lambda: markets.sport_policy_frame(spark),
        "game_policy": lambda: markets.game_policy_frame(spark),
        "ref_stake_limits": lambda: markets.stake_band_frame(spark),
        "betting_rates": lambda: markets.betting_rate_frame(spark),
        "gaming_rates": lambda: markets.gaming_rate_frame(spark),
        "vertical_rates": lambda: markets.vertical_rate_frame(spark),
        "licensed_games": lambda: markets.license_frame(spark),
        "ref_sport_canonical": lambda: nomenclature.sport_canonical(spark),
        "ref_sport_aliases": lambda: nomenclature.sport_aliases(spark),
        "ref_participant_aliases": lambda: nomenclature.participant_aliases(spark),
        "ref_game_type_aliases": lambda: nomenclature.game_type_aliases(spark),
    })
    def plays(activity: DataFrame) -> DataFrame:
        return activity.select("account_id", "game_id", "vertical", "stake", "payout", "occurred_at")

    def union(name: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [m[part] for part in PARTS[name]])

    for feed in cdc.STAGING:
        b[f"stg_{feed}"] = lambda feed=feed: cdc.stage(feed, m[f"cdc_{feed}"])

    b.update({
        "dim_account": lambda: core.account_dimension(m["stg_accounts"]),
        "fct_lifecycle": lambda: core.lifecycle_from_feed(m["cdc_bet_slip_events"], m["stg_bet_slips"]),
        "dim_fixture": lambda: nomenclature.fixture_dimension(
            m["stg_fixtures"], m["ref_sport_aliases"], m["ref_participant_aliases"]),
        "dim_game": lambda: nomenclature.game_dimension(m["stg_games"], m["ref_game_type_aliases"]),
        "unmapped_sports": lambda: nomenclature.unmapped_sports(m["dim_fixture"], m["fct_lifecycle"]),
        "unmapped_game_types": lambda: nomenclature.unmapped_game_types(m["dim_game"], m["fct_activity"]),
        # gaming
        "stg_rounds": lambda: gaming.game_rounds({n: m[f"cdc_{n}"] for n in gaming.FEEDS}, m["stg_games"]),
        "fct_contributions": lambda: gaming.operator_contributions(
            m["stg_operator_jackpot_contributions"], m["fct_lifecycle"], m["cdc_game_round_voids"]),
        "fct_activity": lambda: gaming.gaming_activity(
            m["stg_rounds"], m["stg_poker_activity"], m["fct_contributions"], m["stg_operator_jackpot_wins"]),
        **{f"plays_{n}": lambda n=n: plays(gaming.casino_activity(
            gaming.normalise_feed(m[f"cdc_{n}"], gaming.FEEDS[n], m["stg_games"]))) for n in gaming.FEEDS},
        "plays_poker": lambda: plays(gaming.poker_activity(m["stg_poker_activity"])),
        "plays_pools": lambda: plays(gaming.pool_activity(m["fct_contributions"], m["stg_operator_jackpot_wins"])),
        "plays": lambda: union("plays"),
        "nameless_plays": lambda: m["plays"].withColumn("activity_id", F.lit(None).cast("string")),
        "pool_liability": lambda: gaming.pool_liability(
            m["cdc_jackpot_pools"], m["stg_rounds"], m["cdc_jackpot_wins"]),
        "operator_pool_liability": lambda: gaming.operator_pool_liability(
            m["cdc_operator_jackpot_pools"], m["fct_contributions"], m["stg_operator_jackpot_wins"]),
        # sessions
        "platform_sessions": lambda: sessions.platform_sessions(m["stg_gaming_sessions"], m["fct_activity"]),
        "session_activity": lambda: sessions.game_session_activity(m["fct_activity"]),
        "game_sessions": lambda: sessions.game_sessions(m["session_activity"]),
        "platform_session_file": lambda: sessions.platform_session_file(
            m["platform_sessions"], m["dim_account"], m["market"]),
        "game_session_file": lambda: sessions.game_session_file(
            m["game_sessions"], m["platform_sessions"], m["dim_account"], m["dim_game"], m["market"]),
        # players and money
        "fct_payments": lambda: core.payments_fact(m["stg_payments"], m["dim_account"]),
        "fct_gambling": lambda: core.gambling_activity(m["fct_lifecycle"], m["plays"], m["dim_account"]),
        "fct_ledger": lambda: core.wallet_ledger(
            m["fct_payments"], m["fct_lifecycle"], m["fct_activity"], m["cdc_jackpot_wins"]),
        "wallet_moves": lambda: core.wallet_moves(
            m["fct_payments"], m["fct_lifecycle"], m["plays"], m["cdc_jackpot_wins"]),
        "dim_balance": lambda: core.wallet_balance(m["fct_ledger"], m["dim_account"]),
        "dim_compliance": lambda: core.player_compliance(
            m["dim_account"], m["stg_verifications"], m["stg_self_exclusions"], m["stg_player_limits"]),
        "deposit_limits": lambda: protection.effective_deposit_limits(m["dim_compliance"], m["market"]),
        "breach_deposit_limits": lambda: protection.breach_deposit_limits(
            m["fct_payments"], m["deposit_limits"], m["market"]),
        "breach_loss_limits": lambda: protection.breach_loss_limits(
            m["fct_gambling"], m["stg_player_limits"], m["market"]),
        "breach_activity_while_excluded": lambda: protection.breach_activity_while_excluded(
            m["fct_payments"], m["fct_lifecycle"], m["fct_activity"], m["stg_self_exclusions"]),
        "breach_unverified_withdrawals": lambda: protection.breach_unverified_withdrawals(
            m["fct_payments"], m["stg_verifications"], m["market"]),
        "breach_wallet_overspend": lambda: protection.breach_wallet_overspend(m["fct_ledger"]),
        "overspent": lambda: protection.overspent_accounts(m["wallet_moves"]),
        "breach_stake_limits": lambda: protection.breach_stake_limits(
            m["fct_activity"], m["dim_account"], m["dim_game"], m["stg_player_limits"], m["market"]),
        # exceptions
        "addresses": lambda: exceptions.validate_addresses(
            m["stg_account_addresses"], m["dim_account"], m["cdc_postcode_regions"], m["market"]),
        "terminal_periods": lambda: exceptions.terminal_periods(m["fct_lifecycle"], m["dim_account"], m["market"]),
        "readiness": lambda: exceptions.period_readiness(
            m["terminal_periods"], m["cdc_source_watermarks"], m["market"]),
        "retry_state": lambda: exceptions.retry_step(m["addresses"], m["cdc_exception_state"], now),
        "held_deposit_limit": lambda: exceptions.compliance_hold("deposit_limit", m["breach_deposit_limits"]),
        "held_loss_limit": lambda: exceptions.compliance_hold("loss_limit", m["breach_loss_limits"]),
        "held_wallet_overspend": lambda: exceptions.compliance_hold("wallet_overspend", m["overspent"]),
        "held_activity_while_excluded": lambda: exceptions.compliance_hold(
            "activity_while_excluded", protection.breach_activity_while_excluded(
                m["fct_payments"], m["fct_lifecycle"], m["nameless_plays"], m["stg_self_exclusions"])),
        "held_unverified_withdrawal": lambda: exceptions.compliance_hold(
            "unverified_withdrawal", m["breach_unverified_withdrawals"]),
        "held_stake_limit": lambda: exceptions.compliance_hold("stake_limit", protection.breach_stake_limits(
            m["nameless_plays"], m["dim_account"], m["dim_game"], m["stg_player_limits"], m["market"])),
        "holds": lambda: union("holds"),
        "fct_exceptions": lambda: exceptions.exception_store(
            m["addresses"], m["retry_state"], m["terminal_periods"], m["readiness"], m["holds"]),
        "blocked": lambda: exceptions.blocked_accounts(m["fct_exceptions"]),
        # files
        "reportable": lambda: submissions.reportable(m["fct_lifecycle"], m["dim_account"], m["market"]),
        "admissible": lambda: submissions.admissible(m["reportable"], m["blocked"], m["readiness"]),
        "betting_file": lambda: submissions.betting_file(
            submissions.filed_status(m["admissible"]), m["dim_fixture"], m["stg_reg_attributes"],
            m["map_sport_regulator"], m["sport_policy"]),
        "filed": lambda: m["betting_file"].select("slip_id", "report_date"),
        "betting_tax": lambda: submissions.betting_tax(m["admissible"], m["betting_rates"]),
        "registers": lambda: submissions.periodic_register(m["admissible"]),
        "gaming_reportable": lambda: submissions.gaming_reportable(
            m["fct_activity"], m["dim_account"], m["market"]),
        "gaming_file": lambda: submissions.gaming_file(
            m["gaming_reportable"], m["dim_game"], m["map_game_regulator"], m["game_policy"]),
        "gaming_tax": lambda: submissions.gaming_tax(m["gaming_reportable"], m["gaming_rates"]),
        # money reconciliation
        "platform_slips": lambda: cdc.latest_image(m["cdc_bet_slips"], ["slip_id"]).drop("_op", "_commit_ts"),
        "slip_amounts": lambda: recon.slip_amounts(
            core.slip_images(m["cdc_bet_slip_events"]), m["platform_slips"], m["dim_account"]),
        "market_rounds": lambda: m["cdc_play_rounds"].join(
            m["dim_account"].select("account_id", "jurisdiction"), "account_id"),
        "market_sessions": lambda: m["stg_gaming_sessions"].join(
            m["dim_account"].select("account_id", "jurisdiction"), "account_id"),
        "cash_flow": lambda: recon.cash_flow(m["fct_payments"], m["slip_amounts"], m["market_rounds"]),
        "daily_flows": lambda: recon.daily_flows(m["fct_payments"], m["slip_amounts"], m["market_rounds"]),
        "daily_recon": lambda: recon.daily_reconciliation(m["daily_flows"], m["market"], m["betting_rates"]),
    })
    return m


def from_landing(spark: SparkSession, root: str, run_ts: str) -> Models:
    feeds = {n: (lambda n=n: landing_source.scan(spark, root, n)) for n in landing_source.SCHEMAS}
    return build(spark, feeds, run_ts)


# Unions, and the models that they are written from.
PARTS = {"plays": [*[f"plays_{feed}" for feed in gaming.FEEDS], "plays_poker", "plays_pools"],
         "holds": ["held_deposit_limit", "held_loss_limit", "held_wallet_overspend", "held_activity_while_excluded",
                   "held_unverified_withdrawal", "held_stake_limit"]}

# Models that several outputs of one run read, in the order to share them.
# The files and registers read plays for the holds alone, which need neither their keys nor sessions and pools.
FACTS = ["dim_account", "fct_lifecycle", "plays"]
# What the holds read besides. The ledger without references is the union of written models and read once: it isn't written again.
MONEY = ["fct_payments"]
# What nothing but the holds reads.
FOR_HOLDS = ["plays", "fct_payments"]
GATES = ["readiness", "fct_exceptions"]


def withheld(m: Models) -> Models:
    """Writes the facts and the holds, and deletes what only the holds read."""
    return m.share(*FACTS, *MONEY, "holds").release(*FOR_HOLDS)
