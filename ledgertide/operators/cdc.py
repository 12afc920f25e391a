"""Latest image per key of an append-only change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Feed: key, columns kept, pre-filter (column, values), deletes honoured
STAGING = {
    "accounts": (["account_id"], ["account_id", "jurisdiction", "national_id", "date_of_birth",
                                  "kyc_status", "opened_at"], None, True),
    "bet_slips": (["slip_id"], ["slip_id", "account_id", "fixture_id", "product"], None, True),
    "bet_slip_events": (["slip_id", "event_type"],
                        ["slip_id", "event_type", "event_ts", "stake", "payout"],
                        ("event_type", ["PLACED", "SETTLED", "VOIDED"]), False),
    "fixtures": (["fixture_id"], ["fixture_id", "sport_name_raw", "competition_raw", "home_raw",
                                  "away_raw", "start_ts"], None, True),
    "reg_attributes": (["entity_type", "entity_id", "attr_name"],
                       ["entity_type", "entity_id", "attr_name", "attr_value"], None, True),
    "games": (["game_id"], ["game_id", "game_name", "provider", "provider_game_ref",
                            "game_type_raw"], None, True),
    "poker_activity": (["activity_id"],
                       ["activity_id", "account_id", "game_id", "kind", "amount_in", "amount_out",
                        "rake_or_fee", "session_id", "activity_ts"],
                       ("kind", ["CASH_HAND", "TOURNAMENT_ENTRY"]), True),
    "operator_jackpot_contributions": (
        ["contribution_id"],
        ["contribution_id", "account_id", "jackpot_id", "game_id", "trigger_type", "trigger_ref",
         "amount", "session_id", "contributed_at"], None, True),
    "operator_jackpot_wins": (["win_id"], ["win_id", "jackpot_id", "account_id", "game_id", "amount",
                                           "session_id", "win_ts"], None, True),
    "gaming_sessions": (["session_id"], ["session_id", "account_id", "started_at",
                                         "last_activity_ts", "ended_at", "end_reason"], None, True),
    "player_limits": (["limit_id"], ["limit_id", "account_id", "limit_type", "amount", "set_at",
                                     "revoked_at"], None, True),
    "self_exclusions": (["exclusion_id"], ["exclusion_id", "account_id", "source", "start_ts",
                                           "end_ts"], None, True),
    "verifications": (["verification_id"], ["verification_id", "account_id", "check_type", "status",
                                            "event_ts"], None, True),
    "payments": (["payment_id"], ["payment_id", "account_id", "direction", "amount", "method",
                                  "status", "requested_ts", "completed_ts"],
                 ("direction", ["DEPOSIT", "WITHDRAWAL"]), True),
    "account_addresses": (["account_id"], ["account_id", "postcode", "city"], None, True),
    "jackpot_optins": (["optin_id"], ["optin_id", "account_id", "jackpot_id", "opted_in_at",
                                      "opted_out_at"], None, True),
}


def latest_image(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = (),
                 drop_deletes: bool = True) -> DataFrame:
    """The newest image of each key; a final delete removes the key.

    ``row_number() = 1`` lets Spark cut every key to one row per map task before
    the shuffle (WindowGroupLimit), so replays of a hot key stay cheap. Columns in
    ``order`` break ties on the commit instant, highest first.
    """
    ranking = [F.desc("_commit_ts"), *[F.desc(c) if isinstance(c, str) else c for c in order]]
    newest = Window.partitionBy(*keys).orderBy(*ranking)
    ranked = df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1)
    kept = ranked.filter(F.col("_op") != "D") if drop_deletes else ranked
    return kept.drop("_rank")


def stage(feed: str, landing: DataFrame) -> DataFrame:
    """One staging table by its name in ``STAGING``."""
    keys, columns, prefilter, deletes = STAGING[feed]
    rows = landing if prefilter is None else landing.filter(F.col(prefilter[0]).isin(prefilter[1]))
    ties = [c for c in columns if c not in keys and c in landing.columns]
    return latest_image(rows, keys, ties, deletes).select(*columns)
