"""Platform sessions, derived per-game sessions and inactivity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import local_date, local_datetime, money
from .core import zero
from .ordered import gap_sessions, ordered_lists, parts_of


def platform_sessions(sessions: DataFrame, activity: DataFrame) -> DataFrame:
    """Each stored session with what was played in it."""
    played = activity.filter("session_id is not null").groupBy("session_id").agg(
        F.count("*").alias("plays"), F.sum("stake").alias("staked"), F.sum("payout").alias("won"),
        F.min("occurred_at").alias("first_play_ts"), F.max("occurred_at").alias("last_play_ts"))
    return sessions.join(played, "session_id", "left").select(
        "session_id", "account_id", "started_at", "last_activity_ts", "ended_at", "end_reason",
        F.coalesce("plays", F.lit(0)).alias("plays"), F.coalesce("staked", zero()).alias("staked"),
        F.coalesce("won", zero()).alias("won"), "first_play_ts", "last_play_ts")


def game_session_activity(activity: DataFrame) -> DataFrame:
    return activity.filter("session_id is not null").select(
        "activity_id", "account_id", "session_id",
        F.concat_ws(":", "session_id", "game_id").alias("game_session_id"), "game_id", "stake",
        "payout", "occurred_at")


def game_sessions(stamped: DataFrame) -> DataFrame:
    """Grouped by the derived key alone, so a play stamped into the wrong session
    collides and the single-game rule can see it."""
    return stamped.groupBy("game_session_id").agg(
        F.min("session_id").alias("session_id"), F.min("account_id").alias("account_id"),
        F.min("game_id").alias("game_id"), F.min("occurred_at").alias("started_at"),
        F.max("occurred_at").alias("ended_at"), F.count("*").alias("rounds"),
        F.count(F.when(F.col("payout") > 0, 1)).alias("rounds_won"),
        F.sum("stake").alias("staked"), F.sum("payout").alias("won"))


def _filed(platform: DataFrame) -> DataFrame:
    return platform.filter(F.col("ended_at").isNotNull()
                           & (F.col("file_empty_sessions") | (F.col("plays") > 0)))


def platform_session_file(platform: DataFrame, accounts: DataFrame, market: DataFrame) -> DataFrame:
    zone = F.col("timezone")
    df = platform.join(accounts.select("account_id", "jurisdiction"), "account_id")
    df = df.join(market.filter("session_grain = 'platform'"), "jurisdiction")
    return _filed(df).select(
        "jurisdiction", local_date(F.col("ended_at"), zone).alias("report_date"), "session_id",
        "account_id", local_datetime(F.col("started_at"), zone).alias("started_at_local"),
        local_datetime(F.col("ended_at"), zone).alias("ended_at_local"), "end_reason", "plays",
        money(F.col("staked")).alias("staked"), money(F.col("won")).alias("won"))


def game_session_file(derived: DataFrame, platform: DataFrame, accounts: DataFrame, games: DataFrame,
                      market: DataFrame) -> DataFrame:
    """Per-game sessions whose platform session has ended; how it ended is a fact
    of the platform session."""
    parent = platform.select("session_id", F.col("ended_at").alias("_ended"), "end_reason", "plays")
    df = (derived.join(accounts.select("account_id", "jurisdiction"), "account_id")
          .join(market.filter("session_grain = 'per_game'"), "jurisdiction")
          .join(parent, "session_id").join(games.select("game_id", "game_name"), "game_id", "left"))
    zone = F.col("timezone")
    filed = df.filter(F.col("_ended").isNotNull() & (F.col("file_empty_sessions") | (F.col("plays") > 0)))
    return filed.select(
        "jurisdiction", local_date(F.col("_ended"), zone).alias("report_date"), "game_session_id",
        "session_id", "account_id", "game_id", "game_name",
        local_datetime(F.col("started_at"), zone).alias("started_at_local"),
        local_datetime(F.col("ended_at"), zone).alias("ended_at_local"), "end_reason", "rounds",
        "rounds_won", money(F.col("staked")).alias("staked"), money(F.col("won")).alias("won"))


def close_inactive(sessions: DataFrame, accounts: DataFrame, market: DataFrame, now: Column) -> DataFrame:
    """Open sessions idle for longer than their market allows end at last + timeout."""
    df = (sessions.join(accounts.select("account_id", "jurisdiction"), "account_id")
          .join(market.select("jurisdiction", "timeout_minutes"), "jurisdiction"))
    limit = F.col("last_activity_ts") + F.make_interval(mins=F.col("timeout_minutes"))
    stale = F.col("ended_at").isNull() & F.col("timeout_minutes").isNotNull() & (limit < now)
    return df.select(
        "session_id", "account_id", "jurisdiction", "started_at", "last_activity_ts",
        F.when(stale, limit).otherwise(F.col("ended_at")).alias("ended_at"),
        F.when(stale, "INACTIVITY").otherwise(F.col("end_reason")).alias("end_reason"))


def sessionise(activity: DataFrame, user: str, ts: str, row_id: str, minutes: int) -> DataFrame:
    """A gap longer than ``minutes`` starts a new session; adds ``session_no``."""
    order = [F.col(ts), F.col(row_id)]
    return gap_sessions(activity, [user], ts, order, minutes, "session_no")


def session_summary(sessionised: DataFrame, user: str, ts: str) -> DataFrame:
    return sessionised.groupBy(user, "session_no").agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("last_activity_ts"), F.count("*").alias("activities"))


def session_round_lists(rounds: DataFrame, sessions: DataFrame, part_rows: int = 10_000, players: DataFrame | None = None) -> DataFrame:
    """Rounds of each ended session and game, oldest first, in parts of bounded size.
    Each of the ``parts`` carries the figures of the whole session. With ``players`` only the sessions in which one of them has
    a round are listed, and those wholly."""
    ended = sessions.filter("ended_at is not null").select("session_id")
    if players is not None:
        theirs = rounds.join(players.select("account_id"), "account_id", "left_semi").select("session_id")
        ended = ended.join(theirs, "session_id", "left_semi")
    played = rounds.join(ended, "session_id").select("session_id", "game", "account_id", "round_id",
                                                     "round_ts", "payout")
    totals = [F.min("account_id").alias("account_id"), F.min("round_ts").alias("first_played_at"),
              F.max("round_ts").alias("last_played_at"), F.count("*").alias("rounds"),
              F.count(F.when(F.col("payout") > 0, 1)).alias("rounds_won")]
    lists = ordered_lists(played, ["session_id", "game"], ["round_ts", "round_id"], F.col("round_id"),
                          "round_ids", part_rows, totals)
    return lists.withColumn("parts", parts_of(F.col("rounds"), part_rows))


def session_events(platform: DataFrame) -> DataFrame:
    """Each ended session as its login and logout rows."""
    rows = F.array(F.struct(F.col("started_at").alias("at"), F.lit("LOGIN").alias("tipo")),
                   F.struct(F.col("ended_at").alias("at"), F.lit("LOGOUT").alias("tipo")))
    return (platform.filter("ended_at is not null")
            .select("session_id", "account_id", F.explode(rows).alias("e"))
            .select("session_id", "account_id", "e.at", "e.tipo"))


def session_total_breaks(derived: DataFrame, platform: DataFrame) -> DataFrame:
    """Sessions whose games do not add up to the platform's totals; none expected."""
    rolled = derived.groupBy("session_id").agg(
        F.sum("rounds").alias("_rounds"), F.sum("staked").alias("_staked"), F.sum("won").alias("_won"))
    joined = platform.filter("plays > 0").join(rolled, "session_id", "full_outer")
    return joined.filter(
        F.col("plays").isNull() | F.col("_rounds").isNull() | (F.col("plays") != F.col("_rounds"))
        | (F.col("staked") != F.col("_staked")) | (F.col("won") != F.col("_won"))
    ).select("session_id", "plays", "_rounds", "staked", "_staked", "won", "_won")
