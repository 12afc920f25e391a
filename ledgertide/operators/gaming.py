"""Game provider feeds to one round shape; pools, revenue and their checks."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import markets
from ..functions.scalars import MONEY, money
from .cdc import latest_image
from .core import zero

# One entry per feed: how its columns map to a round. ``studio`` names a column
# where one feed carries several providers; ``minor`` marks amounts in cents.
FEEDS = {
    "netent_rounds": dict(
        provider="NetEnt", prefix="NE", round="round_ref", player="player_ref", game="game_ref",
        ts="round_ts", wager="bet_amount", payout="win_amount", contribution="jp_contribution",
        pool="jp_id", session="session_ref"),
    "evolution_transactions": dict(
        provider="Evolution", prefix="EV", round="round_ref", player="player_ref", game="table_ref",
        ts="tx_ts", tx="tx_id", tx_type="tx_type", amount="amount_cents", minor=True),
    "playtech_rounds": dict(
        provider="Playtech", prefix="PT", round="round_ref", player="player_ref", game="game_code",
        ts="round_ts", wager="stake", payout="payout"),
    "aggregator_rounds": dict(
        studio="sub_provider", prefix="AG", round="round_ref", player="player_ref", game="game_ref",
        ts="round_ts", wager="bet", payout="win"),
}


def _amount(value: Column, feed: Mapping) -> Column:
    return money(value * Decimal("0.01")) if feed.get("minor") else value.cast(MONEY)


def provider_of(feed: Mapping) -> Column:
    """The feed's own provider, or the studio an aggregator names per row."""
    return F.col(feed["studio"]) if "studio" in feed else F.lit(feed["provider"])


def _round_grain(landing: DataFrame, feed: Mapping) -> DataFrame:
    newest = latest_image(landing, [feed["round"]], [feed["player"], feed["game"], feed["wager"]])
    text = F.lit(None).cast("string")
    return newest.select(
        F.col(feed["round"]).alias("_ref"), provider_of(feed).alias("provider"),
        F.col(feed["player"]).alias("account_id"), F.col(feed["game"]).alias("_game"),
        _amount(F.col(feed["wager"]), feed).alias("wager"),
        _amount(F.col(feed["payout"]), feed).alias("payout"),
        (F.coalesce(_amount(F.col(feed["contribution"]), feed), zero())
         if "contribution" in feed else zero()).alias("jackpot_contribution"),
        (F.col(feed["pool"]) if "pool" in feed else text).alias("jackpot_id"),
        (F.col(feed["session"]) if "session" in feed else text).alias("session_id"),
        F.col(feed["ts"]).alias("round_ts"))


def _transaction_grain(landing: DataFrame, feed: Mapping) -> DataFrame:
    newest = latest_image(landing, [feed["tx"]], [feed["player"], feed["game"], feed["amount"]])

    def total(kind: str) -> Column:
        return F.sum(F.when(F.col(feed["tx_type"]) == kind, F.col(feed["amount"])).otherwise(0))
    rounds = newest.groupBy(F.col(feed["round"]).alias("_ref")).agg(
        F.min(feed["player"]).alias("account_id"), F.min(feed["game"]).alias("_game"),
        total("BET").alias("_bet"), total("WIN").alias("_win"), F.min(feed["ts"]).alias("round_ts"))
    text = F.lit(None).cast("string")
    return rounds.select(
        "_ref", provider_of(feed).alias("provider"), "account_id", "_game",
        _amount(F.col("_bet"), feed).alias("wager"), _amount(F.col("_win"), feed).alias("payout"),
        zero().alias("jackpot_contribution"), text.alias("jackpot_id"), text.alias("session_id"), "round_ts")


def normalise_feed(landing: DataFrame, feed: Mapping, games: DataFrame) -> DataFrame:
    """One feed in the common round shape. Round ids carry the feed's prefix,
    because references collide across providers; an unknown game drops out, as
    the catalogue is what gives a round its game id."""
    rounds = _transaction_grain(landing, feed) if "tx" in feed else _round_grain(landing, feed)
    catalogue = games.select("provider", F.col("provider_game_ref").alias("_game"), "game_id")
    return (rounds.join(catalogue, ["provider", "_game"])
            .select(F.concat(F.lit(feed["prefix"] + ":"), F.col("_ref")).alias("round_id"), "provider",
                    "account_id", "game_id", "wager", "payout", "jackpot_contribution", "jackpot_id",
                    "session_id", "round_ts"))


def game_rounds(landings: Mapping[str, DataFrame], games: DataFrame,
                feeds: Mapping[str, Mapping] = FEEDS) -> DataFrame:
    parts = [normalise_feed(landings[name], feed, games) for name, feed in feeds.items()]
    return reduce(DataFrame.unionByName, parts)


def operator_contributions(contributions: DataFrame, lifecycle: DataFrame,
                           round_voids: DataFrame) -> DataFrame:
    """A contribution follows its trigger: voided slip or rolled-back round, refunded.
    Both kinds of void become one (type, ref) list, so one join decides."""
    slips = lifecycle.filter("slip_status = 'VOIDED'").select(
        F.lit("SPORTS_BET").alias("trigger_type"), F.col("slip_id").alias("trigger_ref"))
    rounds = round_voids.select(
        F.lit("GAMING_ROUND").alias("trigger_type"), F.col("round_id").alias("trigger_ref"))
    voided = slips.unionByName(rounds).distinct().withColumn("_voided", F.lit(True))
    return (contributions.join(voided, ["trigger_type", "trigger_ref"], "left")
            .select("contribution_id", "account_id", "jackpot_id", "game_id", "trigger_type",
                    "trigger_ref", "amount", "session_id", "contributed_at",
                    F.when(F.col("_voided"), "REFUNDED").otherwise("ACTIVE").alias("status")))


def casino_activity(rounds: DataFrame) -> DataFrame:
    c = F.col
    return rounds.select(
        c("round_id").alias("activity_id"), "account_id", "game_id",
        F.lit("CASINO_ROUND").alias("vertical"), c("wager").alias("stake"), "payout",
        zero().alias("rake_or_fee"), "jackpot_contribution", "jackpot_id", "session_id",
        c("round_ts").alias("occurred_at"))


def _without_pool(df: DataFrame) -> DataFrame:
    return df.withColumns({"jackpot_contribution": zero(), "jackpot_id": F.lit(None).cast("string")})


def poker_activity(poker: DataFrame) -> DataFrame:
    c = F.col
    return _without_pool(poker.select(
        "activity_id", "account_id", "game_id",
        F.when(c("kind") == "CASH_HAND", "POKER_CASH").otherwise("POKER_TOURNAMENT").alias("vertical"),
        c("amount_in").alias("stake"), c("amount_out").alias("payout"), "rake_or_fee", "session_id",
        c("activity_ts").alias("occurred_at")))


def pool_activity(contributions: DataFrame, wins: DataFrame) -> DataFrame:
    c = F.col

    def pool(df, ref, ts, stake, payout):
        return df.select(c(ref).alias("activity_id"), "account_id", "game_id",
                         F.lit("OPERATOR_JACKPOT").alias("vertical"), stake.alias("stake"),
                         payout.alias("payout"), zero().alias("rake_or_fee"), "session_id",
                         c(ts).alias("occurred_at"))
    paid_in = pool(contributions.filter("status = 'ACTIVE'"), "contribution_id", "contributed_at",
                   c("amount"), zero())
    paid_out = pool(wins, "win_id", "win_ts", zero(), c("amount"))
    return _without_pool(paid_in.unionByName(paid_out))


def gaming_activity(rounds: DataFrame, poker: DataFrame, contributions: DataFrame,
                    wins: DataFrame) -> DataFrame:
    """Every play on one grain: rounds, poker, pool contributions and pool wins."""
    return casino_activity(rounds).unionByName(poker_activity(poker)).unionByName(pool_activity(contributions, wins))


def gaming_revenue(deduct: Column) -> Column:
    """Gross gaming revenue of one play: house games earn stake less payout (less
    the slice a market lets the pool take), poker earns its rake or fee."""
    c = F.col
    margin = c("stake") - c("payout")
    return (F.when(c("vertical") == "CASINO_ROUND",
                   F.when(deduct, margin - c("jackpot_contribution")).otherwise(margin))
            .when(c("vertical") == "OPERATOR_JACKPOT", margin)
            .otherwise(c("rake_or_fee")))


def _liability(pools: DataFrame, paid_in: DataFrame, paid_out: DataFrame) -> DataFrame:
    contributions = paid_in.groupBy("jackpot_id").agg(F.sum("amount").alias("_in"))
    wins = paid_out.groupBy("jackpot_id").agg(F.sum("amount").alias("_out"))
    joined = pools.join(contributions, "jackpot_id", "left").join(wins, "jackpot_id", "left")
    put, out = F.coalesce("_in", zero()), F.coalesce("_out", zero())
    return (joined.withColumn("total_contributions", put).withColumn("total_wins", out)
            .withColumn("pool_balance", F.col("seed_amount") + put - out).drop("_in", "_out"))


def pool_liability(pools: DataFrame, rounds: DataFrame, wins: DataFrame) -> DataFrame:
    paid_in = rounds.filter("jackpot_id is not null").select(
        "jackpot_id", F.col("jackpot_contribution").alias("amount"))
    return _liability(pools, paid_in, wins).select(
        "jackpot_id", "jackpot_name", "seed_amount", "contribution_rate", "total_contributions",
        "total_wins", "pool_balance")


def operator_pool_liability(pools: DataFrame, contributions: DataFrame, wins: DataFrame) -> DataFrame:
    return _liability(pools, contributions.filter("status = 'ACTIVE'"), wins).select(
        "jackpot_id", "jackpot_name", "seed_amount", "total_contributions", "total_wins", "pool_balance")


def reseeding_pool(rounds: DataFrame, game: str = markets.POOL_GAME,
                   seed: Decimal = markets.POOL_SEED) -> DataFrame:
    """Pool that is seeded again after every win."""
    own = rounds.filter(F.col("game") == game)
    agg = own.agg(F.coalesce(F.sum("stake"), zero()).alias("contributions"),
                  F.coalesce(F.sum("payout"), zero()).alias("wins_paid"),
                  F.count(F.when(F.col("payout") > 0, 1)).alias("win_count"))
    balance = F.lit(seed) * (F.col("win_count") + 1) + F.col("contributions") - F.col("wins_paid")
    return agg.select(F.lit(game).alias("game"), "contributions", "wins_paid", "win_count",
                      money(balance).alias("pool"))


def contribution_rate_breaks(rounds: DataFrame, pools: DataFrame) -> DataFrame:
    """Rounds whose contribution is not the pool's rate of the wager."""
    joined = rounds.join(pools.select("jackpot_id", "contribution_rate"), "jackpot_id")
    due = F.col("wager") * F.col("contribution_rate")
    return (joined.filter(F.abs(F.col("jackpot_contribution") - due) > F.lit(markets.TOLERANCE))
            .select("round_id", "jackpot_id", "wager", "jackpot_contribution", "contribution_rate"))


def wallet_pool_check(ledger: DataFrame, contributions: DataFrame) -> DataFrame:
    """Jackpot debits of the wallets against what the pools took in."""
    debits = ledger.filter("entry_type = 'JACKPOT_CONTRIBUTION'").select(
        (-F.col("signed_amount")).cast(MONEY).alias("debit"), zero().alias("taken"))
    taken = contributions.filter("status = 'ACTIVE'").select(zero().alias("debit"), F.col("amount").alias("taken"))
    return debits.unionByName(taken).agg(
        F.coalesce(F.sum("debit"), zero()).alias("wallet_debits"),
        F.coalesce(F.sum("taken"), zero()).alias("pool_contributions")).withColumn(
        "difference", F.col("wallet_debits") - F.col("pool_contributions"))


def bonus_winnings(stake: Column, payout: Column) -> Column:
    """A bonus stake never comes back: a win pays only what exceeds it."""
    return money(F.greatest(payout - stake, zero()))


def implied_contributions(rounds: DataFrame, optins: DataFrame, rate: Decimal = markets.POOL_RATE) -> DataFrame:
    """What each cash play of a player opted in at that instant owes the pool."""
    o = optins.select("account_id", "optin_id", "opted_in_at", "opted_out_at")
    t = F.col("round_ts")
    live = ((t >= F.col("opted_in_at"))
            & (F.col("opted_out_at").isNull() | (t < F.col("opted_out_at"))))
    due = money(F.col("stake") * F.lit(rate))
    return (rounds.filter(f"funding = 'CASH' and game <> '{markets.POOL_GAME}'")
            .join(o, "account_id").filter(live)
            .select("round_id", "account_id", "optin_id", "stake", due.alias("contribution"))
            .filter("contribution > 0"))
