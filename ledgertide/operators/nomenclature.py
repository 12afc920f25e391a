"""Two-hop mapping: feed spelling to canonical code, canonical code to the
regulator's code valid on a date. Plus dated rates and the repair queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import markets
from ..functions.frames import config_frame
from ..functions.scalars import normalise_text


def sport_canonical(spark: SparkSession) -> DataFrame:
    return config_frame(spark, markets.SPORTS, [("code", "string"), ("name", "string")])


def _aliases(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    raw = config_frame(spark, rows, [(n, "string") for n in ["alias", *names]])
    keyed = raw.select(normalise_text(F.col("alias")).alias("alias_norm"), *names)
    return F.broadcast(keyed.dropDuplicates(["alias_norm"]))


def sport_aliases(spark: SparkSession) -> DataFrame:
    return _aliases(spark, markets.SPORT_ALIASES, ["canonical", "source"])


def participant_aliases(spark: SparkSession) -> DataFrame:
    return _aliases(spark, markets.PARTICIPANT_ALIASES, ["canonical_id", "canonical_name"])


def game_type_aliases(spark: SparkSession) -> DataFrame:
    return _aliases(spark, markets.GAME_ALIASES, ["canonical", "source"])


def lookup_alias(df: DataFrame, raw: str, aliases: DataFrame, found: dict[str, str]) -> DataFrame:
    """Left join of a raw label to its alias row; ``found`` renames alias columns.
    A label without an alias keeps NULL and goes to the repair queue."""
    norm = f"_{raw}_norm"
    renamed = aliases.select(F.col("alias_norm").alias(norm),
                             *[F.col(a).alias(b) for a, b in found.items()])
    return (df.withColumn(norm, normalise_text(F.col(raw)))
            .join(F.broadcast(renamed), norm, "left").drop(norm))


def fixture_dimension(fixtures: DataFrame, sports: DataFrame, participants: DataFrame) -> DataFrame:
    df = lookup_alias(fixtures, "sport_name_raw", sports, {"canonical": "canonical_sport"})
    df = lookup_alias(df, "home_raw", participants,
                      {"canonical_id": "home_participant_id", "canonical_name": "_home"})
    df = lookup_alias(df, "away_raw", participants,
                      {"canonical_id": "away_participant_id", "canonical_name": "_away"})
    return df.select(
        "fixture_id", "start_ts", "sport_name_raw", "canonical_sport",
        F.col("competition_raw").alias("competition_name"),
        F.coalesce("_home", "home_raw").alias("home_name"),
        F.coalesce("_away", "away_raw").alias("away_name"),
        "home_participant_id", "away_participant_id")


def game_dimension(games: DataFrame, aliases: DataFrame) -> DataFrame:
    df = lookup_alias(games, "game_type_raw", aliases, {"canonical": "canonical_game_type"})
    return df.select("game_id", "game_name", "provider", "game_type_raw", "canonical_game_type")


def in_force(day: Column, valid_from: Column, valid_to: Column) -> Column:
    """Start inclusive, end exclusive, NULL open."""
    return ((valid_from.isNull() | (day >= valid_from)) & (valid_to.isNull() | (day < valid_to)))


def dated_code(df: DataFrame, codes: DataFrame, canonical: str, day: str) -> DataFrame:
    """Adds ``regulator_code``: the code of the row's market and canonical value
    on its date, NULL where the market has none."""
    r = F.broadcast(codes.select(
        F.col("jurisdiction").alias("_m"), F.col(canonical).alias("_c"), "regulator_code",
        F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")))
    match = ((F.col("jurisdiction") == F.col("_m")) & (F.col(canonical) == F.col("_c"))
             & in_force(F.col(day), F.col("_from"), F.col("_to")))
    return df.join(r, match, "left").drop("_m", "_c", "_from", "_to")


def dated_rate(df: DataFrame, rates: DataFrame, day: str, out: str = "rate") -> DataFrame:
    """Adds the rate of the row's market on its date, NULL outside every period."""
    r = F.broadcast(rates.select(
        F.col("jurisdiction").alias("_m"), F.col("rate").alias(out),
        F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")))
    match = (F.col("jurisdiction") == F.col("_m")) & in_force(F.col(day), F.col("_from"), F.col("_to"))
    return df.join(r, match, "left").drop("_m", "_from", "_to")


def with_bucket(code: Column, bucket: Column) -> Column:
    """Unmapped policy: a market with a bucket files it, one without keeps NULL."""
    return F.coalesce(code, bucket)


def known_codes(codes: DataFrame, policy: DataFrame, bucket: str) -> DataFrame:
    """(market, code) pairs acceptable in a file: every version, plus the bucket."""
    defaults = policy.filter(F.col(bucket).isNotNull()).select(
        "jurisdiction", F.col(bucket).alias("regulator_code"))
    return F.broadcast(codes.select("jurisdiction", "regulator_code").unionByName(defaults).distinct())


def unmapped_sports(fixtures: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """Labels without an alias, by the slips they hold up. Slips are counted per
    fixture first, so one popular fixture never multiplies through the join."""
    slips = lifecycle.groupBy("fixture_id").agg(F.count("slip_id").alias("slips"))
    return (fixtures.filter(F.col("canonical_sport").isNull()).join(slips, "fixture_id", "left")
            .groupBy("sport_name_raw")
            .agg(F.count("fixture_id").alias("fixtures_affected"),
                 F.coalesce(F.sum("slips"), F.lit(0)).cast("bigint").alias("slips_affected"),
                 F.min("start_ts").alias("first_seen"), F.max("start_ts").alias("last_seen"))
            .orderBy(F.desc("slips_affected"), "sport_name_raw"))


def unmapped_game_types(games: DataFrame, activity: DataFrame) -> DataFrame:
    plays = activity.groupBy("game_id").agg(F.count("activity_id").alias("plays"))
    return (games.filter(F.col("canonical_game_type").isNull()).join(plays, "game_id", "left")
            .groupBy("game_type_raw", "provider")
            .agg(F.count("game_id").alias("games_affected"),
                 F.coalesce(F.sum("plays"), F.lit(0)).cast("bigint").alias("activities_affected"))
            .orderBy(F.desc("activities_affected"), "game_type_raw", "provider"))
