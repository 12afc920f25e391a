"""What documents of one market join, list and look up at size."""

import random

from pyspark.sql import functions as F

from ledgertide.operators import delivery, sessions

from .helpers import m, t


def test_receipts_of_one_file_are_not_joined_in_one_task(spark):
    keys = spark.createDataFrame([("GR", "gaming", f"R{i:03d}") for i in range(1000)], "jurisdiction string, record_type string, record_key string")
    stored = spark.createDataFrame([("GR", "gaming", 7)], "jurisdiction string, record_type string, last_seq bigint")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the log is too long for Spark to see that its totals are few
    try:
        got = delivery.assign_receipts(keys, stored)
        assert "SortMergeJoin" not in got._jdf.queryExecution().sparkPlan().toString()
        assert got.agg(F.min("seq"), F.max("seq"), F.countDistinct("seq")).first()[:] == (8, 1007, 1000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def feeds(spark, path, seed):
    """Sessions that several players of several markets play in, rounds without player, session or payout."""
    rnd = random.Random(seed)
    rounds = [(rnd.choice([None, *[f"S{n}" for n in range(120)]]), rnd.choice(["SLOTS", "POKER"]), rnd.choice([None, *[f"A{n}" for n in range(12)]]), f"R{i:03d}",
               t(f"2026-07-01 1{rnd.randrange(10)}:00"), rnd.choice([None, m("0"), m("2")])) for i in range(300)]
    spark.createDataFrame(rounds, "session_id string, game string, account_id string, round_id string, round_ts timestamp, payout decimal(18,2)").write.parquet(path)
    ended = spark.createDataFrame([(f"S{n}", t("2026-07-01 20:00") if n % 5 else None) for n in range(120)], "session_id string, ended_at timestamp")
    accounts = spark.createDataFrame([(f"A{n}", ["NL", "GR", "DE"][n % 3], f"N{n}") for n in range(12)], "account_id string, jurisdiction string, national_id string")
    return spark.read.parquet(path), ended, accounts


def test_lists_of_some_players_are_those_of_all_lists(spark, tmp_path):
    market = spark.createDataFrame([(k, True, False, True, "per_game", 30) for k in ("NL", "GR", "DE")], "jurisdiction string, hashed_ref boolean, "
                                   "include_voided boolean, gaming_via_sessions boolean, session_grain string, timeout_minutes int")
    nothing = spark.createDataFrame([], "record_type string, record_key string")
    for seed in range(2):
        rounds, ended, accounts = feeds(spark, str(tmp_path / f"rounds-{seed}"), seed)
        every = sessions.session_round_lists(rounds, ended, part_rows=1)
        some = sessions.session_round_lists(rounds, ended, part_rows=1, players=accounts.filter("jurisdiction = 'NL'"))
        pending = [delivery.pending_game_sessions(df, accounts, market, nothing).filter("jurisdiction = 'NL'") for df in (every, some)]
        want, got = ({(r.session_id, r.game, r.part, r.parts, r.rounds, r.rounds_won, tuple(r.round_ids)) for r in df.collect()} for df in pending)
        assert got == want and len(want) > 10 and max(x[3] for x in want) > 1
        assert some.count() < every.count()


def test_totals_of_sessions_do_not_read_the_rounds_again(spark, tmp_path):
    rounds, ended, _ = feeds(spark, str(tmp_path / "rounds"), 7)
    assert not [f for f in sessions.session_round_lists(rounds, ended).inputFiles() if "/rounds/" in f]
