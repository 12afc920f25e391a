"""Lifecycle, staging, ledger, gaming and sessions on small rows."""

from pyspark.sql import functions as F

from ledgertide import markets
from ledgertide.functions import scalars
from ledgertide.operators import cdc, core, gaming, nomenclature, sessions, submissions

from .helpers import d, m, t

EVENTS = "slip_id string, event_type string, event_ts timestamp, stake decimal(18,2), payout decimal(18,2)"


def slips(spark, rows):
    events = spark.createDataFrame(rows, EVENTS)
    heads = events.select("slip_id").distinct().withColumns({"account_id": F.lit("A1"), "fixture_id": F.lit("F1")})
    return core.slip_lifecycle(events, heads)


def test_void_wins_over_settlement_and_open_stays_open(spark):
    rows = [("S5", "PLACED", t("2026-07-01 10:00"), m("10"), None), ("S5", "SETTLED", t("2026-07-01 12:00"), None, m("25")),
            ("S5", "VOIDED", t("2026-07-02 09:00"), None, None), ("S6", "PLACED", t("2026-07-01 10:00"), m("7"), None)]
    got = {r.slip_id: (r.slip_status, r.payout, r.stake) for r in slips(spark, rows).collect()}
    assert got == {"S5": ("VOIDED", m("0.00"), m("10.00")), "S6": ("OPEN", m("0.00"), m("7.00"))}


def test_lifecycle_from_feed_equals_staging_then_pivot(spark):
    at = t("2026-07-01 10:00")
    rows = [("S1", "PLACED", at, m("10"), m("0"), "I", at), ("S1", "SETTLED", t("2026-07-01 12:00"), m("0"), m("5"), "I", t("2026-07-01 12:00")),
            ("S1", "SETTLED", t("2026-07-01 12:00"), m("0"), m("6"), "U", t("2026-07-01 12:05")), ("S2", "PLACED", at, m("3"), m("0"), "I", at),
            ("S2", "VOIDED", t("2026-07-01 11:00"), m("0"), m("0"), "D", t("2026-07-01 11:00")), ("S3", "QUOTE", at, m("0"), m("0"), "I", at)]
    feed = spark.createDataFrame(rows, EVENTS + ", _op string, _commit_ts timestamp")
    heads = feed.select("slip_id").distinct().withColumns({"account_id": F.lit("A1"), "fixture_id": F.lit("F1")})
    one = core.lifecycle_from_feed(feed, heads).orderBy("slip_id").collect()
    two = core.slip_lifecycle(cdc.stage("bet_slip_events", feed), heads).orderBy("slip_id").collect()
    assert one == two and [(r.slip_id, r.slip_status, r.payout) for r in one] == [("S1", "SETTLED", m("6.00")), ("S2", "VOIDED", m("0.00"))]
    assert one[0].asDict().keys() == two[0].asDict().keys()


def test_latest_image_is_idempotent_and_honours_deletes(spark):
    schema = "account_id string, kyc string, _op string, _commit_ts timestamp"
    rows = [("A1", "P", "I", t("2026-07-01 10:00")), ("A1", "V", "U", t("2026-07-01 11:00")),
            ("A2", "P", "I", t("2026-07-01 10:00")), ("A2", "P", "D", t("2026-07-01 12:00"))]
    df = spark.createDataFrame(rows, schema)
    once = cdc.latest_image(df, ["account_id"]).collect()
    assert [(r.account_id, r.kyc) for r in once] == [("A1", "V")]
    assert cdc.latest_image(df.unionByName(df), ["account_id"]).collect() == once
    assert cdc.latest_image(df, ["account_id"], drop_deletes=False).count() == 2


def test_latest_image_limits_each_key_before_the_shuffle(spark):
    df = spark.createDataFrame([("A", "I", t("2026-07-01 10:00"))], "k string, _op string, _commit_ts timestamp")
    plan = cdc.latest_image(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_text_normalisation_and_event_name(spark):
    df = spark.createDataFrame([("  FÚTBOL ",), ("R.  Madrid",), ("Barça",), ("Assoc. Football",)], "raw string")
    got = [r[0] for r in df.select(scalars.normalise_text(F.col("raw"))).collect()]
    assert got == ["futbol", "r madrid", "barca", "assoc football"]
    name = scalars.render_event_name(F.lit("{home} - {away}"), F.lit("Real Madrid"), F.lit("Barcelona"))
    assert spark.range(1).select(name).first()[0] == "Real Madrid - Barcelona"


def test_fixture_names_fall_back_to_raw(spark):
    fixtures = spark.createDataFrame([("F1", "Padel", "Liga", " Barça ", "Rovers", None)],
                                     "fixture_id string, sport_name_raw string, competition_raw string, home_raw string, away_raw string, start_ts timestamp")
    r = nomenclature.fixture_dimension(fixtures, nomenclature.sport_aliases(spark), nomenclature.participant_aliases(spark)).first()
    assert (r.canonical_sport, r.home_name, r.away_name, r.home_participant_id) == (None, "Barcelona", "Rovers", "T-0004")


def test_dated_code_and_rate_change_on_the_boundary_day(spark):
    df = spark.createDataFrame([("BG", "FOOT", d("2025-12-31")), ("BG", "FOOT", d("2026-01-01")), ("BG", "HORS", d("2026-01-01"))],
                               "jurisdiction string, canonical_sport string, day date")
    coded = nomenclature.dated_code(df, markets.sport_code_frame(spark), "canonical_sport", "day")
    rated = nomenclature.dated_rate(coded, markets.betting_rate_frame(spark), "day").orderBy("day", "canonical_sport").collect()
    assert [(r.regulator_code, r.rate) for r in rated] == [("FUT", m("0.2")), ("FTB", m("0.25")), (None, m("0.25"))]


def test_withholding_brackets(spark):
    rows = spark.createDataFrame([(m("600"), "GR"), (m("90"), "GR"), (m("600"), "MT")], "p decimal(18,2), j string")
    got = [r[0] for r in rows.select(submissions.withholding(F.col("p"), F.col("j"))).collect()]
    assert got == [m("25.00"), m("0.00"), None]


def test_revenue_by_vertical(spark):
    rows = [("CASINO_ROUND", m("10"), m("6"), m("0"), m("0.04")), ("POKER_CASH", m("10"), m("6"), m("0.5"), m("0")),
            ("OPERATOR_JACKPOT", m("1"), m("0"), m("0"), m("0"))]
    df = spark.createDataFrame(rows, "vertical string, stake decimal(18,2), payout decimal(18,2), rake_or_fee decimal(18,2), jackpot_contribution decimal(18,2)")
    deducted = [r[0] for r in df.select(gaming.gaming_revenue(F.lit(True))).collect()]
    gross = [r[0] for r in df.select(gaming.gaming_revenue(F.lit(False))).collect()]
    assert deducted == [m("3.96"), m("0.50"), m("1.00")] and gross[0] == m("4.00")


def test_transaction_feed_pivots_cents_to_rounds(spark):
    schema = "tx_id string, round_ref string, player_ref string, table_ref string, tx_type string, amount_cents bigint, tx_ts timestamp, _op string, _commit_ts timestamp"
    at = t("2026-07-01 10:00")
    rows = [("T1", "9", "A1", "LR1", "BET", 1000, at, "I", at), ("T1", "9", "A1", "LR1", "BET", 1000, at, "I", at),
            ("T2", "9", "A1", "LR1", "WIN", 350, at, "I", at)]
    games = spark.createDataFrame([("G2", "Evolution", "LR1")], "game_id string, provider string, provider_game_ref string")
    r = gaming.normalise_feed(spark.createDataFrame(rows, schema), gaming.FEEDS["evolution_transactions"], games).collect()
    assert [(x.round_id, x.wager, x.payout, x.game_id) for x in r] == [("EV:9", m("10.00"), m("3.50"), "G2")]


def test_void_cascade_refunds_only_the_matching_trigger(spark):
    contributions = spark.createDataFrame(
        [("C1", "SPORTS_BET", "S5"), ("C2", "GAMING_ROUND", "S5"), ("C3", "GAMING_ROUND", "NE:R9"), ("C4", "SPORTS_BET", "S1")],
        "contribution_id string, trigger_type string, trigger_ref string").withColumns(
        {n: F.lit("x") for n in ("account_id", "jackpot_id", "game_id", "session_id")} | {"amount": F.lit(1), "contributed_at": F.lit(None)})
    lifecycle = spark.createDataFrame([("S5", "VOIDED"), ("S1", "SETTLED")], "slip_id string, slip_status string")
    voids = spark.createDataFrame([("NE:R9",), ("NE:R9",)], "round_id string")
    got = {r.contribution_id: r.status for r in gaming.operator_contributions(contributions, lifecycle, voids).collect()}
    assert got == {"C1": "REFUNDED", "C2": "ACTIVE", "C3": "REFUNDED", "C4": "ACTIVE"}


def test_two_pool_formulas(spark):
    rounds = spark.createDataFrame([("operator-jackpots", m("0.50"), m("0")), ("operator-jackpots", m("0"), m("100.50")), ("SLOTS", m("9"), m("9"))],
                                   "game string, stake decimal(18,2), payout decimal(18,2)")
    assert gaming.reseeding_pool(rounds).first().pool == m("100.00")
    pools = spark.createDataFrame([("J", "Big", m("500"))], "jackpot_id string, jackpot_name string, seed_amount decimal(18,2)")
    paid = spark.createDataFrame([("J", m("9.10"), "ACTIVE"), ("J", m("5"), "REFUNDED")], "jackpot_id string, amount decimal(18,2), status string")
    wins = spark.createDataFrame([("J", m("3.00"))], "jackpot_id string, amount decimal(18,2)")
    r = gaming.operator_pool_liability(pools, paid, wins).first()
    assert (r.total_contributions, r.pool_balance) == (m("9.10"), m("506.10"))


def test_ledger_signs_and_balance(spark):
    pay = spark.createDataFrame([("P1", "A1", "DEPOSIT", m("100"), "COMPLETED", t("2026-07-01 09:00")),
                                 ("P2", "A1", "WITHDRAWAL", m("20"), "COMPLETED", t("2026-07-03 09:00")),
                                 ("P3", "A1", "DEPOSIT", m("500"), "BLOCKED", None)],
                                "payment_id string, account_id string, direction string, amount decimal(18,2), status string, completed_ts timestamp")
    life = slips(spark, [("S1", "PLACED", t("2026-07-01 10:00"), m("30"), None), ("S1", "SETTLED", t("2026-07-01 12:00"), None, m("45")),
                         ("S2", "PLACED", t("2026-07-01 10:00"), m("10"), None), ("S2", "VOIDED", t("2026-07-01 11:00"), None, None)])
    plays = spark.createDataFrame([("O1", "A1", "OPERATOR_JACKPOT", m("1"), m("0"), t("2026-07-02 10:00"))],
                                  "activity_id string, account_id string, vertical string, stake decimal(18,2), payout decimal(18,2), occurred_at timestamp")
    wins = spark.createDataFrame([], "win_id string, account_id string, amount decimal(18,2), win_ts timestamp")
    ledger = core.wallet_ledger(pay, life, plays, wins)
    assert sorted(r.entry_type for r in ledger.collect()) == ["BET_PAYOUT", "BET_STAKE", "DEPOSIT", "JACKPOT_CONTRIBUTION", "WITHDRAWAL"]
    people = spark.createDataFrame([("A1", "MT")], "account_id string, jurisdiction string")
    assert core.wallet_balance(ledger, people).first().balance == m("94.00")


def test_inactivity_closes_only_stale_sessions_of_session_markets(spark):
    rows = [("G1", "N1", t("2026-07-08 10:00")), ("G2", "N1", t("2026-07-08 11:45")), ("G3", "M1", t("2026-07-08 01:00"))]
    df = spark.createDataFrame(rows, "session_id string, account_id string, last_activity_ts timestamp").withColumns(
        {"started_at": F.col("last_activity_ts"), "ended_at": F.lit(None).cast("timestamp"), "end_reason": F.lit(None).cast("string")})
    people = spark.createDataFrame([("N1", "NL"), ("M1", "MT")], "account_id string, jurisdiction string")
    now = F.lit("2026-07-08 12:00:00").cast("timestamp")
    got = {r.session_id: (r.ended_at, r.end_reason) for r in sessions.close_inactive(df, people, markets.market_frame(spark), now).collect()}
    assert got == {"G1": (t("2026-07-08 10:30"), "INACTIVITY"), "G2": (None, None), "G3": (None, None)}


def test_local_dates_across_daylight_saving(spark):
    rows = spark.createDataFrame([(t("2026-03-29 00:30"), "Europe/Madrid"), (t("2026-03-29 22:30"), "Europe/Madrid"),
                                  (t("2026-10-25 22:30"), "Europe/Madrid"), (t("2026-10-25 22:30"), "Europe/Athens")], "ts timestamp, z string")
    got = [(str(r[0]), r[1]) for r in rows.select(scalars.local_date(F.col("ts"), F.col("z")),
                                                   F.hour(scalars.local_datetime(F.col("ts"), F.col("z")))).collect()]
    assert got == [("2026-03-29", 1), ("2026-03-30", 0), ("2026-10-25", 23), ("2026-10-26", 0)]
    life = spark.createDataFrame([(t("2026-03-28 23:00"),), (t("2026-03-29 21:59"),), (t("2026-03-29 22:00"),)], "settled_at timestamp")
    assert submissions.settled_on(life, "2026-03-29", "Europe/Madrid").count() == 2


def test_config_has_no_problems():
    assert markets.check_config() == []


def test_market_files_have_declared_columns(spark):
    from ledgertide.plans import queries
    models = queries.models(spark, "/root/testdata/sf0.001")
    for market in markets.MARKETS:
        got = submissions.market_file(models["open_file"], market).columns
        assert got == ["jurisdiction", "report_date", *markets.BETTING_FILES[market], *markets.EXTENSIONS.get(market, [])]
