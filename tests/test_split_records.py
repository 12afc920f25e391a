"""Long records in parts: keys and ids apart, figures of the whole record in each."""

import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from ledgertide.operators import delivery, document_formats, documents, exceptions, records, sessions, submissions

from .helpers import m, t


def texts(df, market, kind, tag):
    out = documents.documents(df, market, kind, document_formats.docs_for(market, kind), F.lit("2026-07-08 12:00:00").cast("timestamp")).collect()
    return [[e.text for e in ET.fromstring(r.payload).iter() if e.tag.split("}")[-1] == tag] for r in out]


def test_split_session_has_own_ids_and_whole_counts(spark):
    rounds = spark.createDataFrame(
        [("S", "SLOTS", "A", f"R{i}", t(f"2026-07-01 1{i}:00"), m("1") if i < 4 else m("0")) for i in range(5)],
        "session_id string, game string, account_id string, round_id string, round_ts timestamp, payout decimal(18,2)")
    ended = spark.createDataFrame([("S", t("2026-07-01 20:00"))], "session_id string, ended_at timestamp")
    lists = sessions.session_round_lists(rounds, ended, part_rows=2)
    accounts = spark.createDataFrame([("A", "NL", "N1")], "account_id string, jurisdiction string, national_id string")
    market = spark.createDataFrame([("NL", True, False, True, "per_game", 30)], "jurisdiction string, hashed_ref boolean, "
                                   "include_voided boolean, gaming_via_sessions boolean, session_grain string, timeout_minutes int")
    log = spark.createDataFrame([("sessions", "S-SLOTS")], "record_type string, record_key string")
    nothing = log.limit(0)
    recs = records.game_sessions(delivery.pending_game_sessions(lists, accounts, market, nothing)).orderBy("part")
    assert [r.record_key for r in recs.collect()] == ["S-SLOTS", "S-SLOTS~2", "S-SLOTS~3"]
    assert len({tuple(x) for x in texts(recs, "NL", "sessions", "Record_ID")}) == 3
    assert len({tuple(x) for x in texts(recs, "NL", "sessions", "Game_Session_ID")}) == 1
    assert texts(recs, "NL", "sessions", "Game_Session_Rounds") == [["5"]] * 3
    assert texts(recs, "NL", "sessions", "Game_Session_Rounds_Won") == [["4"]] * 3
    # a part that is logged is not filed again; the others still are
    later = delivery.pending_game_sessions(lists, accounts, market, log)
    assert sorted(r.log_key for r in later.collect()) == ["S-SLOTS~2", "S-SLOTS~3"]


def test_split_register_has_own_lots_and_whole_counts(spark):
    rows = spark.createDataFrame(
        [("ES", "RUT", t("2026-06-01 00:00"), t("2026-07-01 00:00"), f"A{i}", f"p{i}", t("2026-01-01 00:00"), 1, m("2"), m("1"), m("1"))
         for i in range(5)],
        "jurisdiction string, register_id string, period_start timestamp, period_end timestamp, account_id string, player_ref string, "
        "opened_at timestamp, bets_settled bigint, stake_sum decimal(28,2), winnings_sum decimal(28,2), ggr_sum decimal(28,2)")
    recs = records.register_records(submissions.register_filings(rows, part_rows=2)).orderBy("part")
    assert [r.record_key for r in recs.collect()] == ["RUT-2026-06-01", "RUT-2026-06-01~2", "RUT-2026-06-01~3"]
    assert [x[0] for x in texts(recs, "ES", "rut", "LoteId")] == ["LOTE-RUT-202606", "LOTE-RUT-202606~2", "LOTE-RUT-202606~3"]
    assert texts(recs, "ES", "rut", "NumeroJugadores") == [["5"]] * 3
    assert texts(recs, "ES", "rut", "SubregistroId") == [["1"] * 2, ["2"] * 2, ["3"] * 2]
    assert texts(recs, "ES", "rut", "SubregistroTotal") == [["3"] * 2] * 3
    players = [p for doc in texts(recs, "ES", "rut", "JugadorId") for p in doc]
    assert sorted(players) == [f"p{i}" for i in range(5)]


def test_postcode_prefix_with_a_space(spark):
    addresses = spark.createDataFrame([("A1", "AB 12 X"), ("A2", "AB 99"), ("A3", "AB"), ("A4", None)], "account_id string, postcode string")
    accounts = spark.createDataFrame([(f"A{i}", "MT") for i in range(1, 5)], "account_id string, jurisdiction string")
    regions = spark.createDataFrame([("AB 12", "inner")], "postcode_prefix string, region_name string")
    market = spark.createDataFrame([("MT", None, True)], "jurisdiction string, postcode_pattern string, region_required boolean")
    got = exceptions.validate_addresses(addresses, accounts, regions, market).select("account_id", "region_name", "fail_reason")
    assert sorted(map(tuple, got.collect())) == [("A1", "inner", None), ("A2", None, "region_not_found"),
                                                 ("A3", None, "region_not_found"), ("A4", None, "region_not_found")]
