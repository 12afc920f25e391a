"""Documents: text, identifiers, escaping, repetition and one-to-many."""

import uuid
import xml.etree.ElementTree as ET
import zlib

from pyspark.sql import functions as F

from ledgertide.functions import scalars
from ledgertide.operators import document_formats, documents
from ledgertide.sources import sinks

from .helpers import m, t


def render(spark, market, kind, row, schema):
    now = F.lit("2026-07-08 12:00:00").cast("timestamp")
    df = spark.createDataFrame([row], schema)
    return documents.documents(df, market, kind, document_formats.docs_for(market, kind), now).collect()


PAYMENT = "record_key string, payment_id string, player_ref string, direction string, amount decimal(18,2), method string, completed_at timestamp, balance decimal(18,2), balance_before decimal(18,2)"
BET = ("record_key string, slip_id string, player_ref string, fixture_id string, sport string, event string, participants array<struct<name string>>, "
       "selection string, odds decimal(18,2), stake decimal(18,2), payout decimal(18,2), session_id string, status string, void_reason string, placed_at timestamp, "
       "terminal_at timestamp, balance_before_stake decimal(18,2), balance_after_stake decimal(18,2), balance_before_credit decimal(18,2), balance_after_credit decimal(18,2)")


def bet(**more):
    row = dict(record_key="S1", slip_id="S1", player_ref="A1", fixture_id="F1", sport="Football", event="A & B <x>", participants=[("Barça",), ("Rovers",)],
               selection="HOME", odds=m("2.5"), stake=m("10"), payout=m("25"), session_id=None, status="SETTLED", void_reason=None, placed_at=t("2026-07-01 10:00"),
               terminal_at=t("2026-07-01 12:00:05"), balance_before_stake=m("50"), balance_after_stake=m("40"), balance_before_credit=m("40"), balance_after_credit=m("65"))
    row.update(more)
    return tuple(row.values())


def test_uuid5_and_crc_match_the_standard_library(spark):
    ns = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    keys = [f"bet|S{i}|ñ" for i in range(50)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = df.select(scalars.uuid5(ns, F.col("k")), scalars.crc_id(F.col("k")), scalars.crc_id(F.col("k"), 30000)).collect()
    want = [(str(uuid.uuid5(uuid.UUID(ns), k)), zlib.crc32(k.encode()), zlib.crc32(k.encode()) % 30000) for k in keys]
    assert [tuple(r) for r in got] == want


def test_nl_payment_text(spark):
    row = ("P1", "P1", "ref", "DEPOSIT", m("25"), "CARD", t("2026-07-01 10:00"), m("75"), m("50"))
    doc, = render(spark, "NL", "payments", row, PAYMENT)
    ids = [str(uuid.uuid5(uuid.UUID(documents.NAMESPACE), k)) for k in ("nl-payment|P1", "nl-txn|P1")]
    assert doc.payload == (
        f"<Root><WOK_Player_Account_Transaction_v1.11><Record_ID>{ids[0]}</Record_ID><Extraction_Date>2026-07-08T12:00:00Z</Extraction_Date>"
        "<Operator_ID>OPERATOR</Operator_ID><Data_Safe_ID>CDB-OPERATOR-1</Data_Safe_ID><Player_Profile_ID>ref</Player_Profile_ID>"
        f"<Transaction_ID>{ids[1]}</Transaction_ID><Transaction_Datetime>2026-07-01T10:00:00Z</Transaction_Datetime><Transaction_Amount>25.00</Transaction_Amount>"
        "<Transaction_Deposit_Instrument>CREDIT_CARD</Transaction_Deposit_Instrument><Transaction_Type>DEPOSIT</Transaction_Type>"
        "<Transaction_Status>SUCCESSFUL</Transaction_Status></WOK_Player_Account_Transaction_v1.11></Root>")
    out, = render(spark, "NL", "payments", (*row[:3], "WITHDRAWAL", *row[4:]), PAYMENT)
    assert "Deposit_Instrument" not in out.payload


def test_one_bet_gives_several_traces(spark):
    kinds = lambda **more: [r.suffix for r in render(spark, "FR", "bets", bet(**more), BET)]
    assert kinds() == ["MISE", "GAIN"]
    assert kinds(payout=m("0")) == ["MISE"]
    assert kinds(status="VOIDED", payout=m("0"), void_reason="Joueur") == ["MISE", "ANNUL"]
    stake = ET.fromstring(render(spark, "FR", "bets", bet(), BET)[0].payload)
    assert [p.text for p in stake.iter("Part")] == ["BARA", "ROVERS"]
    assert stake.findtext("IDSession") == "0-sys" and stake.findtext("DateEvt") == "260701100000"
    assert stake.findtext("IDEvt") == str(zlib.crc32(b"fr-bet-mise|S1|SETTLED"))
    void = ET.fromstring(render(spark, "FR", "bets", bet(status="VOIDED", void_reason="other"), BET)[-1].payload)
    assert void.findtext("Motif") == "Autre" and void.find("Supervision") is not None


def test_text_is_escaped_and_every_format_is_well_formed(spark):
    for market in ("ES", "DK", "GR", "NL", "PT", "MT"):
        for r in render(spark, market, "bets", bet(), BET):
            root = ET.fromstring(r.payload)
            assert root.tag
            if market != "PT":
                assert "A &amp; B &lt;x&gt;" in r.payload
    es = render(spark, "ES", "payments", ("P1", "P1", "ref", "WITHDRAWAL", m("5"), "", t("2026-07-01 10:00"), m("0"), m("5")), PAYMENT)[0].payload
    assert "<Depositos><Total>0.00</Total></Depositos><Retiradas><Total>5.00</Total>" in es and "<MedioPago>OTRO</MedioPago>" in es
    assert '<Registro xsi:type="RegistroCJD">' in es and "<Participacion><Total/></Participacion>" in es


def test_plain_record_leaves_absent_fields_out(spark):
    doc, = render(spark, "MT", "bets", bet(), BET)
    assert doc.payload.startswith('<Record type="bet" id="S1"><SlipId>S1</SlipId>') and "VoidReason" not in doc.payload


def test_documents_are_written_and_found(spark, tmp_path):
    from ledgertide.operators import recon
    root, n = str(tmp_path / "docs"), 60
    rows = [("FR" if i % 3 else "M/T", "bets", f"S{i}|SETTLED", f"S{i}", "GAIN" if i % 5 == 0 else None, f"R{i}", i, f"<a n='{i}'/>") for i in range(n)]
    docs = spark.createDataFrame(rows, "jurisdiction string, record_type string, record_key string, record_id string, suffix string, "
                                       "receipt_id string, seq int, payload string")
    sinks.write_documents(docs, root)
    log, listed, paths = docs.select("jurisdiction", "record_type", "record_key"), sinks.manifest(spark, root), sinks.document_paths(spark, root)
    assert listed.count() == paths.count() == n
    assert {r.value for r in spark.read.text(root + "/files").collect()} == {r[-1] for r in rows}
    assert recon.store_breaks(log, listed, paths).collect() == []
    assert {r.record_id for r in recon.stored_files(paths).collect()} >= {f"S{i}" for i in range(n)}
    gone = tmp_path / "docs" / "files" / "jurisdiction=FR" / "record_type=bets" / "file_name=000010-S10-GAIN.xml"
    for f in gone.iterdir():
        f.unlink()
    gone.rmdir()
    extra = gone.with_name("file_name=000999-S999.xml")
    extra.mkdir()
    (extra / "part-0.txt").write_text("<a/>")
    got = recon.store_breaks(log.where("record_key <> 'S7|SETTLED'").union(spark.createDataFrame([("FR", "bets", "S900|VOIDED")], log.schema)),
                             listed, sinks.document_paths(spark, root)).collect()
    assert sorted((r.item, r.problem) for r in got) == [("000010-S10-GAIN.xml", "FILE_MISSING"), ("000999-S999.xml", "UNKNOWN_FILE"),
                                                        ("S7|SETTLED", "NO_RECEIPT"), ("S900|VOIDED", "NOT_LISTED")]
    sinks.write_xml(docs.select("jurisdiction", "record_type", "payload"), str(tmp_path / "xml"), "Root", "Row")
    assert list((tmp_path / "xml" / "jurisdiction=FR" / "record_type=bets").glob("part-*"))
