"""What the wager gate sorts and writes of the cash flow."""

from ledgertide.operators import protection
from ledgertide.plans import queries


class Scanned(Exception):
    pass


def test_wager_gate_scans_what_it_needs(spark, monkeypatch):
    scanned = []

    def caught(df, *args):
        scanned.append(set(df.columns))
        raise Scanned

    monkeypatch.setattr(protection, "running_sum", caught)
    try:
        queries.PLANS["wager_gate_audit"](queries.models(spark, "/root/testdata/sf0.001"))
    except Scanned:
        pass
    assert scanned == [{"account_id", "ref", "ts", "amount", "is_wager"}]
