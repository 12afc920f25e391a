"""Market files of one write, and readiness looked up in the calendar."""

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from ledgertide import markets
from ledgertide.operators import exceptions, submissions
from ledgertide.sources import sinks


def test_one_write_gives_each_market_its_own_columns(spark, tmp_path):
    names = list(submissions.betting_fields())
    rows = spark.range(90).select(
        F.element_at(F.array(*[F.lit(m) for m in markets.MARKETS]), (F.col("id") % len(markets.MARKETS) + 1).cast("int")).alias("jurisdiction"),
        F.date_add(F.lit("2026-07-01").cast("date"), (F.col("id") % 4).cast("int")).alias("report_date"),
        *[F.concat(F.lit(n), F.col("id").cast("string")).alias(n) for n in names])
    root = str(tmp_path / "files")
    sinks.fan_out(rows, root, markets.MARKETS)
    for m in markets.MARKETS:
        got, want = sinks.market_rows(spark, root, m), submissions.market_file(rows, m).drop("jurisdiction")
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert all("/jurisdiction=ES/" in f for f in sinks.market_rows(spark, root, "ES").inputFiles())


def test_days_are_looked_up_without_moving_rows(spark):
    start = date(1969, 11, 20)
    days = [("MT", start + timedelta(days=3 * k)) for k in range(60)] + [("ES", date(2026, 7, 1)), ("MT", None), (None, date(2026, 7, 1))]
    rows = [(m, start + timedelta(days=k), k, Decimal(k)) for k in range(200) for m in ("MT", "ES")]
    rows += [("ES", date(2026, 7, 1), -1, None), ("XX", date(2026, 7, 1), -2, None), ("MT", None, -3, None), (None, None, -4, None)]
    calendar = spark.createDataFrame(days, "jurisdiction string, report_date date")
    df = spark.createDataFrame(rows, "jurisdiction string, report_date date, n int, stake decimal(18,2)")
    got = exceptions.on_days(df, calendar)
    assert got.columns == df.columns
    known = {d for d in days if None not in d}
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in df.collect() if (r.jurisdiction, r.report_date) in known)
    stored = spark.range(10).select(F.when(F.col("id") > 4, "MT").otherwise("ES").alias("jurisdiction"), F.lit(date(2026, 7, 1)).alias("report_date"), "id")
    plan = exceptions.on_days(stored, calendar)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
