"""What a run leaves on disk: shuffles go with the write they served, tables with their last reader, and scans move and write what is read."""

import os
import random
import time
from datetime import timedelta

from pyspark.sql import functions as F

from ledgertide import markets
from ledgertide.operators import exceptions, gaming, ordered, protection
from ledgertide.plans import pipeline, queries
from ledgertide.scratch import recorded, release, settled, staged, work_folder

from .helpers import d, m, t


def shuffle_files(spark) -> int:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def tables(spark) -> set[str]:
    folder = work_folder(spark)
    return set(os.listdir(folder)) if os.path.exists(folder) else set()


def test_shuffles_of_a_written_table_are_deleted(spark):
    before = shuffle_files(spark)
    table = staged(spark.range(5000).groupBy((F.col("id") % 97).alias("k")).count(), "counted")
    for _ in range(100):  # deleted in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and table.count() == 97
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_what_a_table_was_made_from_is_deleted(spark):
    before = tables(spark)
    with recorded() as folders:
        table = settled(lambda: staged(spark.range(9), "first").where("id > 3"), "second")
    assert {name.rsplit("-", 1)[0] for name in tables(spark) - before} == {"second"} and table.count() == 5
    release(spark, folders)
    assert tables(spark) == before


def test_a_scan_moves_rows_alone_and_writes_what_is_asked(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("k"), "id", (F.col("id") % 7).alias("v"), F.lit("wide").alias("rest"))
    exchange = ordered.dealt_by(df, ["k"], [F.col("id")], _v=F.col("v"))._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "_k#" not in exchange and "_v#" not in exchange
    whole = ordered.running_sum(df, ["k"], [F.col("id")], F.col("v"), "run")
    part = ordered.running_sum(df, ["k"], [F.col("id")], F.col("v"), "run", ["id"], F.col("id") % 2 == 0)
    assert part.columns == ["id", "run"]
    assert sorted(part.collect()) == sorted(whole.where("id % 2 = 0").select("id", "run").collect())
    assert {"rest", "k", "v", "_v", "_t"}.isdisjoint(spark.read.parquet(part.inputFiles()[0]).columns)


def test_only_asked_spans_are_marked(spark):
    rnd, start = random.Random(5), t("2026-07-01 10:00")
    rows = [(rnd.choice("ABC"), f"E{i}", start + timedelta(hours=rnd.randrange(900)), m(f"{rnd.randrange(-9, 30)}.25"),
             rnd.sample(["DAILY", "WEEKLY", "MONTHLY"], rnd.randrange(1, 4))) for i in range(120)]
    df = spark.createDataFrame(rows, "account_id string, ref string, ts timestamp, net decimal(18,2), asked array<string>")
    args = (df, df, "account_id", "ts", "net", "ref", protection.SPANS)
    whole = {r.ref: r for r in ordered.rolling_sums(*args).collect()}
    for r in ordered.rolling_sums(*args, "asked").join(df.select("ref", "asked"), "ref").collect():
        assert all(r[p] == (whole[r.ref][p] if p in r.asked else None) for p in protection.SPANS)
        assert r.ts == whole[r.ref].ts


def test_balances_decide_with_and_without_the_pool(spark):
    """Stakes around the balance before them, of players in and out of the pool, and below zero."""
    rnd, start = random.Random(3), t("2026-07-01 10:00")
    wagers, held = [], []
    for i in range(400):
        stake = m(f"{rnd.choice([-40, -4, 1, 4, 40])}.00")
        pool = (stake * markets.POOL_RATE).quantize(m("0.01"))
        casino = rnd.random() < 0.8
        wagers.append((f"W{i}", rnd.choice("AB"), start + timedelta(minutes=rnd.randrange(60)), stake, m("0"), casino, None, "CASH"))
        held.append((f"W{i}", stake + rnd.choice([m("-0.01"), m("0"), pool - m("0.01"), pool, pool + m("0.01"), m("900")])))
    nil = lambda schema: spark.createDataFrame([], schema)
    optins = spark.createDataFrame([("A", start + timedelta(minutes=20), start + timedelta(minutes=40)), ("A", start + timedelta(minutes=30), None)],
                                   "account_id string, opted_in_at timestamp, opted_out_at timestamp")
    got = protection.wager_gate_audit(
        spark.createDataFrame(wagers, "wager_id string, account_id string, ts timestamp, stake decimal(18,2), net decimal(18,2), casino boolean, game string, funding string"),
        spark.createDataFrame(held, "wager_id string, _before decimal(38,2)"),
        nil("account_id string, start_ts timestamp, end_ts timestamp"), optins, nil("account_id string, ref string, ts timestamp, net decimal(18,2)"),
        nil("account_id string, limit_type string, amount decimal(18,2), revoked_at timestamp"), nil("round_id string"))
    want = {}
    for (ref, account, ts, stake, _, casino, _, _), (_, before) in zip(wagers, held):
        pool = (stake * markets.POOL_RATE).quantize(m("0.01")) if casino and account == "A" and ts >= start + timedelta(minutes=20) else m("0")
        if stake <= 0:
            want[ref] = "NON_POSITIVE"
        elif stake + pool > before:
            want[ref] = "INSUFFICIENT_BALANCE"
    assert {r.wager_id: r.reason for r in got.collect()} == want and len(set(want.values())) == 2


def test_the_wager_gate_keeps_its_failures_alone(spark):
    before = tables(spark)
    audit = queries.PLANS["wager_gate_audit"](queries.models(spark, "/root/testdata/sf0.001"))
    assert {name.rsplit("-", 1)[0].split("-")[0] for name in tables(spark) - before} == {"failed"}
    assert audit.count() > 0


def test_what_only_the_holds_read_goes_with_them(spark):
    before, models, fresh = tables(spark), queries.models(spark, "/root/testdata/sf0.001"), queries.models(spark, "/root/testdata/sf0.001")
    file = queries.PLANS["betting_file"](models)
    left = {name.rsplit("-", 1)[0] for name in tables(spark) - before}
    assert left == {"dim_account", "fct_lifecycle", "blocked", *pipeline.PARTS["holds"]}
    assert sorted(map(str, file.collect())) == sorted(map(str, fresh["betting_file"].collect()))
    assert models["plays"].count() == fresh["fct_activity"].count() > 0  # a released model is built anew


def test_parts_make_up_the_plays(spark):
    models = queries.models(spark, "/root/testdata/sf0.001")
    assert set(pipeline.PARTS["plays"]) == {"plays_poker", "plays_pools", *[f"plays_{feed}" for feed in gaming.FEEDS]}
    whole = models["fct_activity"].select(models["plays"].columns)
    assert models["plays"].exceptAll(whole).count() == whole.exceptAll(models["plays"]).count() == 0


def test_the_isolation_gate_reads_the_file_once(spark):
    rnd = random.Random(11)
    days = [d(f"2026-07-{n:02d}") for n in range(1, 6)]
    owners = [(f"S{i}", rnd.choice([None, *"ABCDEFGH"])) for i in range(200)]
    filed = [(rnd.choice([None, *[s for s, _ in owners], "S-unknown"]), rnd.choice([None, *days])) for _ in range(300)]
    kinds = [("ACCOUNT", "QUARANTINED"), ("ACCOUNT", "RETRYING"), ("ACCOUNT", "RESOLVED"), ("PERIOD", "WAITING_DATA")]
    store = [(*rnd.choice(kinds), rnd.choice([None, *"ABCDEF"]), rnd.choice([None, *days])) for _ in range(9)]
    file = staged(spark.createDataFrame(filed, "slip_id string, report_date date"), "gate")
    got = exceptions.isolation_breaches(file, spark.createDataFrame(owners, "slip_id string, account_id string"),
                                        spark.createDataFrame(store, "block_scope string, status string, account_id string, report_date date"))
    blocked = {a for scope, status, a, _ in store if scope == "ACCOUNT" and status != "RESOLVED" and a}
    waiting = {(a, day) for scope, _, a, day in store if scope == "PERIOD" and a and day}
    of = dict(owners)
    want = {(s, of[s]) for s, day in filed if of.get(s) and (of[s] in blocked or (of[s], day) in waiting)}
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_the_isolation_gate_writes_what_it_reads_of_the_file(spark):
    before = tables(spark)
    queries.PLANS["isolation_breaches"](queries.models(spark, "/root/testdata/sf0.001"))
    names = {name.rsplit("-", 1)[0]: name for name in tables(spark) - before}
    assert "betting_file" not in names and "plays" not in names
    assert set(spark.read.parquet(f"{work_folder(spark)}/{names['filed']}").columns) == {"slip_id", "report_date"}
