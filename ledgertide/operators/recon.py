"""Reconciliation: provider statements, the legacy parallel run, and money."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import markets
from ..functions.scalars import MONEY, money, totals_json
from .core import zero
from .nomenclature import dated_rate

c = F.col
BREAK = ["jurisdiction", "report_date", "break_type", "break_key", "legacy_value", "new_value", "detail"]


def _present(df: DataFrame) -> DataFrame:
    """Unpacks ``_i``, leaving out NULL entries. (A filter on rows stays in generated
    code; ``array_compact`` would evaluate the whole array outside it.)"""
    return df.filter(c("_i").isNotNull()).select(*df.columns[:-1], "_i.*")


def provider_breaks(rounds: DataFrame, statements: DataFrame) -> DataFrame:
    """Own gaming revenue per provider and UTC day against the provider's statement."""
    own = rounds.groupBy("provider", F.to_date("round_ts").alias("statement_date")).agg(
        money(F.sum(c("wager") - c("payout"))).alias("internal_ggr"))
    reported = statements.select("provider", "statement_date", "reported_ggr")
    both = own.join(reported, ["provider", "statement_date"], "full_outer")
    kind = (F.when(c("internal_ggr").isNull(), "statement with no internal activity")
            .when(c("reported_ggr").isNull(), "internal activity with no statement")
            .when(F.abs(c("internal_ggr") - c("reported_ggr")) > F.lit(markets.TOLERANCE), "ggr mismatch"))
    return both.withColumn("break_type", kind).filter(c("break_type").isNotNull()).select(
        "provider", "statement_date", "internal_ggr", "reported_ggr", "break_type")


def _totals(df: DataFrame) -> DataFrame:
    return df.groupBy("jurisdiction", "report_date").agg(
        F.count("*").alias("row_count"), money(F.sum("stake")).alias("total_stake"),
        money(F.sum("payout")).alias("total_payout"))


def legacy_total_breaks(legacy: DataFrame, new: DataFrame) -> DataFrame:
    key = ["jurisdiction", "report_date"]
    side = lambda df, p: _totals(df).select(*key, *[
        c(n).alias(p + n) for n in ("row_count", "total_stake", "total_payout")])
    both = side(legacy, "l_").join(side(new, "n_"), key, "full_outer")
    tol = F.lit(markets.TOLERANCE)
    detail = (F.when(c("l_row_count").isNull(), "date only in new pipeline")
              .when(c("n_row_count").isNull(), "date only in legacy")
              .when(c("l_row_count") != c("n_row_count"), "row count mismatch")
              .when((F.abs(c("l_total_stake") - c("n_total_stake")) > tol)
                    | (F.abs(c("l_total_payout") - c("n_total_payout")) > tol), "amount mismatch"))
    text = lambda p: totals_json(**{n: c(p + n) for n in ("row_count", "total_stake", "total_payout")})
    return both.withColumn("detail", detail).filter(c("detail").isNotNull()).select(
        "jurisdiction", "report_date", F.lit("TOTALS").alias("break_type"),
        c("report_date").cast("string").alias("break_key"), text("l_").alias("legacy_value"),
        text("n_").alias("new_value"), "detail")


def legacy_row_breaks(legacy: DataFrame, new: DataFrame, key: Sequence[str] = ("bet_id", "report_date")) -> DataFrame:
    on = ["jurisdiction", *key]

    def lone(a: DataFrame, b: DataFrame, kind: str, left: str, right: str) -> DataFrame:
        return a.join(b.select(*on), on, "left_anti").select(
            "jurisdiction", "report_date", F.lit(kind).alias("break_type"),
            c(key[0]).cast("string").alias("break_key"), F.lit(left).alias("legacy_value"),
            F.lit(right).alias("new_value"), F.lit(None).cast("string").alias("detail"))
    return lone(legacy, new, "MISSING_IN_NEW", "present", "absent").unionByName(
        lone(new, legacy, "EXTRA_IN_NEW", "absent", "present"))


def legacy_field_breaks(legacy: DataFrame, new: DataFrame, key: Sequence[str] = ("bet_id", "report_date"),
                        fields: Sequence[str] = ("stake", "payout", "ggr")) -> DataFrame:
    """Matched rows whose amounts differ; all fields are compared in one join."""
    on = ["jurisdiction", *key]
    other = new.select(*on, *[c(f).alias("_" + f) for f in fields])
    found = F.array(*[
        F.when(F.abs(c(f) - c("_" + f)) > F.lit(markets.TOLERANCE),
               F.struct(F.lit(f"FIELD_{f.upper()}").alias("break_type"),
                        c(f).cast("string").alias("legacy_value"),
                        c("_" + f).cast("string").alias("new_value"))) for f in fields])
    return (_present(legacy.join(other, on).select("jurisdiction", "report_date", c(key[0]).alias("break_key"),
                                                   F.explode(found).alias("_i")))
            .withColumn("detail", F.lit(None).cast("string")).select(*BREAK))


def submitted_breaks(receipts: DataFrame, ready: DataFrame) -> DataFrame:
    """Filed totals against what was ready to file."""
    totals = ready.groupBy("jurisdiction", "report_date").agg(money(F.sum("stake")).alias("_ready"))
    return (receipts.join(totals, ["jurisdiction", "report_date"])
            .filter(F.abs(c("total_stake") - c("_ready")) > F.lit(markets.TOLERANCE))
            .select("jurisdiction", "report_date", F.lit("SUBMITTED_VS_READY").alias("break_type"),
                    c("report_date").cast("string").alias("break_key"),
                    c("_ready").cast("string").alias("legacy_value"),
                    c("total_stake").cast("string").alias("new_value"), c("receipt_id").alias("detail")))


def cutover_breaks(*breaks: DataFrame) -> DataFrame:
    """Everything that stands in the way of leaving the legacy system; must be empty."""
    return reduce(DataFrame.unionByName, breaks)


def slip_amounts(images: DataFrame, slips: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per slip: when it was placed, settled, voided, and for how much, next to the
    columns of its header. ``images`` is :func:`core.slip_images`. Unlike the lifecycle
    fact, a void does not hide an earlier settlement."""
    return (images.join(slips, "slip_id")
            .join(accounts.select("account_id", "jurisdiction"), "account_id"))


def clawback() -> Column:
    """Payout already credited when the void came."""
    return F.when(c("settled_at") <= c("voided_at"), F.coalesce("payout", zero())).otherwise(zero())


def cash_flow(payments: DataFrame, slips: DataFrame, rounds: DataFrame) -> DataFrame:
    """Signed money movements at their own instants. ``slips`` is :func:`slip_amounts`;
    ``payments`` and ``rounds`` carry the market."""
    def flows(df: DataFrame, *rows: tuple) -> DataFrame:
        built = F.array(*[
            F.when(when, F.struct(ts.alias("ts"), amount.cast(MONEY).alias("amount"), F.lit(kind).alias("kind")))
            for when, ts, amount, kind in rows])
        return _present(df.select("jurisdiction", "account_id", "ref", F.explode(built).alias("_i")))
    done = payments.filter("status = 'COMPLETED'").withColumn("ref", c("payment_id"))
    paid = flows(done, (c("direction") == "DEPOSIT", c("completed_ts"), c("amount"), "DEPOSIT"),
                 (c("direction") == "WITHDRAWAL", c("completed_ts"), -c("amount"), "WITHDRAWAL"))
    bets = flows(slips.withColumn("ref", c("slip_id")),
                 (c("placed_at").isNotNull(), c("placed_at"), -c("stake"), "BET_STAKE"),
                 (c("payout") > 0, c("settled_at"), c("payout"), "BET_PAYOUT"),
                 (c("voided_at").isNotNull() & c("placed_at").isNotNull(), c("voided_at"),
                  c("stake") - clawback(), "VOID_REFUND"))
    net = F.when(c("funding") == "GOLDEN_CHIP", c("payout")).otherwise(c("payout") - c("stake"))
    plays = flows(rounds.withColumn("ref", c("round_id")), (F.lit(True), c("round_ts"), net, "CASINO_NET"))
    return paid.unionByName(bets).unionByName(plays)


def period_balances(flows: DataFrame, start: Column, end: Column) -> DataFrame:
    """Player balances at both ends of a period, per market."""
    before = lambda t: F.coalesce(F.sum(F.when(c("ts") < t, c("amount"))), zero())
    return flows.groupBy("jurisdiction").agg(before(start).alias("opening_balance"),
                                             before(end).alias("closing_balance"))


DAILY_MEASURES = ["deposits", "withdrawals", "settled_n", "settled_stakes", "settled_payouts", "void_n",
                  "void_stakes", "void_ggr_reversal", "rounds_n", "casino_stakes", "casino_payouts",
                  "golden_n", "golden_stakes", "golden_winnings", "open_delta", "cash_delta"]
COUNTS = {"settled_n", "void_n", "rounds_n", "golden_n"}


def _marks(df: DataFrame, rows: list[tuple[Column, Column, dict[str, Column]]]) -> DataFrame:
    """Each source row to its effects: (kept when, instant, measures)."""
    structs = []
    for when, ts, measures in rows:
        fields = [F.coalesce(measures.get(m, zero()), zero()).cast(MONEY).alias(m) for m in DAILY_MEASURES]
        structs.append(F.when(when, F.struct(F.to_date(ts).alias("day"), *fields)))
    return _present(df.select("jurisdiction", F.explode(F.array(*structs)).alias("_i")))


def daily_flows(payments: DataFrame, slips: DataFrame, rounds: DataFrame) -> DataFrame:
    """Every money measure per market and UTC day in one grouped pass. Balances
    and open stakes are kept as daily changes; running totals turn them into levels."""
    amt, one = c("amount"), F.lit(1)
    done = payments.filter("status = 'COMPLETED'")
    paid = _marks(done, [
        (c("direction") == "DEPOSIT", c("completed_ts"), {"deposits": amt, "cash_delta": amt}),
        (c("direction") == "WITHDRAWAL", c("completed_ts"), {"withdrawals": amt, "cash_delta": -amt})])
    stake = c("stake")
    placed, settled, voided = c("placed_at"), c("settled_at"), c("voided_at")
    reversed_ = F.when(settled <= voided, stake - c("payout"))
    bets = _marks(slips, [
        (placed.isNotNull(), placed, {"open_delta": stake, "cash_delta": -stake}),
        (settled.isNotNull() & placed.isNotNull(), settled,
         {"settled_n": one, "settled_stakes": stake, "settled_payouts": c("payout")}),
        (c("payout") > 0, settled, {"cash_delta": c("payout")}),
        (voided.isNotNull() & placed.isNotNull(), voided,
         {"void_n": one, "void_stakes": stake, "void_ggr_reversal": reversed_,
          "cash_delta": stake - clawback()}),
        (placed.isNotNull() & F.coalesce(settled, voided).isNotNull(), F.least(settled, voided),
         {"open_delta": -stake})])
    bonus = c("funding") == "GOLDEN_CHIP"
    payout = c("payout")
    plays = _marks(rounds, [
        (~bonus, c("round_ts"), {"rounds_n": one, "casino_stakes": stake, "casino_payouts": payout,
                                 "cash_delta": payout - stake}),
        (bonus, c("round_ts"), {"golden_n": one, "golden_stakes": stake, "golden_winnings": payout,
                                "cash_delta": payout})])
    return (paid.unionByName(bets).unionByName(plays).groupBy("jurisdiction", "day")
            .agg(*[F.sum(m).alias(m) for m in DAILY_MEASURES]))


def bridge(df: DataFrame, gross: Column) -> DataFrame:
    """Cash view to settlement view. ``df`` has the period's measures, balances and
    open stakes; the residual must be zero."""
    cash = c("deposits") - c("withdrawals") - (c("closing_balance") - c("opening_balance"))
    sports = c("settled_stakes") - c("settled_payouts") - c("void_ggr_reversal")
    casino = c("casino_stakes") - c("casino_payouts")
    golden = F.when(gross, c("golden_stakes") - c("golden_winnings")).otherwise(-c("golden_winnings"))
    return (df.withColumns({"cash_ggr": cash, "sports_ggr": sports, "casino_ggr": casino, "golden_ggr": golden,
                            "open_movement": c("open_end") - c("open_start"),
                            "bonus_bridge": F.when(gross, c("golden_stakes")).otherwise(zero())})
            .withColumn("settlement_ggr", c("sports_ggr") + c("casino_ggr") + c("golden_ggr"))
            .withColumn("residual", money(c("cash_ggr") - c("open_movement") + c("bonus_bridge")
                                          - c("settlement_ggr"))))


def duty_base(basis: Column) -> Column:
    stakes = c("settled_stakes") + c("casino_stakes") + c("golden_stakes")
    return F.when(basis == "turnover", stakes).otherwise(c("settlement_ggr"))


def daily_reconciliation(daily: DataFrame, market: DataFrame, rates: DataFrame) -> DataFrame:
    """All markets and days in one plan. The running windows go over (market, day)
    rows, which the calendar bounds."""
    upto = (Window.partitionBy("jurisdiction").orderBy("day")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = daily.withColumns({"closing_balance": F.sum("cash_delta").over(upto),
                            "open_end": F.sum("open_delta").over(upto)})
    df = df.withColumns({"opening_balance": c("closing_balance") - c("cash_delta"),
                         "open_start": c("open_end") - c("open_delta")})
    df = bridge(df.join(market.select("jurisdiction", "tax_basis", "bonus_gross"), "jurisdiction"),
                c("bonus_gross"))
    df = dated_rate(df, rates, "day")
    base = duty_base(c("tax_basis")).cast("decimal(24,2)")
    levels = ["opening_balance", "closing_balance", "open_start", "open_end", "cash_ggr", "sports_ggr",
              "casino_ggr", "golden_ggr", "open_movement", "bonus_bridge", "settlement_ggr"]
    sums = [m for m in DAILY_MEASURES if m not in ("open_delta", "cash_delta")]
    return df.select(
        "jurisdiction", "day",
        *[(c(m).cast("bigint") if m in COUNTS else c(m).cast("decimal(24,2)")).alias(m) for m in sums],
        *[c(n).cast("decimal(24,2)").alias(n) for n in levels], "residual", base.alias("duty_base"),
        F.coalesce("rate", F.lit(0).cast("decimal(9,4)")).alias("duty_rate"),
        money(base * F.coalesce("rate", F.lit(0).cast("decimal(9,4)"))).alias("duty"))


def monthly_reconciliation(daily: DataFrame) -> DataFrame:
    """Months from days: flows add up, levels come from the first and last day, and
    duty is each day's duty at that day's rate, never an average."""
    month = F.trunc("day", "month").alias("month")
    sums = [m for m in DAILY_MEASURES if m not in ("open_delta", "cash_delta")]
    added = [*sums, "cash_ggr", "settlement_ggr", "open_movement", "bonus_bridge", "duty_base", "duty"]
    return daily.groupBy("jurisdiction", month).agg(
        *[F.sum(m).alias(m) for m in added],
        F.min_by("opening_balance", "day").alias("opening_balance"),
        F.max_by("closing_balance", "day").alias("closing_balance"),
        F.min_by("open_start", "day").alias("open_start"), F.max_by("open_end", "day").alias("open_end"),
        F.count(F.when(c("residual") != 0, 1)).alias("days_off"))


def open_stakes_at(slips: DataFrame, t: Column) -> DataFrame:
    """Stakes placed before an instant with nothing final before it, per market."""
    first_end = F.least("settled_at", "voided_at")
    still = first_end.isNull() | (first_end >= t)
    return slips.filter((c("placed_at") < t) & still).groupBy("jurisdiction").agg(
        F.sum("stake").alias("open_stakes"), F.count("*").alias("open_slips"))


def expected_records(slips: DataFrame, payments: DataFrame, rounds: DataFrame, sessions: DataFrame,
                     market: DataFrame, licensed: DataFrame) -> DataFrame:
    """What each market should have filed: (market, record_type, record_key, record_id, due_at).
    ``payments``, ``rounds`` and ``sessions`` carry the market."""
    m = market.select("jurisdiction", "include_voided", "gaming_via_sessions", "session_grain")
    out = ["jurisdiction", "record_type", "record_key", "record_id", "due_at"]
    ended = F.array(
        F.when(c("settled_at").isNotNull(), F.struct(F.lit("SETTLED").alias("s"), c("settled_at").alias("due_at"))),
        F.when(c("voided_at").isNotNull() & c("include_voided"),
               F.struct(F.lit("VOIDED").alias("s"), c("voided_at").alias("due_at"))))
    both = _present(slips.join(m, "jurisdiction").select("jurisdiction", "slip_id", F.explode(ended).alias("_i")))
    bets = both.select(
        "jurisdiction", F.lit("bets").alias("record_type"), F.concat_ws("|", "slip_id", "s").alias("record_key"),
        c("slip_id").alias("record_id"), "due_at")
    paid = payments.filter("status = 'COMPLETED'").join(m.select("jurisdiction"), "jurisdiction", "left_semi").select(
        "jurisdiction", F.lit("payments").alias("record_type"), c("payment_id").alias("record_key"),
        c("payment_id").alias("record_id"), c("completed_ts").alias("due_at"))
    plays = (licensed_only(rounds.join(m.filter("not gaming_via_sessions"), "jurisdiction"), licensed)
             .select("jurisdiction", F.lit("gaming").alias("record_type"), c("round_id").alias("record_key"),
                     c("round_id").alias("record_id"), c("round_ts").alias("due_at")))
    ended_sessions = sessions.filter("ended_at is not null").join(
        m.filter("session_grain is not null"), "jurisdiction")
    whole = ended_sessions.filter("session_grain = 'platform'").select(
        "jurisdiction", F.lit("sessions").alias("record_type"), c("session_id").alias("record_key"),
        c("session_id").alias("record_id"), c("ended_at").alias("due_at"))
    key = F.concat_ws("-", "session_id", "game")
    per_game = (ended_sessions.filter("session_grain = 'per_game'")
                .join(rounds.select("session_id", "game").distinct(), "session_id")
                .select("jurisdiction", F.lit("sessions").alias("record_type"), key.alias("record_key"),
                        key.alias("record_id"), c("ended_at").alias("due_at")))
    return reduce(DataFrame.unionByName, [bets, paid, plays, whole, per_game]).select(*out)


def licensed_only(rounds: DataFrame, licensed: DataFrame) -> DataFrame:
    """Drops games a market does not license; a market without a list licenses all."""
    listed = licensed.select("jurisdiction").distinct().withColumn("_listed", F.lit(True))
    ok = licensed.select("jurisdiction", "game").withColumn("_ok", F.lit(True))
    return (rounds.join(F.broadcast(listed), "jurisdiction", "left")
            .join(F.broadcast(ok), ["jurisdiction", "game"], "left")
            .filter(c("_listed").isNull() | c("_ok")).drop("_listed", "_ok"))


def stored_names(paths: DataFrame) -> DataFrame:
    """(market, record_type, file_name) of stored document paths ``.../MKT/type/000001-KEY[-SUFFIX].xml``, each a file or a
    folder of one file, with or without column names before the folders' values."""
    p = F.regexp_replace("path", r"/part-[^/]+$", "")
    part = lambda n: F.regexp_extract(p, r"(?:[a-z_]+=)?([^/=]+)" + r"/[^/]+" * n + "$", 1)
    return paths.select(F.url_decode(part(2)).alias("jurisdiction"), F.url_decode(part(1)).alias("record_type"),
                        F.url_decode(part(0)).alias("file_name"))


def stored_files(paths: DataFrame) -> DataFrame:
    """(market, record_type, record_id) of stored document paths; a suffixed file proves its record too.
    A key ending in dash and capitals is listed both whole and cut."""
    named = stored_names(paths)
    name = F.regexp_extract("file_name", r"^[0-9]+-([^/]+)\.xml$", 1)
    cut = F.regexp_replace(name, r"-[A-Z]+$", "")
    return (named.select("jurisdiction", "record_type", F.explode(F.array_distinct(F.array(name, cut))).alias("record_id"))
            .filter("record_id <> ''").distinct())


def bucket_digests(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Number and combined hash of the rows in each bucket of their keys: ``buckets`` rows, however many there are."""
    h = F.xxhash64(*[x for k in keys for x in (F.col(k), F.col(k).isNull())])
    return rows.select(F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"), h.alias("h")).groupBy("bucket").agg(
        F.count("*").alias("n"), F.bit_xor("h").alias("x"))


def differences(sides: dict[str, DataFrame], keys: list[str], buckets: int = 4096) -> DataFrame:
    """Keys that not every side has, with a flag per side. Sides are compared by digests of buckets first; only the
    rows of buckets that differ are itemised, so equal sides cost one small aggregation each. A side holds each key once."""
    h = F.pmod(F.xxhash64(*[x for k in keys for x in (F.col(k), F.col(k).isNull())]), F.lit(buckets)).cast("int")
    digests = [bucket_digests(df, keys, buckets).withColumn("side", F.lit(name)) for name, df in sides.items()]
    seen = reduce(DataFrame.unionByName, digests).groupBy("bucket").agg(
        F.count("*").alias("sides"), F.countDistinct("n", "x").alias("kinds"))
    odd = F.broadcast(seen.where((F.col("sides") < len(sides)) | (F.col("kinds") > 1)).select("bucket"))  # ``buckets`` rows at most
    listed = [df.select(*keys, h.alias("bucket"), F.lit(name).alias("side")).join(odd, "bucket", "left_semi") for name, df in sides.items()]
    found = reduce(DataFrame.unionByName, listed).groupBy(*keys).agg(F.collect_set("side").alias("_in"))
    return found.where(F.size("_in") < len(sides)).select(*keys, *[F.array_contains("_in", name).alias(name) for name in sides])


def store_breaks(log: DataFrame, manifest: DataFrame, paths: DataFrame) -> DataFrame:
    """Where the delivery log, the manifest and the files themselves disagree, by market, record type and file name (record key for
    receipts without a manifest entry)."""
    entry = ["jurisdiction", "record_type", "record_key"]
    filed = differences({"logged": log.select(*entry).distinct(), "listed": manifest.select(*entry).distinct()}, entry)
    name = ["jurisdiction", "record_type", "file_name"]
    kept = differences({"listed": manifest.select(*name).distinct(), "stored": stored_names(paths).distinct()}, name)
    first = filed.select("jurisdiction", "record_type", c("record_key").alias("item"),
                         F.when(c("logged"), "NOT_LISTED").otherwise("NO_RECEIPT").alias("problem"))
    return first.unionByName(kept.select("jurisdiction", "record_type", c("file_name").alias("item"),
                                         F.when(c("listed"), "FILE_MISSING").otherwise("UNKNOWN_FILE").alias("problem")))


def completeness_breaks(expected: DataFrame, log: DataFrame, files: DataFrame) -> DataFrame:
    """Expected records without a receipt, or with one but no stored document."""
    receipts = log.groupBy("record_type", "record_key").agg(F.min("receipt_id").alias("receipt_id"))
    stored = files.select("jurisdiction", "record_type", "record_id").distinct().withColumn("_stored", F.lit(True))
    df = (expected.join(receipts, ["record_type", "record_key"], "left")
          .join(stored, ["jurisdiction", "record_type", "record_id"], "left"))
    problem = (F.when(c("receipt_id").isNull(), "NOT_SUBMITTED").when(c("_stored").isNull(), "FILE_MISSING"))
    return df.withColumn("problem", problem).filter(c("problem").isNotNull()).select(
        "jurisdiction", "record_type", "record_id", "receipt_id", "problem")


def active_markets(flows: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    df = flows if start is None else flows.filter((c("ts") >= start) & (c("ts") < end))
    return df.select("jurisdiction").distinct()
