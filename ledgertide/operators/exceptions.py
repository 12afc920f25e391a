"""Address checks, period readiness, retry state, the exception store and its gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import markets
from ..functions.scalars import add_minutes, local_date, matches

c = F.col
STATE = ["entity_type", "entity_id", "reason_code", "error_class", "attempt_count", "first_seen",
         "next_retry_at", "status"]


def validate_addresses(addresses: DataFrame, accounts: DataFrame, regions: DataFrame,
                       market: DataFrame) -> DataFrame:
    """Every address with its verdict. A malformed postcode (DATA) outranks a
    region that is not known yet (TRANSIENT). A prefix matches where a space follows
    it in the postcode; it may hold spaces itself. So each distinct postcode meets
    the regions by equality on what stands before each of its spaces."""
    known = regions.select(c("postcode_prefix").alias("_prefix"), "region_name")
    before_spaces = F.expr("transform(sequence(1, size(split(postcode, ' ')) - 1), i -> substring_index(postcode, ' ', i))")
    regional = (addresses.filter(F.contains("postcode", F.lit(" "))).select("postcode").distinct()
                .select("postcode", F.explode(F.array_distinct(before_spaces)).alias("_prefix"))
                .join(known, "_prefix").select("postcode", "region_name"))
    rules = market.select("jurisdiction", "postcode_pattern", "region_required")
    df = (addresses.join(accounts.select("account_id", "jurisdiction"), "account_id")
          .join(rules, "jurisdiction", "left").join(regional, "postcode", "left"))
    valid = F.coalesce(F.when(c("postcode_pattern").isNotNull(),
                              matches(c("postcode"), c("postcode_pattern"))).otherwise(True), F.lit(True))
    missing = F.coalesce("region_required", F.lit(False)) & c("region_name").isNull()
    df = df.withColumn("postcode_valid", valid)
    return df.select(
        "account_id", "jurisdiction", "postcode", "region_name", "postcode_valid",
        F.when(~c("postcode_valid"), "postcode_format").when(missing, "region_not_found").alias("fail_reason"),
        F.when(~c("postcode_valid"), "DATA").when(missing, "TRANSIENT").alias("error_class"))


def terminal_periods(lifecycle: DataFrame, accounts: DataFrame, market: DataFrame) -> DataFrame:
    """(account, market, local date) of every terminal slip."""
    df = (lifecycle.filter("slip_status in ('SETTLED', 'VOIDED')")
          .join(accounts.select("account_id", "jurisdiction"), "account_id")
          .join(market.select("jurisdiction", "timezone"), "jurisdiction"))
    day = local_date(F.coalesce("settled_at", "voided_at"), c("timezone"))
    return df.select("account_id", "jurisdiction", day.alias("report_date"))


def period_readiness(periods: DataFrame, watermarks: DataFrame, market: DataFrame) -> DataFrame:
    """A period is closed once the market's settlement feed is complete through a
    later local date. No watermark: not ready."""
    closed = (watermarks.filter("source = 'bet_settlement'")
              .join(market.select("jurisdiction", "timezone"), "jurisdiction")
              .select("jurisdiction", local_date(c("complete_through"), c("timezone")).alias("_through")))
    return (periods.select("jurisdiction", "report_date").distinct()
            .join(closed, "jurisdiction", "left")
            .select("jurisdiction", "report_date",
                    F.coalesce(c("_through") > c("report_date"), F.lit(False)).alias("is_ready")))


def calendar(days: DataFrame) -> DataFrame:
    """Days per market as a bitmap: 64 days in a word. One row for each configured market, whose words
    are bounded by the calendar, so it may be broadcast beside any number of facts."""
    n = F.unix_date("report_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(n, F.lit(64)).cast("int"))
    words = (days.filter(c("jurisdiction").isin(list(markets.MARKETS)) & c("report_date").isNotNull())
             .groupBy("jurisdiction", F.floor(n / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("mask")))
    return F.broadcast(words.groupBy("jurisdiction").agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("_days")))


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows whose (jurisdiction, report_date) is among ``days``, looked up in the bitmap row by row: no shuffle of ``rows``."""
    n = F.unix_date("report_date")
    mask = F.try_element_at("_days", F.floor(n / 64).cast("int"))
    bit = F.call_function("shiftright", mask, F.pmod(n, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    return rows.join(calendar(days), "jurisdiction").filter(bit == 1).select(*[rows[x] for x in rows.columns])


def backoff_minutes(attempt: Column) -> Column:
    return F.lit(markets.BACKOFF_MINUTES) * F.pow(F.lit(2), attempt - 1)


def retry_step(addresses: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """Next retry state from this run's transient failures and the stored state.

    An attempt counts when the failure is new or its retry is due. The next retry
    is set from now on every run; a stored failure that no longer shows is RESOLVED.
    """
    current = addresses.filter("error_class = 'TRANSIENT'").select(
        c("account_id").alias("entity_id"), c("fail_reason").alias("reason_code"),
        F.lit(True).alias("_failing"))
    both = current.join(state, ["entity_id", "reason_code"], "full_outer")
    failing = c("_failing").isNotNull()
    due = c("entity_type").isNull() | (now >= c("next_retry_at"))
    attempts = (F.coalesce("attempt_count", F.lit(0))
                + F.when(failing & F.coalesce(due, F.lit(False)), 1).otherwise(0)).cast("int")
    stepped = both.withColumn("_attempts", attempts)
    spent = c("_attempts") > markets.MAX_ATTEMPTS
    return stepped.select(
        F.coalesce("entity_type", F.lit("ADDRESS")).alias("entity_type"), "entity_id", "reason_code",
        F.when(failing, "TRANSIENT").otherwise(c("error_class")).alias("error_class"),
        c("_attempts").alias("attempt_count"),
        F.coalesce("first_seen", now).alias("first_seen"),
        F.when(failing & ~spent, add_minutes(now, backoff_minutes(c("_attempts")))).alias("next_retry_at"),
        F.when(~failing, "RESOLVED").when(spent, "QUARANTINED").otherwise("RETRYING").alias("status"))


def resolved_failures(addresses: DataFrame, state: DataFrame) -> DataFrame:
    """Stored failures that this run does not show any more."""
    current = addresses.filter("error_class = 'TRANSIENT'").select(
        c("account_id").alias("entity_id"), c("fail_reason").alias("reason_code"))
    return (state.join(current, ["entity_id", "reason_code"], "left_anti")
            .select("entity_type", "entity_id", "reason_code", "attempt_count", "first_seen",
                    F.lit("RESOLVED").alias("status")))


def compliance_hold(kind: str, breaches: DataFrame) -> DataFrame:
    """One row per account that has a breach of this kind."""
    return breaches.select("account_id", F.lit(kind).alias("breach")).distinct()


def exception_store(addresses: DataFrame, next_state: DataFrame, periods: DataFrame, readiness: DataFrame,
                    holds: DataFrame) -> DataFrame:
    """All withheld entities: bad data, waiting retries, open periods, breaches."""
    nil_day, nil_n = F.lit(None).cast("date"), F.lit(None).cast("int")
    nil_ts = F.lit(None).cast("timestamp")

    def rows(df, scope, kind, account, day, reason, klass, severity, status, tries, retry, detail):
        return df.select(
            F.lit(scope).alias("block_scope"), F.lit(kind).alias("entity_type"),
            c(account).alias("entity_id"), c(account).alias("account_id"), day.alias("report_date"),
            reason.alias("reason_code"), F.lit(klass).alias("error_class"),
            F.lit(severity).alias("severity"), status.alias("status"), tries.alias("attempt_count"),
            retry.alias("next_retry_at"), F.lit(detail).alias("detail"))
    bad = rows(addresses.filter("error_class = 'DATA'"), "ACCOUNT", "ADDRESS", "account_id", nil_day,
               F.lit("postcode_format"), "DATA", "ERROR", F.lit("QUARANTINED"), nil_n, nil_ts,
               "postcode does not fit the market")
    retrying = rows(next_state.filter("status in ('RETRYING', 'QUARANTINED')"), "ACCOUNT", "ADDRESS",
                    "entity_id", nil_day, c("reason_code"), "TRANSIENT", "WARNING", c("status"),
                    c("attempt_count"), c("next_retry_at"), "region not known yet")
    unready = readiness.filter("not is_ready").select("jurisdiction", "report_date")
    waiting = rows(on_days(periods, unready), "PERIOD", "PERIOD", "account_id",
                   c("report_date"), F.lit("period_not_complete"), "COMPLETENESS", "WARNING",
                   F.lit("WAITING_DATA"), nil_n, nil_ts, "feed not complete through the period")
    held = rows(holds, "ACCOUNT", "COMPLIANCE", "account_id", nil_day, c("breach"), "COMPLIANCE",
                "CRITICAL", F.lit("HELD"), nil_n, nil_ts, "compliance breach")
    return bad.unionByName(retrying).unionByName(waiting).unionByName(held)


def blocked_accounts(store: DataFrame) -> DataFrame:
    return (store.filter("block_scope = 'ACCOUNT' and status in ('QUARANTINED', 'RETRYING', 'HELD')")
            .select("account_id").distinct())


def isolation_breaches(file: DataFrame, lifecycle: DataFrame, store: DataFrame) -> DataFrame:
    """Filed slips that should have been withheld; must be empty. An account-wide
    block counts for every slip, an open period only for slips of that date: an
    account may have closed and open periods at once. The file is read once, both kinds of block meet it on the account."""
    owner = file.select("slip_id", "report_date").join(lifecycle.select("slip_id", "account_id"), "slip_id")
    whole = blocked_accounts(store).withColumn("_blocked", F.lit(True))
    periods = store.filter("block_scope = 'PERIOD'").select("account_id", "report_date").distinct().withColumn("_open", F.lit(True))
    met = owner.join(whole, "account_id", "left").join(periods, ["account_id", "report_date"], "left")
    return met.filter(F.coalesce("_blocked", "_open", F.lit(False))).select("slip_id", "account_id").distinct()


class GateClosed(RuntimeError):
    """Violations were found, so nothing is published."""


def run_gate(checks: dict[str, DataFrame]) -> dict[str, int]:
    """Counts all checks in one job; raises when any has a violation. Only the
    counts reach the driver, one row per check."""
    counted = [df.select(F.lit(name).alias("check_name")) for name, df in checks.items()]
    rows = reduce(DataFrame.unionByName, counted).groupBy("check_name").count().collect()
    failed = {r["check_name"]: r["count"] for r in rows}
    if failed:
        raise GateClosed(", ".join(f"{k}: {v}" for k, v in sorted(failed.items())))
    return {name: 0 for name in checks}
