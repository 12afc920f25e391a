"""Check SQL per registered query: a chain of relations and a final select."""

from __future__ import annotations

import re

from .. import markets
from . import oracle_documents, oracle_models  # noqa: F401  (fill CTES)
from .derive import RUN_TS, SPLIT_PLAYERS, SPLIT_ROUNDS
from .oracle_feeds import CTES, text
from .oracle_models import civil, day, norm, valid_on
from ..operators import cdc, document_formats

def _round_lists(size: int) -> str:
    return f"""SELECT session_id, game, part, string_agg(round_id, ',' ORDER BY round_ts, round_id) AS round_ids,
        player AS account_id, first_played_at, last_played_at, played AS rounds, rounds_won, parts
        FROM ({oracle_documents.round_parts(size)}) GROUP BY ALL"""


def _filings(size: int) -> str:
    return f"""SELECT jurisdiction, register_id || '-' || strftime(period_start, '%Y-%m-%d') || {oracle_documents.MARK} AS record_key, part, parts, players,
        CAST(count(*) AS INTEGER) AS listed, CAST(sum(stake_sum) AS DOUBLE) AS stake_sum, arg_min(player_ref, account_id) AS first_player
        FROM ({oracle_documents.filing_parts(size)}) GROUP BY jurisdiction, register_id, period_start, part, parts, players"""


FINAL: dict[str, str] = {}


def out(relation: str, columns: str) -> str:
    """Final select; a column suffixed :d is given as double, :i as bigint."""
    cast = {"d": "DOUBLE", "i": "BIGINT"}
    parts = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        parts.append(f"CAST({name} AS {cast[kind]}) AS {name}" if kind else name)
    source = f"({relation})" if relation.lstrip().upper().startswith(("SELECT", "FROM", "WITH")) else relation
    return f"SELECT {', '.join(parts)} FROM {source}"


def compose(sql: str) -> str:
    """``sql`` with the relations it needs in front, in dependency order."""
    order: list[str] = []

    def need(body: str, own: str | None = None) -> None:
        for name in sorted(set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", body)) & CTES.keys()):
            if name != own and name not in order:
                need(CTES[name], name)
                order.append(name)
    need(sql)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + sql


# ---- models as they stand ----------------------------------------------------

FINAL.update({
    "stg_accounts": out("stg_accounts", "account_id jurisdiction national_id date_of_birth kyc_status opened_at"),
    "stg_bet_slips": out("stg_bet_slips", "slip_id account_id fixture_id product"),
    "stg_bet_slip_events": out("stg_bet_slip_events", "slip_id event_type event_ts stake:d payout:d"),
    "stg_fixtures": out("stg_fixtures", "fixture_id sport_name_raw competition_raw home_raw away_raw start_ts"),
    "stg_reg_attributes": out("stg_reg_attributes", "entity_type entity_id attr_name attr_value"),
    "stg_games": out("stg_games", "game_id game_name provider provider_game_ref game_type_raw"),
    "stg_poker_activity": out("stg_poker_activity", "activity_id account_id game_id kind amount_in:d amount_out:d "
                              "rake_or_fee:d session_id activity_ts"),
    "stg_operator_jackpot_contributions": out(
        "stg_operator_jackpot_contributions", "contribution_id account_id jackpot_id game_id trigger_type trigger_ref "
        "amount:d session_id contributed_at"),
    "stg_operator_jackpot_wins": out("stg_operator_jackpot_wins", "win_id jackpot_id account_id game_id amount:d session_id win_ts"),
    "stg_gaming_sessions": out("stg_gaming_sessions", "session_id account_id started_at last_activity_ts ended_at end_reason"),
    "stg_player_limits": out("stg_player_limits", "limit_id account_id limit_type amount:d set_at revoked_at"),
    "stg_self_exclusions": out("stg_self_exclusions", "exclusion_id account_id source start_ts end_ts"),
    "stg_verifications": out("stg_verifications", "verification_id account_id check_type status event_ts"),
    "stg_payments": out("stg_payments", "payment_id account_id direction amount:d method status requested_ts completed_ts"),
    "stg_account_addresses": out("stg_account_addresses", "account_id postcode city"),
    "stg_jackpot_optins": out("stg_jackpot_optins", "optin_id account_id jackpot_id opted_in_at opted_out_at"),
    "dim_account": out("stg_accounts", "account_id jurisdiction national_id date_of_birth kyc_status opened_at"),
    "fct_lifecycle": out("fct_lifecycle", "slip_id account_id fixture_id placed_at settled_at voided_at slip_status stake:d payout:d"),
    "dim_fixture": out("dim_fixture", "fixture_id start_ts sport_name_raw canonical_sport competition_name home_name "
                       "away_name home_participant_id away_participant_id"),
    "dim_game": out("dim_game", "game_id game_name provider game_type_raw canonical_game_type"),
    "unmapped_sports": out("unmapped_sports", "sport_name_raw fixtures_affected slips_affected first_seen last_seen"),
    "unmapped_game_types": out("unmapped_game_types", "game_type_raw provider games_affected activities_affected"),
    "stg_rounds": out("stg_rounds", "round_id provider account_id game_id wager:d payout:d jackpot_contribution:d jackpot_id session_id round_ts"),
    "fct_contributions": out("fct_contributions", "contribution_id account_id jackpot_id game_id trigger_type trigger_ref amount:d "
                             "session_id contributed_at status"),
    "fct_activity": out("fct_activity", "activity_id account_id game_id vertical stake:d payout:d rake_or_fee:d "
                        "jackpot_contribution:d jackpot_id session_id occurred_at"),
    "pool_liability": out("pool_liability", "jackpot_id jackpot_name seed_amount:d contribution_rate:d total_contributions:d total_wins:d pool_balance:d"),
    "operator_pool_liability": out("operator_pool_liability", "jackpot_id jackpot_name seed_amount:d total_contributions:d total_wins:d pool_balance:d"),
    "platform_sessions": out("platform_sessions", "session_id account_id started_at last_activity_ts ended_at end_reason plays "
                             "staked:d won:d first_play_ts last_play_ts"),
    "session_activity": out("session_activity", "activity_id account_id session_id game_session_id game_id stake:d payout:d occurred_at"),
    "game_sessions": out("game_sessions", "game_session_id session_id account_id game_id started_at ended_at rounds rounds_won staked:d won:d"),
    "platform_session_file": out("platform_session_file", "jurisdiction report_date session_id account_id started_at_local "
                                 "ended_at_local end_reason plays staked:d won:d"),
    "game_session_file": out("game_session_file", "jurisdiction report_date game_session_id session_id account_id game_id game_name "
                             "started_at_local ended_at_local end_reason rounds rounds_won staked:d won:d"),
    "fct_payments": out("fct_payments", "payment_id account_id jurisdiction direction amount:d method status requested_ts completed_ts"),
    "fct_gambling": out("fct_gambling", "account_id jurisdiction occurred_at stake:d payout:d source"),
    "fct_ledger": out("fct_ledger", "account_id ref ts entry_type signed_amount:d"),
    "dim_balance": out("dim_balance", "account_id jurisdiction balance:d"),
    "dim_compliance": out("dim_compliance", "account_id jurisdiction verification_status verification_ts open_exclusion_source "
                          "personal_daily_limit:d personal_weekly_limit:d personal_monthly_limit:d"),
    "deposit_limits": out("deposit_limits", "account_id jurisdiction period personal_limit:d default_limit:d effective_limit:d"),
    "breach_deposit_limits": out("breach_deposit_limits", "account_id jurisdiction period window_start deposited:d effective_limit:d"),
    "breach_loss_limits": out("breach_loss_limits", "account_id jurisdiction period window_start net_loss:d loss_limit:d"),
    "breach_activity_while_excluded": out("breach_activity_while_excluded", "account_id exclusion_source activity_type activity_ref activity_ts"),
    "breach_unverified_withdrawals": out("breach_unverified_withdrawals", "payment_id account_id jurisdiction amount:d completed_ts"),
    "breach_wallet_overspend": out("breach_wallet_overspend", "account_id ts entry_type signed_amount:d running_balance:d"),
    "breach_stake_limits": out("breach_stake_limits", "activity_id account_id jurisdiction vertical stake:d effective_limit:d occurred_at"),
    "addresses": out("addresses", "account_id jurisdiction postcode region_name postcode_valid fail_reason error_class"),
    "terminal_periods": out("terminal_periods", "account_id jurisdiction report_date"),
    "readiness": out("readiness", "jurisdiction report_date is_ready"),
    "retry_state": out("retry_state", "entity_type entity_id reason_code error_class attempt_count first_seen next_retry_at status"),
    "holds": out("holds", "account_id breach"),
    "fct_exceptions": """SELECT block_scope, entity_type, account_id AS entity_id, account_id, report_date, reason_code, error_class,
        severity, status, attempt_count, next_retry_at,
        CASE error_class WHEN 'DATA' THEN 'postcode does not fit the market' WHEN 'TRANSIENT' THEN 'region not known yet'
             WHEN 'COMPLETENESS' THEN 'feed not complete through the period' ELSE 'compliance breach' END AS detail FROM fct_exceptions""",
    "betting_tax": out("betting_tax", "jurisdiction report_date settled_slips total_stake:d total_payout:d tax_due:d"),
    "registers": out("registers", "jurisdiction register_id period_start player_ref bets_settled stake_sum:d winnings_sum:d ggr_sum:d"),
    "gaming_tax": out("gaming_tax", "jurisdiction report_date activities total_stake:d total_payout:d total_ggr:d gaming_tax_due:d"),
})
FINAL["lifecycle_from_staging"] = FINAL["fct_lifecycle"]
MONEY_COLUMNS = {"stake", "payout", "ggr", "rake_or_fee", "gaming_ggr", "winnings_withholding_tax"}


def _typed(columns: list[str]) -> str:
    return " ".join(n + (":d" if n in MONEY_COLUMNS else "") for n in columns)


BETTING_COLUMNS = ["slip_id", "account_id", "slip_status", "player_dni_hash", "stake", "payout", "ggr", "placed_at_local",
                   "settled_at_local", "sport_code", "event_name", *markets.HASH_NAMES, "winnings_withholding_tax", *markets.CARRIED]
GAMING_COLUMNS = ["activity_id", "account_id", "player_dni_hash", "game_name", "vertical", "stake", "payout", "rake_or_fee",
                  "occurred_at_local", "game_code", "gaming_ggr"]
FINAL["betting_file"] = out("betting_file", "jurisdiction report_date " + _typed(BETTING_COLUMNS))
FINAL["gaming_file"] = out("gaming_file", "jurisdiction report_date " + _typed(GAMING_COLUMNS))
for _m in markets.MARKETS:
    _cols = [*markets.BETTING_FILES[_m], *markets.EXTENSIONS.get(_m, [])]
    FINAL[f"betting_file_{_m.lower()}"] = out("betting_file", "jurisdiction report_date " + _typed(_cols)) + f" WHERE jurisdiction = '{_m}'"
for _m, _cols in markets.GAMING_FILES.items():
    FINAL[f"gaming_file_{_m.lower()}"] = out("gaming_file", "jurisdiction report_date " + _typed(_cols)) + f" WHERE jurisdiction = '{_m}'"
for _feed, _prefix in {"netent_rounds": "NE", "evolution_transactions": "EV", "playtech_rounds": "PT", "aggregator_rounds": "AG"}.items():
    FINAL[f"rounds_{_feed}"] = FINAL["stg_rounds"] + f" WHERE round_id LIKE '{_prefix}:%'"

# ---- references --------------------------------------------------------------

CTES["open_file"] = CTES["betting_file"].replace("FROM admissible s", "FROM reportable s")
CTES["open_registers"] = CTES["registers"].replace("FROM admissible", "FROM reportable")
_coded = f"""SELECT r.*, f.canonical_sport, k.regulator_code FROM reportable r LEFT JOIN dim_fixture f ON f.fixture_id = r.fixture_id
    LEFT JOIN map_sport k ON k.jurisdiction = r.jurisdiction AND k.canonical_sport = f.canonical_sport AND {valid_on('r.report_date', 'k')}"""
CTES["coded_slips"] = _coded
CTES["coded_plays"] = f"""SELECT g.*, d.canonical_game_type, k.regulator_code FROM gaming_reportable g LEFT JOIN dim_game d ON d.game_id = g.game_id
    LEFT JOIN map_game k ON k.jurisdiction = g.jurisdiction AND k.canonical_game_type = d.canonical_game_type AND {valid_on('g.report_date', 'k')}"""
_landing = {"accounts": "cdc_accounts", "bet_slip_events": "cdc_bet_slip_events", "fixtures": "cdc_fixtures",
            "reg_attributes": "cdc_reg_attributes", "poker_activity": "cdc_poker_activity",
            "operator_jackpot_contributions": "cdc_operator_jackpot_contributions", "gaming_sessions": "cdc_gaming_sessions"}
_newest = {
    "bet_slips": "SELECT placed_at + (CASE i WHEN 1 THEN INTERVAL 1 MINUTE ELSE INTERVAL 0 MINUTE END) AS t FROM d_orders CROSS JOIN range(2) r(i) WHERE i = 0 OR k % 13 = 0",
    "games": "SELECT TIMESTAMP '2019-01-01' AS t FROM cdc_games",
    "operator_jackpot_wins": "SELECT win_ts AS t FROM stg_operator_jackpot_wins",
    "player_limits": "SELECT set_at AS t FROM stg_player_limits", "self_exclusions": "SELECT start_ts AS t FROM stg_self_exclusions",
    "verifications": "SELECT event_ts AS t FROM stg_verifications", "payments": "SELECT requested_ts AS t FROM cdc_payments",
    "account_addresses": "SELECT opened_at AS t FROM d_customers", "jackpot_optins": "SELECT opted_in_at AS t FROM stg_jackpot_optins"}
FINAL["landing_scan"] = " UNION ALL ".join(
    f"SELECT '{f}' AS feed, count(*) AS images, max(t) AS newest FROM ("
    + (_newest[f] if f in _newest else f"SELECT _commit_ts AS t FROM {_landing[f]}") + ")" for f in cdc.STAGING)
_all_sport_codes = [(m, code) for m in markets.MARKETS for code in markets.code_set(
    markets.SPORT_CODES, [(p[0], p[1]) for p in markets.SPORT_POLICY], m)]
_all_game_codes = [(m, code) for m in markets.GAMING_FILES for code in markets.code_set(markets.GAME_CODES, markets.GAME_POLICY, m)]
CTES["sport_code_list"] = "SELECT * FROM (VALUES " + ", ".join(f"({text(a)}, {text(b)})" for a, b in _all_sport_codes) + ") v(jurisdiction, code)"
CTES["game_code_list"] = "SELECT * FROM (VALUES " + ", ".join(f"({text(a)}, {text(b)})" for a, b in _all_game_codes) + ") v(jurisdiction, code)"

FINAL.update({
    "market_players": """SELECT jurisdiction, timezone, currency, tax_basis, include_voided, count(*) AS accounts
        FROM stg_accounts JOIN market USING (jurisdiction) GROUP BY ALL""",
    "sport_alias_use": f"""SELECT {norm('sport_name_raw')} AS alias_norm, a.canonical,
        CASE a.canonical {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in markets.SPORTS)} END AS name, count(*) AS fixtures
        FROM stg_fixtures LEFT JOIN sport_alias a ON a.n = {norm('sport_name_raw')} GROUP BY ALL""",
    "participant_alias_use": f"""SELECT home_raw, canonical_id AS participant_id, canonical_name AS participant, count(*) AS fixtures
        FROM stg_fixtures LEFT JOIN team_alias ON n = {norm('home_raw')} GROUP BY ALL""",
    "game_alias_use": "SELECT game_type_raw, canonical_game_type AS canonical, count(*) AS games FROM dim_game GROUP BY ALL",
    "sport_code_on_date": """SELECT jurisdiction, canonical_sport, regulator_code, count(*) AS slips, min(report_date) AS first_date,
        max(report_date) AS last_date FROM coded_slips GROUP BY ALL""",
    "game_code_on_date": "SELECT jurisdiction, canonical_game_type, regulator_code, count(*) AS plays FROM coded_plays GROUP BY ALL",
    "stake_bands_met": f"""SELECT b.jurisdiction, CAST(max_stake AS DOUBLE) AS max_stake, min_age, max_age, valid_from, valid_to, count(*) AS players
        FROM bands b JOIN stg_accounts a ON a.jurisdiction = b.jurisdiction
        AND floor((DATE '{RUN_TS[:10]}' - date_of_birth) / 365.2425) BETWEEN min_age AND coalesce(max_age, 999) GROUP BY ALL""",
    "rate_on_date": f"""SELECT t.jurisdiction, CAST(date_trunc('month', report_date) AS DATE) AS month, CAST(rate AS DOUBLE) AS rate, count(*) AS days
        FROM (SELECT DISTINCT jurisdiction, report_date FROM reportable) t
        LEFT JOIN betting_rates r ON r.jurisdiction = t.jurisdiction AND {valid_on('report_date', 'r')} GROUP BY ALL""",
    "published_codes_used": """SELECT l.jurisdiction, l.code AS regulator_code, count(slip_id) AS slips FROM sport_code_list l
        LEFT JOIN (SELECT c.slip_id, c.jurisdiction, coalesce(c.regulator_code, p.default_sport_code) AS code
                   FROM coded_slips c JOIN sport_policy p USING (jurisdiction)) u USING (jurisdiction, code) GROUP BY ALL""",
    "normalised_text": f"""SELECT raw, count(*) AS uses, {norm('raw')} AS normalised
        FROM (SELECT unnest([sport_name_raw, home_raw, away_raw]) AS raw FROM cdc_fixtures) GROUP BY raw""",
    "event_names": """SELECT fixture_id, event_template, replace(replace(event_template, '{home}', home_name), '{away}', away_name) AS event_name
        FROM dim_fixture CROSS JOIN (SELECT DISTINCT event_template FROM sport_policy)""",
    # core, gaming
    "slip_status_by_rank": """SELECT slip_id, CASE WHEN bool_or(event_type = 'VOIDED') THEN 'VOIDED' WHEN bool_or(event_type = 'SETTLED')
        THEN 'SETTLED' ELSE 'OPEN' END AS slip_status FROM stg_bet_slip_events GROUP BY 1""",
    "platform_balance": """SELECT account_id, CAST(sum(v) AS DOUBLE) AS balance FROM (
        SELECT account_id, if(direction = 'DEPOSIT', amount, -amount) AS v FROM stg_payments WHERE status = 'COMPLETED'
        UNION ALL SELECT account_id, payout - stake FROM fct_lifecycle WHERE slip_status <> 'VOIDED'
        UNION ALL SELECT account_id, if(funding = 'CASH', payout - stake, payout) FROM play_rounds) GROUP BY 1""",
    "front_door_limits": "SELECT account_id, " + ", ".join(
        f"CAST(min(amount) FILTER (limit_type = '{f}_{p}') AS DOUBLE) AS {f.lower()}_{p.lower()}"
        for f in ("DEPOSIT", "LOSS") for p in ("DAILY", "WEEKLY", "MONTHLY"))
        + " FROM stg_player_limits WHERE revoked_at IS NULL GROUP BY 1",
    "gaming_revenue_by_vertical": "SELECT jurisdiction, vertical, count(*) AS plays, CAST(sum(revenue) AS DOUBLE) AS ggr FROM gaming_reportable GROUP BY ALL",
    "reseeding_pool": f"""SELECT '{markets.POOL_GAME}' AS game, CAST(coalesce(sum(stake), 0) AS DOUBLE) AS contributions,
        CAST(coalesce(sum(payout), 0) AS DOUBLE) AS wins_paid, count(*) FILTER (payout > 0) AS win_count,
        CAST({markets.POOL_SEED} * (1 + count(*) FILTER (payout > 0)) + coalesce(sum(stake), 0) - coalesce(sum(payout), 0) AS DOUBLE) AS pool
        FROM play_rounds WHERE game = '{markets.POOL_GAME}'""",
    "contribution_rate_breaks": out("""SELECT round_id, jackpot_id, wager, jackpot_contribution, contribution_rate
        FROM stg_rounds JOIN jackpot_pools USING (jackpot_id) WHERE abs(jackpot_contribution - wager * contribution_rate) > 0.005""",
                                    "round_id jackpot_id wager:d jackpot_contribution:d contribution_rate:d"),
    "wallet_pool_check": """SELECT CAST(w AS DOUBLE) AS wallet_debits, CAST(p AS DOUBLE) AS pool_contributions, CAST(w - p AS DOUBLE) AS difference
        FROM (SELECT (SELECT -sum(signed_amount) FROM fct_ledger WHERE entry_type = 'JACKPOT_CONTRIBUTION') AS w,
                     (SELECT sum(amount) FROM fct_contributions WHERE status = 'ACTIVE') AS p)""",
    "bonus_winnings": """SELECT round_id, account_id, CAST(stake AS DOUBLE) AS stake, CAST(payout AS DOUBLE) AS payout,
        CAST(greatest(payout - stake, 0) AS DOUBLE) AS winnings FROM play_rounds WHERE funding = 'GOLDEN_CHIP'""",
    "implied_contributions": f"""SELECT round_id, account_id, optin_id, CAST(stake AS DOUBLE) AS stake, CAST(round(stake * {markets.POOL_RATE}, 2) AS DOUBLE) AS contribution
        FROM play_rounds JOIN stg_jackpot_optins USING (account_id) WHERE funding = 'CASH' AND game <> '{markets.POOL_GAME}'
        AND round_ts >= opted_in_at AND (opted_out_at IS NULL OR round_ts < opted_out_at) AND round(stake * {markets.POOL_RATE}, 2) > 0""",
    # sessions
    "sessions_timed_out": f"""SELECT session_id, account_id, jurisdiction, started_at, last_activity_ts,
        coalesce(ended_at, CASE WHEN last_activity_ts + to_minutes(timeout_minutes) < TIMESTAMP '{RUN_TS}' THEN last_activity_ts + to_minutes(timeout_minutes) END) AS ended_at,
        CASE WHEN ended_at IS NULL AND last_activity_ts + to_minutes(timeout_minutes) < TIMESTAMP '{RUN_TS}' THEN 'INACTIVITY' ELSE end_reason END AS end_reason
        FROM stg_gaming_sessions JOIN stg_accounts USING (account_id) JOIN market USING (jurisdiction)""",
    "activity_sessions": """SELECT account_id, session_no, min(t) AS started_at, max(t) AS last_activity_ts, count(*) AS activities FROM (
        SELECT account_id, t, CAST(sum(fresh) OVER (PARTITION BY account_id ORDER BY t, payment_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
        FROM (SELECT account_id, payment_id, requested_ts AS t,
              CASE WHEN lag(requested_ts) OVER w IS NULL OR requested_ts > lag(requested_ts) OVER w + INTERVAL 8 HOUR THEN 1 ELSE 0 END AS fresh
              FROM cdc_payments WINDOW w AS (PARTITION BY account_id ORDER BY requested_ts, payment_id))) GROUP BY 1, 2""",
    "session_round_lists": _round_lists(10_000),
    "split_session_round_lists": _round_lists(SPLIT_ROUNDS),
    "session_events": """SELECT session_id, account_id, if(t.tipo = 'LOGIN', started_at, ended_at) AS at, t.tipo
        FROM stg_gaming_sessions CROSS JOIN (VALUES ('LOGIN'), ('LOGOUT')) t(tipo) WHERE ended_at IS NOT NULL""",
    "session_total_breaks": """SELECT session_id FROM (SELECT * FROM platform_sessions WHERE plays > 0) p
        FULL JOIN (SELECT session_id, sum(rounds) AS r, sum(staked) AS s, sum(won) AS w FROM game_sessions GROUP BY 1) g USING (session_id)
        WHERE plays IS DISTINCT FROM r OR staked IS DISTINCT FROM s OR p.won IS DISTINCT FROM w""",
    # files
    "filed_slips": """SELECT jurisdiction, report_date, slip_status, count(*) AS slips FROM reportable
        WHERE slip_status = 'SETTLED' OR include_voided GROUP BY ALL""",
    "carried_attributes": "SELECT slip_id, " + ", ".join(markets.CARRIED) + " FROM attributes",
    "winnings_withholding": "SELECT slip_id, CAST(payout AS DOUBLE) AS payout, " + ", ".join(
        "CASE WHEN jurisdiction = 'GR' THEN CAST(round(" + " + ".join(f"{r} * greatest({f'least({p}, {hi})' if hi else p} - {lo}, 0)" for _, lo, hi, r in markets.WITHHOLDING)
        + f", 2) AS DOUBLE) END AS {n}" for p, n in (("payout", "tax"), ("(payout * 10)", "tax_on_tenfold")))
        + " FROM reportable",
    "vertical_tax": """SELECT b.jurisdiction, CAST(sum(stake) AS DOUBLE) AS total_stake, CAST(round(sum(stake * coalesce(rate, 0)), 2) AS DOUBLE) AS tax_due
        FROM settled_bets b LEFT JOIN vertical_rates r USING (jurisdiction, vertical)
        WHERE b.jurisdiction IN (SELECT jurisdiction FROM vertical_rates) GROUP BY 1""",
    "plain_submission": f"""SELECT jurisdiction, {day('settled_at')} AS report_date, bet_id, player_id, sha256(player_national_id) AS player_dni_hash,
        game_type, CAST(stake AS DOUBLE) AS stake, CAST(payout AS DOUBLE) AS payout, CAST(stake - payout AS DOUBLE) AS ggr, settled_at
        FROM settled_bets JOIN market USING (jurisdiction) WHERE NOT (jurisdiction = 'ES' AND game_type = 'free_spin')""",
    "settled_on_local_day": out(f"SELECT * FROM fct_lifecycle WHERE {day('settled_at', text('Europe/Madrid'))} = DATE '2023-03-26'",
                                "slip_id settled_at stake:d payout:d"),
    "market_fan_out": "SELECT jurisdiction, count(*) AS rows, CAST(CASE jurisdiction " + " ".join(
        f"WHEN '{k}' THEN {len(markets.BETTING_FILES[k]) + len(markets.EXTENSIONS.get(k, []))}" for k in markets.MARKETS)
        + " END AS INTEGER) AS columns FROM reportable WHERE slip_status = 'SETTLED' OR include_voided GROUP BY 1",
    "register_completeness": """SELECT jurisdiction, player_ref AS row_key, period_start
        FROM (SELECT * FROM registers WHERE register_id = 'RUT') m
        FULL JOIN (SELECT jurisdiction, player_ref, CAST(date_trunc('month', period_start) AS DATE) AS period_start, sum(bets_settled) AS n,
                   sum(stake_sum) AS s FROM registers WHERE register_id = 'RUD' GROUP BY 1, 2, 3) d USING (jurisdiction, player_ref, period_start)
        WHERE n IS NULL OR bets_settled IS NULL OR abs(n - bets_settled) > 0.005 OR abs(s - stake_sum) > 0.005""",
})
CTES["register_row_set"] = """
    SELECT jurisdiction, g.id AS register_id, CAST(date_trunc(g.unit, settled_at) AS TIMESTAMP) AS period_start,
           CAST(date_trunc(g.unit, settled_at) AS TIMESTAMP) + (CASE g.unit WHEN 'day' THEN INTERVAL 1 DAY ELSE INTERVAL 1 MONTH END) AS period_end,
           account_id, opened_at, count(*) AS bets_settled, sum(stake) AS stake_sum, sum(payout) AS winnings_sum, sum(stake - payout) AS ggr_sum,
           sha256(national_id) AS player_ref
    FROM fct_lifecycle JOIN stg_accounts USING (account_id) JOIN (VALUES ('ES', 'RUD', 'day'), ('ES', 'RUT', 'month')) g(jur, id, unit) ON g.jur = jurisdiction
    WHERE slip_status = 'SETTLED' GROUP BY ALL"""
FINAL.update({
    "register_rows": out("register_row_set", "jurisdiction register_id period_start period_end account_id opened_at bets_settled "
                         "stake_sum:d winnings_sum:d ggr_sum:d player_ref"),
    "register_filings": _filings(5000),
    "split_register_filings": _filings(SPLIT_PLAYERS),
    "daily_financial_summary": f"""SELECT a.jurisdiction, {day('g.occurred_at', 'm.timezone')} AS report_date, coalesce(d.canonical_game_type, 'UNMAPPED') AS game_type,
        CAST(sum(stake) AS DOUBLE) AS total_stakes, CAST(sum(payout) AS DOUBLE) AS total_winnings, CAST(sum(rake_or_fee) AS DOUBLE) AS total_commissions,
        CAST(0 AS DOUBLE) AS total_refunds FROM fct_activity g JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction)
        LEFT JOIN dim_game d ON d.game_id = g.game_id GROUP BY 1, 2, 3""",
    # protection
    "statutory_defaults": """SELECT jurisdiction, period, CAST(default_limit AS DOUBLE) AS default_limit, count(*) AS accounts, count(effective_limit) AS capped
        FROM deposit_limits GROUP BY 1, 2, 3""",
    "statutory_caps": f"""SELECT a.account_id, a.jurisdiction, CAST(floor((DATE '{RUN_TS[:10]}' - a.date_of_birth) / 365.2425) AS INTEGER) AS age,
        CAST(min(b.max_stake) AS DOUBLE) AS cap FROM stg_accounts a LEFT JOIN bands b ON b.jurisdiction = a.jurisdiction
        AND floor((DATE '{RUN_TS[:10]}' - a.date_of_birth) / 365.2425) BETWEEN b.min_age AND coalesce(b.max_age, 999)
        AND {valid_on(f"DATE '{RUN_TS[:10]}'", 'b')} GROUP BY 1, 2, 3""",
    "active_exclusions": """SELECT account_id, source FROM stg_self_exclusions WHERE start_ts <= TIMESTAMP '2022-09-01'
        AND (end_ts IS NULL OR end_ts > TIMESTAMP '2022-09-01')""",
})
SPAN_DAYS = {"DAILY": 1, "WEEKLY": 7, "MONTHLY": 30}


def _rolling(source: str, ref: str, ts: str, value: str, family: str) -> str:
    windows = " UNION ALL ".join(
        f"SELECT account_id, {ref}, {ts}, '{p}' AS period, sum({value}) OVER (PARTITION BY account_id ORDER BY {ts} "
        f"RANGE BETWEEN INTERVAL {d} DAY PRECEDING AND CURRENT ROW) AS window_total FROM ({source})" for p, d in SPAN_DAYS.items())
    limits = (f"SELECT account_id, replace(limit_type, '{family}_', '') AS period, min(amount) AS limit_amount FROM stg_player_limits "
              f"WHERE revoked_at IS NULL AND limit_type LIKE '{family}_%' GROUP BY 1, 2")
    return out(f"SELECT * FROM ({windows}) JOIN ({limits}) USING (account_id, period) WHERE window_total > limit_amount",
               f"account_id {ref} {ts} period window_total:d limit_amount:d")


CTES["loss_rows"] = """SELECT account_id, slip_id AS ref, settled_at AS ts, stake - payout AS net FROM fct_lifecycle WHERE slip_status = 'SETTLED'
    UNION ALL SELECT account_id, round_id, round_ts, stake - payout FROM play_rounds WHERE funding = 'CASH'"""
CTES["cap_breaks"] = f"""
    SELECT round_id, account_id, jurisdiction, game, stake, if(stake > personal, 'PERSONAL', 'STATUTORY') AS cap_kind,
           if(stake > personal, personal, statutory) AS cap
    FROM (SELECT r.round_id, r.account_id, a.jurisdiction, r.game, r.stake, c.personal, min(b.max_stake) AS statutory
          FROM play_rounds r JOIN stg_accounts a USING (account_id) LEFT JOIN stake_caps c ON c.account_id = r.account_id
          LEFT JOIN bands b ON b.jurisdiction = a.jurisdiction AND r.game = 'SLOTS'
            AND floor((CAST(r.round_ts AS DATE) - a.date_of_birth) / 365.2425) BETWEEN b.min_age AND coalesce(b.max_age, 999)
            AND {valid_on('CAST(r.round_ts AS DATE)', 'b')}
          GROUP BY r.round_id, r.account_id, a.jurisdiction, r.game, r.stake, r.round_ts, c.personal)
    WHERE stake > personal OR stake > statutory"""
CTES["cash_moves"] = """
    SELECT a.jurisdiction, p.account_id, p.payment_id AS ref, p.completed_ts AS ts, if(direction = 'DEPOSIT', amount, -amount) AS amount, direction AS kind
    FROM stg_payments p JOIN stg_accounts a USING (account_id) WHERE status = 'COMPLETED'
    UNION ALL SELECT jurisdiction, account_id, slip_id, placed_at, -stake, 'BET_STAKE' FROM slip_amounts WHERE placed_at IS NOT NULL
    UNION ALL SELECT jurisdiction, account_id, slip_id, settled_at, payout, 'BET_PAYOUT' FROM slip_amounts WHERE payout > 0
    UNION ALL SELECT jurisdiction, account_id, slip_id, voided_at, stake - CASE WHEN settled_at <= voided_at THEN payout ELSE 0 END, 'VOID_REFUND'
      FROM slip_amounts WHERE voided_at IS NOT NULL
    UNION ALL SELECT a.jurisdiction, r.account_id, r.round_id, r.round_ts, if(funding = 'CASH', payout - stake, payout), 'CASINO_NET'
      FROM play_rounds r JOIN stg_accounts a USING (account_id)"""
CTES["wager_rows"] = """
    SELECT slip_id AS wager_id, account_id, placed_at AS ts, stake, 0 AS net, FALSE AS casino, NULL AS game, 'CASH' AS funding FROM slip_amounts
    UNION ALL SELECT round_id, account_id, round_ts, stake, stake - payout, TRUE, game, funding FROM play_rounds"""
CTES["balance_before_wager"] = """
    SELECT ref AS wager_id, r - amount AS before FROM (
      SELECT *, sum(amount) OVER (PARTITION BY account_id ORDER BY ts, amount DESC, ref ROWS UNBOUNDED PRECEDING) AS r FROM cash_moves)
    WHERE kind IN ('BET_STAKE', 'CASINO_NET')"""
CTES["wager_reasons"] = f"""
    SELECT wager_id, account_id, ts, stake, 0 AS n FROM wager_rows WHERE stake <= 0
    UNION ALL SELECT w.wager_id, w.account_id, w.ts, w.stake, 1 FROM wager_rows w JOIN stg_self_exclusions x USING (account_id)
      WHERE w.ts >= x.start_ts AND (x.end_ts IS NULL OR w.ts < x.end_ts)
    UNION ALL SELECT wager_id, account_id, ts, stake, 2 FROM wager_rows WHERE funding <> 'CASH' AND game NOT IN ('BLACKJACK', 'POKER')
    UNION ALL SELECT w.wager_id, w.account_id, w.ts, w.stake, 3 FROM wager_rows w JOIN balance_before_wager b USING (wager_id)
      WHERE w.funding = 'CASH' AND w.stake + CASE WHEN w.casino AND EXISTS (FROM stg_jackpot_optins o
        WHERE o.account_id = w.account_id AND w.ts >= o.opted_in_at AND (o.opted_out_at IS NULL OR w.ts < o.opted_out_at))
        THEN round(w.stake * {markets.POOL_RATE}, 2) ELSE 0 END > b.before
    UNION ALL SELECT w.wager_id, w.account_id, w.ts, w.stake, 4 FROM wager_rows w JOIN loss_limits l USING (account_id)
      JOIN periods p ON p.period = l.period
      WHERE w.funding = 'CASH' AND w.stake + coalesce((SELECT sum(net) FROM loss_rows e WHERE e.account_id = w.account_id AND e.ts <= w.ts
        AND e.ts >= w.ts - to_days(CASE l.period WHEN 'DAILY' THEN 1 WHEN 'WEEKLY' THEN 7 ELSE 30 END)), 0) - w.net > l.lowest
    UNION ALL SELECT w.wager_id, w.account_id, w.ts, w.stake, 5 FROM wager_rows w WHERE w.wager_id IN (SELECT round_id FROM cap_breaks)"""
FINAL.update({
    "rolling_deposit_audit": _rolling("SELECT * FROM stg_payments WHERE direction = 'DEPOSIT' AND status = 'COMPLETED'",
                                      "payment_id", "completed_ts", "amount", "DEPOSIT"),
    "rolling_loss_audit": _rolling("SELECT * FROM loss_rows", "ref", "ts", "net", "LOSS"),
    "stakes_over_cap_then": out("""SELECT r.round_id, r.account_id, r.game, r.stake, r.round_ts, min(l.amount) AS personal_cap
        FROM play_rounds r JOIN stg_player_limits l ON l.account_id = r.account_id AND l.limit_type = 'STAKE_CASINO'
          AND r.round_ts >= l.set_at AND (l.revoked_at IS NULL OR r.round_ts < l.revoked_at)
        GROUP BY ALL HAVING r.stake > min(l.amount)""", "round_id account_id game stake:d round_ts personal_cap:d"),
    "stake_cap_audit": out("cap_breaks", "round_id account_id jurisdiction game stake:d cap_kind cap:d"),
    "wager_gate_audit": """SELECT wager_id, account_id, ts, CAST(stake AS DOUBLE) AS stake,
        list_extract(['NON_POSITIVE', 'EXCLUDED', 'BONUS_GAME', 'INSUFFICIENT_BALANCE', 'LOSS_LIMIT', 'STAKE_CAP'], min(n) + 1) AS reason
        FROM wager_reasons GROUP BY wager_id, account_id, ts, stake""",
    # exceptions
    "postcode_verdicts": "SELECT jurisdiction, postcode_valid, fail_reason, count(*) AS addresses FROM addresses GROUP BY ALL",
    "postcode_region_matches": "SELECT account_id, postcode, region_name FROM addresses WHERE region_name IS NOT NULL",
    "resolved_failures": "SELECT entity_type, entity_id, reason_code, attempt_count, first_seen, status FROM resolved_rows",
    "backoff_schedule": f"""SELECT entity_id, attempt_count, CAST({markets.BACKOFF_MINUTES} * pow(2, attempt_count - 1) AS BIGINT) AS minutes,
        first_seen + to_minutes(CAST({markets.BACKOFF_MINUTES} * pow(2, attempt_count - 1) AS INTEGER)) AS retry_at FROM exception_state""",
    "admissible_slips": "SELECT slip_id, account_id, jurisdiction, report_date, slip_status FROM admissible",
    "isolation_breaches": """SELECT slip_id, l.account_id FROM betting_file f JOIN fct_lifecycle l USING (slip_id)
        WHERE l.account_id IN (SELECT account_id FROM blocked) OR (l.account_id, f.report_date) IN (
          SELECT account_id, report_date FROM fct_exceptions WHERE block_scope = 'PERIOD')""",
})
# ---- rules -------------------------------------------------------------------


def _violates(kind: str, field: str, arg: object) -> str:
    if kind == "not_null":
        return f"{field} IS NULL"
    if kind == "non_negative":
        return f"{field} < 0"
    if kind == "max_value":
        return f"{field} > {arg}"
    if kind == "in_set":
        return f"{field} NOT IN ({', '.join(map(text, arg))})"
    if kind == "matches":
        return f"NOT regexp_matches({field}, {text(arg)})"
    if kind == "code_in_set":
        return f"({field} IS NULL OR {field} NOT IN ({', '.join(map(text, arg))}))"
    return f"{arg[0]} = {text(arg[1])} AND {field} <> 0"


def _rule_rows(table: str, rules: list[tuple], key_: str, date: str = "report_date") -> str:
    """``rules``: (id, kind, field, arg, market or None)."""
    nothing = f"SELECT CAST(NULL AS VARCHAR) AS rule_id, {key_} AS row_key, {date} AS report_date FROM {table} WHERE FALSE"
    return " UNION ALL ".join([nothing, *[
        f"SELECT {text(rid)}, {key_}, {date} FROM {table} WHERE {_violates(kind, field, arg)}"
        + (f" AND {m}" if m else "") for rid, kind, field, arg, m in rules]])


_sport_sets = {m: markets.code_set(markets.SPORT_CODES, [(p[0], p[1]) for p in markets.SPORT_POLICY], m) for m in markets.MARKETS}
_game_sets = {m: markets.code_set(markets.GAME_CODES, markets.GAME_POLICY, m) for m in markets.GAMING_FILES}
_row_kinds = ("not_null", "non_negative", "max_value", "in_set", "matches", "zero_when")
_betting = [(i, k, f, a, None) for i, k, f, a in markets.COMMON_BETTING_RULES if k in _row_kinds]
_betting += [(i, k, f, a, f"jurisdiction = '{m}'") for m, i, k, f, a in markets.BETTING_RULES if k in _row_kinds]
_betting_codes = [(i, "code_in_set", f, _sport_sets[m], f"jurisdiction = '{m}'")
                  for m, i, k, f, a in markets.BETTING_RULES if k == "valid_sport_code"]
_gaming = [(i, k, f, a, None) for i, k, f, a in markets.COMMON_GAMING_RULES if k in _row_kinds]
_gaming += [(i, "code_in_set", f, _game_sets[m], f"jurisdiction = '{m}'") for m, i, k, f, a in markets.GAMING_RULES if k == "valid_game_code"]
for _kind in _row_kinds:
    FINAL[f"rule_{_kind}"] = _rule_rows("open_file", [r for r in _betting if r[1] == _kind], "slip_id")


def _cases(rules: list[tuple], kind: str) -> str:
    return "CASE jurisdiction " + " ".join(f"WHEN '{r[0]}' THEN '{r[1]}'" for r in rules if r[2] == kind) + " END"


def _markets_of(rules: list[tuple], kind: str) -> str:
    return "(" + ", ".join(f"'{r[0]}'" for r in rules if r[2] == kind) + ")"


CTES["raw_slip_keys"] = "SELECT slip_id FROM d_orders WHERE k % 13 = 0"
_conditions = [
    ("fct_lifecycle", "slip_id", [("L-1", "slip_status = 'SETTLED' AND settled_at IS NULL"), ("L-2", "slip_status = 'VOIDED' AND voided_at IS NULL"),
                                  ("L-3", "slip_status = 'OPEN' AND (settled_at IS NOT NULL OR voided_at IS NOT NULL)"),
                                  ("L-4", "payout <> 0 AND slip_status <> 'SETTLED'"), ("L-5", "stake < 0 OR payout < 0"), ("L-6", "settled_at < placed_at")]),
    ("fct_activity", "activity_id", [("A-1", "stake < 0 OR payout < 0 OR rake_or_fee < 0"), ("A-2", "vertical = 'CASINO_ROUND' AND rake_or_fee <> 0"),
                                     ("A-3", "vertical <> 'CASINO_ROUND' AND jackpot_contribution <> 0")]),
    ("stg_gaming_sessions", "session_id", [("S-1", "ended_at < started_at"), ("S-2", "(ended_at IS NULL) <> (end_reason IS NULL)"), ("S-3", "last_activity_ts > ended_at")]),
    ("fct_payments", "payment_id", [("P-1", "amount <= 0"), ("P-2", "status = 'COMPLETED' AND completed_ts IS NULL"), ("P-3", "completed_ts < requested_ts")]),
    ("operator_pool_liability", "jackpot_id", [("J-1", "pool_balance < 0")])]


def _condition_rows(tables: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{i}' AS rule_id, {k} AS row_key, CAST(NULL AS DATE) AS report_date FROM {t} WHERE {w}"
                              for t, k, cs in _conditions if t in tables for i, w in cs)


FINAL.update({
    "run_gate_counts": f"""SELECT rule_id, count(*) AS violations FROM ({_condition_rows(('fct_lifecycle', 'fct_payments'))}
        UNION ALL SELECT 'SLIP-KEY', slip_id, NULL FROM raw_slip_keys) GROUP BY 1""",
    "row_conditions": _condition_rows(tuple(t for t, _, _ in _conditions)),
    "rule_strict_thresholds": _rule_rows("open_file", [
        ("T-NEG", "non_negative", "ggr", None, None), ("T-MAX", "max_value", "stake", 45, None), ("T-SET", "in_set", "slip_status", ["SETTLED"], None),
        ("T-RE", "matches", "slip_id", "[02468]$", None), ("T-ZERO", "zero_when", "payout", ("slip_status", "SETTLED"), None)], "slip_id"),
    "rule_unique": "SELECT 'COM-005' AS rule_id, slip_id AS row_key, CAST(NULL AS DATE) AS report_date FROM raw_slip_keys",
    "rule_valid_sport_code": """SELECT 'SPORT-CODE' AS rule_id, slip_id AS row_key, report_date FROM open_file o
        WHERE NOT EXISTS (FROM sport_code_list l WHERE l.jurisdiction = o.jurisdiction AND l.code = o.sport_code)""",
    "rule_valid_game_code": """SELECT 'GAME-CODE' AS rule_id, activity_id AS row_key, report_date FROM gaming_file o
        WHERE NOT EXISTS (FROM game_code_list l WHERE l.jurisdiction = o.jurisdiction AND l.code = o.game_code)""",
    "rule_no_unmapped_fixtures": f"""SELECT {_cases(markets.BETTING_RULES, 'no_unmapped_fixtures')} AS rule_id, slip_id AS row_key, report_date
        FROM coded_slips WHERE regulator_code IS NULL AND (slip_status = 'SETTLED' OR include_voided)
        AND jurisdiction IN {_markets_of(markets.BETTING_RULES, 'no_unmapped_fixtures')}""",
    "rule_no_unlicensed_games": f"""SELECT {_cases(markets.GAMING_RULES, 'no_unlicensed_games')} AS rule_id, activity_id AS row_key, report_date
        FROM coded_plays WHERE regulator_code IS NULL AND jurisdiction IN {_markets_of(markets.GAMING_RULES, 'no_unlicensed_games')}""",
    "rule_activity_within_session": """SELECT 'ST-201' AS rule_id, g.activity_id AS row_key, CAST(NULL AS DATE) AS report_date FROM fct_activity g
        JOIN stg_gaming_sessions s USING (session_id) JOIN stg_accounts a ON a.account_id = s.account_id
        WHERE a.jurisdiction IN ('NL', 'PT') AND NOT (g.occurred_at >= s.started_at AND g.occurred_at <= coalesce(s.ended_at, g.occurred_at))""",
    "rule_single_open_session": """SELECT 'ST-202' AS rule_id, account_id AS row_key, CAST(NULL AS DATE) AS report_date
        FROM stg_gaming_sessions JOIN stg_accounts USING (account_id) WHERE ended_at IS NULL AND jurisdiction IN ('NL', 'PT')
        GROUP BY account_id HAVING count(*) > 1""",
    "rule_end_reason_in_set": """SELECT 'ST-203' AS rule_id, session_id AS row_key, report_date FROM platform_session_file
        WHERE end_reason IS NULL OR end_reason NOT IN ('LOGOUT', 'INACTIVITY')
        UNION ALL SELECT 'ST-203', game_session_id, report_date FROM game_session_file WHERE end_reason IS NULL OR end_reason NOT IN ('LOGOUT', 'INACTIVITY')""",
    "rule_single_game_session": """SELECT 'ST-204' AS rule_id, game_session_id AS row_key, CAST(NULL AS DATE) AS report_date
        FROM session_activity JOIN stg_accounts USING (account_id) WHERE jurisdiction = 'NL' GROUP BY 2 HAVING count(DISTINCT game_id) > 1""",
    "sessions_with_many_games": """SELECT 'ST-204' AS rule_id, session_id AS row_key, CAST(NULL AS DATE) AS report_date
        FROM session_activity JOIN stg_accounts USING (account_id) GROUP BY 2 HAVING count(DISTINCT game_id) > 1""",
    "rule_no_voided_slips": f"""SELECT {_cases(markets.BETTING_RULES, 'no_voided_slips')} AS rule_id, slip_id AS row_key, report_date
        FROM reportable WHERE slip_status = 'VOIDED' AND jurisdiction IN {_markets_of(markets.BETTING_RULES, 'no_voided_slips')}""",
    "key_assertions": """SELECT 'RAW' AS rule_id, entity_type || '|' || entity_id || '|' || attr_name AS row_key, CAST(NULL AS DATE) AS report_date
        FROM cdc_reg_attributes GROUP BY entity_type, entity_id, attr_name HAVING count(*) > 1""",
    "null_assertions": """SELECT 'NN-settled' AS rule_id, slip_id AS row_key, CAST(NULL AS DATE) AS report_date FROM fct_lifecycle WHERE settled_at IS NULL
        UNION ALL SELECT 'NN-placed', slip_id, NULL FROM fct_lifecycle WHERE placed_at IS NULL""",
    "one_pass_rules": f"SELECT rule_id, count(*) AS violations FROM ({_rule_rows('open_file', [*_betting, *_betting_codes], 'slip_id')}) GROUP BY 1",
    "gaming_rules": f"SELECT rule_id, count(*) AS violations FROM ({_rule_rows('gaming_file', _gaming, 'activity_id')}) GROUP BY 1",
    "register_rules": _rule_rows("open_registers", [
        *[(i, k, f, a, None) for i, k, f, a in markets.COMMON_REGISTER_RULES],
        *[(i, k, f, a, f"register_id = '{r}'") for r, i, k, f, a in markets.REGISTER_RULES],
        ("R-LOSS", "non_negative", "ggr_sum", None, None)], "player_ref", "period_start"),
})
# ---- reconciliation ----------------------------------------------------------
CTES["new_pipe"] = """SELECT jurisdiction, slip_id AS bet_id, CAST(settled_at AS DATE) AS report_date, stake, payout, stake - payout AS ggr
    FROM fct_lifecycle JOIN stg_accounts USING (account_id) WHERE settled_at IS NOT NULL"""
CTES["legacy_totals"] = """
    SELECT jurisdiction, report_date, l.n AS ln, l.s AS ls, l.p AS lp, n.n AS nn, n.s AS ns, n.p AS np,
           CASE WHEN l.n IS NULL THEN 'date only in new pipeline' WHEN n.n IS NULL THEN 'date only in legacy'
                WHEN l.n <> n.n THEN 'row count mismatch' WHEN abs(l.s - n.s) > 0.005 OR abs(l.p - n.p) > 0.005 THEN 'amount mismatch' END AS detail
    FROM (SELECT jurisdiction, report_date, count(*) AS n, sum(stake) AS s, sum(payout) AS p FROM legacy_capture GROUP BY 1, 2) l
    FULL JOIN (SELECT jurisdiction, report_date, count(*) AS n, sum(stake) AS s, sum(payout) AS p FROM new_pipe GROUP BY 1, 2) n USING (jurisdiction, report_date)"""
CTES["legacy_rows"] = """
    SELECT jurisdiction, report_date, if(n.ggr IS NULL, 'MISSING_IN_NEW', 'EXTRA_IN_NEW') AS break_type, bet_id AS break_key,
           if(n.ggr IS NULL, 'present', 'absent') AS legacy_value, if(n.ggr IS NULL, 'absent', 'present') AS new_value, CAST(NULL AS VARCHAR) AS detail
    FROM legacy_capture l FULL JOIN new_pipe n USING (jurisdiction, bet_id, report_date) WHERE l.ggr IS NULL OR n.ggr IS NULL"""
CTES["legacy_fields"] = " UNION ALL ".join(
    f"""SELECT jurisdiction, report_date, 'FIELD_{f.upper()}' AS break_type, bet_id AS break_key, CAST(l.{f} AS VARCHAR) AS legacy_value,
    CAST(CAST(n.{f} AS DECIMAL(18,2)) AS VARCHAR) AS new_value, CAST(NULL AS VARCHAR) AS detail
    FROM legacy_capture l JOIN new_pipe n USING (jurisdiction, bet_id, report_date) WHERE abs(l.{f} - n.{f}) > 0.005""" for f in ("stake", "payout", "ggr"))
_sums = ["deposits", "withdrawals", "settled_n", "settled_stakes", "settled_payouts", "void_n", "void_stakes", "void_ggr_reversal",
         "rounds_n", "casino_stakes", "casino_payouts", "golden_n", "golden_stakes", "golden_winnings", "open_delta", "cash_delta"]
CTES["money_marks"] = """
    SELECT a.jurisdiction, CAST(completed_ts AS DATE) AS day, if(direction = 'DEPOSIT', 'deposits', 'withdrawals') AS m, amount AS v
    FROM stg_payments JOIN stg_accounts a USING (account_id) WHERE status = 'COMPLETED'
    UNION ALL SELECT jurisdiction, CAST(ts AS DATE), 'cash_delta', amount FROM cash_moves
    UNION ALL SELECT jurisdiction, CAST(placed_at AS DATE), 'open_delta', stake FROM slip_amounts
    UNION ALL SELECT jurisdiction, CAST(least(coalesce(settled_at, voided_at), coalesce(voided_at, settled_at)) AS DATE), 'open_delta', -stake
      FROM slip_amounts WHERE settled_at IS NOT NULL OR voided_at IS NOT NULL
    UNION ALL SELECT jurisdiction, CAST(settled_at AS DATE), unnest(['settled_n', 'settled_stakes', 'settled_payouts']), unnest([1, stake, payout])
      FROM slip_amounts WHERE settled_at IS NOT NULL
    UNION ALL SELECT jurisdiction, CAST(voided_at AS DATE), unnest(['void_n', 'void_stakes', 'void_ggr_reversal']),
      unnest([1, stake, CASE WHEN settled_at <= voided_at THEN stake - payout ELSE 0 END]) FROM slip_amounts WHERE voided_at IS NOT NULL
    UNION ALL SELECT a.jurisdiction, CAST(round_ts AS DATE),
      unnest(if(funding = 'CASH', ['rounds_n', 'casino_stakes', 'casino_payouts'], ['golden_n', 'golden_stakes', 'golden_winnings'])), unnest([1, stake, payout])
      FROM play_rounds JOIN stg_accounts a USING (account_id)"""
CTES["money_days"] = "SELECT jurisdiction, day, " + ", ".join(f"coalesce(sum(v) FILTER (m = '{x}'), 0) AS {x}" for x in _sums) + " FROM money_marks GROUP BY 1, 2"
CTES["recon_days"] = f"""
    WITH levels AS (
      SELECT d.*, sum(cash_delta) OVER w AS closing_balance, sum(open_delta) OVER w AS open_end, mk.tax_basis, mk.bonus_gross, coalesce(r.rate, 0) AS duty_rate
      FROM money_days d JOIN market mk USING (jurisdiction) LEFT JOIN betting_rates r ON r.jurisdiction = d.jurisdiction AND {valid_on('d.day', 'r')}
      WINDOW w AS (PARTITION BY d.jurisdiction ORDER BY d.day)),
    views AS (
      SELECT *, closing_balance - cash_delta AS opening_balance, open_end - open_delta AS open_start, deposits - withdrawals - cash_delta AS cash_ggr,
             settled_stakes - settled_payouts - void_ggr_reversal AS sports_ggr, casino_stakes - casino_payouts AS casino_ggr,
             if(bonus_gross, golden_stakes, 0) - golden_winnings AS golden_ggr, open_delta AS open_movement, if(bonus_gross, golden_stakes, 0) AS bonus_bridge
      FROM levels),
    settled AS (SELECT *, sports_ggr + casino_ggr + golden_ggr AS settlement_ggr FROM views)
    SELECT *, cash_ggr - open_movement + bonus_bridge - settlement_ggr AS residual,
           CAST(if(tax_basis = 'turnover', settled_stakes + casino_stakes + golden_stakes, settlement_ggr) AS DECIMAL(18,2)) AS duty_base,
           round(CAST(if(tax_basis = 'turnover', settled_stakes + casino_stakes + golden_stakes, settlement_ggr) AS DECIMAL(18,2)) * duty_rate, 2) AS duty
    FROM settled"""
_counts = {"settled_n", "void_n", "rounds_n", "golden_n"}
_sum_cols = " ".join(x + (":i" if x in _counts else ":d") for x in _sums if not x.endswith("_delta"))
FINAL.update({
    "provider_breaks": """SELECT provider, statement_date, CAST(i AS DOUBLE) AS internal_ggr, CAST(reported_ggr AS DOUBLE) AS reported_ggr,
        CASE WHEN i IS NULL THEN 'statement with no internal activity' WHEN reported_ggr IS NULL THEN 'internal activity with no statement' ELSE 'ggr mismatch' END AS break_type
        FROM (SELECT provider, CAST(round_ts AS DATE) AS statement_date, sum(wager - payout) AS i FROM stg_rounds GROUP BY 1, 2)
        FULL JOIN provider_statements USING (provider, statement_date) WHERE i IS NULL OR reported_ggr IS NULL OR abs(i - reported_ggr) > 0.005""",
    "legacy_total_breaks": "SELECT jurisdiction, report_date, 'TOTALS' AS break_type, CAST(report_date AS VARCHAR) AS break_key, detail FROM legacy_totals WHERE detail IS NOT NULL",
    "legacy_total_values": "SELECT jurisdiction, report_date, ln AS legacy_rows, CAST(ns AS DOUBLE) AS new_stake FROM legacy_totals WHERE detail IS NOT NULL",
    "legacy_row_breaks": "SELECT jurisdiction, report_date, break_type, break_key, legacy_value, new_value, detail FROM legacy_rows",
    "legacy_field_breaks": "SELECT jurisdiction, report_date, break_type, break_key, legacy_value, new_value, detail FROM legacy_fields",
    "submitted_breaks": """SELECT jurisdiction, report_date, 'SUBMITTED_VS_READY' AS break_type, CAST(report_date AS VARCHAR) AS break_key,
        CAST(CAST(ns AS DECIMAL(18,2)) AS VARCHAR) AS legacy_value, CAST(CAST(ls AS DECIMAL(18,2)) AS VARCHAR) AS new_value,
        jurisdiction || '-' || strftime(report_date, '%Y%m%d') AS detail FROM legacy_totals WHERE abs(ls - ns) > 0.005""",
    "cutover_breaks": """SELECT jurisdiction, break_type, count(*) AS breaks FROM (
        SELECT jurisdiction, 'TOTALS' AS break_type FROM legacy_totals WHERE detail IS NOT NULL UNION ALL SELECT jurisdiction, break_type FROM legacy_rows
        UNION ALL SELECT jurisdiction, break_type FROM legacy_fields) GROUP BY 1, 2""",
    "slip_amounts": out("SELECT *, 'SINGLE' AS product FROM slip_amounts", "slip_id account_id jurisdiction fixture_id selection product odds:d placed_at stake:d settled_at payout:d voided_at"),
    "cash_flow": out("cash_moves", "jurisdiction account_id ref ts amount:d kind"),
    "daily_flows": out("money_days", "jurisdiction day " + " ".join(f"{x}:d" for x in _sums)),
    "daily_recon": out("recon_days", f"jurisdiction day {_sum_cols} opening_balance:d closing_balance:d open_start:d open_end:d cash_ggr:d "
                       "sports_ggr:d casino_ggr:d golden_ggr:d open_movement:d bonus_bridge:d settlement_ggr:d residual:d duty_base:d duty_rate:d duty:d"),
    "monthly_recon": "SELECT jurisdiction, CAST(date_trunc('month', day) AS DATE) AS month, " + ", ".join(
        f"CAST(sum({x}) AS {'BIGINT' if x in _counts else 'DOUBLE'}) AS {x}" for x in [*[y for y in _sums if not y.endswith('_delta')], "cash_ggr", "settlement_ggr",
                                                     "open_movement", "bonus_bridge", "duty_base", "duty"])
        + """, CAST(arg_min(opening_balance, day) AS DOUBLE) AS opening_balance, CAST(arg_max(closing_balance, day) AS DOUBLE) AS closing_balance,
        CAST(arg_min(open_start, day) AS DOUBLE) AS open_start, CAST(arg_max(open_end, day) AS DOUBLE) AS open_end,
        count(*) FILTER (residual <> 0) AS days_off FROM recon_days GROUP BY 1, 2""",
    "period_balances": """SELECT jurisdiction, CAST(coalesce(sum(amount) FILTER (ts < TIMESTAMP '2023-01-01'), 0) AS DOUBLE) AS opening_balance,
        CAST(coalesce(sum(amount) FILTER (ts < TIMESTAMP '2024-02-01'), 0) AS DOUBLE) AS closing_balance FROM cash_moves GROUP BY 1""",
    "open_stakes": """SELECT jurisdiction, CAST(sum(stake) AS DOUBLE) AS open_stakes, count(*) AS open_slips FROM slip_amounts
        WHERE placed_at < TIMESTAMP '2023-01-01' AND NOT coalesce(settled_at < TIMESTAMP '2023-01-01', FALSE)
          AND NOT coalesce(voided_at < TIMESTAMP '2023-01-01', FALSE) GROUP BY 1""",
    "deposits_and_withdrawals": out("money_days", "jurisdiction day deposits:d withdrawals:d") + " WHERE deposits <> 0 OR withdrawals <> 0",
    "settlement_view": out("money_days", "jurisdiction day settled_n:i settled_stakes:d settled_payouts:d") + " WHERE settled_n > 0",
    "void_reversals": out("money_days", "jurisdiction day void_n:i void_stakes:d void_ggr_reversal:d") + " WHERE void_n > 0",
    "rounds_by_funding": """SELECT jurisdiction, funding, CAST(round_ts AS DATE) AS day, count(*) AS rounds, CAST(sum(stake) AS DOUBLE) AS stakes,
        CAST(sum(payout) AS DOUBLE) AS payouts FROM play_rounds JOIN stg_accounts USING (account_id) GROUP BY 1, 2, 3""",
    "bonus_policy": out("recon_days", "jurisdiction day golden_stakes:d golden_winnings:d golden_ggr:d bonus_bridge:d") + " WHERE golden_n > 0",
    "active_markets": "SELECT DISTINCT jurisdiction FROM cash_moves WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'",
})
CTES["expected"] = """
    SELECT jurisdiction, 'bets' AS record_type, slip_id || '|SETTLED' AS record_key, slip_id AS record_id, settled_at AS due_at FROM slip_amounts WHERE settled_at IS NOT NULL
    UNION ALL SELECT jurisdiction, 'bets', slip_id || '|VOIDED', slip_id, voided_at FROM slip_amounts JOIN market USING (jurisdiction) WHERE voided_at IS NOT NULL AND include_voided
    UNION ALL SELECT jurisdiction, 'payments', payment_id, payment_id, completed_ts FROM fct_payments WHERE status = 'COMPLETED'
    UNION ALL SELECT a.jurisdiction, 'gaming', round_id, round_id, round_ts FROM play_rounds r JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction)
      WHERE NOT m.gaming_via_sessions AND (a.jurisdiction NOT IN (SELECT jurisdiction FROM licensed) OR (a.jurisdiction, r.game) IN (SELECT jurisdiction, game FROM licensed))
    UNION ALL SELECT jurisdiction, 'sessions', session_id, session_id, ended_at FROM stg_gaming_sessions JOIN stg_accounts USING (account_id) JOIN market USING (jurisdiction)
      WHERE ended_at IS NOT NULL AND session_grain = 'platform'
    UNION ALL SELECT DISTINCT a.jurisdiction, 'sessions', s.session_id || '-' || r.game, s.session_id || '-' || r.game, s.ended_at
      FROM stg_gaming_sessions s JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction) JOIN play_rounds r ON r.session_id = s.session_id
      WHERE s.ended_at IS NOT NULL AND m.session_grain = 'per_game'"""
CTES["log_keys"] = "SELECT DISTINCT record_type, record_key FROM delivery_log"
_ref = "CASE WHEN hashed_ref THEN sha256(national_id) ELSE account_id END AS player_ref"
_route = """CASE WHEN jurisdiction IN (SELECT jurisdiction FROM licensed) AND (jurisdiction, game) NOT IN (SELECT jurisdiction, game FROM licensed)
    THEN 'SUPPRESSED-UNLICENSED' WHEN gaming_via_sessions THEN 'VIA-SESSION' ELSE 'DELIVER' END"""
CTES["open_bets"] = f"""
    SELECT * FROM (SELECT slip_id, jurisdiction, {_ref}, if(voided_at IS NOT NULL, 'VOIDED', 'SETTLED') AS status,
      if(voided_at IS NOT NULL, 0, payout) AS payout, stake, placed_at, coalesce(voided_at, settled_at) AS terminal_at,
      slip_id || '|' || if(voided_at IS NOT NULL, 'VOIDED', 'SETTLED') AS log_key,
      if(voided_at IS NOT NULL AND NOT include_voided, 'SUPPRESSED-VOID', 'DELIVER') AS route
      FROM slip_amounts JOIN stg_accounts USING (account_id, jurisdiction) JOIN market USING (jurisdiction)
      WHERE settled_at IS NOT NULL OR voided_at IS NOT NULL) WHERE ('bets', log_key) NOT IN (SELECT record_type, record_key FROM log_keys)"""
CTES["open_rounds"] = f"""
    SELECT round_id, account_id, session_id, round_ts, jurisdiction, {_ref}, game, CASE game {' '.join(f"WHEN '{g}' THEN {n}" for g, n in markets.GAME_TYPE_CODES.items())} END AS game_type_code,
      stake, payout, funding, {_route} AS route FROM play_rounds JOIN stg_accounts USING (account_id) JOIN market USING (jurisdiction)
    WHERE ('gaming', round_id) NOT IN (SELECT record_type, record_key FROM log_keys)"""
FINAL.update({
    "expected_records": "SELECT jurisdiction, record_type, record_key, record_id, due_at FROM expected",
    "completeness_breaks": """SELECT e.jurisdiction, e.record_type, if(r.receipt_id IS NULL, 'NOT_SUBMITTED', 'FILE_MISSING') AS problem, count(*) AS records
        FROM expected e LEFT JOIN (SELECT record_type, record_key, min(receipt_id) AS receipt_id FROM delivery_log GROUP BY 1, 2) r USING (record_type, record_key)
        WHERE r.receipt_id IS NULL OR (e.jurisdiction, e.record_type, e.record_id) NOT IN (
          SELECT jurisdiction, record_type, split_part(record_key, '|', 1) FROM delivery_log
          WHERE jurisdiction IS NOT NULL AND right(split_part(record_key, '|', 1), 1) <> '6') GROUP BY 1, 2, 3""",
    "pending_bets": out("open_bets", "slip_id jurisdiction player_ref status payout:d stake:d placed_at terminal_at log_key route"),
    "pending_payments": f"""SELECT payment_id, jurisdiction, {_ref}, direction, CAST(amount AS DOUBLE) AS amount, method, completed_ts
        FROM stg_payments JOIN stg_accounts USING (account_id) JOIN market USING (jurisdiction)
        WHERE status = 'COMPLETED' AND ('payments', payment_id) NOT IN (SELECT record_type, record_key FROM log_keys)""",
    "pending_players": f"""SELECT account_id, jurisdiction, {_ref}, kyc_status, account_id || '|' || kyc_status AS log_key
        FROM stg_accounts JOIN market USING (jurisdiction) WHERE ('players', account_id || '|' || kyc_status) NOT IN (SELECT record_type, record_key FROM log_keys)""",
    "pending_gaming": out("open_rounds", "round_id jurisdiction player_ref game game_type_code stake:d payout:d funding route"),
    "pending_platform_sessions": f"""SELECT session_id, jurisdiction, {_ref}, started_at, ended_at, end_reason FROM stg_gaming_sessions
        JOIN stg_accounts USING (account_id) JOIN market USING (jurisdiction) WHERE session_grain = 'platform' AND ended_at IS NOT NULL
        AND ('sessions', session_id) NOT IN (SELECT record_type, record_key FROM log_keys)""",
    "pending_game_sessions": f"""SELECT session_id, game, jurisdiction, {_ref}, min(round_ts) AS first_played_at, max(round_ts) AS last_played_at, count(*) AS rounds,
        count(*) FILTER (r.payout > 0) AS rounds_won, string_agg(round_id, ',' ORDER BY round_ts, round_id) AS round_ids
        FROM play_rounds r JOIN stg_gaming_sessions s USING (session_id) JOIN stg_accounts a ON a.account_id = r.account_id JOIN market m USING (jurisdiction)
        WHERE s.ended_at IS NOT NULL AND m.session_grain = 'per_game' AND ('sessions', session_id || '-' || game) NOT IN (SELECT record_type, record_key FROM log_keys)
        GROUP BY 1, 2, 3, 4""".replace("sha256(national_id) ELSE account_id", "sha256(national_id) ELSE a.account_id"),
    "routing_counts": """SELECT jurisdiction, record_type, route, count(*) AS records FROM (SELECT jurisdiction, 'bets' AS record_type, route FROM open_bets
        UNION ALL SELECT jurisdiction, 'gaming', route FROM open_rounds) GROUP BY ALL""",
    "player_references": f"SELECT account_id, jurisdiction, {_ref} FROM stg_accounts JOIN market USING (jurisdiction)",
    "slip_balances": """SELECT slip_id, account_id, CAST(b + stake - credit AS DOUBLE) AS balance_before_stake, CAST(b - credit AS DOUBLE) AS balance_after_stake,
        CAST(b - credit AS DOUBLE) AS balance_before_credit, CAST(b AS DOUBLE) AS balance_after_credit, CAST(credit - stake AS DOUBLE) AS balance_net
        FROM (SELECT s.slip_id, s.account_id, s.stake, d.balance AS b, if(s.voided_at IS NOT NULL, s.stake, s.payout) AS credit
              FROM slip_amounts s JOIN dim_balance d USING (account_id) WHERE settled_at IS NOT NULL OR voided_at IS NOT NULL)""",
    "payment_balances": """SELECT payment_id, direction, CAST(amount AS DOUBLE) AS amount, CAST(balance AS DOUBLE) AS balance,
        CAST(if(direction = 'DEPOSIT', balance - amount, balance + amount) AS DOUBLE) AS balance_before
        FROM stg_payments JOIN dim_balance USING (account_id) WHERE status = 'COMPLETED'""",
    "as_of_balances": """SELECT account_id, ref, kind, ts, CAST(amount AS DOUBLE) AS amount,
        CAST(sum(amount) OVER (PARTITION BY account_id ORDER BY ts, amount DESC, kind, ref ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance FROM cash_moves""",
    "delivery_counts": """SELECT jurisdiction, record_type, CASE WHEN receipt_id LIKE 'SUPPRESSED-%' OR receipt_id = 'VIA-SESSION' THEN receipt_id ELSE 'DELIVERED' END AS outcome,
        count(*) AS records FROM delivery_log GROUP BY ALL""",
    "in_flight_slips": """SELECT slip_id, account_id, fixture_id, placed_at, CAST(stake AS DOUBLE) AS stake FROM fct_lifecycle WHERE slip_status = 'OPEN'""",
    "operations_kpis": """SELECT 'players' AS kpi, CAST(count(*) AS DOUBLE) AS value FROM stg_accounts
        UNION ALL SELECT 'open_bets', count(*) FROM fct_lifecycle WHERE slip_status = 'OPEN'
        UNION ALL SELECT 'deposits_last_day', coalesce(sum(amount), 0) FROM stg_payments WHERE direction = 'DEPOSIT' AND status = 'COMPLETED'
          AND completed_ts BETWEEN TIMESTAMP '2024-01-19 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'
        UNION ALL SELECT 'seen_recently', count(DISTINCT account_id) FROM cdc_payments WHERE requested_ts BETWEEN TIMESTAMP '2024-01-20 11:55:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "latest_payments": """SELECT payment_id, account_id, direction, CAST(amount AS DOUBLE) AS amount, status, requested_ts FROM stg_payments
        ORDER BY requested_ts DESC, payment_id LIMIT 12""",
    "odds_board": """SELECT fixture_id, CAST(max(odds) FILTER (selection = 'HOME') AS DOUBLE) AS home_odds, CAST(max(odds) FILTER (selection = 'DRAW') AS DOUBLE) AS draw_odds,
        CAST(max(odds) FILTER (selection = 'AWAY') AS DOUBLE) AS away_odds FROM cdc_bet_slips GROUP BY 1""",
    "receipts": """SELECT jurisdiction, record_type, record_key, seq, jurisdiction || '-BETS-' || lpad(CAST(seq AS VARCHAR), CAST(greatest(6, length(CAST(seq AS VARCHAR))) AS INTEGER), '0') AS receipt_id,
        lpad(CAST(seq AS VARCHAR), CAST(greatest(6, length(CAST(seq AS VARCHAR))) AS INTEGER), '0') || '-' || record_key || '.xml' AS file_name
        FROM (SELECT s.jurisdiction, 'bets' AS record_type, slip_id AS record_key,
              coalesce(l.n, 0) + row_number() OVER (PARTITION BY s.jurisdiction ORDER BY slip_id) AS seq FROM slip_amounts s
              LEFT JOIN (SELECT jurisdiction, max(CAST(regexp_extract(receipt_id, '-([0-9]+)$', 1) AS BIGINT)) AS n FROM delivery_log
                         WHERE record_type = 'bets' AND receipt_id <> 'SUPPRESSED-VOID' GROUP BY 1) l ON l.jurisdiction = s.jurisdiction
              WHERE settled_at IS NOT NULL)""",
    "receipt_totals": """SELECT jurisdiction, report_date, jurisdiction || '-' || strftime(report_date, '%Y%m%d') AS receipt_id, count(*) AS row_count,
        CAST(sum(stake) AS DOUBLE) AS total_stake FROM legacy_capture GROUP BY 1, 2, 3""",
    "envelope_batches": """SELECT jurisdiction, report_date, bet_id, (row_number() OVER (PARTITION BY jurisdiction, report_date ORDER BY bet_id) - 1)
        // CASE jurisdiction WHEN 'MT' THEN 50 WHEN 'NL' THEN 12 ELSE 30 END AS batch_id
        FROM (SELECT jurisdiction, CAST(date_trunc('year', settled_at) AS DATE) AS report_date, bet_id FROM settled_bets)""",
    "filed_per_market": """SELECT jurisdiction, CAST(submitted_at AS DATE) AS filed_on, count(*) AS documents FROM delivery_log
        WHERE jurisdiction IS NOT NULL AND receipt_id NOT IN ('SUPPRESSED-VOID', 'SUPPRESSED-UNLICENSED', 'VIA-SESSION') GROUP BY 1, 2""",
    "log_append": """SELECT 'payments' AS record_type, payment_id AS record_key, jurisdiction, 'NEW' AS receipt_id, completed_ts AS submitted_at
        FROM fct_payments WHERE status = 'COMPLETED' AND ('payments', payment_id) NOT IN (SELECT record_type, record_key FROM log_keys)""",
    "log_replace": """SELECT record_type, record_key, arg_max(j, t) AS jurisdiction, arg_max(r, t) AS receipt_id, max(t) AS submitted_at FROM (
        SELECT record_type, record_key, jurisdiction AS j,
               CASE WHEN record_type = 'bets' AND jurisdiction = 'MT' THEN 'RE-' || receipt_id ELSE receipt_id END AS r,
               CASE WHEN record_type = 'bets' AND jurisdiction = 'MT' THEN submitted_at + INTERVAL 1 DAY ELSE submitted_at END AS t
        FROM delivery_log) GROUP BY 1, 2""",
    "incremental_merge": """SELECT jurisdiction, bet_id, filed_on AS report_date, CAST(stake AS DOUBLE) AS stake,
        CAST(if(bet_id LIKE '%3', payout + 1, payout) AS DOUBLE) AS payout, CAST(ggr AS DOUBLE) AS ggr
        FROM (SELECT *, CAST(if(bet_id LIKE '%13', report_date + 1, report_date) AS DATE) AS filed_on FROM new_pipe)
        WHERE bet_id LIKE '%3' OR (jurisdiction, report_date) IN (SELECT jurisdiction, report_date FROM new_pipe WHERE bet_id LIKE '%3'
            UNION SELECT jurisdiction, CAST(report_date + 1 AS DATE) FROM new_pipe WHERE bet_id LIKE '%13')""",
    "report_date_read": out("new_pipe", "jurisdiction bet_id report_date stake:d payout:d ggr:d") + " WHERE jurisdiction = 'ES' AND report_date = DATE '2023-05-10'",
    # scalars
    "scalar_dates": f"""SELECT slip_id, d AS local_date, t AS local_ts, CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(date_trunc('month', d) AS DATE) AS month_start,
        placed_at + INTERVAL 90 MINUTE AS later, CAST(floor((d - dob) / 365.2425) AS INTEGER) AS age, CAST(d - dob AS INTEGER) AS days_old
        FROM (SELECT slip_id, placed_at, date_of_birth AS dob, {day('placed_at')} AS d, {civil('placed_at')} AS t
              FROM fct_lifecycle JOIN stg_accounts USING (account_id) JOIN market USING (jurisdiction))""",
    "scalar_text": """SELECT account_id, sha256(national_id) AS sha256, upper(sha1(account_id)) AS sha1, regexp_matches(national_id, '^ID[0-9]*[02468]$') AS even_id,
        jurisdiction || '-' || account_id AS joined, CAST(length(national_id) AS INTEGER) AS len, national_id LIKE 'ID1%' AS starts_1 FROM stg_accounts""",
    "scalar_math": """SELECT slip_id, CAST(round(stake * CAST(0.0375 AS DECIMAL(9,4)), 2) AS DOUBLE) AS rounded, CAST(abs(stake - payout) AS DOUBLE) AS gap,
        CAST(greatest(stake, payout) AS DOUBLE) AS hi, CAST(least(stake, payout) AS DOUBLE) AS lo, CAST(floor(stake) AS BIGINT) AS whole,
        CAST(coalesce(nullif(payout, 0), stake) AS DOUBLE) AS paid FROM fct_lifecycle""",
    "document_codecs": """SELECT slip_id, strftime(placed_at, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(placed_at, '%Y%m%d%H%M%S') AS d14, strftime(placed_at, '%Y%m%d') AS d8,
        strftime(placed_at, '%Y%m') AS d6, strftime(placed_at, '%y%m%d%H%M%S') AS d12, strftime(placed_at, '%Y%m%d%H%M%S') || '+0000' AS d14tz,
        CAST(CAST(stake AS DECIMAL(18,2)) AS VARCHAR) AS money2, CAST(CAST(odds AS DECIMAL(18,4)) AS VARCHAR) AS money4,
        if(coalesce(payout, 0) > 0, '1', '0') AS won, upper(sha1(account_id)) AS sha1, selection || 'X''Y' AS canonical FROM slip_amounts""",
    "deterministic_ids": """SELECT slip_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' ||
        list_extract(['8', '9', 'a', 'b'], CAST((strpos('0123456789abcdef', h[17:17]) - 1) % 4 AS INTEGER) + 1) || h[18:20] || '-' || h[21:32] AS uuid
        FROM (SELECT slip_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('bet|' || slip_id)) AS h FROM cdc_bet_slips)""",
})


def _documents() -> None:
    for market, types in document_formats.FORMATS.items():
        for kind in types:
            own = {"NL": "game_sessions", "PT": "platform_sessions"}[market] if kind == "sessions" else kind
            FINAL[f"document_{market.lower()}_{kind}"] = oracle_documents.document_sql(market, kind, own)
    for market, kind, own in (("NL", "sessions", "game_sessions"), ("ES", "rud", "rud"), ("ES", "rut", "rut")):
        FINAL[f"split_document_{market.lower()}_{kind}"] = oracle_documents.document_sql(market, kind, own, "_split")
    for market, kind in (("MT", "bets"), ("BG", "payments"), ("DE", "players"), ("MT", "gaming")):
        FINAL[f"document_{market.lower()}_{kind}"] = oracle_documents.document_sql(market, kind, kind)
    FINAL["numeric_ids"] = out(f"SELECT slip_id, {oracle_documents._crc(chr(39) + 'bet|' + chr(39) + ' || slip_id')} AS crc FROM cdc_bet_slips",
                               "slip_id crc:i").replace("CAST(crc AS BIGINT) AS crc", "CAST(crc AS BIGINT) AS crc, CAST(crc % 30000 AS BIGINT) AS short")


_documents()


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in FINAL.items()}
