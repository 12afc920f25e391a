"""Models of the reporting run as DuckDB SQL over the derived feeds."""

from __future__ import annotations

from .. import markets
from .derive import RUN_TS
from .oracle_feeds import CTES, newest, text


def lit(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    return text(value)


def values(rows: list[tuple], types: str) -> str:
    """Configuration rows as a typed relation; ``types`` is 'name type, name type'."""
    spec = [t.strip().split(" ", 1) for t in types.split(";")]
    body = ",\n          ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in spec)
    return f"SELECT {cols} FROM (VALUES {body}) v({', '.join(n for n, _ in spec)})"


def day(ts: str, zone: str = "timezone") -> str:
    return f"CAST(({ts} AT TIME ZONE 'UTC') AT TIME ZONE {zone} AS DATE)"


def civil(ts: str, zone: str = "timezone") -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE {zone})"


def norm(expr: str) -> str:
    return (f"lower(trim(regexp_replace(regexp_replace(strip_accents({expr}), '[.,]', '', 'g'), "
            f"'\\s+', ' ', 'g')))")


def valid_on(d: str, alias: str) -> str:
    return (f"({alias}.valid_from IS NULL OR {d} >= {alias}.valid_from) "
            f"AND ({alias}.valid_to IS NULL OR {d} < {alias}.valid_to)")


def session_of(market: str, i: int, default: object) -> object:
    return next((s[i] for s in markets.SESSIONS if s[0] == market), default)


MONEY = "DECIMAL(18,2)"
CTES.update({
    "market": values(
        [(*r, r[0] in markets.BONUS_GROSS, session_of(r[0], 1, None), session_of(r[0], 2, None),
          session_of(r[0], 3, False), session_of(r[0], 4, False)) for r in markets.MARKET_ROWS],
        "jurisdiction VARCHAR; timezone VARCHAR; currency VARCHAR; cadence VARCHAR; include_voided BOOLEAN; "
        f"tax_basis VARCHAR; deduct_contributions BOOLEAN; default_daily {MONEY}; default_weekly {MONEY}; "
        f"default_monthly {MONEY}; withdrawal_needs_identity BOOLEAN; postcode_pattern VARCHAR; "
        "region_required BOOLEAN; hashed_ref BOOLEAN; bonus_gross BOOLEAN; session_grain VARCHAR; "
        "timeout_minutes INTEGER; file_empty_sessions BOOLEAN; gaming_via_sessions BOOLEAN"),
    "betting_rates": values(markets.BETTING_RATES,
                            "jurisdiction VARCHAR; rate DECIMAL(9,4); valid_from DATE; valid_to DATE"),
    "gaming_rates": values(markets.GAMING_RATES,
                           "jurisdiction VARCHAR; rate DECIMAL(9,4); valid_from DATE; valid_to DATE"),
    "vertical_rates": values(markets.VERTICAL_RATES, "jurisdiction VARCHAR; vertical VARCHAR; rate DECIMAL(9,4)"),
    "map_sport": values(markets.SPORT_CODES, "jurisdiction VARCHAR; canonical_sport VARCHAR; "
                        "regulator_code VARCHAR; valid_from DATE; valid_to DATE"),
    "map_game": values(markets.GAME_CODES, "jurisdiction VARCHAR; canonical_game_type VARCHAR; "
                       "regulator_code VARCHAR; valid_from DATE; valid_to DATE"),
    "sport_policy": values(markets.SPORT_POLICY, "jurisdiction VARCHAR; default_sport_code VARCHAR; event_template VARCHAR"),
    "game_policy": values(markets.GAME_POLICY, "jurisdiction VARCHAR; default_game_code VARCHAR"),
    "bands": values(markets.STAKE_BANDS, f"jurisdiction VARCHAR; max_stake {MONEY}; min_age INTEGER; "
                    "max_age INTEGER; valid_from DATE; valid_to DATE"),
    "licensed": values([(m, g) for m, gs in markets.LICENSED_GAMES.items() for g in gs],
                       "jurisdiction VARCHAR; game VARCHAR"),
    "sport_alias_raw": values(markets.SPORT_ALIASES, "alias VARCHAR; canonical VARCHAR; source VARCHAR"),
    "team_alias_raw": values(markets.PARTICIPANT_ALIASES, "alias VARCHAR; canonical_id VARCHAR; canonical_name VARCHAR"),
    "game_alias_raw": values(markets.GAME_ALIASES, "alias VARCHAR; canonical VARCHAR; source VARCHAR"),
    "sport_alias": f"SELECT DISTINCT {norm('alias')} AS n, canonical FROM sport_alias_raw",
    "team_alias": f"SELECT DISTINCT {norm('alias')} AS n, canonical_id, canonical_name FROM team_alias_raw",
    "game_alias": f"SELECT DISTINCT {norm('alias')} AS n, canonical FROM game_alias_raw",

    "fct_lifecycle": """
        SELECT slip_id, account_id, fixture_id, placed_at, settled_at, voided_at, slip_status, stake,
               CASE slip_status WHEN 'VOIDED' THEN 0 ELSE won END AS payout
        FROM (SELECT slip_id, min(event_ts) FILTER (event_type = 'PLACED') AS placed_at,
                     min(event_ts) FILTER (event_type = 'SETTLED') AS settled_at,
                     min(event_ts) FILTER (event_type = 'VOIDED') AS voided_at,
                     coalesce(max(stake) FILTER (event_type = 'PLACED'), 0) AS stake,
                     coalesce(max(payout) FILTER (event_type = 'SETTLED'), 0) AS won,
                     CASE max(CASE event_type WHEN 'VOIDED' THEN 3 WHEN 'SETTLED' THEN 2 ELSE 1 END)
                       WHEN 3 THEN 'VOIDED' WHEN 2 THEN 'SETTLED' ELSE 'OPEN' END AS slip_status
              FROM stg_bet_slip_events GROUP BY slip_id)
        JOIN stg_bet_slips USING (slip_id)""",
    "dim_fixture": f"""
        SELECT x.fixture_id, x.start_ts, x.sport_name_raw, s.canonical AS canonical_sport,
               x.competition_raw AS competition_name, coalesce(h.canonical_name, x.home_raw) AS home_name,
               coalesce(a.canonical_name, x.away_raw) AS away_name, h.canonical_id AS home_participant_id,
               a.canonical_id AS away_participant_id
        FROM stg_fixtures x LEFT JOIN sport_alias s ON s.n = {norm('x.sport_name_raw')}
        LEFT JOIN team_alias h ON h.n = {norm('x.home_raw')} LEFT JOIN team_alias a ON a.n = {norm('x.away_raw')}""",
    "dim_game": f"""
        SELECT game_id, game_name, provider, game_type_raw, canonical AS canonical_game_type
        FROM stg_games LEFT JOIN game_alias ON n = {norm('game_type_raw')}""",
    "unmapped_sports": """
        SELECT sport_name_raw, count(DISTINCT fixture_id) AS fixtures_affected, count(slip_id) AS slips_affected,
               min(start_ts) AS first_seen, max(start_ts) AS last_seen
        FROM dim_fixture LEFT JOIN fct_lifecycle USING (fixture_id) WHERE canonical_sport IS NULL GROUP BY ALL""",
    "unmapped_game_types": """
        SELECT game_type_raw, provider, count(DISTINCT game_id) AS games_affected, count(activity_id) AS activities_affected
        FROM dim_game LEFT JOIN fct_activity USING (game_id) WHERE canonical_game_type IS NULL GROUP BY ALL""",

    "latest_netent": newest("cdc_netent_rounds", "round_ref", "player_ref DESC, game_ref DESC, bet_amount DESC"),
    "latest_evolution": newest("cdc_evolution_transactions", "tx_id", "player_ref DESC, table_ref DESC, amount_cents DESC"),
    "latest_playtech": newest("cdc_playtech_rounds", "round_ref", "player_ref DESC, game_code DESC, stake DESC"),
    "latest_aggregator": newest("cdc_aggregator_rounds", "round_ref", "player_ref DESC, game_ref DESC, bet DESC"),
    "evolution_rounds": f"""
        SELECT round_ref, min(player_ref) AS player_ref, min(table_ref) AS table_ref, min(tx_ts) AS ts,
               CAST(coalesce(sum(amount_cents) FILTER (tx_type = 'BET'), 0) * 0.01 AS {MONEY}) AS bet,
               CAST(coalesce(sum(amount_cents) FILTER (tx_type = 'WIN'), 0) * 0.01 AS {MONEY}) AS win
        FROM latest_evolution GROUP BY round_ref""",
    "stg_rounds": f"""
        SELECT r.round_id, r.provider, r.account_id, g.game_id, r.wager, r.payout, r.jackpot_contribution,
               r.jackpot_id, r.session_id, r.round_ts
        FROM (
          SELECT 'NE:' || round_ref AS round_id, 'NetEnt' AS provider, player_ref AS account_id, game_ref AS ref,
                 bet_amount AS wager, win_amount AS payout, coalesce(jp_contribution, 0) AS jackpot_contribution,
                 jp_id AS jackpot_id, session_ref AS session_id, round_ts FROM latest_netent
          UNION ALL BY NAME SELECT 'EV:' || round_ref AS round_id, 'Evolution' AS provider, player_ref AS account_id,
                 table_ref AS ref, bet AS wager, win AS payout, CAST(0 AS {MONEY}) AS jackpot_contribution, ts AS round_ts FROM evolution_rounds
          UNION ALL BY NAME SELECT 'PT:' || round_ref AS round_id, 'Playtech' AS provider, player_ref AS account_id,
                 game_code AS ref, stake AS wager, payout, CAST(0 AS {MONEY}) AS jackpot_contribution, round_ts FROM latest_playtech
          UNION ALL BY NAME SELECT 'AG:' || round_ref AS round_id, sub_provider AS provider, player_ref AS account_id,
                 game_ref AS ref, bet AS wager, win AS payout, CAST(0 AS {MONEY}) AS jackpot_contribution, round_ts FROM latest_aggregator) r
        JOIN stg_games g ON g.provider = r.provider AND g.provider_game_ref = r.ref""",
    "fct_contributions": """
        SELECT k.contribution_id, k.account_id, k.jackpot_id, k.game_id, k.trigger_type, k.trigger_ref, k.amount,
               k.session_id, k.contributed_at,
               CASE WHEN k.trigger_type = 'SPORTS_BET'
                         AND k.trigger_ref IN (SELECT slip_id FROM fct_lifecycle WHERE slip_status = 'VOIDED') THEN 'REFUNDED'
                    WHEN k.trigger_type = 'GAMING_ROUND'
                         AND k.trigger_ref IN (SELECT round_id FROM game_round_voids) THEN 'REFUNDED'
                    ELSE 'ACTIVE' END AS status
        FROM stg_operator_jackpot_contributions k""",
    "fct_activity": f"""
        SELECT round_id AS activity_id, account_id, game_id, 'CASINO_ROUND' AS vertical, wager AS stake, payout,
               CAST(0 AS {MONEY}) AS rake_or_fee, jackpot_contribution, jackpot_id, session_id, round_ts AS occurred_at
        FROM stg_rounds
        UNION ALL SELECT activity_id, account_id, game_id, if(kind = 'CASH_HAND', 'POKER_CASH', 'POKER_TOURNAMENT'),
               amount_in, amount_out, rake_or_fee, 0, NULL, session_id, activity_ts FROM stg_poker_activity
        UNION ALL SELECT contribution_id, account_id, game_id, 'OPERATOR_JACKPOT', amount, 0, 0, 0, NULL, session_id,
               contributed_at FROM fct_contributions WHERE status = 'ACTIVE'
        UNION ALL SELECT win_id, account_id, game_id, 'OPERATOR_JACKPOT', 0, amount, 0, 0, NULL, session_id, win_ts
        FROM stg_operator_jackpot_wins""",
    "pool_liability": """
        SELECT p.jackpot_id, p.jackpot_name, p.seed_amount, p.contribution_rate, coalesce(i.v, 0) AS total_contributions,
               coalesce(o.v, 0) AS total_wins, p.seed_amount + coalesce(i.v, 0) - coalesce(o.v, 0) AS pool_balance
        FROM jackpot_pools p
        LEFT JOIN (SELECT jackpot_id, sum(jackpot_contribution) AS v FROM stg_rounds GROUP BY 1) i USING (jackpot_id)
        LEFT JOIN (SELECT jackpot_id, sum(amount) AS v FROM jackpot_wins GROUP BY 1) o USING (jackpot_id)""",
    "operator_pool_liability": """
        SELECT p.jackpot_id, p.jackpot_name, p.seed_amount, coalesce(i.v, 0) AS total_contributions,
               coalesce(o.v, 0) AS total_wins, p.seed_amount + coalesce(i.v, 0) - coalesce(o.v, 0) AS pool_balance
        FROM operator_jackpot_pools p
        LEFT JOIN (SELECT jackpot_id, sum(amount) FILTER (status = 'ACTIVE') AS v FROM fct_contributions GROUP BY 1) i USING (jackpot_id)
        LEFT JOIN (SELECT jackpot_id, sum(amount) AS v FROM stg_operator_jackpot_wins GROUP BY 1) o USING (jackpot_id)""",

    "platform_sessions": """
        SELECT s.session_id, s.account_id, s.started_at, s.last_activity_ts, s.ended_at, s.end_reason,
               count(a.activity_id) AS plays, coalesce(sum(a.stake), 0) AS staked, coalesce(sum(a.payout), 0) AS won,
               min(a.occurred_at) AS first_play_ts, max(a.occurred_at) AS last_play_ts
        FROM stg_gaming_sessions s LEFT JOIN fct_activity a USING (session_id) GROUP BY 1, 2, 3, 4, 5, 6""",
    "session_activity": """
        SELECT activity_id, account_id, session_id, session_id || ':' || game_id AS game_session_id, game_id, stake,
               payout, occurred_at FROM fct_activity WHERE session_id IS NOT NULL""",
    "game_sessions": """
        SELECT game_session_id, min(session_id) AS session_id, min(account_id) AS account_id, min(game_id) AS game_id,
               min(occurred_at) AS started_at, max(occurred_at) AS ended_at, count(*) AS rounds,
               count(*) FILTER (payout > 0) AS rounds_won, sum(stake) AS staked, sum(payout) AS won
        FROM session_activity GROUP BY 1""",
    "platform_session_file": f"""
        SELECT jurisdiction, {day('ended_at')} AS report_date, session_id, account_id,
               {civil('started_at')} AS started_at_local, {civil('ended_at')} AS ended_at_local, end_reason, plays, staked, won
        FROM platform_sessions JOIN stg_accounts USING (account_id) JOIN market USING (jurisdiction)
        WHERE session_grain = 'platform' AND ended_at IS NOT NULL AND (plays > 0 OR file_empty_sessions)""",
    "game_session_file": f"""
        SELECT m.jurisdiction, {day('p.ended_at')} AS report_date, gs.game_session_id, gs.session_id, gs.account_id,
               gs.game_id, g.game_name, {civil('gs.started_at')} AS started_at_local,
               {civil('gs.ended_at')} AS ended_at_local, p.end_reason, gs.rounds, gs.rounds_won, gs.staked, gs.won
        FROM game_sessions gs JOIN platform_sessions p ON p.session_id = gs.session_id
        JOIN stg_accounts a ON a.account_id = gs.account_id JOIN market m ON m.jurisdiction = a.jurisdiction
        LEFT JOIN dim_game g ON g.game_id = gs.game_id
        WHERE m.session_grain = 'per_game' AND p.ended_at IS NOT NULL""",

    "fct_payments": """
        SELECT payment_id, account_id, jurisdiction, direction, amount, method, status, requested_ts, completed_ts
        FROM stg_payments JOIN stg_accounts USING (account_id)""",
    "fct_gambling": """
        SELECT account_id, jurisdiction, settled_at AS occurred_at, stake, payout, 'BET' AS source
        FROM fct_lifecycle JOIN stg_accounts USING (account_id) WHERE slip_status = 'SETTLED'
        UNION ALL SELECT account_id, jurisdiction, occurred_at, stake, payout, vertical
        FROM fct_activity JOIN stg_accounts USING (account_id)""",
    "fct_ledger": f"""
        SELECT account_id, ref, ts, entry_type, CAST(v AS {MONEY}) AS signed_amount FROM (
          SELECT account_id, payment_id AS ref, completed_ts AS ts, direction AS entry_type,
                 if(direction = 'DEPOSIT', amount, -amount) AS v FROM fct_payments WHERE status = 'COMPLETED'
          UNION ALL SELECT account_id, slip_id, placed_at, 'BET_STAKE', -stake FROM fct_lifecycle WHERE slip_status <> 'VOIDED'
          UNION ALL SELECT account_id, slip_id, settled_at, 'BET_PAYOUT', payout FROM fct_lifecycle WHERE payout > 0
          UNION ALL SELECT account_id, activity_id, occurred_at,
                 if(vertical = 'OPERATOR_JACKPOT', 'JACKPOT_CONTRIBUTION', 'GAMING_STAKE'), -stake FROM fct_activity WHERE stake > 0
          UNION ALL SELECT account_id, activity_id, occurred_at,
                 if(vertical = 'OPERATOR_JACKPOT', 'JACKPOT_WIN', 'GAMING_PAYOUT'), payout FROM fct_activity WHERE payout > 0
          UNION ALL SELECT account_id, win_id, win_ts, 'PROVIDER_JACKPOT_WIN', amount FROM jackpot_wins)""",
    "dim_balance": """
        SELECT account_id, jurisdiction, sum(signed_amount) AS balance
        FROM fct_ledger JOIN stg_accounts USING (account_id) GROUP BY ALL""",
    "dim_compliance": """
        SELECT a.account_id, a.jurisdiction, coalesce(v.status, 'UNVERIFIED') AS verification_status,
               v.event_ts AS verification_ts, x.source AS open_exclusion_source,
               l.d AS personal_daily_limit, l.w AS personal_weekly_limit, l.m AS personal_monthly_limit
        FROM stg_accounts a
        LEFT JOIN (SELECT * FROM stg_verifications WHERE check_type = 'IDENTITY'
                   QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY event_ts DESC, verification_id DESC) = 1) v USING (account_id)
        LEFT JOIN (SELECT account_id, min(source) AS source FROM stg_self_exclusions WHERE end_ts IS NULL GROUP BY 1) x USING (account_id)
        LEFT JOIN (SELECT account_id, max(amount) FILTER (limit_type = 'DEPOSIT_DAILY') AS d,
                          max(amount) FILTER (limit_type = 'DEPOSIT_WEEKLY') AS w,
                          max(amount) FILTER (limit_type = 'DEPOSIT_MONTHLY') AS m
                   FROM stg_player_limits WHERE revoked_at IS NULL GROUP BY 1) l USING (account_id)""",
    "periods": "SELECT * FROM (VALUES ('DAILY', 'day'), ('WEEKLY', 'week'), ('MONTHLY', 'month')) v(period, unit)",
    "deposit_limits": """
        SELECT account_id, jurisdiction, period, personal_limit, default_limit,
               least(coalesce(personal_limit, default_limit), coalesce(default_limit, personal_limit)) AS effective_limit
        FROM (SELECT account_id, jurisdiction, period,
                     CASE period WHEN 'DAILY' THEN personal_daily_limit WHEN 'WEEKLY' THEN personal_weekly_limit ELSE personal_monthly_limit END AS personal_limit,
                     CASE period WHEN 'DAILY' THEN default_daily WHEN 'WEEKLY' THEN default_weekly ELSE default_monthly END AS default_limit
              FROM dim_compliance JOIN market USING (jurisdiction) CROSS JOIN periods)""",
    "breach_deposit_limits": f"""
        SELECT account_id, jurisdiction, period, window_start, deposited, effective_limit
        FROM (SELECT p.account_id, p.jurisdiction, q.period,
                     CAST(date_trunc(q.unit, {day('p.completed_ts', 'm.timezone')}) AS DATE) AS window_start, sum(p.amount) AS deposited
              FROM fct_payments p JOIN market m USING (jurisdiction) CROSS JOIN periods q
              WHERE p.direction = 'DEPOSIT' AND p.status = 'COMPLETED' GROUP BY 1, 2, 3, 4)
        JOIN deposit_limits USING (account_id, jurisdiction, period) WHERE deposited > effective_limit""",
    "loss_limits": """
        SELECT account_id, replace(limit_type, 'LOSS_', '') AS period, max(amount) AS loss_limit, min(amount) AS lowest
        FROM stg_player_limits WHERE revoked_at IS NULL AND limit_type LIKE 'LOSS_%' GROUP BY 1, 2""",
    "breach_loss_limits": f"""
        SELECT account_id, jurisdiction, period, window_start, net_loss, loss_limit
        FROM (SELECT g.account_id, g.jurisdiction, q.period,
                     CAST(date_trunc(q.unit, {day('g.occurred_at', 'm.timezone')}) AS DATE) AS window_start, sum(g.stake - g.payout) AS net_loss
              FROM fct_gambling g JOIN market m USING (jurisdiction) CROSS JOIN periods q GROUP BY 1, 2, 3, 4)
        JOIN loss_limits USING (account_id, period) WHERE net_loss > loss_limit""",
    "breach_activity_while_excluded": """
        SELECT x.account_id, x.source AS exclusion_source, t.kind AS activity_type, t.ref AS activity_ref, t.ts AS activity_ts
        FROM stg_self_exclusions x JOIN (
          SELECT account_id, 'DEPOSIT' AS kind, payment_id AS ref, completed_ts AS ts FROM fct_payments
          WHERE direction = 'DEPOSIT' AND status = 'COMPLETED'
          UNION ALL SELECT account_id, 'BET_PLACED', slip_id, placed_at FROM fct_lifecycle
          UNION ALL SELECT account_id, 'GAMING_ACTIVITY', activity_id, occurred_at FROM fct_activity) t
        ON t.account_id = x.account_id AND t.ts >= x.start_ts AND t.ts < coalesce(x.end_ts, TIMESTAMP '9999-01-01')""",
    "breach_unverified_withdrawals": """
        SELECT payment_id, account_id, jurisdiction, amount, completed_ts
        FROM fct_payments p JOIN market USING (jurisdiction)
        WHERE direction = 'WITHDRAWAL' AND status = 'COMPLETED' AND withdrawal_needs_identity
          AND NOT EXISTS (FROM stg_verifications v WHERE v.account_id = p.account_id AND v.check_type = 'IDENTITY'
                          AND v.status = 'VERIFIED' AND v.event_ts <= p.completed_ts)""",
    "breach_wallet_overspend": """
        SELECT account_id, ts, entry_type, signed_amount,
               sum(signed_amount) OVER (PARTITION BY account_id ORDER BY ts, signed_amount DESC, entry_type, ref
                                        ROWS UNBOUNDED PRECEDING) AS running_balance
        FROM fct_ledger QUALIFY running_balance < 0""",
    "stake_caps": """
        SELECT account_id, min(amount) AS personal FROM stg_player_limits
        WHERE limit_type = 'STAKE_CASINO' AND revoked_at IS NULL GROUP BY 1""",
    "breach_stake_limits": f"""
        SELECT activity_id, account_id, jurisdiction, vertical, stake, cap AS effective_limit, occurred_at
        FROM (SELECT g.activity_id, g.account_id, a.jurisdiction, g.vertical, g.stake, g.occurred_at,
                     least(coalesce(min(b.max_stake), c.personal), coalesce(c.personal, min(b.max_stake))) AS cap
              FROM fct_activity g JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction)
              LEFT JOIN dim_game d ON d.game_id = g.game_id LEFT JOIN stake_caps c ON c.account_id = g.account_id
              LEFT JOIN bands b ON b.jurisdiction = a.jurisdiction AND d.canonical_game_type = 'SLOT'
                AND floor(date_diff('day', a.date_of_birth, {day('g.occurred_at', 'm.timezone')}) / 365.2425)
                    BETWEEN b.min_age AND coalesce(b.max_age, 999)
                AND {valid_on(day('g.occurred_at', 'm.timezone'), 'b')}
              GROUP BY ALL, c.personal)
        WHERE stake > cap""".replace("GROUP BY ALL, c.personal",
                                     "GROUP BY g.activity_id, g.account_id, a.jurisdiction, g.vertical, g.stake, g.occurred_at, c.personal"),

    "addresses": """
        SELECT d.account_id, a.jurisdiction, d.postcode, r.region_name,
               coalesce(regexp_matches(d.postcode, m.postcode_pattern), TRUE) AS postcode_valid,
               CASE WHEN NOT regexp_matches(d.postcode, m.postcode_pattern) THEN 'postcode_format'
                    WHEN m.region_required AND r.region_name IS NULL THEN 'region_not_found' END AS fail_reason,
               CASE WHEN NOT regexp_matches(d.postcode, m.postcode_pattern) THEN 'DATA'
                    WHEN m.region_required AND r.region_name IS NULL THEN 'TRANSIENT' END AS error_class
        FROM stg_account_addresses d JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction)
        LEFT JOIN postcode_regions r ON d.postcode LIKE r.postcode_prefix || ' %'""",
    "terminal_periods": f"""
        SELECT account_id, jurisdiction, {day('coalesce(settled_at, voided_at)')} AS report_date
        FROM fct_lifecycle JOIN stg_accounts USING (account_id) JOIN market USING (jurisdiction)
        WHERE slip_status <> 'OPEN'""",
    "readiness": f"""
        SELECT DISTINCT t.jurisdiction, t.report_date,
               coalesce({day('w.complete_through', 'm.timezone')} > t.report_date, FALSE) AS is_ready
        FROM terminal_periods t JOIN market m USING (jurisdiction)
        LEFT JOIN source_watermarks w ON w.source = 'bet_settlement' AND w.jurisdiction = t.jurisdiction""",
    "retry_state": f"""
        SELECT 'ADDRESS' AS entity_type, account_id AS entity_id, fail_reason AS reason_code, 'TRANSIENT' AS error_class,
               n AS attempt_count, first_seen,
               CASE WHEN n <= {markets.MAX_ATTEMPTS} THEN TIMESTAMP '{RUN_TS}' + to_minutes(CAST({markets.BACKOFF_MINUTES} * pow(2, n - 1) AS INTEGER)) END AS next_retry_at,
               CASE WHEN n <= {markets.MAX_ATTEMPTS} THEN 'RETRYING' ELSE 'QUARANTINED' END AS status
        FROM (SELECT a.account_id, a.fail_reason, coalesce(p.first_seen, TIMESTAMP '{RUN_TS}') AS first_seen,
                     CAST(coalesce(p.attempt_count, 0) + CASE WHEN p.entity_id IS NULL OR p.next_retry_at <= TIMESTAMP '{RUN_TS}' THEN 1 ELSE 0 END AS INTEGER) AS n
              FROM addresses a LEFT JOIN exception_state p ON p.entity_id = a.account_id AND p.reason_code = a.fail_reason
              WHERE a.error_class = 'TRANSIENT')
        UNION ALL SELECT * FROM resolved_rows""",
    "resolved_rows": """
        SELECT entity_type, entity_id, reason_code, error_class, attempt_count, first_seen,
               CAST(NULL AS TIMESTAMP) AS next_retry_at, 'RESOLVED' AS status
        FROM exception_state p WHERE (entity_id, reason_code) NOT IN (
          SELECT account_id, fail_reason FROM addresses WHERE error_class = 'TRANSIENT')""",
    "holds": "\n        UNION ALL ".join(
        f"SELECT DISTINCT account_id, '{kind}' AS breach FROM breach_{table}" for kind, table in [
            ("deposit_limit", "deposit_limits"), ("loss_limit", "loss_limits"), ("wallet_overspend", "wallet_overspend"),
            ("activity_while_excluded", "activity_while_excluded"), ("unverified_withdrawal", "unverified_withdrawals"),
            ("stake_limit", "stake_limits")]),
    "fct_exceptions": """
        SELECT 'ACCOUNT' AS block_scope, 'ADDRESS' AS entity_type, account_id, CAST(NULL AS DATE) AS report_date,
               'postcode_format' AS reason_code, 'DATA' AS error_class, 'ERROR' AS severity, 'QUARANTINED' AS status,
               CAST(NULL AS INTEGER) AS attempt_count, CAST(NULL AS TIMESTAMP) AS next_retry_at
        FROM addresses WHERE error_class = 'DATA'
        UNION ALL SELECT 'ACCOUNT', 'ADDRESS', entity_id, NULL, reason_code, 'TRANSIENT', 'WARNING', status, attempt_count,
               next_retry_at FROM retry_state WHERE status <> 'RESOLVED'
        UNION ALL SELECT 'PERIOD', 'PERIOD', t.account_id, t.report_date, 'period_not_complete', 'COMPLETENESS', 'WARNING',
               'WAITING_DATA', NULL, NULL FROM terminal_periods t JOIN readiness USING (jurisdiction, report_date) WHERE NOT is_ready
        UNION ALL SELECT 'ACCOUNT', 'COMPLIANCE', account_id, NULL, breach, 'COMPLIANCE', 'CRITICAL', 'HELD', NULL, NULL FROM holds""",
    "blocked": "SELECT DISTINCT account_id FROM fct_exceptions WHERE block_scope = 'ACCOUNT'",
    "reportable": f"""
        SELECT l.*, a.jurisdiction, a.national_id, m.timezone, m.include_voided, m.tax_basis,
               {day('coalesce(l.settled_at, l.voided_at)', 'm.timezone')} AS report_date
        FROM fct_lifecycle l JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction)
        WHERE l.slip_status <> 'OPEN'""",
    "admissible": """
        SELECT r.* FROM reportable r JOIN readiness q USING (jurisdiction, report_date)
        WHERE q.is_ready AND NOT EXISTS (FROM blocked b WHERE b.account_id = r.account_id)""",
    "attributes": "SELECT entity_id AS slip_id, " + ", ".join(
        f"max(attr_value) FILTER (attr_name = '{n}') AS {n}" for n in markets.CARRIED
    ) + " FROM stg_reg_attributes WHERE entity_type = 'SLIP' GROUP BY 1",
    "betting_file": f"""
        SELECT s.jurisdiction, s.report_date, s.slip_id, s.account_id, s.slip_status, sha256(s.national_id) AS player_dni_hash,
               s.stake, s.payout, s.stake - s.payout AS ggr, {civil('s.placed_at', 's.timezone')} AS placed_at_local,
               {civil('s.settled_at', 's.timezone')} AS settled_at_local,
               coalesce(k.regulator_code, p.default_sport_code) AS sport_code,
               replace(replace(p.event_template, '{{home}}', f.home_name), '{{away}}', f.away_name) AS event_name,
               {', '.join(f'sha256(s.national_id) AS {n}' for n in markets.HASH_NAMES)},
               CASE s.jurisdiction {' '.join(
                   f"WHEN '{m}' THEN round(" + ' + '.join(
                       f"{r} * greatest({f'least(s.payout, {hi})' if hi else 's.payout'} - {lo}, 0)"
                       for mm, lo, hi, r in markets.WITHHOLDING if mm == m) + ", 2)"
                   for m in sorted({w[0] for w in markets.WITHHOLDING}))} END AS winnings_withholding_tax,
               {', '.join(f'x.{n}' for n in markets.CARRIED)}
        FROM admissible s JOIN sport_policy p ON p.jurisdiction = s.jurisdiction
        LEFT JOIN dim_fixture f ON f.fixture_id = s.fixture_id
        LEFT JOIN map_sport k ON k.jurisdiction = s.jurisdiction AND k.canonical_sport = f.canonical_sport
          AND {valid_on('s.report_date', 'k')}
        LEFT JOIN attributes x ON x.slip_id = s.slip_id
        WHERE s.slip_status = 'SETTLED' OR s.include_voided""",
    "betting_tax": """
        SELECT t.jurisdiction, t.report_date, t.settled_slips, t.total_stake, t.total_payout,
               round(CASE t.tax_basis WHEN 'turnover' THEN t.total_stake ELSE t.total_stake - t.total_payout END * r.rate, 2) AS tax_due
        FROM (SELECT jurisdiction, report_date, tax_basis, count(*) AS settled_slips,
                     CAST(sum(stake) AS DECIMAL(18,2)) AS total_stake, CAST(sum(payout) AS DECIMAL(18,2)) AS total_payout
              FROM admissible WHERE slip_status = 'SETTLED' GROUP BY 1, 2, 3) t
        LEFT JOIN betting_rates r ON r.jurisdiction = t.jurisdiction AND """ + valid_on("t.report_date", "r"),
    "registers": """
        SELECT jurisdiction, g.id AS register_id, CAST(date_trunc(g.unit, report_date) AS DATE) AS period_start,
               sha256(national_id) AS player_ref, count(*) AS bets_settled, sum(stake) AS stake_sum,
               sum(payout) AS winnings_sum, sum(stake - payout) AS ggr_sum
        FROM admissible JOIN (VALUES """ + ", ".join(
            f"('{m}', '{i}', '{'day' if cad == 'daily' else 'month'}')" for m, i, cad in markets.REGISTERS
        ) + """) g(jur, id, unit) ON g.jur = jurisdiction WHERE slip_status = 'SETTLED' GROUP BY 1, 2, 3, 4""",
    "gaming_reportable": f"""
        SELECT g.*, a.jurisdiction, a.national_id, m.timezone, m.deduct_contributions,
               {day('g.occurred_at', 'm.timezone')} AS report_date,
               CASE WHEN g.vertical = 'CASINO_ROUND' AND m.deduct_contributions THEN g.stake - g.payout - g.jackpot_contribution
                    WHEN g.vertical IN ('CASINO_ROUND', 'OPERATOR_JACKPOT') THEN g.stake - g.payout ELSE g.rake_or_fee END AS revenue
        FROM fct_activity g JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction)
        JOIN game_policy USING (jurisdiction)""",
    "gaming_file": f"""
        SELECT g.jurisdiction, g.report_date, g.activity_id, g.account_id, sha256(g.national_id) AS player_dni_hash,
               d.game_name, g.vertical, g.stake, g.payout, g.rake_or_fee,
               {civil('g.occurred_at', 'g.timezone')} AS occurred_at_local,
               coalesce(k.regulator_code, p.default_game_code) AS game_code, g.revenue AS gaming_ggr
        FROM gaming_reportable g JOIN game_policy p USING (jurisdiction) LEFT JOIN dim_game d ON d.game_id = g.game_id
        LEFT JOIN map_game k ON k.jurisdiction = g.jurisdiction AND k.canonical_game_type = d.canonical_game_type
          AND {valid_on('g.report_date', 'k')}""",
    "gaming_tax": """
        SELECT t.jurisdiction, t.report_date, t.activities, t.total_stake, t.total_payout, t.total_ggr,
               round(t.total_ggr * r.rate, 2) AS gaming_tax_due
        FROM (SELECT jurisdiction, report_date, count(*) AS activities, CAST(sum(stake) AS DECIMAL(18,2)) AS total_stake,
                     CAST(sum(payout) AS DECIMAL(18,2)) AS total_payout, CAST(sum(revenue) AS DECIMAL(18,2)) AS total_ggr
              FROM gaming_reportable GROUP BY 1, 2) t
        LEFT JOIN gaming_rates r ON r.jurisdiction = t.jurisdiction AND """ + valid_on("t.report_date", "r"),
    "slip_amounts": """
        SELECT slip_id, account_id, jurisdiction, fixture_id, selection, odds,
               min(event_ts) FILTER (event_type = 'PLACED') AS placed_at, max(stake) FILTER (event_type = 'PLACED') AS stake,
               min(event_ts) FILTER (event_type = 'SETTLED') AS settled_at, max(payout) FILTER (event_type = 'SETTLED') AS payout,
               min(event_ts) FILTER (event_type = 'VOIDED') AS voided_at
        FROM stg_bet_slip_events JOIN stg_bet_slips USING (slip_id) JOIN stg_accounts USING (account_id) GROUP BY ALL""",
})
