"""The derived change feeds once more, as DuckDB SQL over the same tables.

``CTES`` maps a relation name to a query that may name other relations. The
check SQL of a query is the chain of relations it needs, so it never touches
Spark or the code in ``derive``.
"""

from __future__ import annotations

from ..markets import MARKETS
from .derive import GAME_LABELS, PAY_METHODS, PLAY_GAMES, RUN_TS, SELECTIONS, SPORT_LABELS, TEAM_LABELS


def text(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def pick(values: list[str], index: str) -> str:
    return f"list_extract([{', '.join(map(text, values))}], CAST(({index}) % {len(values)} AS INTEGER) + 1)"


def money(minor: str) -> str:
    return f"CAST(CAST({minor} AS DECIMAL(16,0)) * 0.01 AS DECIMAL(18,2))"


def key(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS VARCHAR), {width}, '0')"


def acct(number: str) -> str:
    return key("A", number, 10)


_market = pick(MARKETS, "{k}")
_sport = "CASE p_type " + " ".join(f"WHEN {text(a)} THEN {text(b)}" for a, b in SPORT_LABELS.items()) + " END"
_zero = "CAST(0 AS DECIMAL(18,2))"


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


CTES: dict[str, str] = {
    "d_customers": f"""
        SELECT c_custkey AS k, {acct('c_custkey')} AS account_id, {_market.format(k='c_custkey')} AS jurisdiction,
               c_nationkey AS nation, c_acctbal AS bal,
               TIMESTAMP '2019-06-01' + to_minutes(CAST(c_custkey * 61 % 200000 AS INTEGER)) AS opened_at
        FROM customer""",
    "cdc_accounts": """
        SELECT account_id, jurisdiction, 'ID' || CAST(k * 7919 % 99999989 AS VARCHAR) AS national_id,
               CAST(DATE '1955-01-01' + CAST(k * 37 % 18993 AS INTEGER) AS DATE) AS date_of_birth,
               v.kyc AS kyc_status, opened_at, v.op AS _op, opened_at + to_days(v.lag) AS _commit_ts
        FROM d_customers CROSS JOIN (VALUES ('PENDING', 'I', 0), ('VERIFIED', 'U', 1), ('PENDING', 'D', 2)) v(kyc, op, lag)
        WHERE v.op = 'I' OR (v.op = 'U' AND k % 3 <> 0) OR (v.op = 'D' AND k % 97 = 96)""",
    "cdc_fixtures": f"""
        SELECT {key('F', 'p_partkey', 10)} AS fixture_id, {_sport} AS sport_name_raw, p_brand AS competition_raw,
               {pick(TEAM_LABELS, 'p_partkey')} AS home_raw, {pick(TEAM_LABELS, 'p_partkey // 10 + 1')} AS away_raw,
               TIMESTAMP '2020-01-01' + to_days(CAST(p_partkey % 2000 AS INTEGER))
                 + (CASE WHEN v.op = 'U' THEN INTERVAL 90 MINUTE ELSE INTERVAL 0 MINUTE END) AS start_ts,
               v.op AS _op,
               TIMESTAMP '2020-01-01' + to_days(CAST(p_partkey % 2000 AS INTEGER)) - to_days(v.lead) AS _commit_ts
        FROM part CROSS JOIN (VALUES ('I', 9), ('U', 2), ('D', 1)) v(op, lead)
        WHERE v.op = 'I' OR (v.op = 'U' AND p_partkey % 10 = 0) OR (v.op = 'D' AND p_partkey % 101 = 100)""",
    "d_orders": f"""
        SELECT *, placed_at + to_hours(CAST(k % 72 + 1 AS INTEGER)) AS settled_ts,
               CASE WHEN k % 5 = 0 THEN placed_at + to_hours(CAST(k % 72 + 1 AS INTEGER)) + INTERVAL 1 DAY
                    ELSE placed_at + INTERVAL 2 HOUR END AS voided_ts
        FROM (SELECT o_orderkey AS k, o_custkey AS cust, {key('S', 'o_orderkey', 12)} AS slip_id,
                     {acct('o_custkey')} AS account_id, {key('F', 'o_orderkey // 10', 10)} AS fixture_id,
                     o_orderdate + INTERVAL 25 YEAR + to_seconds(CAST(o_orderkey * 7919 % 86400 AS INTEGER)) AS placed_at,
                     CAST(floor(o_totalprice / 100) AS BIGINT) AS stake_c,
                     CAST(floor(o_totalprice / 100) AS BIGINT) * (o_orderkey * 31 % 9) * 25 // 100 AS payout_c,
                     o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 5 <> 1) AS settles,
                     o_orderstatus = 'P' AND o_orderkey % 5 < 2 AS voids
              FROM orders)""",
    "cdc_bet_slips": f"""
        SELECT slip_id, account_id, fixture_id, 'SINGLE' AS product, {pick(SELECTIONS, 'k')} AS selection,
               {money('k % 400 + 120')} AS odds, 'I' AS _op, placed_at AS _commit_ts FROM d_orders""",
    "cdc_bet_slip_events": f"""
        SELECT slip_id, 'PLACED' AS event_type, placed_at AS event_ts, {money('stake_c')} AS stake,
               {_zero} AS payout, placed_at AS _commit_ts FROM d_orders
        UNION ALL SELECT slip_id, 'SETTLED', settled_ts, {_zero}, {money('payout_c')}, settled_ts
        FROM d_orders WHERE settles
        UNION ALL SELECT slip_id, 'SETTLED', settled_ts, {_zero}, {money('payout_c + 100')},
               settled_ts + INTERVAL 5 MINUTE FROM d_orders WHERE settles AND k % 11 = 0
        UNION ALL SELECT slip_id, 'VOIDED', voided_ts, {_zero}, {_zero}, voided_ts FROM d_orders WHERE voids
        UNION ALL SELECT slip_id, 'CASHOUT_QUOTE', placed_at, {_zero}, {_zero}, placed_at
        FROM d_orders WHERE k % 17 = 0""",
    "cdc_reg_attributes": f"""
        WITH named AS (
          SELECT k, placed_at, slip_id, {_market.format(k='cust')} AS m, upper(md5(slip_id)) AS h,
                 CASE WHEN k % 31 = 0 THEN 'x' ELSE '' END AS bad FROM d_orders WHERE k % 29 <> 0),
        good AS (
          SELECT k, placed_at, slip_id, 'safe_tampertoken' AS n, 'TT-' || h[1:8] || bad AS v FROM named WHERE m = 'DK'
          UNION ALL SELECT k, placed_at, slip_id, 'nra_registration_id', {key('BG-2024-', 'k % 1000000000', 9)} || bad FROM named WHERE m = 'BG'
          UNION ALL SELECT k, placed_at, slip_id, 'cruks_check_ref', 'CRUKS-' || h[1:8] || bad FROM named WHERE m = 'NL'
          UNION ALL SELECT k, placed_at, slip_id, 'cdb_record_id', {key('NL-CDB-', 'k', 10)} || bad FROM named WHERE m = 'NL'
          UNION ALL SELECT k, placed_at, slip_id, 'lugas_activity_id', 'LUGAS-' || h[1:12] || bad FROM named WHERE m = 'DE')
        SELECT 'SLIP' AS entity_type, slip_id AS entity_id, n AS attr_name, v AS attr_value, placed_at AS _commit_ts FROM good
        UNION ALL SELECT 'SLIP', slip_id, n, 'stale', placed_at - INTERVAL 1 MINUTE FROM good WHERE k % 17 = 0""",
    "d_lines": f"""
        SELECT *, CASE WHEN ok % 7 <> 0 THEN 'GS' || lpad(CAST(cust AS VARCHAR), 10, '0') || strftime(ts, '%Y%m%d') END AS session_ref,
               CASE WHEN ok % 53 = 52 THEN 'D' ELSE 'I' END AS _op, ts AS _commit_ts
        FROM (SELECT l_orderkey AS ok, l_linenumber AS ln, l_suppkey AS sk, l_partkey AS pk, l_suppkey % 5 AS feed,
                     lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || CAST(l_linenumber AS VARCHAR) AS round_ref,
                     l_partkey * 3 // 4 AS cust, {acct('l_partkey * 3 // 4')} AS player_ref,
                     'R' || CAST(l_suppkey AS VARCHAR) AS game_ref, {key('G', 'l_suppkey', 8)} AS game_id,
                     l_shipdate + INTERVAL 25 YEAR
                       + to_seconds(CAST((l_orderkey * 131 + l_linenumber * 977) % 86400 AS INTEGER)) AS ts,
                     CAST(floor(l_extendedprice / 200) AS BIGINT) AS stake_c,
                     CAST(floor(l_extendedprice / 200) AS BIGINT) * (l_orderkey * 17 % 8) * 20 // 100 AS payout_c
              FROM lineitem)""",
    "cdc_netent_rounds": f"""
        SELECT round_ref, player_ref, game_ref, {money('stake_c')} AS bet_amount, {money('payout_c')} AS win_amount,
               {money('(stake_c + 50) // 100 + CASE WHEN ok % 41 = 0 THEN 1 ELSE 0 END')} AS jp_contribution,
               'JP' || CAST(sk % 7 AS VARCHAR) AS jp_id, session_ref, ts AS round_ts, _op, _commit_ts
        FROM d_lines WHERE feed = 0""",
    "cdc_evolution_transactions": """
        SELECT round_ref || '-' || t.kind AS tx_id, round_ref, player_ref, game_ref AS table_ref, t.kind AS tx_type,
               CASE t.kind WHEN 'BET' THEN stake_c ELSE payout_c END AS amount_cents, ts AS tx_ts, _op, _commit_ts
        FROM d_lines CROSS JOIN (VALUES ('BET'), ('WIN')) t(kind) WHERE feed = 1""",
    "cdc_playtech_rounds": f"""
        SELECT round_ref, player_ref, game_ref AS game_code, {money('stake_c')} AS stake, {money('payout_c')} AS payout,
               ts AS round_ts, _op, _commit_ts FROM d_lines WHERE feed = 2""",
    "cdc_aggregator_rounds": f"""
        SELECT round_ref, {pick(['Spribe', 'Hacksaw'], 'sk // 5')} AS sub_provider, player_ref, game_ref,
               {money('stake_c')} AS bet, {money('payout_c')} AS win, ts AS round_ts, _op, _commit_ts
        FROM d_lines WHERE feed = 3""",
    "cdc_poker_activity": f"""
        SELECT 'PK' || round_ref AS activity_id, player_ref AS account_id, game_id,
               CASE WHEN ok % 19 = 0 THEN 'PLAY_MONEY' ELSE {pick(['CASH_HAND', 'TOURNAMENT_ENTRY'], 'sk // 5')} END AS kind,
               {money('stake_c')} AS amount_in, {money('payout_c')} AS amount_out, {money('stake_c * 5 // 100')} AS rake_or_fee,
               session_ref AS session_id, ts AS activity_ts, _op, _commit_ts FROM d_lines WHERE feed = 4""",
    "d_sessions": """
        SELECT session_ref AS session_id, player_ref AS account_id, cust, min(ts) AS first_ts, max(ts) AS last_ts
        FROM d_lines WHERE feed IN (0, 4) AND session_ref IS NOT NULL GROUP BY ALL""",
    "cdc_gaming_sessions": """
        SELECT session_id, account_id, first_ts - INTERVAL 60 SECOND AS started_at, last_ts AS last_activity_ts,
               CAST(NULL AS TIMESTAMP) AS ended_at, CAST(NULL AS VARCHAR) AS end_reason,
               first_ts - INTERVAL 60 SECOND AS _commit_ts FROM d_sessions
        UNION ALL
        SELECT session_id, account_id, first_ts - INTERVAL 60 SECOND, last_ts,
               CASE WHEN cust % 10 = 0 THEN NULL WHEN cust % 10 < 7 THEN last_ts + INTERVAL 5 MINUTE
                    WHEN cust % 10 < 9 THEN last_ts + INTERVAL 30 MINUTE ELSE last_ts - INTERVAL 1 MINUTE END,
               CASE WHEN cust % 10 = 0 THEN NULL WHEN cust % 10 < 7 THEN 'LOGOUT'
                    WHEN cust % 10 < 9 THEN 'INACTIVITY' ELSE 'KICKED' END,
               last_ts + INTERVAL 45 MINUTE FROM d_sessions""",
    "cdc_games": f"""
        SELECT {key('G', 's_suppkey', 8)} AS game_id, 'Game ' || CAST(s_suppkey AS VARCHAR) AS game_name,
               CASE s_suppkey % 5 WHEN 0 THEN 'NetEnt' WHEN 1 THEN 'Evolution' WHEN 2 THEN 'Playtech'
                    WHEN 3 THEN {pick(['Spribe', 'Hacksaw'], 's_suppkey // 5')} ELSE 'PokerNet' END AS provider,
               'R' || CAST(s_suppkey AS VARCHAR) AS provider_game_ref,
               CASE s_suppkey % 5 {' '.join(f"WHEN {n} THEN {pick(v, 's_suppkey // 5')}" for n, v in enumerate(GAME_LABELS))} END AS game_type_raw
        FROM supplier
        UNION ALL SELECT 'OJ' || CAST(n_nationkey AS VARCHAR), 'Jackpot ' || CAST(n_nationkey AS VARCHAR), 'Operator',
               'OJ' || CAST(n_nationkey AS VARCHAR), 'Operator Jackpot' FROM nation WHERE n_nationkey < 3""",
    "jackpot_pools": f"""
        SELECT 'JP' || CAST(n_nationkey AS VARCHAR) AS jackpot_id, n_name AS jackpot_name, 'NetEnt' AS provider,
               {money('(n_nationkey + 1) * 100000')} AS seed_amount, CAST(0.01 AS DECIMAL(9,4)) AS contribution_rate
        FROM nation WHERE n_nationkey < 7""",
    "jackpot_wins": f"""
        SELECT {key('JW', 'k', 12)} AS win_id, 'JP' || CAST(k % 7 AS VARCHAR) AS jackpot_id, account_id,
               {money('stake_c * 3')} AS amount, placed_at AS win_ts FROM d_orders WHERE k % 500 = 7""",
    "operator_jackpot_pools": f"""
        SELECT 'OJP' || CAST(n_nationkey AS VARCHAR) AS jackpot_id, n_name AS jackpot_name, {money('50000')} AS seed_amount
        FROM nation WHERE n_nationkey < 3""",
    "stg_jackpot_optins": f"""
        SELECT {key('OPT', 'k', 10)} AS optin_id, account_id, 'OJP0' AS jackpot_id,
               TIMESTAMP '2021-01-01' + to_days(CAST(k % 365 AS INTEGER)) AS opted_in_at,
               CASE WHEN k % 8 = 0 THEN TIMESTAMP '2021-01-01' + to_days(CAST(k % 365 AS INTEGER)) + INTERVAL 365 DAY END AS opted_out_at
        FROM d_customers WHERE k % 4 = 0""",
    "cdc_operator_jackpot_contributions": f"""
        SELECT {key('OC', 'k', 12)} AS contribution_id, account_id, 'OJP' || CAST(k % 3 AS VARCHAR) AS jackpot_id,
               'OJ' || CAST(k % 3 AS VARCHAR) AS game_id, 'SPORTS_BET' AS trigger_type, slip_id AS trigger_ref,
               {money('stake_c // 20 + 1')} AS amount, CAST(NULL AS VARCHAR) AS session_id, placed_at AS contributed_at,
               'I' AS _op, placed_at AS _commit_ts FROM d_orders WHERE k % 6 = 0
        UNION ALL SELECT 'OR' || round_ref, player_ref, 'OJP' || CAST(ok % 3 AS VARCHAR), 'OJ' || CAST(ok % 3 AS VARCHAR),
               'GAMING_ROUND', 'NE:' || round_ref, {money('stake_c // 100 + 1')}, session_ref, ts, _op, _commit_ts
        FROM d_lines WHERE feed = 0 AND ok % 9 = 0""",
    "stg_operator_jackpot_wins": f"""
        SELECT {key('OW', 'k', 12)} AS win_id, 'OJP' || CAST(k % 3 AS VARCHAR) AS jackpot_id, account_id,
               'OJ' || CAST(k % 3 AS VARCHAR) AS game_id, {money('stake_c * 2')} AS amount,
               CAST(NULL AS VARCHAR) AS session_id, placed_at AS win_ts FROM d_orders WHERE k % 400 = 9""",
    "game_round_voids": """
        SELECT 'NE:' || round_ref AS round_id, ts + INTERVAL 1 HOUR AS voided_at FROM d_lines
        WHERE feed = 0 AND ok % 27 = 0""",
    "stg_player_limits": "\n        UNION ALL ".join(
        f"""SELECT {key('L' + tag, 'k', 10)} AS limit_id, account_id, '{kind}' AS limit_type,
               {money(f'({minor}) * 100')} AS amount, TIMESTAMP '2019-12-01' AS set_at,
               CASE WHEN k % 5 = 0 THEN TIMESTAMP '2023-06-01' END AS revoked_at FROM d_customers WHERE {when}"""
        for tag, kind, minor, when in [
            ("A", "DEPOSIT_DAILY", "k % 200 + 40", "k % 7 = 0"), ("B", "DEPOSIT_DAILY", "k % 90 + 20", "k % 14 = 0"),
            ("C", "DEPOSIT_WEEKLY", "k % 300 + 60", "k % 11 = 0"), ("D", "DEPOSIT_MONTHLY", "k % 500 + 90", "k % 6 = 0"),
            ("E", "LOSS_DAILY", "k % 50 + 1", "k % 13 = 0"), ("F", "LOSS_WEEKLY", "k % 60 + 5", "k % 9 = 1"),
            ("G", "LOSS_MONTHLY", "k % 70 + 10", "k % 10 = 3"), ("H", "STAKE_CASINO", "k % 4 + 1", "k % 17 = 0")]),
    "stg_self_exclusions": f"""
        SELECT {key('X', 'k', 10)} AS exclusion_id, account_id,
               CASE WHEN k % 3 = 0 THEN 'NATIONAL' ELSE 'OPERATOR' END AS source,
               TIMESTAMP '2022-01-01' + to_days(CAST(k % 700 AS INTEGER)) AS start_ts,
               CASE WHEN k % 2 = 1 THEN TIMESTAMP '2022-01-01' + to_days(CAST(k % 700 AS INTEGER)) + INTERVAL 90 DAY END AS end_ts
        FROM d_customers WHERE k % 13 = 5""",
    "stg_verifications": f"""
        SELECT {key('VP', 'k', 10)} AS verification_id, account_id, 'IDENTITY' AS check_type, 'PENDING' AS status,
               opened_at AS event_ts FROM d_customers
        UNION ALL SELECT {key('VV', 'k', 10)}, account_id, 'IDENTITY', 'VERIFIED',
               opened_at + to_days(CAST(k % 1700 + 1 AS INTEGER)) FROM d_customers WHERE k % 9 <> 7
        UNION ALL SELECT {key('VA', 'k', 10)}, account_id, 'ADDRESS', 'VERIFIED', opened_at + INTERVAL 2 DAY
        FROM d_customers WHERE k % 4 = 0""",
    "cdc_payments": f"""
        SELECT {key('PC', 'k', 12)} AS payment_id, account_id, 'DEPOSIT' AS direction,
               {money('greatest(CAST(floor(bal * 5) AS BIGINT), 1000)')} AS amount, {pick(PAY_METHODS, 'k')} AS method,
               'COMPLETED' AS status, opened_at AS requested_ts, opened_at + INTERVAL 3 MINUTE AS completed_ts FROM d_customers
        UNION ALL SELECT {key('PE', 'event_id', 12)}, {acct('user_id')},
               CASE WHEN event_type = 'signup' THEN 'WITHDRAWAL' WHEN event_id % 50 = 7 THEN 'TRANSFER' ELSE 'DEPOSIT' END,
               {money('CAST(floor(value * 100) AS BIGINT)')}, {pick(PAY_METHODS, 'event_id')},
               CASE event_type WHEN 'error' THEN 'BLOCKED' WHEN 'view' THEN 'HELD' ELSE 'COMPLETED' END,
               ts, CASE WHEN event_type NOT IN ('error', 'view') THEN ts + INTERVAL 2 MINUTE END FROM events""",
    "stg_account_addresses": """
        SELECT account_id, 'Town' AS city,
               CASE WHEN k % 19 = 3 THEN 'BAD' || CAST(k AS VARCHAR)
                    WHEN jurisdiction = 'MT' THEN chr(CAST(nation % 26 + 65 AS INTEGER)) || 'XT ' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0')
                    WHEN jurisdiction IN ('DK', 'BG') THEN lpad(CAST(k % 10000 AS VARCHAR), 4, '0')
                    WHEN jurisdiction = 'GR' THEN lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || ' ' || lpad(CAST(k % 100 AS VARCHAR), 2, '0')
                    WHEN jurisdiction = 'NL' THEN lpad(CAST(k % 10000 AS VARCHAR), 4, '0') || ' AB'
                    WHEN jurisdiction = 'PT' THEN lpad(CAST(k % 10000 AS VARCHAR), 4, '0') || '-' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0')
                    ELSE lpad(CAST(k % 100000 AS VARCHAR), 5, '0') END AS postcode
        FROM d_customers""",
    "postcode_regions": """
        SELECT chr(CAST(n_nationkey % 26 + 65 AS INTEGER)) || 'XT' AS postcode_prefix, n_name AS region_name
        FROM nation WHERE n_nationkey % 6 <> 5""",
    "source_watermarks": f"""
        SELECT s.name AS source, {_market.format(k='m')} AS jurisdiction, last_ts - to_days(CAST(m * 40 AS INTEGER)) AS complete_through
        FROM (SELECT cust % {len(MARKETS)} AS m, max(placed_at) AS last_ts FROM d_orders GROUP BY 1)
        CROSS JOIN (VALUES ('bet_settlement'), ('payments')) s(name)""",
    "exception_state": f"""
        SELECT 'ADDRESS' AS entity_type, account_id AS entity_id, 'region_not_found' AS reason_code,
               'TRANSIENT' AS error_class, CAST(k // 18 % 6 + 1 AS INTEGER) AS attempt_count,
               TIMESTAMP '{RUN_TS}' - to_days(CAST(k // 18 % 6 + 1 AS INTEGER)) AS first_seen,
               TIMESTAMP '{RUN_TS}' + to_hours(CAST(k % 5 - 2 AS INTEGER)) AS next_retry_at, 'RETRYING' AS status
        FROM d_customers WHERE k % 18 = 0 AND k % 19 <> 3""",
    "provider_statements": f"""
        SELECT CASE feed WHEN 0 THEN 'NetEnt' WHEN 1 THEN 'Evolution' WHEN 2 THEN 'Playtech'
                    ELSE {pick(['Spribe', 'Hacksaw'], 'sk // 5')} END AS provider,
               CAST(ts AS DATE) AS statement_date, {money('sum(stake_c - payout_c)')} AS reported_ggr
        FROM d_lines WHERE feed < 4 GROUP BY 1, 2 HAVING day(CAST(ts AS DATE)) <> 17""",
    "play_rounds": f"""
        SELECT 'R' || round_ref || '-' || CAST(pk AS VARCHAR) || '-' || CAST(sk AS VARCHAR) AS round_id,
               player_ref AS account_id, {pick(PLAY_GAMES, 'sk')} AS game, {money('stake_c')} AS stake,
               {money('payout_c')} AS payout,
               CASE WHEN {pick(PLAY_GAMES, 'sk')} IN ('BLACKJACK', 'POKER') AND ok % 10 = 3 THEN 'GOLDEN_CHIP' ELSE 'CASH' END AS funding,
               session_ref AS session_id, ts AS round_ts FROM d_lines""",
    "delivery_log": f"""
        SELECT 'bets' AS record_type, slip_id || '|SETTLED' AS record_key, {_market.format(k='cust')} AS jurisdiction,
               {key('BETS-', 'k', 12)} AS receipt_id, settled_ts AS submitted_at
        FROM d_orders WHERE settles AND NOT voids AND k % 4 = 0
        UNION ALL SELECT 'bets', slip_id || '|VOIDED', {_market.format(k='cust')}, 'SUPPRESSED-VOID', voided_ts
        FROM d_orders WHERE voids AND k % 10 = 0
        UNION ALL SELECT 'payments', {key('PE', 'event_id', 12)}, {_market.format(k='user_id')},
               {key('PAY-', 'event_id', 12)}, ts + INTERVAL 9 MINUTE FROM events WHERE event_id % 5 = 0
        UNION ALL SELECT 'players', account_id || '|VERIFIED', jurisdiction, {key('PLAY-', 'k', 12)},
               opened_at + INTERVAL 3 DAY FROM d_customers WHERE k % 6 = 1
        UNION ALL SELECT 'gaming', 'R' || round_ref || '-' || CAST(pk AS VARCHAR) || '-' || CAST(sk AS VARCHAR), NULL,
               'VIA-SESSION', ts FROM d_lines WHERE ok % 3 = 0
        UNION ALL SELECT 'sessions', session_id, NULL, 'SESS-1', last_ts FROM d_sessions WHERE cust % 4 = 1""",
    "legacy_capture": f"""
        SELECT {_market.format(k='cust')} AS jurisdiction, slip_id AS bet_id, CAST(settled_ts AS DATE) AS report_date,
               {money('stake_c + CASE WHEN k % 37 = 0 THEN 7 ELSE 0 END')} AS stake, {money('payout_c')} AS payout,
               {money('stake_c + CASE WHEN k % 37 = 0 THEN 7 ELSE 0 END - payout_c')} AS ggr
        FROM d_orders WHERE settles AND k % 43 <> 0""",
    "settled_bets": f"""
        SELECT {_market.format(k='cust')} AS jurisdiction, slip_id AS bet_id, account_id AS player_id,
               'ID' || CAST(cust * 7919 % 99999989 AS VARCHAR) AS player_national_id,
               {pick(['single', 'combo', 'free_spin', 'single'], 'k')} AS game_type,
               {pick(['sports', 'casino', 'poker', 'lottery'], 'k // 3')} AS vertical,
               {money('stake_c')} AS stake, {money('payout_c')} AS payout, settled_ts AS settled_at
        FROM d_orders WHERE settles AND k % 47 <> 0""",
}


def newest(source: str, keys: str, ties: str = "", drop_deletes: bool = True, where: str = "TRUE") -> str:
    """Latest image per key, the way a DuckDB user writes it."""
    tail = f", {ties}" if ties else ""
    gone = " WHERE _op <> 'D'" if drop_deletes else ""
    return f"""SELECT * FROM (SELECT * FROM {source} WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY _commit_ts DESC{tail}) = 1){gone}"""


CTES.update({
    "stg_accounts": newest("cdc_accounts", "account_id"),
    "stg_fixtures": newest("cdc_fixtures", "fixture_id"),
    "stg_bet_slips": "SELECT * FROM cdc_bet_slips",
    "stg_bet_slip_events": newest("cdc_bet_slip_events", "slip_id, event_type", drop_deletes=False,
                                  where="event_type IN ('PLACED', 'SETTLED', 'VOIDED')"),
    "stg_reg_attributes": newest("cdc_reg_attributes", "entity_type, entity_id, attr_name", drop_deletes=False),
    "stg_games": "SELECT * FROM cdc_games",
    "stg_poker_activity": newest("cdc_poker_activity", "activity_id",
                                 "account_id DESC, game_id DESC, amount_in DESC",
                                 where="kind IN ('CASH_HAND', 'TOURNAMENT_ENTRY')"),
    "stg_operator_jackpot_contributions": newest(
        "cdc_operator_jackpot_contributions", "contribution_id", "account_id DESC, amount DESC"),
    "stg_gaming_sessions": newest("cdc_gaming_sessions", "session_id", drop_deletes=False),
    "stg_payments": "SELECT * FROM cdc_payments WHERE direction IN ('DEPOSIT', 'WITHDRAWAL')",
})
