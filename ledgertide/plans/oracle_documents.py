"""Documents as DuckDB text expressions, from the same format tables."""

from __future__ import annotations

from collections.abc import Callable

from ..operators.documents import EMPTY_ELEMENT, NAMESPACE, Doc, El, Val
from ..operators.document_formats import docs_for
from .derive import RUN_TS, SPLIT_PLAYERS, SPLIT_ROUNDS
from .oracle_feeds import CTES, text

ITEM_FIELDS = {"participants": {"name"}, "events": {"player_ref", "session_id", "at", "tipo"},
               "rounds": {"round_id", "player_ref"},
               "rows": {"player_ref", "opened_at", "bets_settled", "stake_sum", "winnings_sum", "ggr_sum"}}
FIELDS = {
    "bets": {"jurisdiction", "record_key", "slip_id", "player_ref", "username", "fixture_id", "sport", "event", "participants",
             "selection", "odds", "stake", "payout", "session_id", "status", "void_reason", "placed_at", "terminal_at", "placed_text",
             "balance_before_stake", "balance_after_stake", "balance_before_credit", "balance_after_credit", "balance_net", "seq"},
    "payments": {"jurisdiction", "record_key", "payment_id", "player_ref", "direction", "amount", "method", "session_id", "completed_at",
                 "method_or_other", "balance", "balance_before", "seq"},
    "players": {"jurisdiction", "record_key", "player_ref", "kyc_status", "opened_at", "date_of_birth", "username", "balance", "session_id",
                "player_short", "player_half", "seq"},
    "gaming": {"jurisdiction", "record_key", "round_id", "player_ref", "username", "game", "game_type_code", "stake", "payout", "funding",
               "session_id", "played_at", "session_or_round", "played_day", "balance_before_stake", "balance_after_stake",
               "balance_before_credit", "balance_after_credit", "balance_net", "seq"},
    "platform_sessions": {"record_key", "session_id", "player_ref", "started_at", "ended_at", "end_reason", "events"},
    "game_sessions": {"record_key", "session_id", "game", "player_ref", "first_played_at", "last_played_at", "rounds", "rounds_won",
                      "rounds_played", "game_part"},
    "filings": {"record_key", "register_id", "period_start", "period_day", "period_month", "rows", "players", "parts",
                "part_no", "part_mark"},
}


def _stamp(fmt: str) -> Callable[[str], str]:
    return lambda x: f"strftime({x}, '{fmt}')"


CODECS: dict[str, Callable[[str], str]] = {
    "text": lambda x: f"CAST({x} AS VARCHAR)", "datetime": _stamp("%Y-%m-%dT%H:%M:%SZ"), "date": _stamp("%Y-%m-%d"),
    "offset": lambda x: f"strftime({x}, '%Y-%m-%dT%H:%M:%S') || if(microsecond({x}) % 1000000 = 0, '', strftime({x}, '.%f')) || '+00:00'",
    "date-compact": _stamp("%Y%m%d"), "money": lambda x: f"CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)",
    "money4": lambda x: f"CAST(CAST({x} AS DECIMAL(18,4)) AS VARCHAR)", "flag-positive": lambda x: f"if({x} > 0, '1', '0')",
    "digits14": _stamp("%Y%m%d%H%M%S"), "digits14tz": _stamp("%Y%m%d%H%M%S+0000"), "digits8": _stamp("%Y%m%d"),
    "digits6": _stamp("%Y%m"), "digits12-yy": _stamp("%y%m%d%H%M%S"), "digits14-fftz": _stamp("%Y%m%d%H%M%S.00 +00:00"),
    "sha1-upper": lambda x: f"upper(sha1(CAST({x} AS VARCHAR)))",
    "fr-canonique": lambda x: f"regexp_replace(upper({x}), '[^0-9A-Z'' -]', '', 'g')",
}


def _uuid5(expr: str) -> str:
    h = f"sha1(unhex('{NAMESPACE.replace('-', '')}') || encode({expr}))"
    return (f"regexp_replace({h}, '^(.{{8}})(.{{4}}).(.{{3}})(.)(.{{3}})(.{{12}}).*$', '\\1-\\2-5\\3-') || "
            f"list_extract(['8', '9', 'a', 'b'], CAST((strpos('0123456789abcdef', {h}[17:17]) - 1) % 4 AS INTEGER) + 1) || "
            f"{h}[18:20] || '-' || {h}[21:32]")


def _crc(expr: str) -> str:
    step = "xor(x >> 1, (x & 1) * 3988292384)"
    rounds = "[0, 1, 2, 3, 4, 5, 6, 7]"
    seed = "CAST(4294967295 AS BIGINT)"
    byte_list = f"list_transform(string_split({expr}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return (f"xor(list_reduce({byte_list}, lambda c, b: list_reduce({rounds}, lambda x, i: {step}, xor(c, b)), {seed}), {seed})")


class Sql:
    """Renders one format over one relation's columns or one list item's fields."""

    def __init__(self, known: set[str], prefix: str = ""):
        self.known, self.prefix = known, prefix

    def ref(self, name: str) -> str:
        return f"{self.prefix}{name}" if name in self.known else "NULL"

    def test(self, conditions: tuple) -> str:
        out = ["TRUE"]
        for kind, name, *value in conditions:
            col = self.ref(name)
            out.append({"equals": lambda: f"coalesce({col} = {text(value[0])}, FALSE)",
                        "differs": lambda: f"coalesce({col} <> {text(value[0])}, TRUE)",
                        "present": lambda: f"{col} IS NOT NULL", "positive": lambda: f"coalesce({col} > 0, FALSE)",
                        "unpaid": lambda: f"coalesce({col} <= 0, TRUE)"}[kind]())
        return " AND ".join(out)

    def parts(self, parts: tuple, sep: str) -> str:
        return f" || '{sep}' || ".join(
            f"coalesce(CAST({self.ref(p[1:])} AS VARCHAR), 'None')" if p.startswith("$") else text(p) for p in parts)

    @staticmethod
    def safe(expr: str) -> str:
        return f"replace(replace(replace({expr}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

    def value(self, v: Val) -> str:
        if v.kind == "const":
            return text(v.args[0])
        if v.kind == "count":
            return f"CAST(len({self.ref(v.args[0])}) AS VARCHAR)"
        if v.kind == "now":
            return CODECS[v.codec](f"TIMESTAMP '{RUN_TS}'")
        if v.kind == "uid":
            return _uuid5(self.parts(v.args, "|"))
        if v.kind == "crc":
            *parts, modulus = v.args
            number = _crc(self.parts(tuple(parts), "|"))
            return f"CAST({number}{f' % {modulus}' if modulus else ''} AS VARCHAR)"
        if v.kind == "text":
            return self.safe(self.parts(v.args, ""))
        raw = self.ref(v.args[0])
        if v.other or v.fallback is not None:
            raw = f"coalesce(nullif({raw}, ''), {self.ref(v.other) if v.other else 'NULL'}, {text(v.fallback)})"
        if v.cut is not None:
            raw = f"{raw}[1:{v.cut}]"
        if v.table is not None:
            cases = " ".join(f"WHEN {text(a)} THEN {text(b)}" for a, b in v.table.items())
            raw = f"CASE {raw} {cases} ELSE {raw if v.default is None else text(v.default)} END"
        shaped = CODECS[v.codec](raw)
        return self.safe(shaped) if v.codec in ("text", "fr-canonique") else shaped

    def element(self, el: El) -> str:
        if el.each:
            inner = Sql(ITEM_FIELDS[el.each], "item.").element(el._replace(each=None))
            return f"coalesce(array_to_string(list_transform({self.ref(el.each)}, lambda item: {inner}), ''), '')"
        head = text("<" + el.name) + "".join(
            f" || {text(f' {k}=' + chr(34))} || {self.ref(v[1:]) if v.startswith('$') else text(v)} || {text(chr(34))}" for k, v in el.attrs)
        if isinstance(el.body, Val):
            inner = self.value(el.body)
        elif el.body:
            inner = " || ".join(self.element(child) for child in el.body)
        else:
            return self.guard(el, f"{head} || '/>'")
        return self.guard(el, f"{head} || '>' || {inner} || {text(f'</{el.name}>')}")

    def guard(self, el: El, built: str) -> str:
        return f"coalesce(CASE WHEN {self.test(el.when)} THEN {built} END, '')" if el.when else f"coalesce({built}, '')"


def document_sql(market: str, record_type: str, kind: str, suffix: str = "") -> str:
    sql = Sql(FIELDS["filings" if kind in ("rud", "rut") else kind])
    relation = ("filing_records" if kind in ("rud", "rut") else f"records_{kind}") + suffix
    only = f" AND register_id = '{kind.upper()}'" if kind in ("rud", "rut") else ""

    def one(doc: Doc) -> str:
        suffix = "CAST(NULL AS VARCHAR)" if doc.suffix is None else text(doc.suffix)
        return (f"SELECT '{market}' AS jurisdiction, '{record_type}' AS record_type, record_key, {suffix} AS suffix, "
                f"regexp_replace({sql.element(doc.root)}, {text(EMPTY_ELEMENT)}, '<\\1\\2/>', 'g') AS payload FROM {relation} WHERE jurisdiction = '{market}'{only} AND {sql.test(doc.when)}")
    return " UNION ALL ".join(one(d) for d in docs_for(market, record_type))


_ref = "CASE WHEN m.hashed_ref THEN sha256(a.national_id) ELSE a.account_id END AS player_ref"
_login = "'user' || a.account_id[2:] AS username"


def _wallet(stake: str, credit: str) -> str:
    b = "coalesce(w.balance, 0)"
    return (f"{b} + {stake} - {credit} AS balance_before_stake, {b} - {credit} AS balance_after_stake, {b} - {credit} AS balance_before_credit, "
            f"{b} AS balance_after_credit, {credit} - {stake} AS balance_net")


def _numbered(body: str, record_type: str) -> str:
    return f"""SELECT r.*, coalesce(l.n, 0) + row_number() OVER (PARTITION BY r.jurisdiction ORDER BY r.record_key) AS seq FROM ({body}) r
    LEFT JOIN (SELECT jurisdiction, max(CAST(regexp_extract(receipt_id, '-([0-9]+)$', 1) AS BIGINT)) AS n FROM delivery_log
               WHERE record_type = '{record_type}' AND regexp_matches(receipt_id, '-[0-9]+$') GROUP BY 1) l ON l.jurisdiction = r.jurisdiction"""


CTES.update({
    "wallets": """SELECT account_id, sum(v) AS balance FROM (
        SELECT account_id, if(direction = 'DEPOSIT', amount, -amount) AS v FROM stg_payments WHERE status = 'COMPLETED'
        UNION ALL SELECT account_id, payout - stake FROM fct_lifecycle WHERE slip_status <> 'VOIDED'
        UNION ALL SELECT account_id, if(funding = 'CASH', payout - stake, payout) FROM play_rounds) GROUP BY 1""",
    "records_bets": _numbered(f"""SELECT s.jurisdiction, s.slip_id AS record_key, s.slip_id, {_ref}, {_login}, s.fixture_id,
        CASE f.canonical_sport WHEN 'FOOT' THEN 'Football' WHEN 'TENN' THEN 'Tennis' WHEN 'HORS' THEN 'Horse Racing' WHEN 'BASK' THEN 'Basketball' END AS sport,
        f.home_name || ' v ' || f.away_name || ' (' || f.competition_name || ')' AS event,
        [{{'name': f.home_name}}, {{'name': f.away_name}}] AS participants, s.selection, s.odds, s.stake,
        if(s.voided_at IS NOT NULL, 0, s.payout) AS payout, CAST(NULL AS VARCHAR) AS session_id,
        CASE WHEN m.include_voided THEN o.status END AS status, CASE WHEN s.voided_at IS NOT NULL THEN 'voided' END AS void_reason,
        s.placed_at, o.terminal_at, strftime(s.placed_at, '%Y-%m-%d %H:%M:%S') || '+00:00' AS placed_text,
        {_wallet('s.stake', 'if(s.voided_at IS NOT NULL, s.stake, s.payout)')}
        FROM open_bets o JOIN slip_amounts s USING (slip_id) JOIN stg_accounts a ON a.account_id = s.account_id JOIN market m ON m.jurisdiction = s.jurisdiction
        JOIN dim_fixture f ON f.fixture_id = s.fixture_id LEFT JOIN wallets w ON w.account_id = s.account_id WHERE o.route = 'DELIVER'""", "bets"),
    "records_payments": _numbered(f"""SELECT a.jurisdiction, p.payment_id AS record_key, p.payment_id, {_ref}, p.direction, p.amount, p.method,
        CAST(NULL AS VARCHAR) AS session_id, p.completed_ts AS completed_at, coalesce(nullif(p.method, ''), 'OTHER') AS method_or_other,
        coalesce(w.balance, 0) AS balance, coalesce(w.balance, 0) + if(p.direction = 'DEPOSIT', -p.amount, p.amount) AS balance_before
        FROM stg_payments p JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction) LEFT JOIN wallets w ON w.account_id = p.account_id
        WHERE p.status = 'COMPLETED' AND ('payments', p.payment_id) NOT IN (SELECT record_type, record_key FROM log_keys)""", "payments"),
    "records_players": _numbered(f"""SELECT *, player_ref[1:12] AS player_short, player_ref[1:32] AS player_half FROM (
        SELECT a.jurisdiction, a.account_id AS record_key, {_ref}, a.kyc_status, a.opened_at, a.date_of_birth, {_login},
        coalesce(w.balance, 0) AS balance, CAST(NULL AS VARCHAR) AS session_id FROM stg_accounts a JOIN market m USING (jurisdiction)
        LEFT JOIN wallets w ON w.account_id = a.account_id
        WHERE ('players', a.account_id || '|' || a.kyc_status) NOT IN (SELECT record_type, record_key FROM log_keys))""", "players"),
    "records_gaming": _numbered(f"""SELECT a.jurisdiction, r.round_id AS record_key, r.round_id, r.player_ref, {_login}, r.game, r.game_type_code, r.stake, r.payout,
        r.funding, r.session_id, r.round_ts AS played_at, coalesce(r.session_id, r.round_id) AS session_or_round,
        strftime(r.round_ts, '%Y-%m-%d') AS played_day, {_wallet("if(r.funding = 'CASH', r.stake, 0)", 'r.payout')}
        FROM open_rounds r JOIN stg_accounts a ON a.account_id = r.account_id JOIN market m ON m.jurisdiction = a.jurisdiction
        LEFT JOIN wallets w ON w.account_id = r.account_id WHERE r.route <> 'SUPPRESSED-UNLICENSED'""", "gaming"),
    "records_platform_sessions": f"""SELECT *, [{{'player_ref': player_ref, 'session_id': session_id, 'at': started_at, 'tipo': 'LOGIN'}},
        {{'player_ref': player_ref, 'session_id': session_id, 'at': ended_at, 'tipo': 'LOGOUT'}}] AS events FROM (
        SELECT a.jurisdiction, s.session_id AS record_key, s.session_id, {_ref}, s.started_at, s.ended_at, s.end_reason
        FROM stg_gaming_sessions s JOIN stg_accounts a USING (account_id) JOIN market m USING (jurisdiction)
        WHERE m.session_grain = 'platform' AND s.ended_at IS NOT NULL AND ('sessions', s.session_id) NOT IN (SELECT record_type, record_key FROM log_keys))""",
})


MARK = "if(part > 0, '~' || (part + 1), '')"


def filing_parts(size: int) -> str:
    """Register rows with the part each falls in and the players of its whole period."""
    whole = "PARTITION BY jurisdiction, register_id, period_start"
    return f"""SELECT *, CAST((row_number() OVER ({whole} ORDER BY account_id) - 1) // {size} AS INTEGER) AS part,
        count(*) OVER ({whole}) AS players, CAST((count(*) OVER ({whole}) + {size - 1}) // {size} AS INTEGER) AS parts FROM register_row_set"""


def round_parts(size: int) -> str:
    """Rounds of ended sessions with the part each falls in and the figures of the whole session and game."""
    whole = "PARTITION BY r.session_id, r.game"
    return f"""SELECT r.session_id, r.game, r.account_id, r.round_id, r.round_ts,
        CAST((row_number() OVER ({whole} ORDER BY round_ts, round_id) - 1) // {size} AS INTEGER) AS part,
        min(r.account_id) OVER ({whole}) AS player, min(round_ts) OVER ({whole}) AS first_played_at, max(round_ts) OVER ({whole}) AS last_played_at,
        count(*) OVER ({whole}) AS played, count(*) FILTER (payout > 0) OVER ({whole}) AS rounds_won,
        CAST((count(*) OVER ({whole}) + {size - 1}) // {size} AS INTEGER) AS parts
        FROM play_rounds r JOIN stg_gaming_sessions s USING (session_id) WHERE s.ended_at IS NOT NULL"""


def _part_records(suffix: str, rounds: int, players: int) -> dict[str, str]:
    return {
        "records_game_sessions" + suffix: f"""SELECT * FROM (
        SELECT a.jurisdiction, r.session_id || '-' || r.game || {MARK} AS record_key, r.session_id, r.game, r.game || {MARK} AS game_part, {_ref},
        r.first_played_at, r.last_played_at, r.rounds_won, r.played AS rounds_played, list_transform(r.ids, lambda i: {{'round_id': i, 'player_ref': player_ref}}) AS rounds
        FROM (SELECT session_id, game, part, player, first_played_at, last_played_at, played, rounds_won, list(round_id ORDER BY round_ts, round_id) AS ids
              FROM ({round_parts(rounds)}) GROUP BY ALL) r JOIN stg_accounts a ON a.account_id = r.player JOIN market m USING (jurisdiction)
        WHERE m.session_grain = 'per_game') WHERE ('sessions', record_key) NOT IN (SELECT record_type, record_key FROM log_keys)""",
        "filing_records" + suffix: f"""SELECT jurisdiction, register_id || '-' || strftime(period_start, '%Y-%m-%d') || {MARK} AS record_key, register_id, period_start,
        strftime(period_start, '%Y%m%d') AS period_day, strftime(period_start, '%Y%m') AS period_month, players, parts, part + 1 AS part_no, {MARK} AS part_mark,
        list({{'player_ref': player_ref, 'opened_at': opened_at, 'bets_settled': bets_settled, 'stake_sum': stake_sum, 'winnings_sum': winnings_sum,
              'ggr_sum': ggr_sum}} ORDER BY account_id) AS rows FROM ({filing_parts(players)}) GROUP BY ALL"""}


CTES.update(_part_records("", 10_000, 5000) | _part_records("_split", SPLIT_ROUNDS, SPLIT_PLAYERS))
