"""Market differences as data. Logic lives elsewhere and exists once.

Each table below is a list of typed rows; ``*_frame`` functions turn them into
broadcast frames. The market codes, zones, rates, bands, code lists and rule
identifiers are fixed values.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from .functions.frames import config_frame


def _d(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def _m(text: str | None) -> Decimal | None:
    return Decimal(text) if text is not None else None


# market, zone, currency, cadence, voids filed, tax basis, contributions
# deducted from gaming revenue, default deposit limits day/week/month,
# withdrawal needs verification, postcode pattern, region required, identity hashed
MARKET_ROWS = [
    ("MT", "Europe/Malta", "EUR", "daily", True, "ggr", True, None, None, None, True,
     "^[A-Z]{3} [0-9]{4}$", True, False),
    ("ES", "Europe/Madrid", "EUR", "daily", False, "ggr", False, "600", "1500", "3000", True,
     "^[0-9]{5}$", False, True),
    ("DK", "Europe/Copenhagen", "DKK", "monthly", True, "ggr", False, None, None, None, True,
     "^[0-9]{4}$", False, False),
    ("BG", "Europe/Sofia", "BGN", "monthly", False, "ggr", False, None, None, None, True,
     "^[0-9]{4}$", False, True),
    ("GR", "Europe/Athens", "EUR", "monthly", False, "ggr", False, None, None, None, True,
     "^[0-9]{3} [0-9]{2}$", False, True),
    ("NL", "Europe/Amsterdam", "EUR", "monthly", False, "ggr", False, None, None, None, True,
     "^[0-9]{4} [A-Z]{2}$", False, True),
    ("DE", "Europe/Berlin", "EUR", "monthly", False, "turnover", False, None, None, "1000", True,
     "^[0-9]{5}$", False, True),
    ("FR", "Europe/Paris", "EUR", "daily", True, "ggr", False, None, None, None, True,
     "^[0-9]{5}$", False, False),
    ("PT", "Europe/Lisbon", "EUR", "daily", True, "turnover", False, None, None, None, True,
     "^[0-9]{4}-[0-9]{3}$", False, False),
]
MARKETS = [row[0] for row in MARKET_ROWS]

# market, rate, from (inclusive), to (exclusive)
BETTING_RATES = [
    ("MT", "0.05", None, None),
    ("ES", "0.20", None, None),
    ("DK", "0.28", None, None),
    ("BG", "0.20", None, "2026-01-01"),
    ("BG", "0.25", "2026-01-01", None),
    ("GR", "0.35", None, None),
    ("NL", "0.342", None, "2026-01-01"),
    ("NL", "0.378", "2026-01-01", None),
    ("DE", "0.053", None, None),
    ("FR", "0.549", None, "2025-07-01"),
    ("FR", "0.593", "2025-07-01", None),
    ("PT", "0.08", None, None),
]
GAMING_RATES = [
    ("MT", "0.05", None, None),
    ("ES", "0.20", None, None),
    ("FR", "0.10", None, None),
    ("PT", "0.25", None, None),
]
# market, vertical, rate: turnover tax that depends on the vertical
VERTICAL_RATES = [("ES", "sports", "0.20"), ("ES", "casino", "0.20"), ("ES", "poker", "0.25")]

SPORTS = [("FOOT", "Football"), ("TENN", "Tennis"), ("HORS", "Horse Racing"), ("BASK", "Basketball")]
GAME_TYPES = [
    ("SLOT", "Slots"), ("ROUL", "Roulette"), ("BLKJ", "Blackjack"),
    ("BACC", "Baccarat / Punto Banco"), ("POKC", "Poker Cash Game"),
    ("POKT", "Poker Tournament"), ("OJACK", "Operator Jackpot"),
]
# spelling, canonical, feed it comes from
SPORT_ALIASES = [
    ("Soccer", "FOOT", "feed_a"), ("Football", "FOOT", "feed_b"), ("Fútbol", "FOOT", "feed_es"),
    ("Assoc Football", "FOOT", "legacy_import"), ("Tennis", "TENN", None),
    ("Lawn Tennis", "TENN", "legacy_import"), ("Horse Racing", "HORS", None),
    ("Horses", "HORS", "feed_a"), ("Basketball", "BASK", None),
]
# spelling, participant, display name
PARTICIPANT_ALIASES = [
    ("Man Utd", "T-0001", "Manchester United"), ("Manchester United FC", "T-0001", "Manchester United"),
    ("Chelsea FC", "T-0002", "Chelsea"), ("Chelsea", "T-0002", "Chelsea"),
    ("Real Madrid", "T-0003", "Real Madrid"), ("R Madrid", "T-0003", "Real Madrid"),
    ("FC Barcelona", "T-0004", "Barcelona"), ("Barça", "T-0004", "Barcelona"),
    ("R. Nadal", "P-0101", "Rafael Nadal"), ("N. Djokovic", "P-0102", "Novak Djokovic"),
]
GAME_ALIASES = [
    ("Video Slots", "SLOT", "netent"), ("Slots", "SLOT", None), ("Slot", "SLOT", "pragmatic"),
    ("Live Roulette", "ROUL", "evolution"), ("Roulette", "ROUL", None),
    ("Table Games - Blackjack", "BLKJ", "netent"), ("Blackjack", "BLKJ", None),
    ("Baccarat", "BACC", None), ("Punto Banco", "BACC", "evolution"),
    ("Poker - Cash", "POKC", "poker_platform"), ("Poker Tournament", "POKT", "poker_platform"),
    ("Operator Jackpot", "OJACK", "operator"),
]
# market, canonical, regulator code, from, to
SPORT_CODES = [
    ("MT", "FOOT", "01", None, None), ("MT", "TENN", "02", None, None),
    ("MT", "HORS", "03", None, None), ("MT", "BASK", "04", None, None),
    ("ES", "FOOT", "FUT", None, None), ("ES", "TENN", "TEN", None, None), ("ES", "BASK", "BAL", None, None),
    ("DK", "FOOT", "1", None, None), ("DK", "TENN", "2", None, None), ("DK", "BASK", "3", None, None),
    ("BG", "FOOT", "FUT", None, "2026-01-01"), ("BG", "FOOT", "FTB", "2026-01-01", None),
    ("BG", "TENN", "TEN", None, None), ("BG", "BASK", "BKB", None, None),
    ("GR", "FOOT", "FTB", None, None), ("GR", "TENN", "TNS", None, None), ("GR", "BASK", "BSK", None, None),
    ("NL", "FOOT", "VB", None, None), ("NL", "TENN", "TN", None, None), ("NL", "BASK", "BB", None, None),
    ("DE", "FOOT", "FUSS", None, None), ("DE", "TENN", "TEN", None, None), ("DE", "BASK", "BKB", None, None),
    ("FR", "FOOT", "FOOTBALL", None, None), ("FR", "TENN", "TENNIS", None, None),
    ("FR", "BASK", "BASKETBALL", None, None),
    ("PT", "FOOT", "FUTB", None, None), ("PT", "TENN", "TENI", None, None), ("PT", "BASK", "BASQ", None, None),
]
GAME_CODES = [
    *[("MT", t, "3" if t in ("POKC", "POKT") else "1", None, None)
      for t in ("SLOT", "ROUL", "BLKJ", "BACC", "POKC", "POKT", "OJACK")],
    ("ES", "SLOT", "MAZ", None, None), ("ES", "ROUL", "RLT", None, None), ("ES", "BLKJ", "BLJ", None, None),
    ("ES", "POKC", "POC", None, None), ("ES", "POKT", "POT", None, None),
    ("FR", "POKC", "PO-CG", None, None), ("FR", "POKT", "PO-TR", None, None),
    ("PT", "SLOT", "fortazar", None, None), ("PT", "ROUL", "fortazar", None, None),
    ("PT", "BLKJ", "bjack", None, None), ("PT", "POKC", "poker", None, None), ("PT", "POKT", "poker", None, None),
]
# market, bucket for an unmapped sport (NULL: such rows block), event name template
SPORT_POLICY = [
    ("MT", "99", "{home} v {away}"), ("ES", None, "{home} - {away}"), ("DK", "9", "{home} - {away}"),
    ("BG", None, "{home} - {away}"), ("GR", "OTH", "{home} v {away}"), ("NL", "OV", "{home} - {away}"),
    ("DE", None, "{home} - {away}"), ("FR", None, "{home} - {away}"), ("PT", None, "{home} - {away}"),
]
GAME_POLICY = [("MT", "1"), ("ES", None), ("FR", None), ("PT", None)]

# market, cap per stake, lowest age, highest age, from, to
STAKE_BANDS = [
    ("MT", "5.00", 18, None, "2026-08-01", None),
    ("MT", "2.00", 18, 24, "2026-09-15", None),
    ("ES", "10.00", 18, None, "2026-08-01", None),
    ("DK", "7.50", 18, None, "2026-08-01", None),
    ("NL", "5.00", 18, None, "2026-08-01", None),
    ("DE", "1.00", 18, None, "2021-07-01", "2026-07-01"),
    ("DE", "1.00", 18, 20, "2026-07-01", None),
    ("DE", "3.00", 21, None, "2026-07-01", None),
]
# market, winnings from, to, rate: progressive withholding
WITHHOLDING = [("GR", "100", "200", "0.025"), ("GR", "200", "500", "0.05"), ("GR", "500", None, "0.075")]

# Columns of each market's betting file, and what it adds from the attribute
# carrier or under a market name of its own.
STATUS_FILE = ["slip_id", "account_id", "slip_status", "stake", "payout", "ggr",
               "sport_code", "event_name", "placed_at_local", "settled_at_local"]
PLAIN_FILE = ["slip_id", "stake", "payout", "sport_code", "event_name",
              "placed_at_local", "settled_at_local"]
BETTING_FILES = {
    "MT": STATUS_FILE, "DK": STATUS_FILE, "FR": STATUS_FILE, "PT": STATUS_FILE,
    "BG": PLAIN_FILE, "GR": PLAIN_FILE, "NL": PLAIN_FILE, "DE": PLAIN_FILE,
    "ES": ["slip_id", "player_dni_hash", *PLAIN_FILE[1:]],
}
EXTENSIONS = {
    "DK": ["safe_tampertoken"],
    "BG": ["player_egn_hash", "nra_registration_id"],
    "GR": ["player_afm_hash", "winnings_withholding_tax"],
    "NL": ["player_bsn_hash", "cruks_check_ref", "cdb_record_id"],
    "DE": ["player_lugas_pseudonym", "lugas_activity_id"],
}
CARRIED = ["safe_tampertoken", "nra_registration_id", "cruks_check_ref", "cdb_record_id",
           "lugas_activity_id"]
HASH_NAMES = ["player_egn_hash", "player_bsn_hash", "player_lugas_pseudonym", "player_afm_hash"]
_GAMING = ["activity_id", "account_id", "game_code", "game_name", "vertical", "stake", "payout",
           "rake_or_fee", "gaming_ggr", "occurred_at_local"]
GAMING_FILES = {"MT": _GAMING, "FR": _GAMING, "PT": _GAMING,
                "ES": ["activity_id", "player_dni_hash", *_GAMING[2:]]}
# market, register, cadence
REGISTERS = [("ES", "RUD", "daily"), ("ES", "RUT", "monthly")]
# market, grain, minutes to timeout, empty sessions filed, rounds filed only inside sessions
SESSIONS = [("NL", "per_game", 30, False, True), ("PT", "platform", 30, False, False)]
END_REASONS = ["LOGOUT", "INACTIVITY"]
DEFAULT_TIMEOUT = 30

# Delivery: games a market licenses (absent: all), bonus stakes counted as revenue
LICENSED_GAMES = {"FR": ["POKER"], "PT": ["SLOTS", "BLACKJACK", "POKER"]}
BONUS_GROSS = ["ES", "BG", "GR", "DE", "PT"]
GAME_TYPE_CODES = {"SLOTS": 1, "BLACKJACK": 2, "POKER": 3, "operator-jackpots": 7077}
BONUS_GAMES = ["BLACKJACK", "POKER"]
POOL_GAME, POOL_SEED, POOL_RATE = "operator-jackpots", Decimal("100.00"), Decimal("0.01")
# Starter scaffold: game types left out of a market's file
EXCLUDED_GAME_TYPES = {"ES": ["free_spin"]}

# Retry of transient failures
MAX_ATTEMPTS, BACKOFF_MINUTES = 5, 15
# Rows per envelope, by market; others have no documented ceiling
ENVELOPE_ROWS = {"MT": 5000, "NL": 512}
DEFAULT_ENVELOPE_ROWS = 5000
TOLERANCE = Decimal("0.005")

HEX64 = "^[0-9a-f]{64}$"
# Rules: market, id, kind, field, argument. A rule selects the rows that break it.
COMMON_BETTING_RULES = [
    ("COM-001", "not_null", "slip_id", None), ("COM-002", "not_null", "report_date", None),
    ("COM-003", "non_negative", "stake", None), ("COM-004", "non_negative", "payout", None),
    ("COM-005", "unique", "slip_id", None),
]
BETTING_RULES = [
    ("MT", "MT-101", "in_set", "slip_status", ["SETTLED", "VOIDED"]),
    ("MT", "MT-104", "valid_sport_code", "sport_code", None),
    ("MT", "MT-102", "max_value", "stake", 50000),
    ("MT", "MT-103", "zero_when", "payout", ("slip_status", "VOIDED")),
    ("ES", "ES-101", "no_voided_slips", "slip_id", None),
    ("ES", "ES-103", "no_unmapped_fixtures", "slip_id", None),
    ("ES", "ES-104", "valid_sport_code", "sport_code", None),
    ("ES", "ES-102", "matches", "player_dni_hash", HEX64),
    ("DK", "DK-101", "in_set", "slip_status", ["SETTLED", "VOIDED"]),
    ("DK", "DK-104", "valid_sport_code", "sport_code", None),
    ("DK", "DK-201", "not_null", "safe_tampertoken", None),
    ("DK", "DK-202", "matches", "safe_tampertoken", "^TT-[0-9A-F]{8}$"),
    ("BG", "BG-101", "no_unmapped_fixtures", "slip_id", None),
    ("BG", "BG-104", "valid_sport_code", "sport_code", None),
    ("BG", "BG-201", "not_null", "nra_registration_id", None),
    ("BG", "BG-202", "matches", "nra_registration_id", "^BG-[0-9]{4}-[0-9]{9}$"),
    ("BG", "BG-203", "matches", "player_egn_hash", HEX64),
    ("GR", "GR-101", "valid_sport_code", "sport_code", None),
    ("GR", "GR-201", "non_negative", "winnings_withholding_tax", None),
    ("GR", "GR-202", "matches", "player_afm_hash", HEX64),
    ("NL", "NL-101", "valid_sport_code", "sport_code", None),
    ("NL", "NL-201", "not_null", "cdb_record_id", None),
    ("NL", "NL-202", "matches", "cdb_record_id", "^NL-CDB-[0-9]{10}$"),
    ("NL", "NL-203", "not_null", "cruks_check_ref", None),
    ("NL", "NL-204", "matches", "cruks_check_ref", "^CRUKS-[0-9A-F]{8}$"),
    ("NL", "NL-205", "matches", "player_bsn_hash", HEX64),
    ("DE", "DE-101", "no_voided_slips", "slip_id", None),
    ("DE", "DE-102", "valid_sport_code", "sport_code", None),
    ("DE", "DE-103", "no_unmapped_fixtures", "slip_id", None),
    ("DE", "DE-104", "matches", "player_lugas_pseudonym", HEX64),
    ("DE", "DE-201", "not_null", "lugas_activity_id", None),
    ("DE", "DE-202", "matches", "lugas_activity_id", "^LUGAS-[0-9A-F]{12}$"),
    ("FR", "FR-101", "in_set", "slip_status", ["SETTLED", "VOIDED"]),
    ("FR", "FR-102", "zero_when", "payout", ("slip_status", "VOIDED")),
    ("FR", "FR-103", "no_unmapped_fixtures", "slip_id", None),
    ("FR", "FR-104", "valid_sport_code", "sport_code", None),
    ("FR", "FR-105", "max_value", "stake", 50000),
    ("PT", "PT-101", "in_set", "slip_status", ["SETTLED", "VOIDED"]),
    ("PT", "PT-102", "zero_when", "payout", ("slip_status", "VOIDED")),
    ("PT", "PT-103", "no_unmapped_fixtures", "slip_id", None),
    ("PT", "PT-104", "valid_sport_code", "sport_code", None),
    ("PT", "PT-105", "max_value", "stake", 50000),
]
COMMON_GAMING_RULES = [
    ("G-COM-001", "not_null", "activity_id", None), ("G-COM-002", "non_negative", "stake", None),
    ("G-COM-003", "non_negative", "rake_or_fee", None), ("G-COM-004", "unique", "activity_id", None),
    ("G-COM-005", "zero_when", "rake_or_fee", ("vertical", "CASINO_ROUND")),
]
GAMING_RULES = [
    ("MT", "MT-201", "valid_game_code", "game_code", None),
    ("ES", "ES-201", "no_unlicensed_games", "activity_id", None),
    ("ES", "ES-202", "valid_game_code", "game_code", None),
    ("FR", "FR-201", "no_unlicensed_games", "activity_id", None),
    ("FR", "FR-202", "valid_game_code", "game_code", None),
    ("PT", "PT-201", "no_unlicensed_games", "activity_id", None),
    ("PT", "PT-202", "valid_game_code", "game_code", None),
]
COMMON_REGISTER_RULES = [
    ("P-COM-001", "not_null", "player_ref", None), ("P-COM-002", "not_null", "period_start", None),
]
REGISTER_RULES = [
    ("RUD", "ES-RUD-101", "matches", "player_ref", HEX64),
    ("RUD", "ES-RUD-102", "non_negative", "stake_sum", None),
    ("RUT", "ES-RUT-101", "matches", "player_ref", HEX64),
    ("RUT", "ES-RUT-102", "non_negative", "stake_sum", None),
]
SESSION_RULES = [
    ("NL", "ST-201", "activity_within_session"), ("NL", "ST-202", "single_open_session"),
    ("NL", "ST-203", "end_reason_in_set"), ("NL", "ST-204", "single_game_session"),
    ("PT", "ST-201", "activity_within_session"), ("PT", "ST-202", "single_open_session"),
    ("PT", "ST-203", "end_reason_in_set"),
]


def betting_rules(market: str) -> list[tuple]:
    return [*COMMON_BETTING_RULES, *[r[1:] for r in BETTING_RULES if r[0] == market]]


def gaming_rules(market: str) -> list[tuple]:
    return [*COMMON_GAMING_RULES, *[r[1:] for r in GAMING_RULES if r[0] == market]]


def code_set(codes: list[tuple], policy: list[tuple], market: str) -> list[str]:
    """Codes valid in any period, plus the bucket for unmapped values."""
    found = {row[2] for row in codes if row[0] == market}
    found |= {row[1] for row in policy if row[0] == market and row[1] is not None}
    return sorted(found)


def market_frame(spark: SparkSession) -> DataFrame:
    rows = [
        (*r[:7], _m(r[7]), _m(r[8]), _m(r[9]), *r[10:], r[0] in BONUS_GROSS,
         next((s[1] for s in SESSIONS if s[0] == r[0]), None),
         next((s[2] for s in SESSIONS if s[0] == r[0]), None),
         next((s[3] for s in SESSIONS if s[0] == r[0]), False),
         next((s[4] for s in SESSIONS if s[0] == r[0]), False))
        for r in MARKET_ROWS
    ]
    return config_frame(spark, rows, [
        ("jurisdiction", "string"), ("timezone", "string"), ("currency", "string"),
        ("cadence", "string"), ("include_voided", "boolean"), ("tax_basis", "string"),
        ("deduct_contributions", "boolean"), ("default_daily", "money"),
        ("default_weekly", "money"), ("default_monthly", "money"),
        ("withdrawal_needs_identity", "boolean"), ("postcode_pattern", "string"),
        ("region_required", "boolean"), ("hashed_ref", "boolean"), ("bonus_gross", "boolean"),
        ("session_grain", "string"), ("timeout_minutes", "int"), ("file_empty_sessions", "boolean"),
        ("gaming_via_sessions", "boolean"),
    ])


def _rates(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    typed = [(m, _m(r), _d(f), _d(t)) for m, r, f, t in rows]
    return config_frame(spark, typed, [
        ("jurisdiction", "string"), ("rate", "rate"), ("valid_from", "date"), ("valid_to", "date")])


def betting_rate_frame(spark: SparkSession) -> DataFrame:
    return _rates(spark, BETTING_RATES)


def gaming_rate_frame(spark: SparkSession) -> DataFrame:
    return _rates(spark, GAMING_RATES)


def vertical_rate_frame(spark: SparkSession) -> DataFrame:
    return config_frame(spark, [(m, v, _m(r)) for m, v, r in VERTICAL_RATES], [
        ("jurisdiction", "string"), ("vertical", "string"), ("rate", "rate")])


def _codes(spark: SparkSession, rows: list[tuple], canonical: str) -> DataFrame:
    typed = [(m, c, code, _d(f), _d(t)) for m, c, code, f, t in rows]
    return config_frame(spark, typed, [
        ("jurisdiction", "string"), (canonical, "string"), ("regulator_code", "string"),
        ("valid_from", "date"), ("valid_to", "date")])


def sport_code_frame(spark: SparkSession) -> DataFrame:
    return _codes(spark, SPORT_CODES, "canonical_sport")


def game_code_frame(spark: SparkSession) -> DataFrame:
    return _codes(spark, GAME_CODES, "canonical_game_type")


def sport_policy_frame(spark: SparkSession) -> DataFrame:
    return config_frame(spark, SPORT_POLICY, [
        ("jurisdiction", "string"), ("default_sport_code", "string"), ("event_template", "string")])


def game_policy_frame(spark: SparkSession) -> DataFrame:
    return config_frame(spark, GAME_POLICY, [
        ("jurisdiction", "string"), ("default_game_code", "string")])


def stake_band_frame(spark: SparkSession) -> DataFrame:
    typed = [(m, "SLOT", _m(cap), lo, hi, _d(f), _d(t)) for m, cap, lo, hi, f, t in STAKE_BANDS]
    return config_frame(spark, typed, [
        ("jurisdiction", "string"), ("game_scope", "string"), ("max_stake", "money"),
        ("min_age", "int"), ("max_age", "int"), ("valid_from", "date"), ("valid_to", "date")])


def license_frame(spark: SparkSession) -> DataFrame:
    """(market, game) pairs of the markets that license only some games."""
    rows = [(m, g) for m, games in LICENSED_GAMES.items() for g in games]
    return config_frame(spark, rows, [("jurisdiction", "string"), ("game", "string")])


def check_config() -> list[str]:
    """Problems in the tables above, found before any plan is built."""
    problems = []
    known = set(MARKETS)
    for name, rows in {"rates": BETTING_RATES, "sport codes": SPORT_CODES, "bands": STAKE_BANDS,
                       "policy": SPORT_POLICY, "rules": BETTING_RULES}.items():
        problems += [f"{name}: unknown market {r[0]}" for r in rows if r[0] not in known]
    for market in MARKETS:
        columns = {"report_date", *BETTING_FILES[market], *EXTENSIONS.get(market, [])}
        problems += [f"{market}: rule {rid} reads missing column {field}"
                     for rid, _, field, _ in betting_rules(market) if field not in columns]
        if not any(r[0] == market for r in BETTING_RATES):
            problems.append(f"{market}: no tax rate")
    canonical = {code for code, _ in SPORTS}
    problems += [f"alias {a!r}: unknown sport {c}" for a, c, _ in SPORT_ALIASES if c not in canonical]
    return problems
