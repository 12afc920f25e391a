"""Document formats per market and record type.

Element names, their order, namespaces and code lists are the regulators' own:
fixed values. Operator identifiers are settings (``OPERATOR``).
"""

from __future__ import annotations

from .documents import Doc, El, Val, const, field, text, uid

# Settings of the reporting operator; replace with the assigned ones.
OPERATOR = {
    "nl_operator": "OPERATOR", "nl_safe": "CDB-OPERATOR-1", "es_operator": "OPR", "es_store": "OPRSAFE1",
    "fr_operator": "9001", "fr_vault": "1", "pt_operator": "77", "pt_vault": "2AA",
    "dk_licence": "OPERATOR-DK-1", "gr_licensee": "el999999999", "domain": "www.operator.example",
    "maker": "OPERATOR", "rng": "RNG-OPERATOR-1",
}
NO_IP = "0.0.0.0"
ZERO = "0.00"


def el(name: str, *body, **more) -> El:
    return El(name, body[0] if len(body) == 1 and isinstance(body[0], Val) else tuple(body), **more)


def at(name: str, source: str, codec: str) -> El:
    return el(name, field(source, codec))


def same(*names: str, value: object) -> list[El]:
    return [el(n, const(value)) for n in names]


# ---- NL: one record per document under Root ----------------------------------

def _nl(element: str, key: tuple, *body: El) -> list[Doc]:
    head = [el("Record_ID", uid(*key)), el("Extraction_Date", Val("now", codec="datetime")),
            el("Operator_ID", const(OPERATOR["nl_operator"])), el("Data_Safe_ID", const(OPERATOR["nl_safe"]))]
    return [Doc(el("Root", el(element, *head, *body)))]


def _nl_transaction(parent: str, child: str, *key: str, **more) -> El:
    return el(parent, el(child, el("Transaction_ID", uid(*key)), el("Player_Profile_ID", field("player_ref")), **more))


NL = {
    "bets": _nl(
        "WOK_Bet_v1.11", ("nl-bet", "$slip_id", "$status"),
        el("Bet_ID", uid("nl-bet-id", "$slip_id")), at("Bet_Start_Datetime", "placed_at", "datetime"),
        el("Bet_Type", const("SINGLE")), el("Bet_Status", const("BET_SETTLED")),
        el("Bet_Parts", el(
            "Part", el("Part_ID", uid("nl-part", "$slip_id")), el("Part_Event", field("event", cut=256)),
            at("Part_Odds", "odds", "money"), el("Part_Sport", field("sport", cut=32)),
            el("Part_Live", const("false")), at("Part_Match_Datetime", "placed_at", "datetime"),
            el("Part_Prognosis_Result_Type", const("MATCH ODDS")), el("Part_Prognosis_Value", field("selection")),
            at("Part_Stake", "stake", "money"))),
        at("Bet_Total_Stake", "stake", "money"),
        _nl_transaction("Bet_Transactions", "Bet_Transaction", "nl-txn", "$slip_id", "STAKE")),
    "payments": _nl(
        "WOK_Player_Account_Transaction_v1.11", ("nl-payment", "$payment_id"),
        el("Player_Profile_ID", field("player_ref")), el("Transaction_ID", uid("nl-txn", "$payment_id")),
        at("Transaction_Datetime", "completed_at", "datetime"), at("Transaction_Amount", "amount", "money"),
        el("Transaction_Deposit_Instrument",
           field("method", table={"CARD": "CREDIT_CARD", "BANK": "BANK_TRANSFER"}, default="OTHER"),
           when=(("equals", "direction", "DEPOSIT"),)),
        el("Transaction_Type", field("direction")), el("Transaction_Status", const("SUCCESSFUL"))),
    "players": _nl(
        "WOK_Player_Profile_v1.11", ("nl-player", "$player_ref", "$kyc_status"),
        el("Player_Profile_ID", field("player_ref")),
        at("Player_Profile_Registration_Datetime", "opened_at", "datetime"),
        el("Player_Profile_DOB", field("date_of_birth", "date"), when=(("present", "date_of_birth"),)),
        el("Player_Profile_Modified", Val("now", codec="datetime")),
        el("Player_Profile_Status", field("kyc_status", table={"VERIFIED": "ACTIVE"}, default="TRIAL")),
        at("Player_Profile_EOD_Balance", "balance", "money")),
    "sessions": _nl(
        "WOK_Game_Session_v1.11", ("nl-gsession", "$session_id", "$game_part"),
        el("Game_ID", uid("nl-game", "$game")), el("Game_Session_ID", uid("nl-gsession", "$session_id", "$game")),
        at("Game_Session_Start_Datetime", "first_played_at", "datetime"),
        at("Game_Session_End_Datetime", "last_played_at", "datetime"),
        el("Game_Session_Rounds", field("rounds_played")), el("Game_Session_Rounds_Won", field("rounds_won")),
        _nl_transaction("Game_Transactions", "Game_Transaction", "nl-txn", "$round_id", "STAKE", each="rounds")),
    "gaming": _nl(
        "WOK_Game_Session_v1.11", ("nl-gaming", "$round_id"),
        el("Game_ID", uid("nl-game", "$game")), el("Game_Session_ID", uid("nl-session", "$round_id")),
        at("Game_Session_Start_Datetime", "played_at", "datetime"),
        at("Game_Session_End_Datetime", "played_at", "datetime"), el("Game_Session_Rounds", const("1")),
        at("Game_Session_Rounds_Won", "payout", "flag-positive"),
        _nl_transaction("Game_Transactions", "Game_Transaction", "nl-txn", "$round_id", "STAKE")),
}

# ---- ES: a batch (Lote) of registers -----------------------------------------
_DEVICE = [el("IP", const(NO_IP)), el("Dispositivo", const("PC")), el("IdDispositivo", const("demo-web"))]


def _es_amount(name: str, source: str | None = None) -> El:
    """An amount as (quantity, unit) lines; without a source it is empty, zero."""
    if source is None:
        return el(name)
    return el(name, el("Linea", at("Cantidad", source, "money"), el("Unidad", const("EUR")),
                       when=(("present", source),)))


def _es_total(name: str, source: str | None = None) -> El:
    return el(name, _es_amount("Total", source))


def _es_lot(lot: Val, *registers: El) -> list[Doc]:
    head = el("Cabecera", el("OperadorId", const(OPERATOR["es_operator"])),
              el("AlmacenId", const(OPERATOR["es_store"])), el("LoteId", lot), el("Version", const("3.3")))
    return [Doc(el("Lote", head, *registers, attrs=(
        ("xmlns", "http://cnjuego.gob.es/sci/v3.3.xsd"),
        ("xmlns:xsi", "http://www.w3.org/2001/XMLSchema-instance"))))]


_WHOLE = (const("1"), const("1"))
_PART = (field("part_no"), field("parts"))


def _es_register(kind: str, register_id: Val, when_field: str, *body: El, sub: tuple[Val, Val] = _WHOLE) -> El:
    """A register that is filed in several lots keeps its id; its subregister tells them apart."""
    head = el("Cabecera", el("RegistroId", register_id), el("SubregistroId", sub[0]),
              el("SubregistroTotal", sub[1]), at("Fecha", when_field, "digits14"))
    return el("Registro", head, *body, attrs=(("xsi:type", kind),))


def _es_period(name: str, unit: str, source: str, codec: str) -> list[El]:
    return [el("Periodicidad", const(name)), el("Periodo", at(unit, source, codec))]


def _es_movement(name: str, direction: str) -> list[El]:
    """Deposits or withdrawals: the operation where it is one, else a zero total."""
    operation = el("Operaciones", at("Fecha", "completed_at", "digits14tz"), at("Importe", "amount", "money"),
                   el("MedioPago", field("method", fallback="OTRO")),
                   el("TipoMedioPago", field("method", table={"CARD": "1"}, default="99")),
                   el("TitularidadVerificada", const("S")), el("ResultadoOperacion", const("OK")), *_DEVICE)
    return [el(name, at("Total", "amount", "money"), operation, when=(("equals", "direction", direction),)),
            el(name, el("Total", const(ZERO)), when=(("differs", "direction", direction),))]


def _es_account(**more) -> El:
    return el("Jugador", el("JugadorId", field("player_ref")), _es_amount("SaldoInicial"),
              *_es_movement("Depositos", "DEPOSIT"), *_es_movement("Retiradas", "WITHDRAWAL"),
              _es_total("Participacion", "stake_sum"), _es_total("ParticipacionDevolucion"),
              _es_total("Premios", "winnings_sum"),
              *[_es_total(n) for n in ("AjustePremios", "Trans_IN", "Trans_OUT", "Otros")],
              _es_amount("SaldoFinal"), el("Cuentas", el("Cuenta", field("player_ref")), _es_amount("SaldoFinal")),
              _es_total("Comision"), _es_total("Bonos"), **more)


def _es_filing(kind: str, own: El, unit: tuple) -> list[Doc]:
    day = "$period_day" if unit[1] == "Dia" else "$period_month"
    balance = _es_register("RegistroCJD", text("CJD-", day), "period_start", *_es_period(*unit),
                           _es_account(each="rows"), sub=_PART)
    return _es_lot(text(f"LOTE-{kind}-", day, "$part_mark"), own, balance)


ES = {
    "bets": _es_lot(text("LOTE-ADC-", "$slip_id"), _es_register(
        "RegistroApuestaContrapartida", field("slip_id"), "terminal_at",
        el("Juego", el("JuegoId", field("slip_id")), el("JuegoDesc", field("event")), el("TipoJuego", const("ADC")),
           at("FechaInicio", "placed_at", "digits14tz"), at("FechaFin", "terminal_at", "digits14tz"),
           el("EnDirecto", const("N")), el("TipoApuesta", const("Simple")), el("NumeroEventos", const("1")),
           el("Eventos", el("EventoId", field("fixture_id")), el("Hecho", text("1X2: ", "$selection")),
              at("FechaHecho", "terminal_at", "digits14tz"))),
        el("Jugador", el("JugadorId", field("player_ref")), _es_amount("Participacion", "stake"),
           _es_amount("ParticipacionDevolucion"), _es_amount("Premios", "payout"), *_DEVICE,
           el("TicketApuesta", field("slip_id")), at("Cuota", "odds", "money4")))),
    "payments": _es_lot(text("LOTE-CJD-", "$payment_id"), _es_register(
        "RegistroCJD", field("payment_id"), "completed_at",
        *_es_period("Diaria", "Dia", "completed_at", "digits8"), _es_account())),
    "players": _es_lot(text("LOTE-RUD-", "$player_short", "-", "$kyc_status"), _es_register(
        "RegistroRUD", text("RUD-", "$player_half"), "opened_at",
        *_es_period("Diaria", "Dia", "opened_at", "digits8"),
        el("Jugador", el("JugadorId", field("player_ref")), at("FechaActivacion", "opened_at", "digits14"),
           el("CambiosEnDatos", field("kyc_status", table={"PENDING": "A"}, default="S")),
           el("RegionFiscal", const("01"))))),
    "gaming": _es_lot(text("LOTE-OJU-", "$round_id"), _es_register(
        "RegistroOtrosJuegos", field("round_id"), "played_at",
        el("Juego", el("JuegoId", field("round_id")), el("JuegoDesc", field("game")),
           el("TipoJuego", field("game", default="AZA", table={
               "SLOTS": "AZA", "BLACKJACK": "BLJ", "POKER": "POC", "operator-jackpots": "AZA"})),
           at("FechaInicio", "played_at", "digits14tz"), at("FechaFin", "played_at", "digits14tz"),
           _es_amount("Participacion", "stake"), _es_amount("ParticipacionDevolucion"),
           _es_amount("Premios", "payout"), _es_total("Botes"), el("PartidasJugadas", const("1"))),
        el("Jugador", el("JugadorId", field("player_ref")),
           el("Sesion", el("SesionId", field("session_id", other="round_id")),
              *[at(n, "played_at", "digits14tz") for n in ("FechaInicioSesion", "FechaFinSesion",
                                                            "FechaInicioPrimerJuego", "FechaFinUltimoJuego")],
              el("PlanificacionSesion", el("DuracionLimite", const("240000")), el("GastoLimite", const(ZERO)),
                 el("PeriodoExclusion", const("N"))),
              el("SesionCompleta", const("S")), el("SesionNueva", const("S")),
              el("MotivoFinSesion", const("Usuario"))), *_DEVICE))),
    "rud": _es_filing("RUD", _es_register(
        "RegistroRUD", text("RUD-", "$period_day"), "period_start",
        *_es_period("Diaria", "Dia", "period_start", "digits8"),
        el("Jugador", el("JugadorId", field("player_ref")), at("FechaActivacion", "opened_at", "digits14"),
           el("CambiosEnDatos", const("N")), el("RegionFiscal", const("01")), each="rows"), sub=_PART),
        ("Diaria", "Dia", "period_start", "digits8")),
    "rut": _es_filing("RUT", _es_register(
        "RegistroRUT", text("RUT-", "$period_month"), "period_start", at("Mes", "period_start", "digits6"),
        el("NumeroJugadores", field("players")), *same("NumeroAltas", "NumeroBajas", value=0),
        el("NumeroActividad", field("players")), el("NumeroTest", const(0)),
        el("NumeroJugadoresPorEstado", el("EstadoCNJ", const("A")), el("Numero", field("players"))), sub=_PART),
        ("Mensual", "Mes", "period_start", "digits6")),
}

# ---- FR: event traces, several documents per record --------------------------
_SYSTEM = const("0-sys")


def _fr(suffix: str, element: str, when_field: str, key: tuple, *body: El, session: Val | None = None,
        poker: bool = False, when: tuple = ()) -> Doc:
    oper, vault = el("IDOper", const(OPERATOR["fr_operator"])), el("IDCoffre", const(OPERATOR["fr_vault"]))
    what = [at("DateEvt", when_field, "digits12-yy"), el("IDEvt", Val("crc", (*key, None)))]
    who = [el("IDJoueur", field("player_ref")), at("HashJoueur", "player_ref", "sha1-upper")]
    seen, ip = el("IDSession", session or field("session_id", fallback="0-sys")), el("IPJoueur", const(NO_IP))
    head = [oper, vault, *what, *who, ip, seen] if poker else [oper, *what, *who, seen, ip, vault]
    return Doc(el(element, *head, *body), suffix, when)


def _fr_balance(before: str, moved: tuple[str, str], after: str, names: tuple[str, str]) -> list[El]:
    return [at(names[0], before, "money"), at(*moved, "money"), at(names[1], after, "money")]


_PAID = (("positive", "payout"),)
_STAKE, _CREDIT = ("balance_before_stake", "balance_after_stake"), ("balance_before_credit", "balance_after_credit")
_FR_REASONS = ("NonConforme", "MSE", "RencontreAnnulee", "Resultat", "Joueur", "PariModifie")


def _fr_poker(suffix: str, element: str, key: str, word: str, moved: str, wallet: tuple, when: tuple = ()) -> Doc:
    return _fr(suffix, element, "played_at", (key, "$round_id"),
               el("Inscription", field("session_id", other="round_id")), el("Tech", field("round_id")),
               el("Description", text(word + " ", "$game")),
               *_fr_balance(wallet[0], ("SoldeMouvement", moved), wallet[1], ("SoldeAvant", "SoldeApres")),
               poker=True, when=when)


def _or_ref(name: str, codec: str = "text") -> El:
    return el(name, field("username", codec, other="player_ref"))


FR = {
    "bets": [
        _fr("MISE", "PASPMISE", "placed_at", ("fr-bet-mise", "$slip_id", "$status"), el("Tech", field("slip_id")),
            el("PaSp", el("Combi", const("S")),
               el("LigSp", at("Renc", "event", "fr-canonique"), el("Tech", field("fixture_id")),
                  el("Sport", field("sport", default="AUTR", table={
                      "Football": "FOOT", "Tennis": "TENN", "Basketball": "BASK"})),
                  el("Evnt", field("fixture_id")), el("Genre", const("H")), at("Date", "placed_at", "digits12-yy"),
                  El("Part", field("name", "fr-canonique"), each="participants"),
                  el("PronoSp", el("TypeRes", const("RES1X2")), el("Choix", field("selection"))),
                  at("Cote", "odds", "money")),
               at("MiseBase", "stake", "money")),
            *_fr_balance(_STAKE[0], ("Mise", "stake"), _STAKE[1], ("SoldeAvantMise", "SoldeApresMise"))),
        _fr("GAIN", "PASPGAIN", "terminal_at", ("fr-bet-gain", "$slip_id"), el("Supervision"),
            el("Tech", field("slip_id")), at("DateMise", "placed_at", "digits12-yy"),
            at("DateHeure", "terminal_at", "digits12-yy"),
            *_fr_balance(_CREDIT[0], ("Gain", "payout"), _CREDIT[1], ("SoldeAvantGain", "SoldeApresGain")),
            session=_SYSTEM, when=_PAID),
        _fr("ANNUL", "PASPANNUL", "terminal_at", ("fr-bet-annul", "$slip_id"), el("Supervision"),
            el("Tech", field("slip_id")), at("DateMise", "placed_at", "digits12-yy"),
            el("Motif", field("void_reason", table={r: r for r in _FR_REASONS}, default="Autre")),
            *_fr_balance(_CREDIT[0], ("MontantRembours", "stake"), _CREDIT[1],
                         ("SoldeAvantRembours", "SoldeApresRembours")),
            session=_SYSTEM, when=(("equals", "status", "VOIDED"),)),
    ],
    "payments": [
        _fr("ALIM", "CPTEALIM", "completed_at", ("fr-alim", "$payment_id"), el("IDRef", field("payment_id")),
            at("DateDemande", "completed_at", "digits12-yy"), at("DateEffective", "completed_at", "digits12-yy"),
            *_fr_balance("balance_before", ("SoldeMouvement", "amount"), "balance", ("SoldeAvant", "SoldeApres")),
            el("MoyenPaiement", field("method", fallback="AUTRE")),
            el("TypeMoyenPaiement", field("method", default="Autre", table={
                "CARD": "CarteBancaire", "BANK": "VirementBancaire"})),
            when=(("equals", "direction", "DEPOSIT"),)),
        _fr("RETRAIT", "CPTERETRAIT", "completed_at", ("fr-retrait", "$payment_id"),
            el("IDRef", field("payment_id")), at("DateDemande", "completed_at", "digits12-yy"),
            at("SoldeDemande", "amount", "money"),
            *_fr_balance("balance_before", ("SoldeMouvement", "amount"), "balance", ("SoldeAvant", "SoldeApres")),
            when=(("equals", "direction", "WITHDRAWAL"),)),
    ],
    "players": [
        _fr("OUV", "OUVINFOPERSO", "opened_at", ("fr-ouv", "$player_ref"), _or_ref("Login"), _or_ref("Pseudo"),
            _or_ref("Nom", "fr-canonique"), el("Prenom", const("NonRenseigne")), el("Civilite", const("M")),
            el("DateN", field("date_of_birth", "date-compact"), when=(("present", "date_of_birth"),)),
            el("VilleN", const("NonRenseigne")), el("DptN", const("00")), el("PaysN", const("France")),
            el("Email", text("$username", "@operator.example")), when=(("equals", "kyc_status", "PENDING"),)),
        _fr("IDENT", "CPTEIDENTITE", "opened_at", ("fr-ident", "$player_ref"),
            el("NatureVerification", const("PieceIdentite")), session=_SYSTEM,
            when=(("equals", "kyc_status", "VERIFIED"),)),
    ],
    "gaming": [
        _fr_poker("ACHAT", "POACHAT", "fr-po-achat", "Mise", "stake", _STAKE),
        _fr_poker("GAIN", "POGAIN", "fr-po-gain", "Gain", "payout", _CREDIT, _PAID),
    ],
}

# ---- PT: category files (ficheiro) -------------------------------------------


def _pt(kind: str, name: str, content: El) -> list[Doc]:
    return [Doc(el("ficheiro", el("cod_entexpl", const(OPERATOR["pt_operator"])),
                   el("datahr", Val("now", codec="digits14")),
                   el("id_ficheiro", Val("crc", (kind, "$record_key", 30000))),
                   el("cod_cofre", const(OPERATOR["pt_vault"])), el(name, content)))]


def _pt_common(key: str, start: str, end: str) -> list[El]:
    return [el("cod_ficha", field(key)), el("cod_aptr_jog", field(key)), el("ap_cruz", const("N")),
            at("timestp_ini", start, "digits14-fftz"), at("timestp_fim", end, "digits14-fftz"),
            at("dathr_ini_evento", start, "digits14"), at("dathr_fim_evento", end, "digits14"),
            el("cod_fichajog", text("$record_key", "-J")), el("id_sessao", field("session_id", fallback="0")),
            el("ip_jogador", const(NO_IP)), el("ip_regiao", const("PT")), el("cod_opejog", text("$record_key", "-OP")),
            at("timestp", end, "digits14-fftz")]


_VOID, _NOT_VOID = (("equals", "status", "VOIDED"),), (("differs", "status", "VOIDED"),)


def _pt_wallet(commission_last: bool) -> list[El]:
    """Stake, winnings and refund triplets; a voided bet refunds and wins nothing."""
    stake = [at("a_saldo_ini", _STAKE[0], "money"), at("a_valor", "stake", "money"),
             at("a_saldo_fim", _STAKE[1], "money"), *same("a_bonus_ini", "a_bonus", "a_bonus_fim", value=ZERO)]
    fee, opening = el("a_comissao", const(ZERO)), at("g_saldo_ini", _CREDIT[0], "money")
    middle = [opening, fee] if commission_last else [fee, opening]

    def either(name: str, voided: Val, normal: Val) -> list[El]:
        return [El(name, voided, when=_VOID), El(name, normal, when=_NOT_VOID)]
    before, after = field(_CREDIT[0], "money"), field(_CREDIT[1], "money")
    return [*stake, *middle, *either("g_ganho", const(ZERO), field("payout", "money")),
            *either("g_saldo_fim", before, after), *either("r_saldo_ini", before, after),
            *either("r_valor", field("stake", "money"), const(ZERO)), El("r_saldo_fim", after)]


_PT_RESULT = [el("resultado", const("1"), when=_PAID), el("resultado", const("0"), when=(("unpaid", "payout"),))]


def _pt_game(*bets: El) -> list[Doc]:
    account = el("conta_jog", el("codigo", field("player_ref")), at("saldo_ini", _STAKE[0], "money"),
                 at("saldo_mov", "balance_net", "money"), at("saldo_fim", _CREDIT[1], "money"),
                 *same("bonus_ini", "bonus_mov", "bonus_fim", "pinscr_ini", "pinscr_mov", "pinscr_fim", value=ZERO))
    return _pt("AJOG", "registos_jogo", el(
        "jogador", el("codjogador", field("player_ref")), _or_ref("logon"), account, el("apostas", *bets)))


def _pt_round(name: str, game: str, *own: El, tail: tuple = ()) -> El:
    return el(name, *_pt_common("round_id", "played_at", "played_at"), *own, *_pt_wallet(False), *tail,
              when=(("equals", "game", game),))


_PT_TABLE = [el("id_inscricao", field("session_id", other="round_id")), el("id_partida", field("round_id"))]
_PT_CARDS = [*same("cartas_m", "cartas_j", value="NA"), el("posicao_mesa", const(0)), *_PT_RESULT]
PT = {
    "bets": _pt_game(el("sport", *_pt_common("slip_id", "placed_at", "terminal_at"), el("descr_ap", field("event")),
                        *same("combinado", "multipla", value="N"), at("cota_ap", "odds", "money"), *_PT_RESULT,
                        *_pt_wallet(True))),
    "payments": _pt("TRAN", "registos_conta", el(
        "conta", el("codjogador", field("player_ref")), el("cod_conta", field("player_ref")),
        el("cod_optct", field("direction", table={"DEPOSIT": "CREDITO", "WITHDRAWAL": "DEBITO"})),
        at("timestp_op", "completed_at", "digits14-fftz"), at("saldo_ini", "balance_before", "money"),
        at("saldo_mov", "amount", "money"), at("saldo_fim", "balance", "money"))),
    "players": _pt("JGDR", "registos_jogador", el(
        "jogador", el("codjogador", field("player_ref")), el("conta_jog", field("player_ref")),
        el("tip_pag", const("OUTRO")), _or_ref("logon"),
        el("id_cidadao", field("national_id", other="player_ref")), el("id_tipocid", const("4")),
        at("timestp_reg", "opened_at", "digits14-fftz"), _or_ref("alias_jog"),
        el("nome", field("username", fallback="NaoDisponivel")),
        el("data_nascimento", field("date_of_birth", "date-compact"), when=(("present", "date_of_birth"),)),
        el("nif", field("national_id", fallback="000000000")), el("morada", const("NaoDisponivel")),
        el("cod_postal", const("0000-000")), el("id_nacao", const("PT")), el("telefone", const("000000000")),
        el("email", text("$username", "@operator.example")), *same("resp_at", "id_resp_at", value="NA"))),
    "sessions": _pt("SESS", "registos_log", el(
        "jogador", el("codjogador", field("player_ref")), el("id_sessao", field("session_id")),
        at("timestp_acao", "at", "digits14-fftz"), el("tipo_log", field("tipo")), el("dispositivo", const("C")),
        each="events")),
    "gaming": _pt_game(
        _pt_round("poker", "POKER", *_PT_TABLE, el("descr", text("Poker ", "$game")), el("torneio", const("N")),
                  el("id_mesa", const("NA")), el("njog_min", const(2)), el("njog_max", const(9)),
                  el("comp_oper", const(ZERO)), at("buyin", "stake", "money"),
                  *same("buyin_pool", "a_lim_min", "a_lim_max", value=ZERO), el("nr_creditos", const(0)),
                  el("marca_jog", const("N")), *_PT_CARDS,
                  tail=tuple(same("pinscr_ini", "pinscr_mov", "pinscr_fim", value=ZERO))),
        _pt_round("bjack", "BLACKJACK", *_PT_TABLE, el("descr", const("Blackjack")), el("id_mesa", const("NA")),
                  el("njog_max", const(7)), *_PT_CARDS),
        _pt_round("fortazar", "SLOTS", el("descr_ap", const("Slots")), el("ro_result_nr", const(0)),
                  *same("ro_result_cor", "sm_result", "bin_cartao", "bin_result", value="NA"))),
}

# ---- DK ----------------------------------------------------------------------
_DK_NS = (("xmlns", "http://skat.dk/begrebsmodel/2009/01/15/"),)


def _dk_head(category: str | None, *key: str) -> list[El]:
    licence = el("SpilCertifikatIdentifikation", const(OPERATOR["dk_licence"]))
    kind = [el("SpilKategoriNavn", const(category))] if category else []
    return [el("FilInformation", el("SpilFilVersion", const("v2")), el("SpilFilIdentifikation", uid(*key))),
            el("TilladelsesindehaverOgSpil" if category else "Tilladelsesindehaver", licence, *kind)]


_DK_SITE = el("SpilSted", el("SpilHjemmeside", const("https://" + OPERATOR["domain"] + "/dk")))
_DK_SHOP, _DK_MONEY = el("SpilSalgskanal", const("Internet")), el("ValutaOplysningKode", const("EUR"))
_DK_PLAYER = el("SpillerInformationIdentifikation", field("player_ref"))
DK = {
    "bets": [Doc(el(
        "FastoddsspilStruktur", *_dk_head("Fastoddsspil", "dk-bet", "$slip_id", "$status"),
        el("Fastoddsspil", _DK_PLAYER, el("SpilTransaktionIdentifikation", field("slip_id")),
           at("SpilKøbDatoTid", "placed_at", "datetime"), at("SpilFaktiskSlutDatoTid", "terminal_at", "datetime"),
           _DK_SHOP, _DK_SITE,
           el("Begivenhedsinformation", el("BegivenhedsIdentifikation", field("fixture_id")),
              el("Begivenhedsnavn", field("event")), el("Udfaldsnavn", field("selection")),
              at("Begivenhedsodds", "odds", "money")),
           at("SpilIndskudSpil", "stake", "money"), at("SpilGevinstSpil", "payout", "money"), _DK_MONEY,
           el("SpilAnnullering", el("SpilAnnullering", const("1")),
              at("SpilAnnulleringDatoTid", "terminal_at", "datetime"), when=_VOID)), attrs=_DK_NS))],
    "players": [Doc(el("SpillerInformationStruktur", *_dk_head(None, "dk-player", "$player_ref", "$kyc_status"),
                       el("SpillerInformation", _DK_PLAYER), attrs=_DK_NS))],
    "gaming": [Doc(el("KasinospilPrSessionStruktur", el(
        "KasinospilStruktur", *_dk_head("KasinospilSinglePlayer", "dk-gaming", "$round_id"),
        el("KasinospilAggregeretPrSession", el(
            "KasinospilSession", el("SpilProduktNavn", field("game")), el("SpilProduktÅbentNetværk", const(0)),
            _DK_PLAYER, el("SpilTransaktionIdentifikation", field("round_id")),
            at("SpilKøbDatoTid", "played_at", "datetime"), at("SpilFaktiskSlutDatoTid", "played_at", "datetime"),
            _DK_SHOP, el("KasinospilKategori", field("game", default="andet", table={
                "SLOTS": "spilleautomat", "BLACKJACK": "blackjack", "POKER": "poker", "operator-jackpots": "andet"})),
            at("KasinospilIndskudSpil", "stake", "money"), at("KasinospilGevinstSpil", "payout", "money"),
            el("KasinospilAntalTræk", const(1)), _DK_MONEY, _DK_SITE,
            el("TilfældighedGeneratorListe", el(
                "TilfældighedGenerator", el("TilfældighedGeneratorIdentifikation", const(OPERATOR["rng"])),
                el("TilfældighedGeneratorSoftwareId", const("1.0")))),
            el("JackpotListe")))), attrs=_DK_NS))],
}

# ---- GR: a batch per record; the file number is the record's receipt number --


def _gr(name: str, key: tuple, *body: El) -> list[Doc]:
    head = el("BatchHeader", el("FileID", field("seq")), el("LicenseeID", const(OPERATOR["gr_licensee"])))
    return [Doc(el("Batch", head, el(name, el("RecordID", uid(*key)), *body),
                   attrs=(("xmlns", "https://www.gamingcommission.gov.gr"),)))]


_GR_PLAYER, _GR_MAKER = el("PlayerID", field("player_ref")), el("ManufacturerLN", const(OPERATOR["maker"]))
_GR_DOMAIN, _GR_MONEY = el("DomainName", const(OPERATOR["domain"])), el("Currency", const("EUR"))
GR = {
    "bets": _gr(
        "Online_Betting", ("gr-bet", "$slip_id", "$status"), _GR_PLAYER, _GR_MAKER,
        el("BetData", el("BetID", field("slip_id")), el("BetName", field("event", cut=40)),
           el("BetEventData", el("BetEventID", field("fixture_id")), el("MarketID", const("1X2")),
              el("PlayerSelection", field("selection")),
              el("PlayerSelectionOdds", at("Odds", "odds", "money"), el("BetTypeB", const(1)))),
           el("BetType", const(1)), el("BetIP", const(NO_IP)), at("BetPlacedDate", "placed_at", "datetime"),
           at("BetAmount", "stake", "money"), _GR_MONEY),
        el("LogInSessionID", uid("gr-login", "$player_ref", "$placed_text")), _GR_DOMAIN),
    "payments": _gr(
        "Online_Customer_Account_Transaction", ("gr-payment", "$payment_id"), _GR_PLAYER,
        el("TransactionData", el("TransactionID", field("payment_id")), el("TransactionCategory", const("PAYMENT")),
           el("TransactionDesc", text("$direction", " via ", "$method_or_other")),
           el("AdjustmentIndicator", const("false")),
           el("TransactionType", field("direction", table={"DEPOSIT": "1"}, default="0")),
           at("TransactionAmount", "amount", "money"), at("TransactionDate", "completed_at", "datetime"),
           el("TransactionCurrency", const("EUR")), at("AccountBalance", "balance", "money"))),
    "players": _gr(
        "Online_Customer_Account", ("gr-player", "$player_ref", "$kyc_status"), _GR_PLAYER,
        el("CustomerAccount", el("Username", field("player_ref", cut=32)), el("AccountType", const(1)),
           el("AccountStatus", field("kyc_status", table={"PENDING": "1"}, default="2")),
           at("AccountStatusDate", "opened_at", "datetime"),
           el("KYCDate", field("opened_at", "datetime"), when=(("equals", "kyc_status", "VERIFIED"),)),
           el("PlayerRisk", const(1)), _GR_MONEY)),
    "gaming": _gr(
        "Online_Game", ("gr-gaming", "$round_id"), el("GameCategoryA", const(2)),
        el("GameCategoryB", field("game", table={"SLOTS": "1", "BLACKJACK": "2"}, default="0")), _GR_PLAYER,
        _GR_MAKER, el("LogInSessionID", uid("gr-login-session", "$session_or_round")),
        el("TaxationSessionID", uid("gr-tax-session", "$session_or_round", "$played_day")),
        el("GameSessionData", el("GameSessionID", field("round_id")),
           at("GameSessionStartDate", "played_at", "datetime"), at("GameSessionEndDate", "played_at", "datetime"),
           el("Stakes", at("GameSessionAmountWagered", "stake", "money")),
           el("Winnings", at("GameSessionAmountWon", "payout", "money")), _GR_MONEY),
        el("IncompleteGameSessionIndicator", const(1)),
        el("RNGGames", el("GameID", text("HGC-GAME-", "$game")), el("PaytableID", text("HGC-PT-", "$game")),
           el("RNGID", const("HGC-" + OPERATOR["rng"]))), _GR_DOMAIN),
}

# ---- any other market or type: field list and name map -----------------------
_PLAIN = {
    "bets": [("SlipId", "slip_id", "text"), ("PlayerRef", "player_ref", "text"), ("Sport", "sport", "text"),
             ("Event", "event", "text"), ("Selection", "selection", "text"), ("Odds", "odds", "money"),
             ("Stake", "stake", "money"), ("Payout", "payout", "money"), ("Status", "status", "text"),
             ("VoidReason", "void_reason", "text"), ("PlacedAt", "placed_at", "offset"),
             ("SettledAt", "terminal_at", "offset")],
    "payments": [("PaymentId", "payment_id", "text"), ("PlayerRef", "player_ref", "text"),
                 ("Direction", "direction", "text"), ("Amount", "amount", "money"), ("Method", "method", "text"),
                 ("CompletedAt", "completed_at", "offset")],
    "players": [("PlayerRef", "player_ref", "text"), ("Jurisdiction", "jurisdiction", "text"),
                ("KycStatus", "kyc_status", "text"), ("OpenedAt", "opened_at", "offset")],
    "gaming": [("RoundId", "round_id", "text"), ("PlayerRef", "player_ref", "text"), ("Game", "game", "text"),
               ("GameType", "game_type_code", "text"), ("Stake", "stake", "money"), ("Payout", "payout", "money"),
               ("funding", "funding", "text"), ("session_id", "session_id", "text"), ("PlayedAt", "played_at", "offset")],
}


def plain(record_type: str) -> list[Doc]:
    kind = {"bets": "bet", "payments": "payment", "players": "player", "gaming": "gaming"}[record_type]
    return [Doc(el("Record", *[at(*row) for row in _PLAIN[record_type]], attrs=(("type", kind), ("id", "$record_key"))))]


FORMATS = {"NL": NL, "ES": ES, "FR": FR, "PT": PT, "DK": DK, "GR": GR}


def docs_for(market: str, record_type: str) -> list[Doc]:
    """The market's own format, or the plain record where none is stipulated."""
    return FORMATS.get(market, {}).get(record_type) or plain(record_type)
