"""Declared shape and load rules of the operational tables.

Column names, keys and formats are fixed values: files in this shape have to load as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from tallyhouse.functions import presets as P


@dataclass(frozen=True)
class TableSpec:
    """How a text file becomes rows of one table.

    columns    name -> kind ("text" or a key of presets.PATTERNS), in file order
    required   columns that may not be NULL (blank: see `blank`)
    not_empty  columns that may not be '' either
    formats    column -> whether NULL passes its format rule ("pass" or "fail")
    domains    column -> (allowed values, whether NULL passes)
    foreign    column -> (parent table, parent column), checked after the row rules
    bad_rows   "stop" the batch, "quarantine" them with their reasons, or "drop" them
    missing    foreign keys that stop the batch instead of dropping the row
    dedup      "latest" by `latest_by`, "one", "last" in file order, or "refuse" repeats
    """

    name: str
    columns: Mapping[str, str]
    key: Sequence[str]
    required: Sequence[str]
    blank: str = "allowed"
    not_empty: Sequence[str] = ()
    formats: Mapping[str, str] = field(default_factory=dict)
    domains: Mapping[str, tuple[Sequence[str], str]] = field(default_factory=dict)
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    missing: Sequence[str] = ()
    bad_rows: str = "stop"
    stop_on_null: Sequence[str] = ()
    dedup: str = "refuse"
    latest_by: Sequence[str] = ()
    key_folded: bool = False
    trim: Sequence[str] = ()
    normalise: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)
    limits: Mapping[str, int] = field(default_factory=dict)
    force_null: bool = False


_SPECS = [
    TableSpec(
        "player",
        {"email": "text", "first_name": "text", "last_name": "text", "dob": "date", "phone": "text", "registration_date": "timestamp", "loyalty_points": "int"},
        key=["email"],
        required=["email", "last_name"],
        blank="empty",
        formats={"dob": "fail", "registration_date": "fail", "loyalty_points": "fail"},
        bad_rows="drop",
        dedup="latest",
        latest_by=["registration_date"],
    ),
    TableSpec(
        "staff",
        {"staff_email": "text", "first_name": "text", "last_name": "text", "position": "text", "hire_date": "date", "salary": "decimal"},
        key=["staff_email"],
        required=["staff_email", "last_name"],
        blank="empty",
        formats={"hire_date": "pass", "salary": "pass"},
        bad_rows="drop",
        dedup="last",
    ),
    TableSpec(
        "casino_location",
        {"location_code": "text", "name": "text", "address": "text", "city": "text", "state": "text", "country": "text"},
        key=["location_code"],
        required=["location_code", "name"],
        blank="empty",
        bad_rows="drop",
        dedup="one",
    ),
    TableSpec(
        "game",
        {"game_name": "text", "type": "text", "min_bet": "decimal", "max_bet": "decimal"},
        key=["game_name"],
        required=["game_name", "type"],
        blank="trimmed",
        trim=["game_name"],
        normalise={"type": P.GAME_TYPES},
        bad_rows="drop",
        dedup="latest",
        latest_by=["min_bet"],
        key_folded=True,
    ),
    TableSpec(
        "player_game",
        {"player_email": "text", "game_name": "text", "play_time": "timestamp", "amount_bet": "decimal", "amount_won": "decimal"},
        key=["player_email", "game_name", "play_time"],
        required=["player_email", "game_name", "play_time", "amount_bet", "amount_won"],
        formats={"play_time": "fail", "amount_bet": "fail", "amount_won": "fail"},
        foreign={"player_email": ("player", "email"), "game_name": ("game", "game_name")},
        bad_rows="drop",
        dedup="one",
        force_null=True,
    ),
    TableSpec(
        "table_game",
        {"table_code": "text", "game_name": "text", "location_code": "text", "status": "text"},
        key=["table_code"],
        required=["table_code", "game_name", "location_code"],
        domains={"status": (P.TABLE_STATUSES, "pass")},
        foreign={"game_name": ("game", "game_name"), "location_code": ("casino_location", "location_code")},
        missing=["location_code"],
        defaults={"status": P.TABLE_STATUS_DEFAULT},
    ),
    TableSpec(
        "staff_assigned_tables",
        {"staff_email": "text", "table_code": "text", "shift_start": "timestamp", "shift_end": "timestamp"},
        key=["staff_email", "table_code", "shift_start"],
        required=["staff_email", "table_code"],
        formats={"shift_start": "pass", "shift_end": "pass"},
        foreign={"table_code": ("table_game", "table_code"), "staff_email": ("staff", "staff_email")},
    ),
    TableSpec(
        "slot_machine",
        {"machine_code": "text", "location_code": "text", "status": "text", "model": "text"},
        key=["machine_code"],
        required=["machine_code", "location_code"],
        domains={"status": (P.MACHINE_STATUSES, "pass")},
        foreign={"location_code": ("casino_location", "location_code")},
        bad_rows="quarantine",
    ),
    TableSpec(
        "slot_play",
        {"machine_code": "text", "player_email": "text", "play_time": "timestamp", "bet_amount": "decimal", "win_amount": "decimal"},
        key=["machine_code", "player_email", "play_time"],
        required=["machine_code", "player_email"],
        formats={"play_time": "pass", "bet_amount": "pass", "win_amount": "pass"},
    ),
    TableSpec(
        "reward",
        {"reward_code": "text", "name": "text", "points_required": "int", "description": "text"},
        key=["reward_code"],
        required=["reward_code", "name"],
        formats={"points_required": "pass"},
    ),
    TableSpec(
        "player_reward",
        {"player_email": "text", "reward_code": "text", "redeem_date": "timestamp"},
        key=["player_email", "reward_code", "redeem_date"],
        required=["player_email", "reward_code"],
        formats={"redeem_date": "pass"},
    ),
    TableSpec(
        "transaction",
        {"transaction_code": "text", "player_email": "text", "amount": "cents", "transaction_type": "text", "transaction_time": "timestamp", "game_name": "text"},
        key=["transaction_code"],
        required=["transaction_code", "player_email", "amount", "transaction_type"],
        formats={"transaction_time": "pass", "amount": "pass"},
        foreign={"game_name": ("game", "game_name"), "player_email": ("player", "email")},
    ),
    TableSpec(
        "game_result",
        {"result_code": "text", "game_name": "text", "table_code": "text", "result_time": "timestamp", "outcome_description": "text"},
        key=["result_code"],
        required=["result_code", "game_name", "result_time", "outcome_description", "table_code"],
        not_empty=["table_code"],
        formats={"result_time": "pass"},
        foreign={"game_name": ("game", "game_name"), "table_code": ("table_game", "table_code")},
        bad_rows="quarantine",
    ),
    TableSpec(
        "login_history",
        {"login_id": "uuid", "player_email": "text", "login_time": "timestamp", "ip_address": "text", "device": "text"},
        key=["login_id"],
        required=["login_id", "player_email", "login_time", "ip_address"],
        formats={"login_time": "pass", "login_id": "pass"},
        foreign={"player_email": ("player", "email")},
        bad_rows="quarantine",
        limits={"device": P.DEVICE_TEXT_LIMIT},
    ),
    TableSpec(
        "audit_log",
        {"log_code": "text", "event_type": "text", "event_time": "timestamp", "performed_by": "text", "details": "text"},
        key=["log_code"],
        required=["log_code", "event_type", "event_time", "details"],
        formats={"event_time": "pass"},
        foreign={"performed_by": ("staff", "staff_email")},
        stop_on_null=["performed_by"],
        bad_rows="quarantine",
    ),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}
