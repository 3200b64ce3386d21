"""DuckDB SQL that gives the result of each query in :mod:`eventweir.plans.catalog`.

The record expressions are shared with the workload; everything after them (Avro bytes,
text forms, filters, renames, replay) is worked out in SQL on its own.
"""

from __future__ import annotations

from eventweir.plans.catalog import SCHEMA_IDS
from eventweir.plans.workload import EVENT_TIME, FIELDS, ORDER_TIME, SOURCE_KEYS, SOURCES
from eventweir.schemas import BUY, CLICK, STREAMS, TOPUP, StreamSpec

DUCKDB_TIMES = {
    EVENT_TIME: "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')",
    ORDER_TIME: "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
}


def _field(kind: str, name: str) -> str:
    text = FIELDS[kind][name]
    return DUCKDB_TIMES.get(text, text)


def _records(spec: StreamSpec) -> str:
    name, event_type = SOURCES[spec.kind]
    fields = ", ".join(f'{_field(spec.kind, n)} AS "{n}"' for n in spec.wire.names)
    only = "true" if event_type is None else f"event_type = '{event_type}'"
    return f"SELECT {SOURCE_KEYS[spec.kind]}, {fields} FROM {name} WHERE {only}"


def _wire(spec: StreamSpec, key: bool, where: str = "true") -> str:
    columns = [SOURCE_KEYS[spec.kind]] if key else []
    columns += [f'"{n}"' for n in spec.wire.names]
    return f"SELECT {', '.join(columns)} FROM ({_records(spec)}) WHERE {where}"


def _keyed(spec: StreamSpec) -> str:
    return f"\"{spec.key}\" IS NOT NULL AND \"{spec.key}\" <> ''"


def _sink(spec: StreamSpec, key: bool = False) -> str:
    columns = [SOURCE_KEYS[spec.kind]] if key else []
    columns += [f'"{c.wire}" AS "{c.name}"' for c in spec.columns]
    return f"SELECT {', '.join(columns)} FROM ({_records(spec)}) WHERE {_keyed(spec)}"


def _varint_hex(z: str) -> str:
    """Hex of the varint of a non-negative 32-bit SQL expression."""
    cases = []
    for size in range(1, 6):
        parts = []
        for i in range(size):
            bits = f"(({z}) >> {7 * i}) & 127"
            parts.append(f"printf('%02X', {bits})" if i == size - 1 else f"printf('%02X', ({bits}) + 128)")
        cases.append(f"WHEN ({z}) < {1 << (7 * size)} THEN {' || '.join(parts)}")
    return f"CASE {' '.join(cases)} END"


def _body_hex(spec: StreamSpec) -> str:
    parts = []
    for field in spec.wire.fields:
        name = f'"{field.name}"'
        if field.type == "int":
            big = f"CAST({name} AS BIGINT)"
            text = _varint_hex(f"CASE WHEN {big} >= 0 THEN 2 * {big} ELSE -2 * {big} - 1 END")
        else:
            text = f"{_varint_hex(f'2 * CAST(strlen({name}) AS BIGINT)')} || hex({name})"
        if field.nullable:
            text = f"CASE WHEN {name} IS NULL THEN '00' ELSE '02' || {text} END"
        parts.append(f"({text})")
    return " || ".join(parts)


def _frame_hex(spec: StreamSpec) -> str:
    return f"'00{SCHEMA_IDS[spec.kind]:08X}' || {_body_hex(spec)}"


def _encoded(spec: StreamSpec, key: bool = True) -> str:
    keys = f"{SOURCE_KEYS[spec.kind]}, " if key else ""
    return f"SELECT {keys}{_frame_hex(spec)} AS value_hex FROM ({_records(spec)})"


def _text(spec: StreamSpec) -> str:
    parts = []
    for i, field in enumerate(spec.wire.fields):
        name = f'"{field.name}"'
        value = f"CAST({name} AS VARCHAR)" if field.type == "int" else f"'\"' || {name} || '\"'"
        parts.append(f"'{', ' if i else '{'}\"{field.name}\": ' || coalesce({value}, 'null')")
    return " || ".join(parts) + " || '}'"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _csv(spec: StreamSpec) -> str:
    """Null text comes back from a CSV file as '', but in the nullable top-up fields as null."""
    columns = []
    for field in spec.wire.fields:
        name = f'"{field.name}"'
        text = field.type == "string" and spec.kind != "topup"
        columns.append(f"coalesce({name}, '') AS {name}" if text else name)
    return f"SELECT {', '.join(columns)} FROM ({_records(spec)})"


NO_PAYLOAD = "message payload is missing or too short"
FAULT_SQL = (
    f"CASE WHEN event_id % 9 < 4 THEN '{NO_PAYLOAD}' WHEN event_id % 9 = 4 THEN 'Avro record ends inside a field: quantity' "
    "WHEN event_id % 9 = 5 THEN 'Avro varint is too long: event' END"
)


def _quarantine() -> str:
    fields = ", ".join(f'CASE WHEN event_id % 9 > 5 THEN r."{n}" END AS "{n}"' for n in BUY.wire.names)
    size = "CAST(length(value_hex) // 2 AS INTEGER)"
    n_bytes = (
        f"CASE event_id % 9 WHEN 1 THEN 0 WHEN 2 THEN 4 WHEN 3 THEN 5 WHEN 4 THEN {size} - 1 WHEN 5 THEN {size} + 5 END"
    )
    return (
        f"SELECT event_id, {fields}, {n_bytes} AS n_bytes, {FAULT_SQL} AS fault "
        f"FROM ({_records(BUY)}) r JOIN ({_encoded(BUY)}) e USING (event_id)"
    )


def _quarantine_counts() -> str:
    counts = f"SELECT {FAULT_SQL} AS fault, count(*) AS n_rows FROM ({_records(BUY)}) WHERE event_id % 9 < 6 GROUP BY 1"
    good = f"SELECT 'none' AS fault, count(*) AS n_rows FROM ({_records(BUY)}) WHERE event_id % 9 > 5 AND {_keyed(BUY)}"
    return _union([counts, good])


def _message_counts() -> str:
    return _union(
        [f"SELECT '{s.topic}' AS topic, count(*) AS n_messages FROM ({_records(s)})" for s in STREAMS.values()]
    )


def _replay() -> str:
    tables, turns = [], []
    for turn, spec in enumerate(STREAMS.values()):
        key = SOURCE_KEYS[spec.kind]
        session = '"sessionId"' if "sessionId" in spec.wire.names else "CAST(NULL AS VARCHAR)"
        phone = '"phoneNumber"' if "phoneNumber" in spec.wire.names else "CAST(NULL AS VARCHAR)"
        tables.append(
            f"{spec.kind} AS (SELECT {key} AS record_key, {session} AS \"sessionId\", {phone} AS \"phoneNumber\", "
            f"row_number() OVER (ORDER BY {key}) - 1 AS pos, count(*) OVER () AS size FROM ({_records(spec)}))"
        )
        turns.append(
            f"SELECT tick, '{spec.topic}' AS topic, record_key, \"sessionId\", \"phoneNumber\" FROM ticks "
            f"JOIN {spec.kind} ON pos = (tick // 3) % size WHERE tick % 3 = {turn}"
        )
    rounds = ", ".join(f"(SELECT count(*) FROM {kind})" for kind in STREAMS)
    ticks = f"ticks AS (SELECT unnest(range(CAST(3 * greatest({rounds}) AS BIGINT))) AS tick)"
    return f"WITH {', '.join(tables)}, {ticks} {_union(turns)}"


def oracle_sql() -> dict[str, str]:
    k = "CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS INTEGER)"
    fan_out = _union([f"SELECT '{sink}' AS sink, * FROM ({_sink(CLICK)})" for sink in ("table", "print")])
    return {
        "s1_topup_topic": _wire(TOPUP, False),
        "s2_buy_topic": _wire(BUY, False),
        "s3_click_topic": _wire(CLICK, False),
        "s4_latest_start": f"SELECT * REPLACE (-quantity AS quantity) FROM ({_sink(BUY)})",
        "s6_value_only": _encoded(BUY, key=False),
        "s8_csv_topup": _csv(TOPUP),
        "s9_csv_click": _csv(CLICK),
        "s10_csv_buy": _csv(BUY),
        "s11_schema_file": _wire(CLICK, True),
        "d1_frame_strip": f"SELECT event_id, CAST({SCHEMA_IDS['click']} AS BIGINT) AS schema_id, "
        f"{_body_hex(CLICK)} AS body_hex FROM ({_records(CLICK)})",
        **{
            name: f"SELECT {SOURCE_KEYS[spec.kind]}, CAST(length(value_hex) // 2 AS INTEGER) AS n_bytes FROM ({_encoded(spec)})"
            for name, spec in (("d2_payload_guard", TOPUP), ("d2_buy_guard", BUY), ("d2_click_guard", CLICK))
        },
        "d3_buy_roundtrip": _wire(BUY, True),
        "d3_quarantine": _quarantine(),
        "d3_quarantine_flow": _quarantine_counts(),
        "d4_click_roundtrip": _wire(CLICK, True),
        "d5_topup_roundtrip": _wire(TOPUP, True),
        "d6_null_int_default": "SELECT event_id, CASE WHEN \"sessionId\" IS NULL THEN 0 ELSE price END AS price, "
        f"CASE WHEN \"sessionId\" IS NULL THEN 0 ELSE quantity END AS quantity FROM ({_records(BUY)})",
        "d7_null_safe_text": f"SELECT event_id, \"sessionId\", category FROM ({_records(CLICK)})",
        "d8_json_decode": f"SELECT event_id, {k} AS k FROM events",
        "d8_nested": f"SELECT event_id, user_id, 2 * {k} AS total FROM events",
        "d9_json_non_null": f"SELECT event_id, {k} AS k FROM events WHERE user_id % 10 <> 0",
        "d10_buy_encode": _encoded(BUY),
        "d10_click_encode": _encoded(CLICK),
        "d10_topup_encode": _encoded(TOPUP),
        "d11_default_fill": "SELECT CAST(NULL AS VARCHAR) AS event, \"sessionId\", "
        'CAST(NULL AS VARCHAR) AS "timestamp", CAST(NULL AS VARCHAR) AS "itemId", price, quantity '
        f"FROM ({_records(BUY)})",
        "d12_required_check": _wire(TOPUP, False),
        "f1_topup_filter": _wire(TOPUP, True, _keyed(TOPUP)),
        "f2_buy_filter": _wire(BUY, True, _keyed(BUY)),
        "f3_click_filter": _wire(CLICK, True, _keyed(CLICK)),
        "p1_topup_project": _sink(TOPUP, True),
        "p2_buy_project": _sink(BUY, True),
        "p3_click_project": _sink(CLICK, True),
        "p4_null_passing": "SELECT is_postpaid, count(*) AS n_rows, "
        "count(*) FILTER (supplier_trans_id IS NULL) AS null_supplier_trans_id, "
        f"count(*) FILTER (job_id IS NULL) AS null_job_id FROM ({_sink(TOPUP)}) GROUP BY 1",
        "p5_event_tag": "SELECT event_id, CASE event_type WHEN 'purchase' THEN 'buy' ELSE 'click' END AS event "
        "FROM events WHERE event_type IN ('purchase', 'click')",
        "p6_text_to_int": "SELECT o_orderkey, CAST(floor(o_totalprice) AS INTEGER) AS total FROM orders",
        "p7_empty_to_null": f"SELECT id, \"supplierTransId\", \"jobId\", \"phoneNumber\" FROM ({_csv(TOPUP)})",
        "p8_record_text": _union(
            [f"SELECT '{s.topic}' AS topic, {_text(s)} AS record FROM ({_records(s)})" for s in STREAMS.values()]
        ),
        "p9_named_cells": _csv(CLICK),
        "k4_topup_sink": _sink(TOPUP),
        "k5_buy_sink": _sink(BUY),
        "k6_click_sink": _sink(CLICK),
        "k4_compacted": f"SELECT * FROM ({_sink(TOPUP)}) UNION ALL SELECT * FROM ({_sink(TOPUP)})",
        "k9_row_key": f"SELECT '{TOPUP.topic}' AS topic, count(*) AS n_rows, CAST(0 AS BIGINT) AS repeated_keys "
        f"FROM ({_sink(TOPUP)})",
        "k10_length_limit": "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_text, "
        "CASE WHEN length(text) <= 255 THEN text END AS code FROM documents",
        "k11_printed_lines": _union(
            [
                f"SELECT '{s.topic}' AS topic, {_text(s)} AS record FROM ({_records(s)}) WHERE {_keyed(s)}"
                for s in STREAMS.values()
            ]
        ),
        "k12_publish": _message_counts(),
        "k13_delivery_counts": _message_counts(),
        "k13_by_partition": "SELECT topic, CAST(2 * n_messages AS BIGINT) AS n_messages, CAST(0 AS BIGINT) AS n_repeated, "
        f"CAST(2 AS BIGINT) AS n_appends FROM ({_message_counts()})",
        "k9_dense_key": "SELECT 2 * count(*) AS n_rows, 2 * count(*) AS n_numbers, CAST(1 AS BIGINT) AS first, 2 * count(*) AS last "
        f"FROM ({_sink(CLICK)})",
        "w4_partition_order": f"SELECT '{CLICK.topic}' AS topic, CAST(3 * count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_breaks, "
        f"true AS several_batches FROM ({_sink(CLICK)})",
        "c1_fan_out": fan_out,
        "c2_three_streams": _union(
            [f"SELECT '{s.table}' AS table_name, count(*) AS n_rows FROM ({_sink(s)})" for s in STREAMS.values()]
        ),
        "c3_query_names": _union(
            [
                f"SELECT '{s.query_name}' AS query_name, count(*) AS n_messages, CAST(0 AS BIGINT) AS n_state_operators, "
                f"false AS watermark FROM ({_records(s)})"
                for s in STREAMS.values()
            ]
        ),
        "c3_operator_counts": _union(
            [
                f"SELECT '{s.query_name}' AS query_name, count(*) AS n_in, count(*) FILTER (NOT coalesce({_keyed(s)}, false)) AS n_dropped, "
                f"count(*) FILTER ({_keyed(s)}) AS n_written FROM ({_records(s)})"
                for s in STREAMS.values()
            ]
        ),
        "c4_topic_routing": _union(
            [
                f"SELECT '{s.topic}' AS topic, CAST({SCHEMA_IDS[s.kind]} AS BIGINT) AS schema_id, "
                "count(*) AS n_messages, CAST(sum(length(value_hex) // 2) AS BIGINT) AS n_bytes "
                f"FROM ({_encoded(s)})"
                for s in STREAMS.values()
            ]
        ),
        "c5_replay": _replay(),
        "c5_row_index": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders",
        "w3_restart": _union([_sink(CLICK), _sink(CLICK)]),
        "w3_new_checkpoint": _union([_sink(CLICK), _sink(CLICK)]),
        "w3_repeated_batch": _union([_sink(BUY), _sink(BUY)]),
        "k1_topup_table": _sink(TOPUP),
        "k2_buy_table": _sink(BUY),
        "k3_click_table": _sink(CLICK),
    }
