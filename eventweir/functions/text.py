"""Scalar text functions. All are built-in expressions and stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventweir.schemas import WireSchema


def int_sql(text: str, name: str) -> str:
    """SQL for the 32-bit int that a SQL text expression holds. Surrounding white space is
    allowed; anything else fails the query."""
    error = f"raise_error(concat('{name}: not an int: ', coalesce({text}, 'null')))"
    return f"coalesce(try_cast({text} as int), {error})"


def text_to_int(text: str, name: str) -> Column:
    return F.expr(int_sql(text, name))


# Named escapes (as SQL) and escaped ranges (as patterns) of the Avro text form.
NAMED_ESCAPES = (
    "map('\"', r'\\\"', r'\\', r'\\\\', chr(8), r'\\b', chr(12), r'\\f', "
    "chr(10), r'\\n', chr(13), r'\\r', chr(9), r'\\t')"
)
HEX_ESCAPED = r"[\x00-\x1f\x7f-\x9f\u2000-\u20ff]"
ANY_ESCAPED = r'["\\\x00-\x1f\x7f-\x9f\u2000-\u20ff]'

ESCAPED_CHAR = (
    f"coalesce(try_element_at({NAMED_ESCAPES}, c), "
    f"case when c rlike r'{HEX_ESCAPED}' then concat(r'\\u', lpad(hex(ascii(c)), 4, '0')) end, c)"
)
ESCAPED_PART = (
    f"concat(p.label, coalesce(case when p.is_text then "
    f"concat('\"', array_join(transform(split(p.value, ''), c -> {ESCAPED_CHAR}), ''), '\"') "
    "else p.value end, 'null'))"
)


def record_text(wire: WireSchema) -> Column:
    """All fields of a record in the Avro text form, ``{"a": "x", "b": 1, "c": null}``.

    Written as SQL text: building so wide an expression column by column takes the driver
    longer than a small query runs.
    """
    plain, parts, strings = [], [], []
    for i, field in enumerate(wire.fields):
        label = f"'{', ' if i else '{'}\"{field.name}\": '"
        value = f"cast(`{field.name}` as string)"
        is_text = field.type == "string"
        shown = f"concat('\"', {value}, '\"')" if is_text else value
        plain.append(f"{label}, coalesce({shown}, 'null')")
        parts.append(f"struct({label} as label, {value} as value, {str(is_text).lower()} as is_text)")
        strings += [value] if is_text else []
    # One look at all strings of the record finds out whether any needs escapes; few do.
    special = f"concat_ws('', {', '.join(strings)}) rlike r'{ANY_ESCAPED}'"
    escaped = f"array_join(transform(array({', '.join(parts)}), p -> {ESCAPED_PART}), '')"
    return F.expr(f"concat(case when {special} then {escaped} else concat({', '.join(plain)}) end, '}}')")
