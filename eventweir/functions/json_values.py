"""JSON message values decoded to a declared type."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALAR = r'^\s*("([^"\\]|\\.)*+"|[-+0-9.eE]+|true|false)\s*$'


def _nested(kind: T.DataType) -> bool:
    """Whether a value of the type can hold a struct."""
    if isinstance(kind, T.ArrayType):
        return _nested(kind.elementType)
    if isinstance(kind, T.MapType):
        return _nested(kind.valueType)
    return isinstance(kind, T.StructType)


def _unknown(text: Column, kind: T.DataType) -> Column:
    """Keys of the document, at any depth, that the type has no field for. Only levels that can
    hold a struct are looked at; a nested value comes as its own text."""
    if isinstance(kind, T.StructType):
        keys = F.array_except(F.json_object_keys(text), F.array(*[F.lit(n) for n in kind.names]).cast("array<string>"))
        inner = [f for f in kind.fields if _nested(f.dataType)]
        if not inner:
            return keys
        parts = F.from_json(text, T.StructType([T.StructField(f.name, T.StringType()) for f in inner]))
        below = [_unknown(parts[f.name], f.dataType) for f in inner]
        return F.concat(keys, *[F.coalesce(b, F.array().cast("array<string>")) for b in below])
    if isinstance(kind, T.ArrayType):
        values, item = F.from_json(text, T.ArrayType(T.StringType())), kind.elementType
    else:
        values, item = F.map_values(F.from_json(text, T.MapType(T.StringType(), T.StringType()))), kind.valueType
    none = F.array().cast("array<string>")
    return F.flatten(F.transform(values, lambda x: F.coalesce(_unknown(x, item), none)))


# Types a checked VARIANT turns into without a change of meaning, and how its schema shows them.
PLAIN_TYPES = {
    T.ByteType: "BIGINT",
    T.ShortType: "BIGINT",
    T.IntegerType: "BIGINT",
    T.LongType: "BIGINT",
    T.StringType: "STRING",
    T.BooleanType: "BOOLEAN",
}
KEY = r"(?:[A-Za-z0-9_]+|`(?:[^`]|``)+`)"


def _shape(kind: T.DataType) -> str | None:
    """A regular expression for the schemas, in Spark's text form, of documents that are of the type
    and have no other key; None if there is none for a type."""
    if type(kind) in PLAIN_TYPES:
        return f"(?:{PLAIN_TYPES[type(kind)]}|VOID)"
    if isinstance(kind, T.ArrayType):
        item = _shape(kind.elementType)
        return item and f"(?:ARRAY<{item}>|VOID)"
    if isinstance(kind, T.MapType):
        item = _shape(kind.valueType) if isinstance(kind.keyType, T.StringType) else None
        return item and f"(?:OBJECT<(?:{KEY}: {item}(?:, {KEY}: {item})*)?>|VOID)"
    if isinstance(kind, T.StructType):
        fields = ""
        for field in sorted(kind.fields, key=lambda f: f.name.encode()):
            item = _shape(field.dataType)
            if item is None or not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", field.name):
                return None
            fields += f"(?:(?:(?<=<)|, ){field.name}: {item})?"
        return f"(?:OBJECT<{fields}>|VOID)"
    return None


def decode_json(value: Column, schema: T.DataType, strict: bool = True) -> Column:
    """Column of the declared type, one JSON document per value; anything else fails the query.

    The type may be a struct, an array, a map or a scalar. The document ``null`` gives null. With
    ``strict`` a key, at any depth, that a struct has no field for is an error too; without it such
    keys are ignored.

    For a strict check each text is parsed once, to VARIANT: its schema is compared with the type,
    keys and types of all levels at once, and the same value gives the result. Documents that are
    not plainly of the type, mostly bad ones, take the longer way, which finds out what is wrong.
    """
    careful = _decode_stepwise(value, schema, strict)
    shape = _shape(schema) if strict and _nested(schema) else None
    if shape is None:
        return careful
    text = value.cast("string")
    plain = F.transform(
        F.array(F.try_parse_json(text)),
        lambda v: F.when(F.schema_of_variant(v).rlike(f"^{shape}$"), F.struct(v.cast(schema).alias("value"))),
    )
    return F.coalesce(plain[0], F.struct(careful.alias("value")))["value"]


def _decode_stepwise(value: Column, schema: T.DataType, strict: bool) -> Column:
    """Parsed by type, and once more for each level whose keys are checked."""
    text = value.cast("string")
    if isinstance(schema, T.StructType | T.MapType):
        whole = F.json_object_keys(text).isNotNull()  # null for anything that is not one whole object
        parsed = F.from_json(text, schema, {"mode": "FAILFAST"})
    elif isinstance(schema, T.ArrayType):
        whole = F.json_array_length(text).isNotNull()
        parsed = F.from_json(text, schema, {"mode": "FAILFAST"})
    else:
        whole = text.rlike(SCALAR)
        parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema), {"mode": "FAILFAST"})[0]
    message = F.concat(F.lit(f"not JSON of type {schema.simpleString()}: "), F.coalesce(text, F.lit("null value")))
    bad = F.raise_error(message).cast(schema)
    parsed = F.coalesce(parsed, bad)
    checked = strict and _nested(schema)
    unknown = _unknown(text, schema) if checked else None
    # Good documents first: no other branch is worked out for them.
    result = F.when(whole & (F.size(unknown) == 0) if checked else whole, parsed)
    result = result.when(F.btrim(text, F.lit(" \t\r\n")) == "null", F.lit(None).cast(schema))
    if checked:
        named = F.concat(F.lit("unknown JSON fields: "), F.array_join(unknown, ", "))
        result = result.when(whole, F.raise_error(named).cast(schema))
    return result.otherwise(bad)
