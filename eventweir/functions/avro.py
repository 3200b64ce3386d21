"""Avro columns: ``decode_avro`` / ``encode_avro`` over a DataFrame column.

With the spark-avro module on the class path the JVM's own ``from_avro`` /
``to_avro`` can be used (``codec="jvm"``). The default, ``"arrow"``, needs no
extra module: an Arrow UDF that decodes a whole batch per call. Both are narrow,
so the rest of the plan stays one stage.
"""

from __future__ import annotations

from collections.abc import Collection

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.functions import avro_batches
from eventweir.functions.frames import add_frame, frame_prefix
from eventweir.schemas import WireSchema

CODECS = ("arrow", "jvm")


def _check(codec: str) -> None:
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}, got {codec!r}")


def _plain(wire: WireSchema) -> avro_batches.Fields:
    return [(f.name, f.type, f.nullable) for f in wire.fields]


def decode_avro(
    body: Column, wire: WireSchema, codec: str = "arrow", wanted: Collection[str] | None = None, permissive: bool = False
) -> Column:
    """Struct column with the wire fields, or only the ``wanted`` ones, of an unframed record.

    Malformed bytes fail the query; bytes after the record are ignored. With ``permissive`` a null
    body or malformed bytes give null fields and a text in the struct's field ``_fault``.
    """
    _check(codec)
    if codec == "jvm":
        if permissive:
            raise ValueError("permissive decoding needs codec='arrow'")
        from pyspark.sql.avro.functions import from_avro

        return from_avro(body, wire.avro_json, {"mode": "FAILFAST"})
    fields = _plain(wire)
    chosen = [f for f in wire.fields if wanted is None or f.name in wanted]
    names = [f.name for f in chosen]

    def decode(batch: pa.Array) -> pa.Array:
        return avro_batches.decode_batch(batch, fields, names, permissive)

    # Marked non-deterministic so that a filter on a decoded field is not pushed below the
    # projection, which would decode every record twice.
    found = [T.StructField(f.name, f.spark_type) for f in chosen]
    if permissive:
        found.append(T.StructField(avro_batches.FAULT, T.StringType()))
    udf = F.arrow_udf(decode, T.StructType(found))
    return udf.asNondeterministic()(body)


def encode_avro(wire: WireSchema, schema_id: int, codec: str = "arrow") -> Column:
    """Framed Avro record of the DataFrame's columns that are named like the wire fields."""
    _check(codec)
    if codec == "jvm":
        from pyspark.sql.avro.functions import to_avro

        return add_frame(to_avro(F.struct(*wire.names), wire.avro_json), schema_id)
    fields, prefix = _plain(wire), frame_prefix(schema_id)

    def encode(*batch: pa.Array) -> pa.Array:
        return avro_batches.encode_batch(list(batch), fields, prefix)

    return F.arrow_udf(encode, T.BinaryType()).asNondeterministic()(*wire.names)
