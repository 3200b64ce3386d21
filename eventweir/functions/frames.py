"""The 5-byte message frame: one magic byte and a 4-byte big-endian schema id."""

from __future__ import annotations

import struct

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the frame layout.
MAGIC = 0
FRAME_BYTES = 5


def frame_prefix(schema_id: int) -> bytes:
    return struct.pack(">bI", MAGIC, schema_id)


def add_frame(body: Column, schema_id: int) -> Column:
    return F.concat(F.lit(frame_prefix(schema_id)), body)


def guard_payload(value: Column) -> Column:
    """The payload itself; null, or too short to hold a frame and a record, fails the query."""
    message = F.concat(
        F.lit("message payload has "),
        F.coalesce(F.octet_length(value).cast("string"), F.lit("no")),
        F.lit(f" bytes; at least {FRAME_BYTES + 1} are needed"),
    )
    return F.when(F.octet_length(value) > FRAME_BYTES, value).otherwise(F.raise_error(message).cast("binary"))


def strip_frame(value: Column) -> Column:
    """Payload without its frame. Neither the magic byte nor the id is checked."""
    return F.substring(value, FRAME_BYTES + 1, 2**31 - 1)


def frame_schema_id(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")
