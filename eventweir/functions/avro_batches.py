"""Avro binary codec for flat string / int records, one Arrow batch at a time.

Helpers for the Arrow UDFs in :mod:`eventweir.functions.avro`. Work is per column:
each step handles one field of every record of the batch with numpy / Arrow
kernels, so no Python code runs per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Fields = list[tuple[str, str, bool]]  # name, "string" or "int", nullable

INT_BYTES = 5  # longest varint of a 32-bit value
ARROW_TYPES = {"string": pa.string(), "int": pa.int32()}
UNION_STRING = 2  # union branch 1, zigzag


class MalformedRecord(ValueError):
    """The payload is not a record of the declared schema."""


def _raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Buffer]:
    """Bytes, row offsets and data buffer of a binary / string array."""
    wide = pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    data = data if data is not None else pa.py_buffer(b"")
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8), bounds, data


class _Faults:
    """What happens to records that are not of the schema: the first one raises or, if faults are
    ``noted``, each gets a text and is left alone from then on."""

    def __init__(self, size: int, noted: bool) -> None:
        self.live = np.arange(size)
        self.noted = noted
        self.texts: list[str] = []
        self.codes = np.full(size, -1, np.int32)

    def at(self, rows: np.ndarray, text: str) -> None:
        if not len(rows):
            return
        if not self.noted:
            raise MalformedRecord(text)
        self.codes[rows] = len(self.texts)
        self.texts.append(text)
        self.live = np.flatnonzero(self.codes < 0)

    def column(self) -> pa.Array:
        texts = pa.array(self.texts, pa.string())
        return texts.take(pa.array(np.maximum(self.codes, 0), mask=self.codes < 0)) if self.texts else pa.nulls(len(self.codes), pa.string())


def _read_varint(raw: np.ndarray, pos: np.ndarray, end: np.ndarray, rows: np.ndarray, faults: _Faults, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Varint of the records ``rows`` at ``pos``, before zigzag; also returns the new positions."""
    value = np.zeros(len(pos), np.int64)
    pos = pos.copy()
    for step in range(INT_BYTES):
        at = pos[rows]
        short = at >= end[rows]
        if short.any():
            faults.at(rows[short], f"Avro record ends inside a field: {name}")
            rows, at = rows[~short], at[~short]
        byte = raw[at].astype(np.int64)
        if step == INT_BYTES - 1 and (byte > 0x7F).any():
            faults.at(rows[byte > 0x7F], f"Avro varint is too long: {name}")
            rows, byte = rows[byte <= 0x7F], byte[byte <= 0x7F]
        value[rows] |= (byte & 0x7F) << (7 * step)
        pos[rows] += 1
        rows = rows[byte > 0x7F]
        if not len(rows):
            break
    return value, pos


def _unzigzag(value: np.ndarray) -> np.ndarray:
    return (value >> 1) ^ -(value & 1)


def _slice_strings(
    data: pa.Buffer, start: np.ndarray, stop: np.ndarray, null: np.ndarray | None, ascii_only: bool
) -> pa.Array:
    """Strings ``data[start:stop]``. Every other slot of an array over the same buffer is a
    field of this column, so Arrow's ``take`` gathers them without a copy in Python."""
    bounds = np.empty(2 * len(start), np.int64)
    bounds[0::2], bounds[1::2] = start, stop
    spans = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), data]
    )
    picked = spans.take(pa.array(np.arange(0, len(bounds) - 1, 2), mask=null)).cast(pa.binary())
    text = picked.view(pa.string())
    if not ascii_only:
        try:
            text.validate(full=True)
        except pa.ArrowInvalid:
            # Malformed UTF-8 becomes U+FFFD, as when Avro text is turned into a Java string.
            text = pa.array([None if b is None else b.decode("utf-8", "replace") for b in picked.to_pylist()], pa.string())
    return text


#: Name of the column of texts about bad records.
FAULT = "_fault"
NO_PAYLOAD = "message payload is missing or too short"


def decode_batch(body: pa.Array, fields: Fields, wanted: list[str] | None = None, permissive: bool = False) -> pa.StructArray:
    """Decode one unframed Avro record per row. Bytes after the record are ignored.

    Every field is checked; only the ``wanted`` ones, by default all, are in the result. A bad
    record raises; with ``permissive`` it gets null in every field and a text in the column
    ``_fault``, and the others of the batch go on.
    """
    if wanted is None:
        wanted = [name for name, _, _ in fields]
    if isinstance(body, pa.ChunkedArray):
        body = body.combine_chunks()
    if body.null_count and not permissive:
        raise MalformedRecord("Avro payload is null")
    names = [*wanted, *([FAULT] if permissive else [])]
    if not len(body):
        empty = [pa.array([], ARROW_TYPES[kind]) for name, kind, _ in fields if name in wanted]
        return pa.StructArray.from_arrays([*empty, *([pa.array([], pa.string())] if permissive else [])], names=names)
    raw, bounds, data = _raw(body)
    pos, end = bounds[:-1], bounds[1:]
    faults = _Faults(len(pos), permissive)
    if body.null_count:
        faults.at(np.flatnonzero(body.is_null().to_numpy(zero_copy_only=False)), NO_PAYLOAD)
    ascii_only = not (raw[bounds[0] : bounds[-1]] > 0x7F).any()
    columns = []
    for name, kind, nullable in fields:
        null = None
        if nullable:
            branch, pos = _read_varint(raw, pos, end, faults.live, faults, name)
            unknown = (branch != 0) & (branch != UNION_STRING)
            if unknown.any():
                faults.at(faults.live[unknown[faults.live]], f"unknown union branch: {name}")
            null = branch == 0
        # A null has no bytes after its branch.
        rows = faults.live if null is None or not null.any() else faults.live[~null[faults.live]]
        value, after = _read_varint(raw, pos, end, rows, faults, name)
        if kind == "int":
            if name in wanted:
                columns.append((kind, value, after, null))
        else:
            size = _unzigzag(value)
            stop = after + size
            bad = (size < 0) | (stop > end)
            if bad.any():
                faults.at(faults.live[bad[faults.live]], f"bad string length: {name}")
                stop = np.where(bad, after, stop)
            if name in wanted:
                columns.append((kind, after, stop, null))
            after = stop
        pos = after
    dead = faults.codes >= 0 if len(faults.live) < len(bounds) - 1 else None
    arrays = [_column(data, kind, first, second, null, dead, bounds[:-1], ascii_only) for kind, first, second, null in columns]
    return pa.StructArray.from_arrays([*arrays, *([faults.column()] if permissive else [])], names=names)


def _column(
    data: pa.Buffer,
    kind: str,
    first: np.ndarray,
    second: np.ndarray,
    null: np.ndarray | None,
    dead: np.ndarray | None,
    starts: np.ndarray,
    ascii_only: bool,
) -> pa.Array:
    """An int column of zigzag values, or a string column of spans, without the dead records: of
    those the span is empty, where the record ``starts``, so that places never decrease."""
    if dead is not None:
        null = dead if null is None else null | dead
    if kind == "int":
        return pa.array(_unzigzag(first & 0xFFFFFFFF).astype(np.int32), mask=null)
    if dead is not None:
        first, second = np.where(dead, starts, first), np.where(dead, starts, second)
    return _slice_strings(data, first, second, null, ascii_only)


def _varints(value: np.ndarray, null: np.ndarray | None) -> pa.Array:
    """Zigzag varint bytes per row; with ``null``, preceded by the union branch."""
    zigzag = (value << 1) ^ (value >> 63)
    width = max(1, -(-int(zigzag.max(initial=0)).bit_length() // 7))
    lead = 0 if null is None else 1
    out = np.empty((len(value), lead + width), np.uint8)
    used = np.empty(out.shape, bool)
    for step in range(width):
        rest = zigzag >> (7 * step)
        used[:, lead + step] = rest > 0 if step else True
        out[:, lead + step] = (rest & 0x7F) | np.where(rest > 0x7F, 0x80, 0)
    if null is not None:
        out[:, 0] = np.where(null, 0, UNION_STRING)
        used[null, 1:] = False
        used[:, 0] = True
    offsets = np.zeros(len(value) + 1, np.int32)
    np.cumsum(used.sum(axis=1), out=offsets[1:])
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(value), [None, pa.py_buffer(offsets), pa.py_buffer(out[used])]
    )


def encode_batch(columns: list[pa.Array], fields: Fields, prefix: bytes = b"") -> pa.Array:
    """Encode one Avro record per row, with ``prefix`` before each."""
    pieces = []
    for (name, kind, nullable), column in zip(fields, columns):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        null = None
        if nullable:
            null = column.is_null().to_numpy(zero_copy_only=False)
        elif column.null_count:
            raise MalformedRecord(f"null in required field {name}")
        if kind == "int":
            value = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            pieces.append(_varints(value, null))
        else:
            text = column.fill_null("").cast(pa.binary())
            size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
            pieces += [_varints(size, null), text]
    head = pa.scalar(prefix, pa.binary())
    return pc.binary_join_element_wise(head, *pieces, pa.scalar(b"", pa.binary()))
