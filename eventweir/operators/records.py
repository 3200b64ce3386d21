"""Per-stream operators over decoded records. Each is a narrow projection or filter."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweir.functions.avro import decode_avro, encode_avro
from eventweir.functions.avro_batches import FAULT
from eventweir.functions.frames import FRAME_BYTES, guard_payload, strip_frame
from eventweir.functions.text import record_text
from eventweir.operators.align import align
from eventweir.schemas import SinkColumn, StreamSpec


def encode_records(df: DataFrame, spec: StreamSpec, schema_id: int, keep: tuple[str, ...] = (), codec: str = "arrow") -> DataFrame:
    """Records to topic messages: ``topic``, ``value`` and any ``keep`` columns."""
    value = encode_avro(spec.wire, schema_id, codec).alias("value")
    return df.select(*keep, F.lit(spec.topic).alias("topic"), value)


def decode_records(
    messages: DataFrame,
    spec: StreamSpec,
    keep: tuple[str, ...] = (),
    codec: str = "arrow",
    wanted: Collection[str] | None = None,
    permissive: bool = False,
) -> DataFrame:
    """Topic messages to wire fields, by default all. Only ``value`` is read, plus any ``keep``
    columns. Catalyst cannot prune inside the decoder, so ``wanted`` says what to leave out.

    A bad payload fails the query. With ``permissive`` it becomes a row of null fields with a text
    in ``_fault``, which is null for all others; see :func:`quarantined`.
    """
    value = F.col("value")
    body = strip_frame(F.when(F.octet_length(value) > FRAME_BYTES, value) if permissive else guard_payload(value))
    decoded = messages.select(*keep, decode_avro(body, spec.wire, codec, wanted, permissive).alias("record"))
    columns = [f"record.`{FAULT}` as `{FAULT}`"] if permissive else []
    for name in spec.wire.names:
        if wanted is None or name in wanted:
            value = f"record.`{name}`"
            filled = f"if(record.`{FAULT}` is null, coalesce({value}, 0), null)" if permissive else f"coalesce({value}, 0)"
            columns.append(f"{filled if name in spec.zero_filled else value} as `{name}`")
    return decoded.selectExpr(*keep, *columns)


def quarantined(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good records of a permissive decoding, without ``_fault``, and the bad ones: the columns
    kept beside the record (such as ``value``) with ``fault``."""
    names = decoded.columns
    bad = decoded.where(f"`{FAULT}` is not null")
    kept = names[: names.index(FAULT)]
    return decoded.where(f"`{FAULT}` is null").drop(FAULT), bad.select(*kept, F.col(FAULT).alias("fault"))


def keep_keyed(df: DataFrame, spec: StreamSpec) -> DataFrame:
    """Only records whose key field is neither null nor empty."""
    return df.where(f"`{spec.key}` <> ''")


def checked_sql(column: SinkColumn) -> str:
    """SQL for the column's text; more characters than the sink holds fails the query."""
    text = f"`{column.wire}`"
    if column.limit is None:
        return text
    message = f"'{column.name}: value of ', length({text}), ' characters does not fit VARCHAR({column.limit})'"
    return f"case when length({text}) > {column.limit} then raise_error(concat({message})) else {text} end"


def project_sink(df: DataFrame, spec: StreamSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the sink table, renamed, in table order, with lengths checked."""
    return df.selectExpr(*keep, *[f"{checked_sql(c)} as `{c.name}`" for c in spec.columns])


def with_text(df: DataFrame, spec: StreamSpec, name: str = "record") -> DataFrame:
    """Add the record's text form."""
    return df.withColumn(name, record_text(spec.wire))


def tag(df: DataFrame, spec: StreamSpec) -> DataFrame:
    """Add the constant ``event`` column of the kinds that have one."""
    return df if spec.tag is None else df.withColumn("event", F.lit(spec.tag))


__all__ = [
    "align", "decode_records", "encode_records", "keep_keyed",
    "project_sink", "quarantined", "tag", "with_text",
]
