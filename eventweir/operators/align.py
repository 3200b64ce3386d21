"""Bring a DataFrame to a wire schema: default fill, required check, field order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventweir.schemas import WireSchema


def required_sql(value: str, name: str) -> str:
    """SQL for the value; null fails the query."""
    return f"coalesce({value}, raise_error('{name}: null in a required field'))"


def checked_cast(value: str, kind: str, name: str) -> str:
    """SQL for the value as a wire type. What the type cannot hold fails the query, whether
    ``spark.sql.ansi.enabled`` is on or off."""
    if kind == "string":
        return f"cast({value} as string)"
    error = f"raise_error(concat('{name}: not {kind}: ', cast({value} as string)))"
    return f"if({value} is null, null, coalesce(try_cast({value} as {kind}), {error}))"


def align(df: DataFrame, wire: WireSchema) -> DataFrame:
    """Exactly the wire fields, in order. A missing nullable field is filled with its default,
    null; a missing required field is an error now, a null in one fails the query."""
    present = set(df.columns)
    columns = []
    for field in wire.fields:
        if field.name in present:
            value = checked_cast(f"`{field.name}`", field.type, field.name)
            value = value if field.nullable else required_sql(value, field.name)
        elif field.nullable:
            value = f"cast(null as {field.type})"
        else:
            raise ValueError(f"{wire.name}: required field {field.name} is missing and has no default")
        columns.append(f"{value} as `{field.name}`")
    return df.selectExpr(*columns)
