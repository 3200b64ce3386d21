"""Print records, on the executors: nothing is collected to the driver."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from eventweir.operators.records import with_text
from eventweir.schemas import StreamSpec


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sys.stdout.write("\n".join([*batch.column(0).to_pylist(), ""]))
            sys.stdout.flush()
    return iter(())


def printed_lines(records: DataFrame, spec: StreamSpec) -> DataFrame:
    """What is printed: one line, the text form, for each record."""
    return with_text(records, spec).select("record")


def print_records(records: DataFrame, spec: StreamSpec) -> None:
    """Every record's text form, one line each, to the standard output of the executors, an Arrow
    batch at a time."""
    lines = printed_lines(records, spec)
    lines.mapInArrow(_print_batches, lines.schema).write.format("noop").mode("overwrite").save()
