"""The producer side: event files or tables → aligned records → framed messages."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from eventweir.operators.align import align
from eventweir.operators.records import encode_records
from eventweir.plans.replay import IndexedTable, index_rows
from eventweir.schemas import STREAMS
from eventweir.sources.csv_files import READERS


def read_event_files(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Records per event kind from one CSV path per kind."""
    return {kind: READERS[kind](spark, path) for kind, path in paths.items()}


def to_messages(
    records: Mapping[str, DataFrame], schema_ids: Mapping[str, int], codec: str = "arrow"
) -> DataFrame:
    """Messages of all kinds in one DataFrame; the ``topic`` column routes each row."""
    parts = []
    for kind, df in records.items():
        spec = STREAMS[kind]
        parts.append(encode_records(align(df, spec.wire), spec, schema_ids[kind], codec=codec))
    return reduce(DataFrame.unionByName, parts)


def index_event_files(spark: SparkSession, paths: Mapping[str, str], scratch: str) -> dict[str, IndexedTable]:
    """Records per kind, numbered in the order they have in their file."""
    return {kind: index_rows(df, f"{scratch}/{kind}") for kind, df in read_event_files(spark, paths).items()}
