"""Cyclic replay of the event tables, interleaved one record per kind.

Tick ``t`` plays kind ``t % kinds`` and, of that kind's table, row ``t div kinds`` modulo
the table size. All of it works on a dense row index per table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweir.schemas import STREAMS

ROW = "_row"
TICK = "tick"
# Times that one step makes a task play a row before the steps are dealt out anew.
STEP = 1024
ROW_ID_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row of the partition here


@dataclass(frozen=True)
class IndexedTable:
    rows: DataFrame  # with a dense 0-based ``_row`` column
    size: int


def index_rows(df: DataFrame, scratch: str, order_by: str | None = None) -> IndexedTable:
    """Number the rows 0, 1, 2, … in the order of a unique sequence column, or without one in
    the order they are read in, which for a single file is the order of its rows.

    Rows with a sequence column are range-partitioned and sorted in parallel; otherwise
    nothing is shuffled. They are written with their partition and place in it, so that both
    stay as they are when the table is read again. Adding up the partition sizes then gives
    every partition's first index; only those sizes, one row per partition, meet in one task.
    """
    spark = df.sparkSession
    if order_by is not None:
        df = df.repartitionByRange(F.col(order_by)).sortWithinPartitions(order_by)
    placed = df.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_ID_MASK)).alias("_place"),
    )
    placed.write.parquet(scratch)
    staged = spark.read.schema(placed.schema).parquet(scratch)
    sizes = staged.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    rows = staged.join(first, "_part").withColumn(ROW, F.col("_first") + F.col("_place"))
    size = sizes.agg(F.sum("_size")).first()[0] or 0
    if size == 0:
        raise ValueError("cannot replay an empty table")
    return IndexedTable(rows.drop("_part", "_place", "_first"), size)


def _turns(tables: Mapping[str, IndexedTable]) -> list[tuple[int, str, IndexedTable]]:
    kinds = [kind for kind in STREAMS if kind in tables]
    return [(turn, kind, tables[kind]) for turn, kind in enumerate(kinds)]


def replay_first(spark: SparkSession, tables: Mapping[str, IndexedTable], n: int) -> dict[str, DataFrame]:
    """Per kind, the records of the first ``n`` ticks.

    Each row works out its own ticks, with no join. Where it has more than one step of ``STEP``
    rounds, the steps are dealt out over the tasks first, so that a small table that is played
    very often is made by many tasks. The result is dealt out by ranges of ticks, each in tick order.
    """
    played = {}
    for turn, kind, table in _turns(tables):
        rounds = max(0, -(-(n - turn) // len(tables)))
        cycles = max(1, -(-rounds // table.size))
        steps = table.rows.select("*", F.explode(F.expr(f"sequence(0L, {cycles - 1}L, {STEP}L)")).alias("_step"))
        if cycles > STEP:
            steps = steps.repartition(ROW, "_step")
        cycle = F.explode(F.expr(f"sequence(_step, least(_step + {STEP - 1}L, {cycles - 1}L))")).alias("_cycle")
        tick = F.expr(f"(_cycle * {table.size}L + cast({ROW} as bigint)) * {len(tables)}L + {turn}L")
        rows = steps.select("*", cycle).withColumn(TICK, tick).where(F.col(TICK) < F.lit(n).cast("long"))
        played[kind] = rows.drop(ROW, "_step", "_cycle").repartitionByRange(TICK).sortWithinPartitions(TICK)
    return played


def interleaved(played: Mapping[str, DataFrame]) -> DataFrame:
    """All kinds in one DataFrame with a ``topic`` column; absent fields are null."""
    parts = [df.withColumn("topic", F.lit(STREAMS[kind].topic)) for kind, df in played.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
