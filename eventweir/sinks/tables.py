"""Table sinks without a database: Parquet directories and catalog tables."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.plans.scratch import remove
from eventweir.schemas import StreamSpec
from eventweir.sinks import compaction
from eventweir.sinks.ledger import PIECE, PLACE, OffsetLedger

SPARK_COLUMN_TYPES = {"string": T.StringType(), "text": T.StringType(), "int": T.IntegerType()}

# Instead of a key the database assigns: unique, and stable when a batch is written again.
KEY_FIELDS = [
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
]


# Where a micro-batch's rows are kept apart from others'.
BATCH_FIELDS = {"run": "STRING", "batch_id": "BIGINT"}


def sink_schema(spec: StreamSpec, keyed: bool = False) -> T.StructType:
    columns = [T.StructField(c.name, SPARK_COLUMN_TYPES[c.type]) for c in spec.columns]
    return T.StructType([*(KEY_FIELDS if keyed else []), *columns])


IDX = "idx"
_PLACE_BITS = 33  # monotonically_increasing_id keeps the row of the partition here


@dataclass(frozen=True)
class FileTableSink:
    """One Parquet directory per stream. Each micro-batch has its own sub-directory, named by the
    streaming query (its checkpoint's identity) and the batch. A repeated batch overwrites its
    own directory only, so rows are there exactly once after any retry or restart, and another
    query or checkpoint only ever adds rows. :meth:`compact` packs small files; :meth:`read` knows.

    ``keyed`` adds ``topic, partition, offset`` as the row key. ``numbered`` adds ``idx``, which
    counts the table's rows from 1 on in the order of insertion, without gaps: one flow at a time.
    """

    root: str
    keyed: bool = False
    numbered: bool = False

    def path(self, spec: StreamSpec) -> str:
        return f"{self.root}/{spec.table}"

    def _batch(self, spec: StreamSpec, batch_id: int, run: str) -> str:
        return f"{self.path(spec)}/run={run}/batch_id={batch_id}"

    def _schema(self, spec: StreamSpec) -> T.StructType:
        own = sink_schema(spec, self.keyed)
        return T.StructType([T.StructField(IDX, T.LongType()), *own]) if self.numbered else own

    def ensure(self, spark: SparkSession, spec: StreamSpec) -> None:
        empty = spark.createDataFrame([], self._schema(spec))
        empty.write.mode("ignore").parquet(self._batch(spec, -1, "none"))

    def write(self, rows: DataFrame, spec: StreamSpec, batch_id: int, run: str = "none") -> None:
        if self.numbered:
            self._write_numbered(rows, spec, batch_id, run)
        else:
            rows.write.mode("overwrite").parquet(self._batch(spec, batch_id, run))

    def _write_numbered(self, rows: DataFrame, spec: StreamSpec, batch_id: int, run: str) -> None:
        """The batch is written aside with the place each row has in its task; the tasks' sizes, one
        row each, give every task its first number, on top of the table's high-water mark. The mark
        is noted with the batch before the batch is, so the same batch gets the same numbers again."""
        spark = rows.sparkSession
        aside = f"{self.path(spec)}/_aside/{run}-{batch_id}"
        rows.withColumn(IDX, F.monotonically_increasing_id()).write.mode("overwrite").parquet(aside)
        placed = spark.read.schema(T.StructType([*rows.schema, T.StructField(IDX, T.LongType())])).parquet(aside)
        placed = placed.withColumn("_task", F.shiftright(IDX, _PLACE_BITS))
        sizes = placed.groupBy("_task").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
        sizes = sizes.withColumn("_before", F.coalesce(before, F.lit(0)))
        total = sizes.agg(F.sum("n")).first()[0] or 0
        first = self._first_number(spark, spec, batch_id, run, total)
        place = F.col(IDX).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
        numbered = placed.join(sizes.drop("n"), "_task").withColumn(IDX, place + F.col("_before") + F.lit(first).cast("long"))
        numbered.select(*self._schema(spec).names).write.mode("overwrite").parquet(self._batch(spec, batch_id, run))
        remove(spark, aside)

    def _first_number(self, spark: SparkSession, spec: StreamSpec, batch_id: int, run: str, total: int) -> int:
        """The first number of a batch of ``total`` rows. Marks are empty files that readers of the
        table skip, named by run, batch, first number and the one after the last; one per run stays."""
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path(spec)}/_marks")
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        marks = [(name, *name.rsplit("+", 3)) for name in names if name.count("+") == 3]
        for _, its_run, its_batch, first, _ in marks:
            if its_run == run and int(its_batch) == batch_id:
                return int(first)
        first = max((int(after) for *_, after in marks), default=1)
        files.create(jvm.org.apache.hadoop.fs.Path(folder, f"{run}+{batch_id}+{first}+{first + total}"), True).close()
        for name, its_run, *_ in marks:
            if its_run == run:
                files.delete(jvm.org.apache.hadoop.fs.Path(folder, name), False)
        return first

    def read(self, spark: SparkSession, spec: StreamSpec) -> DataFrame:
        return self.read_batches(spark, spec).select(*self._schema(spec).names)

    def read_batches(self, spark: SparkSession, spec: StreamSpec) -> DataFrame:
        """The table with the ``run`` and ``batch_id`` of each row."""
        return compaction.read_batches(spark, self.path(spec), self._batch_schema(spec))

    def _batch_schema(self, spec: StreamSpec) -> T.StructType:
        return T.StructType([*self._schema(spec), T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])

    def compact(self, spark: SparkSession, spec: StreamSpec, target: int = compaction.TARGET) -> bool:
        """Pack the files of settled batches into files of about ``target`` bytes, while flows write
        and readers read. Whether there was something to pack."""
        return compaction.compact(spark, self.path(spec), self._batch_schema(spec), target)

    def clean(self, spark: SparkSession, spec: StreamSpec, retention_hours: float = 24.0) -> int:
        """Remove files that were replaced by compaction longer ago than any reader runs."""
        now = int(time.time() * 1000)
        return compaction.clean(spark, self.path(spec), self._batch_schema(spec), now, int(retention_hours * 3_600_000))


@dataclass(frozen=True)
class CatalogTableSink:
    """Tables of a catalog database, with the declared column lengths.

    A table this sink creates is partitioned by query and micro-batch, and a repeated batch
    overwrites its own partition: exactly once. Into a table that was there before and has no
    such columns, rows are appended: with a ``ledger`` folder once, as it notes which offsets the
    table has taken in (see :mod:`eventweir.sinks.ledger`), without one a repeated batch is there
    twice (at least once). Columns are matched by name; a table with other columns is an error.
    ``keyed`` adds the row key ``topic, partition, offset``.
    """

    database: str = "default"
    provider: str = "parquet"
    keyed: bool = False
    ledger: str | None = None

    def name(self, spec: StreamSpec) -> str:
        return f"{self.database}.{spec.table}"

    def create_sql(self, spec: StreamSpec) -> str:
        keys = [f"{f.name} {f.dataType.simpleString()}" for f in (KEY_FIELDS if self.keyed else [])]
        columns = ", ".join([*keys, *[c.ddl("STRING") for c in spec.columns], *[f"{n} {t}" for n, t in BATCH_FIELDS.items()]])
        return (
            f"CREATE TABLE IF NOT EXISTS {self.name(spec)} ({columns}) USING {self.provider} "
            f"PARTITIONED BY ({', '.join(BATCH_FIELDS)})"
        )

    def ensure(self, spark: SparkSession, spec: StreamSpec) -> None:
        spark.sql(self.create_sql(spec))

    def write(self, rows: DataFrame, spec: StreamSpec, batch_id: int, run: str = "none") -> None:
        there = rows.sparkSession.table(self.name(spec)).columns
        own = [name for name in there if name not in BATCH_FIELDS]
        place = [] if self.ledger is None else [c for c in (*PLACE, PIECE) if c in rows.columns and c not in own]
        if sorted([*own, *place]) != sorted(rows.columns):
            raise ValueError(f"{self.name(spec)} has columns {own}, the rows {rows.columns}")
        if self.ledger is not None and not set(BATCH_FIELDS) <= set(there):
            OffsetLedger(self.ledger).insert_once(rows, self.name(spec), self.name(spec), there, run, batch_id)
        elif set(BATCH_FIELDS) <= set(there):
            names = ", ".join(f"`{name}`" for name in own)
            rows.sparkSession.sql(
                f"INSERT OVERWRITE TABLE {self.name(spec)} PARTITION (run = '{run}', batch_id = {int(batch_id)}) "
                f"SELECT {names} FROM {{rows}}",
                rows=rows,
            )
        else:
            rows.select(*there).write.insertInto(self.name(spec))

    def read(self, spark: SparkSession, spec: StreamSpec) -> DataFrame:
        return spark.table(self.name(spec)).select(*sink_schema(spec, self.keyed).names)
