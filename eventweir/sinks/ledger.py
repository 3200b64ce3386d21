"""A ledger of what a table has taken in: intervals of offsets by topic and partition.

For tables that were there before and have no columns to tell batches apart. A batch is first
written aside, with its rows' topic, partition and offset; its intervals are compared with the
ledger, and rows whose offset is in there are left out. After the insert the intervals are
committed. So a batch that is delivered again, by a retry, a restart or another checkpoint, adds
nothing.

A crash between insert and commit leaves the batch in doubt. The intent that was written before the
insert settles it: of the files that the table got since, grouped by the write job in their names,
a group with the batch's row count and digest is the batch, and only the commit is made up for.
Tables without files have nothing to look at, so there a batch in doubt is inserted again.

The ledger is a sequence of small Parquet entries with one writer, the flow. Every ``SNAPSHOT``-th
entry joins neighbouring intervals of all before, so reading it costs a bounded number of entries.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweir.plans.scratch import remove

PIECE = "piece"  # where offsets have no gaps that belong to others: a file of a log
PLACE = ("topic", "partition", "offset")
INTERVALS = "topic string, partition int, first bigint, last bigint"
SNAPSHOT = 32


def intervals_of(rows: DataFrame) -> DataFrame:
    """``topic, partition, first, last`` of rows with their place. Combined before the shuffle."""
    keys = ["topic", "partition", *([PIECE] if PIECE in rows.columns else [])]
    return rows.groupBy(*keys).agg(F.min("offset").alias("first"), F.max("offset").alias("last")).select("topic", "partition", "first", "last")


def joined(intervals: DataFrame) -> DataFrame:
    """Intervals that overlap or are neighbours as one. The window runs over the intervals of one
    partition of one topic, one row per batch at most."""
    key = Window.partitionBy("topic", "partition").orderBy("first", "last")
    reach = F.max("last").over(key.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.withColumn("reach", reach)
    apart = F.coalesce((F.col("first") > F.col("reach") + 1).cast("int"), F.lit(0))
    rows = rows.withColumn("island", F.sum(apart).over(key))
    return rows.groupBy("topic", "partition", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def _hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("h")


def _digest() -> list[Column]:
    """Row count and an order-free digest of the hashes ``h``."""
    return [F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("s")]


@dataclass(frozen=True)
class OffsetLedger:
    """The ledgers of a database's tables, below ``path`` in a folder that outlives the flows."""

    path: str

    def _files(self, spark: SparkSession, path: str):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, spark: SparkSession, path: str) -> bool:
        place, files = self._files(spark, path)
        return files.exists(place)

    def _entries(self, spark: SparkSession, table: str) -> list[int]:
        """Numbers of complete entries."""
        place, files = self._files(spark, f"{self.path}/{table}/entries")
        if not files.exists(place):
            return []
        numbers = [int(s.getPath().getName()) for s in files.listStatus(place) if s.getPath().getName().isdigit()]
        return sorted(n for n in numbers if self._exists(spark, f"{self.path}/{table}/entries/{n:012d}/_SUCCESS"))

    def _entry(self, table: str, number: int) -> str:
        return f"{self.path}/{table}/entries/{number:012d}"

    def committed(self, spark: SparkSession, table: str) -> DataFrame:
        """All intervals that the table has taken in."""
        entries = self._entries(spark, table)
        last = max((n for n in entries if n % SNAPSHOT == 0), default=0)
        paths = [self._entry(table, n) for n in entries if n >= last]
        return spark.read.schema(INTERVALS).parquet(*paths) if paths else spark.createDataFrame([], INTERVALS)

    def commit(self, spark: SparkSession, table: str, intervals: DataFrame) -> None:
        """One file per entry, so that an entry is there whole or not at all."""
        number = max(self._entries(spark, table), default=-1) + 1
        if number % SNAPSHOT == 0 and number:
            intervals = joined(self.committed(spark, table).unionByName(intervals))
        intervals.coalesce(1).write.mode("overwrite").parquet(self._entry(table, number))

    def unseen(self, rows: DataFrame, intervals: DataFrame, table: str) -> DataFrame:
        """``rows`` whose offset no committed interval holds. Only intervals that meet the batch's own
        ones take part, mostly none."""
        spark = rows.sparkSession
        own = intervals.select("topic", "partition", F.col("first").alias("a"), F.col("last").alias("b"))
        known = self.committed(spark, table).join(own, ["topic", "partition"])
        known = known.where("first <= b and a <= last").select("topic", "partition", "first", "last").distinct()
        if known.isEmpty():
            return rows
        known = joined(known).select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "first", "last")
        inside = (F.col("topic") == F.col("_t")) & (F.col("partition") == F.col("_p")) & F.col("offset").between(F.col("first"), F.col("last"))
        return rows.join(known, inside, "left_anti")

    def insert_once(self, rows: DataFrame, table: str, target: str, columns: list[str], run: str, batch_id: int) -> None:
        """Insert those of ``rows`` (``columns`` and their place) into ``target`` that it has not taken in."""
        spark = rows.sparkSession
        aside, intent = (f"{self.path}/{table}/{kind}/{run}-{batch_id}" for kind in ("aside", "intent"))
        rows.write.mode("overwrite").parquet(aside)
        rows = spark.read.schema(rows.schema).parquet(aside)
        intervals = intervals_of(rows)
        if not (self._exists(spark, f"{intent}/_SUCCESS") and self._landed(spark, intent, target, columns)):
            fresh = self.unseen(rows, intervals, table)
            spark.createDataFrame([(json.dumps(self._sum(fresh, columns)),)], "value string").coalesce(1).write.mode("overwrite").text(intent)
            fresh.select(*[f"`{c}`" for c in columns]).write.insertInto(target)
        self.commit(spark, table, intervals)
        remove(spark, intent)
        remove(spark, aside)

    def _sum(self, rows: DataFrame, columns: list[str]) -> list:
        return list(rows.select(_hash(columns)).agg(*_digest()).first())

    def _landed(self, spark: SparkSession, intent: str, target: str, columns: list[str]) -> bool:
        """Whether a write job since the intent has put just these rows there."""
        expected = json.loads(spark.read.text(intent).first()[0])
        if not expected[0]:
            return True
        place, files = self._files(spark, f"{intent}/_SUCCESS")
        since = files.getFileStatus(place).getModificationTime() // 1000
        try:
            rows = spark.table(target).where(F.expr(f"_metadata.file_modification_time >= timestamp_seconds({since})"))
            job = F.regexp_extract(F.col("_metadata.file_name"), "part-[0-9]+-([0-9a-f-]{36})", 1)
            found = rows.select(job.alias("job"), _hash(columns)).groupBy("job").agg(*_digest())
            return any(list(r)[1:] == expected for r in found.collect())
        except AnalysisException:  # no files to look at
            return False
