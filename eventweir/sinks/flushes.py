"""Writing in flushes: the unit of commit and of retry is a flush, not a task or a micro-batch.

A Python data source: every task cuts its rows into flushes of 1,000 rows, or of what came in
200 ms, and hands each to a connection together with the flush's id. The connection stores rows
and id in one transaction. When a flush fails in passing, only that flush is tried again, after
asking on a new connection whether its id is there: a commit whose answer got lost is not repeated.
A task that Spark runs again, or a micro-batch after a restart, goes through the same flushes under
the same ids, so each is stored once, whatever was stored before.

This needs what the flows here have: a task's rows come in the same order each time.
"""

from __future__ import annotations

import base64
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from eventweir.schemas import StreamSpec
from eventweir.sinks.retry import with_retries

FORMAT = "eventweir_flushes"
# The flush size, interval and retries.
FLUSH_ROWS = 1000
FLUSH_SECONDS = 0.2
RETRIES = 5
BATCH_ID = "streaming.sql.batchId"  # local property of a micro-batch's jobs


class Connection(Protocol):
    """Where flushes go. Opened in a task, used by that task alone."""

    def has(self, flush_id: str) -> bool:
        """Whether the flush is stored."""

    def store(self, flush_id: str, rows: list[tuple]) -> None:
        """Store the rows and the id, both or neither."""

    def close(self) -> None: ...


@dataclass
class Flushed(WriterCommitMessage):
    """What a task did: its flushes, those it found stored, rows stored, and repeated attempts."""

    partition: int
    flushes: int
    found: int
    rows: int
    retries: int


class DbApiConnection:
    """A PEP 249 connection. ``receipts`` is a table whose key is ``flush_id``; it shares the rows'
    transaction, so a second store of one flush violates the key and stores nothing."""

    def __init__(self, connection: Any, table: str, columns: Sequence[str], receipts: str = "flush_receipts", mark: str = "%s") -> None:
        self.connection, self.receipts, self.mark = connection, receipts, mark
        self.insert = f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({', '.join([mark] * len(columns))})"

    def has(self, flush_id: str) -> bool:
        cursor = self.connection.cursor()
        cursor.execute(f"SELECT 1 FROM {self.receipts} WHERE flush_id = {self.mark}", (flush_id,))
        return cursor.fetchone() is not None

    def store(self, flush_id: str, rows: list[tuple]) -> None:
        cursor = self.connection.cursor()
        try:
            cursor.execute(f"INSERT INTO {self.receipts} (flush_id) VALUES ({self.mark})", (flush_id,))
            cursor.executemany(self.insert, rows)
            self.connection.commit()
        except Exception:
            self.connection.rollback()
            raise

    def close(self) -> None:
        self.connection.close()


def flushes(rows: Iterable[Row], size: int = FLUSH_ROWS, seconds: float = FLUSH_SECONDS, clock: Callable[[], float] = time.monotonic) -> Iterator[list[tuple]]:
    """Rows in flushes. The time is looked at when a row arrives."""
    held: list[tuple] = []
    since = 0.0
    for row in rows:
        if held and (len(held) == size or clock() - since >= seconds):
            yield held
            held = []
        if not held:
            since = clock()
        held.append(tuple(row))
    if held:
        yield held


class FlushWriter:
    """Runs in a task."""

    def __init__(self, open_: Callable[[], Connection], run: str, size: int, seconds: float, retries: int, pause: float) -> None:
        self.open, self.run, self.size, self.seconds, self.retries, self.pause = open_, run, size, seconds, retries, pause

    def write_as(self, batch: str, partition: int, rows: Iterable[Row]) -> Flushed:
        # With flushes cut by time alone, a second run of the task would cut them elsewhere.
        seconds = self.seconds if self.seconds > 0 else float("inf")
        done = Flushed(partition, 0, 0, 0, 0)
        held: list[Connection] = []

        def close() -> None:
            while held:
                try:
                    held.pop().close()
                except Exception:  # the connection may be what broke
                    pass

        try:
            for number, flush in enumerate(flushes(rows, self.size, seconds)):
                flush_id = f"{self.run}/{batch}/{partition}/{number}"
                attempts = 0

                def store(flush: list[tuple] = flush, flush_id: str = flush_id) -> None:
                    nonlocal attempts
                    attempts += 1
                    if attempts > 1:
                        close()
                    if not held:
                        held.append(self.open())
                    if held[0].has(flush_id):
                        done.found += 1
                        return
                    held[0].store(flush_id, flush)
                    done.rows += len(flush)

                with_retries(store, self.retries, self.pause)
                done.flushes += 1
                done.retries += attempts - 1
        finally:
            close()
        return done


class _BatchWriter(FlushWriter, DataSourceWriter):
    batch = "0"

    def write(self, iterator: Iterator[Row]) -> Flushed:
        return self.write_as(self.batch, TaskContext.get().partitionId(), iterator)

    def commit(self, messages: list[Flushed | None]) -> None:
        """Every flush is stored; there is nothing left to publish."""

    def abort(self, messages: list[Flushed | None]) -> None:
        """Stored flushes stay and are found when the write is run again."""


class _StreamWriter(FlushWriter, DataSourceStreamWriter):
    def write(self, iterator: Iterator[Row]) -> Flushed:
        context = TaskContext.get()
        return self.write_as(context.getLocalProperty(BATCH_ID) or "0", context.partitionId(), iterator)

    def commit(self, messages: list[Flushed | None], batchId: int) -> None:
        """As for a batch."""

    def abort(self, messages: list[Flushed | None], batchId: int) -> None:
        """As for a batch: Spark runs the micro-batch again under its id."""


class FlushSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _settings(self) -> dict:
        options = {k.lower(): v for k, v in self.options.items()}
        return {
            "open_": cloudpickle.loads(base64.b64decode(options["connect"])),
            "run": options["run"],
            "size": int(options["rows"]),
            "seconds": float(options["seconds"]),
            "retries": int(options["retries"]),
            "pause": float(options["pause"]),
        }

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        writer = _BatchWriter(**self._settings())
        writer.batch = {k.lower(): v for k, v in self.options.items()}["batch"]
        return writer

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return _StreamWriter(**self._settings())


@dataclass(frozen=True)
class FlushSink:
    """A sink of flows that writes in flushes. ``connect`` opens a connection to the table of a
    stream, in a task; ``create`` makes that table, once, on the driver.

    ``seconds`` cuts a flush by time; the default, 0, cuts by rows only. A flush that is cut by time
    may be cut elsewhere when its task runs again, so only flushes cut by rows are stored once
    after a *task* is lost; the retry of a flush is exact either way.
    """

    connect: Callable[[StreamSpec], Connection]
    create: Callable[[StreamSpec], None] | None = None
    rows: int = FLUSH_ROWS
    seconds: float = 0.0
    retries: int = RETRIES
    pause: float = 1.0
    keyed = False

    def _options(self, spec: StreamSpec, run: str) -> dict[str, str]:
        connect = self.connect
        packed = base64.b64encode(cloudpickle.dumps(lambda: connect(spec))).decode()
        return {"connect": packed, "run": f"{run}/{spec.table}", "rows": str(self.rows), "seconds": str(self.seconds), "retries": str(self.retries), "pause": str(self.pause)}

    def ensure(self, spark: SparkSession, spec: StreamSpec) -> None:
        spark.dataSource.register(FlushSource)
        if self.create is not None:
            with_retries(lambda: self.create(spec), self.retries, self.pause)

    def write(self, rows: DataFrame, spec: StreamSpec, batch_id: int, run: str = "none") -> None:
        options = {**self._options(spec, run), "batch": str(batch_id)}
        rows.write.format(FORMAT).options(**options).mode("append").save()

    def stream(self, rows: DataFrame, spec: StreamSpec, checkpoint: str, run: str) -> DataStreamWriter:
        """The same without ``foreachBatch``; ``run`` names the flow and must outlive restarts."""
        rows.sparkSession.dataSource.register(FlushSource)
        writer = rows.writeStream.format(FORMAT).outputMode("append")
        return writer.options(**self._options(spec, run)).option("checkpointLocation", checkpoint)
