"""Streaming flows: topic → decode → filter → table, one query per event kind.

A flow is stateless and narrow: no watermark, no exchange. Delivery is at least
once with JDBC, and exactly once with file tables and with catalog tables that the sink
created; order is kept only inside a topic partition.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eventweir.functions.avro_batches import FAULT
from eventweir.operators.records import checked_sql, decode_records, keep_keyed, project_sink
from eventweir.plans.scratch import remove
from eventweir.schemas import STREAMS, StreamSpec
from eventweir.sinks.fan_out import Outlet, write_tagged
from eventweir.sinks.ledger import PIECE
from eventweir.sinks.printing import print_records

# Fixed value: the flush interval.
FLUSH_INTERVAL = {"processingTime": "200 milliseconds"}
AVAILABLE_NOW = {"availableNow": True}
POOL = "spark.scheduler.pool"
ROW_KEY = ("topic", "partition", "offset")


def records_of(
    messages: DataFrame, spec: StreamSpec, keep: Sequence[str] = (), codec: str = "arrow", wanted: Sequence[str] | None = None
) -> DataFrame:
    """Decoded records with a key field. Works on batch and streaming messages."""
    return keep_keyed(decode_records(messages, spec, tuple(keep), codec, wanted), spec)


def sink_rows(messages: DataFrame, spec: StreamSpec, keep: Sequence[str] = (), codec: str = "arrow") -> DataFrame:
    """Messages to rows of the sink table. Decodes only the fields the table has; the key
    field is one of them."""
    return project_sink(records_of(messages, spec, keep, codec, [c.wire for c in spec.columns]), spec, tuple(keep))


def counted(rows: DataFrame, operator: str, where: Column | None = None) -> DataFrame:
    """``rows`` through a named node that counts them, or those of a condition."""
    return rows.observe(operator, (F.count(F.lit(1)) if where is None else F.count_if(where)).alias("rows"))


class OperatorCounts(StreamingQueryListener):
    """Adds up the rows that the named operators of flows report: ``spark.streams.addListener`` it
    before the flows start. ``counts`` has the rows by operator name."""

    def __init__(self) -> None:
        self.counts: dict[str, int] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._news:
            for operator, row in event.progress.observedMetrics.items():
                if "rows" in row.asDict():
                    self.counts[operator] = self.counts.get(operator, 0) + row["rows"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def of(self, queries: Iterable[StreamingQuery], seconds: float = 60.0) -> dict[str, int]:
        """The counts once all that these ended queries reported has arrived."""
        runs = {str(q.runId) for q in queries}
        with self._news:
            if not self._news.wait_for(lambda: runs <= self._ended, seconds):
                raise TimeoutError("the listener has not heard of the end of all queries")
            return dict(self.counts)


QUARANTINE = "topic string, partition int, offset bigint, value binary, fault string, run string, batch_id bigint"


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Bad payloads that flows put aside: ``topic, partition, offset, value, fault`` and their batch."""
    return spark.read.schema(QUARANTINE).parquet(path)


def query_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint at its first start; it outlives restarts."""
    text = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return json.loads(text)["id"]


def start_flow(
    spark: SparkSession,
    spec: StreamSpec,
    source,
    sink,
    checkpoint: str,
    trigger: dict | None = None,
    echo: bool | Callable[[DataFrame, StreamSpec], None] = False,
    codec: str = "arrow",
    name: str | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start one flow. The table exists when this returns; ``echo`` also prints each record, or
    hands every batch of records to the function it is. ``quarantine`` is a folder to which bad
    payloads go, with what is wrong with them, instead of failing the flow: one Parquet directory
    per query and batch, so that a repeated batch adds nothing (read it with :func:`read_quarantine`).

    Names of running queries are unique in a session: a second flow of a topic needs its own.
    The name is also the flow's scheduler pool: with ``spark.scheduler.mode=FAIR`` a large batch
    of one flow does not hold up the others. The flow's operators are named too and count their
    rows: ``<name>/source``, ``/filter`` and ``/sink`` (see :class:`OperatorCounts`).
    """
    sink.ensure(spark, spec)
    source.prepare(spark, spec, checkpoint)
    name = name or spec.query_name
    ledgered = getattr(sink, "ledger", None) is not None
    keep = (*ROW_KEY, PIECE) if ledgered else ROW_KEY if sink.keyed else ()
    messages = source.stream(spark, spec, pieces=True) if ledgered else source.stream(spark, spec)
    beside = tuple(dict.fromkeys((*keep, *ROW_KEY, "value"))) if quarantine is not None else keep
    messages = counted(messages.select(*dict.fromkeys((*beside, "value"))), f"{name}/source")
    run = lru_cache(maxsize=1)(lambda: query_identity(spark, checkpoint))
    if not echo and quarantine is None:
        rows = counted(records_of(messages, spec, keep, codec, wanted=[c.wire for c in spec.columns]), f"{name}/filter")
        stream = counted(project_sink(rows, spec, keep), f"{name}/sink")

        def write(batch: DataFrame, batch_id: int) -> None:
            sink.write(batch, spec, batch_id, run())
    else:
        # Several sinks take the batch: it is evaluated once, for all of them.
        decoded = decode_records(messages, spec, beside, codec, None if echo else [c.wire for c in spec.columns], quarantine is not None)
        good = F.col(f"`{spec.key}`") != ""
        stream = counted(decoded, f"{name}/filter", good)
        fields = [f.name for f in spec.wire.fields if f.name in decoded.columns]
        outlets = [Outlet("table", [*map(F.col, keep), *[F.expr(f"{checked_sql(c)} as `{c.name}`") for c in spec.columns]], good)]
        if echo:
            outlets.append(Outlet("records", [F.col(f"`{c}`") for c in (*keep, *fields)], good))
        if quarantine is not None:
            outlets.append(Outlet("quarantine", [*map(F.col, beside), F.col(f"`{FAULT}`").alias("fault")], F.col(f"`{FAULT}`").isNotNull()))

        def write(batch: DataFrame, batch_id: int) -> None:
            aside = f"{checkpoint}/fan-out/batch_id={batch_id}"
            taken = write_tagged(batch, outlets, aside)
            if quarantine is not None:
                bad = taken["quarantine"].select(*ROW_KEY, "value", "fault")
                bad.write.mode("overwrite").parquet(f"{quarantine}/run={run()}/batch_id={batch_id}")
            if echo:
                (print_records if echo is True else echo)(taken["records"], spec)
            sink.write(taken["table"], spec, batch_id, run())
            remove(spark, aside)

    writer = stream.writeStream.queryName(name).outputMode("append").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or FLUSH_INTERVAL))
    before = spark.sparkContext.getLocalProperty(POOL)
    spark.sparkContext.setLocalProperty(POOL, name)  # the query's thread takes it over
    try:
        return writer.start()
    finally:
        spark.sparkContext.setLocalProperty(POOL, before)


def start_all(
    spark: SparkSession,
    source,
    sink,
    checkpoints: str,
    specs: Iterable[StreamSpec] = tuple(STREAMS.values()),
    **options,
) -> list[StreamingQuery]:
    """Start a flow per event kind, each with its own checkpoint below ``checkpoints``."""
    queries: list[StreamingQuery] = []
    try:
        for spec in specs:
            queries.append(start_flow(spark, spec, source, sink, f"{checkpoints}/{spec.topic}", **options))
    except Exception:
        stop_all(queries)
        raise
    return queries


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait for all flows to end. When one fails, stop the others and raise its error."""
    running = list(queries)
    try:
        while running:
            # Raises the error of a failed query.
            running = [query for query in running if not query.awaitTermination(timeout=0.2)]
    finally:
        stop_all(running)


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()
