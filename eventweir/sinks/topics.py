"""Publishing encoded records: ``topic`` and ``value`` columns to Kafka or a topic log."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from eventweir.schemas import TOPIC_SCHEMA
from eventweir.sources.topics import next_offset, note_append

PLACE_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row of the partition here


def kafka_writer_options(bootstrap_servers: str, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, **options}


def publish_to_kafka(messages: DataFrame, bootstrap_servers: str, **options: str) -> None:
    """Append messages, with a null key, each to the topic its row names."""
    rows = messages.select("topic", "value")
    rows.write.format("kafka").options(**kafka_writer_options(bootstrap_servers, **options)).save()


def stream_to_kafka(messages: DataFrame, bootstrap_servers: str, checkpoint: str, **options: str) -> DataStreamWriter:
    rows = messages.select("topic", "value").writeStream.format("kafka")
    return rows.options(**kafka_writer_options(bootstrap_servers, **options)).option("checkpointLocation", checkpoint)


#: Different keys that an observed count tells apart exactly.
COUNTED_KEYS = 6000
_TRACKED = 1 << 14  # a sketch of this size is exact up to three quarters of half of it


def counts_by(*keys: Column) -> Column:
    """An aggregate for ``observe``: rows by key, whatever keys there are. Read it with
    :func:`read_counts`. It is a sketch of bounded size that is exact up to ``COUNTED_KEYS`` keys."""
    text = F.to_json(F.array(*[k.cast("string") for k in keys]))
    return F.call_function("approx_top_k", text, F.lit(COUNTED_KEYS + 1), F.lit(_TRACKED))


def read_counts(metric: list) -> dict[tuple, int]:
    """Rows by key. More keys than are counted exactly are an error."""
    found = {tuple(json.loads(r["item"])): r["count"] for r in metric or ()}
    if len(found) > COUNTED_KEYS:
        raise ValueError(f"more than {COUNTED_KEYS} different keys to count")
    return found


def publish_to_log(messages: DataFrame, path: str, first_offset: int | None = None) -> dict[tuple[str, int], int]:
    """Append messages to a topic log. Returns the messages by topic and partition, as the
    writing job itself counts them.

    Each writing task is one log partition and numbers its own rows, so nothing is shuffled;
    offsets are unique and increasing per topic and partition but, as in a compacted Kafka
    topic, not dense. They start at ``first_offset``, by default after the log's last one, which
    each append notes beside the log: they grow by the rows of the largest task. One publisher
    at a time may append to a log.
    """
    spark = messages.sparkSession
    if first_offset is None:
        first_offset = next_offset(spark, path)
    note_append(spark, path, None)
    observed = Observation()
    rows = messages.select(
        F.lit(None).cast("binary").alias("key"),
        "value",
        "topic",
        F.spark_partition_id().alias("partition"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_MASK)) + F.lit(first_offset).cast("long")).alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    rows = rows.observe(observed, F.max("offset").alias("last"), counts_by(F.col("topic"), F.col("partition")).alias("delivered"))
    rows.write.partitionBy("topic").mode("append").parquet(path)
    last = observed.get["last"]
    note_append(spark, path, first_offset if last is None else last + 1)
    return {(topic, int(partition)): n for (topic, partition), n in read_counts(observed.get["delivered"]).items()}


def stream_to_log(messages: DataFrame, path: str, checkpoint: str, report: Callable[[int, dict], None] | None = None) -> DataStreamWriter:
    """Append each micro-batch to a topic log. A repeated batch is published again. ``report`` is
    given each batch's id and what it delivered, by topic and partition."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        delivered = publish_to_log(batch, path)
        if report is not None:
            report(batch_id, delivered)

    writer = messages.select("topic", "value").writeStream.foreachBatch(publish)
    return writer.option("checkpointLocation", checkpoint)


def delivery_report(spark: SparkSession, path: str, first_offset: int = 0) -> DataFrame:
    """``topic, partition, n_messages, first, last``: what stands in a topic log from an offset on,
    such as that of an append. Reads three narrow columns; counts are combined before the shuffle."""
    rows = spark.read.schema(TOPIC_SCHEMA).parquet(path).where(F.col("offset") >= first_offset)
    return rows.groupBy("topic", "partition").agg(F.count("*").alias("n_messages"), F.min("offset").alias("first"), F.max("offset").alias("last"))


def observe_delivery(messages: DataFrame, name: str = "delivery") -> tuple[DataFrame, Observation]:
    """The messages, and an observation that counts them by topic as they are written; see
    :func:`delivered`."""
    observation = Observation(name)
    return messages.observe(observation, counts_by(F.col("topic")).alias("delivered")), observation


def delivered(observation: Observation) -> dict[str, int]:
    """Messages by topic, once they are written."""
    return {topic: n for (topic,), n in read_counts(observation.get["delivered"]).items()}


def observe_delivery_stream(messages: DataFrame, name: str = "delivery") -> DataFrame:
    return messages.observe(name, counts_by(F.col("topic")).alias("delivered"))


class DeliveryListener(StreamingQueryListener):
    """Adds up the per-topic counts of streams with ``observe_delivery_stream``."""

    def __init__(self, name: str = "delivery") -> None:
        self.name = name
        self.delivered: dict[str, int] = {}
        self.failures: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(self.name)
        for (topic,), n in read_counts(counts["delivered"]).items() if counts is not None else ():
            self.delivered[topic] = self.delivered.get(topic, 0) + n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            self.failures.append(event.exception)
