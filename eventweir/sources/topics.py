"""Topic sources: Kafka, and a topic log with the same columns in Parquet files.

A source has ``batch``, ``stream`` and ``prepare``; everything downstream of it is
the same for both. ``prepare`` makes a first start at ``latest`` skip what the topic
already holds; a restart goes on from the checkpoint.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.schemas import TOPIC_SCHEMA, StreamSpec

STARTS = ("latest", "earliest")
# By default Spark skips files that are a week older than the newest one. The source then keeps
# the name of every file it has seen.
NO_FILE_TOO_OLD = "36500d"


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a Kafka cluster. Needs the Kafka connector on the class path.

    ``options`` are passed on as they are, e.g. ``maxOffsetsPerTrigger``, ``minPartitions``
    or ``kafka.security.protocol``.
    """

    bootstrap_servers: str
    starting_offsets: str = "latest"
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self, spec: StreamSpec) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": spec.topic,
            "startingOffsets": self.starting_offsets,
            # Spark adds a unique suffix, so two queries never share a consumer group.
            "groupIdPrefix": spec.group,
            **self.options,
        }

    def stream(self, spark: SparkSession, spec: StreamSpec, pieces: bool = False) -> DataFrame:
        """With ``pieces`` also a column that parts what a batch has of a topic's partition into
        stretches without foreign offsets; a batch takes one stretch of a Kafka partition."""
        messages = spark.readStream.format("kafka").options(**self.reader_options(spec)).load()
        return messages.withColumn("piece", F.lit("")) if pieces else messages

    def batch(self, spark: SparkSession, spec: StreamSpec) -> DataFrame:
        options = {**self.reader_options(spec), "startingOffsets": "earliest", **self.options}
        return spark.read.format("kafka").options(**options).load()

    def prepare(self, spark: SparkSession, spec: StreamSpec, checkpoint: str) -> None:
        """Kafka resolves ``latest`` itself, on the first start only."""


@dataclass(frozen=True)
class TopicLog:
    """Topics kept as Parquet files, one directory per topic, one or more files per append."""

    path: str
    starting_offsets: str = "latest"
    options: dict[str, str] = field(default_factory=dict)  # e.g. maxFilesPerTrigger

    def __post_init__(self) -> None:
        if self.starting_offsets not in STARTS:
            raise ValueError(f"starting_offsets must be one of {STARTS}")

    def topic_path(self, topic: str) -> str:
        return f"{self.path}/topic={topic}"

    def stream(self, spark: SparkSession, spec: StreamSpec, pieces: bool = False) -> DataFrame:
        """With ``pieces`` also the file of each message: a file that gets visible late may have
        offsets between those of files in one batch, but none between those of one file."""
        # One directory, so that the source never lists the files of other topics.
        files = spark.readStream.schema(_FILE_SCHEMA).options(**{"maxFileAge": NO_FILE_TOO_OLD, **self.options})
        files = files.parquet(self.topic_path(spec.topic))
        rows = files.withColumn("topic", F.lit(spec.topic))
        return rows.select(*TOPIC_SCHEMA.names, *([F.col("_metadata.file_path").alias("piece")] if pieces else []))

    def batch(self, spark: SparkSession, spec: StreamSpec) -> DataFrame:
        return _with_topic(spark.read.schema(_FILE_SCHEMA).parquet(self.topic_path(spec.topic)), spec)

    def prepare(self, spark: SparkSession, spec: StreamSpec, checkpoint: str) -> None:
        """Create the topic if it is new. For ``latest``, let a query that keeps nothing take
        in the files that are there: the checkpoint then holds them as done. Catalyst drops
        the scan under ``where(false)``, so this lists files and reads none. The flow's own
        batches then start at 1; ``foreachBatch`` sinks do not mind."""
        path = self.topic_path(spec.topic)
        first_start = self.starting_offsets == "latest" and not _has_commits(spark, checkpoint)
        if first_start or not _exists(spark, path):
            # Also makes sure that there is something to take in, and so a commit.
            spark.createDataFrame([], _FILE_SCHEMA).write.mode("append").parquet(path)
        if not first_start:
            return
        nothing = TopicLog(self.path, "earliest").stream(spark, spec).where(F.lit(False))
        query = (
            nothing.writeStream.format("noop").trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start()
        )
        query.awaitTermination()


# The topic is the name of the directory.
_FILE_SCHEMA = T.StructType([f for f in TOPIC_SCHEMA if f.name != "topic"])


def _with_topic(files: DataFrame, spec: StreamSpec) -> DataFrame:
    return files.withColumn("topic", F.lit(spec.topic)).select(*TOPIC_SCHEMA.names)


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def _has_commits(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a batch has ever been done. Spark makes the directory before the first one and
    removes old commits, so only its being empty tells."""
    place, files = _place(spark, f"{checkpoint}/commits")
    return files.exists(place) and any(not s.getPath().getName().startswith(".") for s in files.listStatus(place))


def note_append(spark: SparkSession, path: str, following: int | None) -> None:
    """Note the offset that follows an append; ``None`` before it, so that an append that was
    cut short is not mistaken for none. Notes are empty files that readers of the log skip."""
    place, files = _place(spark, f"{path}/_next")
    old = [s.getPath() for s in files.listStatus(place)] if files.exists(place) else []
    name = "unknown" if following is None else str(following)
    files.mkdirs(place)
    files.create(_place(spark, f"{path}/_next/{name}")[0], True).close()
    for note in old:
        if note.getName() != name:
            files.delete(note, False)


def next_offset(spark: SparkSession, path: str) -> int:
    """One past the largest offset of a topic log: from the note of the last append or, where
    that is missing or the append was cut short, from the offset column."""
    if not _exists(spark, path):
        return 0
    place, files = _place(spark, f"{path}/_next")
    notes = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    notes = [name for name in notes if not name.startswith(".")]
    if len(notes) == 1 and notes[0].isdigit():
        return int(notes[0])
    if not any(s.isDirectory() and s.getPath().getName().startswith("topic=") for s in files.listStatus(_place(spark, path)[0])):
        return 0
    last = spark.read.schema(_FILE_SCHEMA).parquet(path).agg(F.max("offset")).first()[0]
    return 0 if last is None else last + 1
