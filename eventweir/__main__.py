"""Command line: ``python -m eventweir etl …``, ``… publish …`` and ``… compact …``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from eventweir.functions.avro import CODECS
from eventweir.plans.publish import index_event_files, to_messages
from eventweir.plans.replay import replay_first
from eventweir.plans.scratch import scratch_dir
from eventweir.schemas import STREAMS
from eventweir.sinks.jdbc import JdbcSink
from eventweir.sinks.tables import CatalogTableSink, FileTableSink
from eventweir.sinks.topics import delivered, delivery_report, observe_delivery, publish_to_kafka, publish_to_log
from eventweir.sources.topics import STARTS, KafkaTopics, TopicLog, next_offset
from eventweir.streaming.flows import AVAILABLE_NOW, await_all, start_all


def setting(text: str) -> tuple[str, str]:
    name, equals, value = text.partition("=")
    if not (name and equals):
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=VALUE")
    return name, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="eventweir", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, description: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=description)
        topics = command.add_mutually_exclusive_group(required=True)
        topics.add_argument("--bootstrap", help="Kafka bootstrap servers")
        topics.add_argument("--log", help="topic log directory")
        command.add_argument("--codec", choices=CODECS, default="arrow", help="jvm needs the spark-avro module")
        return command

    etl = add("etl", "run the three flows from topics to tables")
    etl.add_argument("--starting-offsets", choices=STARTS, default="latest")
    etl.add_argument(
        "--source-option", type=setting, action="append", default=[], metavar="NAME=VALUE",
        help="option of the topic source, e.g. maxOffsetsPerTrigger=100000 or maxFilesPerTrigger=100",
    )
    etl.add_argument("--checkpoints", required=True, help="checkpoint directory, on shared storage")
    tables = etl.add_mutually_exclusive_group(required=True)
    tables.add_argument("--jdbc", action="store_true", help="tables of the database in spark.eventweir.jdbc.*")
    tables.add_argument("--tables", help="directory of Parquet tables")
    tables.add_argument("--database", help="catalog database")
    etl.add_argument("--ledger", help="with --database: folder that notes which offsets a foreign table has taken in")
    etl.add_argument("--quarantine", help="folder for bad payloads; without it they fail their flow")
    etl.add_argument("--interval", default="200 milliseconds", help="time between micro-batches")
    etl.add_argument("--print", action="store_true", help="also print every record, on the executors")
    etl.add_argument("--once", action="store_true", help="stop when everything available is done")

    compact = commands.add_parser("compact", help="pack the small files of Parquet tables, also while flows write them")
    compact.add_argument("--tables", required=True, help="directory of Parquet tables")
    compact.add_argument("--target-mb", type=int, default=256, help="size of the packed files")
    compact.add_argument("--retention-hours", type=float, default=24.0, help="remove files that were replaced before that")

    publish = add("publish", "publish CSV files, one record per topic in turn, again and again")
    for kind in STREAMS:
        publish.add_argument(f"--{kind}", required=True, help=f"CSV file of {kind} events")
        publish.add_argument(f"--{kind}-schema-id", type=int, required=True)
    publish.add_argument("--records", type=int, required=True, help="publish so many messages in all")
    return top


def run_etl(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.bootstrap:
        source = KafkaTopics(args.bootstrap, args.starting_offsets, dict(args.source_option))
    else:
        source = TopicLog(args.log, args.starting_offsets, dict(args.source_option))
    if args.jdbc:
        sink = JdbcSink.from_conf(spark)
    else:
        sink = FileTableSink(args.tables) if args.tables else CatalogTableSink(args.database, ledger=args.ledger)
    trigger = AVAILABLE_NOW if args.once else {"processingTime": args.interval}
    await_all(start_all(spark, source, sink, args.checkpoints, trigger=trigger, echo=args.print, codec=args.codec, quarantine=args.quarantine))


def run_compact(spark: SparkSession, args: argparse.Namespace) -> None:
    sink = FileTableSink(args.tables)
    for spec in STREAMS.values():
        sink.ensure(spark, spec)
        packed = sink.compact(spark, spec, args.target_mb << 20)
        print(f"{spec.table}: {'packed' if packed else 'nothing to pack'}, {sink.clean(spark, spec, args.retention_hours)} directories removed")


def run_publish(spark: SparkSession, args: argparse.Namespace) -> None:
    options = vars(args)
    tables = index_event_files(spark, {kind: options[kind] for kind in STREAMS}, scratch_dir(spark, "publish"))
    ids = {kind: options[f"{kind}_schema_id"] for kind in STREAMS}
    messages, observation = observe_delivery(to_messages(replay_first(spark, tables, args.records), ids, args.codec))
    first = None if args.bootstrap else next_offset(spark, args.log)
    publish_to_kafka(messages, args.bootstrap) if args.bootstrap else publish_to_log(messages, args.log, first)
    counts = delivered(observation)
    for spec in STREAMS.values():
        print(f"{spec.topic}: {counts.get(spec.topic, 0)} messages delivered")
    if first is not None:
        for row in delivery_report(spark, args.log, first).orderBy("topic", "partition").toLocalIterator():
            print(f"{row.topic} [{row.partition}]: {row.n_messages} messages, offsets {row.first} to {row.last}")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"eventweir-{args.command}").getOrCreate()
    {"etl": run_etl, "publish": run_publish, "compact": run_compact}[args.command](spark, args)


if __name__ == "__main__":
    main()
