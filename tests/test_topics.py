import time

import pytest
from pyspark.sql import functions as F
from samples import BUY_1, CLICK_1

from eventweir.operators.records import decode_records, encode_records
from eventweir.schemas import BUY, CLICK, STREAMS, TOPIC_SCHEMA
from eventweir.sinks import topics
from eventweir.sinks.topics import (
    DeliveryListener,
    delivered,
    delivery_report,
    kafka_writer_options,
    observe_delivery,
    observe_delivery_stream,
    publish_to_log,
    stream_to_log,
)
from eventweir.sources.topics import KafkaTopics, TopicLog, next_offset, note_append


def messages(spark, spec, records):
    return encode_records(spark.createDataFrame(records, spec.wire.struct), spec, 7)


def buys(spark, *prices):
    return messages(spark, BUY, [{**BUY_1, "price": p} for p in prices])


def test_kafka_reader_options():
    options = KafkaTopics("b1:9092", options={"maxOffsetsPerTrigger": "1000"}).reader_options(BUY)
    assert options == {
        "kafka.bootstrap.servers": "b1:9092",
        "subscribe": "buy_events",
        "startingOffsets": "latest",
        "groupIdPrefix": "Buy-group",
        "maxOffsetsPerTrigger": "1000",
    }
    subscribed = {k: KafkaTopics("b").reader_options(s)["subscribe"] for k, s in STREAMS.items()}
    assert subscribed == {"click": "click_events", "buy": "buy_events", "topup": "topup_events"}


def test_kafka_writer_options():
    assert kafka_writer_options("b", acks="all") == {"kafka.bootstrap.servers": "b", "acks": "all"}


def test_log_has_the_kafka_columns(spark, tmp_path):
    log = TopicLog(str(tmp_path / "log"), "earliest")
    publish_to_log(buys(spark, 1, 2, 3), log.path)
    rows = log.batch(spark, BUY)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in TOPIC_SCHEMA]
    assert rows.where("key is not null or topic <> 'buy_events' or timestamp is null").isEmpty()
    assert sorted(r.price for r in decode_records(rows, BUY).collect()) == [1, 2, 3]


def test_offsets_go_on_after_the_last_one(spark, tmp_path):
    path = str(tmp_path / "log")
    assert next_offset(spark, path) == 0
    seen = 0
    for _ in range(3):
        publish_to_log(buys(spark, *range(50)).repartition(3), path)
        keys = TopicLog(path).batch(spark, BUY).groupBy("partition", "offset").count()
        assert keys.count() == seen + 50 and keys.where("count > 1").isEmpty()
        seen += 50


def test_offsets_grow_by_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    for appended in range(1, 4):
        publish_to_log(buys(spark, *range(80)).repartition(8), path)
        assert next_offset(spark, path) <= 80 * appended


def test_an_append_that_was_cut_short_is_looked_up(spark, tmp_path):
    path = str(tmp_path / "log")
    publish_to_log(buys(spark, *range(9)).coalesce(1), path)
    note_append(spark, path, None)
    assert next_offset(spark, path) == 9


def test_topics_are_apart(spark, tmp_path):
    log = TopicLog(str(tmp_path / "log"))
    publish_to_log(buys(spark, 1, 2).unionByName(messages(spark, CLICK, [CLICK_1])), log.path)
    assert log.batch(spark, BUY).count() == 2
    assert decode_records(log.batch(spark, CLICK), CLICK).first().asDict() == CLICK_1


def collect_stream(spark, log, checkpoint, seen):
    log.prepare(spark, BUY, checkpoint)
    query = (
        decode_records(log.stream(spark, BUY), BUY)
        .writeStream.foreachBatch(lambda batch, _: seen.extend(r.price for r in batch.collect()))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sorted(seen)


def test_earliest_reads_all(spark, tmp_path):
    log = TopicLog(str(tmp_path / "log"), "earliest")
    publish_to_log(buys(spark, 1, 2), log.path)
    assert collect_stream(spark, log, str(tmp_path / "cp"), []) == [1, 2]


def test_latest_skips_what_is_there_at_the_first_start_only(spark, tmp_path):
    log = TopicLog(str(tmp_path / "log"))
    place = str(tmp_path / "cp"), []
    publish_to_log(buys(spark, 1, 2), log.path)
    assert collect_stream(spark, log, *place) == []
    publish_to_log(buys(spark, 3), log.path)
    assert collect_stream(spark, log, *place) == [3]
    publish_to_log(buys(spark, 4), log.path)  # while the stream is down
    assert collect_stream(spark, log, *place) == [3, 4]
    assert collect_stream(spark, log, *place) == [3, 4]


def test_latest_on_a_topic_that_does_not_exist_yet(spark, tmp_path):
    log = TopicLog(str(tmp_path / "log"))
    place = str(tmp_path / "cp"), []
    assert collect_stream(spark, log, *place) == []
    publish_to_log(buys(spark, 5), log.path)
    assert collect_stream(spark, log, *place) == [5]


def test_latest_when_the_first_start_was_cut_short(spark, tmp_path):
    log = TopicLog(str(tmp_path / "log"))
    publish_to_log(buys(spark, 1), log.path)
    (tmp_path / "cp" / "commits").mkdir(parents=True)
    place = str(tmp_path / "cp"), []
    assert collect_stream(spark, log, *place) == []
    publish_to_log(buys(spark, 2), log.path)
    assert collect_stream(spark, log, *place) == [2]


def test_latest_after_the_first_commits_are_gone(spark, tmp_path):
    log = TopicLog(str(tmp_path / "log"))
    place = str(tmp_path / "cp"), []
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "1")
    try:
        for price in range(4):
            collect_stream(spark, log, *place)
            publish_to_log(buys(spark, price), log.path)
        assert not (tmp_path / "cp" / "commits" / "0").exists()
        assert collect_stream(spark, log, *place) == [0, 1, 2, 3]
    finally:
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")


def test_unknown_start():
    with pytest.raises(ValueError):
        TopicLog("x", "yesterday")


def test_delivery_counts(spark, tmp_path):
    both = buys(spark, 1, 2).unionByName(messages(spark, CLICK, [CLICK_1]))
    observed, observation = observe_delivery(both)
    told = publish_to_log(observed.coalesce(1), str(tmp_path / "log"))
    assert delivered(observation) == {"click_events": 1, "buy_events": 2}
    assert told == {("click_events", 0): 1, ("buy_events", 0): 2}


def test_any_topics_are_counted(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 3000, 1, 3).select(F.concat(F.lit("to:pic "), (F.col("id") % 500).cast("string")).alias("topic"), F.lit(b"x").alias("value"))
    told = publish_to_log(rows, str(tmp_path / "log"))
    assert len(told) == 1500 and set(told.values()) == {2} and ("to:pic 499", 2) in told
    many = spark.range(0, topics.COUNTED_KEYS + 1).select(F.col("id").cast("string").alias("topic"), F.lit(b"x").alias("value"))
    observed, observation = observe_delivery(many)
    observed.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="different keys"):
        delivered(observation)


def test_a_stream_reports_its_deliveries(spark, tmp_path):
    source, reports = TopicLog(str(tmp_path / "from"), "earliest"), []
    publish_to_log(buys(spark, 1, 2, 3), source.path)
    stream_to_log(source.stream(spark, BUY), str(tmp_path / "to"), str(tmp_path / "cp"), lambda _, told: reports.append(told)).trigger(availableNow=True).start().awaitTermination()
    assert sum(n for told in reports for n in told.values()) == 3 and {t for told in reports for t, _ in told} == {"buy_events"}


def test_delivery_report_by_topic_and_partition(spark, tmp_path):
    path = str(tmp_path / "log")
    publish_to_log(buys(spark, 1, 2, 3).coalesce(1), path)
    first = next_offset(spark, path)
    publish_to_log(buys(spark, 4, 5).unionByName(messages(spark, CLICK, [CLICK_1])).coalesce(1), path)
    report = delivery_report(spark, path, first).orderBy("topic")
    assert [tuple(r) for r in report.collect()] == [("buy_events", 0, 2, 3, 4), ("click_events", 0, 1, 5, 5)]
    assert delivery_report(spark, path).agg(F.sum("n_messages")).first()[0] == 6
    assert delivery_report(spark, path, next_offset(spark, path)).isEmpty()


def test_delivery_listener(spark, tmp_path):
    log = TopicLog(str(tmp_path / "log"), "earliest")
    publish_to_log(buys(spark, 1, 2, 3), log.path)
    listener = DeliveryListener()
    spark.streams.addListener(listener)
    try:
        observed = observe_delivery_stream(log.stream(spark, BUY).select("topic", "value"))
        query = (
            observed.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        for _ in range(100):
            if listener.delivered:
                break
            time.sleep(0.1)
        assert listener.delivered == {"buy_events": 3}
        assert listener.failures == []
    finally:
        spark.streams.removeListener(listener)


def test_publishing_does_not_shuffle(spark, tmp_path):
    rows = buys(spark, 1).select(F.spark_partition_id(), F.monotonically_increasing_id(), "value")
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
