import duckdb
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from samples import BUY_1, CLICK_1, TOPUP_1

from eventweir.operators.records import encode_records
from eventweir.plans.catalog import QUERIES
from eventweir.plans.oracles import oracle_sql
from eventweir.schemas import BUY, CLICK, STREAMS, TOPUP
from eventweir.sinks.printing import print_records
from eventweir.sinks.tables import FileTableSink
from eventweir.sinks.topics import publish_to_log
from eventweir.sources.topics import TopicLog
from eventweir.streaming.flows import (
    AVAILABLE_NOW,
    FLUSH_INTERVAL,
    OperatorCounts,
    await_all,
    read_quarantine,
    records_of,
    sink_rows,
    start_all,
    start_flow,
    stop_all,
)
from eventweir.streaming.order import order_of

SAMPLES = {"buy": BUY_1, "click": CLICK_1, "topup": TOPUP_1}


def publish(spark, log, spec, keys):
    rows = [{**SAMPLES[spec.kind], spec.key: key} for key in keys]
    publish_to_log(encode_records(spark.createDataFrame(rows, spec.wire.struct), spec, 7), log.path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keys_in(sink, spark, spec):
    name = next(c.name for c in spec.columns if c.wire == spec.key)
    return sorted(r[0] for r in sink.read(spark, spec).select(name).collect())


@pytest.fixture
def place(tmp_path):
    return TopicLog(str(tmp_path / "log"), "earliest"), FileTableSink(str(tmp_path / "out")), str(tmp_path / "cp")


def run(spark, spec, log, sink, checkpoint, **options):
    await_all([start_flow(spark, spec, log, sink, checkpoint, trigger=AVAILABLE_NOW, **options)])


@pytest.mark.parametrize("spec", STREAMS.values(), ids=lambda s: s.kind)
@pytest.mark.parametrize("echo", [False, True])
def test_stream_gives_what_batch_gives(spark, place, spec, echo):
    log, sink, checkpoint = place
    publish(spark, log, spec, ["a", "", " ", "b", "a"] + ([None] if spec is not TOPUP else []))
    run(spark, spec, log, sink, checkpoint, echo=echo)
    streamed, batch = sink.read(spark, spec), sink_rows(log.batch(spark, spec), spec)
    assert streamed.count() == 4
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_restart_loses_and_repeats_nothing(spark, place):
    log, sink, checkpoint = place
    for i in range(3):
        publish(spark, log, BUY, [f"s{i}"])
        run(spark, BUY, log, sink, checkpoint)
    run(spark, BUY, log, sink, checkpoint)
    assert keys_in(sink, spark, BUY) == ["s0", "s1", "s2"]


def test_failed_batch_is_repeated_without_duplicates(spark, place):
    log, sink, checkpoint = place
    publish(spark, log, CLICK, ["a", "b"])

    class Failing:
        keyed = False

        def ensure(self, spark, spec):
            sink.ensure(spark, spec)

        def write(self, rows, spec, batch_id, run):
            sink.write(rows, spec, batch_id, run)
            raise RuntimeError("lost after the write")

    with pytest.raises(StreamingQueryException, match="lost after the write"):
        run(spark, CLICK, log, Failing(), checkpoint)
    run(spark, CLICK, log, sink, checkpoint)
    assert keys_in(sink, spark, CLICK) == ["a", "b"]


def test_table_exists_before_any_record(spark, place):
    log, sink, checkpoint = place
    run(spark, TOPUP, log, sink, checkpoint)
    assert sink.read(spark, TOPUP).columns == TOPUP.sink_names
    assert sink.read(spark, TOPUP).count() == 0


def test_row_key(spark, tmp_path, place):
    log, _, checkpoint = place
    sink = FileTableSink(str(tmp_path / "keyed"), keyed=True)
    for keys in (["a", "b"], ["c"]):
        publish(spark, log, BUY, keys)
        run(spark, BUY, log, sink, checkpoint)
    rows = sink.read(spark, BUY)
    assert rows.columns[:3] == ["topic", "partition", "offset"]
    assert rows.count() == rows.dropDuplicates(["topic", "partition", "offset"]).count() == 3


def test_three_flows(spark, place):
    log, sink, checkpoint = place
    for spec in STREAMS.values():
        publish(spark, log, spec, [spec.kind, ""])
    queries = start_all(spark, log, sink, checkpoint, trigger=AVAILABLE_NOW)
    assert [q.name for q in queries] == ["Click Events", "Buy Events", "Topup Events"]
    await_all(queries)
    for spec in STREAMS.values():
        assert keys_in(sink, spark, spec) == [spec.kind]


def test_one_failing_flow_stops_the_others(spark, place):
    log, sink, checkpoint = place
    publish_to_log(spark.createDataFrame([("buy_events", b"\0")], "topic string, value binary"), log.path)
    queries = start_all(spark, log, sink, checkpoint)
    with pytest.raises(StreamingQueryException, match="at least 6 are needed"):
        await_all(queries)
    assert not any(q.isActive for q in queries)


def test_running_flow_picks_up_new_records(spark, tmp_path, place):
    _, sink, checkpoint = place
    log = TopicLog(str(tmp_path / "log2"), "latest")
    publish(spark, log, BUY, ["old"])
    query = start_flow(spark, BUY, log, sink, checkpoint)
    try:
        publish(spark, log, BUY, ["new"])
        query.processAllAvailable()
        assert keys_in(sink, spark, BUY) == ["new"]
    finally:
        stop_all([query])


@pytest.mark.parametrize("spec", STREAMS.values(), ids=lambda s: s.kind)
def test_flow_is_narrow(spark, place, spec):
    log, _, _ = place
    publish(spark, log, spec, ["a"])
    plan = plan_of(sink_rows(log.batch(spark, spec), spec))
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython") == 1
    assert "ReadSchema: struct<value:binary>" in plan


def test_flow_has_no_watermark_and_flushes_every_200_ms(spark, place):
    log, _, _ = place
    publish(spark, log, BUY, ["a"])
    stream = records_of(log.stream(spark, BUY), BUY)
    assert stream.isStreaming
    assert "EventTimeWatermark" not in stream._jdf.queryExecution().analyzed().toString()
    assert FLUSH_INTERVAL == {"processingTime": "200 milliseconds"}


def test_print_runs_on_the_executors(spark, tmp_path, place):
    log, _, _ = place
    publish(spark, log, BUY, ["a", "b"])
    print_records(records_of(log.batch(spark, BUY), BUY), BUY)


def test_every_record_is_printed(capfd):
    import pyarrow as pa

    from eventweir.sinks.printing import _print_batches

    batch = pa.RecordBatch.from_pydict({"record": [f"r{i}" for i in range(1000)]})
    assert list(_print_batches(iter([batch, batch.slice(0, 0), batch]))) == []
    assert capfd.readouterr().out.split() == [f"r{i}" for i in range(1000)] * 2


def test_a_new_checkpoint_only_adds_rows(spark, tmp_path, place):
    log, sink, checkpoint = place
    publish(spark, log, BUY, ["a", "b"])
    run(spark, BUY, log, sink, checkpoint)
    run(spark, BUY, log, sink, str(tmp_path / "another"))
    run(spark, BUY, log, sink, checkpoint)
    assert keys_in(sink, spark, BUY) == ["a", "a", "b", "b"]


def test_a_late_file_with_an_old_time_is_delivered(spark, tmp_path, place):
    import os
    import time
    from pathlib import Path

    log, sink, checkpoint = place
    publish(spark, log, BUY, ["a"])
    run(spark, BUY, log, sink, checkpoint)
    before = set(Path(log.path).rglob("*.parquet"))
    publish(spark, log, BUY, ["late"])
    for file in set(Path(log.path).rglob("*.parquet")) - before:
        os.utime(file, (time.time() - 9 * 86400,) * 2)
    run(spark, BUY, log, sink, checkpoint)
    assert keys_in(sink, spark, BUY) == ["a", "late"]


def test_long_value_stops_the_flow(spark, place):
    log, sink, checkpoint = place
    publish(spark, log, BUY, ["x" * 256])
    with pytest.raises(StreamingQueryException, match="does not fit"):
        run(spark, BUY, log, sink, checkpoint)
    assert sink.read(spark, BUY).where(F.length("session_id") > 0).isEmpty()


def test_each_flow_runs_in_a_pool_of_its_own(spark, place):
    log, sink, checkpoint = place
    publish(spark, log, BUY, ["a"])
    pools = []
    run(spark, BUY, log, sink, checkpoint, echo=lambda batch, spec: pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool")), name="first buys")
    assert pools == ["first buys"] and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_two_sinks_evaluate_a_batch_once(spark, tmp_path):
    """The source's rows are counted as they are read, whatever the sinks."""
    log, sink = TopicLog(str(tmp_path / "log"), "earliest"), FileTableSink(str(tmp_path / "tables"))
    good = encode_records(spark.createDataFrame([BUY_1] * 7, BUY.wire.struct), BUY, 1)
    bad = good.limit(2).withColumn("value", F.lit(b"123"))
    publish_to_log(good.unionByName(bad), log.path)
    listener, echoed = OperatorCounts(), []
    spark.streams.addListener(listener)
    try:
        flow = start_flow(
            spark, BUY, log, sink, str(tmp_path / "checkpoint"), AVAILABLE_NOW,
            echo=lambda batch, spec: echoed.append(batch.count()), name="once", quarantine=str(tmp_path / "bad"),
        )
        flow.awaitTermination()
        counts = listener.of([flow])
    finally:
        spark.streams.removeListener(listener)
    assert counts["once/source"] == 9 and counts["once/filter"] == 7 and sum(echoed) == 7
    assert sink.read(spark, BUY).count() == 7
    told = read_quarantine(spark, str(tmp_path / "bad")).collect()
    assert [bytes(r["value"]) for r in told] == [b"123"] * 2 and {r["topic"] for r in told} == {BUY.topic}


def test_a_bad_payload_at_the_end_of_a_file(spark, place, tmp_path):
    log, sink, checkpoint = place
    good = encode_records(spark.createDataFrame([{**BUY_1, "sessionId": "s"}], BUY.wire.struct), BUY, 7).first()["value"]
    messages = spark.createDataFrame([(good,), (None,), (good,), (good[:-1],)], "value binary").coalesce(1)
    publish_to_log(messages.select(F.lit(BUY.topic).alias("topic"), "value"), log.path, first_offset=0)
    await_all([start_flow(spark, BUY, log, sink, checkpoint, AVAILABLE_NOW, name="ends-badly", quarantine=str(tmp_path / "bad"))])
    assert keys_in(sink, spark, BUY) == ["s", "s"]
    told = read_quarantine(spark, str(tmp_path / "bad")).orderBy("offset").collect()
    assert [(r["offset"], r["fault"]) for r in told] == [(1, "message payload is missing or too short"), (3, "Avro record ends inside a field: quantity")]


def test_quarantine_flow_against_its_sql_where_batches_end_with_each_bad_payload(spark, tmp_path):
    """60 purchases, decoded 7 at a time: batches end with each kind of bad payload, and so does the table."""
    values = "id as event_id, timestamp'2024-01-01' as ts, id % 13 as user_id, 'purchase' as event_type, id / 2 as value, concat('{\"k\": ', id, '}') as props"
    spark.range(60).selectExpr(*values.split(", ", 5)).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = QUERIES["d3_quarantine_flow"](spark, str(tmp_path)).select("fault", "n_rows").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(duck.execute(f"SELECT fault, n_rows FROM ({oracle_sql()['d3_quarantine_flow']})").fetchall())


def test_order_is_checked_in_files_and_between_batches(spark, tmp_path):
    def batch(number, *offsets, run="q"):
        rows = spark.createDataFrame([("t", 0, o) for o in offsets], "topic string, partition int, offset bigint").coalesce(1)
        rows.write.parquet(f"{tmp_path}/run={run}/batch_id={number}")

    batch(0, 0, 1, 2)
    batch(1, 3, 9)
    batch(0, 1, 2, run="other")
    table = spark.read.schema("topic string, partition int, offset bigint, run string, batch_id bigint").parquet(str(tmp_path))
    assert [tuple(r) for r in order_of(table).collect()] == [("t", 0, 7, 3, 0)]
    batch(2, 8, 10, 10, 12)  # behind the batch before, and one offset twice
    table = spark.read.schema(table.schema).parquet(str(tmp_path))
    assert [tuple(r) for r in order_of(table).collect()] == [("t", 0, 11, 4, 2)]


def test_numbers_are_dense_and_stay_with_their_batch(spark, tmp_path):
    sink = FileTableSink(str(tmp_path), numbered=True)
    sink.ensure(spark, CLICK)
    rows = [spark.createDataFrame([(f"{b}-{i}", "t", "i", "c") for i in range(n)], ", ".join(f"{c} string" for c in CLICK.sink_names)).repartition(3) for b, n in enumerate((5, 0, 4))]
    for at in (0, 1, 1, 2, 2):
        sink.write(rows[at], CLICK, at, "q")
    first = {r["session_id"]: r["idx"] for r in sink.read(spark, CLICK).collect()}
    assert sorted(first.values()) == list(range(1, 10)) and max(v for k, v in first.items() if k.startswith("0")) == 5
    sink.write(rows[0], CLICK, 0, "another")
    assert sorted(r["idx"] for r in sink.read(spark, CLICK).collect()) == list(range(1, 15))
