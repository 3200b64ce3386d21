"""Named queries: each runs one operator, or one whole flow, over the benchmark tables.

Every query takes ``(spark, sf_dir)`` and reads its tables whole. Flows that need a
topic log, a table or a checkpoint put it into a new scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.functions.frames import frame_schema_id, guard_payload, strip_frame
from eventweir.functions.json_values import decode_json
from eventweir.functions.text import text_to_int
from eventweir.operators.align import align
from eventweir.operators.records import (
    decode_records,
    encode_records,
    project_sink,
    quarantined,
    tag,
    with_text,
)
from eventweir.plans.publish import to_messages
from eventweir.plans.replay import ROW, index_rows, interleaved, replay_first
from eventweir.plans.scratch import scratch_dir
from eventweir.plans.workload import SOURCE_KEYS, records, table
from eventweir.schemas import BUY, CLICK, STREAMS, TOPUP, VARCHAR_LIMIT, StreamSpec, WireField, WireSchema, read_avsc
from eventweir.sinks.printing import printed_lines as lines_of
from eventweir.sinks.tables import CatalogTableSink, FileTableSink
from eventweir.sinks.topics import delivered, observe_delivery, publish_to_log
from eventweir.sources.csv_files import BUY_CELLS, CLICK_CELLS, READERS, named_records
from eventweir.sources.topics import TopicLog
from eventweir.streaming.flows import (
    AVAILABLE_NOW,
    ROW_KEY,
    OperatorCounts,
    await_all,
    read_quarantine,
    records_of,
    sink_rows,
    start_all,
    start_flow,
)
from eventweir.streaming.order import order_of

Query = Callable[[SparkSession, str], DataFrame]

SCHEMA_IDS = {"click": 1, "buy": 2, "topup": 3}
CSV_CELLS = {"click": CLICK_CELLS, "buy": BUY_CELLS, "topup": TOPUP.wire.names}


def _messages(spark: SparkSession, sf_dir: str, spec: StreamSpec) -> DataFrame:
    """Framed messages of one kind, with the source key beside them."""
    key = SOURCE_KEYS[spec.kind]
    return encode_records(records(spark, sf_dir, spec.kind, keyed=True), spec, SCHEMA_IDS[spec.kind], keep=(key,))


def _all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages({kind: records(spark, sf_dir, kind) for kind in STREAMS}, SCHEMA_IDS)


# Codecs


def encode(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    key = SOURCE_KEYS[spec.kind]
    return _messages(spark, sf_dir, spec).select(key, F.hex("value").alias("value_hex"))


def roundtrip(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_records(_messages(spark, sf_dir, spec), spec, keep=(SOURCE_KEYS[spec.kind],))


def frame_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return _messages(spark, sf_dir, CLICK).select(
        "event_id", frame_schema_id(value).alias("schema_id"), F.hex(strip_frame(value)).alias("body_hex")
    )


def payload_guard(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    guarded = guard_payload(F.col("value"))
    return _messages(spark, sf_dir, spec).select(SOURCE_KEYS[spec.kind], F.octet_length(guarded).alias("n_bytes"))


def damaged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases whose payloads are, by turns, missing, empty, too short, cut, longer than their
    record, or in a frame with a wrong head; the last two are good."""
    whole, turn = F.col("value"), F.col("event_id") % 9
    value = F.when(turn == 1, F.lit(b"")).when(turn == 2, F.substring(whole, 1, 4)).when(turn == 3, F.substring(whole, 1, 5))
    value = value.when(turn == 4, F.expr("substring(value, 1, octet_length(value) - 1)"))
    value = value.when(turn == 5, F.expr("concat(substring(value, 1, 5), x'FFFFFFFFFF', substring(value, 6))"))
    value = value.when(turn == 6, F.concat(whole, F.lit(b"tail"))).when(turn == 7, F.concat(F.lit(b"\xff\xfe\xfd\xfc\xfb"), F.substring(whole, 6, 1 << 30)))
    return _messages(spark, sf_dir, BUY).withColumn("value", F.when(turn != 0, value.otherwise(whole)))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records and, with what is wrong with them, bad payloads, from one decoding."""
    good, bad = quarantined(decode_records(damaged_payloads(spark, sf_dir), BUY, keep=("event_id", "value"), permissive=True))
    bad = bad.select("event_id", F.octet_length("value").alias("n_bytes"), "fault")
    return good.drop("value").unionByName(bad, allowMissingColumns=True)


def quarantine_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same payloads through a flow: rows of the table and rows put aside."""
    root = scratch_dir(spark, "quarantine")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables")
    publish_to_log(damaged_payloads(spark, sf_dir), log.path, first_offset=0)
    name = f"{BUY.query_name} {root}"
    await_all([start_flow(spark, BUY, log, sink, f"{root}/checkpoint", AVAILABLE_NOW, name=name, quarantine=f"{root}/bad")])
    bad = read_quarantine(spark, f"{root}/bad").groupBy("fault").agg(F.count("*").alias("n_rows"))
    return bad.unionByName(sink.read(spark, BUY).agg(F.lit("none").alias("fault"), F.count("*").alias("n_rows")))


def null_int_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a schema in which the ints may be null: the decoder gives 0 for null."""
    fields = [WireField(f.name, f.type, True) for f in BUY.wire.fields]
    loose = replace(BUY, wire=WireSchema(BUY.wire.name, BUY.wire.namespace, tuple(fields)))
    rows = records(spark, sf_dir, "buy", keyed=True)
    rows = rows.withColumns({n: F.when(F.col("sessionId").isNotNull(), F.col(n)) for n in BUY.zero_filled})
    messages = encode_records(rows, loose, SCHEMA_IDS["buy"], keep=("event_id",))
    return decode_records(messages, loose, keep=("event_id",)).select("event_id", *BUY.zero_filled)


def null_safe_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, empty and other text of clicks, as the decoder gives it."""
    decoded = decode_records(_messages(spark, sf_dir, CLICK), CLICK, keep=("event_id",))
    return decoded.select("event_id", "sessionId", "category")


PROPS = T.StructType([T.StructField("k", T.IntegerType())])


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("props").cast("binary")
    decoded = table(spark, sf_dir, "events").select("event_id", decode_json(value, PROPS).alias("record"))
    return decoded.select("event_id", "record.k")


def json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in objects and in arrays, checked strictly at every level."""
    text = F.expr("concat('{\"user\": {\"id\": ', user_id, '}, \"items\": [', props, ', ', props, ']}')")
    schema = T._parse_datatype_string("user struct<id: bigint>, items array<struct<k: int>>")
    decoded = table(spark, sf_dir, "events").select("event_id", decode_json(text.cast("binary"), schema).alias("record"))
    total = F.aggregate("record.items", F.lit(0), lambda sum_, item: sum_ + item["k"])
    return decoded.select("event_id", F.col("record.user.id").alias("user_id"), total.alias("total"))


def json_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("case when user_id % 10 = 0 then 'null' else props end").cast("binary")
    decoded = table(spark, sf_dir, "events").select("event_id", decode_json(value, PROPS).alias("record"))
    return decoded.where("record is not null").select("event_id", "record.k")


def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial_records = records(spark, sf_dir, "buy").select("quantity", "price", "sessionId")
    return align(partial_records, BUY.wire)


def required_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(records(spark, sf_dir, "topup"), TOPUP.wire)


# Filters, projections, scalars


def keyed_records(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(_messages(spark, sf_dir, spec), spec, keep=(SOURCE_KEYS[spec.kind],))


def projected(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sink_rows(_messages(spark, sf_dir, spec), spec, keep=(SOURCE_KEYS[spec.kind],))


def null_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sink_rows(_messages(spark, sf_dir, TOPUP), TOPUP)
    return rows.groupBy("is_postpaid").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("supplier_trans_id").isNull()).alias("null_supplier_trans_id"),
        F.count_if(F.col("job_id").isNull()).alias("null_job_id"),
    )


def event_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = {s: records(spark, sf_dir, s.kind, keyed=True).select("event_id") for s in (CLICK, BUY)}
    return reduce(DataFrame.unionByName, [tag(df, spec) for spec, df in plain.items()])


def text_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "concat(' ', cast(cast(floor(o_totalprice) as int) as string), ' ')"
    return table(spark, sf_dir, "orders").select("o_orderkey", text_to_int(text, "total").alias("total"))


def empty_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the nullable top-up fields, written as CSV and loaded back."""
    return csv_load(TOPUP, spark, sf_dir).select("id", "supplierTransId", "jobId", "phoneNumber")


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for spec in STREAMS.values():
        lines = with_text(records(spark, sf_dir, spec.kind), spec)
        parts.append(lines.select(F.lit(spec.topic).alias("topic"), "record"))
    return reduce(DataFrame.unionByName, parts)


def printed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the three flows print: the text of every record that passes the filter."""
    parts = []
    for spec in STREAMS.values():
        lines = lines_of(records_of(_messages(spark, sf_dir, spec), spec), spec)
        parts.append(lines.select(F.lit(spec.topic).alias("topic"), "record"))
    return reduce(DataFrame.unionByName, parts)


def named_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = records(spark, sf_dir, "click").select(*CLICK_CELLS).toDF("_c0", "_c1", "_c2", "_c3")
    return named_records(cells, CLICK, CLICK_CELLS)


# Sources


def csv_load(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the records as a CSV file table and load it back."""
    path = scratch_dir(spark, f"csv-{spec.kind}")
    header = spec.kind == "topup"
    rows = records(spark, sf_dir, spec.kind).select(*CSV_CELLS[spec.kind])
    rows.write.options(header=header, quote='"', escape='"').csv(path)
    return READERS[spec.kind](spark, path)


def topic_scan(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    log = TopicLog(scratch_dir(spark, f"log-{spec.kind}"))
    publish_to_log(_messages(spark, sf_dir, spec), log.path, first_offset=0)
    return decode_records(log.batch(spark, spec), spec)


def schema_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode with the schema that a schema file holds."""
    path = scratch_dir(spark, "avsc")
    spark.createDataFrame([(CLICK.wire.avro_json,)], "value string").coalesce(1).write.text(path)
    loaded = replace(CLICK, wire=read_avsc(spark, path))
    return decode_records(_messages(spark, sf_dir, CLICK), loaded, keep=("event_id",))


def value_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = TopicLog(scratch_dir(spark, "log-value"))
    publish_to_log(_messages(spark, sf_dir, BUY), log.path, first_offset=0)
    return log.batch(spark, BUY).select(F.hex("value").alias("value_hex"))


def _run(spark: SparkSession, spec: StreamSpec, log: TopicLog, sink, checkpoint: str) -> None:
    name = f"{spec.query_name} {checkpoint}"
    await_all([start_flow(spark, spec, log, sink, checkpoint, trigger=AVAILABLE_NOW, name=name)])


def latest_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All purchases are in the topic before the flow starts; only what comes after it, the
    return of each purchase, arrives."""
    root = scratch_dir(spark, "latest")
    log, sink = TopicLog(f"{root}/log", "latest"), FileTableSink(f"{root}/tables")
    publish_to_log(_messages(spark, sf_dir, BUY), log.path, first_offset=0)
    _run(spark, BUY, log, sink, f"{root}/checkpoint")
    returns = records(spark, sf_dir, "buy").withColumn("quantity", -F.col("quantity"))
    publish_to_log(encode_records(returns, BUY, SCHEMA_IDS["buy"]), log.path)
    _run(spark, BUY, log, sink, f"{root}/checkpoint")
    return sink.read(spark, BUY)


# Sinks and whole flows


def streamed(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, f"flow-{spec.kind}")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables")
    publish_to_log(_messages(spark, sf_dir, spec), log.path, first_offset=0)
    _run(spark, spec, log, sink, f"{root}/checkpoint")
    return sink.read(spark, spec)


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after small batches were packed twice, the second time with the first's small file."""
    root = scratch_dir(spark, "compacted")
    log, sink = TopicLog(f"{root}/log", "earliest", {"maxFilesPerTrigger": "2"}), FileTableSink(f"{root}/tables")
    for _ in range(2):
        publish_to_log(_messages(spark, sf_dir, TOPUP), log.path)
        _run(spark, TOPUP, log, sink, f"{root}/checkpoint")
        sink.compact(spark, TOPUP)
    sink.clean(spark, TOPUP, retention_hours=0)
    return sink.read(spark, TOPUP)


def row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per topic and how many of their keys occur more than once."""
    root = scratch_dir(spark, "row-key")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables", keyed=True)
    publish_to_log(_messages(spark, sf_dir, TOPUP), log.path, first_offset=0)
    _run(spark, TOPUP, log, sink, f"{root}/checkpoint")
    keys = sink.read(spark, TOPUP).groupBy(*ROW_KEY).agg(F.count("*").alias("n"))
    return keys.groupBy("topic").agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("repeated_keys")
    )


def length_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of any length fit the unlimited column; the limited one takes those that fit, and
    a longer one would fail the query."""
    other = [F.lit("x" if f.type == "string" else 1).alias(f.name) for f in TOPUP.wire.fields if f.name not in ("code", "description")]
    fits = F.when(F.length("text") <= VARCHAR_LIMIT, F.col("text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("description"), fits.alias("code"), *other)
    sunk = project_sink(rows, TOPUP, keep=("doc_id",))
    return sunk.select("doc_id", F.length("description").alias("n_text"), "code")


def _counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("topic").agg(F.count("*").alias("n_messages"))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = TopicLog(scratch_dir(spark, "publish"))
    publish_to_log(_all_messages(spark, sf_dir), log.path, first_offset=0)
    return _counts(reduce(DataFrame.unionByName, [log.batch(spark, s).select("topic") for s in STREAMS.values()]))


def delivery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, observation = observe_delivery(_all_messages(spark, sf_dir))
    publish_to_log(messages, scratch_dir(spark, "delivery"), first_offset=0)
    return spark.createDataFrame(list(delivered(observation).items()), "topic string, n_messages bigint")


def delivery_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the writing job reports by topic and partition, summed over two appends. The log is
    not read; partitions are numbered from 0, one per writing task that had messages."""
    path = scratch_dir(spark, "delivery-partitions")
    messages = _all_messages(spark, sf_dir)
    reports = [publish_to_log(messages, path), publish_to_log(messages, path)]
    rows = [(at, topic, partition, n) for at, report in enumerate(reports) for (topic, partition), n in report.items()]
    told = spark.createDataFrame(rows, "append int, topic string, partition int, n bigint")
    return told.groupBy("topic").agg(
        F.sum("n").alias("n_messages"), (F.count("*") - F.countDistinct("append", "partition")).alias("n_repeated"), F.countDistinct("append").alias("n_appends")
    )


def dense_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All clicks through a flow of several micro-batches, twice, into a numbered table; then its last
    batch is written once more. Numbers count the rows and ascend with the offset."""
    root = scratch_dir(spark, "dense-key")
    log, sink = TopicLog(f"{root}/log", "earliest", {"maxFilesPerTrigger": "2"}), FileTableSink(f"{root}/tables", keyed=True, numbered=True)
    for _ in range(2):
        publish_to_log(_messages(spark, sf_dir, CLICK), log.path)
        _run(spark, CLICK, log, sink, f"{root}/checkpoint")
    batches = sink.read_batches(spark, CLICK)
    last = batches.where("batch_id >= 0").agg(F.max(F.struct("batch_id", "run"))).first()[0]
    again = batches.where((F.col("run") == last["run"]) & (F.col("batch_id") == last["batch_id"])).drop("run", "batch_id", "idx")
    again = staged_copy(again, f"{root}/again")
    sink.write(again, CLICK, last["batch_id"], last["run"])
    rows = sink.read(spark, CLICK)
    return rows.agg(
        F.count("*").alias("n_rows"), F.countDistinct("idx").alias("n_numbers"), F.min("idx").alias("first"), F.max("idx").alias("last")
    )


def staged_copy(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def partition_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appends of all clicks, taken in by several micro-batches: rows by topic, and places
    where the table leaves the order of a partition."""
    root = scratch_dir(spark, "order")
    log, sink = TopicLog(f"{root}/log", "earliest", {"maxFilesPerTrigger": "2"}), FileTableSink(f"{root}/tables", keyed=True)
    for _ in range(3):
        publish_to_log(_messages(spark, sf_dir, CLICK), log.path)
    _run(spark, CLICK, log, sink, f"{root}/checkpoint")
    found = order_of(sink.read_batches(spark, CLICK).where("batch_id >= 0"))
    return found.groupBy("topic").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_breaks").alias("n_breaks"), (F.max("n_batches") > 1).alias("several_batches")
    )


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, two sinks: table rows and printed lines, from one decoded batch."""
    root = scratch_dir(spark, "fan-out")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables")
    publish_to_log(_messages(spark, sf_dir, CLICK), log.path, first_offset=0)

    def echo(batch: DataFrame, spec: StreamSpec) -> None:
        lines_of(batch, spec).write.mode("append").text(f"{root}/printed")

    name = f"{CLICK.query_name} {root}"
    await_all([start_flow(spark, CLICK, log, sink, f"{root}/checkpoint", AVAILABLE_NOW, echo, name=name)])
    columns = {c.wire: c.name for c in CLICK.columns}
    written = sink.read(spark, CLICK).select(F.lit("table").alias("sink"), *columns.values())
    cells = [F.get_json_object("value", f"$.{wire}").alias(name) for wire, name in columns.items()]
    return written.unionByName(spark.read.text(f"{root}/printed").select(F.lit("print").alias("sink"), *cells))


def three_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "three")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables")
    publish_to_log(_all_messages(spark, sf_dir), log.path, first_offset=0)
    await_all(start_all(spark, log, sink, f"{root}/checkpoints", trigger=AVAILABLE_NOW))
    parts = [sink.read(spark, s).select(F.lit(s.table).alias("table_name")) for s in STREAMS.values()]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(F.count("*").alias("n_rows"))


def query_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three flows by name, as their progress reports show them: messages read, and neither
    state nor a watermark."""
    root = scratch_dir(spark, "names")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables")
    publish_to_log(_all_messages(spark, sf_dir), log.path, first_offset=0)
    flows = start_all(spark, log, sink, f"{root}/checkpoints", trigger=AVAILABLE_NOW)
    await_all(flows)
    rows = [
        (q.name, sum(p.numInputRows for p in q.recentProgress), sum(len(p.stateOperators) for p in q.recentProgress), any(p.eventTime for p in q.recentProgress))
        for q in flows
    ]
    return spark.createDataFrame(rows, "query_name string, n_messages bigint, n_state_operators bigint, watermark boolean")


def operator_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows through each named operator of the three flows, as a listener collects them: in,
    past the filter, and to the sink."""
    root = scratch_dir(spark, "operators")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables")
    publish_to_log(_all_messages(spark, sf_dir), log.path, first_offset=0)
    listener = OperatorCounts()
    spark.streams.addListener(listener)
    try:
        flows = start_all(spark, log, sink, f"{root}/checkpoints", trigger=AVAILABLE_NOW)
        await_all(flows)
        counts = listener.of(flows)
    finally:
        spark.streams.removeListener(listener)
    rows = []
    for spec in STREAMS.values():
        n_in, n_kept, n_out = (counts.get(f"{spec.query_name}/{operator}", 0) for operator in ("source", "filter", "sink"))
        rows.append((spec.query_name, n_in, n_in - n_kept, n_out))
    return spark.createDataFrame(rows, "query_name string, n_in bigint, n_dropped bigint, n_written bigint")


def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _all_messages(spark, sf_dir)
    return messages.groupBy("topic", frame_schema_id(F.col("value")).alias("schema_id")).agg(
        F.count("*").alias("n_messages"), F.sum(F.octet_length("value")).alias("n_bytes")
    )


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rounds as the largest table has rows; the smaller ones start over."""
    root = scratch_dir(spark, "replay")
    tables = {
        kind: index_rows(records(spark, sf_dir, kind, keyed=True), f"{root}/{kind}", SOURCE_KEYS[kind])
        for kind in STREAMS
    }
    rounds = max(t.size for t in tables.values())
    played = replay_first(spark, tables, rounds * len(tables))
    named = {kind: df.withColumnRenamed(SOURCE_KEYS[kind], "record_key") for kind, df in played.items()}
    return interleaved(named).select("tick", "topic", "record_key", "sessionId", "phoneNumber")


def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    indexed = index_rows(orders, scratch_dir(spark, "index"), "o_orderkey")
    return indexed.rows.select("o_orderkey", F.col(ROW).alias("row_index"))


def restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All clicks arrive, and once more while the flow is down. Started again, it delivers the
    second set; started a third time, nothing."""
    root = scratch_dir(spark, "restart")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables")
    for _ in range(2):
        publish_to_log(_messages(spark, sf_dir, CLICK), log.path)
        _run(spark, CLICK, log, sink, f"{root}/checkpoint")
    _run(spark, CLICK, log, sink, f"{root}/checkpoint")
    return sink.read(spark, CLICK)


def new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All clicks through one checkpoint, then all once more through another one, into the same
    table: both sets are there."""
    root = scratch_dir(spark, "checkpoints")
    log, sink = TopicLog(f"{root}/log", "earliest"), FileTableSink(f"{root}/tables")
    publish_to_log(_messages(spark, sf_dir, CLICK), log.path, first_offset=0)
    for checkpoint in ("first", "second"):
        _run(spark, CLICK, log, sink, f"{root}/{checkpoint}")
    return sink.read(spark, CLICK)


def repeated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All purchases flow, in several micro-batches, into a table that was there before and has no
    batch columns; then all of them once more through another checkpoint. They are there once."""
    root = scratch_dir(spark, "repeated")
    database = "eventweir_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    columns = ", ".join(c.ddl("STRING") for c in reversed(BUY.columns))
    spark.sql(f"CREATE TABLE {database}.{BUY.table} ({columns}) USING parquet")
    log = TopicLog(f"{root}/log", "earliest", {"maxFilesPerTrigger": "3"})
    sink = CatalogTableSink(database, ledger=f"{root}/ledger")
    publish_to_log(_messages(spark, sf_dir, BUY), log.path, first_offset=0)
    publish_to_log(_messages(spark, sf_dir, BUY), log.path)
    for checkpoint in ("first", "second"):
        _run(spark, BUY, log, sink, f"{root}/{checkpoint}")
    return sink.read(spark, BUY)


def created_table(spec: StreamSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog table is made, made once more, filled by a flow and read back."""
    root = scratch_dir(spark, f"catalog-{spec.kind}")
    database = "eventweir_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    log, sink = TopicLog(f"{root}/log", "earliest"), CatalogTableSink(database)
    publish_to_log(_messages(spark, sf_dir, spec), log.path, first_offset=0)
    sink.ensure(spark, spec)
    sink.ensure(spark, spec)
    _run(spark, spec, log, sink, f"{root}/checkpoint")
    return sink.read(spark, spec)


QUERIES: dict[str, Query] = {
    "s1_topup_topic": partial(topic_scan, TOPUP),
    "s2_buy_topic": partial(topic_scan, BUY),
    "s3_click_topic": partial(topic_scan, CLICK),
    "s4_latest_start": latest_start,
    "s6_value_only": value_only,
    "s8_csv_topup": partial(csv_load, TOPUP),
    "s9_csv_click": partial(csv_load, CLICK),
    "s10_csv_buy": partial(csv_load, BUY),
    "s11_schema_file": schema_file,
    "d1_frame_strip": frame_strip,
    "d2_payload_guard": partial(payload_guard, TOPUP),
    "d2_buy_guard": partial(payload_guard, BUY),
    "d2_click_guard": partial(payload_guard, CLICK),
    "d3_buy_roundtrip": partial(roundtrip, BUY),
    "d3_quarantine": quarantine,
    "d3_quarantine_flow": quarantine_flow,
    "d4_click_roundtrip": partial(roundtrip, CLICK),
    "d5_topup_roundtrip": partial(roundtrip, TOPUP),
    "d6_null_int_default": null_int_default,
    "d7_null_safe_text": null_safe_text,
    "d8_json_decode": json_decode,
    "d8_nested": json_nested,
    "d9_json_non_null": json_non_null,
    "d10_buy_encode": partial(encode, BUY),
    "d10_click_encode": partial(encode, CLICK),
    "d10_topup_encode": partial(encode, TOPUP),
    "d11_default_fill": default_fill,
    "d12_required_check": required_check,
    "f1_topup_filter": partial(keyed_records, TOPUP),
    "f2_buy_filter": partial(keyed_records, BUY),
    "f3_click_filter": partial(keyed_records, CLICK),
    "p1_topup_project": partial(projected, TOPUP),
    "p2_buy_project": partial(projected, BUY),
    "p3_click_project": partial(projected, CLICK),
    "p4_null_passing": null_passing,
    "p5_event_tag": event_tag,
    "p6_text_to_int": text_ints,
    "p7_empty_to_null": empty_nulls,
    "p8_record_text": record_lines,
    "p9_named_cells": named_cells,
    "k4_topup_sink": partial(streamed, TOPUP),
    "k5_buy_sink": partial(streamed, BUY),
    "k6_click_sink": partial(streamed, CLICK),
    "k4_compacted": compacted,
    "k9_row_key": row_key,
    "k10_length_limit": length_limit,
    "k11_printed_lines": printed_lines,
    "k12_publish": published,
    "k13_delivery_counts": delivery_counts,
    "k13_by_partition": delivery_by_partition,
    "k9_dense_key": dense_key,
    "w4_partition_order": partition_order,
    "c1_fan_out": fan_out,
    "c2_three_streams": three_streams,
    "c3_query_names": query_names,
    "c3_operator_counts": operator_counts,
    "c4_topic_routing": topic_routing,
    "c5_replay": replayed,
    "c5_row_index": row_index,
    "w3_restart": restarted,
    "w3_new_checkpoint": new_checkpoint,
    "w3_repeated_batch": repeated_batch,
    "k1_topup_table": partial(created_table, TOPUP),
    "k2_buy_table": partial(created_table, BUY),
    "k3_click_table": partial(created_table, CLICK),
}
