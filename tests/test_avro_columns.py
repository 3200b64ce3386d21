"""The Avro columns on Spark, checked against the Avro library on Spark's own class path."""

import random

import pytest
from pyspark.sql import functions as F
from samples import BUY_1, CLICK_1, GOLDEN, TOPUP_1, frame

from eventweir.functions.avro import decode_avro
from eventweir.operators.records import decode_records, encode_records, quarantined
from eventweir.schemas import STREAMS


def library(spark, spec):
    """Encode / decode functions of the Java library."""
    avro = spark.sparkContext._jvm.org.apache.avro
    schema = getattr(avro, "Schema$Parser")().parse(spec.wire.avro_json)
    io = avro.io

    def encode(record):
        row = getattr(avro.generic, "GenericData$Record")(schema)
        for name, value in record.items():
            row.put(name, value)
        out = spark.sparkContext._jvm.java.io.ByteArrayOutputStream()
        encoder = io.EncoderFactory.get().binaryEncoder(out, None)
        avro.generic.GenericDatumWriter(schema).write(row, encoder)
        encoder.flush()
        return bytes(out.toByteArray())

    def decode(body):
        row = avro.generic.GenericDatumReader(schema).read(None, io.DecoderFactory.get().binaryDecoder(body, None))
        values = {f: row.get(f) for f in spec.wire.names}
        return {f: v if v is None or isinstance(v, int) else v.toString() for f, v in values.items()}

    return encode, decode


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def random_records(spec, n, seed):
    rng = random.Random(seed)
    alphabet = "ab \"\\é中😀\n"

    def value(field):
        if field.nullable and rng.random() < 0.3:
            return None
        if field.type == "int":
            return rng.choice([0, -1, 63, 64, 2**31 - 1, -(2**31), rng.randrange(-(10**6), 10**6)])
        return "".join(rng.choices(alphabet, k=rng.choice([0, 1, 5, 40])))

    return [{f.name: value(f) for f in spec.wire.fields} for _ in range(n)]


@pytest.mark.parametrize("kind, record, text", GOLDEN)
def test_golden_messages(spark, kind, record, text):
    spec = STREAMS[kind]
    df = spark.createDataFrame([record], spec.wire.struct)
    encoded = encode_records(df, spec, schema_id=7)
    assert [tuple(r) for r in encoded.collect()] == [(spec.topic, bytearray(frame(text)))]
    assert rows_of(decode_records(encoded, spec)) == [record]


@pytest.mark.parametrize("spec", STREAMS.values(), ids=lambda s: s.kind)
def test_same_bytes_and_values_as_the_avro_library(spark, spec):
    encode, decode = library(spark, spec)
    records = random_records(spec, 30, seed=5)
    df = spark.createDataFrame(records, spec.wire.struct).coalesce(1)
    values = [bytes(r.value) for r in encode_records(df, spec, 9).collect()]
    assert [v[5:] for v in values] == [encode(r) for r in records]
    assert [decode(v[5:]) for v in values] == records


def test_same_verdict_as_the_avro_library_on_damaged_bytes(spark):
    spec = STREAMS["buy"]
    encode, decode = library(spark, spec)
    rng = random.Random(11)
    bodies = []
    for record in random_records(spec, 150, seed=7):
        body = bytearray(encode(record))
        for _ in range(rng.choice([1, 1, 2])):
            body[rng.randrange(len(body))] = rng.randrange(256)
        bodies.append(bytes(body))

    def attempt(run):
        try:
            return run()
        except Exception:
            return "error"

    from eventweir.functions import avro_batches
    from eventweir.functions.avro import _plain

    import pyarrow as pa

    ours = [attempt(lambda: avro_batches.decode_batch(pa.array([b]), _plain(spec.wire)).to_pylist()[0]) for b in bodies]
    theirs = [attempt(lambda: decode(b)) for b in bodies]
    assert "error" in theirs and any(t != "error" for t in theirs)
    assert ours == theirs


def test_many_batches_and_partitions(spark):
    spec = STREAMS["buy"]
    rows = spark.range(25_000).select(
        F.lit("buy").alias("event"),
        F.concat(F.lit("s"), "id").alias("sessionId"),
        F.lit(None).cast("string").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, F.lit("ü")).alias("itemId"),
        F.col("id").cast("int").alias("price"),
        (-F.col("id")).cast("int").alias("quantity"),
    )
    decoded = decode_records(encode_records(rows, spec, 1), spec)
    assert decoded.exceptAll(rows).isEmpty() and rows.exceptAll(decoded).isEmpty()


@pytest.mark.parametrize("payload", [None, b"", b"\0", b"\0\0\0\0", b"\0\0\0\0\7", b"\0\0\0\0\7\2"])
@pytest.mark.parametrize("kind, record", [("buy", BUY_1), ("click", CLICK_1), ("topup", TOPUP_1)])
def test_bad_payload_fails_the_query(spark, fails, kind, record, payload):
    spec = STREAMS[kind]
    good = encode_records(spark.createDataFrame([record], spec.wire.struct), spec, 7).select("value")
    bad = good.union(spark.createDataFrame([(payload,)], "value binary"))
    error = fails(lambda: decode_records(bad, spec).collect())
    expected = "at least 6 are needed" if payload is None or len(payload) < 6 else "MalformedRecord"
    assert expected in error


def test_frame_is_not_checked(spark):
    spec = STREAMS["buy"]
    value = b"\xff\xde\xad\xbe\xef" + frame(GOLDEN[0][2])[5:] + b"tail"
    messages = spark.createDataFrame([(value,)], "value binary")
    assert rows_of(decode_records(messages, spec)) == [BUY_1]


def test_record_is_decoded_once(spark):
    spec = STREAMS["buy"]
    messages = spark.createDataFrame([(b"",)], "value binary")
    query = decode_records(messages, spec).where("sessionId <> '' and price > 1").select("itemId", "price")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("kind", STREAMS)
def test_jvm_codec_asks_for_the_avro_module(spark, kind):
    """The module is not on the class path here; with it, these calls are all there is."""
    spec = STREAMS[kind]
    messages = spark.createDataFrame([(b"",)], "value binary")
    records = spark.createDataFrame([], spec.wire.struct)
    for call in (
        lambda: decode_records(messages, spec, codec="jvm"),
        lambda: encode_records(records, spec, 1, codec="jvm"),
    ):
        with pytest.raises(Exception, match="(?i)avro"):
            call()


def test_unknown_codec():
    with pytest.raises(ValueError, match="codec"):
        decode_avro(None, STREAMS["buy"].wire, codec="other")


@pytest.mark.parametrize("kind", STREAMS)
def test_bad_payloads_leave_the_others_alone(spark, kind):
    """Each kind of fault, and every cut of a record, among good ones in one batch."""
    spec, record = STREAMS[kind], {"buy": BUY_1, "click": CLICK_1, "topup": TOPUP_1}[kind]
    good = bytes(encode_records(spark.createDataFrame([record], spec.wire.struct), spec, 7).first()["value"])
    short = [None, b"", good[:3], good[:5]]
    bad = [good[:at] for at in range(6, len(good))] + [good[:5] + b"\xff" * 5 + good[5:], good[:5] + b"\x09" * 20, good[:5] + b"\x01" + good[6:]]
    fine = [good, good + b"tail", b"\xff" * 5 + good[5:]]
    rows = [(at, v) for at, v in enumerate([good, *short, good, *bad, *fine])]
    messages = spark.createDataFrame(rows, "n int, value binary").coalesce(1)
    kept, broken = quarantined(decode_records(messages, spec, ("n", "value"), permissive=True))
    want = [r.asDict() for r in decode_records(messages.where("n = 0"), spec).collect()]
    n_bad = len(short) + len(bad) + 1
    assert [r["n"] for r in kept.collect()] == [0, 5, *range(n_bad + 1, n_bad + 1 + len(fine))]
    assert [r.asDict() for r in kept.drop("n", "value").collect()] == want * (2 + len(fine))
    told = broken.collect()
    assert [(r["n"], r["value"]) for r in told] == [r for r in rows if r[1] not in fine]
    assert [r["fault"] for r in told[:4]] == ["message payload is missing or too short"] * 4
    assert all(any(f.name in r["fault"] for f in spec.wire.fields) for r in told[4:])


def test_permissive_decoding_is_not_the_default(spark, fails):
    messages = spark.createDataFrame([(b"123",)], "value binary")
    assert "at least 6" in fails(lambda: decode_records(messages, STREAMS["buy"]).collect())
    with pytest.raises(ValueError, match="arrow"):
        decode_avro(None, STREAMS["buy"].wire, codec="jvm", permissive=True)
