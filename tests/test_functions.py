import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.functions.frames import add_frame, frame_schema_id, guard_payload, strip_frame
from eventweir.functions.json_values import decode_json
from eventweir.functions.text import record_text, text_to_int
from eventweir.schemas import BUY, CLICK

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.StringType())])


def one(spark, value, type_, column):
    return spark.createDataFrame([(value,)], f"v {type_}").select(column(F.col("v"))).first()[0]


def test_frames(spark):
    framed = spark.createDataFrame([(b"body",)], "v binary").select(add_frame(F.col("v"), 300).alias("f"))
    row = framed.select("f", strip_frame(F.col("f")), frame_schema_id(F.col("f"))).first()
    assert tuple(row) == (b"\x00\x00\x00\x01\x2cbody", b"body", 300)


def test_guard_payload(spark, fails):
    assert one(spark, b"123456", "binary", guard_payload) == b"123456"
    assert "has 5 bytes" in fails(lambda: one(spark, b"12345", "binary", guard_payload))
    assert "has no bytes" in fails(lambda: one(spark, None, "binary", guard_payload))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_to_int(spark, fails, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        parse = lambda v: one(spark, v, "string", lambda c: text_to_int("v", "n"))
        assert [parse(v) for v in [" 5 ", "+7", "-3", "0012", "2147483647"]] == [5, 7, -3, 12, 2147483647]
        for bad in ["1.5", "9999999999", "", "x", None]:
            assert "not an int" in fails(lambda: parse(bad))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"k": 1, "s": "x"}', (1, "x")),
        ('{"s": null}', (None, None)),
        ("{}", (None, None)),
        (" null ", None),
    ],
)
def test_json(spark, text, expected):
    row = one(spark, text.encode(), "binary", lambda c: decode_json(c, SCHEMA))
    assert row == expected if expected is None else tuple(row) == expected


@pytest.mark.parametrize("text", ["", "  ", "[]", '[{"k": 1}]', "5", '{"k": 1', '{"k": "x"}', '{"k": 99999999999}', None])
@pytest.mark.parametrize("strict", [True, False])
def test_bad_json(spark, fails, text, strict):
    value = None if text is None else text.encode()
    assert fails(lambda: one(spark, value, "binary", lambda c: decode_json(c, SCHEMA, strict)))


def test_unknown_json_fields(spark, fails):
    value = b'{"k": 1, "z": 2}'
    assert "unknown JSON fields: z" in fails(lambda: one(spark, value, "binary", lambda c: decode_json(c, SCHEMA)))
    assert one(spark, value, "binary", lambda c: decode_json(c, SCHEMA, strict=False)).k == 1


NESTED = "a struct<b: int, c: array<struct<d: int>>>, m map<string, struct<e: int>>"


@pytest.mark.parametrize(
    "text, unknown",
    [
        ('{"a": {"b": 1, "c": [{"d": 2}, null]}, "m": {"x": {"e": 3}}}', None),
        ('{"a": null, "m": null}', None),
        ('{"a": {"b": 1, "zzz": 2}}', "zzz"),
        ('{"a": {"c": [{"d": 1}, {"d": 1, "y": 2}]}}', "y"),
        ('{"m": {"x": {"e": 1}, "w": {"f": 1}}}', "f"),
    ],
)
def test_strict_json_at_every_level(spark, fails, text, unknown):
    schema = T._parse_datatype_string(NESTED)
    decode = lambda strict: one(spark, text.encode(), "binary", lambda c: decode_json(c, schema, strict))
    assert decode(False) is not None
    if unknown is None:
        assert decode(True) == decode(False)
    else:
        assert f"unknown JSON fields: {unknown}" in fails(lambda: decode(True))


@pytest.mark.parametrize(
    "kind, text, expected",
    [
        ("array<int>", "[1, null, 2]", [1, None, 2]),
        ("array<int>", "[]", []),
        ("map<string,int>", '{"a": 1}', {"a": 1}),
        ("int", " 5 ", 5),
        ("string", '"x, ]\\" y"', 'x, ]" y'),
        ("boolean", "true", True),
        ("int", "null", None),
        ("int", "1, 2", ValueError),
        ("int", "1],[2", ValueError),
        ("int", "{}", ValueError),
        ("int", '"x"', ValueError),
        ("array<int>", "5", ValueError),
        ("array<int>", '["x"]', ValueError),
    ],
)
def test_json_of_any_type(spark, fails, kind, text, expected):
    decode = lambda: one(spark, text.encode(), "binary", lambda c: decode_json(c, T._parse_datatype_string(kind)))
    if expected is ValueError:
        assert fails(decode)
    else:
        assert decode() == expected


def test_record_text(spark):
    df = spark.createDataFrame([("buy", "s1", None, 'a"b', 5, -1)], BUY.wire.struct)
    text = df.select(record_text(BUY.wire)).first()[0]
    assert text == '{"event": "buy", "sessionId": "s1", "timestamp": null, "itemId": "a\\"b", "price": 5, "quantity": -1}'


def test_record_text_like_the_avro_library(spark):
    avro = spark.sparkContext._jvm.org.apache.avro
    schema = getattr(avro, "Schema$Parser")().parse(CLICK.wire.avro_json)
    values = ["plain", 'q"b\\s\b\f\n\r\t', "\x00\x01\x1f\x7f\x9f–\u20ff℀é😀", "", None, "/x'\\u0041"]
    expected = []
    for value in values:
        row = getattr(avro.generic, "GenericData$Record")(schema)
        for name in CLICK.wire.names:
            row.put(name, value)
        expected.append(row.toString())
    df = spark.createDataFrame([(v,) * len(CLICK.wire.names) for v in values], CLICK.wire.struct).coalesce(1)
    got = df.select(record_text(CLICK.wire)).collect()
    assert [r[0] for r in got] == expected
