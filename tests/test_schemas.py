import json

import pytest
from pyspark.sql import types as T

from eventweir.schemas import BUY, CLICK, STREAMS, TOPUP, parse_avsc, read_avsc


@pytest.mark.parametrize("spec", STREAMS.values(), ids=lambda s: s.kind)
def test_avsc_round_trip(spark, spec, tmp_path):
    path = tmp_path / f"{spec.topic}.avsc"
    path.write_text(json.dumps(json.loads(spec.wire.avro_json), indent=2))
    assert read_avsc(spark, str(path)) == spec.wire


def test_struct_keeps_wire_order_and_nullability():
    assert BUY.wire.struct == T.StructType(
        [
            T.StructField("event", T.StringType(), True),
            T.StructField("sessionId", T.StringType(), True),
            T.StructField("timestamp", T.StringType(), True),
            T.StructField("itemId", T.StringType(), True),
            T.StructField("price", T.IntegerType(), False),
            T.StructField("quantity", T.IntegerType(), False),
        ]
    )
    assert CLICK.wire.names == ["event", "sessionId", "timestamp", "category", "itemId"]
    assert len(TOPUP.wire.names) == 21
    assert [f.name for f in TOPUP.wire.fields if f.nullable] == ["supplierTransId", "jobId"]
    assert [f.name for f in TOPUP.wire.fields if f.type == "int"] == [
        "isPostpaid", "totalAmount", "discountRate", "beforeCredit", "afterCredit", "type", "status",
    ]


def test_sink_columns():
    assert BUY.sink_names == ["session_id", "timestamp", "item_id", "price", "quantity"]
    assert CLICK.sink_names == ["session_id", "timestamp", "item_id", "category"]
    assert TOPUP.sink_names == (
        "created_at updated_at id code description phone_number partner_trans_id supplier_trans_id job_id "
        "is_postpaid total_amount discount_rate before_credit after_credit ip type status supplier mobile_data "
        "merchant_user merchant_subscription"
    ).split()
    assert [c.name for c in TOPUP.columns if c.type == "text"] == ["description"]


def test_streams_in_publishing_order():
    assert list(STREAMS) == ["click", "buy", "topup"]


@pytest.mark.parametrize(
    "text",
    [
        '{"type": "enum", "name": "X", "symbols": []}',
        '{"type": "record", "name": "X", "fields": [{"name": "a", "type": "long"}]}',
        '{"type": "record", "name": "X", "fields": [{"name": "a", "type": ["string", "null"]}]}',
        '{"type": "record", "name": "X", "fields": [{"name": "a", "type": "int", "default": 5}]}',
    ],
)
def test_unsupported_schema(text):
    with pytest.raises(ValueError):
        parse_avsc(text)
