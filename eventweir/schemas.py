"""Wire schemas, sink layouts and per-stream settings.

A stream is described once, by a :class:`StreamSpec`; every operator in the
package takes the spec (or its wire fields) as a parameter, so the three event
kinds share all code.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

SPARK_TYPES = {"string": T.StringType(), "int": T.IntegerType()}


@dataclass(frozen=True)
class WireField:
    """One field of a flat Avro record: a string or int, or a nullable one of those."""

    name: str
    type: str
    nullable: bool = False

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.type]

    @property
    def avro(self) -> dict:
        if self.nullable:
            return {"name": self.name, "type": ["null", self.type], "default": None}
        return {"name": self.name, "type": self.type}


@dataclass(frozen=True)
class WireSchema:
    """An ordered list of wire fields. The order is the Avro byte order."""

    name: str
    namespace: str
    fields: tuple[WireField, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields])

    @property
    def avro_json(self) -> str:
        return json.dumps(
            {
                "type": "record",
                "namespace": self.namespace,
                "name": self.name,
                "fields": [f.avro for f in self.fields],
            }
        )


def parse_avsc(text: str) -> WireSchema:
    """Build a wire schema from the JSON text of an ``.avsc`` record definition."""
    record = json.loads(text)
    if record.get("type") != "record":
        raise ValueError(f"expected an Avro record, got {record.get('type')!r}")
    fields = []
    for field in record["fields"]:
        branches = field["type"] if isinstance(field["type"], list) else [field["type"]]
        nullable = len(branches) == 2 and branches[0] == "null"
        if len(branches) != (2 if nullable else 1) or branches[-1] not in SPARK_TYPES:
            raise ValueError(f"unsupported type for field {field['name']}: {field['type']}")
        if field.get("default") is not None:
            raise ValueError(f"unsupported default for field {field['name']}: {field['default']!r}")
        fields.append(WireField(field["name"], branches[-1], nullable))
    return WireSchema(record["name"], record.get("namespace", ""), tuple(fields))


def read_avsc(spark: SparkSession, path: str) -> WireSchema:
    """Load one ``.avsc`` file from any file system Spark can read."""
    return parse_avsc(spark.read.text(path, wholetext=True).first()[0])


# The wire schemas of the three topics, in byte order.
BUY_WIRE = WireSchema(
    "BuyEvent",
    "com.events",
    (
        WireField("event", "string", True),
        WireField("sessionId", "string", True),
        WireField("timestamp", "string", True),
        WireField("itemId", "string", True),
        WireField("price", "int", False),
        WireField("quantity", "int", False),
    ),
)
CLICK_WIRE = WireSchema(
    "ClickEvent",
    "com.events",
    (
        WireField("event", "string", True),
        WireField("sessionId", "string", True),
        WireField("timestamp", "string", True),
        WireField("category", "string", True),
        WireField("itemId", "string", True),
    ),
)
TOPUP_WIRE = WireSchema(
    "TopupEvent",
    "com.events",
    (
        WireField("createdAt", "string", False),
        WireField("updatedAt", "string", False),
        WireField("id", "string", False),
        WireField("code", "string", False),
        WireField("description", "string", False),
        WireField("phoneNumber", "string", False),
        WireField("partnerTransId", "string", False),
        WireField("supplierTransId", "string", True),
        WireField("jobId", "string", True),
        WireField("isPostpaid", "int", False),
        WireField("totalAmount", "int", False),
        WireField("discountRate", "int", False),
        WireField("beforeCredit", "int", False),
        WireField("afterCredit", "int", False),
        WireField("ip", "string", False),
        WireField("type", "int", False),
        WireField("status", "int", False),
        WireField("supplier", "string", False),
        WireField("mobileData", "string", False),
        WireField("merchantUser", "string", False),
        WireField("merchantSubscription", "string", False),
    ),
)

# Fixed value: the most characters a VARCHAR sink column holds.
VARCHAR_LIMIT = 255


@dataclass(frozen=True)
class SinkColumn:
    wire: str
    name: str
    type: str  # "string" (VARCHAR), "text" (unlimited) or "int"

    @property
    def limit(self) -> int | None:
        return VARCHAR_LIMIT if self.type == "string" else None

    def ddl(self, text_type: str) -> str:
        types = {"string": f"VARCHAR({VARCHAR_LIMIT})", "text": text_type, "int": "INT"}
        return f"{self.name} {types[self.type]}"


def snake_case(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


@dataclass(frozen=True)
class StreamSpec:
    """Everything that differs between the event kinds."""

    kind: str
    topic: str
    group: str
    query_name: str
    table: str
    wire: WireSchema
    key: str
    columns: tuple[SinkColumn, ...]
    tag: str | None = None  # value of the constant ``event`` column, if the kind has one
    zero_filled: tuple[str, ...] = ()  # int fields where a null reads as 0

    @property
    def sink_names(self) -> list[str]:
        return [c.name for c in self.columns]


def _columns(wire: WireSchema, order: list[str], unlimited: tuple[str, ...] = ()) -> tuple[SinkColumn, ...]:
    types = {f.name: f.type for f in wire.fields}
    return tuple(SinkColumn(n, snake_case(n), "text" if n in unlimited else types[n]) for n in order)


# Topics, consumer groups, tables, filter keys and sink column order.
CLICK = StreamSpec(
    kind="click",
    topic="click_events",
    group="Click-group",
    query_name="Click Events",
    table="click_events",
    wire=CLICK_WIRE,
    key="sessionId",
    columns=_columns(CLICK_WIRE, ["sessionId", "timestamp", "itemId", "category"]),
    tag="click",
)
BUY = StreamSpec(
    kind="buy",
    topic="buy_events",
    group="Buy-group",
    query_name="Buy Events",
    table="buy_events",
    wire=BUY_WIRE,
    key="sessionId",
    columns=_columns(BUY_WIRE, ["sessionId", "timestamp", "itemId", "price", "quantity"]),
    tag="buy",
    zero_filled=("price", "quantity"),
)
TOPUP = StreamSpec(
    kind="topup",
    topic="topup_events",
    group="Topup-group",
    query_name="Topup Events",
    table="topup_events",
    wire=TOPUP_WIRE,
    key="phoneNumber",
    columns=_columns(TOPUP_WIRE, TOPUP_WIRE.names, unlimited=("description",)),
)

# In round-robin publishing order.
STREAMS = {spec.kind: spec for spec in (CLICK, BUY, TOPUP)}

# The columns Spark's Kafka source yields; a topic log has the same ones.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)
