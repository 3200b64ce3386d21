"""The three event streams, derived row by row from the benchmark tables.

``events`` gives buy and click records, ``orders`` gives top-up records. Every record
keeps its source key (``event_id`` / ``o_orderkey``) beside the wire fields on request.
All of it is projection, so filters and column pruning reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.schemas import STREAMS

EVENT_TIME = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
ORDER_TIME = "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
SESSION = (
    "case when user_id % 10 = 0 then null when user_id % 10 = 1 then '' "
    "else concat('s', cast(user_id as string)) end"
)
ITEM = "regexp_extract(props, '\"k\": ([0-9]+)', 1)"

EVENT_FIELDS = {"sessionId": SESSION, "timestamp": EVENT_TIME, "itemId": ITEM}
FIELDS = {
    "buy": {
        "event": "'buy'",
        **EVENT_FIELDS,
        "price": "cast(floor(value * 100) as int)",
        "quantity": "cast(event_id % 5 + 1 as int)",
    },
    "click": {
        "event": "'click'",
        **EVENT_FIELDS,
        "category": "case when event_id % 4 = 0 then null else concat('c', cast(event_id % 12 as string)) end",
    },
    "topup": {
        "createdAt": ORDER_TIME,
        "updatedAt": ORDER_TIME,
        "id": "cast(o_orderkey as string)",
        "code": "concat('T', cast(o_orderkey as string))",
        "description": "concat('order ', o_orderpriority)",
        "phoneNumber": "case when o_custkey % 10 = 0 then '' "
        "else concat('09', lpad(cast(o_custkey as string), 8, '0')) end",
        "partnerTransId": "concat('P', cast(o_orderkey as string))",
        "supplierTransId": "case when o_orderkey % 3 = 0 then null else concat('S', cast(o_orderkey as string)) end",
        "jobId": "case when o_orderkey % 5 = 0 then null else concat('J', cast(o_orderkey as string)) end",
        "isPostpaid": "cast(o_orderkey % 2 as int)",
        "totalAmount": "cast(floor(o_totalprice) as int)",
        "discountRate": "cast(o_orderkey % 10 as int)",
        "beforeCredit": "cast(floor(o_totalprice) as int) + 1000",
        "afterCredit": "1000",
        "ip": "concat('10.0.0.', cast(o_custkey % 256 as string))",
        "type": "cast(o_orderkey % 4 as int)",
        "status": "case o_orderstatus when 'F' then 1 when 'O' then 0 else 2 end",
        "supplier": "concat('sup', cast(o_custkey % 7 as string))",
        "mobileData": "concat('m', cast(o_orderkey % 3 as string))",
        "merchantUser": "concat('u', cast(o_custkey as string))",
        "merchantSubscription": "concat('sub', cast(o_custkey % 11 as string))",
    },
}
SOURCES = {"buy": ("events", "purchase"), "click": ("events", "click"), "topup": ("orders", None)}
SOURCE_KEYS = {"buy": "event_id", "click": "event_id", "topup": "o_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, kind: str, keyed: bool = False) -> DataFrame:
    """Wire records of one kind; with ``keyed`` also the source key."""
    name, event_type = SOURCES[kind]
    df = table(spark, sf_dir, name)
    if event_type is not None:
        df = df.where(F.col("event_type") == event_type)
    keep = [SOURCE_KEYS[kind]] if keyed else []
    return df.selectExpr(*keep, *[f"{FIELDS[kind][n]} as `{n}`" for n in STREAMS[kind].wire.names])
