"""The JDBC sink is tested without a database: its SQL, its options and its retries."""

import os
import sys

import pytest
from pyspark import cloudpickle
from samples import BUY_1, CLICK_1

from eventweir.functions.text import int_sql
from eventweir.operators.records import project_sink
from eventweir.schemas import BUY, CLICK, TOPUP
from eventweir.sinks import jdbc
from eventweir.sinks import ledger as ledgers
from eventweir.sinks.flushes import DbApiConnection, FlushSink, flushes
from eventweir.sinks.jdbc import JdbcSink
from eventweir.sinks.ledger import OffsetLedger, joined
from eventweir.sinks.retry import with_retries
from eventweir.sinks.tables import CatalogTableSink, FileTableSink

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # stand-ins run in tasks


def test_create_table_sql():
    sink = JdbcSink("jdbc:postgresql://db/x")
    assert sink.create_sql(BUY) == (
        "CREATE TABLE IF NOT EXISTS buy_events (idx SERIAL PRIMARY KEY, session_id VARCHAR(255), "
        "timestamp VARCHAR(255), item_id VARCHAR(255), price INT, quantity INT)"
    )
    assert sink.create_sql(CLICK) == (
        "CREATE TABLE IF NOT EXISTS click_events (idx SERIAL PRIMARY KEY, session_id VARCHAR(255), "
        "timestamp VARCHAR(255), item_id VARCHAR(255), category VARCHAR(255))"
    )
    topup = sink.create_sql(TOPUP)
    assert topup.count("VARCHAR(255)") == 13 and topup.count(" INT") == 7 and "description TEXT" in topup


def test_writer_options():
    sink = JdbcSink("jdbc:x", user="u", password="p", max_connections=16)
    assert sink.writer_options(BUY) == {
        "url": "jdbc:x", "dbtable": "buy_events", "driver": "org.postgresql.Driver", "user": "u", "password": "p",
        "batchsize": "1000", "numPartitions": "16",
    }
    assert "p" not in repr(JdbcSink("jdbc:x", password="p")).replace("JdbcSink", "")
    assert sink.retries == 5


def test_settings_from_conf(spark):
    with pytest.raises(ValueError, match="jdbc.url"):
        JdbcSink.from_conf(spark)
    spark.conf.set("spark.eventweir.jdbc.url", "jdbc:y")
    spark.conf.set("spark.eventweir.jdbc.user", "u")
    try:
        assert JdbcSink.from_conf(spark, batch_size=10) == JdbcSink("jdbc:y", user="u", batch_size=10)
    finally:
        spark.conf.unset("spark.eventweir.jdbc.url")
        spark.conf.unset("spark.eventweir.jdbc.user")


class FakeRows:
    """Stands in for a DataFrame whose write fails a number of times."""

    def __init__(self, failures=0):
        self.failures, self.saves, self.settings = failures, 0, {}
        self.write = self

    def format(self, name):
        self.settings["format"] = name
        return self

    def options(self, **options):
        self.settings.update(options)
        return self

    def mode(self, mode):
        self.settings["mode"] = mode
        return self

    def save(self):
        self.saves += 1
        if self.saves <= self.failures:
            raise ConnectionError("lost")


@pytest.fixture(autouse=True)
def no_pauses(monkeypatch):
    monkeypatch.setattr("eventweir.sinks.retry.time.sleep", lambda seconds: None)


def test_append(monkeypatch):
    rows = FakeRows(failures=5)
    JdbcSink("jdbc:x").write(rows, CLICK, 0)
    assert rows.saves == 6
    assert rows.settings["format"] == "jdbc" and rows.settings["mode"] == "append"
    assert rows.settings["dbtable"] == "click_events"
    broken = FakeRows(failures=6)
    with pytest.raises(ConnectionError):
        JdbcSink("jdbc:x").write(broken, CLICK, 0)
    assert broken.saves == 6


def test_ensure_runs_the_ddl_once(monkeypatch):
    statements = []
    monkeypatch.setattr(jdbc.JdbcSink, "_execute", lambda self, spark, sql: statements.append(sql))
    sink = JdbcSink("jdbc:x")
    sink.ensure(None, BUY)
    assert statements == [sink.create_sql(BUY)]


def test_missing_driver_is_an_error(spark, fails):
    sink = JdbcSink("jdbc:nothing:x", driver="no.such.Driver", retries=0)
    assert "no.such.Driver" in fails(lambda: sink.ensure(spark, BUY))
    # With a class that is there, DriverManager is asked, and has no driver for the URL.
    sink = JdbcSink("jdbc:nothing:x", user="u", password="p", driver="java.lang.String", retries=0)
    assert "No suitable driver" in fails(lambda: sink.ensure(spark, BUY))


def test_with_retries_stops_at_success():
    calls = []
    with_retries(lambda: calls.append(1), retries=3)
    assert calls == [1]


def sink_frame(spark, spec, *records):
    return project_sink(spark.createDataFrame(list(records), spec.wire.struct), spec)


def test_file_table_batch_is_idempotent(spark, tmp_path):
    sink = FileTableSink(str(tmp_path))
    sink.ensure(spark, CLICK)
    sink.ensure(spark, CLICK)
    rows = sink_frame(spark, CLICK, CLICK_1, CLICK_1)
    sink.write(rows, CLICK, 0)
    sink.write(rows, CLICK, 0)
    assert sink.read(spark, CLICK).count() == 2
    sink.write(rows, CLICK, 1)
    assert sink.read(spark, CLICK).count() == 4


def test_catalog_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    sink = CatalogTableSink("sinks")
    sink.ensure(spark, BUY)
    sink.ensure(spark, BUY)
    sink.write(sink_frame(spark, BUY, BUY_1), BUY, 0)
    sink.write(sink_frame(spark, BUY, {**BUY_1, "price": 9}), BUY, 1)
    rows = sink.read(spark, BUY)
    assert rows.columns == BUY.sink_names
    assert sorted(r.price for r in rows.collect()) == [5, 9]
    spark.sql("DROP DATABASE sinks CASCADE")


def test_catalog_table_keeps_the_length_limit(spark, fails):
    spark.sql("CREATE DATABASE IF NOT EXISTS limits")
    sink = CatalogTableSink("limits")
    sink.ensure(spark, CLICK)
    long = spark.createDataFrame([("x" * 256, "t", "i", "c")]).toDF(*CLICK.sink_names)
    assert "LIMIT_LENGTH" in fails(lambda: sink.write(long, CLICK, 0))
    spark.sql("DROP DATABASE limits CASCADE")


def test_bad_data_is_not_retried():
    calls = []

    def poison():
        calls.append(1)
        raise ValueError("Exceeds char/varchar type length limitation: 255")

    with pytest.raises(ValueError):
        with_retries(poison, retries=5)
    assert calls == [1]


def tried(error, retries=2):
    calls = []

    def lost():
        calls.append(1)
        raise error

    with pytest.raises(type(error)):
        with_retries(lost, retries=retries, pause=0)
    return len(calls)


class FromJvm(Exception):
    """Like an error of PySpark, with the JVM's exception behind it."""

    def __init__(self, origin):
        super().__init__("Job aborted")
        self._origin = origin


def test_broken_connections_are_retried(spark):
    java = spark._jvm.java
    lost = [
        java.sql.SQLTransientConnectionException("x"),
        java.net.ConnectException("x"),
        java.sql.SQLException("x", "08006"),
        java.sql.BatchUpdateException("x", "40001", spark.sparkContext._gateway.new_array(spark._jvm.int, 0)),
    ]
    for error in [*map(FromJvm, lost), *[FromJvm(java.lang.RuntimeException("Task failed", e)) for e in lost]]:
        assert tried(error) == 3
    assert tried(ConnectionResetError("x")) == 3 and tried(TimeoutError()) == 3
    coded = ValueError("x")
    coded.sqlstate = "57P01"
    assert tried(coded) == 3


def test_an_errors_text_decides_nothing(spark):
    java = spark._jvm.java
    texts = ["SQLState: 08006", "java.net.ConnectException: refused", "connection refused", "SQLTransientConnectionException", "deadlock detected"]
    for text in texts:
        assert tried(RuntimeError(text)) == 1 and tried(FromJvm(java.lang.IllegalStateException(text))) == 1
    assert tried(FromJvm(java.sql.SQLException("connection refused", "22001"))) == 1


def test_a_poison_cell_is_tried_once(spark):
    """A cell that reads like a lost connection, and the number it should have been."""
    rows = spark.createDataFrame([("connection refused, SQLState 08006",)], "n string").selectExpr(int_sql("n", "n"))
    calls = []

    def write():
        calls.append(1)
        rows.write.format("noop").mode("overwrite").save()

    with pytest.raises(Exception, match="connection refused"):
        with_retries(write, retries=5, pause=0)
    assert calls == [1]


def test_all_settings_from_conf(spark):
    settings = {"url": "jdbc:y", "batch_size": "10", "retries": "2", "max_connections": "3"}
    for name, value in settings.items():
        spark.conf.set(f"spark.eventweir.jdbc.{name}", value)
    try:
        assert JdbcSink.from_conf(spark) == JdbcSink("jdbc:y", batch_size=10, retries=2, max_connections=3)
    finally:
        for name in settings:
            spark.conf.unset(f"spark.eventweir.jdbc.{name}")


def test_catalog_columns_are_matched_by_name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS named")
    spark.sql("CREATE TABLE named.click_events (session_id STRING, timestamp STRING, category STRING, item_id STRING) USING parquet")
    sink = CatalogTableSink("named")
    sink.ensure(spark, CLICK)
    rows = sink_frame(spark, CLICK, CLICK_1)
    sink.write(rows, CLICK, 0, "q")
    assert sink.read(spark, CLICK).first() == rows.first()
    with pytest.raises(ValueError, match="columns"):
        sink.write(rows.drop("category"), CLICK, 1, "q")
    spark.sql("DROP DATABASE named CASCADE")


def test_catalog_batch_is_idempotent_and_keyed(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keyed")
    sink = CatalogTableSink("keyed", keyed=True)
    sink.ensure(spark, BUY)
    rows = sink_frame(spark, BUY, BUY_1).selectExpr("*", "'t' as topic", "0 as partition", "7L as offset")
    for run, batch in (("q", 0), ("q", 0), ("q", 1), ("r", 0)):
        sink.write(rows, BUY, batch, run)
    assert sink.read(spark, BUY).count() == 3 and sink.read(spark, BUY).columns[:3] == ["topic", "partition", "offset"]
    spark.sql("DROP DATABASE keyed CASCADE")


def place(rows, first, topic="t"):
    """Rows with topic, partition 0 and offsets from ``first`` on."""
    numbered = [(*r, topic, 0, first + i) for i, r in enumerate(rows.collect())]
    return rows.sparkSession.createDataFrame(numbered, rows.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", topic string, partition int, offset bigint")


@pytest.fixture
def foreign(spark, tmp_path):
    """A table that was there before, without batch columns, and a sink with a ledger."""
    spark.sql("CREATE DATABASE IF NOT EXISTS foreign_tables")
    spark.sql("CREATE TABLE foreign_tables.buy_events (price INT, session_id STRING, timestamp STRING, item_id STRING, quantity INT) USING parquet")
    yield CatalogTableSink("foreign_tables", ledger=str(tmp_path / "ledger"))
    spark.sql("DROP DATABASE foreign_tables CASCADE")


def buys(spark, *prices):
    return sink_frame(spark, BUY, *[{**BUY_1, "price": p} for p in prices])


def prices(sink, spark):
    return sorted(r["price"] for r in sink.read(spark, BUY).collect())


def test_a_repeated_batch_adds_nothing_to_a_foreign_table(spark, foreign):
    foreign.ensure(spark, BUY)
    first, second = place(buys(spark, 1, 1, 2), 0), place(buys(spark, 3, 4), 3)
    for rows, batch, run in ((first, 0, "q"), (first, 0, "q"), (second, 1, "q"), (first, 0, "other"), (first.unionByName(second), 7, "third")):
        foreign.write(rows, BUY, batch, run)
    assert prices(foreign, spark) == [1, 1, 2, 3, 4]
    foreign.write(place(buys(spark, 1), 0, topic="u"), BUY, 2, "q")  # another topic's offsets
    foreign.write(place(buys(spark, 9, 8, 7), 4), BUY, 3, "q")  # one of them taken in before
    assert prices(foreign, spark) == [1, 1, 1, 2, 3, 4, 7, 8]


@pytest.mark.parametrize("inserted", [False, True])
def test_a_batch_in_doubt_is_settled_by_the_tables_files(spark, foreign, monkeypatch, inserted):
    """A crash before or after the insert, before the commit; meanwhile others write too."""
    foreign.ensure(spark, BUY)
    rows = place(buys(spark, 1, 2), 0)

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(OffsetLedger, "commit" if inserted else "unseen", crash)
        with pytest.raises(KeyboardInterrupt):
            foreign.write(rows, BUY, 0, "q")
    buys(spark, 50, 60).select("price", "session_id", "timestamp", "item_id", "quantity").write.insertInto("foreign_tables.buy_events")
    foreign.write(rows, BUY, 0, "q")
    assert prices(foreign, spark) == [1, 2, 50, 60]
    foreign.write(rows, BUY, 0, "q")
    assert prices(foreign, spark) == [1, 2, 50, 60]


def test_neighbouring_intervals_become_one(spark):
    rows = [("t", 0, 0, 4), ("t", 0, 5, 9), ("t", 0, 12, 13), ("t", 1, 10, 11), ("t", 0, 2, 3), ("u", 0, 14, 20), ("t", 0, 13, 15)]
    found = joined(spark.createDataFrame(rows, "topic string, partition int, first bigint, last bigint"))
    assert sorted(tuple(r) for r in found.collect()) == [("t", 0, 0, 9), ("t", 0, 12, 15), ("t", 1, 10, 11), ("u", 0, 14, 20)]


def test_a_ledger_stays_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledgers, "SNAPSHOT", 3)
    ledger = OffsetLedger(str(tmp_path))
    for at in range(5):
        ledger.commit(spark, "x", spark.createDataFrame([("t", 0, at * 10, at * 10 + 9)], "topic string, partition int, first bigint, last bigint"))
    found = sorted((r["first"], r["last"]) for r in ledger.committed(spark, "x").collect())
    assert found == [(0, 39), (40, 49)]


class Shelf:
    """A stand-in for a table: each flush is a file, there or not. ``faults`` names, by the call's
    number, what goes wrong; calls are counted in a file, as each task has its own stand-in."""

    def __init__(self, folder, faults):
        self.folder, self.faults = folder, faults

    def _call(self):
        with open(f"{self.folder}/calls", "a+") as f:
            f.write("x")
            f.flush()
            return os.path.getsize(f"{self.folder}/calls")

    def _path(self, flush_id):
        return f"{self.folder}/{flush_id.replace('/', '+')}.flush"

    def has(self, flush_id):
        return os.path.exists(self._path(flush_id))

    def store(self, flush_id, rows):
        fault = self.faults.get(self._call())
        if fault == "bad":
            raise ValueError("connection refused")
        if fault == "lost":
            raise ConnectionResetError("gone")
        with open(self._path(flush_id), "x") as f:  # a second store of a flush fails
            f.write("\n".join(map(str, rows)))
        if fault == "answer lost":
            raise ConnectionResetError("gone after the commit")

    def close(self):
        pass


def shelved(folder):
    return {name: open(f"{folder}/{name}").read().splitlines() for name in sorted(os.listdir(folder)) if name.endswith(".flush")}


def flush_sink(folder, **faults):
    by_call = {int(k[1:]): v for k, v in faults.items()}
    return FlushSink(lambda spec: Shelf(folder, by_call), retries=2, pause=0)


@pytest.mark.parametrize("fault", ["lost", "answer lost"])
def test_only_the_failed_flush_is_tried_again(spark, tmp_path, fault):
    folder = str(tmp_path)
    sink = flush_sink(folder, c3=fault)
    sink.ensure(spark, BUY)
    rows = spark.range(0, 3500, 1, 1)
    sink.write(rows, BUY, 4, "q")
    stored = shelved(folder)
    assert [len(v) for v in stored.values()] == [1000, 1000, 1000, 500]
    assert [line for v in stored.values() for line in v] == [f"({i},)" for i in range(3500)]
    assert os.path.getsize(f"{folder}/calls") == (5 if fault == "lost" else 4)
    sink.write(rows, BUY, 4, "q")  # the micro-batch once more: every flush is there
    assert shelved(folder) == stored and os.path.getsize(f"{folder}/calls") == (5 if fault == "lost" else 4)
    sink.write(rows, BUY, 5, "q")
    assert len(shelved(folder)) == 8


def test_flushes_before_a_bad_one_are_kept_and_not_repeated(spark, tmp_path, fails):
    folder = str(tmp_path)
    sink = flush_sink(folder, c3="bad")
    sink.ensure(spark, BUY)
    rows = spark.range(0, 3500, 1, 1)
    assert "connection refused" in fails(lambda: sink.write(rows, BUY, 0, "q"))
    assert len(shelved(folder)) == 2 and os.path.getsize(f"{folder}/calls") == 3  # a bad value is tried once
    sink.write(rows, BUY, 0, "q")
    assert [len(v) for v in shelved(folder).values()] == [1000, 1000, 1000, 500] and os.path.getsize(f"{folder}/calls") == 5


def test_a_stream_writes_in_flushes(spark, tmp_path):
    folder, rows = tmp_path / "shelf", tmp_path / "rows"
    folder.mkdir()
    for _ in range(2):
        spark.range(0, 1500, 1, 1).write.mode("append").parquet(str(rows))
    sink = flush_sink(str(folder), c2="lost")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(rows))
    sink.stream(stream, BUY, str(tmp_path / "checkpoint"), "q").trigger(availableNow=True).start().awaitTermination()
    stored = shelved(str(folder))
    assert sorted(len(v) for v in stored.values()) == [500, 500, 1000, 1000] and {n.split("+")[2] for n in stored} == {"0", "1"}


def test_flushes_are_cut_by_rows_and_time():
    times = iter([0.0, 0.1, 0.15, 1.0, 1.1, 1.5, 2.0])  # since a flush began, and at each row after
    found = list(flushes([(i,) for i in range(5)], 3, 0.2, lambda: next(times)))
    assert found == [[(0,), (1,), (2,)], [(3,), (4,)]]
    times = iter([0.0, 0.1, 0.5, 0.5, 0.6])
    assert list(flushes([(i,) for i in range(4)], 9, 0.2, lambda: next(times))) == [[(0,), (1,)], [(2,), (3,)]]
    assert [len(f) for f in flushes(((i,) for i in range(2500)), 1000, 99)] == [1000, 1000, 500] and list(flushes([], 3)) == []


class Statements:
    """A stand-in for a PEP 249 connection that notes what it is told."""

    def __init__(self, fail=False):
        self.told, self.fail = [], fail

    def cursor(self):
        return self

    def execute(self, sql, values):
        self.told.append((sql, values))

    def executemany(self, sql, rows):
        if self.fail:
            raise ValueError("bad")
        self.told.append((sql, len(rows)))

    def fetchone(self):
        return None

    def commit(self):
        self.told.append("commit")

    def rollback(self):
        self.told.append("rollback")

    def close(self):
        self.told.append("close")


def test_rows_and_receipt_share_a_transaction():
    base = Statements()
    connection = DbApiConnection(base, "t", ["a", "b"])
    assert not connection.has("q/0/0/0")
    connection.store("q/0/0/0", [(1, 2), (3, 4)])
    connection.close()
    assert base.told == [
        ("SELECT 1 FROM flush_receipts WHERE flush_id = %s", ("q/0/0/0",)),
        ("INSERT INTO flush_receipts (flush_id) VALUES (%s)", ("q/0/0/0",)),
        ("INSERT INTO t (a, b) VALUES (%s, %s)", 2),
        "commit",
        "close",
    ]
    base = Statements(fail=True)
    with pytest.raises(ValueError):
        DbApiConnection(base, "t", ["a"]).store("f", [(1,)])
    assert base.told[-1] == "rollback"
