import pytest
from pyspark.sql import functions as F
from samples import BUY_1, CLICK_1, TOPUP_1

from eventweir.plans.publish import read_event_files, to_messages
from eventweir.plans.replay import ROW, IndexedTable, index_rows, interleaved, replay_first
from eventweir.plans.scratch import scratch_dir
from eventweir.schemas import BUY, CLICK, STREAMS


def indexed(spark, df, order_by="seq"):
    return index_rows(df, scratch_dir(spark, "index"), order_by)


@pytest.mark.parametrize("n", [1, 7, 5000])
def test_index_is_dense_and_in_order(spark, n):
    shuffled = spark.range(n).select((F.col("id") * 3 - 100).alias("seq")).repartition(5)
    table = indexed(spark, shuffled)
    rows = table.rows.orderBy(ROW).collect()
    assert table.size == n
    assert [r[ROW] for r in rows] == list(range(n))
    assert [r.seq for r in rows] == [i * 3 - 100 for i in range(n)]


def test_index_of_an_uneven_sequence(spark):
    """A third of the sequence numbers lie close together, far from the rest."""
    near, far = list(range(1000)), [10**12 + i * 10**6 for i in range(2000)]
    table = indexed(spark, spark.createDataFrame([(v,) for v in near + far], "seq long").repartition(3))
    assert [r.seq for r in table.rows.orderBy(ROW).collect()] == near + far


def test_empty_table(spark):
    with pytest.raises(ValueError, match="empty"):
        indexed(spark, spark.createDataFrame([], "seq long"))


def brute_force(tables, n):
    """Kinds take turns; each goes through its table again and again."""
    return [(kind, rows[(t // len(tables)) % len(rows)]) for t in range(n) for kind, rows in [list(tables.items())[t % len(tables)]]]


VALUES = {"click": ["c0", "c1"], "buy": ["b0", "b1", "b2", "b3", "b4"], "topup": ["t0"]}


@pytest.fixture(scope="module")
def tables(spark):
    frames = {k: spark.createDataFrame(list(enumerate(rows)), "seq int, v string") for k, rows in VALUES.items()}
    return {kind: indexed(spark, df) for kind, df in frames.items()}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40, 41])
@pytest.mark.parametrize("way", ["one step", "small steps"])
def test_replay_against_brute_force(spark, tables, monkeypatch, way, n):
    monkeypatch.setattr("eventweir.plans.replay.STEP", 3 if way == "small steps" else 1024)
    played = replay_first(spark, tables, n)
    rows = interleaved(played).orderBy("tick").collect()
    topics = {s.topic: k for k, s in STREAMS.items()}
    assert [r.tick for r in rows] == list(range(n))
    assert [(topics[r.topic], r.v) for r in rows] == brute_force(VALUES, n)


def test_index_in_reading_order(spark, tmp_path):
    (tmp_path / "c.csv").write_text("".join(f"s{i},t,i,c\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4kb")
    try:
        records = read_event_files(spark, {"click": str(tmp_path / "c.csv")})["click"]
        assert records.rdd.getNumPartitions() > 2
        table = index_rows(records, scratch_dir(spark, "index"))
        assert [r.sessionId for r in table.rows.orderBy(ROW).collect()] == [f"s{i}" for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def sparse(spark, rows, size):
    return {"click": IndexedTable(spark.createDataFrame([(r, f"v{r}") for r in rows], f"{ROW} long, v string").coalesce(1), size)}


def test_replay_counts_beyond_32_bits(spark):
    last = 10**9 - 1
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            ticks = replay_first(spark, sparse(spark, [2, last], 10**9), 4 * 10**9)["click"].select("tick").collect()
            assert [r.tick for r in ticks] == [c * 10**9 + r for c in range(4) for r in (2, last)]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_a_small_table_is_replayed_by_many_tasks_in_tick_order(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        played = replay_first(spark, sparse(spark, [0, 1], 2), 20_000)["click"].select("tick")
        parts = [p for p in played.rdd.map(lambda r: r.tick).glom().collect() if p]
        assert len(parts) > 1 and all(p == sorted(p) for p in parts)
        assert sorted(t for p in parts for t in p) == list(range(20_000))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_replay_order_does_not_depend_on_the_mapping(spark):
    table = IndexedTable(spark.createDataFrame([(0, "x")], f"{ROW} long, v string"), 1)
    played = replay_first(spark, {"topup": table, "buy": table, "click": table}, 3)
    assert [(k, df.first().tick) for k, df in played.items()] == [("click", 0), ("buy", 1), ("topup", 2)]


def test_messages_of_all_kinds(spark):
    samples = {"buy": BUY_1, "click": CLICK_1, "topup": TOPUP_1}
    records = {k: spark.createDataFrame([r], STREAMS[k].wire.struct) for k, r in samples.items()}
    rows = to_messages(records, {"click": 1, "buy": 2, "topup": 3}).collect()
    assert {r.topic: r.value[:5] for r in rows} == {
        "click_events": b"\0\0\0\0\1", "buy_events": b"\0\0\0\0\2", "topup_events": b"\0\0\0\0\3",
    }


def test_files_to_messages(spark, tmp_path):
    (tmp_path / "b.csv").write_text("s,t,i,1,2\n")
    (tmp_path / "c.csv").write_text("s,t,i,c\n")
    records = read_event_files(spark, {"buy": str(tmp_path / "b.csv"), "click": str(tmp_path / "c.csv")})
    assert records["buy"].columns == BUY.wire.names and records["click"].columns == CLICK.wire.names
    assert to_messages(records, {"buy": 1, "click": 1}).count() == 2


def test_scratch_dirs_are_new_and_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first != second and first.startswith(shared) and second.startswith(shared)
