import pytest

from eventweir.__main__ import main, parser
from eventweir.operators.records import decode_records
from eventweir.schemas import BUY, CLICK, STREAMS, TOPUP
from eventweir.sinks.tables import FileTableSink
from eventweir.sinks.topics import publish_to_log
from eventweir.sources.topics import TopicLog
from eventweir.streaming.flows import AVAILABLE_NOW, await_all, read_quarantine, start_flow


@pytest.fixture
def files(tmp_path):
    (tmp_path / "click.csv").write_text("s1,t,i1,c1\n,t,i2,c2\n")
    (tmp_path / "buy.csv").write_text("".join(f"s{i},t,i,{i},1\n" for i in range(5)))
    names, row = TOPUP.wire.names, ["5" if f.type == "int" else f.name for f in TOPUP.wire.fields]
    (tmp_path / "topup.csv").write_text(f"{','.join(names)}\n{','.join(row)}\n")
    return [arg for kind in STREAMS for arg in (f"--{kind}", str(tmp_path / f"{kind}.csv"), f"--{kind}-schema-id", "4")]


def test_publish_then_etl(spark, tmp_path, files, capsys):
    log, tables = str(tmp_path / "log"), str(tmp_path / "tables")
    main(["publish", "--log", log, "--records", "14", *files])
    lines = capsys.readouterr().out.rstrip().split("\n")
    assert lines[:3] == [f"{t}_events: {n} messages delivered" for t, n in (("click", 5), ("buy", 5), ("topup", 4))]
    by_place = [line.split(" messages, offsets ") for line in lines[3:]]
    assert by_place and sum(int(place.split(": ")[1]) for place, _ in by_place) == 14
    topics = TopicLog(log)
    prices = sorted(r.price for r in decode_records(topics.batch(spark, BUY), BUY).collect())
    assert prices == [0, 1, 2, 3, 4]
    items = sorted(r.itemId for r in decode_records(topics.batch(spark, CLICK), CLICK).collect())
    assert items == ["i1", "i1", "i1", "i2", "i2"]
    assert topics.batch(spark, TOPUP).count() == 4

    etl = ["etl", "--log", log, "--starting-offsets", "earliest", "--tables", tables, "--once", "--source-option", "maxFilesPerTrigger=1"]
    main([*etl, "--checkpoints", str(tmp_path / "cp")])
    sink = FileTableSink(tables)
    assert {k: sink.read(spark, s).count() for k, s in STREAMS.items()} == {"click": 3, "buy": 5, "topup": 4}
    main([*etl, "--checkpoints", str(tmp_path / "cp"), "--print"])
    assert sink.read(spark, BUY).count() == 5


def test_tables_are_compacted(spark, tmp_path, files, capsys):
    log, tables = str(tmp_path / "log"), str(tmp_path / "tables")
    etl = ["etl", "--log", log, "--starting-offsets", "earliest", "--tables", tables, "--once", "--checkpoints", str(tmp_path / "cp")]
    for _ in range(2):
        main(["publish", "--log", log, "--records", "6", *files])
        main(etl)
    capsys.readouterr()
    main(["compact", "--tables", tables, "--retention-hours", "0"])
    lines = capsys.readouterr().out.rstrip().split("\n")
    assert lines == [f"{s.table}: packed, 1 directories removed" for s in STREAMS.values()]
    assert FileTableSink(tables).read(spark, BUY).count() == 4


def test_bad_payloads_are_put_aside(spark, tmp_path, files):
    log, folder = str(tmp_path / "log"), str(tmp_path / "bad")
    main(["publish", "--log", log, "--records", "6", *files])
    publish_to_log(spark.createDataFrame([(BUY.topic, b"bad")], "topic string, value binary"), log)
    main(["etl", "--log", log, "--starting-offsets", "earliest", "--tables", str(tmp_path / "t"), "--once", "--quarantine", folder, "--checkpoints", str(tmp_path / "cp")])
    assert FileTableSink(str(tmp_path / "t")).read(spark, BUY).count() == 2
    assert [bytes(r["value"]) for r in read_quarantine(spark, folder).collect()] == [b"bad"]


def test_flow_in_small_batches(spark, tmp_path, files):
    """Reading can be limited; the result is the same."""
    path, sink = str(tmp_path / "log"), FileTableSink(str(tmp_path / "tables"))
    for _ in range(3):
        main(["publish", "--log", path, "--records", "3", *files])
    log = TopicLog(path, "earliest", {"maxFilesPerTrigger": "1"})
    query = start_flow(spark, BUY, log, sink, str(tmp_path / "cp"), trigger=AVAILABLE_NOW)
    await_all([query])
    assert len(query.recentProgress) >= 3
    assert sink.read(spark, BUY).count() == 3


def test_arguments():
    with pytest.raises(SystemExit):
        parser().parse_args(["etl", "--log", "x", "--checkpoints", "c"])
    with pytest.raises(SystemExit):
        parser().parse_args(["etl", "--log", "x", "--bootstrap", "b", "--jdbc", "--checkpoints", "c"])
    with pytest.raises(SystemExit):
        parser().parse_args(["etl", "--log", "x", "--tables", "t", "--checkpoints", "c", "--source-option", "novalue"])
    assert parser().parse_args(["etl", "--bootstrap", "b", "--jdbc", "--checkpoints", "c"]).starting_offsets == "latest"
