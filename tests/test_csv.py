import csv
import random

import pytest
from samples import TOPUP_1

from eventweir.schemas import TOPUP
from eventweir.sources import csv_files
from eventweir.sources.csv_files import read_buy_csv, read_click_csv, read_topup_csv


def write(path, rows, row_end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=row_end).writerows(rows)
    return str(path)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def click(sid, ts, item, category):
    return dict(event="click", sessionId=sid, timestamp=ts, category=category, itemId=item)


CLICK_ROWS = [
    ["s1", "t1", "i1", "c1"],
    ["s2", "", "a,b", 'say "hi"'],
    ["", "", "", ""],
    ["é中", " t ", "\\", "x\\\"y"],
]


def test_click_file(spark, tmp_path):
    path = write(tmp_path / "c.csv", CLICK_ROWS)
    assert rows_of(read_click_csv(spark, path)) == [click(*r) for r in CLICK_ROWS]


@pytest.mark.parametrize("row_end", ["\n", "\r\n"])
@pytest.mark.parametrize("line_break", ["\n", "\r\n", "\r"])
def test_line_break_in_a_cell(spark, tmp_path, line_break, row_end):
    rows = [["s", f"one{line_break}two", '"', f"{line_break}last"], *CLICK_ROWS, [f"{line_break}", "", "é", "q"]]
    path = write(tmp_path / "c.csv", rows, row_end)
    assert rows_of(read_click_csv(spark, path)) == [click(*r) for r in rows]


@pytest.mark.parametrize("row_end", ["\n", "\r\n"])
def test_header_and_line_breaks(spark, tmp_path, row_end):
    records = [{**TOPUP_1, "description": "a\r\nb\nc"}, TOPUP_1]
    path = write(tmp_path / "t.csv", topup_rows(TOPUP.wire.names, *records), row_end)
    assert rows_of(read_topup_csv(spark, path)) == records


def test_quoted_empty_cell(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('s1,t,i,""\n"",t,,c\n')
    assert rows_of(read_click_csv(spark, str(path))) == [click("s1", "t", "i", ""), click("", "t", "", "c")]


@pytest.mark.parametrize("broken", [True, False])
@pytest.mark.parametrize("bad", ["s1,t,i", "s1,t,i,c,more", "s1"])
def test_wrong_number_of_cells(spark, fails, tmp_path, bad, broken):
    path = tmp_path / "c.csv"
    path.write_text(f"s0,t,i,{'"a\nb"' if broken else 'c'}\n{bad}\n")
    df = read_click_csv(spark, str(path))
    assert fails(df.collect)
    assert fails(df.select("sessionId").collect), "also when only some columns are read"


def test_buy_file(spark, fails, tmp_path):
    path = write(tmp_path / "b.csv", [["s", "t", "i", " 5 ", "-2"], ["", "", "", "0", "2147483647"]])
    assert rows_of(read_buy_csv(spark, path)) == [
        dict(event="buy", sessionId="s", timestamp="t", itemId="i", price=5, quantity=-2),
        dict(event="buy", sessionId="", timestamp="", itemId="", price=0, quantity=2147483647),
    ]
    for bad in ["1.5", "9999999999", "", "x"]:
        df = read_buy_csv(spark, write(tmp_path / "bad.csv", [["s", "t", "i", bad, "1"]]))
        assert "price: not an int" in fails(df.collect)


def topup_rows(names, *records):
    return [names, *[[r.get(n, "?") if r.get(n) is not None else "" for n in names] for r in records]]


def test_topup_file_is_read_by_name(spark, tmp_path):
    names = ["unknown", *reversed(TOPUP.wire.names)]
    path = write(tmp_path / "t.csv", topup_rows(names, TOPUP_1, {**TOPUP_1, "description": "a\nb", "phoneNumber": ""}))
    assert rows_of(read_topup_csv(spark, path)) == [TOPUP_1, {**TOPUP_1, "description": "a\nb", "phoneNumber": ""}]


def test_topup_nullable_columns_may_be_missing(spark, tmp_path):
    names = [n for n in TOPUP.wire.names if n not in ("supplierTransId", "jobId")]
    path = write(tmp_path / "t.csv", topup_rows(names, TOPUP_1))
    assert rows_of(read_topup_csv(spark, path)) == [{**TOPUP_1, "jobId": None}]


def test_topup_other_columns_may_not_be_missing(spark, tmp_path):
    names = [n for n in TOPUP.wire.names if n != "ip"]
    with pytest.raises(ValueError, match="ip"):
        read_topup_csv(spark, write(tmp_path / "t.csv", topup_rows(names, TOPUP_1)))


def test_topup_files_with_different_headers(spark, fails, tmp_path):
    write(tmp_path / "a.csv", topup_rows(TOPUP.wire.names, TOPUP_1))
    write(tmp_path / "b.csv", topup_rows(list(reversed(TOPUP.wire.names)), TOPUP_1))
    assert fails(read_topup_csv(spark, str(tmp_path)).collect)
    write(tmp_path / "b.csv", topup_rows(TOPUP.wire.names, TOPUP_1))
    assert rows_of(read_topup_csv(spark, str(tmp_path))) == [TOPUP_1, TOPUP_1]


def test_topup_short_row(spark, fails, tmp_path):
    rows = topup_rows(TOPUP.wire.names, TOPUP_1)
    path = write(tmp_path / "t.csv", [rows[0], rows[1][:-1]])
    assert fails(read_topup_csv(spark, path).collect)


def test_file_without_line_breaks_in_cells_is_split(spark, tmp_path):
    path = write(tmp_path / "c.csv", [[f"s{i}", "t", "i", "c"] for i in range(2000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8kb")
    try:
        df = read_click_csv(spark, path)
        assert df.rdd.getNumPartitions() > 1
        assert sorted(r.sessionId for r in df.collect()) == sorted(f"s{i}" for i in range(2000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4kb")
    spark.conf.set("spark.sql.files.openCostInBytes", "1kb")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_cells_that_go_on_over_many_splits(spark, tmp_path, small_splits):
    """Rows end anywhere in a split, or span several; order and line breaks are kept."""
    rows = [[f"s{i}", "t", f"line {i}\n" * (i * 37 % 50) + 'say "x",\r\n', "c" * (5000 if i % 60 == 7 else i % 9)] for i in range(300)]
    rows[50][2] = ("long\n" * 4000) + '"'
    (tmp_path / "d").mkdir()
    write(tmp_path / "d" / "a.csv", rows)
    write(tmp_path / "d" / "b.csv", [["x", "y", "z", "q"]] * 500, "\n")
    df = read_click_csv(spark, str(tmp_path / "d"))
    assert rows_of(df) == [click(*r) for r in [*rows, *[["x", "y", "z", "q"]] * 500]]


def test_a_stray_quote_is_text_and_keeps_the_splits(spark, tmp_path, small_splits):
    path = tmp_path / "c.csv"
    path.write_text("".join(f"s{i},t,i{i},{'5' + chr(34) + ' disk' if i == 900 else 'c'}\n" for i in range(3000)))
    df = read_click_csv(spark, str(path))
    assert df.rdd.getNumPartitions() >= path.stat().st_size // 4096
    assert [r.itemId for r in df.collect()] == [f"i{i}" for i in range(3000)]
    assert df.where("sessionId = 's900'").first().category == '5" disk'


def test_malformed_utf8_fails(spark, fails, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes(b"s,t,\xff,c\n")
    assert "UTF" in fails(lambda: read_click_csv(spark, str(path)).collect())


def test_states_of_many_splits_follow_block_by_block(spark):
    """Equal to following them one by one, with blocks of few and of many splits."""
    rng = random.Random(7)
    splits = [("f", at * 10, rng.random() < 0.3, rng.random() < 0.5, rng.random() < 0.6) for at in range(100_000)]
    splits += [("g", at * 10, False, True, False) for at in range(5)]
    want, opened, owner, file = {}, False, -1, None
    for name, start, out, in_, leaves in splits:
        if name != file:
            file, opened, owner = name, False, -1
        ends = in_ if opened else out
        want[name, start] = (opened, owner, ends, not opened and not out)
        owner = owner if opened and not leaves else start
        opened = ends
    rows = spark.createDataFrame(splits, "file string, start bigint, o boolean, i boolean, leaves boolean").selectExpr(
        "file", "start", "10L as length", "named_struct('open', o, 'owner', start, 'was_open', o) as from_out",
        "named_struct('open', i, 'owner', if(leaves, start, null), 'was_open', true) as from_in",
    )
    got = {(r.file, r.start): (r.opened, r.owner, r.ends_open, r.whole) for r in csv_files._followed(rows).collect()}
    assert got == want
    few = rows.where("start < 3000")
    assert {(r.file, r.start): r.opened for r in csv_files._followed(few, fan=3).collect()} == {k: v[0] for k, v in want.items() if k[1] < 3000}


def test_a_cell_that_does_not_close_is_named(spark, tmp_path):
    (tmp_path / "c.csv").write_text("s,t,i,c\n\"a\nb\",t,i,c\ns,\"t,i,c\n" + "x,y,z,w\n" * 50)
    with pytest.raises(ValueError, match=r"c\.csv: a quoted cell of line 4 does not close: 's,\"t,i,c'"):
        csv_files.csv_rows(spark, str(tmp_path))


def test_the_header_is_read_by_itself(spark, tmp_path):
    (tmp_path / "t.csv").write_text('\n  \r\n"i""d","a\nb",c\r\n1,2,3\n')
    assert csv_files._first_row(spark, str(tmp_path)) == '"i""d","a\nb",c'
    (tmp_path / "t.csv").write_text("")
    assert csv_files._first_row(spark, str(tmp_path)) is None
