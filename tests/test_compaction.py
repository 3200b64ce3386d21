"""Packing of small files: rows, order, readers at work, repeats, two at a time, cleaning."""

import hashlib
import os

import pytest
from samples import CLICK_1

from eventweir.operators.records import project_sink
from eventweir.schemas import CLICK
from eventweir.sinks import compaction
from eventweir.sinks.tables import FileTableSink


def batch(spark, *sessions):
    records = [{**CLICK_1, "sessionId": s} for s in sessions]
    return project_sink(spark.createDataFrame(records, CLICK.wire.struct), CLICK).coalesce(1)


@pytest.fixture
def sink(spark, tmp_path):
    sink = FileTableSink(str(tmp_path))
    sink.ensure(spark, CLICK)
    for number in range(12):
        sink.write(batch(spark, f"a{number}", f"b{number}"), CLICK, number, "x")
    sink.write(batch(spark, "other"), CLICK, 0, "y")
    return sink


def rows_of(df):
    return sorted((r["run"], r["batch_id"], r["session_id"]) for r in df.collect())


def files_of(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_rows_stay_and_files_get_fewer(spark, sink):
    before = rows_of(sink.read_batches(spark, CLICK))
    assert sink.compact(spark, CLICK)
    assert rows_of(sink.read_batches(spark, CLICK)) == before
    known = compaction.current_list(spark, sink.path(CLICK))
    assert known.packed == {"x": 10} and len(known.generations) == 1  # not the newest of a run
    (packed,) = files_of(f"{sink.path(CLICK)}/_packed")
    stored = spark.read.parquet(packed).collect()
    assert [r["session_id"] for r in stored] == [f"{c}{n}" for n in range(11) for c in "ab"]  # in order of insertion
    assert not sink.compact(spark, CLICK)  # nothing is left to pack


def test_a_reader_is_not_disturbed(spark, sink):
    reader = sink.read_batches(spark, CLICK)  # has its files, not yet read
    before = rows_of(sink.read_batches(spark, CLICK))
    during = []
    publish = compaction.publish

    def watched(*args):
        during.append(rows_of(sink.read_batches(spark, CLICK)))  # the new files are there, the list is not
        sink.write(batch(spark, "late"), CLICK, 12, "x")
        return publish(*args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(compaction, "publish", watched)
        assert sink.compact(spark, CLICK)
    assert during == [before]
    assert rows_of(reader) == before
    assert rows_of(sink.read_batches(spark, CLICK)) == sorted([*before, ("x", 12, "late")])


def test_bins_of_the_target_size(spark, sink):
    size = max(map(os.path.getsize, files_of(f"{sink.path(CLICK)}/run=x")))
    assert sink.compact(spark, CLICK, target=3 * size)
    assert 4 <= len(files_of(f"{sink.path(CLICK)}/_packed")) <= 5


def test_large_files_stay_where_they_are(spark, sink):
    before = rows_of(sink.read_batches(spark, CLICK))
    assert sink.compact(spark, CLICK, target=1)
    known = compaction.current_list(spark, sink.path(CLICK))
    assert len(known.kept) == 11 and not known.generations
    sink.write(batch(spark, "next"), CLICK, 12, "x")
    assert sink.compact(spark, CLICK)
    assert rows_of(sink.read_batches(spark, CLICK)) == sorted([*before, ("x", 12, "next")])
    assert sink.clean(spark, CLICK, retention_hours=0) == 1  # batch 11 only
    assert rows_of(sink.read_batches(spark, CLICK)) == sorted([*before, ("x", 12, "next")])


def test_repeats_and_small_generations(spark, sink):
    before = rows_of(sink.read_batches(spark, CLICK))
    sink.compact(spark, CLICK)
    sink.write(batch(spark, "a3", "b3"), CLICK, 3, "x")  # a packed batch again
    sink.write(batch(spark, "a11", "b11"), CLICK, 11, "x")  # the newest again
    assert rows_of(sink.read_batches(spark, CLICK)) == before
    sink.write(batch(spark, "c"), CLICK, 12, "x")
    assert sink.compact(spark, CLICK)  # the small generation is packed again
    assert len(compaction.current_list(spark, sink.path(CLICK)).generations) == 1
    assert rows_of(sink.read_batches(spark, CLICK)) == sorted([*before, ("x", 12, "c")])


def test_generations_that_are_large_enough_stay_apart(spark, tmp_path):
    sink = FileTableSink(str(tmp_path))
    sink.ensure(spark, CLICK)
    places = iter(range(1 << 30))

    def write(number):
        # Texts that do not compress, so that packed files are as large as their parts together.
        names = [hashlib.sha256(b"%d" % next(places)).hexdigest() for _ in range(500)]
        sink.write(batch(spark, *names), CLICK, number, "x")

    for number in range(4):
        write(number)
    size = max(map(os.path.getsize, files_of(f"{sink.path(CLICK)}/run=x")))
    before = rows_of(sink.read_batches(spark, CLICK))
    assert sink.compact(spark, CLICK, target=3 * size)
    assert rows_of(sink.read_batches(spark, CLICK)) == before
    for number in range(4, 8):
        write(number)
    before = rows_of(sink.read_batches(spark, CLICK))
    assert sink.compact(spark, CLICK, target=3 * size)
    assert len(compaction.current_list(spark, sink.path(CLICK)).generations) == 2
    assert rows_of(sink.read_batches(spark, CLICK)) == before and len(before) == 4000
    # A generation of the old layout, with a directory per bin, beside them.
    stored = files_of(f"{sink.path(CLICK)}/_packed")[0]
    os.mkdir(f"{os.path.dirname(stored)}/_pack=0")
    os.rename(stored, f"{os.path.dirname(stored)}/_pack=0/{os.path.basename(stored)}")
    assert rows_of(sink.read_batches(spark, CLICK)) == before
    write(8)
    assert sink.compact(spark, CLICK, target=100 * size)  # all generations are small now
    assert len(compaction.current_list(spark, sink.path(CLICK)).generations) == 1
    assert len(rows_of(sink.read_batches(spark, CLICK))) == 4500
    assert sink.clean(spark, CLICK, retention_hours=0)
    assert len(rows_of(sink.read_batches(spark, CLICK))) == 4500


def test_the_second_of_two_gives_up(spark, sink):
    before = rows_of(sink.read_batches(spark, CLICK))
    publish = compaction.publish

    def overtaken(session, path, new):
        assert publish(session, path, compaction.BatchList(new.version))
        return publish(session, path, new)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(compaction, "publish", overtaken)
        assert not sink.compact(spark, CLICK)
    assert not files_of(f"{sink.path(CLICK)}/_packed")
    assert rows_of(sink.read_batches(spark, CLICK)) == before


def test_cleaning_waits_for_readers(spark, sink):
    before = rows_of(sink.read_batches(spark, CLICK))
    sink.compact(spark, CLICK)
    many = len(files_of(sink.path(CLICK)))
    assert sink.clean(spark, CLICK, retention_hours=1) == 0 and len(files_of(sink.path(CLICK))) == many
    assert sink.clean(spark, CLICK, retention_hours=0) == 11
    assert len(files_of(f"{sink.path(CLICK)}/run=x")) == 1
    assert rows_of(sink.read_batches(spark, CLICK)) == before


def test_an_empty_table(spark, tmp_path):
    sink = FileTableSink(str(tmp_path))
    sink.ensure(spark, CLICK)
    assert not sink.compact(spark, CLICK) and sink.read(spark, CLICK).count() == 0
    assert sink.clean(spark, CLICK, retention_hours=0) == 0
