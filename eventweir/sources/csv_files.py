"""CSV event files to wire records.

Text in a file is never null: an empty cell is ``''``. Rows with too few or too many cells, and
malformed UTF-8, fail the query. Rows end in ``\\n`` or ``\\r\\n``; quoted cells may hold line breaks,
which are kept as they are. Files are always read split (see :func:`csv_rows`).
"""

from __future__ import annotations

import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweir.functions.text import int_sql
from eventweir.operators.align import align
from eventweir.operators.records import tag
from eventweir.plans.scratch import scratch_dir
from eventweir.schemas import BUY, CLICK, TOPUP, StreamSpec, WireField

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST", "lineSep": "\n"}

# A line that ends inside a quoted cell, once its doubled quotes are gone: whole cells, quoted or
# not, then one that opens and does not close. Possessive, so it needs one pass and no stack.
ENDS_OPEN = r'^(?:(?:"[^"]*+"[^,]*+|[^",][^,]*+)?+,)*+"[^"]*+\z'

OPEN = re.compile(ENDS_OPEN.replace(r"\z", r"\Z"))
#: Neighbouring splits that are composed at a time.
FAN = 128

# Cell order of the files without a header.
CLICK_CELLS = ["sessionId", "timestamp", "itemId", "category"]
BUY_CELLS = ["sessionId", "timestamp", "itemId", "price", "quantity"]


def _ends_open(line: Column) -> Column:
    return F.replace(line, F.lit('""'), F.lit("")).rlike(ENDS_OPEN)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split and place, and whether they end inside a quoted cell if they
    start outside of one (``out``) or inside (``in``)."""
    quoted = F.contains("value", F.lit('"'))
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("id"),
        F.validate_utf8("value").alias("value"),
        F.when(quoted, _ends_open(F.col("value"))).otherwise(False).alias("out"),
        F.when(quoted, _ends_open(F.concat(F.lit('"'), F.col("value")))).otherwise(True).alias("in"),
    )


def _effects(lines: DataFrame) -> DataFrame:
    """One row per split: ``file, start, length, from_out, from_in``: what the split does to either
    state. Of an effect, ``open`` is the state after it, ``owner`` the split in which the row starts
    that is open then (null: the row that was open before), ``was_open`` whether a line ends open.

    Lines that change nothing do not count.
    """
    counts = ~(~F.col("out") & F.col("in"))
    steps = F.array_sort(F.collect_list(F.when(counts, F.struct("id", F.col("out").alias("o"), F.col("in").alias("i")))))
    own = lines.groupBy("file", "start").agg(F.max("length").alias("length"), steps.alias("steps"))

    def through(opened: bool) -> str:
        return (
            f"aggregate(steps, named_struct('open', {opened}, 'was_open', {opened}, 'was_out', {not opened}), "
            "(a, s) -> named_struct('open', if(a.open, s.i, s.o), 'was_open', a.was_open or if(a.open, s.i, s.o), "
            "'was_out', a.was_out or not if(a.open, s.i, s.o)), "
            "a -> named_struct('open', a.open, 'owner', if(a.was_out, start, null), 'was_open', a.was_open))"
        )

    return own.selectExpr("file", "start", "length", f"{through(False)} as from_out", f"{through(True)} as from_in")


def _composed(parts: str, opened: str, owner: str, found: str = "", more: str = "") -> str:
    """SQL that follows a state through an array of parts with their effects."""
    effect = "if(a.open, p.from_in, p.from_out)"
    return (
        f"aggregate({parts}, named_struct('open', {opened}, 'owner', {owner}{found}), "
        f"(a, p) -> named_struct('open', {effect}.open, 'owner', coalesce({effect}.owner, a.owner){more}))"
    )


def _followed(effects: DataFrame, fan: int = FAN) -> DataFrame:
    """One row per split: ``file, start, opened`` (it starts inside a cell), ``owner`` (the split in
    which that cell's row starts), ``ends_open``, and ``whole`` (each of its lines is a row).

    The effects of neighbours compose, so this is an associative scan: blocks of about ``fan``
    neighbours are composed level by level until each file is one block, and the states are handed
    down the same levels. Work is linear in the splits, and no list is longer than a block.
    """
    top = effects.agg(F.max("length"), F.max("start")).first()
    width, end = max(top[0] or 1, 1), top[1] or 0
    part = effects.select("file", "start", F.struct("start", "from_out", "from_in").alias("part"))
    levels: list[DataFrame] = []
    while not levels or width <= end:
        width *= fan
        block = F.floor(F.col("start") / width).cast("long") * F.lit(width)
        blocks = part.groupBy("file", block.alias("start")).agg(F.array_sort(F.collect_list("part")).alias("parts"))
        effect = "named_struct('open', e.open, 'owner', e.owner, 'was_open', false)"
        none = "cast(null as bigint)"
        both = [f"transform(array({_composed('parts', str(state), none)}), e -> {effect})[0] as {name}" for name, state in (("from_out", False), ("from_in", True))]
        levels.append(blocks.selectExpr("file", "start", "parts", *both))
        part = levels[-1].select("file", "start", F.struct("start", "from_out", "from_in").alias("part"))
    # A file starts outside of a cell.
    known = levels[-1].selectExpr("file", "start", "parts", "false as opened", "-1L as owner")
    for below in levels[-2::-1]:
        known = below.select("file", "start", "parts").join(_handed_down(known).select("file", "start", "opened", "owner"), ["file", "start"])
    return _handed_down(known)


def _handed_down(blocks: DataFrame) -> DataFrame:
    """Each block's parts with the state they start in."""
    kind = "array<struct<start: bigint, opened: boolean, owner: bigint, ends_open: boolean, whole: boolean>>"
    state = (
        "named_struct('start', p.start, 'opened', a.open, 'owner', a.owner, "
        "'ends_open', if(a.open, p.from_in, p.from_out).open, 'whole', not a.open and not p.from_out.was_open)"
    )
    found = _composed("parts", "opened", "owner", f", 'found', cast(array() as {kind})", f", 'found', array_append(a.found, {state})")
    return blocks.select("file", F.explode(F.expr(f"({found}).found")).alias("s")).select("file", "s.*")


def _inside(lines: DataFrame) -> DataFrame:
    """``lines`` with their split's ``opened`` to lines with ``inside``: whether they start inside a cell."""
    split = Window.partitionBy("file", "start").orderBy("id")
    so_far = split.rowsBetween(Window.unboundedPreceding, 0)
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    # What is known of a line's start: the last line that ends alike either way, and how many
    # lines that turn the state round came since.
    turns = F.col("out") & ~F.col("in")
    rows = lines.withColumn("turns", F.sum(turns.cast("int")).over(so_far))
    fixed = F.when(F.col("out") == F.col("in"), F.struct(F.col("out").alias("open"), "turns"))
    rows = rows.withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
    since = F.col("turns") - turns.cast("int") - F.coalesce("fixed.turns", F.lit(0))
    return rows.withColumn("inside", F.coalesce("fixed.open", "opened") != (since % 2 == 1))


def _fail_unclosed(lines: DataFrame, splits: DataFrame) -> None:
    """Raise if a file ends inside a quoted cell, before its rest is put together as one row."""
    last = splits.groupBy("file").agg(F.max_by(F.struct("start", "opened", "owner", "ends_open"), "start").alias("s"))
    bad = last.where("s.ends_open").first()
    if bad is None:
        return
    file, state = bad["file"], splits.where(F.col("file") == bad["file"])
    rows = _inside(lines.where(F.col("file") == file).join(state.select("file", "start", "opened"), ["file", "start"]))
    begins = rows.where("not inside").agg(F.max(F.struct("start", "id", "value"))).first()[0]
    start, id_ = begins["start"], begins["id"]
    number = lines.where((F.col("file") == file) & ((F.col("start") < start) | ((F.col("start") == start) & (F.col("id") <= id_)))).count()
    raise ValueError(f"{file}: a quoted cell of line {number} does not close: {begins['value'][:80]!r}")


def _joined(lines: DataFrame) -> DataFrame:
    """Rows of splits in which a cell goes on in the next line. ``lines`` come with their split."""
    split = Window.partitionBy("file", "start").orderBy("id")
    so_far = split.rowsBetween(Window.unboundedPreceding, 0)
    rows = _inside(lines)
    rows = rows.withColumn("n", F.sum((~F.col("inside")).cast("int")).over(so_far))
    last = F.max("n").over(split.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("goes_on", F.col("ends_open") & (F.col("n") == last))
    # Number 0 is the row that goes on in the next split; there it has the number 0 too.
    number = F.when(F.col("goes_on"), 0).otherwise(F.col("n"))
    owner = F.when(F.col("n") == 0, F.col("owner")).otherwise(F.col("start"))
    part = F.struct("start", "id", "value")
    whole = rows.groupBy("file", owner.alias("owner"), number.alias("number")).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return whole.select("file", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["id"].alias("id"), F.array_join("parts.value", "\n").alias("value"))


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """``row, start``: the text of each row that is not blank, and where the split it is in starts.

    Lines are read split. Which lines start inside a quoted cell follows from one small row per
    split; only splits in which a cell goes on in the next line are shuffled, to join the lines
    of a row. Rows come in the order they have in their file. A file that ends inside a quoted
    cell is an error that names the line where the cell's row starts.
    """
    lines = _lines(spark, path)
    place = scratch_dir(spark, "csv-splits")
    _effects(lines).write.parquet(f"{place}/effects")
    _followed(spark.read.parquet(f"{place}/effects")).write.parquet(f"{place}/states")
    splits = spark.read.parquet(f"{place}/states")
    rows = lines.select("file", "start", "id", "value")
    if not splits.where("not whole").isEmpty():
        _fail_unclosed(lines, splits)
        known = lines.join(splits, ["file", "start"])
        rows = known.where("whole").select(*rows.columns).unionAll(_joined(known.where("not whole")))
        rows = rows.repartitionByRange("file", "start", "id").sortWithinPartitions("file", "start", "id")
    return rows.where(F.trim(F.rtrim("value", F.lit("\r"))) != "").select(F.regexp_replace("value", r"\r\z", "").alias("row"), "start")


def _first_row(spark: SparkSession, path: str) -> str | None:
    """The first row that is not blank of one of the files, read by itself: a few lines of a file's
    first split, and more only while blank lines or an open cell ask for them."""
    lines = spark.read.text(path, lineSep="\n").where("_metadata.file_block_start = 0")
    wanted = 1
    while True:
        found = [line["value"] for line in lines.take(wanted)]
        row = ""
        for line in found:
            row = f"{row}\n{line}" if row else line
            if not row.rstrip("\r").strip(" "):
                row = ""
            elif not OPEN.match(row.replace('""', "")):
                return row.removesuffix("\r")
        if len(found) < wanted:
            return row or None
        wanted *= 16


def _cells(rows: DataFrame, names: list[str]) -> DataFrame:
    schema = ", ".join(f"_c{i} string" for i in range(len(names)))
    return rows.select(F.from_csv("row", schema, CSV_OPTIONS).alias("cells")).select("cells.*").toDF(*names)


def _cell(name: str) -> str:
    return f"coalesce(`{name}`, '')"


def named_records(rows: DataFrame, spec: StreamSpec, cells: list[str]) -> DataFrame:
    """Rows of text cells in file order to wire records: named, tagged, in wire order."""
    types = {f.name: f.type for f in spec.wire.fields}
    values = [f"{int_sql(_cell(c), c) if types[c] == 'int' else _cell(c)} as `{c}`" for c in cells]
    return align(tag(rows.toDF(*cells).selectExpr(*values), spec), spec.wire)


def read_click_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less ``sessionId, timestamp, itemId, category`` rows."""
    return named_records(_cells(csv_rows(spark, path), CLICK_CELLS), CLICK, CLICK_CELLS)


def read_buy_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less ``sessionId, timestamp, itemId, price, quantity`` rows."""
    return named_records(_cells(csv_rows(spark, path), BUY_CELLS), BUY, BUY_CELLS)


def _named_cell(field: WireField) -> str:
    if field.type == "int":
        return int_sql(_cell(field.name), field.name)
    return f"nullif({_cell(field.name)}, '')" if field.nullable else _cell(field.name)


def read_topup_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of files with a header, the same in all of them, read by name. Other columns are
    ignored; the nullable fields may be empty or have no column at all. Rows that repeat the
    header are left out; another one fails, as its names are no ints."""
    rows = csv_rows(spark, path)
    header = _first_row(spark, path) or "none"
    names = next(csv.reader([header]))
    present = [f for f in TOPUP.wire.fields if f.name in names]
    cells = _cells(rows.where(F.col("row") != header), names)
    return align(cells.selectExpr(*[f"{_named_cell(f)} as `{f.name}`" for f in present]), TOPUP.wire)


READERS = {"click": read_click_csv, "buy": read_buy_csv, "topup": read_topup_csv}
