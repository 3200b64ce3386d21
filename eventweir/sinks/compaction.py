"""Small files of a file table packed into files of a target size, with readers undisturbed.

A stream leaves a directory per micro-batch. :func:`compact` packs the files of settled batches,
in the order of insertion, into bins of about the target size, writes them as a new generation
beside the batches, and then publishes a list of what the table consists of: the generations, the
last packed batch of each run, and batches whose files are large enough to stay as they are. The
list appears by one rename, so a reader sees the table before or after, never between. What
was packed stays until :func:`clean`, so that readers of an older list finish.

A run's newest batch is never packed, since the stream may write it again. A repeat of a packed batch
adds nothing, as readers take no directory up to the packed ones. Of two compactions at a time
the second to publish gives up, and its generation is removed.

Rows are rewritten once, and the small files of generations again until they are large. Bins are
filled by running sums over a run's files, in slabs of ``SLAB`` batches, so no task sees all files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.plans.scratch import remove

TARGET = 256 << 20
SLAB = 4096
LISTS, GENERATIONS = "_lists", "_packed"


@dataclass(frozen=True)
class BatchList:
    """What a table consists of: ``generations`` (directories of packed files), the batches after
    ``packed`` (run → its last packed batch), and the batches in ``kept`` (``run/batch_id``)."""

    version: int = -1
    generations: tuple[str, ...] = ()
    packed: dict[str, int] = field(default_factory=dict)
    kept: tuple[str, ...] = ()

    def apart(self) -> Column:
        """Whether a batch directory is part of the table by itself. Prunes partitions."""
        after = F.lit(True)
        if self.packed:
            last = F.create_map(*[F.lit(x) for pair in self.packed.items() for x in pair])
            after = F.coalesce(F.col("batch_id") > F.element_at(last, F.col("run")).cast("long"), F.lit(True))
        return after | _name().isin(list(self.kept)) if self.kept else after


def _name() -> Column:
    return F.concat_ws("/", "run", F.col("batch_id").cast("string"))


def _hadoop(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> dict[int, int]:
    """Published lists and when they were published, in milliseconds."""
    place, files = _hadoop(spark, f"{path}/{LISTS}")
    found = files.listStatus(place) if files.exists(place) else []
    return {int(s.getPath().getName()): s.getModificationTime() for s in found if s.getPath().getName().isdigit()}


def _list(spark: SparkSession, path: str, version: int) -> BatchList:
    known = json.loads(spark.read.text(f"{path}/{LISTS}/{version:012d}", wholetext=True).first()[0])
    return BatchList(known["version"], tuple(known["generations"]), known["packed"], tuple(known["kept"]))


def current_list(spark: SparkSession, path: str) -> BatchList:
    version = max(_versions(spark, path), default=-1)
    return _list(spark, path, version) if version >= 0 else BatchList()


def publish(spark: SparkSession, path: str, new: BatchList) -> bool:
    """Publish a list unless its version is there already. The text is written aside and renamed,
    so that no reader meets half a list."""
    jvm = spark.sparkContext._jvm
    place, files = _hadoop(spark, f"{path}/{LISTS}/{new.version:012d}")
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}/{LISTS}/.{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(json.dumps(asdict(new)).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        context.rename(aside, place, options)
    except Py4JJavaError as error:
        files.delete(aside, False)
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table's rows with their ``run`` and ``batch_id``; ``schema`` is that of both."""
    now = current_list(spark, path)
    rows = spark.read.schema(schema).parquet(path).where(now.apart())
    return rows.unionByName(_generations(spark, path, schema, now.generations)) if now.generations else rows


def _generations(spark: SparkSession, path: str, schema: T.StructType, names: tuple[str, ...]) -> DataFrame:
    """Rows of generations. Their directories per bin say nothing of the rows: as partitions, those of
    several generations, each below its own root, could not be read together."""
    files = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return files.parquet(*[f"{path}/{GENERATIONS}/{name}" for name in names]).select(*schema.names)


def _sizes(rows: DataFrame, *keys: str) -> DataFrame:
    """Files that hold rows and their bytes. Reads no column of them."""
    return rows.select(*keys, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes")).distinct()


def _binned(files: DataFrame, target: int) -> DataFrame:
    """``_file, _pack, _place`` of files with ``_slab`` (a text), in the order of ``_order, _file``."""
    order = Window.partitionBy("_slab").orderBy("_order", "_file")
    before = F.sum("_bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    number = F.floor(F.coalesce(before, F.lit(0)) / target).cast("string")
    return files.select("_file", F.concat_ws("-", "_slab", F.lpad(number, 10, "0")).alias("_pack"), F.row_number().over(order).alias("_place"))


def compact(spark: SparkSession, path: str, schema: T.StructType, target: int = TARGET) -> bool:
    """Pack what is settled and small; whether a new list was published. ``schema``: that of the
    rows with ``run`` and ``batch_id``. A table without anything to pack is left as it is."""
    old = current_list(spark, path)
    batches = spark.read.schema(schema).parquet(path).where(old.apart() & ~_name().isin(list(old.kept)))
    files = _sizes(batches, "run", "batch_id")
    newest = {r["run"]: r["last"] for r in files.groupBy("run").agg(F.max("batch_id").alias("last")).collect()}
    settled = F.col("batch_id") < F.element_at(F.create_map(*[F.lit(x) for p in newest.items() for x in p]), F.col("run")) if newest else F.lit(False)
    files = files.where(settled)
    by_batch = files.groupBy("run", "batch_id").agg(F.avg("_bytes").alias("mean"))
    large = [f"{r['run']}/{r['batch_id']}" for r in by_batch.where(F.col("mean") >= target / 2).collect()]
    last = {r["run"]: r["last"] for r in by_batch.groupBy("run").agg(F.max("batch_id").alias("last")).collect()}
    # Of the generations those whose files are small on average are packed again, together.
    means = {g: _sizes(_generations(spark, path, schema, (g,))).agg(F.avg("_bytes")).first()[0] for g in old.generations}
    again = tuple(g for g, mean in means.items() if (mean or 0) < target / 2)
    if not last:
        return False
    small = batches.where(settled & ~_name().isin(large))
    slab = F.concat_ws("-", "run", F.lpad(F.greatest(F.floor(F.col("batch_id") / SLAB), F.lit(0)).cast("string"), 10, "0"))
    sized = _sizes(small, "run", "batch_id").select("_file", "_bytes", slab.alias("_slab"), F.col("batch_id").alias("_order"))
    if again:
        packed = _generations(spark, path, schema, again)
        sized = sized.unionByName(_sizes(packed).select("_file", "_bytes", F.lit("packed").alias("_slab"), F.lit(0).cast("long").alias("_order")))
        small = small.select("*", "_metadata").unionByName(packed.select("*", "_metadata"))
    generation = f"generation-{uuid.uuid4().hex}"
    # The list of files is written first, so that Spark knows its size and sends a short one to all
    # tasks; rows are then dealt out once, by bin, and carry a file's place instead of its name.
    aside = f"{path}/_aside/{generation}"
    _binned(sized, target).write.parquet(aside)
    bins = spark.read.schema("_file string, _pack string, _place int").parquet(aside)
    count = bins.agg(F.count_distinct("_pack")).first()[0]
    if count:
        where = f"{path}/{GENERATIONS}/{generation}"
        rows = small.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}).drop("_metadata")
        rows = rows.join(bins, "_file").drop("_file").repartition(count, "_pack").sortWithinPartitions("_pack", "run", "batch_id", "_place", "_row")
        rows.drop("_place", "_row").write.partitionBy("_pack").parquet(where)
    remove(spark, aside)
    stay = tuple(g for g in old.generations if g not in again)
    new = replace(
        old, version=old.version + 1, generations=(*stay, generation) if count else stay, packed=old.packed | last, kept=(*old.kept, *large)
    )
    if publish(spark, path, new):
        return True
    remove(spark, f"{path}/{GENERATIONS}/{generation}")
    return False


def clean(spark: SparkSession, path: str, schema: T.StructType, now_ms: int, retention_ms: int) -> int:
    """Remove what lists replaced at least ``retention_ms`` before ``now_ms``; the number of
    directories removed. No reader may run longer than that. A generation whose compaction crashed
    before it was published is in no list and stays."""
    versions = _versions(spark, path)
    old = [v for v, at in versions.items() if at <= now_ms - retention_ms]
    if not old:
        return 0
    base = max(old)
    lists = {v: _list(spark, path, v) for v in versions}
    used = {g for v, one in lists.items() if v >= base for g in one.generations}
    gone = {g for v, one in lists.items() if v < base for g in one.generations} - used
    removed = [f"{path}/{GENERATIONS}/{g}" for g in sorted(gone)]
    replaced = spark.read.schema(schema).parquet(path).where(~lists[base].apart())
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    removed += [r[0] for r in replaced.select(folder).distinct().toLocalIterator()]
    for place in removed:
        remove(spark, place)
    for version in versions:
        if version < base:
            remove(spark, f"{path}/{LISTS}/{version:012d}")
    return len(removed)
