"""Whether a keyed table holds each partition of a topic in order, over any number of batches.

Each range of a file is reduced, where it is read, to its first and last offset and whether it
ascends; ranges of a batch are combined, and each batch is compared with the one before it. No row
is sorted or sent anywhere, and what is compared is one row per batch of a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = "run string, batch_id bigint, topic string, partition int, first bigint, last bigint, n bigint, breaks bigint"


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per file range, batch and partition; rows arrive in file order."""
    open_: dict[tuple, list[int]] = {}
    file = None

    def closed() -> pa.RecordBatch:
        rows = [(*key[1:], *values) for key, values in open_.items()]
        open_.clear()
        columns = list(zip(*rows, strict=True))
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
        names = [c.split()[0] for c in RANGES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        frame = batch.to_pandas()
        for key, rows in frame.groupby(["file", "run", "batch_id", "topic", "partition"], sort=False, dropna=False):
            if open_ and key[0] != file:
                yield closed()
            file = key[0]
            offsets = rows["offset"].to_numpy(np.int64)
            breaks = int((np.diff(offsets) <= 0).sum())
            known = open_.get(key)
            if known is None:
                open_[key] = [int(offsets.min()), int(offsets.max()), len(offsets), breaks]
            else:
                breaks += int(offsets[0] <= known[1])
                open_[key] = [min(known[0], int(offsets.min())), max(known[1], int(offsets.max())), known[2] + len(offsets), known[3] + breaks]
    if open_:
        yield closed()


def order_of(rows: DataFrame) -> DataFrame:
    """``topic, partition, n_rows, n_batches, n_breaks`` of a table's rows (run, batch_id, topic,
    partition, offset), read from its files: breaks are places where an offset does not ascend, in
    a file or from one batch to the next of its run."""
    placed = rows.select(F.concat_ws(":", "_metadata.file_path", "_metadata.file_block_start").alias("file"), "run", "batch_id", "topic", "partition", "offset")
    ranges = placed.mapInArrow(_ranges, RANGES)
    batches = ranges.groupBy("run", "topic", "partition", "batch_id").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("breaks").alias("breaks")
    )
    before = F.lag("last").over(Window.partitionBy("run", "topic", "partition").orderBy("batch_id"))
    batches = batches.withColumn("behind", F.coalesce((F.col("first") <= before).cast("long"), F.lit(0)))
    return batches.groupBy("topic", "partition").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_batches"), F.sum(F.col("breaks") + F.col("behind")).alias("n_breaks")
    )
