"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.plans.scratch import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read back. It cuts the lineage,
    stays readable when executors are lost, and gives the optimizer the table's true size."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key's text modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def quoted(name: str) -> str:
    """A column name as it is, whatever characters it has."""
    return f"`{name.replace('`', '``')}`"


def own_columns(df: DataFrame) -> list[Column]:
    return [F.col(quoted(name)) for name in df.columns]


def slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """A batch of texts in slices of about ``most`` bytes, whole texts each. Functions that get an
    iterator of batches may return it in other pieces, so what they build stays small."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(texts)], strict=True):
        yield texts.slice(start, end - start)
