"""One evaluation of a batch for several sinks.

Each row becomes one tagged row per sink that takes it, and one job writes them all, in a directory
per sink. Every sink then reads its own directory. Nothing is persisted in executors, so a
lost executor costs its tasks and no second decoding of the batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG = "sink"


@dataclass(frozen=True)
class Outlet:
    """The rows a sink takes, by a condition that is true or not, and its columns."""

    name: str
    columns: Sequence[Column]
    where: Column | None = None


def write_tagged(rows: DataFrame, outlets: Sequence[Outlet], path: str) -> dict[str, DataFrame]:
    """Write ``rows`` once for all ``outlets`` and return what each takes."""
    names = [o.name for o in outlets]
    shapes = {o.name: rows.select(*o.columns).schema for o in outlets}

    def row(outlet: Outlet) -> Column:
        own = [F.struct(*o.columns) if o is outlet else F.lit(None).cast(shapes[o.name]) for o in outlets]
        tagged = F.struct(F.lit(outlet.name).alias(TAG), *[c.alias(n) for c, n in zip(own, names, strict=True)])
        return tagged if outlet.where is None else F.when(outlet.where, tagged)

    tagged = rows.select(F.explode(F.array_compact(F.array(*map(row, outlets)))).alias("row")).select("row.*")
    tagged.write.mode("overwrite").partitionBy(TAG).parquet(path)
    back = rows.sparkSession.read.schema(tagged.schema).parquet(path)
    return {n: back.where(F.col(TAG) == n).select(f"`{n}`.*") for n in names}
