"""Exact top-k inner products with block-at-a-time pruning.

Dimensions are the terms. Vectors are ordered by their nearest pivot and id, and cut into ranges:
a group of ranges per partition, each range a block with its largest and smallest component in
every dimension. A query's bound for a block is the sum over dimensions of the larger of the two
possible products, so no vector of the block can score more. Each query visits blocks in the
order of their bounds and scores their forward index until the bound falls below its k-th score.

Two rounds: first each query searches the group it lies in, which holds its likeliest neighbours
and gives a first k-th score. Then a query goes only to those groups whose envelope, the largest
and smallest components of the whole group, may reach that score: envelopes are compared in chunks
of ``ENVELOPES`` groups, and vectors are shipped for the pairs of query and group that survive. A
task holds one group of blocks and one slice of queries; only k rows per query and group leave it.
Results are exact.

Components x become floor(1024 * x), kept in units of 1/1024, so that the largest doubles do not
overflow. Vectors that are null or hold null or non-finite components take no part; shorter vectors
count as padded with zeros; empty vectors score 0. A repeated row is a candidate like any other and,
if a query, is answered once per row. Ties go to the smaller id. Scores are exact while sums stay
below 2 ** 53; beyond that exact integers are used, cut to long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.llm.tables import staged, table

SCALE = 1024
TOP = 10
BLOCK = 256
GROUP = 16_384
SLICE = 65_536
ENVELOPES = 1024
PIVOTS = 64
EXACT = float(1 << 53)
FOUND = "query long, query_id long, vec_id long, score long"


def scaled(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part, components floored to units of 1/1024."""
    numbers = F.col(vector).cast("array<double>")
    sound = F.col(vector).isNotNull() & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() gives longs; components beyond them have no fraction and stay as they are.
    small = lambda x: F.abs(x) < 1e15
    whole = F.transform(numbers, lambda x: F.when(small(x), F.floor(F.when(small(x), x) * SCALE).cast("double") / SCALE).otherwise(x))
    return rows.where(sound & F.col("vec_id").isNotNull()).select("vec_id", whole.alias("vector"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    matrix = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        matrix[i, : len(v)] = v
    return matrix


def with_pivot(rows: DataFrame) -> DataFrame:
    """``rows`` with the pivot of the largest inner product. Pivots: at most ``PIVOTS`` rows."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("vector").collect()
    width = max((len(r["vector"]) for r in picked), default=0)
    pivots = _matrix(pd.Series([r["vector"] for r in picked], dtype=object), width)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                ours = _matrix(batch["vector"].map(lambda v: v[:width]), width)
                with np.errstate(over="ignore", invalid="ignore"):  # any pivot is right
                    batch["pivot"] = (ours @ pivots.T).argmax(axis=1).astype(np.int32) if width else np.int32(0)
                yield batch

    return rows.mapInPandas(nearest, T.StructType([*rows.schema.fields, T.StructField("pivot", T.IntegerType())]))


BLOCKS = "group int, block int, width int, ids binary, rows array<long>, forward binary, high binary, low binary"


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    group, number = TaskContext.get().partitionId(), 0
    held = pd.DataFrame()
    for batch in _then_none(batches):
        held = held if batch is None else pd.concat([held, batch])
        while len(held) >= BLOCK or (batch is None and len(held)):
            part, held = held[:BLOCK], held[BLOCK:]
            width = int(part["vector"].map(len).max())
            matrix = _matrix(part["vector"], width)
            arrays = matrix, matrix.max(axis=0, initial=-np.inf), matrix.min(axis=0, initial=np.inf)
            ids = part["vec_id"].to_numpy(np.int64).tobytes()
            yield pd.DataFrame([[group, number, width, ids, part["row"].tolist(), *[a.tobytes() for a in arrays]]], columns=["group", "block", "width", "ids", "rows", "forward", "high", "low"])
            number += 1


def _then_none(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def _whole(component: float) -> int:
    """A component in whole units of 1/1024."""
    return int(component) * SCALE if abs(component) >= 1e15 else int(component * SCALE)


def _products(queries: np.ndarray, forward: np.ndarray) -> np.ndarray:
    """Inner products as integers; double arithmetic where it is exact."""
    most = [float(np.abs(side).max(initial=0)) * SCALE for side in (queries, forward)]
    if most[0] * most[1] * max(1, queries.shape[1]) < EXACT:
        return ((queries * SCALE) @ (forward * SCALE).T).astype(np.int64)
    exact = np.array([[_whole(x) for x in q] for q in queries], object) @ np.array([[_whole(x) for x in v] for v in forward], object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """No vector between ``low`` and ``high`` scores more with a query. Scores are cut to long, so
    bounds are too, from below; where sums overflow both ways nothing is known."""
    with np.errstate(over="ignore", invalid="ignore"):
        bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        size = np.abs(queries) @ np.maximum(np.abs(high), np.abs(low)).T
        # Rounding of large sums must not hide a block.
        bounds = (bounds + size * 1e-9) * float(SCALE * SCALE) + 1
    return np.maximum(np.where(np.isnan(bounds), np.inf, bounds), -float(1 << 63))


class _Block:
    def __init__(self, row, width: int) -> None:
        self.ids, self.rows = np.frombuffer(row.ids, np.int64), np.asarray(row.rows, np.int64)
        pad = ((0, 0), (0, width - row.width))
        self.forward = np.pad(np.frombuffer(row.forward).reshape(len(self.ids), row.width), pad)
        self.high, self.low = (np.pad(np.frombuffer(x), pad[1]) for x in (row.high, row.low))


def _search(blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """The best of one group's vectors for each query. ``least``: a k-th score known so far."""
    columns = ["query", "query_id", "vec_id", "score"]
    if not len(blocks) or not len(queries):
        return pd.DataFrame(columns=columns)
    width = max(int(blocks["width"].max()), int(queries["vector"].map(len).max()))
    index = [_Block(b, width) for b in blocks.sort_values("block").itertuples()]
    ours = _matrix(queries["vector"], width)
    own = queries["row"].to_numpy(np.int64)
    high, low = np.stack([b.high for b in index]), np.stack([b.low for b in index])
    bounds = _bounds(ours, high, low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    lowest, none = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    scores, ids = np.full((len(own), TOP), lowest), np.full((len(own), TOP), none)
    kth = queries["least"].fillna(-np.inf).to_numpy(np.float64)
    for wave in range(len(index)):
        at = order[:, wave]
        open_ = np.flatnonzero(bounds[np.arange(len(own)), at] >= kth)
        if not open_.size:
            break
        for number in np.unique(at[open_]):
            block, asked = index[number], open_[at[open_] == number]
            got = _products(ours[asked], block.forward)
            also = np.broadcast_to(block.ids, got.shape).copy()
            itself = own[asked][:, None] == block.rows[None, :]
            got[itself], also[itself] = lowest, none
            got, also = np.concatenate([scores[asked], got], axis=1), np.concatenate([ids[asked], also], axis=1)
            best = np.lexsort((also, ~got), axis=1)[:, :TOP]
            scores[asked], ids[asked] = np.take_along_axis(got, best, 1), np.take_along_axis(also, best, 1)
            full = ids[asked, -1] != none
            kth[asked] = np.where(full, np.maximum(kth[asked], scores[asked, -1].astype(np.float64)), kth[asked])
    there = ids != none
    q = np.repeat(np.arange(len(own)), there.sum(axis=1))
    return pd.DataFrame({"query": own[q], "query_id": queries["vec_id"].to_numpy(np.int64)[q], "vec_id": ids[there], "score": scores[there]})


def _padded(vectors: pd.Series, width: int) -> np.ndarray:
    """Arrays kept as bytes, side by side; what they lack counts as zeros."""
    return _matrix(pd.Series([np.frombuffer(x) for x in vectors], dtype=object), width)


def _envelope(blocks: pd.DataFrame) -> pd.DataFrame:
    """The largest and smallest components of one group of blocks."""
    width = int(blocks["width"].max())
    high, low = _padded(blocks["high"], width).max(axis=0), _padded(blocks["low"], width).min(axis=0)
    return pd.DataFrame([[blocks["group"].iloc[0], width, high.tobytes(), low.tobytes()]], columns=["group", "width", "high", "low"])


def _open_pairs(envelopes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """Which queries go to which groups of a chunk: not their own, nor those below their k-th score."""
    if not len(envelopes) or not len(queries):
        return pd.DataFrame({"row": [], "group": []})
    width = max(int(envelopes["width"].max()), int(queries["vector"].map(len).max()))
    high, low = _padded(envelopes["high"], width), _padded(envelopes["low"], width)
    groups, least = envelopes["group"].to_numpy(), queries["least"].fillna(-np.inf).to_numpy(np.float64)
    bounds = _bounds(_matrix(queries["vector"], width), high, low)
    q, g = np.nonzero((bounds >= least[:, None]) & (queries["own"].to_numpy()[:, None] != groups[None, :]))
    return pd.DataFrame({"row": queries["row"].to_numpy()[q], "group": groups[g]})


def surviving(blocks: DataFrame, queries: DataFrame) -> DataFrame:
    """``row, group``: the pairs of query (row, vector, own, slice, least) and group that are left to
    search. A task compares a slice of queries with the envelopes of ``ENVELOPES`` groups."""
    envelopes = blocks.select("group", "width", "high", "low").groupBy("group").applyInPandas(_envelope, "group int, width int, high binary, low binary")
    envelopes = staged(envelopes.withColumn("chunk", F.floor(F.col("group") / ENVELOPES).cast("int")), "envelopes")
    chunks = (envelopes.agg(F.max("chunk")).first()[0] or 0) + 1
    slices = (queries.agg(F.max("slice")).first()[0] or 0) + 1
    placed = envelopes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    asked = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    pairs = placed.groupBy("chunk", "slice").cogroup(asked.groupBy("chunk", "slice"))
    return staged(pairs.applyInPandas(lambda e, q: _open_pairs(e, q), "row long, group int"), "open-pairs")


def top_products(rows: DataFrame, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``rows`` (vec_id, embedding) whose id is
    divisible by ``every``, against all other rows. Other columns are not read."""
    vectors = scaled(rows.select("vec_id", "embedding")).withColumn("row", F.monotonically_increasing_id())
    vectors = staged(with_pivot(staged(vectors, "vectors")), "pivoted")
    groups = max(1, -(-vectors.count() // GROUP))
    ranged = vectors.repartitionByRange(groups, "pivot", "vec_id", "row").sortWithinPartitions("pivot", "vec_id", "row")
    blocks = staged(ranged.mapInPandas(_blocks, BLOCKS), "blocks")
    placed = blocks.select(F.explode("rows").alias("row"), F.col("group").alias("own"))
    queries = vectors.where(F.col("vec_id") % every == 0).join(placed, "row")
    slices = max(1, -(-queries.count() // SLICE))
    queries = staged(queries.select("row", "vec_id", "vector", "own", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice")), "queries")
    sliced = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def search(asked: DataFrame) -> DataFrame:
        return staged(sliced.groupBy("group", "slice").cogroup(asked.groupBy("group", "slice")).applyInPandas(lambda b, q: _search(b, q), FOUND), "found")

    first = search(queries.withColumn("group", F.col("own")).withColumn("least", F.lit(None).cast("double")))
    least = first.groupBy(F.col("query").alias("row")).agg(F.when(F.count("*") >= TOP, F.min("score").cast("double")).alias("least"))
    known = staged(queries.join(least, "row", "left"), "known-scores")
    both = first.unionAll(search(known.join(surviving(blocks, known), "row")))
    rank = F.expr("row_number() over (partition by query order by score desc, vec_id)")
    return both.withColumn("rank", rank).where(F.col("rank") <= TOP).select("query_id", "rank", "vec_id", "score")


def op4_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
