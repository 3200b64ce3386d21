"""Embedding near-duplicates by a robust-pruned flat graph.

1. Vectors that are equal are one class. Classes go to the shards of their nearest centroids, so
   shards overlap; a cluster too large for a shard is cut by hyperplanes, and a class also goes to
   the far side of planes that it is close to, in all combinations. What planes leave large, such as a ball of
   near-equal vectors, is cut into slices by hash, and each pair of slices is a shard, so no
   task holds more than two slices. Centroids come from a bounded sample.
2. Each shard builds a graph: every class keeps neighbours by robust pruning, which drops a
   candidate if a kept neighbour is closer to it, by the factor ``ALPHA``, than the class itself.
3. Adjacency lists of all shards are united per class.
4. In each shard, every class is searched for: greedily from the medoid with a beam, then all
   that is in range, itself included, is expanded, slightly beyond the threshold so that paths
   do not break off. Edges are followed both ways.
5. What was found is verified by cosine in double precision, and counted in the shard: a link
   belongs to the first cell that holds both ends, so overlapping shards count it once. A shard
   returns a number per class and at most one spanning link per class, not its pairs, so a ball of
   near-equal vectors writes no more rows than others.
6. Recall is audited: a bounded sample of classes is compared with all by brute force, and the
   shares of their links that were counted are averaged, so that a ball does not outweigh others.
   Below ``RECALL``, the whole is repeated with twice the overlap.

Defined results: null, empty and zero vectors, and those that hold null or non-finite components,
link with nothing; so do vectors of different length. Repeated rows are copies and link. Rows with
a null id get a component like others; they are kept only where no row of the component has an id.
Where the audited classes have no link, recall is null: not measured. An empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm.graph import lowest_reachable, merge_labels
from eventweir.llm.tables import staged, table

COSINE = 0.95
#: Range that the search expands, below the threshold.
EXPANDED = 0.88
RECALL = 0.9
AUDITED = 256
SAMPLE = 16_384
CENTROIDS = 1024
SHARD = 512
#: Classes of one shard at most, on average; larger clusters are cut by hyperplanes.
LARGEST = 2048
#: How close to a plane a class also goes to its far side: this over the root of the dimensions,
#: since distances from random planes shrink like that; at most so many planes, the nearest ones.
MARGIN = 0.25
FLIPS = 4
#: A cell with more than two slices of so many classes is cut into slices that meet in pairs.
SLICE = 1024
OVERLAP = 2
CANDIDATES = 48
DEGREE = 24
ALPHA = 1.2
BEAM = 16
#: Classes that are searched for at a time.
TOGETHER = 256
#: Pairs that are compared at a time, and edges that are followed at a time.
PAIRS = 1 << 16
EXPANSION = 1 << 21
#: Kinds of what a shard returns.
COUNT, SPAN, AUDIT = 0, 1, 2


def classes(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``embedding, copies, first, node``: one row per different sound vector."""
    numbers = F.col(vector).cast("array<double>")
    sound = F.col(vector).isNotNull() & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(numbers, lambda x: x != 0)
    found = rows.where(sound).groupBy(F.col(vector).alias("embedding")).agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    return staged(found.withColumn("node", F.monotonically_increasing_id()), "vector-classes")


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.array([np.asarray(v, np.float64) for v in vectors])
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # no overflow, no underflow
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def centroids(sample: np.ndarray, count: int, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = sample[rng.choice(len(sample), count, replace=False)]
    for _ in range(8):
        nearest = (sample @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centers)
    return centers


def sharded(nodes: DataFrame, overlap: int) -> DataFrame:
    """``cluster, code, pair, node, embedding``: the classes of each shard, every class in its
    ``overlap`` nearest clusters."""
    count = nodes.count()
    widths = nodes.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    width = widths[0]["width"] if widths else 0
    picked = nodes.where(F.size("embedding") == width).orderBy(F.xxhash64("node")).limit(min(SAMPLE, max(count, 1))).select("embedding").collect()
    sample = _unit(pd.Series([r[0] for r in picked])) if picked else np.zeros((0, 1))
    centers = centroids(sample, max(1, min(CENTROIDS, len(sample), -(-count // SHARD)))) if len(sample) else sample
    planes = np.random.default_rng(1).normal(size=(20, width))
    planes /= np.maximum(np.linalg.norm(planes, axis=1, keepdims=True), 1e-12)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["embedding"].map(len)):
                if size == width:
                    unit = _unit(part["embedding"])
                    near = np.argsort(-(unit @ centers.T), axis=1)[:, :overlap]
                    sides = unit @ planes.T
                else:  # other lengths link only among themselves
                    near, sides = np.full((len(part), 1), -size), np.ones((len(part), len(planes)))
                bits = (sides > 0) @ (1 << np.arange(len(planes)))
                yield pd.DataFrame({"node": part["node"].repeat(near.shape[1]), "cluster": near.ravel(), "bits": bits.repeat(near.shape[1]), "margins": list(np.abs(sides).repeat(near.shape[1], axis=0)), "embedding": part["embedding"].repeat(near.shape[1])})

    rows = staged(nodes.select("node", "embedding").mapInPandas(assign, "node long, cluster int, bits long, margins array<double>, embedding array<double>"), "assigned")
    sizes = rows.groupBy("cluster").count()
    cut = staged(sizes.select("cluster", F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / LARGEST))).cast("int").alias("planes")), "cuts")
    rows = rows.join(cut, "cluster")
    rows = rows.withColumns({
        "code": F.expr("bits & (shiftleft(1L, planes) - 1)"),
        "close": F.expr("transform(slice(margins, 1, planes), (m, i) -> struct(m, i))"),
    })
    near = F.slice(F.array_sort(F.filter("close", lambda c: c["m"] <= MARGIN / max(width, 1) ** 0.5)), 1, FLIPS)
    rows = rows.withColumn("close", near)
    codes = F.expr("aggregate(close, array(code), (found, c) -> concat(found, transform(found, x -> x ^ shiftleft(1L, c.i))))")
    cells = staged(rows.select(F.col("cluster"), F.explode(codes).alias("code"), "node", "embedding"), "cells")
    return sliced(cells)


def sliced(cells: DataFrame) -> DataFrame:
    """``cells`` (cluster, code, node, embedding) with ``pair``: 0, or which two of a large cell's
    slices meet; ``own`` and ``other`` are these two. A class is in one pair for each slice of its cell."""
    sizes = cells.groupBy("cluster", "code").count().where(F.col("count") > 2 * SLICE)
    large = staged(sizes.select("cluster", "code", F.ceil(F.col("count") / SLICE).cast("long").alias("slices")), "large-cells")
    rows = cells.join(large, ["cluster", "code"], "left").withColumn("slices", F.coalesce("slices", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64("node"), "slices").alias("own")
    rows = rows.select("cluster", "code", "node", "embedding", "slices", own, F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("other"))
    return rows.select("cluster", "code", (F.least("own", "other") * F.col("slices") + F.greatest("own", "other")).alias("pair"), "node", "embedding", "own", "other")


def robust_graph(unit: np.ndarray) -> np.ndarray:
    """Neighbours of every vector, ``DEGREE`` columns, -1 where there are fewer."""
    size = len(unit)
    width = min(CANDIDATES, size - 1)
    kept = np.full((size, DEGREE), -1, np.int32)
    for at in range(0, size if width > 0 else 0, TOGETHER):
        close = unit[at : at + TOGETHER] @ unit.T
        rows = np.arange(len(close))
        close[rows, rows + at] = -np.inf
        near = np.argpartition(-close, width - 1, axis=1)[:, :width]
        distance = 1 - np.take_along_axis(close, near, 1)
        between = 1 - np.einsum("rid,rjd->rij", unit[near], unit[near])
        alive = np.ones_like(distance, bool)
        for column in range(DEGREE):
            best = np.where(alive, distance, np.inf).argmin(axis=1)
            some = alive[rows, best]
            if not some.any():
                break
            kept[at : at + TOGETHER][some, column] = near[rows, best][some]
            alive &= ALPHA * between[rows, best] > distance
            alive[rows, best] = False
    return kept


def _shard_lists(part: pd.DataFrame) -> pd.DataFrame:
    lists = []
    nodes = part["node"].to_numpy(np.int64)
    kept = robust_graph(_unit(part["embedding"]).astype(np.float32))
    for row in kept:
        lists.append(nodes[row[row >= 0]].tolist())
    return pd.DataFrame({"node": nodes, "near": lists, "cell": part["cell"]})


def _neighbours(nodes: np.ndarray, lists: pd.Series) -> np.ndarray:
    """The lists' places in this shard, both ways, padded with -1; edges out of the shard are
    left out. Without the way back, what is nobody's near neighbour could not be reached."""
    size, order = len(nodes), np.argsort(nodes)
    known = nodes[order]
    lengths = [0 if near is None else len(near) for near in lists]
    ends = np.concatenate([np.zeros(0, np.int64), *[np.asarray(near, np.int64) for near in lists if near is not None]])
    at = np.minimum(np.searchsorted(known, ends), size - 1)
    inside = known[at] == ends
    i, j = np.repeat(np.arange(size), lengths)[inside], order[at[inside]]
    i, j = np.divmod(np.unique(np.concatenate([i * size + j, j * size + i])), size)
    degrees = np.bincount(i, minlength=size)
    places = np.full((size, max(1, degrees.max(initial=0))), -1, np.int64)
    places[i, np.arange(len(i)) - (np.cumsum(degrees) - degrees)[i]] = j
    return places


def beam_search(unit: np.ndarray, places: np.ndarray, asked: np.ndarray, start: int) -> np.ndarray:
    """Which vectors each search has seen (rows: searches), greedily from ``start``."""
    count, rows = len(asked), np.arange(len(asked))
    seen = np.zeros((count, len(unit)), bool)
    seen[:, start] = True
    beam = np.full((count, BEAM), start)
    close = np.full((count, BEAM), -np.inf)
    close[:, 0] = unit[asked] @ unit[start]
    done = close == -np.inf
    while True:
        best = np.where(done, -np.inf, close).argmax(axis=1)
        active = np.flatnonzero(~done[rows, best])
        if not active.size:
            return seen
        done[active, best[active]] = True
        near = places[beam[active, best[active]]]
        new = (near >= 0) & ~seen[active[:, None], near]
        seen[active[:, None].repeat(near.shape[1], axis=1)[new], near[new]] = True
        score = np.where(new, np.einsum("qd,qnd->qn", unit[asked[active]], unit[near]), -np.inf)
        scores, ids = np.concatenate([close[active], score], axis=1), np.concatenate([beam[active], near], axis=1)
        flags = np.concatenate([done[active], ~new], axis=1)
        top = np.argsort(-scores, axis=1, kind="stable")[:, :BEAM]
        close[active], beam[active], done[active] = (np.take_along_axis(x, top, 1) for x in (scores, ids, flags))


def range_links(unit: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links of a shard: places of both ends. What is searched for is in its own range,
    so its neighbours are expanded too."""
    start = int((unit @ unit.sum(axis=0)).argmax())  # the medoid
    single = unit.astype(np.float32)
    together = max(1, EXPANSION // places.shape[1])
    for at in range(0, len(unit), TOGETHER):
        asked = np.arange(at, min(at + TOGETHER, len(unit)))
        seen = beam_search(single, places, asked, start)
        seen[np.arange(len(asked)), asked] = True
        q, x = np.nonzero(seen)
        fits = _cosines(single, asked[q], x) >= EXPANDED
        todo = [(q[fits], x[fits])]
        while todo:  # expand all in range
            q, x = todo.pop()
            if len(q) > together:
                todo += [(q[b : b + together], x[b : b + together]) for b in range(0, len(q), together)]
                continue
            links = (asked[q] != x) & (_cosines(unit, asked[q], x) >= COSINE)
            yield asked[q[links]], x[links]
            near = places[x]
            q, near = q.repeat(near.shape[1]), near.ravel()
            new = near >= 0
            new[new] = ~seen[q[new], near[new]]
            q, x = np.divmod(np.unique(q[new] * len(unit) + near[new]), len(unit))
            seen[q, x] = True
            fits = _cosines(single, asked[q], x) >= EXPANDED
            if fits.any():
                todo.append((q[fits], x[fits]))


def _cosines(unit: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    parts = [np.einsum("nd,nd->n", unit[left[b : b + PAIRS]], unit[right[b : b + PAIRS]]) for b in range(0, len(left), PAIRS)]
    return np.concatenate(parts) if parts else np.zeros(0, unit.dtype)


def _shared_earlier(cells: list[np.ndarray], this: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Tells of pairs of places whether both ends are in a cell before ``this`` one too."""
    earlier = [np.asarray(c, np.int64) for c in cells]
    earlier = [c[c < this] for c in earlier]
    rows = np.repeat(np.arange(len(cells)), [len(c) for c in earlier])
    known, columns = np.unique(np.concatenate([np.zeros(0, np.int64), *earlier]), return_inverse=True)
    bits = np.zeros((len(cells), len(known) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (rows, columns >> 6), np.uint64(1) << (columns & 63).astype(np.uint64))
    return lambda i, j: (bits[i] & bits[j]).any(axis=1)


def _shard_links(part: pd.DataFrame, audited: np.ndarray) -> pd.DataFrame:
    """What a shard found, as rows ``kind, a, b``: ``COUNT`` (class, number of vectors that the links
    which belong to this shard lead to), ``SPAN`` (links that hold its components together) and
    ``AUDIT`` (audited class, other end of a counted link)."""
    nodes, own = part["node"].to_numpy(np.int64), part["own"].to_numpy(np.int64)
    size, copies = len(nodes), part["copies"].to_numpy(np.int64)
    within = bool((part["own"] == part["other"]).all())
    shared = _shared_earlier(list(part["homes"]), int(part["cell"].iloc[0]))
    keys = [np.unique(np.minimum(i, j) * size + np.maximum(i, j)) for i, j in range_links(_unit(part["embedding"]), _neighbours(nodes, part["near"]))]
    found = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    others, labels, asked = np.zeros(size, np.int64), np.arange(size), np.isin(nodes, audited)
    rows = []
    for at in range(0, len(found), PAIRS):
        i, j = np.divmod(found[at : at + PAIRS], size)
        labels = merge_labels(labels, i, j)
        counted = ~shared(i, j)
        if not within:  # ends in one slice meet in that slice's own shard
            counted &= own[i] != own[j]
        i, j = i[counted], j[counted]
        np.add.at(others, i, copies[j])
        np.add.at(others, j, copies[i])
        for x, y in ((i, j), (j, i)):
            rows.append((AUDIT, nodes[x[asked[x]]], nodes[y[asked[x]]]))
    linked = np.flatnonzero(others)
    rows.append((COUNT, nodes[linked], others[linked]))
    lower = np.flatnonzero(labels != np.arange(size))
    rows.append((SPAN, nodes[lower], nodes[labels[lower]]))
    kinds = np.repeat([kind for kind, _, _ in rows], [len(a) for _, a, _ in rows])
    return pd.DataFrame({"kind": kinds, "a": np.concatenate([a for _, a, _ in rows]), "b": np.concatenate([b for _, _, b in rows])})


def searched(nodes: DataFrame, audited: np.ndarray, overlap: int = OVERLAP) -> DataFrame:
    """``kind, a, b``: what the shards found of ``nodes`` (node, embedding, copies)."""
    cell = F.col("cluster").cast("long") * (1 << 20) + F.col("code")
    shards = staged(sharded(nodes, overlap).withColumn("cell", cell), "shards")
    lists = shards.groupBy("cluster", "code", "pair").applyInPandas(_shard_lists, "node long, near array<long>, cell long")
    near = F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")
    union = lists.groupBy("node").agg(near, F.collect_set("cell").alias("homes")).join(nodes.select("node", "copies"), "node")
    rows = shards.join(staged(union, "adjacency"), "node")
    return staged(rows.groupBy("cluster", "code", "pair").applyInPandas(lambda part: _shard_links(part, audited), "kind int, a long, b long"), "found")


def audit_sample(nodes: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """At most ``AUDITED`` classes drawn by hash, and all their true links (``a, b``) by brute force."""
    picked = nodes.orderBy(F.xxhash64(F.lit("audit"), "node")).limit(AUDITED).select("node", "embedding").collect()
    asked = pd.DataFrame({"node": [r[0] for r in picked], "embedding": [r[1] for r in picked]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["embedding"].map(len)):
                ours = asked[asked["embedding"].map(len) == size]
                if len(ours):
                    i, j = np.nonzero(_unit(ours["embedding"]) @ _unit(part["embedding"]).T >= COSINE)
                    a, b = ours["node"].to_numpy()[i], part["node"].to_numpy()[j]
                    yield pd.DataFrame({"a": a[a != b], "b": b[a != b]})

    true = staged(nodes.select("node", "embedding").mapInPandas(compare, "a long, b long"), "true-links")
    return asked["node"].to_numpy(np.int64), true


def audited_recall(true: DataFrame, found: DataFrame) -> float | None:
    """Mean share of its true links that was counted, over the audited classes that have any."""
    hits = found.where(F.col("kind") == AUDIT).select("a", "b", F.lit(1).alias("hit"))
    shares = true.join(hits, ["a", "b"], "left").groupBy("a").agg((F.count("hit") / F.count("*")).alias("share"))
    return shares.agg(F.avg("share")).first()[0]


def near_duplicates(rows: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept, recall`` for every row of ``rows`` (vec_id,
    embedding); other columns are not read. ``recall`` is the audit's."""
    nodes = classes(rows.select("vec_id", "embedding"))
    audited, true = audit_sample(nodes)
    overlap = OVERLAP
    links = searched(nodes, audited, overlap)
    while (recall := audited_recall(true, links)) is not None and recall < RECALL and overlap < 8 * OVERLAP:
        overlap *= 2
        links = searched(nodes, audited, overlap)
    spanning = links.where(F.col("kind") == SPAN).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = staged(lowest_reachable(nodes.select("node", "first"), spanning), "vector-components")
    counts = links.where(F.col("kind") == COUNT).groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("others"))
    known = nodes.join(found, "node").join(staged(counts, "link-counts"), "node", "left")
    known = staged(known.select("embedding", "component", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known-classes")
    out = rows.select("vec_id", "embedding").join(known, "embedding", "left")
    component = F.coalesce("component", "vec_id")
    kept = F.col("vec_id").eqNullSafe(component)
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"), F.lit(recall).cast("double").alias("recall"))


def op7_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
