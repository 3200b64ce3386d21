"""SimHash near-duplicates: a Gray-order hierarchical index over 64-bit fingerprints.

The distinct fingerprints are sorted by Gray rank over range partitions and cut into blocks of
neighbours. Neighbours share leading bits, so every node of the index keeps the mask of the bits
that all below it share, and their pattern: leaves and inner nodes inside a block, blocks, and
upper nodes of eight, up to one root. A search compares pairs of nodes from the root down. The
differences of two patterns on bits that both masks have add up on the way down and never shrink, so
they are a lower bound; where it exceeds 3 the pair goes, with all pairs of fingerprints below it.
The upper levels are joins of each pair's children by parent; a pair of blocks that is left is
searched in one task, which holds two blocks; surviving leaves are compared bit by bit. Nothing is
estimated, and no level is left out for small input: no link is lost.

Results: null and word-less texts have fingerprint zero and link like any other; copies share a
fingerprint and are represented once in the index. Repeated rows each get a row; null ids get a
component like other rows and are never its smallest id unless it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm.graph import lowest_reachable, merge_labels
from eventweir.llm.tables import fresh, own_columns, staged, table

SEED = 42
WORDS = 3
DISTANCE = 3
#: Fingerprints of a block and of a leaf; children of a node inside a block, and above (a power of 2).
BLOCK = 1 << 14
LEAF = 16
FANOUT = 4
UPPER_BITS = 3
#: Node pairs that a task expands at a time.
PAIRS = 1 << 12


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """XXH64 of every shingle; of the whole sequence if it is shorter; none without words."""
    from xxhash import xxh64_intdigest

    tokens = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxh64_intdigest(joined, SEED)] if tokens else [], np.uint64)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - words].tolist()
    spans = zip(starts, ends[words - 1 :].tolist(), strict=True)
    return np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in spans], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed 64-bit integer."""
    counts = np.zeros(64, np.int64)
    for at in range(0, hashes.size, 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > hashes.size).view(">u8")[0].astype(np.uint64).astype(np.int64))


def fingerprint(text: Column, words: int = WORDS) -> Column:
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([majority(shingle_hashes(t.as_py() or "", words)) for t in texts], pa.int64())

    return simhash(text)


def gray_rank(prints: np.ndarray) -> np.ndarray:
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _ranked(fingerprint: Column) -> Column:
    """Gray rank of a fingerprint, as a long that sorts like the unsigned one."""
    for shift in (1, 2, 4, 8, 16, 32):
        fingerprint = fingerprint.bitwiseXOR(F.shiftrightunsigned(fingerprint, shift))
    return fingerprint.bitwiseXOR(F.lit(-(1 << 63)))


def _levels(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Masks and patterns of a block's nodes, leaves first. ``prints`` in Gray order."""
    cuts = np.arange(0, prints.size, LEAF)
    ones, zeros = np.bitwise_and.reduceat(prints, cuts), np.bitwise_and.reduceat(~prints, cuts)
    levels = [(ones | zeros, ones)]
    while ones.size > 1:
        cuts = np.arange(0, ones.size, FANOUT)
        ones, zeros = np.bitwise_and.reduceat(ones, cuts), np.bitwise_and.reduceat(zeros, cuts)
        levels.append((ones | zeros, ones))
    return levels


def _children(pairs: np.ndarray, fanout: int, sizes: tuple[int, int], same: bool) -> np.ndarray:
    """All pairs of the children of each node pair; of a node with itself (``same`` block) once."""
    step = np.arange(fanout)
    left = (pairs[:, :1] * fanout + step).repeat(fanout, axis=1).ravel()
    right = np.tile(pairs[:, 1:] * fanout + step, (1, fanout)).ravel()
    fits = (left < sizes[0]) & (right < sizes[1])
    if same:
        fits &= left <= right
    return np.stack([left[fits], right[fits]], axis=1)


def block_links(one: np.ndarray, other: np.ndarray | None = None, distance: int = DISTANCE) -> Iterator[np.ndarray]:
    """Index pairs of fingerprints (in Gray order) of one block, or of two, that link."""
    same = other is None
    sides = (one, one if same else other)
    trees = tuple(_levels(side) for side in sides)
    deep = max(map(len, trees)) - 1
    todo = [(deep, np.zeros((1, 2), np.int64))]
    while todo:
        depth, pairs = todo.pop()
        if len(pairs) > PAIRS:
            todo += [(depth, pairs[at : at + PAIRS]) for at in range(0, len(pairs), PAIRS)]
            continue
        # The root of a lower tree stands for itself on the levels above it.
        (mask, pattern), (mask_, pattern_) = (tree[min(depth, len(tree) - 1)] for tree in trees)
        i, j = pairs.T
        pairs = pairs[np.bitwise_count((pattern[i] ^ pattern_[j]) & mask[i] & mask_[j]) <= distance]
        if depth:
            todo.append((depth - 1, _children(pairs, FANOUT, tuple(tree[min(depth - 1, len(tree) - 1)][0].size for tree in trees), same)))
            continue
        pairs = _children(pairs, LEAF, (sides[0].size, sides[1].size), same)
        if same:
            pairs = pairs[pairs[:, 0] < pairs[:, 1]]
        yield pairs[np.bitwise_count(sides[0][pairs[:, 0]] ^ sides[1][pairs[:, 1]]) <= distance]


def pair_forest(one: np.ndarray, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a block, or of two, that are linked there, and for each a fingerprint of the
    other links' group: enough links to connect what is linked."""
    both = one if other is None else np.concatenate([one, other])
    shift = 0 if other is None else one.size
    labels = np.arange(both.size)
    for pairs in block_links(one, other):
        labels = merge_labels(labels, pairs[:, 0], pairs[:, 1] + shift)
    linked = labels != np.arange(both.size)
    return both[linked], both[labels[linked]]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted fingerprints of a partition to blocks: their number, what all share, and themselves."""
    part = TaskContext.get().partitionId()
    number, held = 0, np.zeros(0, np.uint64)

    def block(prints: np.ndarray) -> pa.RecordBatch:
        ones, zeros = np.bitwise_and.reduce(prints), np.bitwise_and.reduce(~prints)
        values = [part, number, *(int(x.astype(np.int64)) for x in (ones, zeros))]
        arrays = [pa.array([v], t) for v, t in zip(values, (pa.int64(),) * 4, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([prints.tobytes()], pa.binary())], names=["part", "number", "ones", "zeros", "prints"])

    for batch in batches:
        held = np.concatenate([held, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)])
        while held.size >= BLOCK:
            yield block(held[:BLOCK])
            number, held = number + 1, held[BLOCK:]
    if held.size:
        yield block(held)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks (the second null: a block with itself) to links."""
    for batch in batches:
        for one, other in zip(*batch.columns, strict=True):
            sides = [np.frombuffer(x.as_py(), np.uint64) if x.is_valid else None for x in (one, other)]
            a, b = pair_forest(*sides)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def index_blocks(prints: DataFrame) -> DataFrame:
    """``id, ones, zeros, prints``: blocks of distinct ``fingerprint`` in Gray order. Ids are in that
    order too, so that ids without their last bits name the upper nodes."""
    dealt = prints.select("fingerprint", _ranked(F.col("fingerprint")).alias("rank"))
    dealt = dealt.repartitionByRange("rank").sortWithinPartitions("rank").select("fingerprint")
    blocks = staged(dealt.mapInArrow(_blocks, "part long, number long, ones long, zeros long, prints binary"), "blocks")
    most = blocks.agg(F.max("number")).first()[0] or 0
    bits = -(-int(most).bit_length() // UPPER_BITS) * UPPER_BITS
    return blocks.select((F.shiftleft("part", bits) + F.col("number")).alias("id"), "ones", "zeros", "prints")


def near_blocks(blocks: DataFrame) -> tuple[DataFrame, list[int]]:
    """``i, j``: pairs of blocks that can hold links, i <= j, and how many pairs of nodes were left
    at each level, the root first. A level's pairs are the children's of those left above it, by two
    equi-joins on the parents; only these narrow tables meet, no fingerprints."""
    masks = staged(blocks.select("id", "ones", "zeros"), "block-masks")
    top = masks.agg(F.max("id")).first()[0] or 0
    height = -(-int(top).bit_length() // UPPER_BITS)

    def nodes(level: int) -> DataFrame:
        node = F.shiftright("id", level * UPPER_BITS)
        shared = masks.groupBy(node.alias("id")).agg(F.bit_and("ones").alias("ones"), F.bit_and("zeros").alias("zeros"))
        return shared.select("id", F.shiftright("id", UPPER_BITS).alias("parent"), "ones", F.col("ones").bitwiseOR(F.col("zeros")).alias("mask"))

    pairs = nodes(height).select(F.col("id").alias("i"), F.col("id").alias("j"))
    left = []
    for level in range(height - 1, -1, -1):
        children = nodes(level)
        one, other = (children.select(*[F.col(c).alias(f"{c}_{side}") for c in children.columns]) for side in "ij")
        found = pairs.join(one, F.col("i") == F.col("parent_i")).join(other, F.col("j") == F.col("parent_j"))
        bound = F.bit_count(F.col("ones_i").bitwiseXOR(F.col("ones_j")).bitwiseAND(F.col("mask_i")).bitwiseAND(F.col("mask_j")))
        pairs = staged(found.where((F.col("id_i") <= F.col("id_j")) & (bound <= DISTANCE)).select(F.col("id_i").alias("i"), F.col("id_j").alias("j")), "near-nodes")
        left.append(pairs.count())
    return pairs, left


def near_links(prints: DataFrame) -> DataFrame:
    """``a, b``: links between distinct fingerprints, enough to connect all that are linked."""
    blocks = staged(index_blocks(prints), "index")
    pairs, _ = near_blocks(blocks)
    one, other = blocks.select(F.col("id").alias("i"), F.col("prints").alias("one")), blocks.select(F.col("id").alias("j"), F.col("prints").alias("other"))
    # Dealt out by pair, so that one block's pairs are searched by many tasks.
    whole = pairs.join(one, "i").join(other, "j").select("i", "j", "one", F.when(F.col("i") != F.col("j"), F.col("other")).alias("other"))
    # Into as many parts as there are: a pair has few bytes for its work, so parts are not joined by bytes.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return whole.repartition(parts, "i", "j").select("one", "other").mapInArrow(_searched, "a long, b long")


def _classes(rows: DataFrame, *first: Column) -> DataFrame:
    """One row per fingerprint of ``rows`` with aggregates, its component's ``root`` (a fingerprint)
    and the smallest id of that component."""
    nodes = staged(rows.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("first"), *first), "classes")
    return lowest_reachable(nodes, near_links(nodes.select(F.col("node").alias("fingerprint"))))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component``: each row's fingerprint (long) and the smallest id that it
    reaches. Other columns of ``docs`` are not read."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fingerprint"))
    rows = staged(rows, "fingerprints")
    nodes = _classes(rows).withColumnRenamed("node", "fingerprint")
    return rows.join(nodes, "fingerprint").select("doc_id", "fingerprint", "component")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each component: the one with the smallest id, null ids last; of rows that share
    it, the first one read. Rows are told apart by a number that is written with them, not by id."""
    row, prints, whole = fresh(docs, "row", "fingerprint", "document")
    rows = docs.select(
        F.struct(*own_columns(docs)).alias(whole),
        F.col("doc_id").alias("doc_id"),
        F.monotonically_increasing_id().alias(row),
        fingerprint(F.col("text")).alias(prints),
    )
    rows = staged(rows, "documents-and-fingerprints")
    narrow = rows.select("doc_id", F.col(row).alias("row"), F.col(prints).alias("fingerprint"))
    nodes = staged(_classes(narrow).select(F.col("node").alias("fingerprint"), "root"), "roots")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    best = narrow.groupBy("fingerprint").agg(F.min(place).alias("best")).join(nodes, "fingerprint")
    kept = staged(best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row")), "kept")
    # Those that go are fewer, mostly few enough to be sent to all tasks; Spark decides by their size.
    gone = staged(narrow.select("row").join(kept, "row", "left_anti").withColumnRenamed("row", row), "gone")
    return rows.join(gone, row, "left_anti").select(f"{whole}.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
