"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; its identity is a digest chained from turn to turn
while the sorted turns stream by, so no conversation is ever held. Members are counted by an aggregate
that is combined before the shuffle.

Subtree sums come from a centroid decomposition of the forest of parent edges. A component's
centroid is its deepest node whose subtree within the component has at least half of the
component's nodes; without it, no part has more than half. What the centroid's own part sums to
(its value and the totals of the components below it) is its result within the component, and
is added to every node on the path from the centroid to the component's top; everything else is
found inside the parts. So each value travels through at most as many additions as the logarithm
of the node count, however deep or bushy the trie is, and a hub or a long chain is no special case.

Components of more than ``LOCAL`` nodes are split by DataFrame rounds. A conversation knows the
nodes of its path, so subtree sizes, the parts below a centroid and the path above it follow from
windows over single conversations and aggregates; one small row per split component is all that
is shared. Components of at most ``LOCAL`` nodes are dealt out and split further inside tasks.

Defined results: turns are ordered by number, nulls first, those of one number by role and text, so
that reruns agree; null role or text is empty; rows whose ``conv_id`` is null belong to no
conversation and are left out; repeated rows are turns of their own; a conversation that has no
turn is a member of the root; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweir.llm.tables import staged, table

FAMILY = 20
SHARED = 4
#: Nodes of a component that one task splits further.
LOCAL = 1 << 11
#: Ids that are joined into one text before the texts of a node are digested in order.
CHUNK = 1 << 12
ROOT = bytes(16)
BATCH = 1 << 14


def _dealt(turns: DataFrame) -> DataFrame:
    conv = F.col("conv_id").cast("long")
    rows = turns.where("conv_id is not null").select(
        (conv - conv % FAMILY).alias("family"),
        conv.alias("conv"),
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    own = (F.col("conv") != F.col("family")).alias("_member")  # a family's first conversation comes first
    rows = rows.repartition("family").sortWithinPartitions("family", own, "conv", F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("family", "conv", "role", "text")


class _Path:
    """The nodes of one conversation, turn by turn; the last one waits until it is known to be so."""

    def __init__(self, conv: int) -> None:
        self.conv, self.depth, self.node = conv, 0, ROOT
        self.row = (conv, 0, ROOT, None, 0)

    def turn(self, role: str, text: str) -> tuple:
        done = (*self.row, False)
        said = text.encode()
        parent, who = self.node, role.encode()
        self.node = hashlib.blake2b(b"%s%d:%s%s" % (parent, len(who), who, said), digest_size=16).digest()
        self.depth += 1
        self.row = (self.conv, self.depth, self.node, parent, len(said.split()))  # bytes: ASCII white space only
        return done

    def end(self) -> tuple:
        return (*self.row, True)


PATHS = "conv long, depth long, node binary, parent binary, words long, last boolean"
_PATHS_ARROW = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("words", pa.int64()), ("last", pa.bool_())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rebuilt_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole families, sorted, to the paths of their rebuilt conversations. A family's first
    turns are held, no more than any of its conversations can take over."""
    out: list[tuple] = []
    path: _Path | None = None
    family, lent, skip = None, [], 0
    for batch in batches:
        for its, conv, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if its != family:
                family, lent = its, []
            if path is None or conv != path.conv:
                if path is not None:
                    out.append(path.end())
                path, skip = _Path(conv), 0
                if conv != family:
                    skip = zlib.crc32(str(conv).encode()) % SHARED
                    out += [path.turn(*turn) for turn in lent[:skip]]
            if conv == family and len(lent) < SHARED - 1:
                lent.append((role, text))
            if skip:
                skip -= 1
            else:
                out.append(path.turn(role, text))
            if len(out) >= BATCH:
                yield _batch(out, _PATHS_ARROW)
                out = []
    if path is not None:
        yield _batch([*out, path.end()], _PATHS_ARROW)


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv) rows to runs of ids: ``node, first, ids``."""
    schema = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    node, held = None, []
    for batch in batches:
        out: list[tuple] = []
        for its, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and (its != node or len(held) == CHUNK):
                out.append((node, held[0], ",".join(map(str, held))))
                held = []
            node = its
            held.append(conv)
        if out:
            yield _batch(out, schema)
    if held:
        yield _batch([(node, held[0], ",".join(map(str, held)))], schema)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.binary()), ("ends", pa.string())])
    node, digest = None, None
    for batch in batches:
        out: list[tuple] = []
        for its, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if digest is not None and its == node:
                digest.update(b",")
            else:
                if digest is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = its, hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield _batch(out, schema)
    if digest is not None:
        yield _batch([(node, digest.hexdigest())], schema)


def end_digests(paths: DataFrame) -> DataFrame:
    """``node, ends``: SHA-256 of the ids, in order, of the conversations that end at a node. A node
    where very many end is spread over range partitions, and only joined ids meet in one task."""
    ends = paths.where("last").select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    runs = ends.mapInArrow(_joined_ids, "node binary, first long, ids string")
    runs = runs.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
    return runs.mapInArrow(_digested, "node binary, ends string")


def rollup(parent: list[int], *values: list[int]) -> list[list[int]]:
    """Subtree sums of each of ``values`` in a forest in which parents (-1: none) come before their
    children, by centroid decomposition."""
    up, alive = list(parent), list(range(len(parent)))
    size, top = [0] * len(parent), [0] * len(parent)
    splits: list[tuple[int, int, list[int]]] = []
    while alive:
        for v in alive:
            size[v] = 1
        for v in reversed(alive):
            if up[v] >= 0:
                size[up[v]] += size[v]
        centroid: dict[int, int] = {}
        for v in alive:
            top[v] = v if up[v] < 0 else top[up[v]]
            if 2 * size[v] >= size[top[v]]:
                centroid[top[v]] = v  # these nodes are a chain: the deepest comes last
        below: dict[int, list[int]] = {c: [] for c in centroid.values()}
        splits += [(c, t, below[c]) for t, c in centroid.items()]
        rest = []
        for v in alive:
            if v in below:
                continue
            if up[v] in below:
                below[up[v]].append(v)
                up[v] = -1
            rest.append(v)
        alive = rest
    sums = [list(value) for value in values]
    for c, t, tops in reversed(splits):
        for total in sums:
            part = total[c] + sum(total[k] for k in tops)
            total[c] = part
            v = c
            while v != t:
                v = parent[v]
                total[v] += part
    return sums


def _local_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (top, depth) to subtree sums within their components, many small ones at a time."""
    schema = pa.schema([("node", pa.binary()), ("leaves", pa.int64()), ("saved", pa.int64())])

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        place: dict[bytes, int] = {}
        parents = []
        for at, (top, node, parent, _, _) in enumerate(rows):
            place[node] = at
            parents.append(-1 if node == top else place[parent])
        leaves, saved = rollup(parents, [r[3] for r in rows], [r[4] for r in rows])
        return _batch(list(zip([r[1] for r in rows], leaves, saved, strict=True)), schema)

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if len(held) >= LOCAL and held[-1][0] != row[0]:
                yield solved(held)
                held = []
            held.append(row)
    if held:
        yield solved(held)


def subtree_sums(paths: DataFrame, nodes: DataFrame, local: int = LOCAL) -> DataFrame:
    """``node, leaves, saved``: sums over each node's subtree of the columns ``leaf`` and ``saved`` of
    ``nodes`` (node, parent, conv, depth, leaf, saved); ``conv`` is the smallest member. ``paths`` has
    all of ``conv, depth, node``."""
    small = nodes.select(F.lit(ROOT).alias("top"), "node", "parent", "depth", "leaf", "saved")
    n_nodes = nodes.count()
    parts: list[DataFrame] = []
    if n_nodes > local:
        # A node is owned by its smallest member: its row in that conversation's path stands for it.
        values = nodes.select("conv", "depth", "parent", "leaf", "saved", F.lit(1).alias("own"))
        rows = paths.select("conv", "depth", "node").join(values, ["conv", "depth"], "left")
        rows = rows.withColumn("owns", F.max("own").over(Window.partitionBy("conv"))).where("owns = 1").drop("owns")
        rows = rows.withColumn("own", F.coalesce("own", F.lit(0))).withColumn("top", F.lit(ROOT))
        rows = staged(rows, "trie-open")
        done: list[DataFrame] = []
        while not rows.isEmpty():
            rows, finished, sums = _split(rows, local)
            done.append(finished)
            parts.append(sums)
        small = done[0]
        for more in done[1:]:
            small = small.unionAll(more)
    dealt = small.repartition("top").sortWithinPartitions("top", "depth").select("top", "node", "parent", "leaf", "saved")
    sums = dealt.mapInArrow(_local_sums, "node binary, leaves long, saved long")
    for part in parts:
        sums = sums.unionAll(part)
    return sums.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")) if parts else sums


def _split(rows: DataFrame, local: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: every component of ``rows`` loses its centroid. Returns the rows of parts that are
    still too large, the nodes of the others, and the sums that the centroids bring to themselves
    and to the nodes above them."""
    path = Window.partitionBy("conv", "top")
    below = F.sum("own").over(path.orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sized = rows.withColumn("below", below).groupBy("top", "node", "depth")
    sized = staged(sized.agg(F.sum("below").alias("size"), F.max(F.when(F.col("own") == 1, F.col("conv"))).alias("owner")), "trie-sizes")
    total = sized.where("node = top").select("top", F.col("size").alias("total"))
    heavy = sized.join(total, "top").where("2 * size >= total")
    centroid = heavy.groupBy("top").agg(F.max_by(F.struct("node", "depth", "owner"), "depth").alias("c"))
    centroid = staged(centroid.select("top", F.col("c.node").alias("c"), F.col("c.depth").alias("c_depth"), F.col("c.owner").alias("c_owner")), "trie-centroids")
    cut = rows.join(centroid, "top")
    through = F.max((F.col("node") == F.col("c")).cast("int")).over(path) == 1
    head = F.max(F.when(F.col("depth") == F.col("c_depth") + 1, F.col("node"))).over(path)
    cut = staged(cut.select("*", through.alias("through"), head.alias("head")), "trie-cut")
    part = cut.where("through and depth >= c_depth").groupBy("c").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    part = staged(part, "trie-parts")
    above = cut.where("conv = c_owner and depth <= c_depth").select("c", "node")
    sums = above.join(part, "c").select("node", "leaves", "saved")
    rest = cut.where("node <> c").select("conv", "depth", "node", "parent", "leaf", "saved", "own", F.when(F.expr("through and depth > c_depth"), F.col("head")).otherwise(F.col("top")).alias("top"))
    rest = staged(rest, "trie-rest")
    large = staged(rest.groupBy("top").agg(F.sum("own").alias("n")).where(F.col("n") > local).select("top"), "trie-large")
    open_ = staged(rest.join(large, "top", "left_semi").select(*rows.columns), "trie-open")
    finished = rest.where("own = 1").join(large, "top", "left_anti").select("top", "node", "parent", "depth", "leaf", "saved")
    return open_, finished, staged(sums, "trie-sums")


def trie(turns: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``turns`` (conv_id, turn, role,
    text): ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    paths = staged(_dealt(turns).mapInArrow(_rebuilt_paths, PATHS), "trie-paths")
    nodes = paths.groupBy("node").agg(
        F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("words").alias("words"), F.count("*").alias("n_convs")
    )
    nodes = staged(nodes, "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")})
    nodes = staged(nodes, "trie-values")
    sums = staged(subtree_sums(paths, nodes, local), "trie-subtrees").withColumnRenamed("saved", "saved_tokens")
    ends = staged(end_digests(paths), "trie-ends")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    whole = nodes.join(sums, "node").join(ends, "node", "left").join(parents, "parent", "left")
    return whole.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        "saved_tokens",
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH RECURSIVE bits AS (
    SELECT CAST(i AS UBIGINT) AS i FROM range(256) t(i)
), crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS UBIGINT)) ELSE a // 2 END) AS c
        FROM bits)
), o AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, xor(list_reduce(
        list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
        lambda a, b: xor(a // 256, t[CAST(xor(a % 256, b) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM o), crc_table
), r AS (
    SELECT c.conv_id, n, role, text FROM convs c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.n <= c.h
    UNION ALL
    SELECT c.conv_id, n, role, text FROM convs c JOIN o ON o.conv_id = c.conv_id AND o.n > c.h
), numbered AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY n) AS d FROM r
), paths AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS depth, '' AS node, CAST(NULL AS VARCHAR) AS parent, 0 AS words FROM convs
    UNION ALL
    SELECT p.conv_id, n.d, sha256(concat(p.node, length(n.role), ':', n.role, n.text)), p.node,
        len(regexp_extract_all(n.text, '[^\x20\x09-\x0D]+'))
    FROM paths p JOIN numbered n ON n.conv_id = p.conv_id AND n.d = p.depth + 1
), lasts AS (
    SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id
), nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(p.depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (l.depth = p.depth), '')) AS ends_sha256
    FROM paths p JOIN lasts l ON l.conv_id = p.conv_id GROUP BY node
), kids AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
    SELECT p.node, count(*) FILTER (k.n_children IS NULL) AS n_leaves, CAST(sum((x.n_convs - 1) * x.words) AS BIGINT) AS saved_tokens
    FROM nodes x JOIN paths p ON p.conv_id = x.conv_id AND p.depth <= x.depth LEFT JOIN kids k ON k.node = x.node
    GROUP BY p.node
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes up ON up.node = n.parent
"""
