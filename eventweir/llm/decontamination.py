"""Benchmark decontamination: an FM-index per training shard, searched backward for test phrases.

A phrase is a window of ten consecutive words of a benchmark item (a shorter item is one phrase).
The benchmark's phrases are the stated query set: they are taken in blocks of a bounded number, and
each block meets all documents once. In a task, each batch of documents is cut into shards. A
word that no phrase of the block has cannot be inside an occurrence, so it only separates; what is left
between separators is indexed: suffix order, its Burrows-Wheeler transform in a wavelet
matrix with rank directories, and sampled suffix positions. All phrases are searched at once,
last word first, by two ranks a level; the positions of those that remain are found by
stepping back to a sampled suffix, and overlapping occurrences are merged into removal spans.

Whole texts are indexed; a run longer than a shard is cut with an overlap of one phrase less a
word, so that no occurrence is lost. Nothing is shuffled but the benchmark.

Defined results: null and word-less texts have no words, hits or items; a null or word-less
benchmark item has no phrase; items that share an id count once; a null id counts as an item but
is left out of the list of ids; an empty benchmark hits nothing; repeated documents each get a row;
an empty table gives an empty table. Names already taken get underscores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm.tables import fresh, staged, table

WINDOW = 10
#: Phrases that are searched in one pass over the documents.
BLOCK = 1 << 18
#: Indexed words of one shard, at most.
SHARD = 1 << 20
#: Every so many words the position of a suffix is kept, and at the start of every run.
SAMPLE = 16
#: Bytes that are part of a word: digits, letters and all that is not ASCII. Capitals become small.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order. 0 separates; separators differ from each other."""
    size = text.size
    gaps = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + gaps.size
    rank[gaps] = np.arange(gaps.size)
    step = 1
    while True:
        after = np.zeros(size, np.int64)
        after[: max(size - step, 0)] = rank[step:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)]) if size else np.zeros(0, np.int64)
        rank[order] = new
        if not size or new[-1] == size - 1:
            return order
        step *= 2


class Bits:
    """A bit vector with constant-time rank: packed words and the count of ones before each."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((bits.size // 64 + 1) * 64, np.uint8)
        padded[: bits.size] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1]
        self.zeros = bits.size - int(bits.sum())

    def ones(self, end: np.ndarray) -> np.ndarray:
        """How many of the first ``end`` bits are set."""
        word = end >> 6
        mask = (np.uint64(1) << (end & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks and symbols of a sequence over 0 to ``top``, one bit vector a level."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.levels: list[Bits] = []
        self.shifts = range(max(int(top).bit_length(), 1) - 1, -1, -1)
        for shift in self.shifts:
            bits = ((symbols >> shift) & 1).astype(np.uint8)
            self.levels.append(Bits(bits))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        start = np.zeros_like(low)
        for shift, bits in zip(self.shifts, self.levels, strict=True):
            one = (symbol >> shift) & 1 == 1
            at = [np.where(one, bits.zeros + n, place - n) for place in (start, low, high) for n in (bits.ones(place),)]
            start, low, high = at
        return low - start, high - start

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the places, and how often each occurs before."""
        symbol, start = np.zeros_like(place), np.zeros_like(place)
        for shift, bits in zip(self.shifts, self.levels, strict=True):
            n, m = bits.ones(place), bits.ones(start)
            one = bits.ones(place + 1) > n
            symbol |= one.astype(np.int64) << shift
            place, start = np.where(one, bits.zeros + n, place - n), np.where(one, bits.zeros + m, start - m)
        return symbol, place - start


class FMIndex:
    """Counts and positions of phrases in a text whose separators are 0."""

    def __init__(self, text: np.ndarray) -> None:
        text = np.append(text, 0).astype(np.int64)
        order = suffix_order(text)
        before = text[order - 1]  # of the first suffix: the last symbol, a separator
        top = int(text.max())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.tree = WaveletMatrix(before, top)
        kept = (order % SAMPLE == 0) | (before == 0)
        self.sampled = Bits(kept.astype(np.uint8))
        self.positions = order[kept]
        self.top = top

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``phrases`` (padded at the front) the suffixes that start with it:
        ``low`` to ``high``."""
        size = int(self.first[-1])
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), size, np.int64)
        alive = np.flatnonzero(sizes > 0)
        width = phrases.shape[1]
        for step in range(width):
            column = phrases[alive, width - 1 - step]
            known = column <= self.top
            high[alive[~known]] = low[alive[~known]] = 0
            at, column = alive[known], column[known]
            a, b = self.tree.rank(column, low[at], high[at])
            low[at], high[at] = self.first[column] + a, self.first[column] + b
            alive = at[(low[at] < high[at]) & (sizes[at] > step + 1)]
            if not alive.size:
                break
        return low, high

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: step back by the last-to-first mapping to a sampled one."""
        found = np.zeros(suffixes.size, np.int64)
        todo, at, steps = np.arange(suffixes.size), suffixes, 0
        while todo.size:
            n = self.sampled.ones(at)
            here = self.sampled.ones(at + 1) > n
            found[todo[here]] = self.positions[n[here]] + steps
            todo, at = todo[~here], at[~here]
            symbol, rank = self.tree.access(at)
            at = self.first[symbol] + rank
            steps += 1
        return found


@dataclass(frozen=True)
class Phrases:
    """A block of phrases as word numbers from 1 on, padded at the front, and the items of each."""

    vocabulary: dict[bytes, int]
    ids: np.ndarray
    sizes: np.ndarray
    owner_starts: np.ndarray
    owners: np.ndarray  # item ids as text, None for a null id

    @classmethod
    def of(cls, rows: list[tuple[str, list[str | None]]]) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        ids = np.zeros((len(rows), WINDOW), np.int64)
        sizes = np.zeros(len(rows), np.int64)
        owners: list[str | None] = []
        starts = [0]
        for at, (phrase, items) in enumerate(rows):
            numbers = [vocabulary.setdefault(word, len(vocabulary) + 1) for word in phrase.encode().split()]
            ids[at, WINDOW - len(numbers) :] = numbers
            sizes[at] = len(numbers)
            owners += items
            starts.append(len(owners))
        return cls(vocabulary, ids, sizes, np.array(starts), np.array(owners, object))

    def runs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the stretches of known words that can hold a phrase."""
        inside = np.concatenate([[0], (numbers > 0).view(np.int8), [0]])
        turns = np.flatnonzero(np.diff(inside))
        starts, ends = turns[::2], turns[1::2]
        long = ends - starts >= self.sizes.min(initial=1 << 60)
        return starts[long], ends[long]

    def occurrences(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``numbers`` (0: separator) and phrases of all occurrences."""
        starts, ends = self.runs(numbers)
        pieces = [(s + at, min(e, s + at + SHARD)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True) for at in range(0, max(e - s - WINDOW + 1, 1), SHARD - WINDOW + 1)]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[tuple[int, int]] = []
        size = 0
        for piece in [*pieces, None]:
            if held and (piece is None or size + piece[1] - piece[0] > SHARD):
                found.append(self._in_shard(numbers, np.array(held)))
                held, size = [], 0
            if piece is not None:
                held.append(piece)
                size += piece[1] - piece[0] + 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, phrases = (np.concatenate(part) for part in zip(*found, strict=True))
        return places, phrases

    def _in_shard(self, numbers: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = pieces[:, 1] - pieces[:, 0] + 1  # with its separator
        ends = np.cumsum(sizes)
        source = np.arange(ends[-1]) + np.repeat(pieces[:, 0] - (ends - sizes), sizes)
        text = numbers[np.minimum(source, numbers.size - 1)]
        text[ends - 1] = 0
        used, text = np.unique(text, return_inverse=True)  # 0 stays 0; the shard's own alphabet
        own = np.searchsorted(used, self.ids)
        own[used[np.minimum(own, used.size - 1)] != self.ids] = used.size  # a word the shard has not
        index = FMIndex(text)
        low, high = index.search(own, self.sizes)
        hits = np.flatnonzero(low < high)
        counts = high[hits] - low[hits]
        suffixes = np.arange(counts.sum()) + np.repeat(low[hits] - (np.cumsum(counts) - counts), counts)
        return source[index.locate(suffixes)], np.repeat(hits, counts)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans, as disjoint spans in order; spans that touch become one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    if not starts.size:
        return starts, reach
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    last = np.concatenate([first[1:], [True]])
    return starts[first], reach[last]


FOUND = "struct<n_words: bigint, spans: array<struct<start: bigint, end: bigint>>, n_null: int, items: array<string>>"


def _searched(text: Column, known: Column, shared: Broadcast) -> Column:
    """What a block's phrases find in each text, united with what is known from other blocks."""

    @F.arrow_udf(FOUND)
    def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        block = Phrases.of(shared.value)
        number = block.vocabulary.get
        for texts, before in batches:
            counts, flat = [], [np.zeros(1, np.int32)]
            for value in texts:
                own = words(value.as_py())
                counts.append(len(own))
                flat.append(np.fromiter([number(w, 0) for w in own], np.int32, len(own)))
                flat.append(np.zeros(1, np.int32))  # separates documents
            sizes = np.array(counts, np.int64) + 1
            starts = np.cumsum(sizes) - sizes + 1
            places, phrases = block.occurrences(np.concatenate(flat))
            document = np.searchsorted(starts, places, "right") - 1
            order = np.argsort(document, kind="stable")
            places, phrases, document = places[order], phrases[order], document[order]
            cuts = np.searchsorted(document, np.arange(len(counts) + 1))
            out = []
            for row, count in enumerate(counts):
                old = before[row].as_py()
                a, b = cuts[row], cuts[row + 1]
                if a == b:
                    out.append(old or {"n_words": count, "spans": [], "n_null": 0, "items": []})
                    continue
                hit = np.unique(phrases[a:b])
                items = {item for p in hit.tolist() for item in block.owners[block.owner_starts[p] : block.owner_starts[p + 1]].tolist()}
                at = places[a:b] - starts[row]
                spans = (at, at + block.sizes[phrases[a:b]])
                if old:
                    items |= set(old["items"]) | ({None} if old["n_null"] else set())
                    spans = (np.append(spans[0], [s["start"] for s in old["spans"]]), np.append(spans[1], [s["end"] for s in old["spans"]]))
                spans = merged(spans[0].astype(np.int64), spans[1].astype(np.int64))
                out.append(
                    {
                        "n_words": count,
                        "spans": [{"start": s, "end": e} for s, e in zip(*(x.tolist() for x in spans), strict=True)],
                        "n_null": int(None in items),
                        "items": sorted(i for i in items if i is not None),
                    }
                )
            yield pa.array(out, _FOUND_ARROW)

    return search(text, known)


_FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("n_null", pa.int32()),
        ("items", pa.list_(pa.string())),
    ]
)


def _phrases_of(text: Column) -> Column:
    @F.arrow_udf("array<string>")
    def windows(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            own = [w.decode() for w in words(value.as_py())]
            out.append([" ".join(own[at : at + WINDOW]) for at in range(max(len(own) - WINDOW + 1, min(len(own), 1)))])
        return pa.array(out, pa.list_(pa.string()))

    return windows(text)


def phrase_table(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``phrase, items``: each different phrase once, with the ids (as text) of the items it is in."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.explode(_phrases_of(F.col(f"`{text}`"))).alias("phrase"))
    # An array of a struct keeps the null id, which a set of bare ids would drop.
    items = F.transform(F.collect_set(F.struct("item")), lambda s: s["item"])
    return rows.groupBy("phrase").agg(items.alias("items"))


def found(docs: DataFrame, benchmark: DataFrame, text: str = "text", block: int = BLOCK) -> tuple[DataFrame, str]:
    """``docs`` with what was found in each text, and the name of that column:
    ``n_words``, merged ``spans`` of words, ``items`` and whether a null item id is among them."""
    spark = docs.sparkSession
    phrases = staged(phrase_table(benchmark), "phrases")
    n_blocks = max(-(-phrases.count() // block), 1)
    (name,) = fresh(docs, "found")
    rows = docs.withColumn(name, F.lit(None).cast(FOUND))
    for at in range(n_blocks):
        if at:  # a pass for each block; what it finds is added to the row
            rows = staged(rows, "searched")
        own = phrases.where(F.pmod(F.xxhash64("phrase"), F.lit(n_blocks)) == at)
        shared = spark.sparkContext.broadcast(sorted((r["phrase"], list(r["items"])) for r in own.collect()))
        rows = rows.withColumn(name, _searched(F.col(f"`{text}`"), F.col(name), shared))
    return rows, name


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items, spans, contaminated``."""
    names = fresh(docs, "n_words", "n_hit", "n_items", "items", "spans", "contaminated")
    rows, name = found(docs, benchmark, text, block)
    n_hit = F.aggregate(F.col(f"{name}.spans"), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    values = [
        F.col(f"{name}.n_words"),
        n_hit,
        (F.size(f"{name}.items") + F.col(f"{name}.n_null")).cast("long"),
        F.col(f"{name}.items"),
        F.col(f"{name}.spans"),
        F.size(f"{name}.spans") > 0,
    ]
    own = [F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*own, *[v.alias(n) for v, n in zip(values, names, strict=True)])


def without_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` whose texts have lost the hit words, from the first letter of a span to its last."""
    rows, name = found(docs, benchmark, text)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, founds: pa.Array) -> pa.Array:
        out = []
        for value, what in zip(texts, founds, strict=True):
            whole, spans = value.as_py(), what.as_py()["spans"]
            if not spans:
                out.append(whole)
                continue
            raw = whole.encode()
            folded = np.frombuffer(raw.translate(FOLD), np.uint8) != 0x20
            turns = np.flatnonzero(np.diff(np.concatenate([[0], folded.view(np.int8), [0]])))
            kept, at = [], 0
            for span in spans:
                kept.append(raw[at : turns[2 * span["start"]]])
                at = turns[2 * span["end"] - 1]
            out.append(b"".join([*kept, raw[at:]]).decode())
        return pa.array(out, pa.string())

    own = [F.col(f"`{c}`") if c != text else cut(F.col(f"`{text}`"), F.col(name)).alias(text) for c in docs.columns]
    return rows.select(*own)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP13_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), p AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), hits AS (
    SELECT o.r, o.i, o.size, p.item_id
    FROM (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
        FROM (SELECT r, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM p) WHERE len(w) >= size)) o
    JOIN p ON p.size = o.size AND p.phrase = o.phrase
), n AS (
    SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS k FROM hits) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS list
    FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN items USING (r)
"""
