"""Exact byte-level BPE encoding by dynamic programming over prefixes, and decoding.

The ids of a text are those of the merge procedure, found without running the merges. For
every prefix of a piece exactly one token can come last, because the encoding of a prefix is
the only token sequence whose neighbours are all *compatible*: between two compatible tokens
no merge that crosses their boundary ever gets its turn. So one pass over the automaton's
suffix matches stores that last token per prefix, and following the back-pointers from the end
yields the ids. Work is linear in the text times the (bounded) number of suffix matches.

Defined results: null text encodes like an empty one, to no ids; a special token's string in a
text becomes its id; decoding joins the tokens' bytes and replaces malformed UTF-8, ids outside
the vocabulary decode to nothing; very long pieces need memory in proportion to the piece.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm.tables import fresh, slices, table

NEVER = 1 << 60
#: Bytes, about, of a worker's cache of pieces, in each of two generations, and of one entry beside
#: its piece and ids; entries of its table of tested token pairs, of about 100 bytes each.
CACHE_BYTES = 24 << 20
ENTRY_BYTES = 180
CACHED_PAIRS = 1 << 17
CACHED_EDGES = 1 << 14
#: Longer pieces are encoded anew each time, so that the cache's bytes stay bounded too.
CACHED_BYTES = 48


def byte_alphabet() -> dict[str, int]:
    """The vocabulary file's character for each byte: printable Latin-1 stands for itself, the
    other bytes follow from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixEncoder:
    """The tokenizer of one vocabulary file, built once per Python worker."""

    def __init__(self, path: str, pattern: str) -> None:
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.all_bytes = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile(pattern).findall
        self.merges: dict[int, dict[int, int]] = {}  # of a left part: its right parts' ranks
        self.halves: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            pair = (vocab[left], vocab[right])
            self.merges.setdefault(pair[0], {})[pair[1]] = rank
            self.halves[vocab[left + right]] = pair
            self.born[vocab[left + right]] = rank
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, raw in self.all_bytes.items():
            self.automaton.add_word(raw.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.sizes = array("i", [len(self.all_bytes.get(i, b"")) for i in range(max(self.all_bytes, default=0) + 1)])
        self.all_bytes |= {i: s.encode() for s, i in self.special.items()}
        self.by_id = [self.all_bytes.get(i, b"") for i in range(max(self.all_bytes, default=0) + 1)]
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.tested: dict[int, bool] = {}
        self.edge = lru_cache(CACHED_EDGES)(self._edge)

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """The tokens that stand at the token's left (0) or right (1) end while it is built:
        id, rank of the merge that makes it, rank of the merge that takes it up."""
        found, taken_up = [], NEVER
        while True:
            made = self.born.get(token, -1)
            found.append((token, made, taken_up))
            if made < 0:
                return found
            token, taken_up = self.halves[token][side], made

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the boundary. A merge of rank r does if both its parts
        stand there when r comes up; of equal ranks, the leftmost place is merged first."""
        starts = self.edge(right, 0)
        for a, a_made, a_taken in self.edge(left, 1):
            ranks = self.merges.get(a)
            for b, b_made, b_taken in starts if ranks else ():
                rank = ranks.get(b)
                if rank is not None and a_made < rank < a_taken and b_made < rank <= b_taken:
                    return False
        return True

    def encode_piece(self, piece: bytes) -> list[int]:
        last = [-1] * (len(piece) + 1)
        start = [0] * (len(piece) + 1)
        tested, fits = self.tested, True
        if len(tested) > CACHED_PAIRS:
            tested.clear()
        sizes = self.sizes
        for at, token in self.automaton.iter(piece.decode("latin-1")):
            end = at + 1
            if last[end] < 0:
                before = end - sizes[token]
                if before:
                    if last[before] < 0:
                        continue
                    pair = last[before] << 32 | token
                    fits = tested.get(pair)
                    if fits is None:
                        fits = tested[pair] = self.compatible(last[before], token)
                if fits or not before:
                    last[end], start[end] = token, before
        ids, end = [], len(piece)
        while end:
            ids.append(last[end])
            end = start[end]
        ids.reverse()
        return ids

    def _coded(self, piece: str) -> bytes:
        """The piece's ids as packed 32-bit integers, kept if the piece is short. A full cache
        becomes the older generation, from which pieces in use come back."""
        packed = self.older.get(piece)
        if packed is None:
            raw = piece.encode()
            packed = array("i", self.encode_piece(raw)).tobytes()
            if len(raw) > CACHED_BYTES:
                return packed
        self.held += ENTRY_BYTES + len(piece) + len(packed)
        if self.held > CACHE_BYTES:
            self.cache, self.older, self.held = {}, self.cache, 0
        self.cache[piece] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        packed: list[bytes] = []
        coded = self._coded
        for part, special in self._parts(text):
            known = self.cache.get
            packed += [known(piece) or coded(piece) for piece in self.split(part)]
            if special is not None:
                packed.append(array("i", [special]).tobytes())
        return np.frombuffer(b"".join(packed), np.int32)

    def _parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Ordinary text, each time with the special token that follows it."""
        at = 0
        while True:
            found = [(p, -len(s), s) for s in self.special if (p := text.find(s, at)) >= 0]
            if not found:
                yield text[at:], None
                return
            place, _, name = min(found)
            yield text[at:place], self.special[name]
            at = place + len(name)

    def decode(self, ids: np.ndarray) -> str:
        known = ids[(ids >= 0) & (ids < len(self.by_id))]
        return b"".join(map(self.by_id.__getitem__, known.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> PrefixEncoder:
    return PrefixEncoder(path, pattern)


def round_trip(text: Column, name: str = "byte_bpe_50k.json") -> Column:
    """``struct<ids array<int>, decoded string>`` of a text column. ``name`` is a vocabulary
    file of the tokenizer folder, opened on each worker."""

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def bpe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import public_tokenizers

        coder = encoder(public_tokenizers.path(name), public_tokenizers.PATTERN)
        for batch in batches:
            for texts in slices(batch):
                yield _coded(coder, texts)

    return bpe(text)


def _coded(coder: PrefixEncoder, texts: pa.Array) -> pa.Array:
    offsets, flat, decoded = [0], [], []
    for text in texts:
        ids = coder.encode(text.as_py() or "")
        flat.append(ids)
        offsets.append(offsets[-1] + len(ids))
        decoded.append(coder.decode(ids))
    values = pa.array(np.concatenate(flat) if flat else [], pa.int32())
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    return pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], names=["ids", "decoded"])


def encode_decode(docs: DataFrame, text: str = "text", name: str = "byte_bpe_50k.json") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded`` (underscores are added to names already taken).
    Narrow: one pass, no shuffle. An empty table gives an empty table."""
    ids, decoded, both = fresh(docs, "ids", "decoded", "round_trip")
    coded = docs.withColumn(both, round_trip(F.col(text), name))
    return coded.withColumns({ids: F.col(f"{both}.ids"), decoded: F.col(f"{both}.decoded")}).drop(both)


def digests(docs: DataFrame) -> DataFrame:
    """The query's columns: counts and digests of ids and decoded text."""
    coded = encode_decode(docs.select("doc_id", "text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
