"""Personal data: base patterns, and a skip-chain conditional random field that adds spans.

The field's nodes are a document's candidates: the base matches, whose label is known, and other
digit groups and mail-like words, whose label is inferred (mail, address, card, phone or none).
A candidate's own evidence is a softmax over shape features fitted in numpy. Neighbouring
candidates share a chain potential; distant candidates that repeat or resemble each other (same
digits, the end of each other's digits, same mail box) share a skip potential that favours equal
labels. Loopy message passing over chain and skip edges gives each candidate's label
probabilities; a candidate whose label is sure enough adds a span. So a number that is written
without its prefix or separators is found wherever the document also has it in full.

Each candidate links to the first base match of each kind that is like it (else to the first
candidate that is), so edges grow with the candidates, not with their pairs, and a known label
reaches every repeat directly. Messages pass until they converge. Field and features are fitted on a bounded sample of documents; its labels are the
base matches. Detection is narrow: one pass, whole texts, no shuffle.

Positions count code points, ends are exclusive. Null texts are empty and have no spans; repeated
rows each get a row; an empty table gives an empty table. Patterns are searched in linear time on
any text.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm.tables import fresh, own_columns, quoted, slices, table

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: Documents to fit on, about; of each so many candidates and pairs of them, drawn by hash.
SAMPLE = 4000
CANDIDATES_PER_TEXT = 16
PAIRS_PER_TEXT = 64
#: Probability from which a candidate's label adds a span.
SURE = 0.8
#: Largest change of a message (log probability) that counts as converged.
CONVERGED = 1e-4
#: Rounds after which messages that have not converged are damped twice as much. Damping ends
#: every oscillation: messages are bounded, so their change falls below any bound.
PATIENCE = 64
#: Digits that a shorter form of a number must share with the full one.
SHARED_DIGITS = 9

# The contract's patterns. A look-behind or a search from the "@" finds the same matches without
# trying every start inside a run.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Looser forms, for candidates.
NUMBER = re.compile(r"(?<![0-9])[+(]?[0-9](?:[-.() /]{0,2}[0-9])*")
MAIL = re.compile(r"(?:@|\(at\)|\[at\])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _run_before(text: str, end: int, least: int) -> int:
    """Start of the run of mail characters that ends at ``end``, not before ``least``."""
    start = end
    while start > least and (c := text[start - 1]).isascii() and (c.isalnum() or c in "._%+-"):
        start -= 1
    return start


def _mails(text: str, domain: re.Pattern) -> Iterator[tuple[int, int]]:
    taken = 0
    for match in domain.finditer(text):
        start = _run_before(text, match.start(), taken)
        if start < match.start():
            yield start, match.end()
            taken = match.end()


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """All base matches by start, then kind as listed."""
    found = [(0, s, e) for s, e in _mails(text, DOMAIN)] if "@" in text else []
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((3, *m.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Looser matches outside the base spans, kind ``NONE`` for now."""
    gaps, at = [], 0
    for start, end in sorted((s, e) for _, s, e in base):
        if start > at:
            gaps.append((at, start))
        at = max(at, end)
    gaps.append((at, len(text)))
    found = []
    for start, end in gaps:
        part = text[start:end]
        if "@" in part or "(at)" in part or "[at]" in part:
            found += [(NONE, start + s, start + e) for s, e in _mails(part, MAIL)]
        found += [(NONE, start + m.start(), start + m.end()) for m in NUMBER.finditer(part) if m.end() - m.start() >= 7 and len(_digits(m.group())) >= 7]
    return sorted(found, key=lambda s: (s[1], s[2]))


def features(text: str) -> list[float]:
    """The shape of a candidate, without the exact separators that the base patterns ask for."""
    digits = _digits(text)
    n = len(digits)
    mail = any(mark in text for mark in ("@", "(at)", "[at]"))
    parts = [p for p in re.split(r"[^0-9]+", text) if p]
    small = len(parts) == 4 and all(len(p) <= 3 for p in parts) and not mail
    return [1.0, float(mail), float(small), float(not mail and 12 <= n <= 19), float(not mail and 12 <= n <= 19 and luhn(digits)), float(not mail and 9 <= n <= 11), float(not mail and n < 9), float(text.startswith("+"))]


def likeness(text: str) -> list[tuple]:
    """Keys under which candidates count as similar."""
    low = text.lower()
    for mark in ("@", "(at)", "[at]"):
        if mark in low:
            box, _, domain = low.partition(mark)
            return [("mail", box, domain.split(".")[0])]
    digits = _digits(text)
    return [("number", digits)] + ([("end", digits[-SHARED_DIGITS:])] if len(digits) >= SHARED_DIGITS else [])


@dataclass
class Field:
    """Weights of the evidence (features x labels), and potentials (labels x labels, logs)."""

    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, own: np.ndarray, edges: np.ndarray, is_skip: np.ndarray) -> np.ndarray:
        """Label probabilities of every node: sum-product messages both ways over each edge,
        damped, since the edges form loops. ``own``: log evidence."""
        sources, targets = np.concatenate([edges, edges[:, ::-1]]).T
        potentials = np.where(np.concatenate([is_skip, is_skip])[:, None, None], self.skip, np.concatenate([np.repeat(self.chain[None], len(edges), 0), np.repeat(self.chain.T[None], len(edges), 0)]))
        messages = np.zeros((len(sources), own.shape[1]))
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        belief = own.copy()
        step, change, rounds = 0.5, np.inf if len(edges) else 0.0, 0
        while change > CONVERGED:
            into = (belief[sources] - messages[back])[:, :, None] + potentials
            new = np.log(np.exp(into - into.max(axis=1, keepdims=True)).sum(axis=1)) + into.max(axis=1)
            new -= np.log(np.exp(new - new.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) + new.max(axis=1, keepdims=True)
            change = step * np.abs(new - messages).max()
            messages += step * (new - messages)
            rounds += 1
            step *= 0.5 if rounds % PATIENCE == 0 else 1.0
            belief = own.copy()
            np.add.at(belief, targets, messages)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)


def edges_of(text: str, nodes: list[Span]) -> tuple[list[tuple[int, int]], list[bool]]:
    """Chain edges between neighbours; skip edges from a candidate to the first base match of each
    kind that is like it, or else to the first node that is, and from a base match to the last one.
    So the nodes of a key form a star: a label reaches all of them, and few loops count it twice."""
    chain = [(i, i + 1) for i in range(len(nodes) - 1)]
    skips: dict[tuple[int, int], None] = {}
    keys = [likeness(text[start:end]) for _, start, end in nodes]
    anchors: dict[tuple, dict[int, int]] = {}  # of a key: its first base match of each kind
    for i, (kind, _, _) in enumerate(nodes):
        for key in keys[i] if kind != NONE else ():
            anchors.setdefault(key, {}).setdefault(kind, i)
    first: dict[tuple, int] = {}
    last: dict[tuple, int] = {}
    for i, (kind, _, _) in enumerate(nodes):
        like = set() if kind == NONE else {last[k] for k in keys[i] if k in last}
        for k in keys[i] if kind == NONE else ():
            like.update(anchors[k].values() if k in anchors else [first[k]] if k in first else [])
        skips.update(dict.fromkeys((min(other, i), max(other, i)) for other in sorted(like)))
        last.update(dict.fromkeys(keys[i], i))
        for k in keys[i]:
            first.setdefault(k, i)
    return [*chain, *skips], [False] * len(chain) + [True] * len(skips)


def fitted(samples: list[tuple[list[float], int]], chain: np.ndarray, agree: tuple[int, int]) -> Field:
    """Softmax evidence by gradient descent; chain and skip potentials from counts."""
    labels = NONE + 1
    width = len(features(""))
    x = np.array([f for f, _ in samples], float).reshape(-1, width)
    y = np.eye(labels)[[k for _, k in samples]] if samples else np.zeros((0, labels))
    weights = np.zeros((width, labels))
    for _ in range(400 if len(x) else 0):
        p = np.exp(x @ weights - (x @ weights).max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        weights += 1.0 * (x.T @ (y - p) / len(x) - 1e-3 * weights)
    joint = (chain + 1) / (chain + 1).sum()
    chained = np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)))
    bonus = np.log((agree[0] + 10) * (labels - 1) / (agree[1] + 1))
    return Field(weights, np.clip(chained, -1, 1), np.eye(labels) * np.clip(bonus, 1.0, 8.0))


def _drawn(places: range, most: int) -> list[int]:
    """At most so many places, in order, drawn by a hash from all over the text."""
    if len(places) <= most:
        return list(places)
    return sorted(heapq.nsmallest(most, places, key=lambda i: zlib.crc32(b"%d" % i)))


def learned(docs: DataFrame) -> Field:
    """Fit on about ``SAMPLE`` documents of any length, drawn by a hash of id and text so that copies
    of a text are drawn one by one, and reruns agree."""
    total = docs.count()
    share = F.pmod(F.xxhash64(F.lit("pii"), *[F.col(quoted(c)) for c in docs.columns]), F.lit(1 << 30)) / float(1 << 30)
    sample = docs.where((share < SAMPLE / max(total, 1)) & F.col("text").rlike("[0-9@]")).select("text")

    def shapes(batches):
        for batch in batches:
            rows = []
            for text in batch["text"]:
                base = base_spans(text)
                nodes = sorted(base + candidates(text, base), key=lambda s: (s[1], s[2]))
                edges, skip = edges_of(text, nodes)
                some = _drawn(range(len(nodes)), CANDIDATES_PER_TEXT)
                pairs = [[nodes[i][0], nodes[j][0], int(skip[k])] for k in _drawn(range(len(edges)), PAIRS_PER_TEXT) for i, j in (edges[k],)]
                rows.append(([[*features(text[nodes[i][1] : nodes[i][2]]), float(nodes[i][0])] for i in some], pairs))
            yield pd.DataFrame(rows, columns=["shapes", "pairs"])

    samples, chain, agree = [], np.zeros((NONE + 1, NONE + 1)), [0, 0]
    for row in sample.mapInPandas(shapes, "shapes array<array<double>>, pairs array<array<int>>").collect():
        samples += [(shape[:-1], int(shape[-1])) for shape in row["shapes"]]
        for i, j, skip in row["pairs"]:
            if not skip:
                chain[i, j] += 1
            elif i != NONE and j != NONE:  # a base match resembles another one
                agree[i != j] += 1
    return fitted(sorted(samples), chain, (agree[0], agree[1]))


def detect(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that the field adds."""
    base = base_spans(text)
    loose = candidates(text, base)
    if not loose:
        return base, []
    nodes = sorted(base + loose, key=lambda s: (s[1], s[2]))
    shapes = np.array([features(text[s:e]) for _, s, e in nodes])
    own = shapes @ field.weights
    for i, (kind, _, _) in enumerate(nodes):
        if kind != NONE:
            own[i] = np.where(np.arange(NONE + 1) == kind, 0.0, -50.0)
    edges, skip = edges_of(text, nodes)
    p = field.marginals(own, np.array(edges, np.int64).reshape(-1, 2), np.array(skip, bool))
    best = p[:, :NONE].argmax(axis=1)
    added = [(int(best[i]), s, e) for i, (kind, s, e) in enumerate(nodes) if kind == NONE and p[i, best[i]] >= SURE]
    return base, added


SPANS = "array<struct<kind: string, start: int, end: int>>"


def spans(text: Column, field: Field) -> Column:
    """``struct<base, added, redacted>`` of a text column: base spans, added spans, and the text
    with every span replaced by its kind in angle brackets (overlapping ones together)."""

    @F.arrow_udf(f"struct<base: {SPANS}, added: {SPANS}, redacted: string>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        kind = pa.struct([("base", span), ("added", span), ("redacted", pa.string())])
        for batch in batches:
            for texts in slices(batch):
                rows = []
                for value in texts:
                    text = value.as_py()
                    base, added = detect(text or "", field)
                    rows.append({"base": [_row(s) for s in base], "added": [_row(s) for s in added], "redacted": None if text is None else redacted(text, base + added)})
                yield pa.array(rows, kind)

    return find(text)


def _row(span: Span) -> dict:
    return {"kind": KINDS[span[0]], "start": span[1], "end": span[2]}


def redacted(text: str, found: list[Span]) -> str:
    parts, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], s[0])):
        if start >= at:
            parts += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def found(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base``, ``added`` and ``redacted`` (underscores are added to names already
    taken); needs ``text``."""
    names = fresh(docs, "base", "added", "redacted", "personal")
    rows = docs.withColumn(names[3], spans(F.col("text"), learned(docs.select(*[c for c in ("doc_id", "text") if c in docs.columns]))))
    return rows.withColumns({name: F.col(f"{names[3]}.{part}") for name, part in zip(names, ("base", "added", "redacted"), strict=False)}).drop(names[3])


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, personal data in ``text`` replaced and ``n_chars`` kept true."""
    name = fresh(docs, "base", "added", "redacted")[2]
    rows = found(docs)
    changed = {"text": F.col(name)} | ({"n_chars": F.length(name).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return rows.withColumns(changed).select(*own_columns(docs))


def _joined(column: Column) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in KINDS]
    place = F.create_map(*[x for i, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(i))])
    keyed = F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return rows.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.array_sort(keyed)).alias("spans"))
