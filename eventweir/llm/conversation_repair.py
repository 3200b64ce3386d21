"""Repair of conversation structure by generalised LR parsing with weighted edits.

The roles of a conversation must read ``(s?(ua)+)?``: nothing, or an optional system turn and
pairs of user and assistant. Each turn is kept, deleted or given another role, and turns without
text may be inserted; each edit has a price. A parser of the role grammar tries all edits at
once on a graph-structured stack: stacks are linked nodes that share what lies below them, and
after every turn stacks with an equal top are merged into the one of the smallest (cost, audit),
the audit being the initials of the edits so far. With a left-recursive grammar the stacks'
depth is bounded, so a turn costs a constant number of steps whatever the length.

A conversation's rows go to one task, sorted, and stream through it: what all surviving stacks
agree on is written out and forgotten, so that neither texts nor stacks of a long conversation
pile up. What stays is a letter per turn, which the result asks for, and the turns about which the
stacks still differ. (A digest of the whole repaired conversation is sequential by nature, so one
conversation cannot be dealt out to several tasks.) The first turn of each text is found by an
aggregate that is combined before the shuffle, and meets the rows in the same sorted stream.

Defined results: null columns count as one space, so a null role is no role of the grammar; a
null ``conv_id`` is a conversation of its own; turns of one number are ordered by a digest of
role and text, so that reruns agree; an empty role fits no place in the grammar and is given a new
one or deleted; a conversation that has no row left gets zeros, an empty audit and an empty text; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os.path
import re
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventweir.llm.tables import table

# The role grammar: a head and a body of terminals (role initials) and heads.
RULES = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
START, END = "S", "$"
TERMINALS = "sua"
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: From any stack one insertion, or a deletion and an insertion, or two insertions reach whatever
#: another stack can still do. So a stack that costs more than this above the best cannot win.
SLACK = DELETE + INSERT
#: Undecided edits after which what all stacks agree on is written out.
HELD = 64
FULL_STOP = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")
BLACK = re.compile(r"[^\x20\x09-\x0D]")

Item = tuple[int, int]
Stack = tuple  # (state, stack below) or ()
Frontier = dict[frozenset, tuple[int, str, Stack]]


def _closure(items: set[Item]) -> frozenset[Item]:
    found, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        body = RULES[rule][1]
        for other, (head, _) in enumerate(RULES):
            if body[dot : dot + 1] == head and (other, 0) not in found:
                found.add((other, 0))
                todo.append((other, 0))
    return frozenset(found)


@lru_cache(maxsize=None)
def _goto(state: frozenset[Item], symbol: str) -> frozenset[Item]:
    return _closure({(rule, dot + 1) for rule, dot in state if RULES[rule][1][dot : dot + 1] == symbol})


@lru_cache(maxsize=None)
def _node(state: frozenset[Item], below: Stack) -> Stack:
    """The one node of this state above that stack."""
    return (state, below)


def _complete(state: frozenset[Item]) -> list[int]:
    return [rule for rule, dot in state if dot == len(RULES[rule][1])]


def _reduced(stack: Stack, rule: int) -> Stack | None:
    """The stack after the rule's body is replaced by its head; None once that is the start."""
    head, body = RULES[rule]
    for _ in body:
        stack = stack[1]
    if head == START:
        return None
    return _node(_goto(stack[0], head), stack)


@lru_cache(maxsize=None)
def shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a terminal, or None. Finite: the grammar bounds the stacks' depth."""
    after = _goto(stack[0], symbol)
    if not after:
        return None
    stack = _node(after, stack)
    while len(stack[0]) == 1 and _complete(stack[0]):  # nothing else can be done here
        stack = _reduced(stack, _complete(stack[0])[0])
    return stack


@lru_cache(maxsize=None)
def accepted(stack: Stack) -> bool:
    """Whether the conversation may end here."""
    return any(RULES[rule][0] == START for rule in _complete(stack[0]))


def root() -> Stack:
    return _node(_closure({(rule, 0) for rule, (head, _) in enumerate(RULES) if head == START}), ())


def _offer(frontier: Frontier, stack: Stack | None, cost: int, audit: str) -> bool:
    """Merge a stack into the frontier: of equal tops the smaller (cost, audit) stays."""
    if stack is None:
        return False
    known = frontier.get(stack[0])
    if known is not None and (known[0], known[1]) <= (cost, audit):
        return False
    frontier[stack[0]] = (cost, audit, stack)
    return True


def with_insertions(frontier: Frontier) -> Frontier:
    todo = list(frontier)
    while todo:
        cost, audit, stack = frontier[todo.pop()]
        for symbol in NAMES:
            after = shifted(stack, symbol)
            if _offer(frontier, after, cost + INSERT, audit + "I"):
                todo.append(after[0])
    best = min(cost for cost, _, _ in frontier.values())
    return {top: entry for top, entry in frontier.items() if entry[0] <= best + SLACK}


def after_turn(frontier: Frontier, initial: str, doomed: bool, truncated: bool) -> Frontier:
    """The frontier after one turn is deleted, or kept or given a role unless it is ``doomed``."""
    found: Frontier = {}
    fault = TRUNCATED if truncated else 0
    for cost, audit, stack in frontier.values():
        _offer(found, stack, cost + DELETE, audit + "D")
        if doomed:
            continue
        if initial and initial in TERMINALS:
            _offer(found, shifted(stack, initial), cost + fault, audit + "K")
        for symbol in NAMES:
            if symbol != initial:
                _offer(found, shifted(stack, symbol), cost + REROLE + fault, audit + "R")
    return with_insertions(found)


class Conversation:
    """One conversation's counts and cheapest repair, turn by turn; repaired turns go to ``write``."""

    def __init__(self, write: Callable[[str, str], None]) -> None:
        self.write = write
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = None
        self.n_turns = 0  # distinct ones
        self.before: str | None = None  # initial of the row before
        start = root()
        self.frontier = with_insertions({start[0]: (0, "", start)})
        self.cost = 0  # of what is written; the frontier's costs and audits count from there
        self.audit: list[str] = []
        self.rows: deque[tuple[str, str]] = deque()
        self.role = ""  # initial of the last turn written

    def turn(self, number: int | None, role: str, text: str, duplicate: bool) -> None:
        if number is not None and number != self.last_turn:
            self.first_turn = number if self.first_turn is None else self.first_turn
            self.last_turn = number
            self.n_turns += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        blank = BLACK.search(text) is None
        duplicate = duplicate and not blank
        truncated = not blank and not duplicate and FULL_STOP.search(text) is None
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.rows.append((role, text))
        self.frontier = after_turn(self.frontier, initial, blank or duplicate, truncated)
        if len(next(iter(self.frontier.values()))[1]) > HELD:
            self._settle(os.path.commonprefix([audit for _, audit, _ in self.frontier.values()]))

    def end(self) -> None:
        """Write the rest of the cheapest accepted repair. The empty audit's stack is accepted, so
        there is always one."""
        cost, audit = min((cost, audit) for cost, audit, stack in self.frontier.values() if accepted(stack))
        self.cost += cost
        self.frontier = {}
        self._settle(audit)

    def _settle(self, letters: str) -> None:
        """Write what the letters decide. They fix the roles: two that follow each other differ."""
        for letter in letters:
            role, text = self.rows.popleft() if letter != "I" else ("", "")
            if letter == "D":
                continue
            if letter != "K":
                role = NAMES["a" if self.role == "u" else "u"]
            self.role = role[0]
            self.write(role, text)
        self.audit.append(letters)
        self.frontier = {top: (cost, audit[len(letters) :], stack) for top, (cost, audit, stack) in self.frontier.items()}

    @property
    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.n_turns if self.n_turns else 0


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text; nulls as one space) with known damage: by a checksum
    of its place a row is dropped (``copies`` 0), emptied, stripped of full stops, repeated (2) or
    called a user's."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(F.coalesce("text", F.lit(" ")), "[.!?]", "")).otherwise(F.coalesce("text", F.lit(" "))).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """One sorted stream per conversation. ``kind`` 0 names the first turn of a text, just before
    that turn's rows (kind 1); kind 2 stands for a row that is gone, so that none gets lost."""
    content = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string"), F.col("text").cast("string"), "copies")
    rows = rows.withColumn("content", F.when(F.col("copies") > 0, content))
    order = F.struct(F.col("turn").isNotNull(), "turn")  # nulls first
    firsts = rows.where("copies > 0").groupBy("conv_id", "content").agg(F.min(order)["turn"].alias("turn"))
    none = F.lit(None).cast("string")
    marks = firsts.select("conv_id", "turn", none.alias("role"), none.alias("text"), F.lit(1).alias("copies"), "content", F.lit(0).alias("kind"))
    kind = F.when(F.col("copies") > 0, 1).otherwise(2)
    gone = F.col("copies") == 0
    dealt = rows.select("conv_id", "turn", F.when(~gone, F.col("role")), F.when(~gone, F.col("text")), "copies", "content", kind).toDF(*marks.columns)
    return dealt.unionAll(marks).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "content", "kind"
    )


def _stream(batches: Iterator[pa.RecordBatch], open_: Callable[[object], Conversation], close: Callable[[object, Conversation], None]) -> Iterator[None]:
    """Runs sorted rows through their conversations; yields after every batch."""
    nothing = object()
    current, talk, mark = nothing, None, None
    for batch in batches:
        for conv, turn, role, text, copies, content, kind in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if conv != current:
                if talk is not None:
                    close(current, talk)
                current, talk, mark = conv, open_(conv), None
            if kind == 0:
                mark = (turn, content)
            elif kind == 1:
                for _ in range(copies):
                    talk.turn(turn, role, text, mark != (turn, content))
                    mark = None
        yield
    if talk is not None:
        close(current, talk)
        yield


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _named(rows: DataFrame, copies: str | None) -> DataFrame:
    often = F.lit(1) if copies is None else F.col(copies)
    text = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv_id", "turn", *text, often.cast("int").alias("copies"))


def repairs(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """``conv_id``, the counts of faults, ``cost, audit, repaired_sha256``: one row for each
    conversation of ``rows`` (conv_id, turn, role, text). ``copies`` names a column that says how often
    a row counts; the conversation of a row that counts 0 times is returned all the same."""
    schema = T.StructType(
        [rows.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        digest = [None, False]

        def write(role: str, text: str) -> None:
            digest[0].update(f"{'\n' if digest[1] else ''}{role}:{text}".encode())
            digest[1] = True

        def open_(conv: object) -> Conversation:
            digest[:] = hashlib.sha256(), False
            return Conversation(write)

        def close(conv: object, talk: Conversation) -> None:
            talk.end()
            done.append((conv, *[int(getattr(talk, c)) for c in COUNTS], "".join(talk.audit), digest[0].hexdigest()))

        arrow = None
        for _ in _stream(batches, open_, close):
            if done:
                arrow = arrow or _arrow(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), arrow, strict=True)], schema=arrow)
                done.clear()

    return _dealt(_named(rows, copies)).mapInArrow(summed, schema)


def repaired_turns(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired conversations themselves: ``conv_id, turn, role, text``, turns from 0. Nothing
    is returned of a conversation that has no turn left."""
    schema = T.StructType([rows.schema["conv_id"], *[T.StructField(n, t) for n, t in (("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))]])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def open_(conv: object) -> Conversation:
            number = iter(range(1 << 62))
            return Conversation(lambda role, text: out.append((conv, next(number), role, text)))

        arrow = None
        for _ in _stream(batches, open_, lambda _, talk: talk.end()):
            if out:
                arrow = arrow or _arrow(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                out.clear()

    return _dealt(_named(rows, copies)).mapInArrow(written, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repairs(damaged(table(spark, sf_dir, "conversations")), "copies")


OP11_SQL = r"""
WITH RECURSIVE raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS place
    FROM conversations
), bits AS (
    SELECT CAST(i AS UBIGINT) AS i FROM range(256) t(i)
), crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS UBIGINT)) ELSE a // 2 END) AS c
        FROM bits)
), keyed AS (
    SELECT raw.*, xor(list_reduce(
        list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(place, ''), lambda x: CAST(ascii(x) AS UBIGINT))),
        lambda a, b: xor(a // 256, t[CAST(xor(a % 256, b) AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 20 AS kind
    FROM raw, crc_table
), d AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM keyed
), o AS (
    SELECT *, row_number() OVER w AS n, substr(role, 1, 1) AS c,
        lag(substr(role, 1, 1)) OVER w AS before,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
    FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(length(role), ':', role, text)), copy)
), f AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
    FROM o
), ins(p, q, cost, letters, added) AS (
    VALUES ('0', '0', 0, '', []::VARCHAR[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
        ('0', 'u', 2, 'I', ['user:']), ('s', 'u', 2, 'I', ['user:']), ('a', 'u', 2, 'I', ['user:']), ('u', 'a', 2, 'I', ['assistant:']),
        ('0', 'a', 4, 'II', ['user:', 'assistant:']), ('s', 'a', 4, 'II', ['user:', 'assistant:'])
), move(q, c, r) AS (
    VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), edits AS (
    SELECT f.conv_id, f.n, q.q, q.q AS r, 3 AS cost, 'D' AS letters, []::VARCHAR[] AS added
    FROM f, (SELECT DISTINCT q FROM ins) q
    UNION ALL
    SELECT f.conv_id, f.n, move.q, move.r, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END, 'K', [concat(f.role, ':', f.text)]
    FROM f JOIN move ON f.c = move.c WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT f.conv_id, f.n, move.q, move.r, CASE WHEN fault = 'truncated' THEN 3 ELSE 2 END, 'R',
        [concat(CASE move.c WHEN 'u' THEN 'user:' ELSE 'assistant:' END, f.text)]
    FROM f, move WHERE move.c <> 's' AND fault NOT IN ('blank', 'duplicate')
), convs AS (
    SELECT conv_id, (SELECT count(*) FROM f WHERE f.conv_id IS NOT DISTINCT FROM k.conv_id) AS size
    FROM (SELECT DISTINCT conv_id FROM raw) k
), parse AS (
    SELECT conv_id, size, CAST(0 AS BIGINT) AS n, {'cost': CAST(0 AS BIGINT), 'audit': '', 'state': '0', 'said': []::VARCHAR[]} AS best FROM convs
    UNION ALL
    SELECT p.conv_id, p.size, p.n + 1, min({'cost': CAST(p.best.cost + i.cost + e.cost AS BIGINT), 'audit': concat(p.best.audit, i.letters, e.letters),
        'state': e.r, 'said': list_concat(p.best.said, list_concat(i.added, e.added))})
    FROM parse p JOIN ins i ON p.best.state = i.p JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.n = p.n + 1 AND e.q = i.q
    GROUP BY p.conv_id, p.size, p.n + 1, e.r
), done AS (
    SELECT p.conv_id, min({'cost': CAST(p.best.cost + i.cost AS BIGINT), 'audit': concat(p.best.audit, i.letters), 'said': list_concat(p.best.said, i.added)}) AS best
    FROM parse p JOIN ins i ON p.best.state = i.p WHERE p.n = p.size AND i.q IN ('0', 'a') GROUP BY p.conv_id
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND concat(before, c) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM f GROUP BY conv_id
)
SELECT done.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
    sha256(array_to_string(best.said, chr(10))) AS repaired_sha256
FROM done LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM done.conv_id
"""
