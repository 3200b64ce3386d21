"""Conversation repair, prefix trie and decontamination: brute force, SQL, and odd inputs."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweir.llm import conversation_repair as repair
from eventweir.llm import decontamination as leak
from eventweir.llm import prefix_trie as trie

TURNS = [
    *[(1, t, r, x) for t, r, x in [(0, "system", "Be kind."), (1, "user", "Hi."), (2, "assistant", "Hello."), (3, "user", "Hi."), (7, "assistant", "So")]],
    *[(20, t, r, x) for t, r, x in [(0, "user", "a b."), (1, "assistant", "c."), (2, "user", "d e f!"), (3, "assistant", "g")]],
    *[(c, t, r, f"{x} {c % 3}.") for c in range(21, 40) for t, r, x in [(0, "user", "q"), (1, "assistant", "r s"), (2, "user", "t"), (3, "tool", "u")][: c % 5]],
    (None, 0, "user", "lost?"),
    (None, None, None, None),
    (41, None, "user", None),
    (41, None, "user", None),
    (41, 1, None, "x."),
    (41, 1, "", "y."),
    (42, 5, "assistant", " \t\n "),
    (43, 0, "assistant", "é 😀."),
    (44, 0, "user", "word " * 40_000),
    (-5, 0, "user", "below"),
    (0, 0, "user", "zero."),
    (0, 1, "assistant", "one."),
]


@pytest.fixture(scope="module")
def turns(spark):
    rows = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    clashing = ["copies", "kind", "cost", "depth", "node", "conv", "family", "a.b"]
    return rows.withColumns({name: F.lit("x") for name in clashing}).repartition(3)


def duck(**tables):
    connection = duckdb.connect()
    for name, df in tables.items():
        connection.register(name, df.toArrow())
    return connection


def same(df, sql, **tables):
    found = duck(**tables).execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(str(row) for row in found.fetchall())
    got = sorted(str(tuple(row)) for row in df.select(*names).collect())
    assert got == want
    return got


def cheapest(rows):
    """All edits of at most three rows: the smallest (cost, audit, repaired text)."""
    gaps = ["", "u", "a", "ua", "au"]
    name = {"u": "user", "a": "assistant"}
    seen, options = set(), []
    for role, text in rows:
        blank = not re.search(r"[^\x20\x09-\x0D]", text)
        bad = blank or (role, text) in seen
        seen.add((role, text))
        fault = 0 if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else 1
        some = [(3, "D", [])]
        if not bad:
            some += [(fault, "K", [(role, text)]), *[(2 + fault, "R", [(name[x], text)]) for x in "ua"]]
        options.append(some)
    best = None
    for picks in itertools.product(*options):
        for adds in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for add, pick in zip(adds, [*picks, (0, "", [])], strict=True):
                cost += 2 * len(add) + pick[0]
                audit += "I" * len(add) + pick[1]
                out += [(name[x], "") for x in add] + pick[2]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
                best = min(best or (99, "", []), (cost, audit, out))
    return best


def test_repair_equals_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["a.", "b", "", "c!"])) for _ in range(rng.randint(0, 3))]
        out = []
        talk = repair.Conversation(lambda role, text, out=out: out.append((role, text)))
        seen = set()
        for at, (role, text) in enumerate(rows):
            talk.turn(at, role, text, (role, text) in seen)
            seen.add((role, text))
        talk.end()
        assert (talk.cost, "".join(talk.audit), out) == cheapest(rows), rows


def test_a_long_conversation_is_written_as_it_streams():
    rng = random.Random(1)
    out, held = [], 0
    talk = repair.Conversation(lambda role, text: out.append(role[0]))
    for at in range(20_000):
        talk.turn(at, rng.choice(["system", "user", "assistant"]), rng.choice(["a.", "b"]), rng.random() < 0.1)
        held = max(held, len(talk.rows))
    assert held < 1000 and len(out) > 5_000
    talk.end()
    assert re.fullmatch("s?(ua)+", "".join(out)) and len(re.sub("I", "", "".join(talk.audit))) == 20_000


def test_repair_equals_sql(turns):
    rows = same(repair.repairs(repair.damaged(turns), "copies"), repair.OP11_SQL, conversations=turns.select("conv_id", "turn", "role", "text"))
    assert len(rows) == len({t[0] for t in TURNS})
    assert same(repair.repairs(repair.damaged(turns.where("false")), "copies"), repair.OP11_SQL, conversations=turns.where("false").select("conv_id", "turn", "role", "text")) == []


def test_repaired_turns(turns):
    kept = repair.repaired_turns(turns)
    talks = {}
    for r in sorted(kept.collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["turn"])):
        talks.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert all(re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in talk)) for talk in talks.values())
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.repairs(turns).collect()}
    assert digests == {c: hashlib.sha256("\n".join(f"{r}:{t}" for r, t in talks.get(c, [])).encode()).hexdigest() for c in digests}
    assert repair.repairs(turns).where("conv_id = 1").first()["audit"] == "KKKDR" or talks[1][0] == ("system", "Be kind.")


def test_rollup_equals_walking_up():
    rng = random.Random(3)
    for shape in ("bushy", "chain", "hub", "forest"):
        n = 300
        parent = [-1] + [{"bushy": rng.randrange(v), "chain": v - 1, "hub": 0, "forest": rng.randrange(-1, v)}[shape] for v in range(1, n)]
        value = [rng.randrange(10) for _ in range(n)]
        want = list(value)
        for v in reversed(range(n)):
            if parent[v] >= 0:
                want[parent[v]] += want[v]
        assert trie.rollup(parent, value) == [want]
    assert trie.rollup([], []) == [[]]


@pytest.mark.parametrize("local", [trie.LOCAL, 12])
def test_trie_equals_sql(turns, local):
    named = turns.select("conv_id", "turn", "role", "text")
    rows = same(trie.trie(turns, local), trie.OP12_SQL, conversations=named)
    assert len(rows) > 20


def test_trie_of_nothing_and_of_many_copies(spark, turns):
    assert trie.trie(turns.where("false")).count() == 0 and trie.trie(turns.where("conv_id is null")).count() == 0
    copies = spark.range(9000).select((F.col("id") * 20).alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("one two").alias("text"))
    rows = {r["depth"]: r for r in trie.trie(copies).collect()}
    ids = ",".join(str(i * 20) for i in range(9000))
    assert rows[1]["saved_tokens"] == 8999 * 2 and rows[1]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert len(rows) == 2 and rows[0]["n_leaves"] == 1 and rows[0]["ends_sha256"] == hashlib.sha256().hexdigest()


def test_index_equals_scan():
    rng = np.random.default_rng(2)
    for size in (0, 1, 7, 400):
        text = rng.integers(0, 5, size)
        text[text == 4] = 3  # a symbol in every place, and one that is missing
        index = leak.FMIndex(text)
        phrases = [tuple(rng.integers(1, 7, rng.integers(1, 6))) for _ in range(50)]
        ids = np.zeros((50, 6), np.int64)
        for at, p in enumerate(phrases):
            ids[at, 6 - len(p) :] = p
        low, high = index.search(ids, np.array([len(p) for p in phrases]))
        for p, a, b in zip(phrases, low, high, strict=True):
            want = [i for i in range(size) if tuple(text[i : i + len(p)]) == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


DOCS = [
    (1, "So: one TWO three four five six seven eight nine ten eleven, said he."),
    (1, "So: one TWO three four five six seven eight nine ten eleven, said he."),
    (2, "one two three four five six seven eight nine nine ten"),
    (3, None),
    (4, " .,; "),
    (None, "Très court, très court"),
    (6, "x " * 1_500 + "two three four five six seven eight nine ten eleven " * 3),
    (7, ("z" * 100_000) + " short item " + "one " * 40),
]
ITEMS = [
    (10, "one two three four five six seven eight nine ten eleven"),
    (9, "two three four five six seven eight nine ten eleven"),
    (9, "short item"),
    (11, "Très COURT"),
    (12, None),
    (13, " ! "),
    (14, "one one one one one one one one one one one one"),
]


@pytest.fixture(scope="module")
def leaks(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("found", "n_words", "items", "a.b")})
    return docs.repartition(2), spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("phrase", F.lit(0))


def digested(rows):
    return rows.select("doc_id", F.col("n_words_").alias("n_words"), "n_hit", "n_items", F.sha2(F.array_join("items_", ","), 256).alias("items_sha256"), "contaminated")


@pytest.mark.parametrize("block", [leak.BLOCK, 3])
def test_decontamination_equals_sql(leaks, block, monkeypatch):
    docs, items = leaks
    # RE2 reads bytes outside ASCII as code points, so capitals outside A-Z stay as they are in both.
    rows = same(digested(leak.contaminated(docs, items, block=block)), leak.OP13_SQL, documents=docs.select("doc_id", "text"), benchmark=items)
    assert len(rows) == len(DOCS)
    none = digested(leak.contaminated(docs, items.where("false")))
    assert none.where("contaminated or n_items > 0").count() == 0 and none.count() == len(DOCS)
    assert leak.contaminated(docs.where("false"), items).count() == 0


def test_shards_lose_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(" ".join(f"w{x}" for x in rng.integers(0, 3, rng.integers(1, 11))), [str(at)]) for at in range(40)]
    block = leak.Phrases.of(rows)
    numbers = np.array([block.vocabulary.get(f"w{x}".encode(), 0) for x in rng.integers(0, 4, 2000)], np.int32)
    want = sorted(zip(*[x.tolist() for x in block.occurrences(numbers)], strict=True))
    assert want == [(i, p) for i in range(2000) for p in range(40) if (numbers[i : i + block.sizes[p]].tolist() == block.ids[p, 10 - block.sizes[p] :].tolist())]
    monkeypatch.setattr(leak, "SHARD", 25)
    assert sorted(set(zip(*[x.tolist() for x in block.occurrences(numbers)], strict=True))) == want


def test_null_item_and_removed_passages(spark, leaks):
    docs, items = leaks
    with_null = items.unionByName(spark.createDataFrame([(None, "said he", 0)], "item_id long, text string, phrase int"))
    row = leak.contaminated(docs, with_null).where("doc_id = 1").first()
    assert row["n_items"] == 3 and row["items_"] == ["10", "9"] and row["n_hit"] == 13
    texts = {r["doc_id"]: r["text"] for r in leak.without_passages(docs, items).collect()}
    assert texts[1] == "So: , said he." and texts[3] is None and texts[None] == ""
    assert texts[2] == DOCS[2][1] and texts[4] == " .,; "
    long = spark.createDataFrame([(1, "y " * 300_000 + "two three four five six seven eight nine ten eleven")], "doc_id long, text string")
    row = leak.contaminated(long, items).first()
    assert row["n_words"] == 300_010 and [tuple(s) for s in row["spans"]] == [(300_000, 300_010)] and row["items"] == ["10", "9"]
