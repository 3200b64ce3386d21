"""Licence scan: base phrases, and a positional index of rare licence words.

The bodies, names and SPDX lines of some thirty licences are indexed by word: each posting is a
template and a place in it. Of each template the words with the highest IDF over the corpus are its
anchors. For each file the anchors are looked up; a hit at word ``at`` of the file and a
posting at ``place`` agree on the relative position ``at - place``, and a template is found where
anchors with at least half of its IDF mass agree on one position and its mandatory key phrase stands
in the file. A mere reference (a template of fewer than ``BODY`` words) does not count where a
negation stands within ``DENIED`` words before its key phrase: "not under the MIT license".

Everything is DataFrame and SQL functions. Texts are read once; what is kept of a file are the
licence words it has and, if it may hold a key phrase, their places; only these are shuffled. Index,
vocabulary and document frequencies have at most as many rows as the fixed templates have words.

Defined results: null and word-less texts have no words, no labels and score 0; repeated rows
each get a row; an empty table gives an empty table. The score is 1 for files with a base phrase,
else the highest share of agreeing IDF mass of a template that was found, else 0.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm.licence_texts import TEMPLATES
from eventweir.llm.tables import staged, table

# The contract's phrases.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Words too common to be looked up.
COMMON = {"a", "all", "and", "any", "are", "by", "for", "in", "is", "into", "of", "or", "the", "this", "to", "under", "with", "without"}
# Words that deny what follows.
NEGATIONS = {"not", "nor", "no", "neither", "never", "isn", "cannot"}
#: Anchors of each template, those with the highest IDF.
ANCHORS = 12
#: Words before a key phrase in which a negation denies a reference, and words a body has at least.
DENIED = 5
BODY = 16
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def postings() -> list[tuple[str, int, int]]:
    """Word, template and place of every indexed word; a repeated word has several."""
    rows = []
    for template, (_, _, text) in enumerate(TEMPLATES):
        rows += [(word, template, place) for place, word in enumerate(text.split()) if word not in COMMON]
    return rows


def idf(rows: int, counts: dict[str, int]) -> dict[str, float]:
    """Weights of the indexed words, above zero also for words of every document."""
    return {word: math.log(1 + (rows + 1) / (counts.get(word, 0) + 0.5)) for word, _, _ in postings()}


def anchors(rows_in_all: int, counts: dict[str, int]) -> list[tuple[str, int, int, float]]:
    """Word, template, place and share of its template's IDF mass, of the anchors of every template.
    Words that no document has cannot be anchors."""
    weights, rows = idf(rows_in_all, counts), []
    for template in range(len(TEMPLATES)):
        own = [posting for posting in postings() if posting[1] == template and counts.get(posting[0])]
        rarest = set(sorted({word for word, _, _ in own}, key=lambda w: (-weights[w], w))[:ANCHORS])
        kept = [posting for posting in own if posting[0] in rarest]
        mass = sum(weights[word] for word, _, _ in kept)
        rows += [(*posting, weights[posting[0]] / mass) for posting in kept]
    return rows


def gate() -> list[str]:
    """Words of which a text with any key or base phrase has one: the longest of each phrase."""
    return sorted({max(phrase.split(), key=len) for phrase in (*BASE, *[key for _, key, _ in TEMPLATES])})


def words_of(text: Column) -> Column:
    # Lower-casing beyond A-Z neither joins nor splits words, and only the Kelvin sign would
    # become an ASCII letter.
    lower = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(lower, SEPARATORS), "")


def spaced(phrase: str) -> str:
    """The phrase as it stands in text whose words have a space on each side."""
    return "".join(f" {word} " for word in phrase.split())


def _words_in(text: Column) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))) / 2).cast("long")


def occurrences(line: Column, n_words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Number of places of a phrase in a spaced line, and its first and last start."""
    mark = spaced(phrase)
    there = F.contains(line, F.lit(mark))
    count = (F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))) / len(mark)
    first = _words_in(F.substring_index(line, mark, 1))
    last = n_words - _words_in(F.substring_index(line, mark, -1)) - len(phrase.split())
    return F.when(there, count.cast("long")).otherwise(F.lit(0)), F.when(there, first), F.when(there, last)


def scanned(docs: DataFrame) -> DataFrame:
    """One pass over the texts: base columns, licence words and their places, key phrases present."""
    vocabulary = sorted({word for word, _, _ in postings()})
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    known = F.arrays_overlap("words", F.array(*map(F.lit, gate())))
    rows = rows.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), known.alias("known"))
    line = F.when(F.col("known"), F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))).otherwise("")
    placed = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    hits = F.filter(placed, lambda h: h["word"].isin(vocabulary) | h["word"].isin(sorted(NEGATIONS)))
    rows = rows.select(
        "doc_id", "n_words", line.alias("line"),
        F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary))).alias("seen"),
        F.when(F.col("known"), hits).otherwise(F.array().cast("array<struct<at:int,word:string>>")).alias("hits"),
    )
    found = {label: occurrences(F.col("line"), F.col("n_words"), phrase) for phrase, label in BASE.items()}
    keys = F.array_compact(F.array(*[F.when(F.contains("line", F.lit(spaced(key))), F.lit(i)) for i, (_, key, _) in enumerate(TEMPLATES)]))
    rows = rows.select(
        "doc_id",
        "n_words",
        reduce(lambda a, b: a + b, [n for n, _, _ in found.values()]).cast("long").alias("n_base"),
        F.least(*[first for _, first, _ in found.values()]).alias("first_word"),
        F.greatest(*[last for _, _, last in found.values()]).alias("last_word"),
        F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for label, (n, _, _) in found.items()])).alias("base"),
        "seen",
        "hits",
        keys.alias("keys"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.withColumn("hits", F.when(F.size("keys") > 0, F.col("hits")))


def licences(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs`` (doc_id, text); others are not read."""
    spark = docs.sparkSession
    rows = staged(scanned(docs), "licence-words")  # row numbers are written with their rows
    # Document frequencies over all texts: at most one row per indexed word.
    counts = rows.select(F.explode("seen").alias("word")).groupBy("word").count()
    listed = anchors(rows.count(), {r["word"]: r["count"] for r in counts.collect()})
    index = F.broadcast(spark.createDataFrame(listed, "word string, template int, place int, share double"))
    keyed = rows.where(F.size("keys") > 0)
    hits = keyed.select("row", "keys", F.explode("hits").alias("hit"))
    hits = hits.join(index, F.col("hit.word") == F.col("word")).where(F.array_contains("keys", F.col("template")))
    agreeing = hits.groupBy("row", "template", (F.col("hit.at") - F.col("place")).alias("position")).agg(F.count("*").alias("agree"), F.sum("share").alias("share"))
    aligned = agreeing.where((F.col("agree") >= 2) & (F.col("share") >= 0.5 - 1e-9))
    # Where the key phrase of a reference starts, and the negations of the few files that have both.
    starts = [_key_place(key, text) if len(text.split()) < BODY else None for _, key, text in TEMPLATES]
    start = F.col("position") + F.element_at(F.array(*[F.lit(x).cast("int") for x in starts]), F.col("template") + 1)
    negations = F.transform(F.filter("hits", lambda h: h["word"].isin(sorted(NEGATIONS))), lambda h: h["at"])
    negated = keyed.select("row", negations.alias("negations")).where(F.size("negations") > 0)
    aligned = aligned.withColumn("start", start).join(negated, "row", "left")
    denied = F.exists("negations", lambda at: (at < F.col("start")) & (at >= F.col("start") - DENIED))
    aligned = aligned.where(~F.coalesce(denied, F.lit(False)))
    label = F.element_at(F.array(*[F.lit(label) for label, _, _ in TEMPLATES]), F.col("template") + 1)
    found = aligned.groupBy("row").agg(F.collect_set(label).alias("labels"), F.max("share").alias("share"))
    rows = rows.drop("seen", "hits", "keys").join(found, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("labels", F.array().cast("array<string>"))))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.least(F.coalesce("share", F.lit(0.0)), F.lit(1.0)))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )


def _key_place(key: str, text: str) -> int:
    return len(f" {text} ".partition(f" {key} ")[0].split())


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences(table(spark, sf_dir, "documents"))
