"""Bounded samples of labelled texts for classifiers that are fitted on the driver."""

from __future__ import annotations

from collections.abc import Hashable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Different labels that are learned, the most frequent ones.
LABELS = 256


def spread(text: Column, pieces: int, size: int) -> Column:
    """The text cut into pieces of ``size`` characters or, if it has more than ``pieces`` of them, so
    many pieces at even distances from its start to its end."""
    n = F.length(text)
    step = F.when(n <= pieces * size, F.lit(float(size))).otherwise((n - size) / float(max(pieces - 1, 1)))
    count = F.least(F.lit(pieces), F.ceil(n / size)).cast("int")
    places = F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)
    return F.transform(places, lambda i: F.substring(text, F.floor(i * step).cast("int") + 1, F.lit(size)))


def labelled_sample(
    rows: DataFrame, per_label: int, pieces: int, size: int, labels: DataFrame | None = None
) -> list[tuple[list[str], Hashable]]:
    """Pieces of texts with their label, sorted so that reruns agree.

    ``rows`` has ``doc_id, text, label``: a text's label is the one of its own row. Of each of the
    ``LABELS`` most frequent labels at most ``per_label`` rows are drawn, by a hash of id and text, and
    of each text at most ``pieces`` pieces of ``size`` characters: so the sample is bounded
    whatever the rows, and a text of any length can be in it. With ``labels`` (``doc_id, label``, an id
    once) ``rows`` has no ``label``: the two meet by id, and texts stay where they are.
    """
    place = F.xxhash64(F.lit("sample"), "doc_id", "text")
    if labels is not None:
        rows = rows.where("length(text) > 0").select("doc_id", "text", place.alias("place"))
        known = rows.select("doc_id", "place").join(labels.where("label is not null"), "doc_id")
        drawn = _first_rows(known, per_label, "place", "doc_id").groupBy("label", "doc_id", "place").agg(F.count("*").alias("n"))
        # Rows alike in id and text are one key; the keys are as bounded as the sample, whatever the rows.
        found = rows.join(F.broadcast(drawn), ["doc_id", "place"]).select("doc_id", "place", "label", "n", spread(F.col("text"), pieces, size).alias("pieces"))
        found = found.groupBy("doc_id", "place", "label", "n").agg(F.min("pieces").alias("pieces"))
        return sorted((list(r["pieces"]), r["label"]) for r in found.collect() for _ in range(r["n"]))
    rows = rows.where("label is not null and length(text) > 0")
    # Each task keeps its own first rows of a label, and only their pieces, before anything is shuffled.
    ranked = rows.select("label", spread(F.col("text"), pieces, size).alias("pieces"), place.alias("place"))
    return sorted((list(r["pieces"]), r["label"]) for r in _first_rows(ranked, per_label, "place", "pieces").collect())


def _first_rows(rows: DataFrame, per_label: int, *order: str) -> DataFrame:
    """Of each of the most frequent labels the first rows."""
    counts = rows.groupBy("label").count().orderBy(F.col("count").desc(), "label").limit(LABELS)
    names = [r["label"] for r in counts.collect()]
    numbered = rows.where(F.col("label").isin(names)).withColumn("_n", F.row_number().over(Window.partitionBy("label").orderBy(*order)))
    return numbered.where(F.col("_n") <= per_label).drop("_n")
