"""Mix sources to target weights by Pareto order sampling.

A source's target is its weight's share of all words, but at most ``MOST`` times the source;
what is cut off goes to the other sources by weight. Every document is first allotted the
certain whole copies, ``floor(target / source words)``. The rest of a source's target is a
sample without replacement with unequal probabilities: a document is included with a probability
in proportion to its words, so that few documents miss the target by little; where that
would pass 1 the document is certain. Documents rank by random odds over their own inclusion odds,
and the lowest ranks are taken until the source's words are as near the target as whole
documents allow. The random numbers are a hash of the id, so reruns agree.

No source meets in one task: each source's documents are cut into about the square root of
their number of buckets by rank, bucket sums (partial sums before the shuffle) give the one
bucket in which the source's target is reached, and only that bucket is ordered row by row.

Defined results: null text has size 0; documents without words get the certain copies only; a
null source is a source of its own, last in order; rows that share an id, or have none, are
documents of their own, which draw by their row number and are told apart by it (reruns agree as
long as the table is read in the same pieces); an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweir.llm.tables import fresh, own_columns, quoted, staged, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix"


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, n, target``, one row per source of ``rows`` (source, size).

    Sources fill up at their limit in the order of limit over weight; the first that does not
    sets the level of all that follow. The windows run over one row per source.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ranked = sums.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("fills", most * F.col("source_size") / F.col("weight"))
    before = Window.orderBy("fills", "place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranked.select(
        "*",
        F.row_number().over(Window.orderBy("fills", "place")).alias("order"),
        F.sum("source_size").over(everything).alias("words"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0)).alias("full"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("full_weights"),
    )
    level = (F.col("words") - F.col("full")) / (F.col("weights") - F.col("full_weights"))
    ranked = ranked.withColumn("level", level).withColumn("free", F.col("level") <= F.col("fills"))
    ranked = ranked.select(
        "*",
        F.min(F.when(F.col("free"), F.col("order"))).over(everything).alias("first"),
        F.min_by(F.when(F.col("free"), F.col("level")), F.when(F.col("free"), F.col("order"))).over(everything).alias("shared"),
    )
    target = F.when(F.col("order") < F.col("first"), (most * F.col("source_size")).cast("double")).otherwise(F.col("shared") * F.col("weight"))
    return ranked.select("source", "source_size", "n", target.alias("target"))


def _inclusion(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``_s, slope``: documents of a source are included with probability ``slope * size``, at most
    1, such that the expected words are the source's ``rest``. Sizes are made certain from the
    largest on until the others' probabilities stay below 1. One row per size of a source."""
    sizes = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    sizes = sizes.join(sources.select(F.col("source").alias("_s"), "rest"), F.col("source").eqNullSafe(F.col("_s")))
    source = Window.partitionBy("_s")
    larger = source.orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    others = source.orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    certain = F.coalesce(F.sum(F.col("size") * F.col("n")).over(larger).cast("double"), F.lit(0.0))
    squares = F.sum(F.col("size").cast("decimal(18,0)") * F.col("size") * F.col("n")).over(others).cast("double")
    slope = (F.col("rest") - certain) / squares
    fits = sizes.select("_s", "size", slope.alias("slope")).where("slope * size <= 1")
    return fits.groupBy("_s").agg(F.max_by("slope", "size").alias("slope"))


def _drawn(docs: DataFrame, seed: str) -> Column:
    """The random number of a row in (0, 1), a hash of its id; a row whose id is null or not its own
    draws by its row number too, so that such rows neither tie nor meet."""
    key = F.when(F.col("_own"), F.col("doc_id").cast("string")).otherwise(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("#"), F.col("_row").cast("string")))
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << 52)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the whole copies that
    the mix takes of a row (underscores are added to names already taken). Needs ``doc_id, text,
    source``; a row is taken at most ``most`` times."""
    whole = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_doc")
    return _decided(docs.select(whole, "doc_id", "source", _words(F.col("text")).alias("size")), docs, weights, most, seed)


def _decided(sized: DataFrame, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix of ``sized`` rows (doc_id, source, size and, in ``_doc``, what else to return)."""
    names = fresh(docs, "size", "source_size", "target", "copies")
    shared = staged(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "shared-ids")
    sized = sized.join(shared.select("doc_id", F.lit(True).alias("_shared")), "doc_id", "left")
    own = F.col("doc_id").isNotNull() & F.col("_shared").isNull()
    # Row numbers hold once they are written.
    rows = staged(sized.withColumn("_own", own).drop("_shared").withColumn("_row", F.monotonically_increasing_id()), "sizes")
    sources = source_targets(rows, weights, most)
    ratio = F.least(F.coalesce(F.expr("target / nullif(source_size, 0)"), F.lit(0.0)), F.lit(float(most)))
    sources = sources.withColumn("certain", F.floor(ratio).cast("int"))
    rest = F.when(F.col("certain") < most, F.greatest(F.col("target") - F.col("certain") * F.col("source_size"), F.lit(0.0))).otherwise(0.0)
    sources = staged(sources.withColumn("rest", rest).withColumn("buckets", F.ceil(F.sqrt("n"))), "sources")
    slopes = _inclusion(rows, sources).toDF("_t", "slope")
    known = staged(sources.join(slopes, F.col("source").eqNullSafe(F.col("_t")), "left").drop("_t", "n"), "inclusion")

    def ranked(known: DataFrame) -> DataFrame:
        df = rows.join(known.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        df = df.withColumn("_u", _drawn(df, seed)).withColumn("_p", F.coalesce(F.col("slope") * F.col("size"), F.lit(0.0)))
        # Random odds over inclusion odds: nil for the certain ones, none for those that cannot be in.
        rank = F.when(F.col("_p") >= 1, 0.0).when(F.col("_p") > 0, F.expr("(_u / (1 - _u)) / (_p / (1 - _p))"))
        # The cut is near rank 1, in the middle of the buckets.
        return df.withColumn("_rank", rank).withColumn("_bucket", F.floor(F.expr("_rank / (1 + _rank)") * F.col("buckets")))

    order = ranked(known).where("_rank is not null")
    sums = order.groupBy("source", "_bucket", "rest").agg(F.sum("size").alias("_sum"))
    so_far = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(so_far), F.lit(0)))
    last = staged(sums.where("_before <= rest and rest < _before + _sum").select("source", "_bucket", "_before"), "last-buckets")
    last = last.toDF("_s", "_b", "_before")
    edge = order.join(last, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    one_by_one = Window.partitionBy("source").orderBy("_rank", "doc_id", "size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("_before", F.col("_before") + F.coalesce(F.sum("size").over(one_by_one), F.lit(0)))
    place = F.struct("_rank", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "size", "_row")
    cuts = edge.where("_before + size / 2 <= rest").groupBy("source").agg(F.max(place).alias("_cut"))
    last = last.join(cuts, F.col("_s").eqNullSafe(F.col("source")), "left").select("_s", "_b", "_cut")
    known = staged(known.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "cuts")

    # Without a last bucket the source's remaining target is out of reach or nil.
    inside = (F.col("_bucket") < F.col("_b")) | ((F.col("_bucket") == F.col("_b")) & (place <= F.col("_cut")))
    copies = F.col("certain") + F.when(inside, 1).otherwise(0)
    columns = [F.col("size"), F.col("source_size"), F.col("target"), copies]
    kept = ["_doc.*"] if "_doc" in sized.columns else ["doc_id"]
    return ranked(known).select(*kept, *[c.alias(n) for c, n in zip(columns, names, strict=True)])


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns of ``docs``."""
    copies, copy = fresh(docs, "size", "source_size", "target", "copies", "_copy")[-2:]
    rows = mixed(docs).where(F.col(copies) > 0)
    return rows.select(*own_columns(docs), F.explode(F.array_repeat(F.lit(0), F.col(copies))).alias(copy)).drop(copy)


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = _decided(docs.select("doc_id", "source", _words(F.col("text")).alias("size")), docs.select("doc_id"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP3_SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
            / 4503599627370496 AS u
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
        row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM d GROUP BY source
), f AS (
    SELECT *, row_number() OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, place) AS k,
        CAST(3 * source_size AS DOUBLE) / weight AS fills,
        CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
            ORDER BY CAST(3 * source_size AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (
            ORDER BY CAST(3 * source_size AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
    FROM s
), g AS (SELECT min(k) AS k, min_by(level, k) AS level FROM f WHERE level <= fills),
t AS (
    SELECT source, source_size,
        CASE WHEN f.k < g.k THEN CAST(3 * source_size AS DOUBLE) ELSE g.level * weight END AS target
    FROM f, g
), r AS (
    SELECT *, least(coalesce(target / nullif(source_size, 0), 0.0), 3.0) AS ratio FROM t
), c AS (
    SELECT *, CAST(floor(ratio) AS BIGINT) AS certain,
        CASE WHEN floor(ratio) < 3 THEN greatest(target - floor(ratio) * source_size, 0) ELSE 0 END AS rest
    FROM r
), z AS (
    SELECT c.source, d.size, any_value(c.rest) AS rest, CAST(count(*) AS HUGEINT) AS n
    FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source WHERE d.size > 0 GROUP BY c.source, d.size
), q AS (
    SELECT source, size,
        (rest - coalesce(CAST(sum(size * n) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
            / CAST(sum(size * size * n) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS slope
    FROM z
), k AS (
    SELECT source, max_by(slope, size) AS slope FROM q WHERE slope * size <= 1 GROUP BY source
), p AS (
    SELECT d.doc_id, d.size, d.u, c.source, c.source_size, c.target, c.certain, c.rest, coalesce(k.slope * d.size, 0.0) AS p
    FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source LEFT JOIN k ON k.source IS NOT DISTINCT FROM c.source
), o AS (
    SELECT *, CASE WHEN p >= 1 THEN 0.0 WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM p
), w AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM o
)
SELECT doc_id, size, source_size, target,
    CAST(size * (certain + CASE WHEN rank IS NOT NULL AND before + size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM w
"""
