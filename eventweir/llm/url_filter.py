"""URL filter: host and path rules, and a character language-model ratio for all other URLs.

Two variable-order Markov models over URL characters are learned, one from the URLs that the
rules allow and one from those they block. The probability of a character after a context is
interpolated from order 0 to ``ORDER``: a context's counts are mixed with the next shorter
context's estimate in proportion to the number of different characters seen after it, so unseen
contexts fall through to shorter ones. A URL's score is the difference of its log-likelihoods
(blocked minus allowed) per character. The threshold is calibrated on rule-labelled URLs that
neither model has seen (one fold in five by the page id): it is the score with the highest sum
of hit rates on both sides, to one hundredth.

Everything is DataFrame and SQL functions. URLs are folded to ``SYMBOLS`` symbols, so a model
has at most SYMBOLS ** (ORDER + 1) rows, under 2.4 million, whatever the input: that bound is
why the model may be broadcast. URL positions are scored where they are read; only one row per
page is shuffled.

Defined results: a null URL, or one without ``://``, has empty host and path and no rule; a null
or empty URL scores 0 and is allowed, as nothing speaks against it; URLs tie freely; without learned rows on both sides every URL
without a rule is allowed, with score 0; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweir.llm.tables import fold, staged, table


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
ORDER = 3
PAD = "^"
#: a-z, one for all digits, ten punctuation marks, one for anything else, and the padding.
SYMBOLS = 39
FOLDS = 5


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def folded(url: Column) -> Column:
    """The URL in the models' alphabet, after ``ORDER`` padding symbols."""
    plain = F.regexp_replace(ascii_lower(F.coalesce(url, F.lit(""))), "[0-9]", "0")
    return F.concat(F.lit(PAD * ORDER), F.regexp_replace(plain, r"[^a-z0/.\-_?=&%:#]", "~"))


def positions(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per character of a URL: it and the ``ORDER`` symbols before it, as ``gram``."""
    at = F.explode(F.expr(f"sequence(1, length(symbols) - {ORDER}, 1)")).alias("at")
    rows = pages.where(F.length("symbols") > ORDER).select(*keep, "symbols", at)
    return rows.select(*keep, F.expr(f"substring(symbols, at, {ORDER + 1})").alias("gram"))


def model(grams: DataFrame) -> DataFrame:
    """``gram, weight``: log-likelihood of the gram's last symbol under the blocked model minus
    that under the allowed one. ``grams``: ``gram, allowed, blocked`` counts, zero for grams
    that only unlabelled URLs have."""
    estimate = None
    for order in range(ORDER + 1):
        level = grams.groupBy(F.expr(f"right(gram, {order + 1})").alias("gram")).agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
        context = Window.partitionBy(F.expr(f"left(gram, {order})"))
        columns = {}
        for side in ("allowed", "blocked"):
            columns[f"{side}_seen"] = F.sum(side).over(context)
            columns[f"{side}_kinds"] = F.sum(F.when(F.col(side) > 0, 1).otherwise(0)).over(context)
        level = level.withColumns(columns)
        if estimate is None:
            level = level.withColumns({f"{side}_shorter": F.lit(1.0 / SYMBOLS) for side in ("allowed", "blocked")})
        else:
            shorter = estimate.toDF("suffix", "allowed_shorter", "blocked_shorter")
            level = level.join(shorter, F.expr(f"right(gram, {order})") == F.col("suffix"))
        mixed = [
            F.when(F.col(f"{side}_seen") == 0, F.col(f"{side}_shorter"))
            .otherwise((F.col(side) + F.col(f"{side}_kinds") * F.col(f"{side}_shorter")) / (F.col(f"{side}_seen") + F.col(f"{side}_kinds")))
            .alias(side)
            for side in ("allowed", "blocked")
        ]
        estimate = level.select("gram", *mixed)
    return estimate.select("gram", (F.log("blocked") - F.log("allowed")).alias("weight"))


def threshold(scored: DataFrame) -> float:
    """The score, in hundredths, above which blocking has the highest sum of hit rates among
    labelled rows (``score``, ``verdict``); of several the smallest in size. The histogram has
    one row per hundredth between the models' bounds."""
    bins = scored.groupBy(F.floor(F.col("score") * 100).alias("bin")).agg(
        F.count_if(F.col("verdict") == "block").alias("blocked"), F.count_if(F.col("verdict") == "allow").alias("allowed")
    )
    above = Window.orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gain = F.expr("try_divide(hit, all_blocked)") + F.expr("try_divide(kept, all_allowed)")
    ranked = bins.select(
        ((F.col("bin") + 1) / 100.0).alias("cut"),
        F.coalesce(F.sum("blocked").over(above), F.lit(0)).alias("hit"),
        F.sum("allowed").over(upto).alias("kept"),
        F.sum("blocked").over(everything).alias("all_blocked"),
        F.sum("allowed").over(everything).alias("all_allowed"),
    )
    best = ranked.where(gain.isNotNull()).orderBy(gain.desc(), F.abs("cut"), "cut").limit(1).collect()
    return best[0]["cut"] if best else 0.0


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score, cut`` for every row of ``pages`` (page_id,
    url). Other columns are not read."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    tests = F.coalesce(fold(F.col("page_id"), FOLDS) == 0, F.lit(True))
    # The row number is written with its row, so it stays as it is.
    rows = staged(
        rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), tests.alias("tests"), folded(F.col("url")).alias("symbols"), F.monotonically_increasing_id().alias("row")),
        "urls",
    )
    side = {s: F.count_if((F.col("verdict") == v) & ~F.col("tests")).alias(s) for s, v in (("allowed", "allow"), ("blocked", "block"))}
    grams = staged(positions(rows, "verdict", "tests").groupBy("gram").agg(*side.values()), "grams")
    sums = grams.agg(F.sum("allowed"), F.sum("blocked")).first()
    if not all(sums):
        scored = rows.withColumns({"score": F.lit(0.0), "cut": F.lit(0.0)})
    else:
        weights = staged(model(grams), "url-model")
        sums = positions(rows, "row").join(F.broadcast(weights), "gram").groupBy("row").agg(F.avg("weight").alias("score"))
        scored = staged(rows.join(sums, "row", "left"), "url-scores")
        scored = scored.withColumn("cut", F.lit(threshold(scored.where("tests and rule is not null"))))
    # Without a character there is no score, and nothing speaks against the URL.
    by_model = F.when(F.col("score") > F.col("cut"), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_model).alias("verdict"), F.coalesce("score", F.lit(0.0)).alias("score"), "cut")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
