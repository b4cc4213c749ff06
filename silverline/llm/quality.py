"""Quality by weak supervision.

A few rules look at a document and vote good (1), bad (-1) or abstain (0). No rule decides
alone: a latent good or bad class is assumed behind the votes, and expectation-maximisation over
all documents that pass the base rules estimates how often good and bad documents get each vote of each rule, and how
common good ones are. A document's quality is the posterior probability that it is good.

Everything is DataFrame operations. The features of a document are arrays of its own row: no
word or window is ever shuffled, and work is linear in the text (only texts with a repeated
window sort their windows). Votes form at most 3^rules patterns, so an iteration sums over that
bounded table of counts, which holds every document; only the new rates reach the driver.

Cases: null and empty texts have no words, and all features 0; so does a text of white space;
repeated rows repeat their result; a null id stays null; a text of any length is read whole, in its
own row; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from silverline.llm.common import SPACE
from silverline.sources.shared import durable

RUN = 8
ROUNDS = 12
START = {"good": (0.02, 0.28, 0.70), "bad": (0.30, 0.30, 0.40)}  # chances of votes -1, 0, 1
START_GOOD = 0.8
KEEP = 0.5
PRIOR = 0.01  # weight of START beside the documents, as a share of them
PLAIN = r"^[\p{P}]{0,2}\p{L}[\p{L}\p{M}'\x{2019}-]*[.,;:!?\"')\]\x{bb}]*$"  # an ordinary word


def features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Base counts and what the rules look at, one row per row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole.alias("_text"),
                       words.alias("_words"), lines.alias("_lines"))
    step = step.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    windows = F.transform(F.sequence(F.lit(1), F.size("_hashes") - RUN + 1),
                          lambda i: F.xxhash64(F.slice("_hashes", i, RUN)))
    none, zero = F.array().cast("array<bigint>"), F.lit(0).cast("long")
    step = step.withColumn("_windows", F.when(F.size("_hashes") > RUN, windows).otherwise(none))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    step = step.withColumn("_placed", F.when(repeats, placed))
    count = F.size("_placed")
    twice = F.zip_with(F.slice("_placed", 1, count - 1), F.slice("_placed", 2, count - 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    step = step.withColumn("_at", F.when(repeats, F.sort_array(F.array_distinct(
        F.flatten(F.filter(twice, lambda x: x.isNotNull()))))))
    count = F.size("_at")
    gaps = F.zip_with(F.slice("_at", 1, count - 1), F.slice("_at", 2, count - 1),
                      lambda a, b: F.least(b - a, F.lit(RUN)).cast("long"))
    covered = F.aggregate(gaps, zero, lambda s, x: s + x) + RUN
    joined = F.array_join("_words", "")
    return step.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, covered).otherwise(zero).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_hashes")).cast("long").alias("n_distinct"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("_text", F.lit(r"[!?]{2,}|\.{4,}")).cast("long").alias("n_shouts"),
        F.size(F.filter("_words", lambda w: w.rlike(PLAIN))).cast("long").alias("n_plain"),
        F.regexp_count("_text", F.lit(r"[.!?][\x20\x09-\x0D]")).cast("long").alias("n_stops"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"[.!?:;\"'\p{Pf}\)][\x20\x09-\x0D]*$")))
        .cast("long").alias("n_ended"))


def rules() -> dict[str, tuple[Column, Column]]:
    """For each rule when it votes bad, and when good."""
    c = F.col
    words, chars = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("word_chars"), F.lit(1))
    lines = F.greatest(c("n_lines"), F.lit(1))
    length, symbols = c("word_chars") / words, c("n_symbols") / words
    upper, ended = c("n_upper") / chars, c("n_ended") / lines
    return {
        "length": (c("n_words") < 20, c("n_words") >= 50),
        "word_length": ((length < 2) | (length > 20), (length >= 3) & (length <= 14)),
        "symbols": (symbols > 0.3, symbols < 0.05),
        "dup_lines": (c("n_dup_lines") > 0.3 * c("n_lines"), c("n_dup_lines") == 0),
        "repeats": (c("n_repeat_words") > 0.2 * c("n_words"), c("n_repeat_words") < 0.05 * words),
        "capitals": (upper > 0.4, upper < 0.12),
        "shouting": (c("n_shouts") > 0.2 * c("n_words"), c("n_shouts") < 0.01 * words),
        "line_ends": (ended < 0.2, ended > 0.7),
        "plain_words": (c("n_plain") < 0.6 * c("n_words"), c("n_plain") > 0.85 * words),
        "sentences": (c("n_words") > 60 * (c("n_stops") + 1), c("n_words") < 35 * (c("n_stops") + 1)),
        "variety": ((c("n_words") >= 100) & (c("n_distinct") < 0.15 * c("n_words")),
                    c("n_distinct") > 0.3 * words),
    }


def votes(found: DataFrame) -> DataFrame:
    return found.withColumns({f"vote_{name}": F.when(bad, -1).when(good, 1).otherwise(0)
                              for name, (bad, good) in rules().items()})


def _odds(rates: dict, good: float, names: list[str]) -> Column:
    """Log odds that a document is good, from its votes."""
    total = F.lit(math.log(good / (1 - good)))
    for name in names:
        by_vote = [math.log(a / b) for a, b in zip(rates["good"][name], rates["bad"][name])]
        total = total + F.element_at(F.array(*map(F.lit, by_vote)), F.col(f"vote_{name}") + 2)
    return total


def posterior(rates: dict, good: float, names: list[str]) -> Column:
    return 1 / (1 + F.exp(-_odds(rates, good, names)))


def estimate(voted: DataFrame, rounds: int = ROUNDS) -> tuple[dict, float]:
    """Rates of votes by class and rule, and the share of good documents."""
    names = list(rules())
    patterns = durable(voted.groupBy(*[f"vote_{n}" for n in names])
                       .agg(F.count(F.lit(1)).alias("n")).coalesce(1))
    rates = {y: {n: START[y] for n in names} for y in START}
    good = START_GOOD
    for _ in range(rounds):
        weighed = patterns.withColumn("_p", posterior(rates, good, names))
        part = {"good": F.col("n") * F.col("_p"), "bad": F.col("n") * (1 - F.col("_p"))}
        row = weighed.agg(
            F.sum("n").alias("n"), *[F.sum(part[y]).alias(y) for y in part],
            *[F.sum(F.when(F.col(f"vote_{n}") == v, part[y])).alias(f"{y}_{n}_{v}")
              for y in part for n in names for v in (-1, 0, 1)]).first()
        if not row["n"]:
            break
        good = (row["good"] + 1) / (row["n"] + 2)
        held = PRIOR * row["n"]
        rates = {y: {n: tuple(((row[f"{y}_{n}_{v}"] or 0.0) + held * START[y][v + 1]) / (row[y] + held)
                              for v in (-1, 0, 1)) for n in names} for y in part}
    return rates, good


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
          rounds: int = ROUNDS, keep: float = KEEP) -> DataFrame:
    """The features with `base_failed`, `quality` (the posterior) and `kept`."""
    voted = durable(votes(features(docs, text, doc_id)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rates, good = estimate(voted.filter(~failed), rounds)
    return (voted.withColumn("quality", posterior(rates, good, list(rules())))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep)))
