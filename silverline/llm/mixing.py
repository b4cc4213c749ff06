"""Mixing sources to target weights along a low-discrepancy schedule.

Sizes are word counts. The sources, in code point order with null last, weigh 1, 2, 3 and so
on over again, and share the total of all sizes by weight; no target exceeds `max_epochs` times
its source's size, and what is cut off is shared anew among the others.

A source's documents are laid end to end in a shuffled order (by a hash of seed and id) and
cut into blocks of `block` words. The mix is a row of slots. Slot k falls on the point
k * a mod 2^30, where a / 2^30 is close to the golden ratio: any run of slots is spread evenly
over the circle, which the sources divide in proportion to the slots that they need. So every
stretch of the mix, not only the whole of it, has the wanted shares. A source's r-th slot takes
its block r mod n in epoch r / n, and slots past the last allowed epoch stay empty.

All of it is DataFrame operations, deterministic, and free of windows over a whole source:
running sums go by hash range inside a source, and ranks by stretch of slots, each with a small
table of totals to start from. A source with a third of all rows is spread like any other; the
join of documents to sources is one that adaptive execution may split.

Cases: a null text or one without words has size 0, target of its source, taken 0; a source
without words has target 0; a null source is a source; a null id is shuffled as an empty text;
rows sharing an id are separate rows; a text of any length counts all its words; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from silverline.llm.common import bounded, numbered, stored
from silverline.operators.keyed import running_total
from silverline.sources.shared import durable

BLOCK = 64
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"

CIRCLE = 1 << 30
STEP = 663608941
ARCS = 1 << 10
STRETCH = 1 << 16
ROWS_A_RANGE = 4096
FINE = 1024


@dataclass
class Mix:
    """sources: source, sid, weight, source_size, target, blocks, low, high (its arc).
    rows: row, doc_id, source, sid, size, start: one per input row, `start` in its source.
    slots: slot, sid, rank, block, epoch."""
    sources: DataFrame
    rows: DataFrame
    slots: DataFrame
    block: int

    def pieces(self) -> DataFrame:
        """(sid, block, row, words): the stretch of each row in each block of its source."""
        b, end = self.block, F.col("start") + F.col("size")
        first, last = F.expr(f"start div {b}"), F.expr(f"(start + size - 1) div {b}")
        return (self.rows.filter("size > 0")
                .select("sid", "row", "start", "size",
                        F.explode(F.sequence(first, last)).alias("block"))
                .select("sid", "block", "row",
                        (F.least(end, (F.col("block") + 1) * b)
                         - F.greatest("start", F.col("block") * b)).alias("words")))

    def filled(self) -> DataFrame:
        """(slot, sid, block, epoch, row, words): the mix itself, in the order of its slots."""
        return self.slots.join(self.pieces(), ["sid", "block"])

    def taken(self) -> DataFrame:
        """The rows with `source_size`, `target` and the words `taken` from each."""
        uses = self.slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("uses"))
        sums = (self.pieces().join(uses, ["sid", "block"])
                .groupBy("row").agg(F.sum(F.col("words") * F.col("uses")).alias("taken")))
        known = self.sources.select("sid", "source_size", "target")
        return (self.rows.join(sums, "row", "left").join(known, "sid")
                .withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))))


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _level(sources: DataFrame, total: int, epochs: int) -> float:
    """Words per unit of weight such that the capped targets add up to the total."""
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("source_size") * epochs
        row = sources.agg(F.sum(F.when(over, F.col("source_size") * epochs)).alias("full"),
                          F.sum(F.when(~over, F.col("weight"))).alias("weight"),
                          F.count(F.when(over, 1)).alias("capped")).first()
        if row["capped"] == capped or not row["weight"]:
            return level
        capped = row["capped"]
        level = (total - (row["full"] or 0)) / row["weight"]


def _sources(sized: DataFrame, weights: tuple[int, ...], epochs: int, block: int) -> DataFrame:
    order = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source"))
    own = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("_order", order).withColumn("_one", F.lit(1).cast("long")))
    own = running_total(own, "_order", "_one", "sid")
    own = own.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    own = durable(own.select("sid", "source", "source_size", "weight"))
    total = own.agg(F.sum("source_size")).first()[0] or 0
    level = _level(own, total, epochs)
    own = (own.withColumn("target", F.least(F.col("source_size") * F.lit(float(epochs)),
                                            F.col("weight") * F.lit(level)))
           .withColumn("blocks", F.ceil(F.col("source_size") / block)))
    slots = F.when(F.col("source_size") > 0,
                   F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    own = running_total(own.withColumn("_slots", F.floor(slots * FINE)), "sid", "_slots", "_upto")
    return durable(own)


def _arcs(own: DataFrame, fine: int) -> DataFrame:
    """Each source's part of the circle, in proportion to its slots."""
    at = lambda c: F.floor(c / F.lit(float(max(1, fine))) * float(CIRCLE))
    return (own.withColumn("low", at(F.col("_upto") - F.col("_slots")))
            .withColumn("high", at(F.col("_upto"))).drop("_upto", "_slots"))


def _laid_out(sized: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """Each row's place in its source's shuffled row of words."""
    ranges = max(1, sized.count() // ROWS_A_RANGE)
    mark = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keys = sources.select(F.col("source").alias("_source"), "sid")
    rows = (sized.join(keys, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("_mark", mark)
            .withColumn("_range", F.conv(F.substring("_mark", 1, 8), 16, 10).cast("long") % ranges)
            .withColumn("row", F.col("_row") if "_row" in sized.columns else F.monotonically_increasing_id()))
    rows = durable(rows)
    before = Window.partitionBy("sid").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (rows.groupBy("sid", "_range").agg(F.sum("size").alias("_sum"))
            .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum"))
    within = (Window.partitionBy("sid", "_range").orderBy("_mark", "doc_id", "size", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("_own", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(sums, ["sid", "_range"])
            .select("row", "doc_id", "source", "sid", "size",
                    (F.col("_base") + F.col("_own")).alias("start")))


def _slots(sources: DataFrame, count: int, epochs: int) -> DataFrame:
    spark = sources.sparkSession
    points = (spark.range(count).withColumnRenamed("id", "slot")
              .withColumn("point", F.col("slot") % CIRCLE * STEP % CIRCLE))
    width = CIRCLE // ARCS
    arcs = (sources.filter("high > low")
            .withColumn("arc", F.explode(F.sequence(F.expr(f"low div {width}"),
                                                    F.expr(f"(high - 1) div {width}"))))
            .select("arc", "low", "high", "sid", "blocks"))
    found = (points.withColumn("arc", F.expr(f"point div {width}")).join(arcs, "arc")
             .filter("point >= low and point < high")
             .select("slot", "sid", "blocks", F.expr(f"slot div {STRETCH}").alias("_stretch")))
    found = durable(found)
    before = (Window.partitionBy("sid").orderBy("_stretch")
              .rowsBetween(Window.unboundedPreceding, -1))
    bases = (found.groupBy("sid", "_stretch").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    within = Window.partitionBy("sid", "_stretch").orderBy("slot")
    ranked = (found.withColumn("_at", F.row_number().over(within)).join(bases, ["sid", "_stretch"])
              .withColumn("rank", F.col("_base") + F.col("_at") - 1))
    return (ranked.filter(F.col("rank") < F.col("blocks") * epochs)
            .select("slot", "sid", "rank", (F.col("rank") % F.col("blocks")).alias("block"),
                    F.expr("rank div blocks").alias("epoch")))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, block: int = BLOCK,
        seed: str = SEED, row: str | None = None) -> Mix:
    """Plan the mix of all rows of `docs`; `row` names a column with a unique number of each, if there is one."""
    number = [F.col(row).alias("_row")] if row else []
    sized = durable(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                                F.col(source).alias("source"), word_count(text).alias("size"), *number))
    own = _sources(sized, weights, max_epochs, block)
    fine = own.agg(F.max("_upto")).first()[0] or 0
    sources = _arcs(own, fine)
    slots = _slots(sources, -(-fine // FINE), max_epochs)
    return Mix(sources, durable(_laid_out(sized, sources, seed)), slots, block)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Rows of `docs` in the order of the mix: a copy at each slot that holds a row's middle word.

    So a row is repeated about as often as the mix takes its words, never more than `max_epochs`
    times, and every stretch of the result has the wanted shares, as far as whole rows allow. The
    result is sorted by ranges of slots, each a task. Takes the columns doc_id, source and text;
    others ride along, whatever their names.
    """
    whole = numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest")), "mix")
    plan = mix(whole.select("row", "rest.doc_id", "rest.source", "rest.text"), row="row", **options)
    middle = F.floor((F.col("start") + F.floor(F.col("size") / 2)) / plan.block)
    placed = (plan.rows.filter("size > 0").select("sid", middle.alias("block"), "row", "start")
              .join(plan.slots.select("sid", "block", "slot"), ["sid", "block"]).select("row", "slot", "start"))
    return (whole.select("row", "rest").join(bounded(stored(placed, "placed")), "row")
            .repartitionByRange("slot", "start").sortWithinPartitions("slot", "start").select("rest.*"))
