"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

The mix has ``SLOTS`` slots. Slot *i* lies at the fractional part of *(i + 1/2)* times the golden ratio, and that
point, mapped through the sources' cumulative targets, says whose turn it is: any stretch of the schedule holds
the sources nearly in proportion. The slots of a source are ranked, and its slot of rank *r* takes block *r* of
its documents, shuffled by a hash and laid end to end, again and again if the target exceeds the source. Blocks
hold the same number of words for all sources. A source's last block is cut off at its target, and a source that
the points give too few slots gets the missing ones at the end, so it takes its target to the word. A document comes
where its blocks come: the mix gives out the slots of each of its passes, and the mixed corpus is in their order, so
that any stretch of it holds the sources nearly in proportion.

Targets: sources in order of code points, null last, have the weights ``WEIGHTS`` in turn and share the words of
all documents; a target stops at ``MAX_PASSES`` times its source's words, and the excess goes to the others by
weight. That level is worked out at once from the sources in the order in which they stop. So no document is
taken more than ``MAX_PASSES`` times.

Null texts count as empty; texts without words have size 0 and take 0. A null source is a source, as is an empty
one. Ties in the shuffle go by ``doc_id`` and row. Repeated rows are documents of their own; other columns than id,
text and source are carried, whatever their names. Words of very long texts are counted where the text is read; such
a text covers many blocks. An empty table gives an empty result. The list of sources is sorted in one task; nothing
else is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, columns_of, keyed, row_key, scratch, staged, text_of, unused

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
#: The golden ratio's fractional part.
GOLDEN = 0.6180339887498949
SLOTS = 1 << 18
#: Cells of the unit interval through which points find their source.
CELLS = 1 << 12
#: Slots that are ranked in one piece, and digits of the shuffle's hash that make one.
CHUNK = 1 << 12
DIGITS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: ``source_no`` from 0, ``source``, ``source_size`` and ``target``."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    ranked = totals.select(
        (F.row_number().over(by_name) - 1).alias("source_no"),
        "source",
        "source_size",
        F.sum("source_size").over(everything).alias("total"),
    )
    turn = F.col("source_no") % len(weights) + 1
    ranked = ranked.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn.cast("int")))
    ranked = ranked.withColumn("cap", (passes * F.col("source_size")).cast("double"))
    # In the order in which sources stop; each asks for the level if all before it have stopped.
    ranked = ranked.withColumn("stop", F.col("cap") / F.col("weight"))
    order = Window.orderBy("stop", "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(after))
    fits = F.when(F.col("level") <= F.col("stop"), F.struct("stop", "source_no", "level"))
    level = F.coalesce(F.min(fits).over(everything)["level"], F.lit(0.0))
    return ranked.select(
        "source_no", "source", "source_size", F.least("cap", F.col("weight") * level).alias("target"), "total"
    )


def schedule(targets: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``slot``, ``source_no`` and the ``block`` of that source, with the words ``start`` to ``end`` it takes.

    ``start`` and ``end`` count along the source's documents laid end to end again and again.
    """
    spark = targets.sparkSession
    wide = targets.withColumn("block_words", F.greatest(F.ceil(F.col("total") / slots), F.lit(1)).cast("bigint"))
    wide = wide.withColumn("quota", F.round("target").cast("bigint"))
    line = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    share = F.col("target") / F.sum("target").over(Window.partitionBy())
    wide = wide.where("target > 0").withColumn("share", share).withColumn("high", F.sum("share").over(line))
    wide = staged(wide.withColumn("low", F.col("high") - F.col("share")), "shares")
    first, last = F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS))
    cells = wide.select("source_no", "low", "high", F.explode(F.sequence(first, last)).alias("cell"))
    turn = (F.col("id") + 0.5) * GOLDEN
    points = spark.range(slots).select(F.col("id").alias("slot"), (turn - F.floor(turn)).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS))
    # The last interval is open upwards, so that rounding loses no point.
    top = F.col("high") >= 1 - 1e-9
    hit = (F.col("low") <= F.col("point")) & ((F.col("point") < F.col("high")) | top)
    dealt = points.join(cells, "cell").where(hit)
    dealt = dealt.groupBy("slot").agg(F.min("source_no").alias("source_no"))
    dealt = staged(dealt.withColumn("chunk", F.floor(F.col("slot") / CHUNK)), "slots")
    counts = dealt.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("source_no", "chunk").orderBy("slot")
    ranked = dealt.withColumn("rank", F.row_number().over(inside) - 1).join(counts, ["source_no", "chunk"])
    ranked = ranked.select("slot", "source_no", (F.col("rank") + F.col("before")).alias("block"))
    got = dealt.groupBy("source_no").agg(F.count(F.lit(1)).alias("n"))
    need = F.ceil(F.col("quota") / F.col("block_words"))
    short = wide.join(got, "source_no", "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < need)
    missing = short.select("source_no", F.explode(F.sequence(F.col("n"), need - 1)).alias("block"))
    missing = missing.select((F.lit(slots) + F.col("block")).alias("slot"), "source_no", "block")
    start = F.col("block") * F.col("block_words")
    return (
        ranked.unionByName(missing)
        .join(wide.select("source_no", "quota", "block_words"), "source_no")
        .withColumn("start", start)
        .where("start < quota")
        .withColumn("end", F.least(F.col("start") + F.col("block_words"), F.col("quota")))
        .select("slot", "source_no", "block", "start", "end")
    )


def laid_out(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """The documents of each source, shuffled, with the place ``at`` of their first word in the source."""
    shuffle = F.md5(F.concat(F.lit("mix "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    docs = sizes.withColumn("shuffle", shuffle).withColumn("bucket", F.substring("shuffle", 1, DIGITS))
    docs = docs.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    buckets = docs.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    inside = Window.partitionBy("source_no", "bucket").orderBy("shuffle", "doc_id", "row_id")
    end = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    docs = docs.withColumn("inside", end - F.col("size")).join(
        buckets.select("source_no", "bucket", "before"), ["source_no", "bucket"]
    )
    return docs.withColumn("at", F.col("before") + F.col("inside"))


def mix(docs: DataFrame, key: Column | None = None, slots: int = SLOTS) -> DataFrame:
    """Per row of ``docs``: ``row_id``, ``key``, ``doc_id``, ``size``, its source's ``source_size`` and ``target``, ``taken``.

    And where: ``begins``, the first slot of each pass in order of passes, ``first_slot``, ``last_slot``, ``n_slots``.
    """
    size = F.regexp_count(text_of(), F.lit(WORD)).cast("bigint").alias("size")
    sizes = staged(keyed(docs, "doc_id", "source", size, key=key), "sizes")
    targets = staged(source_targets(sizes), "targets")
    plan = schedule(targets, slots)
    words = F.greatest(F.ceil(F.col("total") / slots), F.lit(1)).cast("bigint")
    rows = laid_out(sizes, targets).withColumn("block_words", words)
    quota = F.round("target").cast("bigint")
    last_pass = F.floor((quota - 1 - F.col("at")) / F.col("source_size"))
    taken_from = (F.col("size") > 0) & (quota > F.col("at"))
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn(
        "again", F.explode_outer(F.when(taken_from, F.sequence(F.lit(0).cast("bigint"), last_pass)).otherwise(none))
    )
    rows = rows.withColumn("first", F.col("again") * F.col("source_size") + F.col("at"))
    rows = rows.withColumn("last", F.least(F.col("first") + F.col("size"), quota) - 1)
    blocks = F.sequence(F.floor(F.col("first") / F.col("block_words")), F.floor(F.col("last") / F.col("block_words")))
    columns = ["row_id", "key", "doc_id", "size", "source_size", "target"]
    pieces = rows.select(
        *columns, "again", "source_no", "first", "last", F.explode_outer(F.when(F.col("again").isNotNull(), blocks)).alias("block")
    )
    met = pieces.join(plan, ["source_no", "block"], "left")
    overlap = F.least(F.col("last") + 1, "end") - F.greatest("first", "start")
    # A pass that is taken has a block, and of its blocks the first slot says where it comes.
    begins = [F.min(F.when(F.col("again") == k, F.col("slot"))) for k in range(MAX_PASSES)]
    return met.groupBy(*columns).agg(
        F.coalesce(F.sum(overlap), F.lit(0)).cast("bigint").alias("taken"),
        F.array_compact(F.array(*begins)).alias("begins"),
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.count("slot").alias("n_slots"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, its words by the document's, rounded half up.

    They are in the order of the schedule, each pass of a document where its first block is: the first partition
    has the lowest slots, and a partition is sorted.
    """
    with scratch(docs.sparkSession):
        times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
        decided = mix(docs, row_key(docs)).where(times > 0)
        decided = decided.select("key", F.slice("begins", F.lit(1), times.cast("int")).alias("slots"))
        # Rows that agree in all columns share a key, so their slots are one list.
        shared = decided.groupBy("key").agg(F.flatten(F.collect_list("slots")).alias("slots"), F.count("*").alias("rows"))
        shared = staged(shared, "slots-of-rows", kept=True)
        key, slot = unused(docs, "_key"), unused(docs, "_slot")
        rows = docs.withColumn(key, row_key(docs))
        if not shared.where("rows > 1").isEmpty():
            rows = rows.dropDuplicates([key])
        chosen = shared.select(F.col("key").alias(key), F.col("slots").alias(slot))
        placed = rows.join(chosen, key).select(*columns_of(docs), F.explode(F.col(slot)).alias(slot))
        return placed.repartitionByRange(slot).sortWithinPartitions(slot).select(*columns_of(docs))
