"""Mixing sources to target weights by a low-discrepancy source schedule. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free, looked_up, small, stored

#: Weights by rank of the source in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: 2**32 divided by the golden ratio, to the nearest odd number: slot k stands at frac(k * GOLDEN / 2**32).
GOLDEN = 2654435769
#: Documents, about, of a hash bucket of the shuffle, and least buckets of a source; slots that are ranked together, and most such runs.
BUCKET, BUCKETS, RUN, RUNS = 20_000, 1024, 4096, 65_536
#: Cells of the line of cumulative targets in which the sources of points are looked up, beside a few for each source.
CELLS = 4096
#: Words of a block.
BLOCK = 128


def _sid(source: Column) -> Column:
    """A key of the source that is never null."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("s"), source))


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, sid, size (words; null text: 0) and the place in the shuffle of the source, by a hash of id and text."""
    buckets = max(BUCKETS, docs.count() // BUCKET)
    size = F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    mixed = F.xxhash64(F.lit("mix"), "doc_id", F.coalesce(text, F.lit("")))
    return docs.select("doc_id", "source", _sid(F.col("source")).alias("sid"), size.alias("size"), mixed.alias("mixed"), F.pmod(F.shiftrightunsigned(mixed, 20), F.lit(buckets)).alias("bucket"), F.monotonically_increasing_id().alias("row"))


def targets(by_source: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Water filling over the table of sources: (source, source_size) gains weight, target and place (from 0, by code point).

    Targets are min(most * size, level * weight); the level is the one at which they sum to `share` of all sizes.
    That is what resharing the excess by weight ends at. A source of no words gets 0.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    every, order = Window.partitionBy(), Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        by_source.withColumn("weight", w)
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", share * F.sum("source_size").over(every))
        .withColumn("weights", F.sum("weight").over(every))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("first_open", F.min(F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(every))
        .withColumn("open_level", F.max(F.when((F.col("ratio") == F.col("first_open")) & (F.col("level") <= F.col("ratio")), F.col("level"))).over(every))
        .withColumn("target", F.when(F.col("open_level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("open_level") * F.col("weight"))))
        .select("source", "source_size", "weight", "target", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("long").alias("place"))
    )


def schedule(spark: SparkSession, goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots of the mix: slot, sid, rank of the slot within the source, and its words. Goals have source, target and place.

    Slot k of n takes the source whose stretch of cumulative target holds the golden-ratio point of k; the source is looked up by
    the cell of the line that the point is in. Ranks come from counts per run of slots and a window within the run, so
    that no source's slots meet in one task. A slot has `block` words, a source's last one what remains of its target (to
    the nearest word). Slots beyond the target go; a source that got too few has the others after the last slot.
    """
    goals = goals.select("source", _sid(F.col("source")).alias("sid"), "target", "place", F.round("target").cast("long").alias("goal"))
    edge = Window.orderBy("place")
    reach = goals.select("sid", "goal", "place", F.sum("target").over(edge.rowsBetween(Window.unboundedPreceding, 0)).alias("hi"), F.sum("target").over(Window.partitionBy()).alias("all"), F.count("*").over(Window.partitionBy()).alias("sources"))
    reach = stored(reach.withColumn("lo", F.lag("hi", 1, 0.0).over(edge)), "reach")
    sums = reach.agg(F.coalesce(F.ceil(F.max("all") / block), F.lit(0)).alias("n"), F.coalesce(F.max("sources"), F.lit(0)).alias("sources")).first()
    n, cells, run = sums["n"], CELLS + 4 * sums["sources"], max(RUN, sums["n"] // RUNS)
    cell = lambda at: F.floor(at * cells)
    near = F.sequence(F.greatest(cell(F.col("lo") / F.col("all")) - 1, F.lit(0)), F.least(cell(F.col("hi") / F.col("all")) + 1, F.lit(cells - 1)))
    lines = stored(reach.where("hi > lo").select("sid", "goal", "lo", "hi", "all", F.explode(near).alias("cell")), "cells")
    slots = spark.range(0, n).withColumnRenamed("id", "slot")
    point = (F.col("slot") % F.lit(2**31)) * F.lit(GOLDEN) % F.lit(2**32) / F.lit(float(2**32))
    slots = slots.withColumn("point", point).withColumn("cell", cell(F.col("point")))
    placed = slots.join(small(lines), "cell").where((F.col("point") * F.col("all") >= F.col("lo")) & (F.col("point") * F.col("all") < F.col("hi")))
    placed = placed.select("slot", "sid", "goal", F.floor(F.col("slot") / run).alias("run"))
    counts = placed.groupBy("sid", "run").agg(F.count("*").alias("n"))
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("sid", "run").orderBy("slot")) - 1
    ranked = placed.withColumn("within", within).join(ahead, ["sid", "run"]).select("slot", "sid", "goal", (F.col("ahead") + F.col("within")).alias("rank"))
    short = reach.join(counts.groupBy("sid").agg(F.sum("n").alias("have")), "sid", "left").withColumn("have", F.coalesce("have", F.lit(0))).where(F.col("have") * block < F.col("goal"))
    more = short.select("sid", "goal", "sources", "place", "have", F.explode(F.sequence(F.col("have"), F.ceil(F.col("goal") / block) - 1)).alias("rank"))
    more = more.select((F.lit(n) + (F.col("rank") - F.col("have")) * F.col("sources") + F.col("place")).cast("long").alias("slot"), "sid", "goal", "rank")
    words = F.least(F.lit(block), F.col("goal") - F.col("rank") * block).cast("long")
    return ranked.unionByName(more).select("slot", "sid", "rank", words.alias("words")).where("words > 0")


def _places(sized: DataFrame) -> DataFrame:
    """Adds `start`: the words of the source's shuffled documents ahead of this one."""
    parts = sized.groupBy("sid", "bucket").agg(F.sum("size").alias("part"))
    parts = parts.select("sid", "bucket", F.coalesce(F.sum("part").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    order = Window.partitionBy("sid", "bucket").orderBy("mixed", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return sized.withColumn("inner", F.coalesce(F.sum("size").over(order), F.lit(0))).join(parts, ["sid", "bucket"]).withColumn("start", F.col("before") + F.col("inner"))


def _goals(sized: DataFrame, share: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return stored(targets(by_source, share, most, weights).withColumn("sid", _sid(F.col("source"))), "mix-targets")


def _dealt(sized: DataFrame, goals: DataFrame, block: int) -> DataFrame:
    """slot, row, first, words: which words of which row each slot takes: the slots joined with the blocks of their rank.

    Every source's documents, shuffled, are laid end to end, over and over, and cut into blocks; only the passes and blocks up to
    the target are made.
    """
    told = goals.select("sid", "source_size", F.round("target").cast("long").alias("goal"))
    laid = looked_up(_places(sized).where("size > 0").select("sid", "row", "size", "start"), told, ["sid"]).where("start < goal")
    passes = F.sequence(F.lit(0).cast("long"), F.floor((F.col("goal") - F.col("start") - 1) / F.col("source_size")))
    laid = laid.select("sid", "row", "size", "goal", "start", F.explode(passes).alias("pass"), "source_size")
    laid = laid.withColumn("from", F.col("pass") * F.col("source_size") + F.col("start")).withColumn("to", F.least(F.col("from") + F.col("size"), F.col("goal")))
    pieces = laid.select("sid", "row", "from", "to", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))).alias("rank"))
    low, high = F.greatest("from", F.col("rank") * block), F.least("to", (F.col("rank") + 1) * block)
    pieces = pieces.select("sid", "rank", "row", (low - F.col("from")).alias("first"), (high - low).alias("words"))
    slots = schedule(sized.sparkSession, goals.select("source", "target", "place"), block).select("sid", "rank", "slot")
    return pieces.join(slots, ["sid", "rank"]).select("slot", "row", "first", "words")


def ordered(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """slot, doc_id, source, first, words: the mix in order: slot by slot, which words of which document it takes."""
    sized = stored(sizes(docs), "mix-sizes")
    dealt = _dealt(sized, _goals(sized, share, most, weights), block)
    return dealt.join(sized.select("row", "doc_id", "source"), "row").select("slot", "doc_id", "source", "first", "words")


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words the mix takes of each document.

    Every source's documents are shuffled (by hash) and laid end to end, over and over, then cut into blocks of
    `block` words. The source's slots of the schedule, by rank, take its blocks in turn; a block goes on over the end
    of a pass, and the last one is as long as what remains of the target. `taken` counts a document's words in the
    blocks that slots took: over a source they sum to its target, to the nearest word, so at most to `most` passes.
    Nulls: a null text has size 0, a null source is a source, a null doc_id is an id. Documents without words get
    taken 0; no rows give no rows. Repeated rows count apart, each with its place; equal ones share a bucket.
    The table of sources, a row each, is ordered in one task.
    """
    sized = stored(sizes(docs), "mix-sizes")
    goals = _goals(sized, share, most, weights)
    taken = _dealt(sized, goals, block).groupBy("row").agg(F.sum("words").alias("taken"))
    met = sized.select("row", "doc_id", "source", "sid", "size").join(taken, "row", "left")
    out = looked_up(met, goals.select("sid", "source_size", "target"), ["sid"])
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def rendered(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: each is repeated as often as `taken` holds its size, rounded; the columns stay."""
    key, times, copy = free(docs.columns, "key", "times", "copy")
    cols = [F.col(c) for c in docs.columns]
    keyed = docs.withColumn(key, F.xxhash64(*cols, *[c.isNull() for c in cols]))
    rounded = F.round(F.col("taken") / F.greatest("size", F.lit(1)))
    got = mix(keyed.select(F.col(key).alias("doc_id"), "text", "source"), **how).groupBy("doc_id").agg(F.max(rounded).cast("int").alias(times))
    joined = keyed.join(got.withColumnRenamed("doc_id", key), key).where(F.col(times) > 0)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
