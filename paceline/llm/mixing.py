"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Targets share the words of all sources by weight; a source gives at most ``repeats`` times its words,
and what it cannot give is shared again by weight among the others. Each source's rows lie shuffled
on a line, repeated end to end as often as its target needs, cut into blocks of equal words. Slot k of
the schedule has the point frac(k * golden ratio); the source whose stretch of cumulative shares holds
the point owns the slot, and the slot's rank among that source's slots is the block it takes. Sources
so appear evenly at every scale of the schedule. The schedule has as many slots as there are blocks; the
sequence is off by a few points, so slots that find their source's blocks used up go in order to the blocks
still open. Words are taken by the inner join of slots with blocks and in no other way.

No task holds a source: rows and slots are placed on their lines in some sqrt(n) runs, the join of
slots with cumulative shares is an equality of grid cells, blocks and slots meet one to one. Sources
themselves, one short row each, are put in order by one window.

Defined cases: a null source is a source, ordered last; a null text has no words and is never taken; an
empty table gives no rows; repeated rows are rows of their own; other columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.tables import on_a_line, stored, text_of

GOLDEN = 0.6180339887498949
# Words of a block.
BLOCK = 256
# Cells of the grid on which a point finds its source.
CELLS = 4096


def word_count(text: Column | str) -> Column:
    """Runs of what is not ASCII white space; null has none."""
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """For (source, source_size): target words, and the stretch [lo, hi) of cumulative shares.

    Filling by weight up to the limits ends where every source below its limit has the same words per
    weight, so limits in order of limit per weight are used up to the first that would not be reached.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(by_name) - 1
    one = (
        sizes.withColumn("place", place)
        .withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * float(repeats))
        .withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything))
    )
    rising = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    up_to = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("limit").over(up_to), F.lit(0.0))
    rate = left / F.sum("weight").over(onward)
    level = one.withColumn("rate", rate).withColumn(
        "level", F.max(F.when(F.col("limit") > F.col("rate") * F.col("weight"), F.col("rate"))).over(everything)
    )
    share = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    aimed = level.withColumn("target", share)
    in_order = Window.orderBy("place")
    begins = F.coalesce(F.sum("target").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ends = F.sum("target").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return aimed.select(
        "place", "source", "source_size", "target", F.round("target").cast("long").alias("quota"),
        (begins / F.nullif(F.sum("target").over(everything), F.lit(0.0))).alias("lo"),
        F.when(F.col("place") == F.max("place").over(everything), 1.0)
        .otherwise(ends / F.nullif(F.sum("target").over(everything), F.lit(0.0))).alias("hi"),
    )


def slots(shares: DataFrame, count: int, step: float = GOLDEN, cells: int = CELLS) -> DataFrame:
    """(slot, place, rank): ``count`` slots, each with the source that holds its point and its rank there."""
    spark = shares.sparkSession
    # frac(k * step) in two steps keeps its digits for long schedules.
    stride = 2**20 * step % 1.0
    high, low = F.floor(F.col("id") / 2**20), F.col("id") % 2**20
    points = spark.range(count).select(F.col("id").alias("slot"), ((high * stride % 1.0 + low * step) % 1.0).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * cells))
    stretch = F.sequence(F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))
    grid = shares.filter("hi > lo").select("place", "lo", "hi", F.explode(stretch).alias("grid_cell"))
    owned = points.join(
        grid, (points.cell == grid.grid_cell) & (points.point >= grid.lo) & (points.point < grid.hi)
    ).select("slot", "place")
    # The rank: slots of earlier runs, then those of the run before this one.
    run = max(1, round(count**0.5))
    owned = owned.withColumn("run", F.floor(F.col("slot") / run))
    earlier = Window.partitionBy("place").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = owned.groupBy("place", "run").agg(F.count("*").alias("n")).select(
        F.col("place").alias("p"), F.col("run").alias("r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("place", "run").orderBy("slot")
    ranked = owned.withColumn("inside", F.row_number().over(within) - 1)
    return ranked.join(sums, (ranked.place == sums.p) & (ranked.run == sums.r)).select(
        "slot", "place", (F.col("base") + F.col("inside")).alias("rank"))


def schedule(shares: DataFrame, block: int = BLOCK, step: float = GOLDEN) -> DataFrame:
    """(slot, place, rank): each slot with the block it takes.

    A slot whose source has no block left goes to a block left open, in order: some log(slots) for each source.
    """
    wanted = shares.select("place", F.ceil(F.col("quota") / block).cast("long").alias("blocks"))
    sources, count = wanted.agg(F.count("*"), F.coalesce(F.sum("blocks"), F.lit(0))).first()
    # As many cells as sources at least, so a point meets few stretches.
    owned = stored(slots(shares, count, step, max(CELLS, 4 * sources)), "slots")
    found = owned.join(wanted, "place")
    used = found.filter("rank < blocks").select("slot", "place", "rank")
    spare = found.filter("rank >= blocks").select("slot", F.row_number().over(Window.orderBy("slot")).alias("n"))
    have = owned.groupBy("place").agg(F.count("*").alias("have"))
    short = wanted.join(have, "place", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("have < blocks")
    open_blocks = short.select("place", F.explode(F.sequence("have", F.col("blocks") - 1)).alias("rank"))
    open_blocks = open_blocks.withColumn("n", F.row_number().over(Window.orderBy("rank", "place")))
    return used.union(spare.join(open_blocks, "n").select("slot", "place", "rank"))


def mix(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), repeats: int = 3, block: int = BLOCK,
    keep: Sequence[str] = ("doc_id",), text: str = "text", source: str = "source", step: float = GOLDEN,
) -> tuple[DataFrame, DataFrame]:
    """The placed rows, and the schedule's pieces.

    Placed: ``keep``, source, size, source_size, target, quota, place, start (on the source's line).
    Pieces: slot, place, start, size (of the row), copy (0 for the first pass over the source), first
    word, words. A row of size 0 has no piece. A size and start name one row of a source that has words.
    """
    rows = docs.select(*keep, F.col(source).alias("source"), word_count(text).alias("size"))
    rows = stored(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = stored(targets(sizes, weights, repeats), "shares")
    line = on_a_line(rows, "source", [*map(F.col, keep), F.col("size")], F.col("size"), "start")
    named = shares.withColumnRenamed("source", "named")
    placed = line.join(
        named.select("named", "place", "source_size", "target", "quota"), line.source.eqNullSafe(named.named)
    ).drop("named")
    placed = stored(placed, "placed")

    # A pass over the source shifts a row by the source's size; words beyond the quota are not taken.
    passes = F.explode(F.sequence(F.lit(0), F.ceil(F.col("quota") / F.col("source_size")).cast("int") - 1))
    taken = (
        placed.filter("size > 0 and quota > 0").select("place", "start", "size", "source_size", "quota", passes.alias("copy"))
        .withColumn("a", F.col("copy") * F.col("source_size") + F.col("start"))
        .withColumn("b", F.least(F.col("a") + F.col("size"), F.col("quota")))
        .filter("b > a")
        .withColumn("rank", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("b") - 1) / block))))
    )
    begin, end = F.greatest("a", F.col("rank") * block), F.least("b", (F.col("rank") + 1) * block)
    pieces = taken.select(
        "place", "rank", "start", "size", "copy", (begin - F.col("a")).alias("first"), (end - begin).alias("words")
    ).join(schedule(shares, block, step), ["place", "rank"])
    return placed, pieces.drop("rank")


def words_taken(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """The placed rows, each with the words that its slots take of it, repeats counted, and its first slot (null if none)."""
    sums = pieces.groupBy("place", "start", "size").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return placed.join(sums, ["place", "start", "size"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
