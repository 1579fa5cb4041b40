"""Mixing sources to target weights by a low-discrepancy schedule (operator 9).

Each source's documents, shuffled by a hash of their id, form one line of words that
is cut into blocks of nearly equally many words: at most ``block``, and small sources
into at least ``LEAST_BLOCKS`` (or one word each). A source's quota of slots is its
target in blocks. Slot j of N takes the point frac((j + 1/2) a / N), with a / N the
golden ratio rounded to a fraction (one of small terms whose a has no divisor in common
with N): these are the golden-ratio points moved to the N places of a grid, so each
place is met once.
Cumulative quotas map points to sources, so after all slots every source has its
quota exactly, and after any part of them its share to within a few blocks. Slots are
ranked per source; the slot of rank r takes block r modulo the number of blocks, in
pass r div that number. A source's taken words differ from its target by at most half
a block and a word for each block.

The map is turned round: a source's places are listed and each one's slot computed,
so no slot looks for its source. Ranks, shuffled positions and sums are two-level
(chunks of slots, buckets of documents), so no source, however hot, passes through
one task. The targets and quotas are windows over a row per source in one task.

A null text has size 0 and is never taken; a null source is a source of its own,
the last; repeated ids are documents of their own; all sizes 0 give targets 0; an
empty table gives an empty table. Extra columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeshore.llm.store import written

#: Fixed values of the contract: weights by a source's place, and the largest repeat.
WEIGHTS, MOST = (5, 2, 1), 3
#: Words of a block, and the least number of blocks of a source with as many words.
BLOCK, LEAST_BLOCKS = 32, 64
#: Slots ranked together, and buckets of a source's documents.
CHUNK = 1 << 14
BUCKETS = 1 << 10
GOLDEN = 0.6180339887498949
#: How far from it, in places, the step of the schedule may be.
NEAR = 64
SEED = 20240607


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(n, source, source_size, target, blocks, quota, first): one row per source. Targets share
    all words by weight; one at ``most`` times its source's size stays there and
    the rest share what it leaves: sources in order of cap per weight are capped
    until the common level fits. ``quota`` slots of the source are the places from
    ``first`` on."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("n") - 1) % len(weights) + 1)
    rows = sums.withColumn("n", F.row_number().over(by_name)).withColumn("w", w.cast("double"))
    rows = rows.withColumn("cap", F.col("source_size") * float(most))
    line = Window.orderBy(F.col("cap") / F.col("w"), "n")
    before, every = line.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.select(
        "*", F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("used"),
        F.sum("w").over(line.rowsBetween(0, Window.unboundedFollowing)).alias("weight_left"),
        F.sum("source_size").over(every).cast("double").alias("total"))
    rows = rows.withColumn("level", (F.col("total") - F.col("used")) / F.col("weight_left"))
    # the first source whose cap the level does not reach sets it for all that follow
    fits = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "n", "level")))
    rows = rows.withColumn("at", fits.over(every)["level"])
    rows = rows.withColumn("target", F.least("cap", F.coalesce(F.col("at") * F.col("w"), "cap")))
    least = F.least(F.col("source_size"), F.lit(LEAST_BLOCKS))
    rows = rows.withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / block), least).cast("long"))
    quota = F.round(F.col("target") * F.col("blocks") / F.nullif("source_size", F.lit(0)))
    rows = rows.withColumn("quota", F.least(F.coalesce(quota, F.lit(0)).cast("long"), most * F.col("blocks")))
    before = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("n", "source", "source_size", "target", "blocks", "quota",
                       F.coalesce(F.sum("quota").over(before), F.lit(0)).alias("first"))


def _running(df: DataFrame, group: list[str], part: str, order: list[str], value: Column,
             name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the rows of the group that come before,
    in order of (part, order); parts are summed first, so rows of a group need not
    meet in one task."""
    sums = df.groupBy(*group, part).agg(F.sum(value).alias("_part"))
    over = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, part, F.coalesce(F.sum("_part").over(over), F.lit(0)).alias("_base"))
    inner = (Window.partitionBy(*group, part).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, -1))
    return (df.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(sums, [*group, part]).withColumn(name, F.col("_base") + F.col("_in"))
            .drop("_base", "_in"))


def _product(x: str, y: str, div: str, rest: bool = False) -> Column:
    """x * y div (or modulo) ``div``, exact beyond 64 bits."""
    d = lambda c, p=19: f"cast({c} as decimal({p}, 0))"
    whole = f"({d(x, 18)} * {d(y, 18)})"
    return F.expr(f"cast({whole} % {d(div)} as bigint)" if rest else f"{whole} div {d(div)}")


def _step(n: int) -> tuple[int, int]:
    """(a, its inverse modulo n): of the numbers near n times the golden ratio, that
    without a common divisor whose continued fraction a / n has the smallest largest
    term, which is what spreads the points."""
    best = (n + 2, 1)
    for a in range(max(1, round(n * GOLDEN) - NEAR), round(n * GOLDEN) + NEAR):
        x, y, largest = n, a, 0
        while y:
            x, y, largest = y, x % y, max(largest, x // y)
        if x == 1:
            best = min(best, (largest, a))
    return best[1], pow(best[1], -1, n) if n > 1 else 0


def schedule(spark, table: DataFrame) -> DataFrame:
    """(slot, n, rank, block, pass): the mixture in order, a row per block taken.
    ``table`` is written (a row per source)."""
    total = int(table.agg(F.sum("quota")).first()[0] or 0)
    _, back = _step(max(total, 1))
    # a source's places in two steps, so that a hot one is dealt to many tasks
    parts = table.where("quota > 0").select(
        "n", "blocks", "first", "quota",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(quota - 1) div {CHUNK}"))).alias("part"))
    parts = parts.repartition("n", "part")
    inside = F.sequence(F.col("part") * CHUNK, F.least((F.col("part") + 1) * CHUNK, F.col("quota")) - 1)
    places = (parts.select("n", "blocks", "first", F.explode(inside).alias("i"))
              .select("n", "blocks", (F.col("first") + F.col("i")).alias("place")))
    # the point of slot j is place j * a mod N, so the slot of a place is place / a mod N
    slots = places.select("n", "blocks", _product("place", str(back), str(max(total, 1)), rest=True).alias("slot"))
    # written: planned sizes of exploded rows are those of the sources, far too small
    slots = written(slots.withColumn("chunk", F.expr(f"slot div {CHUNK}")), "slots")
    ranked = _running(slots, ["n"], "chunk", ["slot"], F.lit(1), "rank")
    return ranked.select("slot", "n", "rank", (F.col("rank") % F.col("blocks")).alias("block"),
                         F.expr("rank div blocks").alias("pass"))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        carry: Column | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix
    takes, repeats counted), and ``rest``, the ``carry`` column."""
    spark = docs.sparkSession
    sized = docs.select(F.monotonically_increasing_id().alias("rid"),
                        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{source_col}`").alias("source"),
                        word_count(F.col(f"`{text_col}`")).alias("size"),
                        # equal rows are told apart by nothing, and need not be
                        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h"),
                        (carry if carry is not None else F.lit(0)).alias("rest"))
    sized = written(sized, "sized")
    rows = sized.drop("rest")
    table = written(targets(rows, weights, most, block), "targets")
    slots = schedule(spark, table)
    uses = slots.groupBy("n", "block").agg(F.count("*").alias("times"))
    places = table.select("n", F.col("source").alias("s"), "source_size", "target", "blocks")
    line = (rows.join(places, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
            .withColumn("bucket", F.pmod("h", F.lit(BUCKETS))))
    line = written(_running(line, ["n"], "bucket", ["h", "doc_id", "rid"], F.col("size"), "at"), "line")
    # block b of a line of S words in B blocks holds its words from b * S div B on
    line = line.withColumn("upto", F.col("at") + F.col("size"))
    first = _product("at + 1", "blocks", "source_size")
    first = first - F.expr("if(cast(at + 1 as decimal(18, 0)) * blocks % source_size = 0, 1, 0)")
    last = _product("upto", "blocks", "source_size")
    last = last - F.expr("if(cast(upto as decimal(18, 0)) * blocks % source_size = 0, 1, 0)")
    cuts = (line.where("size > 0").select("rid", "n", "at", "upto", "blocks", "source_size",
                                          F.explode(F.sequence(first, last)).alias("block"))
            .select("rid", "n", "block",
                    (F.least("upto", _product("block + 1", "source_size", "blocks"))
                     - F.greatest("at", _product("block", "source_size", "blocks"))).alias("words")))
    taken = (cuts.join(uses, ["n", "block"]).groupBy("rid")
             .agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    out = line.select("rid", "doc_id", "size", "source_size", "target").join(taken, "rid", "left")
    if carry is not None:  # whole rows meet their numbers only at the end
        out = out.join(sized.select("rid", "rest"), "rid")
    else:
        out = out.withColumn("rest", F.lit(0))
    return out.select("doc_id", "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "rest")


def op9_source_mix(spark, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("rest")
