"""Mixing sources to target weights by capped water-filling.

Every source has a weight and holds at most ``epochs`` times its own size.
Sources that would get more than that are clamped, their excess goes to the
others in proportion to their weights, until none is above. The fixed point is
``min(cap, level * weight)`` with one water level, found from the sources in
order of ``cap / weight``. A source is then taken in whole repetitions and one
fractional repetition, whose rows are drawn in the order of a seeded hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SHARE = 1.0
SEED = 17
BUCKET_BITS = 12   # a fractional repetition is settled within one of so many buckets
HASH_BITS = 52


def n_words(text: Column) -> Column:
    """Number of words; 0 for null. Counts the places where a word begins."""
    blank = "[\\x20\\x09-\\x0D]+"
    return F.coalesce(F.size(F.filter(F.split(text, blank), lambda w: w != "")), F.lit(0)).cast("long")


def draw(key: Column, text: Column, seed: int) -> Column:
    """The seeded place of a row in its source's order, below 2**52: by its id,
    by its text if it has none."""
    none = F.concat(F.lit("null:"), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), none))
    return F.conv(F.substring(F.md5(drawn.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _place(id_col: str, text_col: str, seed: int) -> list[Column]:
    """``size`` and the place ``(h, size, tie)`` of a row; only rows equal in id
    and text have one place."""
    size = n_words(F.col(text_col))
    return [size.alias("size"), F.struct(draw(F.col(id_col), F.col(text_col), seed).alias("h"), size.alias("size"),
                                         F.xxhash64(F.col(text_col).cast("string")).alias("tie")).alias("at")]


def targets(sizes: DataFrame, weights=WEIGHTS, epochs: float = EPOCHS, share: float = SHARE) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources by code point, null last, weigh ``weights`` in turn. The windows run
    over the list of sources, one row each, not over documents.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)),
                     (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    one = sizes.select("source", "source_size", w.alias("w"))
    one = one.withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    # The level if this source and all after it stay below their caps.
    one = one.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                         / F.sum("w").over(rest))
    below = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    level = F.first(below, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding,
                                                                  Window.unboundedFollowing))
    return one.select("source", "source_size",
                      F.least("cap", F.coalesce(level * F.col("w"), F.col("cap"))).alias("target"))


def goals(docs: DataFrame, id_col: str, text_col: str, source_col: str, *, weights, epochs: float,
          share: float, seed: int) -> DataFrame:
    """One row per source: its target, its whole repetitions, the last place in
    its order that gets one copy more, and how many of the ``rows`` rows there
    get it (``some``; null: all)."""
    rows = saved(docs.select(F.col(source_col).cast("string").alias("source"), *_place(id_col, text_col, seed))
                 .withColumn("bucket", F.shiftright("at.h", HASH_BITS - BUCKET_BITS).cast("int")), "sizes")
    bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    goal = targets(bucket.groupBy("source").agg(F.sum("n").alias("source_size")), weights, epochs, share)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("whole", whole.cast("long"))
    goal = saved(goal.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")), "goals")
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket = saved(bucket.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
                   .join(goal.select(F.col("source").alias("s"), "part"), F.col("source").eqNullSafe(F.col("s")))
                   .drop("s"), "buckets")
    filled = (bucket.where("before + n <= part").groupBy(F.col("source").alias("s"))
              .agg(F.max("bucket").alias("filled")))
    cut = (bucket.where("before < part and part < before + n")
           .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "part"))
    own = Window.partitionBy("s").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    place = (rows.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
             .groupBy("s", "at", "size", "before", "part").agg(F.count("*").alias("rows"))
             .withColumn("before", F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("rows")).over(own), F.lit(0))))
    # The rows of a place whose middle the rest of the target covers.
    some = F.when(F.col("size") > 0, F.floor((F.col("part") - F.col("before")) / F.col("size") + 0.5)).when(
        F.col("before") <= F.col("part"), F.col("rows")).otherwise(0).cast("long")
    last = (place.withColumn("some", F.least("rows", some)).where("some > 0").groupBy("s")
            .agg(F.max(F.struct("at", "some", "rows")).alias("last")))
    end = F.shiftleft(F.coalesce(F.col("filled"), F.lit(-1)).cast("long") + 1, HASH_BITS - BUCKET_BITS) - 1
    most = F.struct(end.alias("h"), F.lit((1 << 62)).cast("long").alias("size"), F.lit(0).cast("long").alias("tie"))
    return (goal.join(filled, F.col("source").eqNullSafe(filled.s), "left").drop("s")
            .join(last, F.col("source").eqNullSafe(last.s), "left").drop("s")
            .select("source", "source_size", "target", "whole", F.greatest(most, F.coalesce("last.at", most)).alias("last"),
                    F.when(F.col("last.some") < F.col("last.rows"), F.col("last.some")).alias("some")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        weights=WEIGHTS, epochs: float = EPOCHS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the
    number of times that the mix takes the row (0 and more).

    With ``r = target / source_size`` every row is taken ``floor(r)`` times. The
    rest of the target is filled with one more copy of the rows that come first
    in the seeded order of their ids, as long as a copy brings the sum nearer to
    it, so a source misses its target by half a document at most. Of rows equal
    in id and text, which have one place in the order, as many get the copy as
    fit. Rows without words get no such copy. A null source is a source of its
    own; rows without an id are ordered by their texts; an empty table stays
    empty; columns named like an added one are replaced.

    The order is settled in two steps. Sizes per source and bucket of the hash
    (at most 4,096 a source) say which buckets are taken whole; only rows of the
    one bucket that the target cuts are ordered. A source that holds a third of
    all rows is thus never sorted as a whole. Equal rows at the last place are
    numbered within the parts of a table that holds only them. The outcome is one row per source,
    read back from a table, so that Spark broadcasts it if it is small enough.
    """
    added = ["size", "source_size", "target", "copies"]
    keep = [c for c in docs.columns if c not in added]
    goal = saved(goals(docs, id_col, text_col, source_col, weights=weights, epochs=epochs, share=share,
                       seed=seed), "mix").withColumnRenamed("source", "_s")
    rows = docs.select(*keep, *_place(id_col, text_col, seed), F.col(source_col).cast("string").alias("_source"))
    rows = rows.join(goal, F.col("_source").eqNullSafe(F.col("_s")))
    out = lambda one: [*keep, "size", "source_size", "target", (F.col("whole") + one.cast("long")).alias("copies")]
    split = F.coalesce((F.col("at") == F.col("last")) & F.col("some").isNotNull() & (F.col("size") > 0), F.lit(False))
    whole = rows.where(~split).select(*out((F.col("at") <= F.col("last")) & (F.col("size") > 0)))
    if goal.where("some is not null").isEmpty():
        return whole
    tied = saved(rows.where(split).withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}),
                 "tied")
    ahead = Window.partitionBy("_s").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    part = (tied.groupBy("_s", "_part").agg(F.count("*").alias("n"))
            .select(F.col("_s").alias("_t"), F.col("_part").alias("_p"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_ahead")))
    tied = tied.join(part, F.col("_s").eqNullSafe(F.col("_t")) & (F.col("_part") == F.col("_p")))
    number = F.col("_ahead") + F.row_number().over(Window.partitionBy("_s", "_part").orderBy("_row"))
    return whole.union(tied.withColumn("_number", number).select(*out(F.col("_number") <= F.col("some"))))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken."""
    return (mixed.where("copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .drop("_copy", "copies", "size", "source_size", "target"))
