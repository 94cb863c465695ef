"""Mixing sources to target weights: hash-random keys, prefix sums inside each source, a cut at the exact budget.

Columns and DataFrame functions only. Every source gets a target number of words; its documents are taken in
the order of a hash-random key, whole passes (epochs) first and then the part of a pass that is left. The
document at the cut gives only the words that are still missing, so a source's total is its budget exactly.

The key range of a source is cut into equal stretches of about ``rows_per_stretch`` rows. A stretch knows the
words before it from the sums of the stretches before, so no source, however large, is sorted in one task.
Only (id, source, size, key) is shuffled, never a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from qaspark.session import write_through

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words in ``text``; null and blank texts have none."""
    pieces = F.size(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"))
    blank_left = F.coalesce(text, F.lit("")).rlike("^[\\x20\\x09-\\x0D]")
    blank_right = F.coalesce(text, F.lit("")).rlike("[\\x20\\x09-\\x0D]\\z")
    return F.when(F.length(F.coalesce(text, F.lit(""))) == 0, F.lit(0)).otherwise(
        F.greatest(pieces - blank_left.cast("int") - blank_right.cast("int"), F.lit(0))
    ).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` times all words.
    No target passes ``most`` times its source; what is too much goes to the others by weight until none is
    above. Written as one level L for all: target = least(most * size, weight * L), where L follows from the
    sources in the order of the level at which they fill up. One row per source passes through a window here.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    size = F.col("source_size").cast("double")
    rows = sources.withColumn("_w", weight).withColumn("_cap", size * most).withColumn("_full", F.col("_cap") / F.col("_w"))
    filled = Window.orderBy("_full", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything).cast("double") * share - F.coalesce(F.sum("_cap").over(filled), F.lit(0.0))
    open_weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(filled), F.lit(0.0))
    # The level if exactly the sources before this one were full. It is never above the true level, and equal for one.
    rows = rows.withColumn("_level", left / open_weight)
    level = F.max("_level").over(everything)
    rows = rows.withColumn("target", F.coalesce(F.least(F.col("_cap"), F.col("_w") * level), F.col("_cap")))
    return rows.drop("_w", "_cap", "_full", "_level")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    rows_per_stretch: int = 5_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns one row per input row: ``doc_id, source, size, source_size, target, budget, taken``; ``budget`` is the
    target rounded to whole words, and the ``taken`` of a source add up to it. Null text: size 0, nothing taken.
    Null source: a source of its own. Repeated rows count each and follow one another. Null ids are one more key.
    An empty table gives an empty result. Other columns are left out.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("_key"),
    )
    sized = write_through(sized, "sizes")  # texts are read and counted once; four small columns go on
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    sources = targets(sources, weights, share, most).withColumn("budget", F.round("target").cast("long"))
    sources = sources.withColumn("_stretches", F.ceil(F.col("_rows") / rows_per_stretch).cast("double")).withColumnRenamed("source", "_source")
    position = F.conv(F.substring("_key", 1, 7), 16, 10).cast("double") / float(16**7)
    placed = sized.join(sources, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "_stretch", F.floor(position * F.col("_stretches")).cast("int")
    )
    sums = placed.groupBy(F.col("_source").alias("_s"), F.col("_stretch").alias("_t")).agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("_s").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    placed = placed.join(sums, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_stretch") == F.col("_t")), "left")
    inside = Window.partitionBy("_source", "_stretch").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("budget") - passes * F.col("source_size") - start
    taken = F.col("size") * passes + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", "budget", taken.alias("taken"))
