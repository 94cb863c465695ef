"""Line dedup by distinct-site spread: lines that stand on many sites are boilerplate and go.

A line's spread is the number of distinct sites it stands on. Spread is first estimated: one HyperLogLog sketch
of the sites per line hash, built in every task and merged by the aggregation, so a line on a third of all rows
costs each task one sketch. Lines whose estimate is near the threshold get an exact distinct count; farther
away the estimate decides. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.session import few_files, measured_write, write_through

MIN_SITES = 10
LG_K = 11
NEAR = 0.15
_SALTS = 16
_BLANKS = " \t\x0b\x0c\r"


def lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """Distinct non-blank lines of each document: ``id, site, line`` (hash of the line without outer blanks)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = F.array_distinct(F.transform(F.split(text, "\n"), lambda x: _line_key(x)))
    return docs.select(F.col(id_col).alias("id"), F.col(site_col).alias("site"), F.explode(keys).alias("line")).where(F.col("line").isNotNull())


def _line_key(line):
    """Hash of a line without its outer blanks; null for a blank line."""
    bare = F.trim(line, F.lit(_BLANKS))
    return F.when(F.length(bare) > 0, F.xxhash64(bare))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Lines on at least ``min_sites`` distinct sites: ``line`` (hash) and ``n_sites`` (exact or null where the estimate decided).

    Rows without a site count for no site. ``near`` must be several times the sketch's relative error,
    1.04 / sqrt(2**lg_k), which is 2.3 % by default; lines within it of the threshold are counted exactly.
    """
    placed = lines(docs, id_col, text_col, site_col).where(F.col("site").isNotNull()).select("line", F.col("site").cast("string").alias("site"))
    spread = placed.groupBy("line").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"))
    estimated = spread.select("line", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= min_sites * (1 - near))
    estimated, seen = measured_write(estimated, "line-spread", rows=F.count(F.lit(1)))
    close = estimated.where(F.col("estimate") <= min_sites * (1 + near)).select("line")
    # A close line stands on few sites by definition; its rows are cut to distinct (line, site) before the join.
    salted = close.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    again = placed.withColumn("_salt", F.pmod(F.xxhash64("site"), F.lit(_SALTS)).cast("int")).distinct()
    exact = again.join(salted, ["line", "_salt"], "left_semi").groupBy("line").agg(F.count(F.lit(1)).alias("n_sites"))
    sure = estimated.where(F.col("estimate") > min_sites * (1 + near)).select("line", F.lit(None).cast("long").alias("n_sites"))
    return few_files(exact.where(F.col("n_sites") >= min_sites).unionByName(sure), seen["rows"])


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """The documents without boilerplate lines, with ``n_removed`` (removed lines, repeats counted).

    Only a document whose non-blank lines are all boilerplate stays whole: it is a copy of a page, has no text of its own
    and is left to document-level dedup, so no document is emptied. Every other
    line, blank ones included, keeps its place. A document without boilerplate keeps its text byte for byte; null
    stays null. Rows, other columns and repeated rows are kept as they are; an existing ``n_removed`` is replaced.
    """
    names = docs.drop("n_removed").columns
    found = write_through(boilerplate(docs, min_sites, lg_k, near, id_col, text_col, site_col).select("line"), "boilerplate")
    salted = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    hits = lines(docs, id_col, text_col, site_col).select("id", "line").withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int"))
    hits = hits.join(salted, ["line", "_salt"], "left_semi").groupBy("id").agg(F.collect_set("line").alias("__site_drop"))
    joined = docs.drop("n_removed").join(hits.withColumnRenamed("id", "__site_id"), F.col(id_col).eqNullSafe(F.col("__site_id")), "left")
    parts = F.split(F.col(text_col), "\n")
    dropped = lambda x: F.coalesce(F.array_contains("__site_drop", _line_key(x)), F.lit(False))
    marked = F.transform(parts, lambda x: F.struct(x.alias("line"), dropped(x).alias("hit"), _line_key(x).isNull().alias("blank")))
    joined = joined.withColumn("__site_parts", F.when(F.col("__site_drop").isNotNull(), marked))
    own = F.exists("__site_parts", lambda x: ~x["hit"] & ~x["blank"])
    joined = joined.withColumn("__site_cut", F.col("__site_parts").isNotNull() & own)
    left = F.array_join(F.transform(F.filter("__site_parts", lambda x: ~x["hit"]), lambda x: x["line"]), "\n")
    removed = F.when(F.col("__site_cut"), F.size(F.filter("__site_parts", lambda x: x["hit"]))).otherwise(F.lit(0)).cast("long")
    return joined.select(*[F.when(F.col("__site_cut"), left).otherwise(F.col(text_col)).alias(text_col) if n == text_col else F.col(f"`{n}`") for n in names], removed.alias("n_removed"))
