"""Top rows per group, written so that one huge group does not end up in one task.

Spark turns ``row_number() <= k`` into a WindowGroupLimit that keeps k rows per group
*before* the shuffle, but only up to ``spark.sql.optimizer.windowGroupLimitThreshold``
(1000). Beyond that the rows are first ranked in salted sub-groups, in two levels: 4,096 tasks share a group,
and no later task reads more than 64 times n rows of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_GROUP_LIMIT = 1000
_SALTS = (4096, 64)


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None, salt_on: list[str] | None = None
) -> DataFrame:
    """The first ``n`` rows of each group; ``order`` has to break every tie.

    ``salt_on`` names columns that spread the rows of a group; it is needed for large ``n``.
    """
    rank_column = rank or "_rank"
    if n > _GROUP_LIMIT:
        if not salt_on:
            raise ValueError("a large n needs salt_on")
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(_SALTS[0])))
        for salts in _SALTS:
            inner = Window.partitionBy(*keys, F.col("_salt") % salts).orderBy(*order)
            df = df.withColumn("_inner", F.row_number().over(inner)).where(F.col("_inner") <= n)
        df = df.drop("_salt", "_inner")
    ranked = df.withColumn(rank_column, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    top = ranked.where(F.col(rank_column) <= n)
    return top if rank else top.drop(rank_column)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``."""
    return top_per_group(df, keys, order, 1)
