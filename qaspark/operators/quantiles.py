"""Exact quantiles per group in two reads of the input, without holding a group in memory.

``median`` and ``percentile`` keep all distinct values of a group in one task. Here the pass that makes counts and means also makes a mergeable
KLL sketch per group, which brackets every wanted rank within its error. The second pass counts what lies below
each bracket and keeps only the values inside it, counted per value inside tasks; the ranks are then read off exactly. The
result is checked: a rank that lies outside its bracket (rarer than one in 10^5, the brackets are twice as wide as the stated error)
widens the brackets, and one with very many values inside narrows them, by one more read each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaspark.session import broadcast_if_small, measured_write

SKETCH_K = 2048
# The sketch's rank error at this size is below 0.0015 with a certainty of 99 %.
SLACK = 0.003
FEW = 512
#: Brackets that hold more rows than this are narrowed before their values are counted one by one.
MOST_INSIDE = 20_000_000
_GRID = 1000

Wanted = dict[str, tuple[str, float]]


def _number(column: str) -> Column:
    """The column as a number that can be ranked, or null."""
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def sketched(df: DataFrame, keys: list[str], columns: list[str], aggregates: list[Column]) -> tuple[DataFrame, int]:
    """The first pass: one stored row per group with ``aggregates`` and, per column, count, ends and sketch; and the number of rows."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    seen = []
    for i, c in enumerate(columns):
        v = _number(c)
        seen += [F.count(v).alias(f"_n{i}"), F.min(v).alias(f"_lo{i}"), F.max(v).alias(f"_hi{i}"), F.kll_sketch_agg_double(v, SKETCH_K).alias(f"_s{i}")]
    table, measured = measured_write(df.groupBy(*keys).agg(*aggregates, *seen), "sketched", rows=F.count(F.lit(1)))
    return table, measured["rows"]


def rank_bracket(i: int, p: float, slack: float = SLACK) -> tuple[Column, Column]:
    """Two values of column ``i`` between which the ranks next to the fraction ``p`` lie, as far as the sketch can tell.

    In groups of up to ``FEW`` rows a rank may be farther from its fraction than the slack; there the bracket is everything.
    """
    n = F.col(f"_n{i}")

    def at(fraction: float, end: str) -> Column:
        if not 0 < fraction < 1:
            return F.col(f"_{end}{i}")
        return F.when(n > FEW, F.kll_sketch_get_quantile_double(F.col(f"_s{i}"), F.lit(fraction))).otherwise(F.col(f"_{end}{i}"))

    return at(p - slack, "lo"), at(p + slack, "hi")


def counted(df: DataFrame, keys: list[str], columns: list[str], brackets: DataFrame, groups: int, names: list[tuple[str, int]]) -> DataFrame:
    """``(keys…, q, side, v, rows, least, most)`` by one read of ``df``.

    ``brackets(keys…, b)`` holds an array of (lo, hi) in the order of ``names`` = (name, column). Side -1 is everything below a bracket, 1 everything
    above (``v`` null), 0 one value inside. Null and NaN are left out.
    """
    small = broadcast_if_small(brackets, groups * len(names))
    numbers = df.select(*keys, *[_number(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(q).alias("q"), F.col(f"_v{i}").alias("v"), F.col("b")[q]["lo"].alias("lo"), F.col("b")[q]["hi"].alias("hi")) for q, (_, i) in enumerate(names)]
    long = numbers.join(small, keys).select(*keys, F.explode(F.array(*cells)).alias("_c")).select(*keys, "_c.*").where(F.col("v").isNotNull())
    side = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), 1).otherwise(0).alias("side")
    inside = F.when(F.col("side") == 0, F.col("v")).alias("x")
    placed = long.select(*keys, "q", "v", side).select(*keys, "q", "side", "v", inside)
    return placed.groupBy(*keys, "q", "side", "x").agg(F.count(F.lit(1)).alias("rows"), F.min("v").alias("least"), F.max("v").alias("most")).withColumnRenamed("x", "v")


def _bracketed(table: DataFrame, keys: list[str], ranges: list[tuple[Column, Column]]) -> DataFrame:
    return table.select(*keys, F.array(*[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in ranges]).alias("b"))


def _narrowed(df: DataFrame, keys: list[str], columns: list[str], table: DataFrame, groups: int, names: list[tuple[str, int]], fractions: list[float], brackets: DataFrame) -> DataFrame:
    """One more read: brackets with very many rows inside are narrowed by sketches of their inside."""
    small = broadcast_if_small(brackets, groups * len(names))
    numbers = df.select(*keys, *[_number(c).alias(f"_v{i}") for i, c in enumerate(columns)]).join(small, keys)
    parts = []
    for q, (_, i) in enumerate(names):
        v, lo, hi = F.col(f"_v{i}"), F.col("b")[q]["lo"], F.col("b")[q]["hi"]
        parts += [F.count_if(v < lo).alias(f"_below{q}"), F.count(F.when(v.between(lo, hi), v)).alias(f"_n{q}"), F.kll_sketch_agg_double(F.when(v.between(lo, hi), v), SKETCH_K).alias(f"_s{q}")]
    inside, _ = measured_write(numbers.groupBy(*keys).agg(*parts), "narrowed")
    total = table.select(*keys, *[F.col(f"_n{i}").alias(f"_all{i}") for i in range(len(columns))])
    joined = inside.join(total, keys).join(brackets, keys)
    ranges = []
    for q, ((_, i), p) in enumerate(zip(names, fractions)):
        old = F.col("b")[q]["lo"], F.col("b")[q]["hi"]
        at = (F.col(f"_all{i}") - 1) * F.lit(float(p)) - F.col(f"_below{q}")
        share = at / F.col(f"_n{q}")
        crowded = (F.col(f"_n{q}") > MOST_INSIDE) & (at >= 0) & (at <= F.col(f"_n{q}"))
        values = F.kll_sketch_get_quantile_double(F.col(f"_s{q}"), F.array(*[F.lit(g / _GRID) for g in range(_GRID + 1)]))
        low, high = F.floor((share - SLACK) * _GRID), F.ceil((share + SLACK) * _GRID)
        ranges.append((F.when(crowded & (low > 0), values[low.cast("int")]).otherwise(old[0]), F.when(crowded & (high < _GRID), values[high.cast("int")]).otherwise(old[1])))
    return _bracketed(joined, keys, ranges)


def ranked_values(table: DataFrame, df: DataFrame, keys: list[str], columns: list[str], groups: int, wanted: Wanted, extra: list[tuple[str, int, Column, Column]] = ()) -> tuple[DataFrame, DataFrame]:
    """``(quantiles, counted)``: one row per group with the exact ``wanted``, and the table of ``counted`` they come from.

    ``extra`` = (name, column, low, high) adds brackets of a caller's own, in terms of the sketched ``table``.
    """
    names = [(o, columns.index(c)) for o, (c, _) in wanted.items()] + [(name, i) for name, i, _, _ in extra]
    fractions = [float(p) for _, p in wanted.values()]
    most = table.agg(*[F.max(f"_n{i}") for i in range(len(columns))]).first()
    slack = SLACK
    while True:
        ranges = [rank_bracket(i, p, slack) for (_, i), p in zip(names, fractions)] + [(lo, hi) for _, _, lo, hi in extra]
        brackets, _ = measured_write(_bracketed(table, keys, ranges), "brackets")
        expected = 2 * slack * max((n or 0) for n in most)
        while expected > MOST_INSIDE and not extra:
            brackets = _narrowed(df, keys, columns, table, groups, names[: len(fractions)], fractions, brackets)
            expected *= 2 * SLACK
        found, _ = measured_write(counted(df, keys, columns, brackets, groups, names), "counted")
        quantiles = _read_off(found, table, keys, names, wanted)
        missing = [F.count_if((F.col(f"_n{columns.index(c)}") > 0) & F.col(o).isNull()) for o, (c, _) in wanted.items()]
        stored, lost = measured_write(quantiles, "quantiles", lost=sum(missing[1:], missing[0]))
        if not lost["lost"] or slack > 1:
            return stored.select(*keys, *wanted), found
        slack *= 8


def _read_off(found: DataFrame, table: DataFrame, keys: list[str], names: list[tuple[str, int]], wanted: Wanted) -> DataFrame:
    """The quantiles of ``table``'s groups out of the counted values; null where a bracket does not hold its rank."""
    inside = Window.partitionBy(*keys, "q").orderBy("v")
    running = found.where(F.col("side") <= 0).withColumn("_end", F.sum("rows").over(inside))  # nulls, that is all below, come first
    sizes = table.select(*keys, *[c for c in table.columns if c.startswith("_n")])
    joined = running.join(sizes, keys)
    outputs = []
    for q, ((o, i), (_, p)) in enumerate(zip(names, wanted.values())):
        at = F.col(f"_n{i}").cast("double") - 1
        rank = at * F.lit(float(p))

        def value(k: Column, q: int = q) -> Column:
            holds = (F.col("q") == q) & (F.col("side") == 0) & (F.col("_end") - F.col("rows") <= k) & (k < F.col("_end"))
            return F.max(F.when(holds, F.col("v")))

        low, high = value(F.floor(rank)), value(F.ceil(rank))
        fraction = F.max(F.when(F.col("q") == q, rank - F.floor(rank)))
        # The middle of two numbers is written as their mean, like the usual median.
        outputs.append(F.when(fraction == 0.5, (low + high) / 2).otherwise(low + (high - low) * fraction).alias(o))
    quantiles = joined.groupBy(*keys).agg(*outputs)
    return sizes.join(quantiles, keys, "left")


def aggregate_with_quantiles(df: DataFrame, keys: list[str], aggregates: list[Column], wanted: Wanted) -> DataFrame:
    """``aggregates`` and exact quantiles ``wanted = {output: (column, fraction)}`` per group, in two reads of ``df``.

    Linear interpolation between the two nearest ranks; nulls and NaN are left out, and a group without values has null quantiles.
    Rows with a null key belong to no group. Runs jobs when called.
    """
    columns = sorted({c for c, _ in wanted.values()})
    table, groups = sketched(df, keys, columns, aggregates)
    plain = [c for c in table.columns if c in keys or not any(c in (f"_n{i}", f"_lo{i}", f"_hi{i}", f"_s{i}") for i in range(len(columns)))]
    quantiles, _ = ranked_values(table, df, keys, columns, groups, wanted)
    return table.select(*plain).join(quantiles, keys)


def exact_quantiles(df: DataFrame, keys: list[str], wanted: Wanted) -> DataFrame:
    """One row per group with ``wanted = {output: (column, fraction)}``; groups without any value give no row."""
    full = aggregate_with_quantiles(df, keys, [F.lit(1).alias("_one")], wanted)
    return full.select(*keys, *wanted).where(F.coalesce(*[F.col(o) for o in wanted]).isNotNull())
