"""Vectors in blocks, queries in groups: the frame in which both exact and approximate searches run.

All rows of one length are dealt by hash to blocks of about ``rows_per_block`` vectors; each block becomes one row that holds its
own index. A stated set of queries, in groups, meets one block first: the k-th score found there is a floor for
every other block. A meeting is one row and one task step, and returns at most k rows per query. The best k per query are then
taken over all blocks. An index travels once, to the task of its block; the groups come to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from qaspark.session import write_through

ROWS_PER_BLOCK = 8192
QUERIES_PER_GROUP = 512


def clean_vectors(df: DataFrame, id_col: str, vector_col: str, allow_zero: bool) -> DataFrame:
    """``id, vector`` (array<double>), one row per id, of the vectors that can take part.

    Left out: null ids, null or empty vectors, vectors with a null or non-finite component, and zero vectors unless
    allowed. An id that is repeated counts once, with its smallest vector in array order.
    """
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    if not allow_zero:
        fine = fine & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).where(F.col("id").isNotNull() & (F.size("vector") > 0)).where(fine)
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    values = np.asarray(column.flatten(), dtype=np.float64)
    return values.reshape(len(column), -1)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    build: Callable[[np.ndarray, np.ndarray], bytes],
    find: Callable[[bytes, np.ndarray, np.ndarray, int, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
    rows_per_block: int = ROWS_PER_BLOCK,
    queries_per_group: int = QUERIES_PER_GROUP,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all rows of its length but the query itself, ties to the smaller id.

    ``build`` makes a block's index from (ids, matrix); ``find`` returns (number of the query, id, score) of the best
    k in one block for (index, query ids, query matrix, k, floors). A floor is the k-th score of another block, or minus infinity: what
    is below it need not be returned.
    """
    vectors = write_through(vectors.select("id", "vector", F.size("vector").alias("width"), is_query.alias("asks")), "vectors")
    # One row per length of a vector.
    widths = vectors.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).where(F.col("q") > 0).orderBy("width").collect()
    if not widths:
        return vectors.sparkSession.createDataFrame([], f"query_id long, rank int, vec_id long, score {score_type}")
    n_blocks = {r["width"]: -(-r["n"] // rows_per_block) for r in widths}
    n_groups = {r["width"]: -(-r["q"] // queries_per_group) for r in widths}

    def numbered(counts: dict[int, int]) -> Column:
        """The block of a row among those of its length, all lengths' blocks in one row of numbers."""
        first = dict(zip(counts, np.cumsum([0, *counts.values()]).tolist()))
        entry = lambda d: F.element_at(F.create_map(*[F.lit(x) for pair in d.items() for x in pair]), F.col("width"))
        return (entry(first) + F.pmod(F.xxhash64("id"), entry(counts))).cast("int")

    def index(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        blob = build(ids[order], _matrix(table, "vector")[order])
        head = table.select(["width", "block"]).slice(0, 1).cast(pa.schema([("width", pa.int32()), ("block", pa.int32())]))
        return head.append_column("index", pa.array([blob], pa.binary()))

    def group(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        floors = table.column("floor").to_numpy().astype(np.float64)[order]
        head = table.select(["width", "grp"]).slice(0, 1).cast(pa.schema([("width", pa.int32()), ("grp", pa.int32())]))
        for name, part in (("ids", ids[order]), ("queries", _matrix(table, "vector")[order]), ("floors", floors)):
            head = head.append_column(name, pa.array([part.tobytes()], pa.binary()))
        return head

    known = [r["width"] for r in widths]
    total = sum(n_blocks.values())
    data = vectors.where(F.col("width").isin(known)).select("id", "vector", "width", numbered(n_blocks).alias("block"))
    data = write_through(data.repartition(total, "block").groupBy("width", "block").applyInArrow(index, "width int, block int, index binary"), "index")
    asking = vectors.where("asks").select("id", "vector", "width", numbered(n_groups).alias("grp"))
    blocks = data.select("width", "block")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, queries, floors, blob in zip(*(batch.column(i) for i in range(4))):
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                matrix = np.frombuffer(queries.as_buffer(), np.float64).reshape(len(ids), -1)
                who, found, score = find(blob.as_buffer(), ids, matrix, k, np.frombuffer(floors.as_buffer(), np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

    def meetings(queries: DataFrame, first: bool) -> DataFrame:
        """Groups next to blocks of their length: a first block each, or all others."""
        groups = queries.groupBy("width", "grp").applyInArrow(group, "width int, grp int, ids binary, queries binary, floors binary")
        own = F.pmod("grp", F.element_at(F.create_map(*[F.lit(x) for pair in n_blocks.items() for x in pair]), F.col("width")))
        start = F.element_at(F.create_map(*[F.lit(x) for pair in zip(n_blocks, np.cumsum([0, *n_blocks.values()]).tolist()) for x in pair]), F.col("width"))
        mine = F.col("block") == (start + own)
        pairs = groups.select("width", "grp").join(F.broadcast(blocks), "width").where(mine if first else ~mine)  # two numbers per block
        met = pairs.join(groups, ["width", "grp"]).select("block", "ids", "queries", "floors")
        return met.repartition(total, "block").join(data.drop("width").repartition(total, "block"), "block").select("ids", "queries", "floors", "index")

    fields = f"query_id long, vec_id long, score {score_type}"
    begun = write_through(meetings(asking.withColumn("floor", F.lit(float("-inf"))), True).mapInArrow(meet, fields), "begun")
    if total == len(n_blocks):
        found = begun
    else:
        floors = begun.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) == k, F.min("score")).cast("double").alias("floor"))
        floored = asking.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        found = begun.unionByName(meetings(floored, False).mapInArrow(meet, fields))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def dump(**arrays: np.ndarray) -> bytes:
    """Arrays as one Arrow stream, read back without a copy."""
    table = {k: pa.array([v.tobytes()], pa.large_binary()) for k, v in arrays.items()}
    batch = pa.record_batch(table)
    batch = batch.replace_schema_metadata({k: f"{v.dtype.str} {' '.join(map(str, v.shape))}" for k, v in arrays.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def load(blob) -> dict[str, np.ndarray]:
    batch = next(iter(pa.ipc.open_stream(blob)))
    out = {}
    for name, column in zip(batch.schema.names, batch.columns):
        kind, *shape = batch.schema.metadata[name.encode()].decode().split()
        out[name] = np.frombuffer(column[0].as_buffer(), kind).reshape([int(x) for x in shape])
    return out
