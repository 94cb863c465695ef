"""Truncated SVD of the TF-IDF rows and unit-length document vectors.

Documents are rows of (term position, weight) lists. One pass over them multiplies the
Gram matrix of the terms with a thin block of vectors: every task adds up its part, Spark
sums the parts. What reaches the driver is a model of at most
``max_features x block`` numbers per language, never document data. All languages go
through each pass together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaspark.session import Scratch, write_through

_MOST_BLOCKS = 16
_OVERSAMPLE = 10
_ROWS = 256
_TERMS = 256
_MODEL_BYTES = 256 << 20


def term_positions(vocab: DataFrame) -> DataFrame:
    """Number the terms of each language from 0; the vocabulary is bounded by max_features."""
    order = Window.partitionBy("language").orderBy("term")
    return vocab.select("language", "term", (F.row_number().over(order) - 1).alias("position"))


def sparse_rows(weights: DataFrame, positions: DataFrame) -> DataFrame:
    """``(language, doc_id, positions, values)`` with the positions in order."""
    pairs = F.sort_array(F.collect_list(F.struct("position", "weight")))
    rows = weights.join(positions, ["language", "term"]).groupBy("language", "doc_id").agg(pairs.alias("_p"))
    return rows.select(
        "language",
        "doc_id",
        F.col("_p.position").alias("positions"),
        F.col("_p.weight").alias("values"),
    )


def _dense(positions: pd.Series, values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The terms that a few rows have, and the rows as a matrix over these."""
    row = np.repeat(np.arange(len(positions)), positions.str.len().to_numpy())
    used, column = np.unique(np.concatenate(positions.to_numpy()).astype(np.int64), return_inverse=True)
    cells = np.bincount(row * len(used) + column, np.concatenate(values.to_numpy()), len(positions) * len(used))
    return used, cells.reshape(len(positions), len(used))


def _packed(rows: DataFrame) -> DataFrame:
    """The rows in packs of up to ``_ROWS`` of one language: bytes that numpy takes as they are, the columns of a pack being the terms it has."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            language = batch.column(0).dictionary_encode()
            codes = language.indices.to_numpy(zero_copy_only=False)
            for code, name in enumerate(language.dictionary.to_pylist()):
                mine = np.flatnonzero(codes == code)
                for at in range(0, len(mine), _ROWS):
                    some = batch.take(pa.array(mine[at : at + _ROWS]))
                    counts = pc.list_value_length(some.column(1)).to_numpy().astype("<i4")
                    used, columns = np.unique(some.column(1).flatten().to_numpy(), return_inverse=True)
                    values = some.column(2).flatten().to_numpy().astype("<f8")
                    parts = [[name], *([x.tobytes()] for x in (counts, used.astype("<i4"), columns.astype("<i4"), values))]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(parts, [pa.string(), *[pa.binary()] * 4])], names=["language", "counts", "used", "columns", "values"])

    return rows.select("language", "positions", "values").mapInArrow(pack, "language string, counts binary, used binary, columns binary, values binary")


def _added(total: np.ndarray, model: np.ndarray, room: np.ndarray, counts: pa.Scalar, used: pa.Scalar, columns: pa.Scalar, values: pa.Scalar) -> np.ndarray:
    """Add ``X'X M`` of a pack's rows to ``total``. ``room`` is all zeros before and after; a larger one is returned if the rows need it."""
    counts, used, columns, values = (np.frombuffer(x.as_buffer(), kind) for x, kind in ((counts, "<i4"), (used, "<i4"), (columns, "<i4"), (values, "<f8")))
    if len(room) < len(counts) * len(used):
        room = np.zeros(len(counts) * len(used))
    cells = np.repeat(np.arange(len(counts)) * len(used), counts) + columns
    np.add.at(room, cells, values)
    dense = room[: len(counts) * len(used)].reshape(len(counts), len(used))
    total[used] += dense.T @ (dense @ model[used])
    room[cells] = 0.0
    return room


def _gram_times(packs: DataFrame, models: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """``X'X M`` of every language: one pass for all whose models fit a broadcast together."""
    groups: list[dict[str, np.ndarray]] = []
    for language, model in models.items():
        if not groups or sum(m.nbytes for m in groups[-1].values()) + model.nbytes > _MODEL_BYTES:
            groups.append({})
        groups[-1][language] = model
    result = {}
    for group in groups:
        mine = packs if len(groups) == 1 else packs.where(F.col("language").isin(list(group)))
        result.update(_gram_pass(mine, group))
    return result


def _gram_pass(packs: DataFrame, models: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One task per core, however many packs there are: each sends its sums once, so what travels does not grow with the rows."""
    context = packs.sparkSession.sparkContext
    shared = context.broadcast(models)
    fields = "language string, at int, z binary"
    names = ["language", "at", "z"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        room = np.zeros(0)
        for batch in batches:
            for language, *pack in zip(batch.column(0).to_pylist(), *(batch.column(i) for i in range(1, 5))):
                model = shared.value.get(language)
                if model is not None:
                    if language not in sums:
                        sums[language] = np.zeros(model.shape)
                    room = _added(sums[language], model, room, *pack)
        for language, total in sums.items():
            pieces = [(at, total[at : at + _TERMS]) for at in range(0, len(total), _TERMS)]
            pieces = [(at, z.tobytes()) for at, z in pieces if z.any()]
            if pieces:
                at, z = zip(*pieces)
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(at)), pa.array(at, pa.int32()), pa.array(z, pa.binary())], names=names)

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(z.as_buffer()) for z in table.column("z"))
        return pa.table([table.column("language").slice(0, 1), table.column("at").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=names)

    parts = packs.coalesce(context.defaultParallelism).mapInArrow(partial, fields)
    result = {k: np.zeros(m.shape) for k, m in models.items()}
    for language, at, z in parts.groupBy("language", "at").applyInArrow(add, fields).collect():  # the model: terms x block
        total = np.frombuffer(z).reshape(-1, models[language].shape[1])
        result[language][at : at + len(total)] = total
    shared.unpersist()
    return result


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``block`` that ``basis`` does not span yet."""
    scale = np.linalg.norm(block) or 1.0
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    left = left[:, size > 1e-10 * scale]
    left = left - basis @ (basis.T @ left)
    return np.linalg.qr(left)[0] if left.shape[1] else left


def truncated_svd(
    rows: DataFrame, n_terms: dict[str, int], k: int = 50, tolerance: float = 1e-9, seed: int = 42
) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """``{language: (singular values, term directions)}`` of the rows, without centring.

    A block Krylov space grows by one block per pass until the singular values stand still or the rows hold
    nothing more. A space of more than ``_MOST_BLOCKS`` blocks is restarted from its best directions, so what the driver
    holds stays proportional to the model. ``n_terms`` gives the size of each vocabulary.
    """
    with Scratch(rows.sparkSession) as scratch:
        return _krylov(scratch.write(_packed(rows), "packs")[0], n_terms, k, tolerance, seed)


def _krylov(packs: DataFrame, n_terms: dict[str, int], k: int, tolerance: float, seed: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    random = np.random.default_rng(seed)
    basis: dict[str, np.ndarray] = {}
    inner: dict[str, np.ndarray] = {}  # basis' X'X basis, grown by what each pass adds
    values: dict[str, np.ndarray] = {}
    result: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    block = {
        lang: np.linalg.qr(random.standard_normal((n, min(n, k + _OVERSAMPLE))))[0] for lang, n in n_terms.items() if n > 0
    }
    while block:
        product = _gram_times(packs, block)
        following = {}
        for lang, z in product.items():
            basis[lang] = np.hstack([basis[lang], block[lang]]) if lang in basis else block[lang]
            side = basis[lang].T @ z
            known = len(side) - z.shape[1]
            side[known:] = (side[known:] + side[known:].T) / 2
            inner[lang] = np.block([[inner[lang], side[:known]], [side[:known].T, side[known:]]]) if known else side
            found = np.sqrt(np.maximum(np.linalg.eigvalsh(inner[lang])[::-1][:k], 0.0))
            steady = lang in values and len(values[lang]) == len(found) and np.all(
                np.abs(values[lang] - found) <= tolerance * max(found[0], 1e-300)
            )
            values[lang] = found
            fresh = _new_directions(z, basis[lang])
            if not steady and fresh.shape[1]:
                following[lang] = fresh
                if basis[lang].shape[1] >= _MOST_BLOCKS * (k + _OVERSAMPLE):
                    square, vectors = np.linalg.eigh(inner[lang])
                    best = np.argsort(square)[::-1][: k + _OVERSAMPLE]
                    basis[lang], inner[lang] = basis[lang] @ vectors[:, best], np.diag(square[best])
            else:
                square, vectors = np.linalg.eigh(inner.pop(lang))
                directions = basis.pop(lang) @ vectors[:, np.argsort(square)[::-1][:k]]
                sign = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])])
                result[lang] = found, directions * np.where(sign == 0, 1.0, sign)
        block = following
    return result


def document_vectors(rows: DataFrame, svd: dict[str, tuple[np.ndarray, np.ndarray]], k: int = 50) -> DataFrame:
    """``(language, doc_id, vector)``: scores along the term directions, unit length."""
    shared = rows.sparkSession.sparkContext.broadcast({lang: directions for lang, (_, directions) in svd.items()})

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, part in batch.groupby("language", sort=False):
                model = shared.value[language]
                for at in range(0, len(part), _ROWS):
                    piece = part.iloc[at : at + _ROWS]
                    used, dense = _dense(piece["positions"], piece["values"])
                    scores = dense @ model[used]
                    padded = np.zeros((len(piece), k))
                    padded[:, : scores.shape[1]] = scores
                    yield pd.DataFrame({"language": language, "doc_id": piece["doc_id"].to_numpy(), "vector": list(padded)})

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInPandas(score, f"language string, doc_id {kind}, vector array<double>")
    return scored.withColumn("vector", l2_normalize("vector"))


def l2_normalize(column):
    """Vector of unit length; a zero vector stays as it is."""
    column = F.col(column) if isinstance(column, str) else column
    scaled = lambda square: F.transform(column, lambda x: F.when(square > 0, x.cast("double") / F.sqrt(square)).otherwise(x.cast("double")))
    return F.aggregate(column, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"), scaled)


def vectorize(docs: DataFrame, vocab: DataFrame, weights: DataFrame, k: int = 50) -> DataFrame:
    """Unit vectors of all documents; those without a known term get the zero vector."""
    positions = write_through(term_positions(vocab), "positions")
    rows = write_through(sparse_rows(weights, positions), "rows")
    sizes = {r["language"]: r["n"] for r in vocab.groupBy("language").agg(F.count(F.lit(1)).alias("n")).collect()}
    vectors = document_vectors(rows, truncated_svd(rows, sizes, k), k)
    zero = F.array_repeat(F.lit(0.0), k)
    return docs.select("language", "doc_id").join(vectors, ["language", "doc_id"], "left").select(
        "language", "doc_id", F.coalesce("vector", zero).alias("vector")
    )


def svd_energy(weights: DataFrame, vocab: DataFrame, k: int = 50) -> DataFrame:
    """Singular values per language, with the share of the squared total they explain."""
    positions = write_through(term_positions(vocab), "positions")
    rows = write_through(sparse_rows(weights, positions), "rows")
    sizes = {r["language"]: r["n"] for r in vocab.groupBy("language").agg(F.count(F.lit(1)).alias("n")).collect()}
    svd = truncated_svd(rows, sizes, k)
    found = [(lang, i + 1, float(v)) for lang, (s, _) in svd.items() for i, v in enumerate(s)]  # k per language
    values = weights.sparkSession.createDataFrame(found, "language string, component int, singular_value double")
    total = weights.groupBy("language").agg(F.sum(F.col("weight") * F.col("weight")).alias("_total"))
    energy = F.col("singular_value") * F.col("singular_value") / F.col("_total")
    return values.join(total, "language").select("language", "component", "singular_value", energy.alias("energy"))
