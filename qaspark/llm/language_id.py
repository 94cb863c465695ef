"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language inside tasks; the model is one row of 2**bits log probabilities per
language, broadcast as scaled integers, so sums are the same however texts are
batched. Prediction scores whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.llm.components import sized
from qaspark.llm.memory import slices
from qaspark.operators.ranking import top_per_group
from qaspark.session import measured_write

ORDERS = (1, 2, 3)
BITS = 15
BLOCK_CHARS = 1 << 20
MOST_MODEL_BYTES = 256 << 20
_SCALE = 1 << 16
_END = "\x00"
#: A language with fewer labelled rows has no bound for its fit: so low a quantile cannot be told from them.
LEAST_ROWS = 100
LOW_QUANTILE = 0.01
#: The bound lies so many times as far below the median of the fits as the low quantile does.
FIT_WIDTH = 4
_LETTER = np.array([chr(i).isalpha() for i in range(0x3000)])


def _letters(codes: np.ndarray) -> np.ndarray:
    """Which code points count as letters; everything from 0x3000 on is taken as a letter but for private use and symbols."""
    low = codes < len(_LETTER)
    out = np.zeros(len(codes), dtype=bool)
    out[low] = _LETTER[codes[low]]
    high = np.flatnonzero(~low)
    if len(high):
        distinct, inverse = np.unique(codes[high], return_inverse=True)
        out[high] = np.array([chr(c).isalpha() for c in distinct])[inverse]
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _buckets(codes: np.ndarray, letter: np.ndarray, text_of: np.ndarray, new: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every n-gram of normalised ``codes`` that holds a letter and ends at place ``new`` or later."""
    found, owner = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
    h = np.zeros(len(codes), np.uint32)
    some = np.zeros(len(codes), bool)
    for n in range(1, max(ORDERS) + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        h = (h[:size] ^ codes[n - 1 :]) * np.uint32(0x9E3779B1) + np.uint32(n)
        some = some[:size] | letter[n - 1 :]
        if n in ORDERS:
            # A sequence that runs on into the next text belongs to neither.
            good = some & (text_of[:size] == text_of[n - 1 :])
            good[: max(0, new - n + 1)] = False
            at = np.flatnonzero(good)
            bucket = (h[at] ^ (h[at] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            found.append((bucket >> np.uint32(32 - bits)).astype(np.int32))
            owner.append(text_of[at])
    return np.concatenate(found), np.concatenate(owner)


def features(texts: list[str | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the texts, and the number of its text.

    Texts are lower-cased; every run of other characters than letters is one blank, and a blank stands at both ends. N-grams (of
    one to three characters) must hold a letter.
    """
    joined = "".join([f" {(t or '').replace(_END, ' ')} {_END}" for t in texts]).lower()
    codes = _codes(joined)
    end = codes == 0
    text_of = np.cumsum(end, dtype=np.int32)
    letter = _letters(codes)
    keep = letter.copy()
    keep[:1] = True
    keep[1:] |= (letter[:-1] | end[:-1]) & ~end[1:]
    return _buckets(np.where(letter, codes, np.uint32(32))[keep], letter[keep], text_of[keep], 0, bits)


def _long_features(text: str, bits: int, block_chars: int) -> Iterator[np.ndarray]:
    """The buckets that ``features`` gives for one long text, a piece at a time.

    The text is lower-cased whole. A piece knows whether a letter came before it and carries the last normalised characters
    of the piece before; it counts the n-grams that end in its own part.
    """
    lowered = f" {text.replace(_END, ' ')} ".lower()
    # As after a letter: the blank at the front counts.
    after_letter, carried, carried_letters = True, np.empty(0, np.uint32), np.empty(0, bool)
    for k in range(0, len(lowered), block_chars):
        codes = _codes(lowered[k : k + block_chars])
        letter = _letters(codes)
        keep = letter.copy()
        keep[0] |= after_letter
        keep[1:] |= letter[:-1]
        after_letter = letter[-1]
        codes = np.concatenate((carried, np.where(letter, codes, np.uint32(32))[keep]))
        letter = np.concatenate((carried_letters, letter[keep]))
        yield _buckets(codes, letter, np.zeros(len(codes), np.int32), len(carried), bits)[0]
        rest = max(ORDERS) - 1
        carried, carried_letters = codes[-rest:], letter[-rest:]


def feature_blocks(texts: list[str | None], bits: int = BITS, block_chars: int = BLOCK_CHARS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``features`` of all texts in blocks of about ``block_chars``; a longer text comes in several, none of its n-grams lost or added.

    Inside each n-gram length of a block the n-grams of a text lie together.
    """
    begin, size = 0, 0
    for i, t in enumerate([*texts, None]):
        n = len(t or "")
        if begin < i and (i == len(texts) or size + n > block_chars):
            bucket, owner = features(texts[begin:i], bits)
            yield bucket, owner + begin
            begin, size = i, 0
        if n > block_chars:
            for bucket in _long_features(t, bits, block_chars):
                yield bucket, np.full(len(bucket), i, np.int32)
            begin, size = i + 1, 0
        else:
            size += n


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows_per_language: int | None = None, bits: int = BITS, alpha: float = 0.5, bounded: bool = False) -> dict:
    """Fit the model on all labelled rows, or on at most ``rows_per_language`` of each language, the first by a hash of their id.

    Rows that share id and language count as one towards that bound and are all learned. Rows without text or language take no part; a language without any n-gram is left out. Returns
    ``{"languages": [...], "weights": int32 array (languages, 2**bits)}``, empty without labelled rows. The model has a proven size, 4 * 2**bits bytes per language; above
    ``MOST_MODEL_BYTES`` it is refused with a request for fewer bits. With ``bounded`` the training rows are scored once more
    and ``{"bounds": {language: least fit}}`` is added: ``FIT_WIDTH`` times as far below the median of their fits as the
    quantile ``LOW_QUANTILE`` is. A language with fewer than ``LEAST_ROWS`` rows has none.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    picked = rows.select("lang", "text")
    if rows_per_language is not None:
        # The cut is made on ids alone, in salted parts and then over what these leave; texts are fetched for the chosen rows.
        labels = rows.select("id", "lang").distinct()
        chosen = top_per_group(labels, ["lang"], [F.xxhash64("id"), F.col("id")], rows_per_language, salt_on=["id"])
        ids, seen = measured_write(chosen.select(F.col("id").alias("_id"), F.col("lang").alias("_lang")), "training-ids", rows=F.count(F.lit(1)))
        same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang"))
        picked = rows.join(sized(ids, seen["rows"]), same, "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, 1):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for bucket, owner in feature_blocks(texts, bits):
                present = np.flatnonzero(np.bincount(owner, minlength=len(texts))).tolist()
                if not present:
                    continue
                names = sorted({langs[i] for i in present})
                of = np.zeros(len(texts), np.int64)
                of[present] = [names.index(langs[i]) for i in present]
                table = np.bincount(of[owner] * (1 << bits) + bucket, minlength=len(names) << bits).reshape(len(names), -1)
                for k, name in enumerate(names):
                    sums[name] = sums[name] + table[k] if name in sums else table[k].copy()
        for name, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(row[at], pa.int64())], names=["lang", "bucket", "n"])

    counted = picked.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # One row per language: its buckets and counts, at most 2**bits of each.
    found = sorted(counted.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).collect())
    if len(found) * 4 << bits > MOST_MODEL_BYTES:
        raise ValueError(f"{len(found)} languages with {1 << bits} buckets pass {MOST_MODEL_BYTES} bytes; take fewer bits")
    weights = np.zeros((len(found), 1 << bits), np.int32)
    for k, row in enumerate(found):
        counts = np.full(1 << bits, alpha)
        counts[np.array(row["b"], dtype=np.int64)] += np.array(row["n"], dtype=np.float64)
        weights[k] = np.rint(np.log(counts / counts.sum()) * _SCALE).astype(np.int32)
    model = {"languages": [r["lang"] for r in found], "weights": weights, "bits": bits}
    if bounded:
        fits = identify(picked, model, fit=True).where(F.col("lang_pred") == F.col("lang")).groupBy("lang")
        # One row per language.
        rows = fits.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("fit", [LOW_QUANTILE, 0.5], 10_000).alias("q")).collect()
        model["bounds"] = {r["lang"]: r["q"][1] - FIT_WIDTH * (r["q"][1] - r["q"][0]) for r in rows if r["n"] >= LEAST_ROWS}
    return model


def identify(docs: DataFrame, model: dict, text_col: str = "text", fit: bool = False) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every row, from the whole text.

    ``score`` is the posterior of the best language with equal priors. ``und`` and 0 where the text is null, has
    no letters, or nothing was learned. Equal scores go to the smaller language name. Existing columns
    of these two names are replaced; all others are kept. With ``fit`` a column of this name is added: the mean log probability
    of an n-gram under the best language, less what the language's own n-grams have on average, plus three
    standard errors of such a mean, so that short texts have the benefit of the doubt. Null where nothing was scored.
    """
    kept = docs.drop("lang_pred", "score", *(["fit"] if fit else []))
    columns = kept.columns
    at = columns.index(text_col)
    logs = model["weights"] / _SCALE
    usual = (np.exp(logs) * logs).sum(1)
    # The n-grams of each length overlap, so a text has about a third as many that are free.
    wide = 3 * np.sqrt(len(ORDERS) * ((np.exp(logs) * logs**2).sum(1) - usual**2))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, weights, bits = shared.value["languages"], shared.value["weights"], shared.value["bits"]
        for batch in slices(batches, at):
            texts = batch.column(at).to_pylist()
            total = np.zeros((len(texts), len(languages)), np.int64)
            seen = np.zeros(len(texts), np.int64)
            for bucket, owner in feature_blocks(texts, bits):
                seen += np.bincount(owner, minlength=len(texts))
                # Texts lie in order inside each n-gram length, so every run of one owner is one sum.
                edge = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else []
                for k in range(len(languages)):
                    if len(edge):
                        np.add.at(total[:, k], owner[edge], np.add.reduceat(weights[k][bucket], edge, dtype=np.int64))
            if languages:
                best = total.argmax(axis=1)
                gap = (total - total.max(axis=1, keepdims=True)) / _SCALE
                score = np.where(seen > 0, 1.0 / np.exp(gap).sum(axis=1), 0.0)
                names = [languages[b] if s else "und" for b, s in zip(best, seen)]
            else:
                score, names = np.zeros(len(texts)), ["und"] * len(texts)
            found = {"lang_pred": pa.array(names, pa.string()), "score": pa.array(score, pa.float64())}
            if fit:
                n = np.maximum(seen, 1)
                value = total.max(axis=1) / _SCALE / n - usual[best] + wide[best] / np.sqrt(n) if languages else score
                found["fit"] = pa.array(value, pa.float64(), mask=np.array([x == "und" for x in names], bool))
            yield pa.RecordBatch.from_arrays([*batch.columns, *found.values()], names=[*columns, *found])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "lang_pred string, score double", *(["fit double"] if fit else [])])
    return kept.mapInArrow(predict, schema)


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % divisor
