"""TF-IDF in long form: ``(language, doc_id, term, tf, weight)``."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from qaspark.functions import text
from qaspark.operators.ranking import top_per_group
from qaspark.session import broadcast_if_small, measured_write, write_through

_DOC = ["language", "doc_id"]
#: A task cuts up about so many bytes of text, however many there are: the terms it holds to count them stay in proportion.
TEXT_BYTES = 8 << 20
#: A worker counts the terms of about so many words at a time; with them the keys of its counts stay below 2^63.
WORDS = 1 << 19
#: A term that stands at most once in so many words of a slice is left out of the first count.
RARE = 1 << 17
#: A vocabulary of so many rows in all is held by every worker.
KNOWN = 200_000


def term_counts(df: DataFrame, column: str = "text", stopwords: list[str] | None = None) -> DataFrame:
    """Occurrences of words and neighbour pairs in every document.

    The texts are shuffled by document before they are cut up: that moves less than their words and pairs would. Terms are
    counted inside their row; only documents that stand in several rows are added up. Runs two small jobs at once, over the
    texts' lengths and over the ids.
    """
    rows = df.select(*_DOC, F.col(column).alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    parts = max(math.ceil(size / TEXT_BYTES), rows.sparkSession.sparkContext.defaultParallelism)
    once, again = _by_occurrence(rows, rows.repartition(parts, *_DOC), stopwords)
    counts = _counted(once, stopwords)
    return counts if again is None else counts.unionByName(again)


def _by_occurrence(rows: DataFrame, spread: DataFrame, stopwords: list[str] | None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of documents that stand in one row only, and the counts of the others, if any."""
    several = rows.groupBy(*_DOC).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    several, seen = measured_write(several.select(F.col("language").alias("_l"), F.col("doc_id").alias("_d")), "several", rows=F.count(F.lit(1)))
    if not seen["rows"]:
        return spread, None
    same = F.col("language").eqNullSafe(F.col("_l")) & F.col("doc_id").eqNullSafe(F.col("_d"))
    listed = broadcast_if_small(several, seen["rows"])
    again = _counted(spread.join(listed, same, "left_semi"), stopwords).groupBy(*_DOC, "term").agg(F.sum("tf").alias("tf"))
    return spread.join(listed, same, "left_anti"), again


def _kept(rows: DataFrame, stopwords: list[str] | None) -> DataFrame:
    return rows.select(*_DOC, text.kept_words("_text", stopwords).alias("_w"))


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.Array]]:
    """Rows of ``_kept`` of one language, with about ``most`` words at a time: (rows, row of each word, number of each word, the different words)."""
    for batch in batches:
        language = batch.column(0).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        order = np.argsort(language, kind="stable")
        batch, language = batch.take(pa.array(order)), language[order]
        sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            to = int(np.searchsorted(ends, ends[at] - sizes[at] + most, "right"))
            to = min(max(to, at + 1), int(np.searchsorted(language, language[at], "right")))
            some = batch.slice(at, to - at)
            words = some.column(2).flatten().dictionary_encode()
            if len(words):
                yield some, np.repeat(np.arange(to - at), sizes[at:to]), words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
            at = to


def _counted_in(row: np.ndarray, code: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(row, first word, second word or -1, occurrences) of the terms of each row; ``n`` words are different."""
    word = (row * n + code) * (n + 1)
    keys, tf = np.unique(np.concatenate((word, (word[:-1] + code[1:] + 1)[row[1:] == row[:-1]])), return_counts=True)
    rest, second = np.divmod(keys, n + 1)
    row, first = np.divmod(rest, n)
    return row, first, second - 1, tf


def _spelled(words: pa.Array, first: np.ndarray, second: np.ndarray) -> pa.Array:
    others = words.take(pa.array(second, mask=second < 0))
    return pc.binary_join_element_wise(words.take(pa.array(first)), others, pa.scalar(" ", words.type), null_handling="skip")


def _counted(rows: DataFrame, stopwords: list[str] | None) -> DataFrame:
    """The terms of each row with their number in it."""
    most = WORDS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, row, code, words in _slices(batches, most):
            row, first, second, tf = _counted_in(row, code, len(words))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([some.column(0).take(at), some.column(1).take(at), _spelled(words, first, second), pa.array(tf)], names=[*_DOC, "term", "tf"])

    kept = _kept(rows, stopwords)
    return kept.mapInArrow(count, StructType([*kept.schema.fields[:2], StructField("term", StringType()), StructField("tf", LongType())]))


def _counted_by_language(rows: DataFrame, stopwords: list[str] | None, rare: int | None = None) -> DataFrame:
    """``(language, term, df, ctf, missed)`` of documents that stand in one row each, several rows a term: a slice adds up what it has at hand.

    A term that stands in a slice at most once in ``rare`` words is left out. A row without a term says how often such a term may stand in the slice.
    """
    most = WORDS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, row, code, words in _slices(batches, most):
            missed = len(row) // rare if rare else 0
            n = len(words) + 1
            _, first, second, tf = _counted_in(row, code, len(words))
            keys, place, df = np.unique(first * n + second + 1, return_inverse=True, return_counts=True)
            ctf = np.bincount(place, tf).astype(np.int64)
            often = ctf > missed
            terms = pa.concat_arrays([_spelled(words, keys[often] // n, keys[often] % n - 1), pa.nulls(1, words.type)])
            figures = (np.append(df[often], 0), np.append(ctf[often], 0), np.full(len(terms), missed))
            yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(np.zeros(len(terms), np.int64))), terms, *map(pa.array, figures)], names=["language", "term", "df", "ctf", "missed"])

    kept = _kept(rows, stopwords)
    return kept.mapInArrow(count, StructType([kept.schema["language"], StructField("term", StringType()), *(StructField(c, LongType()) for c in ("df", "ctf", "missed"))]))


def top_words(df: DataFrame, column: str = "text", n: int = 15, stopwords: list[str] | None = None) -> DataFrame:
    words = df.select("language", F.explode(text.tokenize(column, stopwords)).alias("word"))
    counts = words.groupBy("language", "word").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, ["language"], [F.desc("n"), F.col("word")], n, rank="rank")


def vocabulary(counts: DataFrame, docs: DataFrame, min_df: int = 3, max_features: int = 5000) -> DataFrame:
    """``(language, term, df, ctf, idf)``: terms in at least ``min_df`` documents, the
    ``max_features`` most frequent of each language.

    ``docs`` gives the number of documents, also those without any term.
    """
    return _best_terms(counts.select("language", "term", F.lit(1).cast("long").alias("df"), F.col("tf").alias("ctf")), docs, min_df, max_features)


def _best_terms(found: DataFrame, docs: DataFrame, min_df: int, max_features: int) -> DataFrame:
    sizes = docs.groupBy("language").agg(F.count(F.lit(1)).alias("_n"))
    per_term = found.groupBy("language", "term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf")).where(F.col("df") >= min_df)
    best = top_per_group(per_term, ["language"], [F.desc("ctf"), F.col("term")], max_features, salt_on=["term"])
    idf = F.log((F.lit(1) + F.col("_n")) / (F.lit(1) + F.col("df"))) + 1
    return best.join(sizes, "language").select("language", "term", "df", "ctf", idf.alias("idf"))


def transform(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Unit-length weights of the known terms; unknown terms drop out."""
    raw = counts.join(vocab.select("language", "term", "idf"), ["language", "term"]).withColumn(
        "_w", (F.lit(1) + F.log("tf")) * F.col("idf")
    )
    # A document has at most max_features known terms, so its list is bounded.
    by_doc = raw.groupBy(*_DOC).agg(
        F.collect_list(F.struct("term", "tf", "_w")).alias("_t"), F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm")
    )
    return by_doc.select(*_DOC, "_norm", F.explode("_t").alias("_t")).select(
        *_DOC, "_t.term", "_t.tf", (F.col("_t._w") / F.col("_norm")).alias("weight")
    )


class _Known:
    """The vocabulary of a language, to be looked up by the words of its terms."""

    def __init__(self, terms: list[str], figures: list):
        parts = [t.split(" ") for t in terms]
        words = sorted({w for p in parts for w in p})
        number = {w: i for i, w in enumerate(words)}
        keys = np.array([number[p[0]] * (len(words) + 1) + (number[p[1]] + 1 if len(p) > 1 else 0) for p in parts], np.int64)
        order = np.argsort(keys)
        self.words, self.keys = pa.array(words, pa.string()), keys[order]
        self.terms, self.figures = pa.array(terms, pa.string()).take(pa.array(order)), np.array(figures)[order]

    def find(self, row: np.ndarray, code: np.ndarray, words: pa.Array) -> tuple[np.ndarray, ...]:
        """(row, term, occurrences) of the known terms of some rows."""
        number = pc.fill_null(pc.index_in(words, self.words.cast(words.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
        known = number >= 0
        both = known[1:] & known[:-1] & (row[1:] == row[:-1])
        single = number * (len(self.words) + 1)
        keys = np.concatenate((single[known], (single[:-1] + number[1:] + 1)[both]))
        term = np.searchsorted(self.keys, keys)
        real = self.keys[np.minimum(term, len(self.keys) - 1)] == keys
        cells, tf = np.unique(np.concatenate((row[known], row[:-1][both]))[real] * len(self.keys) + term[real], return_counts=True)
        return *np.divmod(cells, len(self.keys)), tf


def _shared(terms: DataFrame, figure: str) -> Broadcast:
    """The terms of each language with a figure of theirs, for all workers; at most ``KNOWN`` in all."""
    listed: dict[str, tuple[list, list]] = {}
    for language, term, x in terms.select("language", "term", figure).collect():
        for part, value in zip(listed.setdefault(language, ([], [])), (term, x)):
            part.append(value)
    return terms.sparkSession.sparkContext.broadcast({k: _Known(*v) for k, v in listed.items()})


def _counted_known(rows: DataFrame, terms: DataFrame, stopwords: list[str] | None) -> DataFrame:
    """``(language, term, df, ctf)`` of the given terms, one row of a term per task, in documents that stand in one row each."""
    shared = _shared(terms, "ctf")
    most = WORDS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for some, row, code, words in _slices(batches, most):
            name = some.column(0)[0].as_py()
            if name in shared.value:
                known = shared.value[name]
                _, term, tf = known.find(row, code, words)
                total = sums.setdefault(name, np.zeros((2, len(known.keys)), np.int64))
                total += np.stack((np.bincount(term, minlength=len(known.keys)), np.bincount(term, tf, len(known.keys)).astype(np.int64)))
        for name, (df, ctf) in sums.items():
            some = pa.array(np.flatnonzero(df))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), shared.value[name].terms.take(some), pa.array(df).take(some), pa.array(ctf).take(some)], names=["language", "term", "df", "ctf"])

    return _kept(rows, stopwords).mapInArrow(count, "language string, term string, df long, ctf long")


def _weighted(rows: DataFrame, vocab: DataFrame, stopwords: list[str] | None) -> DataFrame:
    """``transform`` of the counts of documents that stand in one row each; all workers hold the vocabulary."""
    shared = _shared(vocab, "idf")
    most = WORDS

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, row, code, words in _slices(batches, most):
            name = some.column(0)[0].as_py()
            if name in shared.value:
                known = shared.value[name]
                row, term, tf = known.find(row, code, words)
                raw = (1.0 + np.log(tf)) * known.figures[term]
                weight = raw / np.sqrt(np.bincount(row, raw * raw))[row]
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([some.column(0).take(at), some.column(1).take(at), known.terms.take(pa.array(term)), pa.array(tf), pa.array(weight)], names=[*_DOC, "term", "tf", "weight"])

    kept = _kept(rows, stopwords)
    return kept.mapInArrow(weigh, StructType([*kept.schema.fields[:2], StructField("term", StringType()), StructField("tf", LongType()), StructField("weight", DoubleType())]))


def _term_figures(once: DataFrame, again: DataFrame | None, stopwords: list[str] | None, min_df: int, max_features: int) -> DataFrame:
    """``(language, term, df, ctf)``, several rows a term, of all terms that may be among the ``max_features`` most frequent ones of a language.

    Nearly all terms are rare everywhere. A first count leaves out what is rare in its slice, and how often a term may have been missed is known.
    If that is less than ``max_features`` terms surely have, only terms that may reach these are counted again, over all documents, and no others travel;
    languages for which it is not are counted in full. The figures are exact, whatever way they were taken.
    """
    spark = once.sparkSession
    once = once.where(F.col("language").isNotNull())
    first = _counted_by_language(once, stopwords, RARE)
    if again is not None:
        again = again.where(F.col("language").isNotNull()).select("language", "term", F.lit(1).cast("long").alias("df"), F.col("tf").alias("ctf"))
        first = first.unionByName(again.withColumn("missed", F.lit(0).cast("long")))
    sure = write_through(first.groupBy("language", "term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf"), F.sum("missed").alias("missed")), "sure")
    missed = {r["language"]: r["missed"] for r in sure.where(F.col("term").isNull()).collect()}  # one row per language
    sure = sure.where(F.col("term").isNotNull())
    best = top_per_group(sure.where(F.col("df") >= min_df), ["language"], [F.desc("ctf"), F.col("term")], max_features, salt_on=["term"])
    least = {r["language"]: r["least"] for r in best.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.min("ctf").alias("least")).where(F.col("n") == max_features).collect()}
    reached = [(k, n, least[k]) for k, n in missed.items() if 0 < n < least.get(k, 0)]
    found = sure.where(~F.col("language").isin([k for k, n in missed.items() if n])).select("language", "term", "df", "ctf")
    if reached:
        bounds = F.broadcast(spark.createDataFrame(reached, "language string, _missed long, _least long"))  # one row per language
        may = sure.join(bounds, "language").where(F.col("ctf") + F.col("_missed") - F.col("missed") >= F.col("_least"))
        may, seen = measured_write(may.select("language", "term", "ctf"), "candidates", rows=F.count(F.lit(1)))
        if seen["rows"] > KNOWN:
            reached = []
        else:
            found = found.unionByName(_counted_known(once.where(F.col("language").isin([k for k, _, _ in reached])), may, stopwords))
    rest = [k for k, n in missed.items() if n and k not in {k for k, _, _ in reached}]
    if rest:
        found = found.unionByName(_counted_by_language(once.where(F.col("language").isin(rest)), stopwords).where(F.col("term").isNotNull()).drop("missed"))
    if again is not None:
        found = found.unionByName(again.where(F.col("language").isin([k for k, n in missed.items() if n])))
    return found


def fit(
    df: DataFrame,
    column: str = "text",
    stopwords: list[str] | None = None,
    min_df: int = 3,
    max_features: int = 5000,
) -> tuple[DataFrame, DataFrame]:
    """``(vocabulary, weights)`` of the documents.

    The texts are cut up once for the vocabulary's candidates, once to count these and once for the weights: stored counts are many times their size. A document in one row is counted and weighed where it is
    cut up, so no term without a place in the vocabulary leaves its task, and nothing is gathered by document; those in several rows go through
    ``transform``. The vocabulary has at most ``max_features`` rows per language and is stored; one of more than ``KNOWN`` rows is joined instead.
    """
    rows = df.select(*_DOC, F.col(column).alias("_text"))
    once, again = _by_occurrence(rows, rows, stopwords)
    found = _term_figures(once, again, stopwords, min_df, max_features)
    vocab, seen = measured_write(_best_terms(found, df, min_df, max_features), "vocabulary", rows=F.count(F.lit(1)))
    if seen["rows"] > KNOWN:
        counts = _counted(once, stopwords)
        return vocab, transform(counts if again is None else counts.unionByName(again), vocab)
    weights = _weighted(once, vocab, stopwords)
    return vocab, weights if again is None else weights.unionByName(transform(again, vocab))
