"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

A document is its set of distinct word shingles. One hash of every shingle gives the whole signature: the hash
range is cut into ``bands * rows`` bins and each bin keeps its smallest hash. An empty bin borrows from a filled
one, tried in an order that is random per bin and the same for all documents. Documents that agree on all rows
of a band share a bucket.

Inside a bucket only (hub, member) pairs are candidates, so their number is linear in its size. After two such
rounds with different hubs, the members that could still join two components inside a bucket are compared in blocks, so no
link between a bucket's members is left out. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaspark.llm.components import components, sized
from qaspark.llm.memory import slices
from qaspark.llm.words import Words, grams_of, mix
from qaspark.session import few_files, measured_write, write_through

WORDS = 5
SIMILARITY_PERCENT = 80
#: At a similarity of 0.8 a pair misses all bands with probability (1 - 0.8**7)**64 = 3e-7.
BANDS, ROWS = 64, 7
#: Documents of a bucket that are compared in one task step.
BLOCK_DOCS = 1024
#: Rows of 64 band keys in a file.
_CLASSES_PER_FILE = 10_000
_PAIRS_PER_FILE = 100_000
_order: dict[int, np.ndarray] = {}


def shingle_sets(texts: list[bytes | None], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text; A-Z lower-cased, short texts are one shingle."""
    words = Words(texts, lower=True)
    found, at = words.grams(n)
    cut = np.searchsorted(at, words.offsets)
    sets = []
    hashes = words.hashes()
    for i, count in enumerate(words.n_words):
        if 0 < count < n:
            a, b = words.offsets[i], words.offsets[i + 1]
            sets.append(grams_of(hashes[a:b], np.array([0, b - a]), int(count))[0])
            continue
        s = np.sort(found[cut[i] : cut[i + 1]])
        sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s)
    return sets


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Smallest hash of each bin; ``shingles`` is sorted and not empty."""
    if bins not in _order:
        _order[bins] = np.random.Generator(np.random.PCG64(bins)).permuted(np.tile(np.arange(bins, dtype=np.int16 if bins < 2**15 else np.int32), (bins, 1)), axis=1)
    bin_of = ((shingles >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bin_of[1:] != bin_of[:-1])))
    filled = bin_of[first].astype(np.int64)
    out = np.zeros(bins, np.uint64)
    out[filled] = shingles[first]
    if len(filled) < bins:
        empty = np.ones(bins, bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        # _order[i, j] is when bin i asks bin j: the first filled one asked lends its value.
        lender = filled[_order[bins][empty[:, None], filled[None, :]].argmin(axis=1)]
        out[empty] = out[lender]
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.reshape(bands, -1)
    h = np.arange(bands, dtype=np.uint64)
    for k in range(rows.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return h.view(np.int64)


def _sketches(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = shingle_sets(batch.column(1).cast(pa.large_binary()).to_pylist(), n)
            sums = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            more = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            keys = [band_keys(signature(s, bands * rows), bands) for s in sets if len(s)]
            lengths = np.array([bands * bool(len(s)) for s in sets])
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            bands_of = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums), pa.array(more), bands_of],
                names=["id", "n", "sum", "sum2", "bands"],
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(sketch, "id long, n long, sum long, sum2 long, bands array<long>")


def _sets_of(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = shingle_sets(batch.column(1).cast(pa.large_binary()).to_pylist(), n)
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
            flat = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["id", "shingles"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(build, "id long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    all_ = F.size("_a") + F.size("_b") - both
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= all_ * percent).select("a", "b")


def _remaining(groups: DataFrame, sets: DataFrame, percent: int, rows: int) -> DataFrame:
    """Links between different components inside a bucket, at least one for each two components that have any.

    In each bucket the members outside of its most frequent component are held against all members. Buckets are cut
    into blocks of a bounded number of documents; no pair becomes a row. ``rows``: how many ``groups`` has.
    """
    parts = groups.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy(F.col("key").alias("_k")).agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("size"), F.count(F.lit(1)).alias("_n"))
    mixed = mixed.where(F.col("_n") > 1).drop("_n")
    rest = write_through(few_files(groups.select("key", "cid", "comp").join(mixed, F.col("key") == F.col("_k")).drop("_k"), rows), "rest")
    held = rest.join(sets.withColumnRenamed("id", "_s"), F.col("cid") == F.col("_s")).drop("_s")
    n = F.ceil(F.col("size") / BLOCK_DOCS).cast("int")
    own = F.pmod(F.xxhash64("cid"), n).cast("int")
    every = F.sequence(F.lit(0), n - 1)
    asked = F.col("comp") != F.col("main")
    # A document meets, as a member, the queries of every block, and as a query the members of every block.
    as_member = F.transform(every, lambda k: F.struct(k.alias("q"), own.alias("m"), F.lit(False).alias("asks")))
    as_query = F.transform(every, lambda k: F.struct(own.alias("q"), k.alias("m"), F.lit(True).alias("asks")))
    dealt = held.withColumn("b", F.explode(F.when(asked, F.concat(as_member, as_query)).otherwise(as_member)))

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        cid, comp = table.column("cid").to_numpy(), table.column("comp").to_numpy()
        lists = [np.asarray(x.values) for x in table.column("shingles")]
        members, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
        sizes = np.fromiter((len(x) for x in lists), np.int64, len(lists))
        found: set[tuple[int, int]] = set()
        if len(members) and len(queries):
            flat = np.concatenate([lists[i] for i in members])
            order = np.argsort(flat, kind="stable")
            ranked, owner = flat[order], np.repeat(np.arange(len(members)), sizes[members])[order]
            for q in queries:
                low, high = np.searchsorted(ranked, lists[q], "left"), np.searchsorted(ranked, lists[q], "right")
                both = np.bincount(np.concatenate([owner[x:y] for x, y in zip(low, high)]), minlength=len(members))
                near = (both * 100 >= (sizes[q] + sizes[members] - both) * percent) & (comp[members] != comp[q])
                at = members[near]
                # One link to each component is enough.
                _, first = np.unique(comp[at], return_index=True)
                found.update((min(int(cid[q]), int(cid[i])), max(int(cid[q]), int(cid[i]))) for i in at[first])
        pairs = sorted(found)
        return pa.table({"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())})

    return dealt.select("key", "cid", "comp", "shingles", "b.q", "b.m", "b.asks").groupBy("key", "q", "m").applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    n: int = WORDS,
    percent: int = SIMILARITY_PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked if 100 * |common shingles| >= percent * |all shingles|. ``component_id`` is the smallest
    id reachable through links and ``kept`` marks the document that carries it. Null, empty and blank texts
    have no shingle and no link. Rows that repeat an id are one document, with the smallest of their texts, and
    share its result; a null id stays alone (component null, kept). Other columns are left out.
    """
    sketches, seen = measured_write(_sketches(docs, id_col, text_col, n, bands, rows), "sketches", rows=F.count(F.lit(1)))
    repeated = sketches.where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    if repeated.limit(1).count():
        rows_of = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        single = rows_of.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("text").alias("text"))
        found = near_duplicates(single.union(rows_of.where(F.col("doc_id").isNull())), n, percent, bands, rows)
        known = found.where(F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "__near_id")
        alone = found.where(F.col("doc_id").isNull())
        return rows_of.select("doc_id").join(known, F.col("doc_id") == F.col("__near_id")).drop("__near_id").unionByName(alone)
    used = sketches.where((F.col("n") > 0) & F.col("id").isNotNull())
    # Equal sets are one class: it is its smallest id, and the copies join again at the end.
    classes = used.groupBy("n", "sum", "sum2").agg(F.min_by("bands", "id").alias("bands"), F.min("id").alias("cid"))
    classes = write_through(few_files(classes, seen["rows"], _CLASSES_PER_FILE), "classes")
    keys = classes.select("cid", "n", F.explode("bands").alias("key")).distinct()
    shared = keys.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where(F.col("low") != F.col("high")).select("key")
    most = seen["rows"] * bands
    shared, found = measured_write(few_files(shared, most), "buckets", rows=F.count(F.lit(1)))
    members, counted = measured_write(few_files(keys.join(sized(shared, found["rows"]), "key"), most), "members", rows=F.count(F.lit(1)))
    base = sketches.select("id", "n", "sum", "sum2")
    same = base.where((F.col("n") > 0) & F.col("id").isNotNull()).join(
        classes.select(F.col("n").alias("_n"), F.col("sum").alias("_s"), F.col("sum2").alias("_t"), "cid"),
        (F.col("n") == F.col("_n")) & (F.col("sum") == F.col("_s")) & (F.col("sum2") == F.col("_t")),
    ).select("id", "cid")
    links = None
    if counted["rows"]:
        wanted = few_files(members.select(F.col("cid").alias("__near_id")).distinct(), min(seen["rows"], counted["rows"]))
        wanted, ids = measured_write(wanted, "wanted", rows=F.count(F.lit(1)))
        texts = docs.join(sized(wanted, ids["rows"]), F.col(id_col).cast("long") == F.col("__near_id"), "left_semi")
        sets = write_through(_sets_of(texts, id_col, text_col, n), "shingles")
        near = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
        # First the smallest member of every bucket is its hub, so that buckets share hubs; then a member in random order, so
        # that a document which missed its hub meets another one in each of its buckets.
        for order in (F.col("cid"), F.xxhash64("key", "cid")):
            groups = members.withColumn("comp", F.col("cid")) if links is None else _with_component(members, components(links, linked["rows"]))
            hubs = groups.groupBy(F.col("key").alias("_k")).agg(F.min_by(F.struct("cid", "n", "comp"), order).alias("hub"), F.min("comp").alias("_x"), F.max("comp").alias("_y"))
            hubs = hubs.where(F.col("_x") != F.col("_y")).select("_k", F.col("hub.cid").alias("hub"), F.col("hub.n").alias("m"), F.col("hub.comp").alias("hub_comp"))
            pairs = groups.join(hubs, F.col("key") == F.col("_k")).where((F.col("comp") != F.col("hub_comp")) & near)
            pairs = pairs.select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct()
            confirmed = _confirmed(pairs, sets, percent)
            confirmed = confirmed if links is None else links.union(confirmed)
            # Sets are compared in all partitions; the few pairs that are left are dealt anew.
            files = -(-counted["rows"] // _PAIRS_PER_FILE)
            links, linked = measured_write(confirmed.repartition(files), "confirmed", rows=F.count(F.lit(1)))
        groups = _with_component(members, components(links, linked["rows"]))
        links = links.union(_remaining(groups, sets, percent, counted["rows"]))
    roots = components(classes.select(F.col("cid").alias("a"), F.col("cid").alias("b")).where("false") if links is None else links)
    grouped = same.join(roots, F.col("cid") == F.col("node"), "left").select(F.col("id").alias("__near_id"), F.coalesce("component", "cid").alias("component"))
    joined = base.join(grouped, F.col("id") == F.col("__near_id"), "left")
    component = F.coalesce("component", "id")
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _with_component(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found, F.col("cid") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "cid")).drop("node", "component")
