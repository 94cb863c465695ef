"""Brown class-based n-grams: words fall into classes, classes follow one another, words come out of classes.

    P(word | word before) = P(class | class before) * P(word | class)

Every word of the training texts, however rare, is an item of exchange clustering with a class of its own. The start
is the exact exchange of the most frequent words (the others go with their ending); then rounds run over the whole
corpus: batches of documents count the classes beside their words, buckets of the vocabulary add these counts up and
let each word pick its best class against the table of class transitions. Only words never seen in training take a
class by their ending. Word counts are those of all training texts: every batch asks the corpus for the
counts and classes of its own words. The 64-bit keys travel once: a bucket numbers its words, and the rounds know the
words of a batch by these numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaspark.llm import batches as B
from qaspark.llm.words import Words, mix
from qaspark.session import _write, delete_table, write_through

TOP_WORDS = 768
ENDINGS = 256
CLASSES = 64
DELTA = 0.5
#: Rounds end with a gain of less than this part of the likelihood, or when not even this share of the words can move with a gain.
LEAST_GAIN = 1e-3
LEAST_SHARE = 0.25
_LOW = np.uint64(ENDINGS - 1)
_TALLY = "bucket int, batch long, classes binary, counts binary"
#: A batch's words as steps between their places among the bucket's words, and their counts; the row of batch -1 has the keys of the bucket's words.
_NUMBERED = "bucket int, batch long, places binary, counts binary, tokens long, types long, key array<long>, n array<long>"
_WORDS_AT_ONCE = 1 << 14


def word_keys(words: Words) -> np.ndarray:
    """64-bit keys: 56 bits of the word's hash, and 8 bits that words with the same last three bytes share."""
    last = np.zeros(len(words.starts), np.uint64)
    for k in range(1, 4):
        at = words.ends - k
        last = last << np.uint64(8) | np.where(at >= words.starts, words.buffer[np.maximum(at, 0)], 0).astype(np.uint64)
    return (words.hashes() & ~_LOW) | (mix(last) & _LOW)


def items_of(keys: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Item of each word: its place among the sorted ``top`` keys, or the item of its ending after them."""
    place = np.searchsorted(top, keys)
    found = np.zeros(len(keys), bool)
    inside = place < len(top)
    found[inside] = top[place[inside]] == keys[inside]
    return np.where(found, place, len(top) + (keys & _LOW).astype(np.int64))


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(joint: np.ndarray) -> float:
    """What of the corpus' log likelihood depends on the classes, from the counts of class pairs."""
    return float(xlogx(joint).sum() - xlogx(joint.sum(0)).sum() - xlogx(joint.sum(1)).sum())


def exchange(pairs: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of every item from the bigram counts ``pairs``; the last item (the end of a text) keeps a class of its own.

    Items go round in order of frequency and move to the class that raises the likelihood most, until a round moves none
    or gains less than a millionth of the total.
    """
    n = len(pairs)
    counts = pairs.astype(np.float64)
    weight = counts.sum(0) + counts.sum(1)
    order = np.argsort(-weight[:-1], kind="stable")
    of = np.empty(n, np.int64)
    of[order] = np.arange(n - 1) % (classes - 1)
    of[-1] = classes - 1
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1
    joint = member.T @ counts @ member
    out = counts @ member  # to each class, by item
    into = counts.T @ member  # from each class, by item

    value = likelihood(joint)
    while True:
        moved = 0
        for w in order:
            if not weight[w]:
                continue
            a, loop = of[w], counts[w, w]
            o, i = out[w].copy(), into[w].copy()
            o[a] -= loop
            i[a] -= loop
            # Without w: its row and column leave class a.
            joint[a] -= o
            joint[:, a] -= i
            joint[a, a] -= loop
            rows, columns = joint.sum(1), joint.sum(0)
            # Gain of putting w into each class b: its row, its column and the corner where they meet.
            row = (xlogx(joint + o) - xlogx(joint)).sum(1) - (xlogx(joint.diagonal() + o) - xlogx(joint.diagonal()))
            column = (xlogx(joint.T + i) - xlogx(joint.T)).sum(1) - (xlogx(joint.diagonal() + i) - xlogx(joint.diagonal()))
            corner = xlogx(joint.diagonal() + o + i + loop) - xlogx(joint.diagonal())
            sums = xlogx(rows + o.sum() + loop) - xlogx(rows) + xlogx(columns + i.sum() + loop) - xlogx(columns)
            gain = row + column + corner - sums
            gain[classes - 1] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            joint[b] += o
            joint[:, b] += i
            joint[b, b] += loop
            if b != a:
                out[:, a] -= counts[:, w]
                out[:, b] += counts[:, w]
                into[:, a] -= counts[w]
                into[:, b] += counts[w]
                of[w] = b
                moved += 1
        new = likelihood(joint)
        if not moved or new - value <= 1e-6 * abs(new):
            return of
        value = new


def best_classes(out: np.ndarray, into: np.ndarray, loop: np.ndarray, of: np.ndarray, joint: np.ndarray, delta: float = DELTA) -> np.ndarray:
    """The class that suits each word best against the counts of class pairs ``joint``, which stay as they are.

    ``out`` and ``into`` (words x classes) count the classes after and before each word, ``loop`` a word beside itself.
    A word is judged by the others: its own counts are taken out of its class ``of``. The last class is that of the end.
    """
    n, classes = out.shape
    every, own = np.arange(n), joint[of, of] - out[np.arange(n), of] - into[np.arange(n), of] - loop
    log, wide = np.log(joint + delta), delta * classes
    weight = out.sum(1) + loop
    rows, columns = joint.sum(1), joint.sum(0)
    score = out @ log.T + into @ log + loop[:, None] * log.diagonal() - weight[:, None] * (np.log(rows + wide) + np.log(columns + wide))
    row, column = joint[of] - out, joint.T[of] - into
    row[every, of] = column[every, of] = own
    stay = (out * np.log(row + delta) + into * np.log(column + delta)).sum(1) + loop * np.log(own + delta)
    stay -= weight * (np.log(rows[of] - weight + wide) + np.log(columns[of] - weight + wide))
    score[every, of] = stay
    score[:, -1] = -np.inf
    best = score.argmax(1)
    return np.where(score[every, best] > stay + 1e-9, best, of)


def _count_classes(line: np.ndarray, of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class pairs of a line of word numbers (the last number is the end), and the counts beside its words.

    The latter are sorted codes, word * (2 classes + 1) + slot, and how often each occurs; slots are the class after, the class
    before, and the word itself.
    """
    before, after = np.concatenate(([len(of) - 1], line[:-1])), line
    if not len(line):
        before = line
    a, b = of[before], of[after]
    joint = np.bincount(a * classes + b, minlength=classes * classes).reshape(classes, classes)
    width, same = 2 * classes + 1, before == after
    codes = np.concatenate((before[~same] * width + b[~same], after[~same] * width + classes + a[~same], before[same] * width + 2 * classes))
    codes, n = np.unique(codes[codes < (len(of) - 1) * width], return_counts=True)
    return joint, codes, n


def _class_bytes(of: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(of.astype("<i2").tobytes())


def _classes(blob) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<i2").astype(np.int64)


def number(asked: DataFrame, top_words: int) -> DataFrame:
    """The questions with places in place of keys and with the answered counts, and for each bucket a row of its keys, sums and most frequent words."""

    def places(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(k.as_buffer(), np.uint64) for k in table.column("keys")])
        order, begins, run, numbers = B.merged(table)
        totals, names = np.add.reduceat(numbers[order], begins), keys[order][begins]
        best = np.lexsort((names, -totals))[:top_words]
        best = best[totals[best] > 0]
        cuts, rows = np.cumsum([len(k.as_buffer()) // 8 for k in table.column("keys")])[:-1], table.num_rows
        none = [None] * rows
        return pa.table(
            {
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (rows + 1), pa.int32()),
                "batch": pa.array([*table.column("batch").to_pylist(), -1], pa.int64()),
                "places": pa.array([*(B.squeeze(np.diff(x, prepend=0)) for x in np.split(run, cuts)), names.tobytes()], pa.binary()),
                "counts": pa.array([*(B.squeeze(x) for x in np.split(totals[run], cuts)), None], pa.binary()),
                "tokens": pa.array([*none, int(totals.sum())], pa.int64()),
                "types": pa.array([*none, int((totals > 0).sum())], pa.int64()),
                "key": pa.array([*none, names[best].view(np.int64).tolist()], pa.list_(pa.int64())),
                "n": pa.array([*none, totals[best].tolist()], pa.list_(pa.int64())),
            }
        )

    return write_through(asked.groupBy("bucket").applyInArrow(places, _NUMBERED), "word-numbers")


def cluster(asked: DataFrame, numbered: DataFrame, lines: DataFrame, first: Callable[[np.ndarray], np.ndarray], classes: int, spent: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Exchange rounds over all training words: ``batch, bucket, answer`` (classes in key order), class pairs, types by ending and class.

    A round is one job. All words move at once, so a round can lose likelihood: then it is taken back and a smaller
    share of the words, drawn anew, moves. Each bucket holds its own words only; a table of classes x classes is shared.
    The keys of ``asked`` are read once, for the first classes; then their folder ``spent`` is deleted.
    """
    spark = asked.sparkSession
    width = 2 * classes + 1

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_class_bytes(first(np.frombuffer(k.as_buffer(), np.uint64))) for k in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(found, pa.binary())], names=["batch", "bucket", "answer"])

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = sorted(zip(right.column("bucket").to_pylist(), right.column("answer").to_pylist()))
        if not left.num_rows:
            # Numbers of types go through to the summary.
            return pa.table([pa.array([-2] * len(rows), pa.int32()), right.column("batch"), pa.array([b""] * len(rows), pa.binary()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "batch", "classes", "counts"])
        batch = left.column("batch")[0].as_py()
        parts = [_classes(x) for _, x in rows]
        joint, codes, n = _count_classes(B.spread(left.column("line")[0].as_buffer()), np.concatenate([*parts, [classes - 1]]).astype(np.int64), classes)
        out = [(-1, batch, b"", B.squeeze(joint.ravel()))]
        place = 0
        for (bucket, answer), part in zip(rows, parts):
            a, b = np.searchsorted(codes, [place * width, (place + len(part)) * width])
            word, slot = np.divmod(codes[a:b] - place * width, width)
            out.append((bucket, batch, answer, B.squeeze(np.concatenate((np.bincount(word, minlength=len(part)), slot, n[a:b])))))
            place += len(part)
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "batch", "classes", "counts"])

    def pick(shared, share: float, turn: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def choose(left: pa.Table, right: pa.Table) -> pa.Table:
            joint = shared.value
            stored = dict(zip(left.column("batch").to_pylist(), left.column("places")))
            names = np.frombuffer(stored.pop(-1).as_buffer(), np.uint64)
            numbers, places = list(stored), [np.cumsum(B.spread(x.as_buffer())) for x in stored.values()]
            lengths = [len(x) for x in places]
            run, of = np.concatenate(places), np.empty(len(names), np.int64)
            tallies = dict(zip(right.column("batch").to_pylist(), zip(right.column("classes"), right.column("counts"))))
            codes, counts, place = [], [], 0
            for number, length in zip(numbers, lengths):
                mine = run[place : place + length]
                of[mine] = _classes(tallies[number][0].as_buffer())
                flat = B.spread(tallies[number][1].as_buffer())
                n = (len(flat) - length) // 2
                codes.append(np.repeat(mine, flat[:length]) * width + flat[length : length + n])
                counts.append(flat[length + n :].astype(np.int32))
                place += length
            codes, counts = np.concatenate(codes), np.concatenate(counts)
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            del order
            new, seen = of.copy(), np.zeros(len(of), bool)
            if share < 1:
                moving = mix(names + np.uint64(turn)) < np.uint64(int(share * 2**64))
            else:
                moving = np.ones(len(names), bool)
            for a in range(0, len(of), _WORDS_AT_ONCE):
                b = min(a + _WORDS_AT_ONCE, len(of))
                x, y = np.searchsorted(codes, [a * width, b * width])
                table = np.bincount(codes[x:y] - a * width, weights=counts[x:y], minlength=(b - a) * width).reshape(b - a, width)
                seen[a:b] = table.any(1)
                some = a + np.flatnonzero(seen[a:b] & moving[a:b])
                if len(some):
                    table = table[some - a]
                    new[some] = best_classes(table[:, :classes], table[:, classes:-1], table[:, -1], of[some], joint)
            ending = (names[seen] & _LOW).astype(np.int64) * classes
            types = np.bincount(ending + of[seen], minlength=ENDINGS * classes), np.bincount(ending + new[seen], minlength=ENDINGS * classes)
            found = [_class_bytes(x) for x in np.split(new[run], np.cumsum(lengths)[:-1])]
            bucket = left.column("bucket")[0].as_py()
            return pa.table(
                {
                    "batch": pa.array([*numbers, -1 - bucket], pa.int64()),
                    "bucket": pa.array([bucket] * (len(numbers) + 1), pa.int32()),
                    "answer": pa.array([*found, B.squeeze(np.concatenate(types))], pa.binary()),
                }
            )

        return choose

    def add(table: pa.Table) -> pa.Table:
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "total": pa.array([B.squeeze(sum(B.spread(x.as_buffer()) for x in table.column("counts")))], pa.binary())})

    def tally(state: DataFrame) -> tuple[DataFrame, str, np.ndarray, np.ndarray | None]:
        table, _, path = _write(lines.groupBy("batch").cogroup(state.groupBy("batch")).applyInArrow(count, _TALLY), "class-tally", {})
        # At most 32 sums of each kind come back: tables of classes x classes, and of endings x classes.
        sums = table.where(F.col("bucket") < 0).select("bucket", "counts", F.pmod(F.xxhash64("batch"), F.lit(32)).alias("part"))
        total: dict[int, np.ndarray] = {}
        for r in sums.groupBy("bucket", "part").applyInArrow(add, "bucket int, total binary").collect():
            total[r["bucket"]] = total.get(r["bucket"], 0) + B.spread(r["total"])
        types = total[-2].reshape(2, ENDINGS, classes) if -2 in total else None
        return table, path, total.get(-1, np.zeros(classes * classes)).reshape(classes, classes).astype(np.float64), types

    table, path, joint, _ = tally(asked.mapInArrow(begin, B.ANSWER))
    delete_table(spark, spent)
    places = numbered.select("bucket", "batch", "places")
    value, share, turn, known = likelihood(joint), 1.0, 0, np.zeros((ENDINGS, classes))
    while value and share >= LEAST_SHARE:
        turn += 1
        shared = spark.sparkContext.broadcast(joint)
        moved = places.groupBy("bucket").cogroup(table.where(F.col("bucket") >= 0).groupBy("bucket")).applyInArrow(pick(shared, share, turn), B.ANSWER)
        after, written, pairs, types = tally(moved)
        gain = likelihood(pairs) - value
        known = types[int(gain > 0)]
        if gain <= 0:
            delete_table(spark, written)
            share /= 2
            continue
        delete_table(spark, path)
        table, path, joint, value = after, written, pairs, value + gain
        if gain <= LEAST_GAIN * abs(value):
            break
    answers = table.where(F.col("bucket") >= 0).select("batch", "bucket", F.col("classes").alias("answer"))
    return answers, joint, known


def score_texts(docs: DataFrame, held_out: Column, top_words: int = TOP_WORDS, classes: int = CLASSES, delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every whole text with a model learned from the rows for which ``held_out`` (on ``doc_id``) does not hold.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` for every row. Tokens are the words, A-Z
    lower-cased, and one end. ``base_score`` is log10 of the smoothed unigram model, ``score`` that of the class model,
    ``perplexity`` the latter per token. Null and blank texts are just the end; a null id is not held out. Repeated rows count
    each. Other columns are left out; an empty table gives an empty result.
    """
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = F.coalesce(held_out, F.lit(False))
    # A packed row carries its id behind a letter that says whether the model may learn from it.
    packed, size = B.pack_batches(kept.select(F.concat(F.when(held, "h").otherwise("t"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("tag"), "text"), "tag", "text", "string")
    bits = B.bucket_bits(size // 25)

    def read(blob) -> tuple[list[str], Words, np.ndarray, np.ndarray]:
        tags, texts = B.unpack(blob)
        words = Words(texts, lower=True)
        learn = np.array([t[0] == "t" for t in tags], bool)
        return tags, words, word_keys(words), learn

    def distinct(words: Words, keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        if not len(order):
            return keys, np.empty(0, np.int64)
        ranked = keys[order]
        begin = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        return ranked[begin], np.add.reduceat(np.repeat(learn, words.n_words)[order].astype(np.int64), begin)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, words, keys, learn = read(blob.as_buffer())
                names, n = distinct(words, keys, learn)
                line, _ = _with_ends(np.searchsorted(names, keys), words, len(names))
                # The training texts as numbers of the batch's own words stand below a bucket that does not exist.
                told = {"bucket": -1, "batch": number, "keys": B.squeeze(line[np.repeat(learn, words.n_words + 1)]), "numbers": None}
                yield B.question_batch([*B.question(number, names, n, bits), told])

    # Keys and lines lie apart, as each goes once it is no longer read.
    told_apart = packed.mapInArrow(ask, B.QUESTION).withColumn("kind", F.when(F.col("bucket") < 0, "line").otherwise("ask"))
    written, _, path = _write(told_apart, "word-counts", {}, by="kind")
    asked = written.where(F.col("kind") == "ask").select("bucket", "batch", "keys", "numbers")
    lines = written.where(F.col("kind") == "line").select("batch", F.col("keys").alias("line"))

    numbered = number(asked, top_words)
    parts, replied = numbered.where(F.col("batch") < 0), numbered.where(F.col("batch") >= 0)
    best = parts.select(F.explode(F.arrays_zip("key", "n")).alias("x")).select("x.*").orderBy(F.desc("n"), "key").limit(top_words).collect()
    top = np.sort(np.array([r["key"] for r in best], np.int64).view(np.uint64))
    n_words, n_types = parts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).collect()[0]
    n_items = len(top) + ENDINGS + 1

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_items * n_items, np.int64)
        for batch in batches:
            for blob in batch.column(1):
                _, words, keys, learn = read(blob.as_buffer())
                line, _ = _with_ends(items_of(keys, top), words, n_items - 1)
                use = np.repeat(learn, words.n_words + 1)
                before = _before(line, words, n_items - 1)
                sums += np.bincount(before[use] * n_items + line[use], minlength=n_items * n_items)
        rows = sums.reshape(n_items, n_items)
        for a in range(0, n_items, 64):
            yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([B.squeeze(rows[a : a + 64].ravel())], pa.binary())], names=["row", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(B.spread(x.as_buffer()) for x in table.column("counts"))
        return pa.table({"row": table.column("row").slice(0, 1), "counts": pa.array([B.squeeze(total)], pa.binary())})

    # A table of items x items, whatever the size of the corpus.
    blocks = packed.mapInArrow(pairs, "row long, counts binary").groupBy("row").applyInArrow(add, "row long, counts binary").collect()
    counts = np.zeros((n_items, n_items), np.int64)
    for r in blocks:
        counts[r["row"] : r["row"] + 64] = B.spread(r["counts"]).reshape(-1, n_items)
    of = exchange(counts, classes)
    n_train = int(counts.sum(0)[-1])
    n_tokens = n_words + n_train
    found, joint, types = cluster(asked, numbered, lines, lambda keys: of[items_of(keys, top)], classes, f"{path}/kind=ask")
    delete_table(docs.sparkSession, path)
    with_class = joint.sum(0)
    # A word never seen goes where most training words of its ending are; without any, where most words are.
    unseen = np.where(types.any(1), types.argmax(1), types.sum(0).argmax())
    in_class = types.sum(0)
    in_class[-1] = 1 if n_train else 0
    n_types += in_class[-1]
    model = docs.sparkSession.sparkContext.broadcast(
        {
            "unseen": unseen,
            "step": np.log10((joint + delta) / (joint.sum(1, keepdims=True) + delta * classes)),
            "emit": np.log10(with_class + delta * (in_class + 1)),
            "base": np.log10(n_tokens + 0.5 * (n_types + 1)),
            "train": n_train,
        }
    )

    counted = replied.select("batch", "bucket", F.col("counts").alias("answer"), F.lit("count").alias("kind"))
    replies = counted.unionByName(found.withColumn("kind", F.lit("class")))

    def score(number, tags, texts, kinds) -> pa.Table:
        m = model.value
        words = Words(texts, lower=True)
        keys = word_keys(words)
        names = distinct(words, keys, np.zeros(len(tags), bool))[0]
        known = np.concatenate([B.spread(x) for x in kinds["count"]]) if len(names) else np.empty(0, np.int64)
        of = np.concatenate([_classes(x) for x in kinds["class"]]) if len(names) else known
        of = np.where(known > 0, of, m["unseen"][(names & _LOW).astype(np.int64)])
        place = np.searchsorted(names, keys)
        c, first = _with_ends(known[place], words, m["train"])
        group, _ = _with_ends(of[place], words, classes - 1)
        before = _before(group, words, classes - 1)
        base = np.log10(c + 0.5) - m["base"]
        own = m["step"][before, group] + np.log10(c + delta) - m["emit"][group]
        ids = [int(t[1:]) if len(t) > 1 else None for t in tags]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array([t[0] == "h" for t in tags]),
                "n_tokens": pa.array(words.n_words + 1, pa.int64()),
                "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), first), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, first)),
                "score": pa.array(np.add.reduceat(own, first)),
            }
        )

    found = B.answered(packed, replies, score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def _with_ends(values: np.ndarray, words: Words, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``values`` of the words with one ``end`` after each text, and where each text begins."""
    n = words.n_words + 1
    first = np.cumsum(n) - n
    out = np.full(int(n.sum()), end, np.int64)
    inside = np.ones(len(out), bool)
    inside[first + words.n_words] = False
    out[inside] = values
    return out, first


def _before(line: np.ndarray, words: Words, end: int) -> np.ndarray:
    """What stands before each token; an end before the first of a text (which is also what stands there)."""
    return np.concatenate(([end], line[:-1])) if len(line) else line
