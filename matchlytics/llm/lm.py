"""A hashed maximum-entropy language model with a class-factored softmax, and the smoothed unigram model beside it.

P(word | before) = P(class | before) * P(word | class, before), two softmaxes, both with features of the words before:

* class: the class before (bigram), the two before (trigram, hashed) and the one before that (skip), whose weights have a fixed
  size and whose gradients are sums over the cluster; and, on top, the word before and the two words before with the class.
* word in its class: its smoothed count there, the word before with it and the two words before with it.

The features of words are a table that grows with the corpus. It is dealt by a hash of the word before to shards, so that all
that shares a feature is in one shard; there its gradients are summed and its weights are learned, and there every token is scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from matchlytics.llm.common import blocks, on_workers, stored, utf8
from matchlytics.llm.sums import vector_sum

#: Closes every document. It has white space, so no word is like it.
END = b"\n"
SMOOTH = 0.1
#: Frequent words are classes of their own (the end is the last of them); others share classes by their last bytes.
OWN, GROUPS, SPLIT = 64, 8, 8
CLASSES = OWN + GROUPS * SPLIT
SUFFIXES = 4096
#: Rows of the weights: bias, class before, skip, and buckets of hashed trigrams.
BUCKETS = 4096
TRIGRAMS = BUCKETS - 1 - 2 * CLASSES
#: What an exponential prior takes from a feature's count, and how often the weights of words are gone over.
DISCOUNT, PASSES = 0.75, 4
#: Counts of places go from tasks to their sums in so many ranges.
RANGES = 64


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def token_block(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct tokens of several texts, the number of each token in order, and where each text begins and the last ends."""
    found = [tokens(t) for t in texts]
    bounds = np.append(0, np.cumsum([len(f) for f in found], dtype=np.int64))
    coded = pa.array(list(chain.from_iterable(found)), pa.large_binary()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds


def suffix_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIXES


@dataclass
class Classes:
    """Which class a word belongs to; of fixed size."""

    own: dict[bytes, int]
    by_suffix: np.ndarray

    def of(self, word: bytes) -> int:
        return self.own[word] if word in self.own else int(self.by_suffix[suffix_of(word)])


def feature_rows(before: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """The weights' rows for each context: bias, bigram, skip, hashed trigram."""
    pair = (before * CLASSES + skip).astype(np.uint64)
    hashed = (pair * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % TRIGRAMS
    return np.stack([np.zeros_like(before), 1 + before, 1 + CLASSES + skip, 1 + 2 * CLASSES + hashed], axis=-1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 on, compressed; each in as few bytes as its largest takes, first bytes with first bytes."""
    small = [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
    head = np.array([x for a in small for x in (a.itemsize, len(a))], np.int64)
    body = head.tobytes() + b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in small)
    return np.array([len(arrays), len(body)], np.int64).tobytes() + pa.compress(body, "zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    count, size = np.frombuffer(data[:16], np.int64).tolist()
    body = np.frombuffer(pa.decompress(data[16:], size, "zstd", asbytes=True), np.uint8)
    out, at = [], 16 * count
    for width, n in body[:at].view(np.int64).reshape(-1, 2).tolist():
        planes = np.ascontiguousarray(body[at : at + width * n].reshape(width, n).T)
        out.append(planes.view(f"u{width}").ravel().astype(np.int64))
        at += width * n
    return out


def risen(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two arrays sorted by the first and then the second as steps up, which ``pack`` makes smaller; a new value of the first starts the second anew."""
    up, then = np.diff(first, prepend=first.dtype.type(0)), np.diff(second, prepend=second.dtype.type(0))
    return up, np.where(up > 0, second, then)


def climbed(up: np.ndarray, then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``risen`` was given."""
    starts = np.flatnonzero(np.append(True, up[1:] > 0))[: len(up)]
    total = np.cumsum(then)
    return np.cumsum(up), total - np.repeat(total[starts] - then[starts], np.diff(np.append(starts, len(up))))


def chunked(rows: DataFrame, chunk_tokens: int) -> DataFrame:
    """(chunk, ids, train, words, tokens), written: texts of one task, about ``chunk_tokens`` tokens a row, as numbers of the chunk's words.

    ``words`` are squeezed; ``tokens`` packs the tokens and the texts' bounds.
    """
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)), T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("words", T.BinaryType()), T.StructField("tokens", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        index: dict[bytes, int] = {}
        ids, train, found, sizes = [], [], [], []

        def flush() -> pa.RecordBatch:
            texts = [pa.concat_arrays(x) for x in (ids, train)]
            token = np.concatenate(found)
            order = np.argsort(-np.bincount(token, minlength=len(index)), kind="stable")
            place = np.empty(len(order), np.int32)  # frequent words first, so most numbers are small
            place[order] = np.arange(len(order), dtype=np.int32)
            words = [*index]
            tokens = pack(place[token], np.append(0, np.cumsum(np.concatenate(sizes))))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in texts]
            columns = [pa.array([base + made]), *lists, pa.array([squeeze([words[k] for k in order.tolist()])], pa.binary()), pa.array([tokens], pa.binary())]
            for x in (index, ids, train, found, sizes):
                x.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        held = 0
        for batch in batches:
            for part in blocks(batch, "text"):
                distinct, token, bounds = token_block(utf8(part.column(1)))
                found.append(np.array([index.setdefault(w, len(index)) for w in distinct], np.int64)[token].astype(np.int32))
                sizes.append(np.diff(bounds))
                ids.append(part.column(0))
                train.append(part.column(2))
                held += len(token)
                if held >= chunk_tokens:
                    yield flush()
                    made, held = made + 1, 0
        if held:
            yield flush()

    on_workers(rows.sparkSession)
    return stored(rows.mapInArrow(run, schema))


def words_of(data: bytes) -> list[bytes]:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True).split(b" ")


def learned(train: np.ndarray, token: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and bounds of the texts that are learned from."""
    sizes = np.diff(bounds)
    return token[np.repeat(train, sizes)], np.append(0, np.cumsum(sizes[train]))


def map_chunks(chunks: DataFrame, make: Callable[[], Callable[[tuple | None], dict | None]], schema: str) -> DataFrame:
    """``mapInArrow`` over chunks: the function that ``make`` gives takes number, words, tokens and bounds of learned texts; last it gets None."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for k in range(batch.num_rows):
                train = batch.column(1).slice(k, 1).flatten().to_numpy(zero_copy_only=False).astype(bool)
                own = step((batch.column(0)[k].as_py(), words_of(batch.column(2)[k].as_py()), *learned(train, *unpack(batch.column(3)[k].as_py()))))
                if own:
                    yield pa.RecordBatch.from_pydict(own)
        if own := step(None):
            yield pa.RecordBatch.from_pydict(own)

    on_workers(chunks.sparkSession)
    return chunks.select("chunk", "train", "words", "tokens").mapInArrow(run, schema)


def squeeze(words: list[bytes]) -> bytes:
    """Words joined by spaces and compressed; ``words_of`` gives them back."""
    joined = b" ".join(words)
    return len(joined).to_bytes(8, "little") + pa.compress(joined, "zstd", asbytes=True)


def buckets_of(words: list[bytes], buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words], np.int64) % buckets


def by_bucket(found: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of words in the order of their buckets, and where each bucket begins and the last ends."""
    return np.argsort(found, kind="stable"), np.append(0, np.cumsum(np.bincount(found, minlength=buckets)))


def bucketed(chunks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, words, n): the words of each chunk by the bucket of their hash, and how often learned texts have them."""

    def make():
        def step(chunk):
            if chunk is None:
                return None
            key, words, token, _ = chunk
            n = np.bincount(token, minlength=len(words))
            order, ends = by_bucket(buckets_of(words, buckets), buckets)
            there = np.flatnonzero(np.diff(ends))
            at = [order[ends[k] : ends[k + 1]] for k in there.tolist()]
            texts = [squeeze([words[x] for x in places.tolist()]) for places in at]
            return {"bucket": there, "chunk": np.full(len(there), key), "words": pa.array(texts, pa.binary()), "n": pa.array([pack(n[places]) for places in at], pa.binary())}

        return step

    return map_chunks(chunks, make, "bucket long, chunk long, words binary, n binary")


def wordless(chunks: DataFrame, buckets: int) -> DataFrame:
    """(chunk, ids, train, places, tokens): the buckets of the words, packed, instead of the words, which are not sent on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk, ids, train, words, tokens = batch.slice(k, 1).columns
                places = pa.array([pack(buckets_of(words_of(words[0].as_py()), buckets))], pa.binary())
                yield pa.RecordBatch.from_arrays([chunk, ids, train, places, tokens], names=schema.names)

    schema = T.StructType([T.StructField("places", T.BinaryType()) if f.name == "words" else f for f in chunks.schema])
    on_workers(chunks.sparkSession)
    return chunks.mapInArrow(run, schema)


def token_counts(words: DataFrame) -> DataFrame:
    """(token, n) of all learned texts, from words by buckets: all of a word are in one."""

    def add_up(table: pa.Table) -> pa.Table:
        coded = pa.array(list(chain.from_iterable(words_of(w) for w in table["words"].to_pylist())), pa.large_binary()).dictionary_encode()
        n = np.concatenate([unpack(x)[0] for x in table["n"].to_pylist()])
        total = np.bincount(coded.indices.to_numpy(), weights=n, minlength=len(coded.dictionary)).astype(np.int64)
        there = np.flatnonzero(total)
        return pa.table({"token": coded.dictionary.take(pa.array(there)).cast(pa.binary()), "n": total[there]})

    return words.groupBy("bucket").applyInArrow(add_up, "token binary, n long")


def look_up(words: DataFrame, numbered: DataFrame, buckets: int, classes: Classes) -> DataFrame:
    """(chunk, bucket, numbers): those of the words of each bucket of a chunk, in their order; not learned: the word's class."""
    shared = words.sparkSession.sparkContext.broadcast(classes)

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        known, number = pa.concat_arrays([*right["token"].chunks, pa.array([], pa.binary())]), np.append(right["number"].to_numpy(), 0)
        lists = [words_of(w) for w in left["words"].to_pylist()]
        flat = list(chain.from_iterable(lists))
        numbers = number[pc.fill_null(pc.index_in(pa.array(flat, pa.binary()), value_set=known), len(known)).to_numpy()]
        for k in np.flatnonzero(numbers == 0).tolist():
            numbers[k] = shared.value.of(flat[k])
        found = np.split(numbers, np.cumsum([len(x) for x in lists])[:-1])
        return pa.table({"chunk": left["chunk"], "bucket": left["bucket"], "numbers": pa.array([pack(x) for x in found], pa.binary())})

    dealt_out = numbered.select(F.pmod(F.crc32("token"), F.lit(buckets)).alias("bucket"), "token", "number")
    return words.select("bucket", "chunk", "words").groupBy("bucket").cogroup(dealt_out.groupBy("bucket")).applyInArrow(look, "chunk long, bucket long, numbers binary")


def _binned(chunks: DataFrame, size: int, places: Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(place, n): how often each place comes up in all learned texts; added up in the tasks first, and packed by ranges of places.

    ``places`` goes from words, tokens and bounds to places.
    """
    span = -(-size // RANGES)

    def make():
        total = np.zeros(size, np.int64)

        def step(chunk):
            if chunk is None:
                where = np.flatnonzero(total)
                if not len(where):
                    return None
                cuts = np.searchsorted(where, np.arange(RANGES + 1) * span)
                there = np.flatnonzero(np.diff(cuts))
                own = [where[cuts[k] : cuts[k + 1]] for k in there.tolist()]
                return {"part": there, "data": pa.array([pack(np.diff(x, prepend=k * span), total[x]) for k, x in zip(there.tolist(), own)], pa.binary())}
            found = places(*chunk[1:])
            if len(found) > size // 8:
                total[:] += np.bincount(found, minlength=size)
            else:
                np.add.at(total, found, 1)
            return None

        return step

    def add_up(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        total, start = np.zeros(span, np.int64), key[0].as_py() * span
        for data in table["data"]:
            steps, n = unpack(data.as_py())
            total[np.cumsum(steps)] += n
        where = np.flatnonzero(total)
        return pa.table({"place": start + where, "n": total[where]})

    return map_chunks(chunks, make, "part long, data binary").groupBy("part").applyInArrow(add_up, "place long, n long")


def make_classes(chunks: DataFrame, counts: DataFrame) -> Classes:
    """Frequent words, and for the endings of others the frequent words that they are found after.

    Endings after the same frequent words (of one language, say) come into one of GROUPS groups.
    """
    top = [bytes(r["token"]) for r in counts.where(F.col("token") != F.lit(bytearray(END))).orderBy(F.desc("n"), "token").limit(OWN - 1).collect()]
    own = {w: k for k, w in enumerate(top)} | {END: OWN - 1}

    def places(distinct: list[bytes], token: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        frequent = np.array([own.get(w, -1) for w in distinct], np.int64)[token]
        ending = np.array([suffix_of(w) for w in distinct], np.int64)[token]
        frequent[bounds[1:] - 1] = -1  # the end of a text is before nothing, and no word after it
        rest = frequent < 0
        rest[bounds[1:] - 1] = False
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        found = []
        for back in (1, 2):
            keep = (frequent[:-back] >= 0) & rest[back:] & (text[:-back] == text[back:])
            found.append(ending[back:][keep] * OWN + frequent[:-back][keep])
        return np.concatenate(found)

    binned = _binned(chunks, SUFFIXES * OWN, places)
    table = np.zeros(SUFFIXES * OWN)
    for r in binned.collect():  # at most SUFFIXES * OWN rows
        table[r["place"]] = r["n"]
    table = table.reshape(SUFFIXES, OWN)
    share = table / np.sqrt(table.sum(0) + 1)
    best = share.argmax(1)
    mass = np.bincount(best, weights=table.sum(1), minlength=OWN)
    group = np.full(OWN, GROUPS - 1)
    group[np.argsort(-mass, kind="stable")[: GROUPS - 1]] = np.arange(GROUPS - 1)
    return Classes(own, OWN + group[best] * SPLIT + np.arange(SUFFIXES) % SPLIT)


def contexts(own: np.ndarray, bounds: np.ndarray, end: int = OWN - 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class (or number) of each token, of the one before and the one before that, for texts laid end to end; before a text stands its end."""
    before, skip = np.roll(own, 1), np.roll(own, 2)
    starts = bounds[:-1]  # no text is without tokens
    before[starts] = skip[starts] = end
    second = starts + 1
    skip[second[second < bounds[1:]]] = end
    return own, before, skip


def context_counts(chunks: DataFrame, classes: Classes) -> DataFrame:
    """(place, n) of (skip, class before, class) as one number; before a text stands its end. The words' own features: ``fit``."""
    shared = chunks.sparkSession.sparkContext.broadcast(classes)

    def places(distinct: list[bytes], token: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        own, before, skip = contexts(np.array([shared.value.of(w) for w in distinct], np.int64)[token], bounds)
        return (skip * CLASSES + before) * CLASSES + own

    return _binned(chunks, CLASSES**3, places)


def logits(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return weights[rows].sum(axis=-2)


def train(counts: DataFrame, rounds: int = 12, parts: int = 8) -> np.ndarray:
    """The weights. Each round sums, for every row of weights, what the counts have above what the model expects.

    The step of a weight is the logarithm of observed to expected count over the number of features that a context has,
    which never lowers the likelihood. The counts' table is bounded by the classes, so are its parts and what they send.
    """
    table = stored(counts.repartition(parts, F.floor(F.col("place") / CLASSES)).sortWithinPartitions("place"))
    weights = np.zeros((BUCKETS, CLASSES), np.float32)
    totals = vector_sum(table, CLASSES, lambda b: np.bincount(b.column(0).to_numpy() % CLASSES, weights=b.column(1).to_numpy(), minlength=CLASSES))
    weights[0] = np.log((totals + SMOOTH) / (totals.sum() + SMOOTH * CLASSES))
    context = table.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(weights)

        def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = shared.value
            observed, expected = np.zeros((2, BUCKETS, CLASSES), np.float32)
            for batch in batches:
                places, n = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.float64)
                contexts, where = np.unique(places // CLASSES, return_inverse=True)
                for lo in range(0, len(contexts), 4096):
                    own = contexts[lo : lo + 4096]
                    at = (where >= lo) & (where < lo + len(own))
                    seen = np.zeros((len(own), CLASSES))
                    seen[where[at] - lo, places[at] % CLASSES] = n[at]
                    rows = feature_rows(own % CLASSES, own // CLASSES)
                    z = logits(w, rows)
                    p = np.exp(z - z.max(1, keepdims=True))
                    p *= seen.sum(1, keepdims=True) / p.sum(1, keepdims=True)
                    for k in range(rows.shape[1]):
                        np.add.at(observed, rows[:, k], seen)
                        np.add.at(expected, rows[:, k], p)
            used = np.flatnonzero(expected.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array([x.tobytes() for x in (observed - expected)[used]], pa.binary()), pa.array([x.tobytes() for x in expected[used]], pa.binary())],
                names=["row", "gradient", "expected"],
            )

        gradient, expected = np.zeros((2, BUCKETS, CLASSES))
        for r in table.mapInArrow(sums, "row long, gradient binary, expected binary").toLocalIterator():
            gradient[r["row"]] += np.frombuffer(r["gradient"], np.float32)
            expected[r["row"]] += np.frombuffer(r["expected"], np.float32)
        weights = (weights + np.log1p(np.maximum(gradient / (expected + 0.5), -0.95)) / 4).astype(np.float32)
        shared.unpersist()
    return weights


def log_partition(weights: np.ndarray) -> np.ndarray:
    """The logarithm of the softmax's sum for each context."""
    out = np.empty(CLASSES * CLASSES)
    for skip in range(CLASSES):
        z = logits(weights, feature_rows(np.arange(CLASSES), np.full(CLASSES, skip)))
        top = z.max(1)
        out[skip * CLASSES : (skip + 1) * CLASSES] = top + np.log(np.exp(z - top[:, None]).sum(1))
    return out


#: Words of a class are numbered by count in so many cells, 1 the most frequent one; 0: the class's unknown words.
CELLS = 16 * CLASSES
LOW = (1 << 32) - 1


@dataclass
class Counts:
    """The count of a word from its number: of each cell, at which number another count begins. No words are in it."""

    first: np.ndarray
    n: np.ndarray
    mass: np.ndarray

    def of(self, number: np.ndarray) -> np.ndarray:
        rank = number // CELLS
        if not len(self.n):
            return np.zeros(len(number))
        at = np.searchsorted(self.first, (number % CELLS << 40) + rank, "right") - 1
        return np.where(rank > 0, self.n[at], 0).astype(float)

    def share(self, number: np.ndarray) -> np.ndarray:
        """The smoothed share of a word in its class; words of a class of their own are certain in it."""
        kind = number % CLASSES
        return np.where(kind < OWN, 1.0, (self.of(number) + SMOOTH) / self.mass[kind])


def number_words(counts: DataFrame, classes: Classes) -> tuple[DataFrame, Counts]:
    """(token, number): number % CLASSES is the word's class; and what gives the counts of numbers."""
    shared = counts.sparkSession.sparkContext.broadcast(classes)

    def kinds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            found = [shared.value.of(w) + CLASSES * (zlib.crc32(w) >> 28) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["token", "n", "cell"])

    celled = counts.mapInArrow(kinds, "token binary, n long, cell long")
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("n"), "token"))
    numbered = stored(celled.select("token", "n", "cell", (rank.cast("long") * CELLS + F.col("cell")).alias("number")))
    steps = numbered.groupBy("cell", "n").agg(F.min("number").alias("number"), F.count("*").alias("words")).toPandas().sort_values("number")
    cell, n, words = (steps[c].to_numpy(np.int64) for c in ("cell", "n", "words"))
    first = (cell << 40) + steps["number"].to_numpy(np.int64) // CELLS
    order = np.argsort(first, kind="stable")
    kind = cell % CLASSES
    mass = np.bincount(kind, weights=n * words, minlength=CLASSES) + SMOOTH * (np.bincount(kind, weights=words, minlength=CLASSES) + 1)
    return numbered.select("token", "number"), Counts(first[order], n[order], mass)


def halved(numbers: np.ndarray) -> np.ndarray:
    """The numbers in half the memory, if they are small enough, as they are for all but very large vocabularies."""
    return numbers.astype(np.int32) if numbers.max(initial=0) < (1 << 31) - 1 else numbers


def dealt(number: np.ndarray, mixed: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each pair of numbers."""
    key = number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mixed.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((key >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def events(number: np.ndarray, bounds: np.ndarray, train: np.ndarray, end: int, shards: int) -> Iterator[tuple[int, bytes]]:
    """For each shard the tokens of a chunk that it learns from and scores, which ``sent`` gives back: word, word before, skipped word, document, parts.

    Part 1 is the class's softmax, part 2 the word's. Both go by the word before; if that is a class of its own, and so may be
    before a large part of all tokens, part 1 goes by the two words before, part 2 by the word before and the class. Part 1 alone
    takes the word's class in place of the word.
    """
    word, before, skip = contexts(halved(number), bounds, end)
    doc = np.repeat((np.arange(len(train)) * 2 + train).astype(np.int32), np.diff(bounds))
    own = before % CLASSES < OWN
    again = np.flatnonzero(own & (word % CLASSES >= OWN)).astype(np.int32)
    small = np.min_scalar_type(shards)
    shard = np.concatenate([dealt(before, np.where(own, skip + 1, 0), shards).astype(small), dealt(before[again], word[again] % CLASSES + 1, shards).astype(small)])
    part = np.concatenate([np.where(own, 1, 3).astype(np.uint8), np.full(len(again), 2, np.uint8)])
    word = np.concatenate([np.where(own, word % CLASSES, word), word[again]])
    token = np.concatenate([np.arange(len(before), dtype=np.int32), again])
    del own, again
    ends = np.append(0, np.cumsum(np.bincount(shard, minlength=shards)))
    order = np.argsort(before[token].astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)).astype(np.int32)  # for small steps
    order = order[np.argsort(shard[order], kind="stable")]
    word, token, part = word[order], token[order], part[order]
    del shard, order
    for k in np.flatnonzero(np.diff(ends)).tolist():
        own = slice(ends[k], ends[k + 1])
        at = token[own]
        yield k, pack(*risen(before[at], word[own]), skip[at], doc[at], part[own])


def sent(data: bytes) -> list[np.ndarray]:
    """The tokens of a chunk for a shard: word, word before, skipped word, document, parts."""
    up, then, *rest = unpack(data)
    before, word = climbed(up, then)
    return [halved(a) for a in (word, before, *rest)]


def raised(e: np.ndarray, n: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Weights (as factors) after a full step: of one kind of features a token has one at most, so it never lowers the likelihood.

    The exponential prior takes DISCOUNT from each count and keeps weights from falling below nothing (a factor of 1).
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((n > DISCOUNT) & (expected > 0), np.maximum(e * (n - DISCOUNT) / expected, 1), 1.0)


def fit_words(word: np.ndarray, before: np.ndarray, skip: np.ndarray, n: np.ndarray, counts: Counts) -> np.ndarray:
    """The logarithm of P(word | class, before) of each token; learned from those with ``n`` 1.

    Features besides the share: (before, word) and (skip, before, word). A sum over all words of a class is 1 plus what
    the words with features add to their shares.
    """
    pairs, b = np.unique(before.astype(np.int64) << 32 | word, return_inverse=True)
    triples, triple = np.unique(b << 32 | skip, return_inverse=True)
    b = triples >> 32
    n_t = np.bincount(triple, weights=n, minlength=len(triples))
    n_b = np.bincount(b, weights=n_t, minlength=len(pairs))
    groups, g = np.unique(pairs >> 32 << 32 | (pairs & LOW) % CLASSES, return_inverse=True)
    places, k = np.unique(g[b] << 32 | triples & LOW, return_inverse=True)
    g_k = places >> 32
    n_k = np.bincount(k, weights=n_t, minlength=len(places))
    share = counts.share(pairs & LOW)
    e_b, e_t = np.ones(len(pairs)), np.ones(len(triples))

    def state() -> tuple[np.ndarray, np.ndarray]:
        plain = (share * e_b)[b]
        total = 1 + np.bincount(g, weights=share * (e_b - 1), minlength=len(groups))
        return plain, total[g_k] + np.bincount(k, weights=plain * (e_t - 1), minlength=len(places))

    for _ in range(PASSES):
        plain, z = state()
        ratio = n_k / z
        more = np.bincount(b, weights=ratio[k] * plain * (e_t - 1), minlength=len(pairs))
        e_b = raised(e_b, n_b, share * e_b * np.bincount(g_k, weights=ratio, minlength=len(groups))[g] + more)
        plain, z = state()
        e_t = raised(e_t, n_t, (n_k / z)[k] * plain * e_t)
    plain, z = state()
    return np.log(plain * e_t / z[k])[triple]


def fit_classes(kind: np.ndarray, before: np.ndarray, skip: np.ndarray, n: np.ndarray, model: np.ndarray) -> np.ndarray:
    """The logarithm of P(class | before) of each token; learned from those with ``n`` 1.

    Features besides those of ``model`` (the probabilities by skipped class and class before): (before, class), unless the
    word before is a class of its own and its weight is in the model, and (skip, before, class).
    """
    places, k = np.unique(before.astype(np.int64) << 32 | skip, return_inverse=True)
    triples, triple = np.unique(k * CLASSES + kind, return_inverse=True)
    k, c = np.divmod(triples, CLASSES)
    n_t = np.bincount(triple, weights=n, minlength=len(triples))
    rows, row_k = np.unique((places >> 32) * CLASSES + (places & LOW) % CLASSES, return_inverse=True)
    _, starts, word_row = np.unique(rows // CLASSES, return_index=True, return_inverse=True)
    out = np.empty(len(triples))
    cuts = [0]
    while cuts[-1] < len(starts):  # some words before at a time; all arrays are sorted by them
        limit = starts[cuts[-1]] + 8192
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(np.append(starts, len(rows)), limit, "right")) - 1))
    edges = np.append(starts, len(rows))[cuts]
    k_edges = np.searchsorted(places >> 32, np.append(rows // CLASSES, LOW)[edges])
    t_edges = np.searchsorted(k, k_edges)
    for j in range(len(cuts) - 1):
        rs, ks, ts = (slice(e[j], e[j + 1]) for e in (edges, k_edges, t_edges))
        out[ts] = _fit_rows(model, rows[rs], word_row[rs] - cuts[j], starts[cuts[j] : cuts[j + 1]] - edges[j], row_k[ks] - edges[j], k[ts] - k_edges[j], c[ts], n_t[ts])
    return out[triple]


def _fit_rows(model: np.ndarray, rows: np.ndarray, word: np.ndarray, starts: np.ndarray, row_k: np.ndarray, k: np.ndarray, c: np.ndarray, n_t: np.ndarray) -> np.ndarray:
    """``fit_classes`` for some words before: the logarithm for each triple."""
    before = rows // CLASSES % CLASSES
    q = model[rows % CLASSES * CLASSES + before]
    n_k = np.bincount(k, weights=n_t, minlength=len(row_k))
    row, size = row_k[k], len(starts) * CLASSES
    cell = word[row] * CLASSES + c
    n_b = np.bincount(cell, weights=n_t, minlength=size).reshape(-1, CLASSES)
    n_b[before[starts] < OWN] = 0
    e_b, e_t, q_t = np.ones((len(starts), CLASSES)), np.ones(len(k)), q[row, c].astype(float)

    def state() -> tuple[np.ndarray, np.ndarray]:
        plain = q_t * e_b.ravel()[cell]
        total = np.einsum("rc,rc->r", q, e_b.astype(np.float32)[word]).astype(float)
        return plain, total[row_k] + np.bincount(k, weights=plain * (e_t - 1), minlength=len(row_k))

    for _ in range(PASSES):
        plain, z = state()
        ratio = n_k / z
        dense = np.add.reduceat(q * np.bincount(row_k, weights=ratio, minlength=len(rows))[:, None], starts)
        more = np.bincount(cell, weights=ratio[k] * plain * (e_t - 1), minlength=size).reshape(-1, CLASSES)
        e_b = raised(e_b, n_b, e_b * dense + more)
        plain, z = state()
        e_t = raised(e_t, n_t, (n_k / z)[k] * plain * e_t)
    plain, z = state()
    return np.log(plain * e_t / z[k])


def probabilities(weights: np.ndarray) -> np.ndarray:
    """The class model's softmax for each context, as rows by skip * CLASSES + before."""
    out, parts = np.empty((CLASSES * CLASSES, CLASSES), np.float32), log_partition(weights)
    for skip in range(CLASSES):
        own = slice(skip * CLASSES, (skip + 1) * CLASSES)
        out[own] = np.exp(logits(weights, feature_rows(np.arange(CLASSES), np.full(CLASSES, skip))) - parts[own, None])
    return out / out.sum(1, keepdims=True)


def fit(word: np.ndarray, before: np.ndarray, skip: np.ndarray, n: np.ndarray, part: np.ndarray, model: np.ndarray, counts: Counts) -> np.ndarray:
    """What a shard adds to the logarithm of each token's probability: the class's part, the word's, or both."""
    out = np.zeros(len(word))
    at = np.flatnonzero(part & 1)
    out[at] += fit_classes(word[at] % CLASSES, before[at], skip[at], n[at], model)
    at = np.flatnonzero((part & 2 > 0) & (word % CLASSES >= OWN))
    out[at] += fit_words(word[at], before[at], skip[at], n[at], counts)
    return out


def score_documents(docs: DataFrame, train_on: Column, doc_id: str = "doc_id", text: str = "text", rounds: int = 12, chunk_tokens: int = 1_800_000, shard_tokens: int = 1_200_000) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``train_on`` says which rows are learned from (null: not). Scores are base-10 logarithms of a text's probability: base
    under unigrams with 0.1 added to counts and one place for unknown tokens, score under the model. Texts are lower-cased
    (A-Z), split at ASCII white space and closed by an end token; null is the empty text. Texts are laid in chunks of about
    ``chunk_tokens`` tokens; each chunk's distinct tokens are looked up by buckets of their hash, so no task holds more of the
    vocabulary than its texts or its bucket have. A chunk's tokens with the words before them go to shards of about ``shard_tokens``,
    which learn the weights of words and score; their sums go back to the chunk. Without training rows all tokens are unknown.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.coalesce(train_on, F.lit(False)).alias("train"))
    chunks = chunked(rows, chunk_tokens)
    buckets = 1 + chunks.count() // 4
    words = bucketed(chunks, buckets)
    counts = stored(token_counts(words))
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, unseen = size["n"], size["n"] + SMOOTH * (size["v"] + 1)
    classes = make_classes(chunks, counts)
    weights = train(context_counts(chunks, classes), rounds)
    numbered, known = number_words(counts, classes)
    shards = 1 + total // shard_tokens
    shared = docs.sparkSession.sparkContext.broadcast((weights, known))

    found = look_up(words, numbered, buckets, classes)
    piece = [T.StructField("chunk", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("id", docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("data", T.BinaryType())]
    dealing = T.StructType([T.StructField("shard", T.LongType()), *piece])

    def table_of(columns: dict, schema: T.StructType) -> pa.Table:
        rows = max(map(len, columns.values()))
        kinds = to_arrow_schema(schema)
        return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in kinds], schema=kinds)

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        _, known = shared.value
        chunk, texts = left["chunk"][0].as_py(), left["ids"].combine_chunks().flatten()
        learn = left["train"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(bool)
        token, bounds = unpack(left["tokens"][0].as_py())
        order, ends = by_bucket(unpack(left["places"][0].as_py())[0], buckets)
        number = np.zeros(len(order), np.int64)
        for k, data in zip(right["bucket"].to_pylist(), right["numbers"].to_pylist()):
            number[order[ends[k] : ends[k + 1]]] = unpack(data)[0]
        n = known.of(number)
        base = np.add.reduceat(np.log10((n + SMOOTH) / unseen)[token], bounds[:-1])
        seen = np.add.reduceat((n > 0).astype(np.int64)[token], bounds[:-1])
        own = {"shard": np.full(len(texts), chunk % shards), "chunk": np.full(len(texts), chunk), "doc": np.arange(len(texts)), "id": texts, "n_tokens": np.diff(bounds), "n_known": seen, "base_score": base}
        number = number[token]
        end = int(number[bounds[1] - 1])  # of the first text; each has one
        del order, token, n
        away = list(events(number, bounds, learn, end, shards))
        blobs = {"shard": [k for k, _ in away], "chunk": [chunk] * len(away), "data": [d for _, d in away]}
        return pa.concat_tables([table_of(own, dealing), table_of(blobs, dealing)])

    def learn_and_score(table: pa.Table) -> pa.Table:
        weights, known = shared.value
        data = pc.is_valid(table["data"])
        found, rest = table.filter(data), table.filter(pc.invert(data)).drop_columns(["shard"])
        if not found.num_rows:
            return rest
        parts = [sent(d.as_py()) for d in found["data"]]
        sizes = np.array([len(p[0]) for p in parts])
        word, before, skip, doc, part = (np.concatenate(x) for x in zip(*parts))
        del parts
        z = fit(word, before, skip, doc & 1, part, probabilities(weights), known)
        sums = []
        for a, b in zip((np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist()):
            where, place = np.unique(doc[a:b] >> 1, return_inverse=True)
            sums.append(pack(np.diff(where, prepend=0), np.bincount(place, weights=z[a:b]).astype(np.float32).view(np.uint32)))
        return pa.concat_tables([rest, table_of({"chunk": found["chunk"].combine_chunks(), "data": sums}, T.StructType(piece))])

    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType)] + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score")])

    def add(table: pa.Table) -> pa.Table:
        data = pc.is_valid(table["data"])
        rows = table.filter(pc.invert(data)).sort_by("doc")
        score = np.zeros(rows.num_rows)
        for steps, z in map(unpack, sorted(table.filter(data)["data"].to_pylist())):  # in one order, so that sums don't depend on arrival
            score[np.cumsum(steps)] += z.astype(np.uint32).view(np.float32)
        columns = {doc_id: rows["id"].combine_chunks(), "score": score / np.log(10), "train_tokens": np.full(rows.num_rows, total)}
        return table_of(columns | {n: rows[n].combine_chunks() for n in ("n_tokens", "n_known", "base_score")}, schema)

    dealt_out = wordless(chunks, buckets).groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(deal, dealing)
    return dealt_out.groupBy("shard").applyInArrow(learn_and_score, T.StructType(piece)).groupBy("chunk").applyInArrow(add, schema)
