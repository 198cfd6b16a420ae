"""Substring dedup by words: windows of words that occur earlier are removed, found by sharded Aho-Corasick automata.

Content-defined anchors say where windows may recur, and deal the stretches of all documents that hold such windows out to
shards, so that equal windows meet in one. A shard confirms the passages that do recur, compiles them into one automaton of
word numbers, and streams its stretches through it to find every occurrence.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from matchlytics.llm.anchors import Rolling, mixed
from matchlytics.llm.common import fresh, map_blocks, on_workers, stored, tasks, utf8
from matchlytics.llm.suffix_dedup import RANGES, anchored_runs, ranges_of, segments_of, tag_of

GRAM = 5
#: Bytes of stretches that one automaton is made for.
SHARD = 1 << 20


def word_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = [t.split() for t in texts]
    bounds = np.append(0, np.cumsum([len(w) for w in found]))
    return np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(found)), np.uint64, int(bounds[-1])), bounds


def _split(text: bytes) -> list[bytes]:
    return text.split()


def _join(words: list[bytes], a: int, b: int) -> bytes:
    return b" ".join(words[a:b])


def _passages(later: np.ndarray, least: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of later windows that follow each other, and whose earliest ones do too: first window and number of each run."""
    k = np.flatnonzero(later)
    new = np.ones(len(k), bool)
    on = (np.diff(k) == 1) & (np.diff(least[k]) == 1) & (np.diff(owner[k]) == 0) & (np.diff(owner[least[k]]) == 0)
    new[1:] = ~on
    heads = np.flatnonzero(new)
    return k[heads], np.diff(np.append(heads, len(k)))


def later_windows(rows: list[dict], length: int, salt: int = 0) -> list[np.ndarray]:
    """For each stretch (``data``, ``count`` windows, its earliest ``id`` and ``first``): which windows occur earlier.

    Rolling hashes of word numbers propose passages that recur, as long as they go on alike; an automaton of those passages
    streams through the stretches that hold them and says where they do occur. Places are ordered by id, null first, then by
    start. A proposal that the automaton doesn't find at its earliest place is a collision, and others hashes are taken.
    """
    counts = np.array([row["count"] for row in rows], np.int64)
    owner = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    split = [row["data"].split() for row in rows]
    starts = np.append(0, np.cumsum([len(w) for w in split], dtype=np.int64))
    numbers = pa.array(list(chain.from_iterable(split)), pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64) + np.uint64(1)
    del split
    at = starts[owner] + offset
    hashes = Rolling(mixed(numbers + np.uint64(salt << 40)))(at, at + length)
    ids = [(row["id"] is not None, row["id"] if row["id"] is not None else 0) for row in rows]
    order = {x: n for n, x in enumerate(sorted(set(ids)))}
    base = np.array([order[x] << 32 for x in ids], np.int64) + np.array([row["first"] for row in rows], np.int64)
    place = base[owner] + offset
    sorting = np.lexsort((place, hashes))
    same = np.concatenate([[False], np.diff(hashes[sorting]) == 0]) if len(sorting) else np.zeros(0, bool)
    least = np.empty(len(owner), np.int64)
    least[sorting] = sorting[np.maximum.accumulate(np.where(same, 0, np.arange(len(sorting))))]
    later = place > place[least]
    out = [np.zeros(row["count"], bool) for row in rows]
    if not later.any():
        return out
    heads, sizes = _passages(later, least, owner)
    lines = {int(k): tuple(numbers[starts[k] : starts[k + 1]].tolist()) for k in np.unique(np.concatenate([owner[later], owner[least[later]]]))}
    known: dict[tuple, int] = {}
    number = np.array([known.setdefault(lines[k][o : o + n + length - 1], len(known)) for k, o, n in zip(owner[heads].tolist(), offset[heads].tolist(), sizes.tolist())])
    shard = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for passage, n in known.items():
        shard.add_word(passage, n)
    shard.make_automaton()
    windows = np.array([len(passage) - length + 1 for passage in known], np.int64)
    first = np.full(len(known), np.iinfo(np.int64).max)
    for k, begin, n in _occurrences(shard, lines, windows, length):
        np.minimum.at(first, n, base[k] + begin)
    if (first[number] > place[least[heads]]).any():
        return later_windows(rows, length, salt + 1)
    cover = np.zeros(len(owner) + 1, np.int64)
    start = np.cumsum(counts) - counts
    for k, begin, n in _occurrences(shard, lines, windows, length):
        again = base[k] + begin > first[n]
        at = start[k[again]] + begin[again]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + windows[n[again]], -1)
    return np.split(np.cumsum(cover[:-1]) > 0, start[1:])


def _occurrences(shard: ahocorasick.Automaton, lines: dict[int, tuple], windows: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Stretch, first window and number of each passage that the automaton finds, for some stretches at a time.

    Stretches alike but for their ends hold many passages inside each other, so all finds at once could be large.
    """
    own = iter(lines.items())
    while some := list(islice(own, 1024)):
        found = np.fromiter((x for k, line in some for end, n in shard.iter(line) for x in (k, end, n)), np.int64).reshape(-1, 3)
        yield found[:, 0], found[:, 1] + 2 - length - windows[found[:, 2]], found[:, 2]


SHARDED = "anchor long, content long, count int, ranges array<struct<a:int,b:int>>"


def _locate(length: int):
    """Stretches sorted by anchor to the ranges of windows that occur earlier; about a shard's size at a time."""

    def answer(rows: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([r[n] for r in rows], t) for n, t in (("anchor", pa.int64()), ("content", pa.int64()), ("count", pa.int32()))]
        return pa.RecordBatch.from_arrays([*columns, ranges_of(later_windows(rows, length))], names=["anchor", "content", "count", "ranges"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in batch.slice(at, 512).to_pylist():
                    if size >= SHARD and row["anchor"] != last:
                        yield answer(rows)
                        rows, size = [], 0
                    rows.append(row)
                    size += len(row["data"])
                    last = row["anchor"]
        if rows:
            yield answer(rows)

    return run


def _crowded(segments: DataFrame, length: int) -> DataFrame:
    """The same where an anchor has too many different stretches for one task: by the least place of each window's hash.

    Every window is a key of its own, and equal ones are combined before the shuffle.
    """
    size = length

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                words, n = row.column(3)[0].as_py().split(), row.column(2)[0].as_py()
                found = np.frombuffer(b"".join(xxhash.xxh128_digest(b" ".join(words[k : k + size])) for k in range(n)), np.int64).reshape(-1, 2)
                again = pa.array(np.zeros(n, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(c).take(again) for c in (0, 1, 2, 4, 5)), pa.array(np.arange(n, dtype=np.int32)), pa.array(found[:, 0]), pa.array(found[:, 1])],
                    names=["anchor", "content", "count", "id", "first", "a", "x", "y"],
                )

    kinds = T.StructType([segments.schema[c] for c in ("anchor", "content", "count", "id", "first")])
    kinds = kinds.add("a", T.IntegerType()).add("x", T.LongType()).add("y", T.LongType())
    windows = stored(segments.select("anchor", "content", "count", "data", "id", "first").mapInArrow(hashes, kinds)).withColumn("at", F.struct("id", F.col("first") + F.col("a")))
    least = windows.groupBy("x", "y").agg(F.min("at").alias("least"))
    found = windows.join(least, ["x", "y"]).where(~F.col("at").eqNullSafe(F.col("least"))).groupBy("anchor", "content", "count")
    return found.agg(F.collect_list(F.struct("a", (F.col("a") + 1).alias("b"))).alias("ranges"))


def later_occurrences(docs: DataFrame, length: int, crowd: int = 4096) -> DataFrame:
    """(id, tag, ranges): starts of the windows of ``length`` words that occur earlier too, for docs of (id, text)."""
    on_workers(docs.sparkSession)
    keys = ["anchor", "content", "count"]
    runs = anchored_runs(docs, length, GRAM, word_units)
    # Written, so that both sides of the join come straight from a shuffle and a frequent anchor's part can be split.
    twice = stored(runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    runs = stored(runs.join(twice, "anchor"))
    # Equal stretches are one from here on: the earliest stands for them, and all its windows are earlier than the others'.
    one = stored(runs.groupBy(keys).agg(F.count("*").alias("copies"), F.min(F.struct("id", "first", "tag")).alias("at")).select(*keys, "copies", "at.*"))
    texts = stored(segments_of(docs, one, length, _split, _join))
    segments = texts.join(one.select(*keys, "id", "first"), keys)
    many = stored(texts.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("anchor"))
    crowded = not many.isEmpty()
    usual = segments.join(many, "anchor", "left_anti") if crowded else segments
    found = usual.repartition(tasks(docs), "anchor").sortWithinPartitions("anchor").mapInArrow(_locate(length), SHARDED)
    if crowded:
        found = found.union(_crowded(segments.join(many, "anchor", "left_semi"), length))
    found = stored(found)
    # Written, so that a frequent stretch's part of the next join can be split.
    firsts = stored(one.join(found, keys, "left").select(*keys, F.struct("id", "first").alias("earliest"), F.coalesce("ranges", F.array().cast("array<struct<a:int,b:int>>")).alias("ranges")))
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("count").alias("b")))
    own = F.when(F.struct("id", "first").eqNullSafe(F.col("earliest")), F.col("ranges")).otherwise(whole)
    placed = runs.join(firsts, keys).select("id", "tag", "first", own.alias("ranges")).where(F.size("ranges") > 0)
    shifted = F.transform("ranges", lambda r: F.struct((r["a"] + F.col("first")).alias("a"), (r["b"] + F.col("first")).alias("b")))
    return placed.select("id", "tag", shifted.alias("ranges")).groupBy("id", "tag").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))


def remove_later_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 20, crowd: int = 4096) -> DataFrame:
    """Adds ``n_words``, ``spans`` (removed runs of words, [a, b)) and ``kept`` (the other words joined by one space).

    A word is removed if a window of ``length`` words that covers it has the word sequence of a window that starts earlier:
    in a document of smaller id, or earlier in the same one; judged on the input. Words are what ASCII white space
    separates, unchanged. A null text has no words; a null id is smaller than any other. Repeated rows start at the same
    place, so none of them is earlier. Existing columns of the added names are replaced.
    """
    docs = docs.drop("n_words", "spans", "kept")
    places = later_occurrences(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), length, crowd)
    tag, own_id, found = (fresh(n, docs.columns) for n in ("_tag", "_id", "_found"))
    places = places.select(F.col("id").alias(own_id), F.col("tag").alias(tag), F.col("ranges").alias(found))
    both = docs.join(places, docs[doc_id].eqNullSafe(places[own_id]) & (tag_of(docs[text]) == places[tag]), "left").select(*(docs[c] for c in docs.columns), found)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("spans", RANGES), T.StructField("kept", T.StringType())])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"n_words": [], "spans": [], "kept": []}
            for data, found in zip(utf8(batch.column(batch.schema.get_field_index(text))), batch.column(batch.num_columns - 1).to_pylist()):
                words = data.split()
                gone = np.zeros(len(words) + 1, np.int32)
                for r in found or []:
                    gone[r["a"]] += 1
                    gone[r["b"] + length - 1] -= 1
                removed = np.cumsum(gone)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], removed.astype(np.int8), [0]]))).reshape(-1, 2).tolist()
                out["n_words"].append(len(words))
                out["spans"].append([{"a": a, "b": b} for a, b in edges])
                out["kept"].append(b" ".join([w for w, r in zip(words, removed.tolist()) if not r] if edges else words).decode())
            return dict(zip(batch.schema.names, batch.columns)) | out

        return step

    return map_blocks(both, make, schema, text)
