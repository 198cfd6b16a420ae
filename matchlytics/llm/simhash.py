"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into four segments of 16. Of up to three differing bits one segment has none; the other
48 bits are two halves of 24, of which one has at most one. So two linked fingerprints agree on a segment, and on an index
of a codeword near to the first 23 bits of a half: those are the keys they are joined by. What meets is verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from matchlytics.llm.common import fresh, map_blocks, on_workers, stored, tasks, utf8
from matchlytics.llm.components import components
from matchlytics.llm.golay import nearby

SEED = 42
LINKS = "a long, b long"


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """A bit is set if over half of the shingles' hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashing, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    for at in range(0, len(starts), 50_000):
        hashes = np.array([hashing(line[a:b], SEED) for a, b in zip(starts[at : at + 50_000], ends[at : at + 50_000])], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): the fingerprint's bits as a long. A text without words, or null, has 0. Columns of ``also`` stay."""
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField(doc_id, kind), T.StructField("fp", T.LongType()), *(docs.schema[c] for c in also)])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            found = np.array([fingerprint(x, shingle) for x in utf8(batch.column(batch.schema.get_field_index(text)))], np.uint64)
            return {"fp": pa.array(found.view(np.int64)), **{c: batch.column(batch.schema.get_field_index(c)) for c in (doc_id, *also)}}

        return step

    return map_blocks(docs.select(doc_id, text, *also), make, schema, text)


def _keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each fingerprint: (row, key). A key holds the segment's place, the half's place, segment and codeword."""
    bits, rows, keys = fps.view(np.uint64), [], []
    parts = [(bits >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64) for k in range(4)]
    for k in range(4):
        x, y, z = (parts[j] for j in range(4) if j != k)
        rest = x | y << 16 | z << 32
        for half in range(2):
            row, index = nearby(rest >> (24 * half) & 0x7FFFFF)
            rows.append(row)
            keys.append((k * 2 + half) << 28 | parts[k][row] << 12 | index)
    return np.concatenate(rows), np.concatenate(keys)


def fuzzy_keys(fps: DataFrame) -> DataFrame:
    """(key, fp) for a table of one column of fingerprints."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).astype(np.int64)
                rows, keys = _keys(own)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[rows])], names=["key", "fp"])

    on_workers(fps.sparkSession)
    return fps.mapInArrow(run, "key long, fp long")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected by links of up to ``bits`` bits inside the group."""
    links, rest = [], fps
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            near = _distance(rest, x) <= bits
            if near.any():
                links += [(x, y) for y in rest[near]]
                todo += list(rest[near])
                rest = rest[~near]
    return links


def _links_of_groups(bits: int):
    def links(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows sorted by key, groups whole."""
        edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        sizes = np.diff(edges)
        pairs = edges[:-1][sizes == 2]
        near = _distance(fps[pairs], fps[pairs + 1]) <= bits
        a, b = [fps[pairs][near]], [fps[pairs + 1][near]]
        for start, size in zip(edges[:-1][sizes > 2], sizes[sizes > 2]):
            found = np.array(_forest(fps[start : start + size], bits), np.int64).reshape(-1, 2)
            a.append(found[:, 0])
            b.append(found[:, 1])
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = np.zeros(0, np.int64)
        for batch in batches:
            k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last group may go on
            if whole:
                a, b = links(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        if len(keys):
            a, b = links(keys, fps)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _masks(bits: int) -> list[int]:
    found, level = {0}, {0}
    for _ in range(bits):
        level = {m ^ 1 << k for m in level for k in range(64)}
        found |= level
    return sorted(m - (1 << 64) if m >> 63 else m for m in found)


def _crowd_links(crowd: DataFrame) -> DataFrame:
    """Links of up to three bits among the fingerprints of too large groups, by the words near to both.

    Two fingerprints are within three bits if some word is within one bit of one and two of the other. Each emits the
    words within two bits; per word, those within two bits are linked to the smallest one within one bit. The work is in
    proportion to the fingerprints, and a word's rows are combined before and split after the shuffle.
    """
    masks = F.lit(_masks(2))
    near = crowd.select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("word"), (F.bit_count("mask") <= 1).alias("close"))
    anchors = near.where("close").groupBy("word").agg(F.min("fp").alias("anchor"))
    return near.join(anchors, "word").where("fp <> anchor").select(F.col("fp").alias("a"), F.col("anchor").alias("b")).distinct()


def fuzzy_links(fps: DataFrame, crowd: int = 4096) -> DataFrame:
    """(a, b): links between distinct fingerprints of at most three differing bits, enough to connect all that are.

    Keys of one fingerprint are dropped before groups are made, by a count that is combined before its shuffle. Groups of
    up to ``crowd`` are compared in a task, with a link or less for each member coming out; larger ones go another exact
    way that needs no group in one place.
    """
    keys = stored(fuzzy_keys(fps))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(keys.join(sizes, "key"))
    n = tasks(fps)
    groups = met.where(F.col("n") <= crowd).select("key", "fp").repartition(n, "key").sortWithinPartitions("key")
    links = groups.mapInArrow(_links_of_groups(3), LINKS)
    large = met.where(F.col("n") > crowd).select("fp").distinct()
    if not large.isEmpty():
        links = links.union(_crowd_links(stored(large)))
    return links.distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, crowd: int = 4096) -> DataFrame:
    """Adds ``fingerprint`` (16 lowercase hex digits) and ``component_id``, the smallest id that links lead to.

    Documents are linked if their fingerprints differ in at most three bits. Texts are read once; copies share a
    fingerprint and are one node from there on. Texts without words (null too) have fingerprint zero and are linked like
    others. Rows are told apart by id and text, so each has its own fingerprint also where an id is null or shared. A null
    id is not a component's id unless all its ids are null. Existing columns of the two names are replaced.
    """
    docs = docs.drop("fingerprint", "component_id")
    copy, own_id, same = (fresh(n, [*docs.columns, "fp"]) for n in ("_copy", "_id", "_same"))
    marked = docs.withColumn(copy, F.xxhash64(text))
    own = stored(fingerprints(marked, doc_id, text, shingle, (copy,)))
    found = own.join(classes_of(own, doc_id, crowd), "fp")
    result = found.select(F.col(doc_id).alias(own_id), F.col(copy).alias(same), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id").distinct()
    return marked.join(result, marked[doc_id].eqNullSafe(result[own_id]) & (marked[copy] == result[same])).drop(own_id, same, copy)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, crowd: int = 4096) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group that links lead through, the row of the smallest id.

    Links are those of ``near_duplicates``. Rows are told apart by id and text, so rows of one id (or none) count as documents
    of their own; null ids come last, and of a group's rows of one id that of the smallest hash of the text stays. Rows
    equal in id and text are one document: one of them stays, with its other columns. Texts without words (null too) have
    the fingerprint zero and are copies of each other. An empty table stays empty; no column of ``docs`` is lost or replaced.
    """
    copy, own_id, same = (fresh(n, [*docs.columns, "fp"]) for n in ("_copy", "_id", "_same"))
    marked = docs.withColumn(copy, F.xxhash64(text))
    own = stored(fingerprints(marked, doc_id, text, shingle, (copy,)))
    row = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(copy).alias("copy"))
    least = own.groupBy("fp").agg(F.min(row).alias("least")).join(classes_of(own, doc_id, crowd), "fp").groupBy("root").agg(F.min("least").alias("least"))
    kept = least.select(F.col("least.id").alias(own_id), F.col("least.copy").alias(same))
    found = marked.join(kept, marked[doc_id].eqNullSafe(kept[own_id]) & (marked[copy] == kept[same]), "left_semi")
    return found.dropDuplicates([doc_id, copy]).drop(copy)


def classes_of(own: DataFrame, doc_id: str, crowd: int = 4096) -> DataFrame:
    """(fp, root, component_id) for a table of (doc_id, fp): a fingerprint of the group, and the group's smallest id."""
    distinct = stored(own.groupBy("fp").agg(F.min(doc_id).alias("least")))
    roots = components(fuzzy_links(distinct.select("fp"), crowd))
    rooted = stored(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")
