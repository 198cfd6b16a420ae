"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere are removed.

Only where a content-defined anchor occurs twice can a string repeat. The runs of strings of such anchors are the segments
that are sorted: those of one anchor meet in one place, where two-stage suffix sorting and the common prefixes of
neighbours say which of their strings repeat. All numbers grow with the text, not with the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from matchlytics.llm.anchors import anchor_runs, byte_values
from matchlytics.llm.common import fresh, list_array, map_blocks, on_workers, stored, tasks, utf8
from matchlytics.llm.suffixes import repeated_starts

#: Bytes in an anchor's gram, and of text handled at a time.
GRAM, BLOCK = 40, 1 << 20
RANGES = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
SEGMENT = "anchor long, content long, count int, copies long, data binary"
FOUND = "anchor long, content long, count int, ranges array<struct<a:int,b:int>>"


def text_tag(text: bytes) -> int:
    """Tells rows of one id with different texts apart."""
    return xxhash.xxh64_intdigest(text, 42) & 0x7FFFFFFF


def tag_of(text: Column) -> Column:
    """``text_tag`` as a column, so that tables are joined by id and tag; null is the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(0x7FFFFFFF).cast("int")


def byte_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each unit of the texts laid end to end, and where each text begins and the last ends."""
    return byte_values()[np.frombuffer(b"".join(texts), np.uint8)], np.append(0, np.cumsum([len(t) for t in texts]))


def anchored_runs(docs: DataFrame, length: int, gram: int = GRAM, units=byte_units) -> DataFrame:
    """(anchor, content, count, id, tag, first): runs of windows of ``length`` units of all texts of (id, text)."""
    schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("anchor", "content")] + [T.StructField("count", T.IntegerType()), docs.schema["id"]] + [T.StructField(n, T.IntegerType()) for n in ("tag", "first")]
    )

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            texts = utf8(batch.column(1))
            runs = anchor_runs(*units(texts), length, gram)
            tags = np.array([text_tag(t) for t in texts], np.int32)
            return {
                "anchor": pa.array(runs["anchor"]),
                "content": pa.array(runs["content"]),
                "count": pa.array(runs["count"].astype(np.int32)),
                "id": batch.column(0).take(pa.array(runs["doc"])),
                "tag": pa.array(tags[runs["doc"]]),
                "first": pa.array(runs["first"].astype(np.int32)),
            }

        return step

    return map_blocks(docs, make, schema, "text", BLOCK)


def _same(text: bytes) -> bytes:
    return text


def _slice(text: bytes, a: int, b: int) -> bytes:
    return text[a:b]


def segments_of(docs: DataFrame, wanted: DataFrame, length: int, prepare=_same, take=_slice) -> DataFrame:
    """The bytes of the wanted runs (anchor, content, count, copies, id, tag, first).

    ``take`` gets what ``prepare`` made of a text, and the first unit and the one after the last.
    """
    by_text = wanted.groupBy("id", "tag").agg(F.collect_list(F.struct("anchor", "content", "count", "copies", "first")).alias("runs"))
    own = docs.alias("d").join(by_text.alias("w"), F.col("d.id").eqNullSafe(F.col("w.id")) & (tag_of(F.col("d.text")) == F.col("w.tag"))).select("d.text", "w.runs")
    schema = T._parse_datatype_string(SEGMENT)

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {f.name: [] for f in schema}
            for text, runs in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                prepared = prepare(text)
                for run in runs:
                    for name in ("anchor", "content", "count", "copies"):
                        out[name].append(run[name])
                    out["data"].append(take(prepared, run["first"], run["first"] + run["count"] + length - 1))
            return out

        return step

    return map_blocks(own, make, schema, "text", BLOCK)


def ranges_of(flags: list[np.ndarray]) -> pa.Array:
    """Runs of true flags as [a, b), a list for each array."""
    lists = [np.flatnonzero(np.diff(np.concatenate([[0], f.astype(np.int8), [0]]))).reshape(-1, 2) for f in flags]
    pairs = np.concatenate(lists) if lists else np.zeros((0, 2), int)
    items = pa.StructArray.from_arrays([pa.array(pairs[:, k].astype(np.int32)) for k in range(2)], names=["a", "b"])
    offsets = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), items)


def _sort_segments(length: int):
    """Segments sorted by anchor to the strings that repeat among those of an anchor; about a block at a time.

    Of equal segments one came, with their number; two stand for any more.
    """

    def answer(rows: list[dict]) -> pa.RecordBatch:
        data, counts, owner = [], [], []
        for k, row in enumerate(rows):
            for _ in range(min(2, row["copies"])):
                data.append(row["data"])
                counts.append(row["count"])
                owner.append(k)
        flags: list = [None] * len(rows)
        for k, found in zip(owner, repeated_starts(data, counts, length)):
            flags[k] = found
        kept = [(r, f) for r, f in zip(rows, flags) if f.any()]
        columns = [pa.array([r[n] for r, _ in kept], t) for n, t in (("anchor", pa.int64()), ("content", pa.int64()), ("count", pa.int32()))]
        return pa.RecordBatch.from_arrays([*columns, ranges_of([f for _, f in kept])], names=["anchor", "content", "count", "ranges"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in batch.slice(at, 512).to_pylist():
                    if size >= BLOCK and row["anchor"] != last:
                        yield answer(rows)
                        rows, size = [], 0
                    rows.append(row)
                    size += len(row["data"])
                    last = row["anchor"]
        if rows:
            yield answer(rows)

    return run


def _count_strings(crowded: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many different segments for one task: their strings are counted by 128-bit hashes.

    Each string is a key of its own, and equal ones are combined before the shuffle.
    """

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = row["data"]
                found = np.frombuffer(b"".join(xxhash.xxh128_digest(data[k : k + length]) for k in range(row["count"])), np.int64).reshape(-1, 2)
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.full(n, row[c])) for c in ("anchor", "content")), pa.array(np.full(n, row["count"], np.int32)), pa.array(np.full(n, row["copies"])), pa.array(np.arange(n, dtype=np.int32)), pa.array(found[:, 0]), pa.array(found[:, 1])],
                    names=["anchor", "content", "count", "copies", "a", "x", "y"],
                )

    strings = stored(crowded.mapInArrow(hashes, "anchor long, content long, count int, copies long, a int, x long, y long"))
    twice = strings.groupBy("x", "y").agg(F.sum("copies").alias("n")).where("n > 1").select("x", "y")
    found = strings.join(twice, ["x", "y"]).groupBy("anchor", "content", "count")
    return found.agg(F.collect_list(F.struct("a", (F.col("a") + 1).alias("b"))).alias("ranges"))


def repeated_strings(docs: DataFrame, length: int, crowd: int = 4096) -> DataFrame:
    """(id, tag, ranges): starts of the strings of ``length`` bytes that start twice or more, for docs of (id, text)."""
    on_workers(docs.sparkSession)
    runs = anchored_runs(docs, length)
    # Written, so that both sides of the join come straight from a shuffle and a frequent anchor's part can be split.
    twice = stored(runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    runs = stored(runs.join(twice, "anchor"))
    # Equal segments (of copies) are one from here on.
    one = runs.groupBy("anchor", "content", "count").agg(F.count("*").alias("copies"), F.min(F.struct("id", "tag", "first")).alias("at"))
    wanted = one.select("anchor", "content", "count", "copies", "at.*")
    segments = stored(segments_of(docs, wanted, length))
    many = stored(segments.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("anchor"))
    usual = segments
    if not many.isEmpty():
        usual = segments.join(many, "anchor", "left_anti")
    found = usual.repartition(tasks(docs), "anchor").sortWithinPartitions("anchor").mapInArrow(_sort_segments(length), FOUND)
    if not many.isEmpty():
        found = found.union(_count_strings(segments.join(many, "anchor", "left_semi"), length))
    places = runs.join(stored(found), ["anchor", "content", "count"]).select(
        "id", "tag", F.transform("ranges", lambda r: F.struct((r["a"] + F.col("first")).alias("a"), (r["b"] + F.col("first")).alias("b"))).alias("ranges")
    )
    return places.groupBy("id", "tag").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))


def merged(ranges: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal runs covered by the strings that start in the ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["a"], r["b"] + length - 1) for r in ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without characters that they cover in part."""
    out = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join(kept) + text[at:]


def remove_repeated_strings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 200, crowd: int = 4096) -> DataFrame:
    """Adds ``n_bytes``, ``spans`` (maximal removed runs [a, b) in bytes), ``kept`` (the remaining bytes) and ``cleaned``.

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else, in the same document
    (overlapping too) or another; all occurrences go, judged on the input. ``cleaned`` is text again: characters covered
    in part stay whole in it. Texts are taken as UTF-8, a null one as empty (``cleaned`` stays null). A repeated row is
    another document with the same strings. Texts shorter than ``length`` stay. Existing columns of the added names are
    replaced. An anchor with over ``crowd`` different segments goes a way that needs no group in one task.
    """
    docs = docs.drop("n_bytes", "spans", "kept", "cleaned")
    places = repeated_strings(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), length, crowd)
    tag, own_id, found = (fresh(n, docs.columns) for n in ("_tag", "_id", "_found"))
    places = places.select(F.col("id").alias(own_id), F.col("tag").alias(tag), F.col("ranges").alias(found))
    both = docs.join(places, docs[doc_id].eqNullSafe(places[own_id]) & (tag_of(docs[text]) == places[tag]), "left").select(*(docs[c] for c in docs.columns), found)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("spans", RANGES), T.StructField("kept", T.BinaryType()), T.StructField("cleaned", T.StringType())]
    )

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            raw = batch.column(batch.schema.get_field_index(text))
            out: dict[str, list] = {"n_bytes": [], "spans": [], "kept": [], "cleaned": []}
            for data, null, found in zip(utf8(raw), raw.is_null().to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                spans = merged(found or [], length)
                out["n_bytes"].append(len(data))
                out["spans"].append([{"a": a, "b": b} for a, b in spans])
                out["kept"].append(without(data, spans))
                out["cleaned"].append(None if null else without(data, whole_characters(data, spans)).decode())
            return dict(zip(batch.schema.names, batch.columns)) | out

        return step

    return map_blocks(both, make, schema, text, BLOCK)
