"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items, one scan of each text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from matchlytics.llm.common import fresh, map_blocks, utf8, with_schema

WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lower-cases A-Z; what is no word character becomes a space. Bytes of characters beyond ASCII stay.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))

_automata: dict = {}


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def item_windows(text: bytes, window: int) -> list[bytes]:
    """The word windows of an item; one of all its words if there are fewer."""
    found = normal_words(text)
    if not found:
        return []
    return [b" ".join(found[k : k + window]) for k in range(max(1, len(found) - window + 1))]


def _shards(benchmark: DataFrame, item_id: str, text: str, window: int, shard_chars: int) -> Iterator[dict[bytes, list[str]]]:
    """Windows with the items that have them, as many at a time as one automaton may hold."""
    shard, size = {}, 0
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    for row in rows.toLocalIterator():
        for found in item_windows(bytes(row.t or b""), window):
            items = shard.setdefault(found, [])
            size += 0 if items else len(found)
            if row.i is not None and row.i not in items:
                items.append(row.i)
        if size >= shard_chars:
            yield shard
            shard, size = {}, 0
    if shard:
        yield shard


def automaton(key: str, windows: dict[bytes, list[str]]) -> ahocorasick.Automaton:
    """Finds the windows between spaces; made once in a worker, which keeps four. Bytes stand as characters."""
    if key not in _automata:
        made = ahocorasick.Automaton()
        for found, items in windows.items():
            made.add_word(f" {found.decode('latin-1')} ", (len(found) + 2, items))
        if windows:
            made.make_automaton()
        if len(_automata) > 3:
            _automata.clear()
        _automata[key] = made
    return _automata[key]


def word_line(text: bytes) -> bytes:
    """The words with a space before, between and after them; nothing if there are none."""
    found = normal_words(text)
    return b" " + b" ".join(found) + b" " if found else b""


def scan(line: bytes, finder: ahocorasick.Automaton) -> tuple[np.ndarray | None, list[str]]:
    """Which words of the line are hit (None: none), and the items found."""
    matches = list(finder.iter(line.decode("latin-1"))) if line and len(finder) else []
    if not matches:
        return None, []
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _ in matches])
    first = np.searchsorted(spaces, [end + 1 - size for end, (size, _) in matches])
    cover = np.zeros(len(spaces), np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, last, -1)
    return np.cumsum(cover)[:-1] > 0, sorted({i for _, (_, items) in matches for i in items})


def spans_of(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as [start, end) in characters of the original text."""
    places = [m.span() for m in re.finditer(WORD, text.translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    runs, chars, at = [], 0, 0
    for a, b in edges.reshape(-1, 2):
        start, end = places[a][0], places[b - 1][1]
        chars += len(text[at:start].decode())
        first = chars
        chars += len(text[start:end].decode())
        runs.append((first, chars))
        at = end
    return runs


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join(kept) + text[at:]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, shard_chars: int = 4 << 20) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``items`` (ids as text, sorted), ``spans`` (of hit words, in characters) and ``cleaned``.

    A window of ``window`` consecutive item words (all of them, if an item has fewer) that occurs in a document hits its
    words; ``cleaned`` is the text without the spans. Words are runs of a-z, 0-9 and characters beyond ASCII, after A-Z
    is lower-cased. The items' windows make one automaton, sent to the workers; a benchmark of more than ``shard_chars``
    window bytes makes several, and each text passes them in turn, so that memory is bounded whatever its size.
    Null or empty texts have no words, items without words no windows. Repeated items all count. Existing columns of the
    added names are replaced.
    """
    added = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("items", T.ArrayType(T.StringType())), ("spans", SPAN), ("cleaned", T.StringType())]
    docs = docs.drop(*(n for n, _ in added))
    context = docs.sparkSession.sparkContext
    shards = [context.broadcast(x) for x in _shards(benchmark, item_id, item_text, window, shard_chars)]
    keys = [f"{context.applicationId}-{x._jbroadcast.id()}" for x in shards]

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            raw = batch.column(batch.schema.get_field_index(text))
            out: dict[str, list] = {n: [] for n, _ in added}
            texts = utf8(raw)
            lines = [word_line(data) for data in texts]
            hits: list[np.ndarray | None] = [None] * len(lines)
            items: list[list[str]] = [[] for _ in lines]
            for key, shard in zip(keys, shards):  # each automaton is made at most once for a block of texts
                finder = automaton(key, shard.value)
                for k, line in enumerate(lines):
                    covered, found = scan(line, finder)
                    if covered is not None:
                        hits[k] = covered if hits[k] is None else hits[k] | covered
                        items[k] += found
            for data, line, hit, names in zip(texts, lines, hits, items):
                spans = [] if hit is None else spans_of(data, hit)
                out["n_words"].append(max(0, line.count(b" ") - 1))
                out["n_hit"].append(0 if hit is None else int(hit.sum()))
                out["items"].append(sorted(set(names)))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["cleaned"].append(_without(data.decode(), spans) if spans else None)
            return dict(zip(batch.schema.names, batch.columns)) | out

        return step

    made = map_blocks(docs, make, with_schema(docs, *added), text)
    return made.withColumn("cleaned", F.coalesce("cleaned", text))
