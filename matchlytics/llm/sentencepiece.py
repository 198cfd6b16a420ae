"""SentencePiece BPE encoding and decoding by a table of last tokens.

For merge-type (BPE) models every prefix of a text has exactly one token that ends its encoding. The encoder finds, with
an Aho-Corasick automaton of the pieces, all pieces that end at a place; the one that may follow the last token of what
stands before it is stored. The ids are then read from the back. No merge queue is run over the text.

Words (runs of the space mark and what follows) are encoded one by one, as no piece goes over a word's start; words seen
before come from a cache of bounded size.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from matchlytics.llm.common import list_array, map_blocks, with_schema

MARK = "▁"
#: Pairs of tokens whose fit a worker remembers.
PAIRS = 1_000_000
#: Ends that words are tried without, so that a word is worked out once and not once for each of them.
ENDINGS = ".,;:!?\"')|*"


class Recent(dict):
    """A dictionary of at most ``2 * size`` recently used entries: when full, what wasn't asked for since goes.

    Long texts as keys are computed each time.
    """

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if isinstance(key, str) and len(key) > 64:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Beside(dict):
    """Of a last token: which tokens may stand right after it, worked out when first asked for. Without a token: the start."""

    __slots__ = ("fits", "token", "size")

    def __init__(self, fits: Callable[[int, int], bool] | None = None, token: int = -1, size: int = 0):
        super().__init__()
        self.fits, self.token, self.size = fits, token, size

    def __missing__(self, token: int) -> bool:
        found = self[token] = self.fits is None or self.fits(self.token, token)
        return found


class PieceTable:
    """The pieces of a merge-type model, how each is merged, and the automaton that finds them."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = f" a  b{MARK}é\n"
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model's normaliser changes texts; only identity with a leading space mark is supported")
        self.byte_ids: dict[int, int] = {}
        self.surface: list[bytes] = []
        text, score = {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte = int(piece[3:5], 16)
                self.byte_ids[byte] = i
                self.surface.append(bytes([byte]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"" if model.is_control(i) else " ⁇ ".encode())
            else:
                text[i], score[i] = piece, model.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte fallback")
        if any(MARK in piece.lstrip(MARK) for piece in text.values()):
            raise ValueError("a piece spans words")
        self.text = text
        self.by_text = {piece: i for i, piece in text.items()}
        places = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {i: places[s] for i, s in score.items()}
        # How a piece comes about: its last merge. A piece that its own characters don't merge to never occurs.
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.finder = ahocorasick.Automaton()
        for i, piece in text.items():
            if len(piece) > 1:
                last = self._last_merge(piece)
                if last is None:
                    continue
                self.left[i], self.right[i] = last
            self.finder.add_word(piece, i)
        self.finder.make_automaton()
        self.inside = {piece[k : k + 2] for piece in text.values() for k in range(len(piece) - 1)}
        self.known = frozenset(c for c in text.values() if len(c) == 1)
        self.strange = re.compile(f"([^{''.join(map(re.escape, sorted(self.known)))}])", re.DOTALL)
        self.sizes = [len(text.get(i, "")) for i in range(model.get_piece_size())]
        self.pairs = 0
        self.start = Beside()
        self.beside = [Beside(self._counted, i, size) for i, size in enumerate(self.sizes)]
        self.words = Recent(self._encode_word, 300_000)
        self.digits = [f"{i},".encode() for i in range(model.get_piece_size())]

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two tokens merged last when the piece's characters alone are merged, if they become the piece."""
        parts, last = list(piece), None
        while len(parts) > 1:
            found = [(self.rank[self.by_text[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.by_text]
            if not found:
                return None
            k = min(found)[1]
            last = (parts[k], parts[k + 1])
            parts[k : k + 2] = ["".join(last)]
        ids = [self.by_text.get(x) for x in last or ()]
        return (ids[0], ids[1]) if len(ids) == 2 and None not in ids else None

    def _counted(self, a: int, b: int) -> bool:
        """``_fits``; answers kept are bounded in number, as all are forgotten when there are too many."""
        self.pairs += 1
        if self.pairs > PAIRS:
            self.pairs = 0
            for row in self.beside:
                row.clear()
        return self._fits(a, b)

    def _fits(self, a: int, b: int) -> bool:
        """Whether the two tokens stay apart side by side.

        Takes their merges back, the latest first. If the tokens that then meet could have merged before the merge taken
        back, the two would never have come about next to each other. Of equal ranks the merge further left is earlier.
        """
        done = float("inf")
        while True:
            joined = self.by_text.get(self.text[a] + self.text[b])
            if joined is not None and self.rank[joined] < done:
                return False
            when_a = self.rank[a] if a in self.right else -1
            when_b = self.rank[b] if b in self.left else -1
            if when_a < 0 and when_b < 0:
                return True
            if when_a > when_b:
                done, a = when_a, self.right[a]
            else:
                done, b = when_b + 1, self.left[b]

    def _encode_run(self, run: str) -> list[int]:
        """Ids of characters that are all pieces."""
        rows: list[Beside | None] = [None] * len(run)
        rows.append(self.start)  # the place before the first character is -1
        sizes, beside = self.sizes, self.beside
        for end, token in self.finder.iter(run):
            if rows[end] is None:
                before = rows[end - sizes[token]]
                if before is not None and before[token]:
                    rows[end] = beside[token]
        ids, at = [], len(run) - 1
        while at >= 0:
            last = rows[at]
            ids.append(last.token)
            at -= last.size
        ids.reverse()
        return ids

    def _encode_word(self, word: str) -> bytes:
        core = word.rstrip(ENDINGS)
        if core and len(core) < len(word) and word[len(core) - 1 : len(core) + 1] not in self.inside:
            return self.words[core] + self.words[word[len(core) :]]  # no piece goes over this place
        if self.known.issuperset(word):
            return array("i", self._encode_run(word)).tobytes()
        ids: list[int] = []
        for run in self.strange.split(word):
            if len(run) == 1 and run not in self.known:
                ids += [self.byte_ids[x] for x in run.encode()]
            elif run:
                ids += self._encode_run(run)
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The text's ids as 32-bit numbers of this machine's byte order."""
        if not text:
            return b""
        parts = (" " + text.replace(MARK, " ")).replace(" ", " " + MARK).split(" ")
        del parts[0]
        if MARK in parts:  # a run of spaces belongs to the word after it
            whole, marks = [], ""
            for part in parts:
                if part == MARK:
                    marks += MARK
                else:
                    whole.append(marks + part)
                    marks = ""
            parts = whole + [marks] if marks else whole
        return b"".join(map(self.words.__getitem__, parts))

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, space marks as spaces, the first one left out; bytes that aren't UTF-8 become U+FFFD."""
        data = b"".join(map(self.surface.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")

    def listed(self, ids: list[int]) -> bytes:
        """The ids in decimal, joined by commas."""
        return b"".join(map(self.digits.__getitem__, ids))[:-1]


@lru_cache(2)
def piece_table(path: str) -> PieceTable:
    return PieceTable(path)


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of every whole text, without begin or end ids.

    ``model`` is a path that every executor has, as one inside an installed package. A null or empty text has no ids.
    All columns of the table are kept; a column named as ``ids`` is replaced.
    """
    df = df.drop(ids)

    def make():
        table = piece_table(model)

        def step(batch: pa.RecordBatch) -> dict:
            found = [table.encode(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            values = np.frombuffer(b"".join(found), np.int32)
            counts = np.array([len(f) // 4 for f in found])
            return dict(zip(batch.schema.names, batch.columns)) | {ids: list_array(values, counts, pa.int32())}

        return step

    return map_blocks(df, make, with_schema(df, (ids, T.ArrayType(T.IntegerType()))), text)


def decode(df: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for. Null or no ids: an empty text. A column named as ``decoded`` is replaced."""
    df = df.drop(decoded)

    def make():
        table = piece_table(model)

        def step(batch: pa.RecordBatch) -> dict:
            found = [table.decode(x or []) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            return dict(zip(batch.schema.names, batch.columns)) | {decoded: pa.array(found, pa.string())}

        return step

    return map_blocks(df, make, with_schema(df, (decoded, T.StringType())), ids)


def round_trip(df: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode``, then ``decode`` of what came out, in one pass over the texts. Columns named as the two added are replaced."""
    df = df.drop(ids, decoded)

    def make():
        table = piece_table(model)

        def step(batch: pa.RecordBatch) -> dict:
            found = [np.frombuffer(table.encode(t or ""), np.int32) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            texts = [table.decode(x.tolist()) for x in found]
            values = np.concatenate([np.zeros(0, np.int32), *found])
            return dict(zip(batch.schema.names, batch.columns)) | {ids: list_array(values, np.array([len(x) for x in found]), pa.int32()), decoded: pa.array(texts, pa.string())}

        return step

    return map_blocks(df, make, with_schema(df, (ids, T.ArrayType(T.IntegerType())), (decoded, T.StringType())), text)


def round_trip_digests(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """In place of the text: ``n_tokens``, ``ids_sha256`` of the ids in decimal joined by commas, ``decoded_sha256`` of what they decode to.

    For comparing encodings where the ids themselves needn't leave the task. A null or empty text has no ids. Columns named as
    the three are replaced.
    """
    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    df = df.drop(*(n for n, _ in added))
    left = [n for n in df.columns if n != text]

    def make():
        table = piece_table(model)

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n: [] for n, _ in added}
            for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                found = np.frombuffer(table.encode(t or ""), np.int32).tolist()
                out["n_tokens"].append(len(found))
                out["ids_sha256"].append(sha256(table.listed(found)).hexdigest())
                out["decoded_sha256"].append(sha256(table.decode(found).encode()).hexdigest())
            return {n: batch.column(batch.schema.get_field_index(n)) for n in left} | out

        return step

    return map_blocks(df, make, with_schema(df.drop(text), *added), text)
