from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from matchlytics.llm.queries import QUERIES
from matchlytics.llm.suffix_dedup import remove_repeated_strings
from matchlytics.llm.suffixes import repeated_starts
from tests.llm.conftest import SMALL


def plain(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    """(removed, spans, kept) of each text."""
    found = Counter(hash(t[k : k + length]) for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        flags, until = [], 0
        for k in range(len(t)):
            if k <= len(t) - length and found[hash(t[k : k + length])] > 1:
                until = k + length
            flags.append(k < until)
        spans = sum(f and not g for f, g in zip(flags, [False] + flags))
        out.append((sum(flags), spans, bytes(b for b, f in zip(t, flags) if not f)))
    return out


def test_repeated_starts_equal_counting():
    rng = random.Random(2)
    for _ in range(400):
        length, letters = rng.choice([8, 9, 12]), rng.choice([b"ab", b"abc", b"a\x00\xff"])
        segments, counts = [], []
        for _ in range(rng.randint(1, 6)):
            n = rng.randint(1, 30)
            size = n + length - 1 + rng.randint(0, 4)
            segments.append(bytes(rng.choice(letters) for _ in range(size)) if rng.random() < 0.7 else bytes([rng.choice(letters)]) * size)
            counts.append(n)
        found = Counter(s[k : k + length] for s, n in zip(segments, counts) for k in range(n))
        want = [[found[s[k : k + length]] > 1 for k in range(n)] for s, n in zip(segments, counts)]
        assert [g.tolist() for g in repeated_starts(segments, counts, length)] == want
    assert repeated_starts([], [], 8) == []


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op2_suffix_dedup"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = plain([r.text.encode() for r in rows], 200)
    assert sum(w[0] > 0 for w in want) > 5 and len(got) == len(rows)
    for row, (removed, spans, kept) in zip(rows, want):
        found = got[row.doc_id]
        assert (found.n_bytes, found.n_removed, found.n_spans, found.kept_sha256) == (len(row.text.encode()), removed, spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("crowd", [4096, 1])
def test_edge_cases(spark, docs_of, crowd):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    passage, edge = word(260), word(199)
    rows = [(1, None), (2, ""), (3, "short"), (4, word(300) + passage + word(80)), (5, passage + word(300)), (6, "z" * 5000), (7, edge + "x"), (8, edge + "y")]
    rows += [(9, word(700)), (9, word(700)), (10, (text := word(400))), (10, text), (None, word(500) + passage)]
    rows += [(20 + k, word(50) + passage[:230] + word(40)) for k in range(12)]
    got = remove_repeated_strings(docs_of(rows), length=200, crowd=crowd).collect()
    assert len(got) == len(rows) and {r.ids for r in got} == {"extra"}
    want = dict(zip(((i, t) for i, t in rows), plain([(t or "").encode() for _, t in rows], 200)))
    for r in got:
        removed, spans, kept = want[r.doc_id, r.text]
        assert (sum(s.b - s.a for s in r.spans), len(r.spans), r.kept) == (removed, spans, kept)
        assert r.cleaned is None if r.text is None else r.cleaned.encode().replace("é".encode(), b"") == kept.replace("é".encode(), b"").replace(b"\xc3", b"").replace(b"\xa9", b"")


def test_empty_table(spark, docs_of):
    assert remove_repeated_strings(docs_of([])).collect() == []
