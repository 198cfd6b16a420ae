from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from matchlytics.llm.queries import MODEL, QUERIES
from matchlytics.llm.sentencepiece import PieceTable, Recent, decode, encode
from tests.llm.conftest import SMALL


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_equal_the_library_on_random_texts(library):
    table, rng = PieceTable(MODEL), random.Random(1)
    letters = "aeioutnshr  .,▁\n\t0<>|ñé𝔘日本ab  e\0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    texts += ["".join(library.id_to_piece(rng.randrange(259, 32000)) for _ in range(rng.randint(1, 5))) for _ in range(2000)]
    texts += ["", " ", "  ", " a", "a ", "a  b", "<s> </s>", "<0x0A>", "x" * 70, "a" * 3000, "ab" * 2000 + ".", "the the. the, the"]
    for text in texts:
        ids = np.frombuffer(table.encode(text), np.int32).tolist()
        assert ids == library.encode(text), text
        assert table.decode(ids) == library.decode(ids), text


def test_cache_is_bounded_and_right():
    cache = Recent(lambda k: k * 2, 10)
    for k in [*range(100), *range(95, 100), 3]:
        assert cache[k] == 2 * k
        assert len(cache) <= 10 and len(cache.old) <= 10


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in QUERIES["op1_sentencepiece"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == want


def test_edge_cases(spark, docs_of, library):
    long = "wörd, " * 40_000
    rows = [(1, None), (2, ""), (3, long), (4, "same"), (4, "same"), (None, "a  b")]
    got = decode(encode(docs_of(rows), MODEL), MODEL).collect()
    assert sorted((str(r.doc_id), r.ids_ if "ids_" in r else len(r.ids)) for r in got) == sorted((str(i), len(library.encode(t or ""))) for i, t in rows)
    assert all(r.decoded == (r.text or "") for r in got)
    assert encode(docs_of([]), MODEL).collect() == []
    assert public_tokenizers.path("piece_bpe_32k.model") == MODEL
