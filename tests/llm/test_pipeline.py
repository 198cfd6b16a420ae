from __future__ import annotations

import re
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import SMALL
from tests.llm.test_simhash import plain_classes, plain_fingerprint

SPACE = "\x20\x09-\x0d"


def words(text: str) -> list[str]:
    return re.findall(f"[^{SPACE}]+", text)


def plain_quality(rows):
    """No line of the small table is above the limits, so only the base rules count."""
    out = {}
    for i, text in rows.items():
        w = words(text)
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {p for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        if len(w) >= 10 and 100 * len(covered) <= 20 * len(w):
            out[i] = text
    return out


def plain_copies(rows):
    """Three words and three bits, by comparing all pairs."""
    ids = sorted(rows)
    root = plain_classes(ids, np.array([plain_fingerprint(rows[i]) for i in ids], np.uint64))
    return {i: rows[i] for i in ids if root[i] == i}


def plain_passages(rows, length=200):
    data = {i: t.encode() for i, t in rows.items()}
    found = Counter(hash(t[k : k + length]) for t in data.values() for k in range(len(t) - length + 1))
    out = {}
    for i, t in data.items():
        gone, until = [], 0
        for k in range(len(t)):
            if k <= len(t) - length and found[hash(t[k : k + length])] > 1:
                until = k + length
            gone.append(k < until)
        kept, at = [], 0
        for c in t.decode():
            size = len(c.encode())
            if not all(gone[at : at + size]):
                kept.append(c)
            at += size
        out[i] = "".join(kept)
    return out


def plain_benchmark(rows, items):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for item in items:
        w = pattern.findall(low(item or ""))
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in rows.items():
        found = list(pattern.finditer(low(text)))
        w = [m.group() for m in found]
        hit = {p for n in sizes for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for p in range(k, k + n)}
        kept, at = [], 0
        for p in sorted(hit):
            start = found[p - 1].end() if p - 1 in hit else found[p].start()
            kept.append(text[at:start])
            at = found[p].end()
        out[i] = "".join(kept) + text[at:]
    return out


def test_pipeline_equals_plain_stages(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = plain_quality(rows)
    single = plain_copies(kept)
    passages = plain_passages(single)
    clean = plain_benchmark(passages, items)
    assert len(rows) > len(kept) > len(single) and clean != passages
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: (r.ids, r.text) for r in got} == {i: ((ids := model.encode(t)), model.decode(ids)) for i, t in clean.items()}
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_stages_on_nulls_repeated_rows_and_empty_tables(spark, docs_of):
    line = "a b c d e f g h i j k l"
    rows = [(1, None), (None, "a b"), (None, None), (2, "x " * 300), (3, line), (3, line), (None, line + " m n")]
    left = {
        "quality rules": [(None, line + " m n"), (3, line), (3, line)],
        "near-duplicates": [(1, None), (2, "x " * 300), (3, line), (None, "a b"), (None, line + " m n")],
        "repeated passages": [(i, "" if i == 2 else t) for i, t in rows],
        "benchmark passages": rows,
    }
    for given in ([], rows):
        docs = docs_of(given)
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SMALL)
            if name == "tokens":
                assert sorted((str(r.doc_id), r.text) for r in found.collect()) == sorted((str(i), t or "") for i, t in given)
            else:
                assert found.columns == docs.columns
                assert sorted((str(r.doc_id), str(r.text)) for r in found.collect()) == sorted((str(i), str(t)) for i, t in (left[name] if given else []))


def test_columns_named_as_those_of_the_operators_stay(spark, docs_of):
    names = ["kept", "cleaned", "spans", "n_words", "items", "fingerprint", "_keys", "_id", "_copy", "_found", "_tag", "user_column_4", "id", "tag"]
    docs = docs_of([(k, " ".join(f"w{k}x{j}" for j in range(30))) for k in range(3)])
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SMALL)
        assert found.columns == docs.columns and found.schema == docs.schema
        rows = found.collect()
        assert len(rows) == 3 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
