from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from matchlytics.llm import golay
from matchlytics.llm.components import components
from matchlytics.llm.queries import QUERIES
from matchlytics.llm.simhash import classes_of, fuzzy_links, near_duplicates, one_of_each
from tests.llm.conftest import SMALL


def plain_fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_classes(ids: list[int], fps: np.ndarray) -> dict[int, int]:
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
    return {ids[i]: ids[find(i)] for i in range(len(ids))}


def test_golay_code_is_perfect_and_neighbours_share_an_index():
    words = np.arange(1 << 23)
    assert (np.bincount(golay.nearest(words)) == 2048).all()
    some = np.random.default_rng(1).integers(0, 1 << 23, 3000)
    rows, found = golay.nearby(some)
    own = np.bincount(rows)
    assert set(own) == {1, 6}
    keys = [set(found[rows == k]) for k in range(300)]
    for bit in range(23):
        other_rows, other = golay.nearby(some[:300] ^ (1 << bit))
        assert all(keys[k] & set(other[other_rows == k]) for k in range(300))


def test_query_equals_brute_force(spark):
    got = QUERIES["op3_simhash"](spark, SMALL).toPandas().sort_values("doc_id").reset_index(drop=True)
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    fps = np.array([plain_fingerprint(t) for t in texts.text], np.uint64)
    assert got.fingerprint.tolist() == [f"{f:016x}" for f in fps.tolist()]
    want = plain_classes(texts.doc_id.tolist(), fps)
    assert dict(zip(got.doc_id, got.component_id)) == want


@pytest.mark.parametrize("crowd", [4096, 8, 1])
def test_links_of_a_crowded_group(spark, crowd):
    """Chains and clusters of fingerprints a few bits apart, whichever way large groups go."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 4).astype(np.uint64)
    fps = {int(c) ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))) for c in centres for _ in range(60)}
    chain = int(rng.integers(0, 1 << 62))
    for k in range(0, 60, 3):
        chain ^= 7 << k
        fps.add(chain)
    fps |= {0, 1, (1 << 64) - 1}
    unsigned = np.array(sorted(fps), np.uint64)
    ids = list(range(100, 100 + len(unsigned)))
    own = spark.createDataFrame(pd.DataFrame({"doc_id": ids, "fp": unsigned.view(np.int64)})).repartition(4)
    by_fp = {r.fp: r.component_id for r in classes_of(own, "doc_id", crowd).collect()}
    assert {i: by_fp[f] for i, f in zip(ids, unsigned.view(np.int64).tolist())} == plain_classes(ids, unsigned)


def test_no_link_is_missed(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    near = np.array([int(x) ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for x in base], np.uint64)
    fps = spark.createDataFrame(pd.DataFrame({"fp": np.concatenate([base, near]).view(np.int64)}))
    got = {frozenset(r) for r in fuzzy_links(fps).collect()}
    assert {frozenset(map(int, x)) for x in zip(base.view(np.int64), near.view(np.int64))} <= got


def test_edge_cases(spark, docs_of):
    long = "word " * 30_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one two"), (6, long), (7, long), (8, "a b c d"), (8, "a b c d"), (None, "one two")]
    got = near_duplicates(docs_of(rows), "doc_id").collect()
    assert len(got) == 10 and {r.ids for r in got} == {"extra"}
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].component_id == by_id[2].component_id == by_id[3].component_id == 1 and by_id[1].fingerprint == "0" * 16
    assert by_id[5].component_id == by_id[None].component_id == 4 and by_id[7].component_id == 6
    assert near_duplicates(docs_of([]), "doc_id").collect() == []


def test_one_of_each_keeps_rows_of_null_and_shared_ids(spark, docs_of):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(None, text(0)), (None, text(1)), (None, text(1)), (7, text(2)), (7, text(3)), (8, text(4)), (None, text(4)), (9, text(3).upper()), (5, text(5)), (5, text(5)), (3, None), (2, " ")]
    docs = docs_of(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    want = [(0, text(0)), (0, text(1)), (7, text(2)), (7, text(3)), (8, text(4)), (5, text(5)), (2, " ")]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(want)
    marked = near_duplicates(docs).collect()
    assert len(marked) == len(rows)
    assert len({(r.text, r.fingerprint) for r in marked}) == len({t for _, t in rows})
    assert one_of_each(docs_of([])).collect() == []


def test_columns_named_as_those_inside_stay(spark, docs_of):
    names = ("_id", "_same", "_copy", "fp", "root", "least", "key")
    docs = docs_of([(1, "a b c d"), (2, "A b c d"), (3, "other words are here")])
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id")))
    for found, ids in ((one_of_each(docs), [1, 3]), (near_duplicates(docs), [1, 2, 3])):
        rows = sorted(found.collect(), key=lambda r: r.doc_id)
        assert [r.doc_id for r in rows] == ids and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_components_of_chains_stars_and_nulls(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200), (202, 201)]
    got = dict(components(spark.createDataFrame(links, "x long, y long")).collect())
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 160)}, **{k: 200 for k in (200, 201, 202)}}
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []
