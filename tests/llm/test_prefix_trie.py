from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F, types as T

from matchlytics.llm.common import on_workers
from matchlytics.llm.prefix_trie import KEY, build_trie, ends_digests, forked, numbered, prefix_trie, with_turns

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("k1", T.StringType())])


def in_order(rows):
    convs: dict = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        convs.setdefault(c, []).append((role or "", text or ""))
    return convs


def as_forked(convs):
    out = {}
    for c, own in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain(convs):
    """Every prefix with its members, from a dictionary."""
    nodes: dict = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children: dict = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[c] for c in children.get(p, [])) or 1
        saved[p] = sum(saved[c] for c in children.get(p, [])) + (len(nodes[p]) - 1) * words
    ends = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in nodes[p] if len(convs[c]) == len(p)))).encode()).hexdigest()
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p], ends(p)) for p, m in nodes.items())


def found(trie):
    rows = trie.nodes.join(ends_digests(trie.ends), KEY, "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or empty) for r in rows)


def table(spark, rows):
    on_workers(spark)
    return spark.createDataFrame([(*r, "mine", "mine") for r in rows], SCHEMA).repartition(4)


def invented(seed, convs=60, most=9):
    """Few distinct turns, so that beginnings are shared; ties, repeated rows, nulls."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(convs), -40, -39, -35, 1 << 40]:
        for _ in range(rng.randrange(most)):
            rows.append((c, rng.choice([None, 0, 1, 1, 2, 3, 5]), rng.choice(["user", "user", None]), rng.choice(["a b", "a b", "a  b\tc", "", None, "ü"])))
        if rows and rng.random() < 0.2:
            rows.append(rows[-1])
    return [*rows, (None, 1, "user", "lost"), (None, None, None, None)]


@pytest.mark.parametrize("span,convs,turns", [(1024, 2048, 1 << 16), (2, 3, 5)])
def test_forked_conversations_equal_brute_force(spark, span, convs, turns):
    rows = invented(1)
    got = build_trie(*forked(numbered(table(spark, rows)), 20, 4), span, convs, turns)
    assert found(got) == plain(as_forked(in_order(rows)))


def test_a_staircase_and_a_long_conversation_over_many_blocks(spark):
    rows = [(0, i, "user", "x y" if i % 3 else "z") for i in range(60)]
    for c in range(1, 25):  # each leaves the one before a little later: chains hang on chains on chains
        rows += [(c, i, "user", ("x y" if i % 3 else "z")) for i in range(2 * c)] + [(c, 100, "assistant", f"own {c // 2}")]
    rows += [(c, i, "system", "the same in all") for c in range(30, 60) for i in range(3)]
    trie = prefix_trie(table(spark, rows))
    assert found(trie) == plain(in_order(rows))
    small = numbered(table(spark, rows))
    assert found(build_trie(small, small.groupBy("conv").agg(F.count("*").alias("length")), 4, 2, 7)) == plain(in_order(rows))
    said = {(r.conv_id, r.depth): (r.role, r.text) for r in with_turns(trie.nodes, table(spark, rows)).collect()}
    convs = in_order(rows)
    assert all(v == (convs[c][d - 1] if d else (None, None)) for (c, d), v in said.items())


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")], [(7, None, None, None)], [(21, 0, "user", "only")], [(5, 0, "user", "word " * 200_000)]])
def test_edges(spark, rows):
    got = build_trie(*forked(numbered(table(spark, rows)), 20, 4))
    assert found(got) == plain(as_forked(in_order(rows)))


def test_an_end_list_over_many_pieces(spark):
    rows = [(c, 0, "user", "all alike") for c in range(500)]
    turns = numbered(table(spark, rows))
    trie = build_trie(turns, turns.groupBy("conv").agg(F.count("*").alias("length")), 4, 16, 1000)
    assert trie.ends.count() > 20 and found(trie) == plain(in_order(rows))
