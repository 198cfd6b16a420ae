"""The trie of conversations' shared beginnings, from vertical bitmaps.

A shard holds some thousand conversations over a block of positions. Its index maps (position, turn) to a bitset of the
shard's conversations; a node's bitset is intersected with the postings of the next position, depth first, and what is not
empty is a child. Popcounts and end lists of the shards are added up by node, whose key is a 128-bit hash of its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from matchlytics.llm.common import on_workers, stored

#: Positions in a block, conversations and turns in a shard. They bound a task's memory; results don't depend on them.
SPAN, CONVS, TURNS = 1024, 2048, 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["k1", "k2", "depth"]


def numbered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, h1, h2, words): each turn's place in its conversation from 0, its 128-bit hash, its words. A written table.

    Turns are ordered by ``turn``, null first; those of one turn by role, the first 64 characters of the text, and hash.
    Null role or text is empty; rows without a conv_id belong to no conversation. Rows are sorted over the whole cluster, so
    that a conversation of any length is spread over many tasks, and counted on from the task before.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(text, F.lit(1), role).alias("h2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["conv", "turn", "role", "head", "h1", "h2"]
    rows = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "h1", "h2", "words", F.monotonically_increasing_id().alias("at")))
    task = F.shiftright("at", 33)
    before = Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("conv", task.alias("task")).agg(F.min("at").alias("first"), F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return stored(rows.withColumn("task", task).join(runs, ["conv", "task"]).select("conv", (F.col("at") - F.col("first") + F.col("offset")).alias("pos"), "h1", "h2", "words"))


def lengths_of(turns: DataFrame) -> DataFrame:
    """(conv, length) of conversations as they are."""
    return turns.groupBy("conv").agg(F.count("*").alias("length"))


def forked(turns: DataFrame, stride: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as another one: the turns, and (conv, length) of all, also those left without a turn.

    Conversation c begins with the first h turns of c - c % ``stride`` (all if it has fewer, none if it is absent) and goes
    on with its own after its first h, where h is the crc32 of c in decimal, modulo ``most``.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    own = lengths_of(turns).withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % stride)
    bases = own.where(F.col("conv") == F.col("base")).select("base", F.col("length").alias("there"))
    shared = F.least("h", F.coalesce("there", F.lit(0)))
    convs = stored(own.join(bases, "base", "left").select("conv", "base", "h", shared.alias("shared"), (F.greatest(F.col("length") - F.col("h"), F.lit(0)) + shared).alias("length")))
    kept = turns.where(F.col("pos") >= h).join(convs, "conv").select("conv", (F.col("pos") - F.col("h") + F.col("shared")).alias("pos"), "h1", "h2", "words")
    heads = turns.where((F.col("conv") % stride == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv", "base")
    lent = convs.join(heads, "base").where(F.col("pos") < F.col("shared")).select("conv", "pos", "h1", "h2", "words")
    return stored(kept.unionByName(lent)), convs.select("conv", "length")


def _wrapped(total: Column) -> Column:
    """A decimal sum modulo 2^64, as a signed long."""
    size = F.lit(str(1 << 64)).cast("decimal(38,0)")
    rest = F.pmod(total, size)
    return F.when(rest >= F.lit(str(1 << 63)).cast("decimal(38,0)"), rest - size).otherwise(rest).cast("long")


def _with_marks(turns: DataFrame, convs: DataFrame, span: int) -> DataFrame:
    """Turns dealt to blocks of positions, and before those of each (block, conversation) a mark with the key up to there.

    The key of a conversation's first d turns is the sum of two hashes of (position, turn), so that blocks far into a long
    conversation know theirs from sums. Marks have position -1 and the conversation's length.
    """
    place = F.col("pos")
    rows = turns.select(
        F.floor(place / span).cast("long").alias("block"), "conv", "pos",
        F.xxhash64("h1", "h2", "pos").alias("x"), F.xxhash64("h2", "pos", "h1").alias("y"), "words", F.lit(None).cast("long").alias("length"),
    )
    nothing = F.lit(0).cast("long")
    first = convs.select(nothing.alias("block"), "conv", F.lit(-1).cast("long").alias("pos"), nothing.alias("x"), nothing.alias("y"), nothing.alias("words"), "length")
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.col("x").cast("decimal(20,0)"), F.col("y").cast("decimal(20,0)")
    later = (
        rows.join(convs.where(F.col("length") > span).select("conv", F.col("length").alias("all")), "conv")
        .groupBy("conv", "block")
        .agg(F.sum(whole[0]).alias("x"), F.sum(whole[1]).alias("y"), F.max("all").alias("length"))
        .select("block", "conv", F.lit(-1).cast("long").alias("pos"), *[_wrapped(F.sum(F.col(c).cast("decimal(38,0)")).over(upto)).alias(c) for c in "xy"], nothing.alias("words"), "length")
        .where(F.col("block") > 0)
    )
    return rows.unionByName(first).unionByName(later)


def _members(bits: int) -> list[int]:
    if bits.bit_count() == 1:
        return [bits.bit_length() - 1]
    data = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little")).tolist()


def shard_nodes(block: int, span: int, conv: np.ndarray, pos: np.ndarray, x: np.ndarray, y: np.ndarray, words: np.ndarray, length: np.ndarray) -> dict:
    """The nodes that a shard's conversations pass in a block. Rows are by conversation and position, marks first."""
    marks = np.flatnonzero(pos < 0)
    sizes = np.diff(np.append(marks, len(conv))) - 1
    owner = np.repeat(np.arange(len(marks)), sizes + 1)
    with np.errstate(over="ignore"):
        keys = [np.cumsum(v.view(np.uint64), dtype=np.uint64) for v in (x, y)]
        keys = [c - (c[marks] - v.view(np.uint64)[marks])[owner] for c, v in zip(keys, (x, y))]

    # Vertical index: a code for each (position, turn), and the bitset of its conversations.
    order = np.lexsort((y, x, pos))
    new = np.ones(len(order), bool)
    new[1:] = np.any([v[order][1:] != v[order][:-1] for v in (pos, x, y)], 0)
    code = np.empty(len(order), np.int64)
    code[order] = np.cumsum(new) - 1
    code, one, who = code.tolist(), [1 << i for i in range(len(marks))], owner.tolist()
    postings = [0] * (max(code, default=-1) + 1)
    alive = [0] * (int(sizes.max(initial=0)) + 1)
    local = (pos - block * span).tolist()
    for r, d in enumerate(local):
        if pos[r] >= 0:
            postings[code[r]] |= one[who[r]]
            alive[d] |= one[who[r]]
    final = sum(one[i] for i in np.flatnonzero(sizes + block * span == length[marks]))

    start, stop = marks.tolist(), np.append(marks[1:], len(conv)).tolist()
    roots: dict[tuple[int, int], int] = {}
    for i, r in enumerate(start):
        at = int(keys[0][r]), int(keys[1][r])
        roots[at] = roots.get(at, 0) | one[i]
    found: list[int] = []
    counts: list[int] = []
    ends: dict[int, list[int]] = {}

    def emit(r: int, bits: int, over: int) -> None:
        if over:
            ends[len(found)] = _members(over)
        found.append(r)
        counts.append(bits.bit_count())

    stack = [(bits, 0) for bits in roots.values()]
    if block == 0:
        for bits, _ in stack:
            emit(start[(bits & -bits).bit_length() - 1], bits, bits & ~alive[0] & final)
    while stack:
        bits, d = stack.pop()
        rest = bits & alive[d]
        while rest:
            i = (rest & -rest).bit_length() - 1
            r = start[i] + 1 + d
            child = rest & postings[code[r]]
            rest ^= child
            if child == one[i]:  # alone from here on
                found.extend(range(r, stop[i]))
                counts.extend([1] * (stop[i] - r))
                if final & child:
                    ends[len(found) - 1] = [i]
                continue
            emit(r, child, child & ~alive[d + 1] & final)
            if child & alive[d + 1]:
                stack.append((child, d + 1))

    rows = np.array(found, np.int64)
    depth = np.where(pos[rows] < 0, 0, pos[rows] + 1)
    above = np.where(depth > 0, rows - 1, rows)
    signed = [k.view(np.int64) for k in keys]
    ids = conv[marks]
    return {
        "k1": signed[0][rows], "k2": signed[1][rows], "depth": depth, "p1": signed[0][above], "p2": signed[1][above],
        "conv": conv[rows], "n": np.array(counts, np.int64), "words": words[rows], "ends": [ids[ends[k]].tolist() if k in ends else None for k in range(len(found))],
    }


LOCAL = pa.schema([*[(c, pa.int64()) for c in ("k1", "k2", "depth", "p1", "p2", "conv", "n", "words")], ("ends", pa.list_(pa.int64()))])


def _in_shards(rows: DataFrame, span: int, convs: int, turns: int) -> DataFrame:
    """``shard_nodes`` of all shards. Rows stream through a task in order; it holds one shard."""
    names = ["block", "conv", "pos", "x", "y", "words", "length"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * len(names)

        def shards(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            heads = np.flatnonzero(held[2] < 0)  # each (block, conversation) begins with its mark
            whole = np.append(heads, len(held[0])) if last else heads  # the last one may go on in the next batch
            blocks, at = held[0][heads], 0
            while at + 1 < len(whole):
                limits = np.searchsorted(blocks, blocks[at], "right"), at + convs, np.searchsorted(whole, whole[at] + turns)
                stop = int(min(limits))
                if stop >= len(whole):
                    if not last:
                        break
                    stop = len(whole) - 1
                a, b = whole[at], whole[stop]
                part = shard_nodes(int(blocks[at]), span, *[c[a:b] for c in held[1:]])
                yield pa.RecordBatch.from_arrays([pa.array(part[f.name], f.type) for f in LOCAL], schema=LOCAL)
                at = stop
            rest = whole[at] if len(whole) else 0
            held = [c[rest:] for c in held]

        for batch in batches:
            held = [np.concatenate([h, batch.column(n).fill_null(0).to_numpy(zero_copy_only=False)]) for h, n in zip(held, names)]
            yield from shards(False)
        yield from shards(True)

    on_workers(rows.sparkSession)
    placed = rows.repartitionByRange("block", "conv").sortWithinPartitions("block", "conv", "pos").select(*names)
    return placed.mapInArrow(run, "k1 long, k2 long, depth long, p1 long, p2 long, conv long, n long, words long, ends array<long>")


@dataclass
class Trie:
    """``nodes``: (k1, k2, depth, p1, p2, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens).
    ``ends``: (k1, k2, depth, first, convs): the conversations ending in a node, ascending, in pieces of bounded size."""

    nodes: DataFrame
    ends: DataFrame


def _totals(chains: DataFrame) -> DataFrame:
    """(conv, leaves, saved) with all chains below added, by doubling the distance to the ancestor: rounds are logarithmic."""
    now = stored(chains)
    while not now.where(F.col("above").isNotNull()).isEmpty():
        more = now.where(F.col("above").isNotNull()).groupBy(F.col("above").alias("conv")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        next_up = now.select(F.col("conv").alias("above"), F.col("above").alias("next"))
        now = stored(
            now.join(more, "conv", "left").join(next_up, "above", "left").select(
                "conv", F.col("next").alias("above"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")
            )
        )
    return now


def build_trie(turns: DataFrame, convs: DataFrame, span: int = SPAN, shard_convs: int = CONVS, shard_turns: int = TURNS) -> Trie:
    """The trie of (conv, pos, h1, h2, words), positions from 0 without gaps, and (conv, length) of all conversations.

    Each node is named by its smallest member ``conv_id`` and ``depth``. n_convs: conversations that begin with its turns;
    n_leaves: childless nodes in its subtree, itself included; saved_tokens: over its subtree, (n_convs - 1) times the words
    of the node's last turn. Without conversations there is no node. Identical conversations share all their nodes.

    A node's smallest member is also that of a run of nodes below it: the chain of this conversation. Chains hang on others,
    and subtree sums are those of chains (a row a conversation) plus running sums along a chain, in blocks of ``span``. No
    step holds all members of a node: a common turn is one row a shard, added up before and after the shuffle.
    """
    local = stored(_in_shards(_with_marks(turns, convs, span), span, shard_convs, shard_turns))
    nodes = stored(
        local.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.sum("n").alias("n"), F.min("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
        .withColumn("saved", (F.col("n") - 1) * F.when(F.col("depth") > 0, F.col("words")).otherwise(0))
    )

    # Where each chain begins, ends and hangs.
    chains = nodes.groupBy("conv").agg(F.min("depth").alias("top"), F.max("depth").alias("last"), F.min_by("p1", "depth").alias("k1"), F.min_by("p2", "depth").alias("k2"), F.sum("saved").alias("saved"))
    above = nodes.select("k1", "k2", F.col("depth").alias("hook"), F.col("conv").alias("above"))
    chains = stored(chains.withColumn("hook", F.when(F.col("top") > 0, F.col("top") - 1)).join(above, ["k1", "k2", "hook"], "left").select("conv", "top", "last", "saved", "above", "hook"))
    hung = chains.where(F.col("above").isNotNull())
    at_end = hung.select(F.col("above").alias("conv"), F.col("hook").alias("last")).distinct().withColumn("more", F.lit(True))
    leaves = F.when(F.col("more").isNull(), 1).otherwise(0).cast("long")
    totals = _totals(chains.join(at_end, ["conv", "last"], "left").select("conv", "above", leaves.alias("leaves"), "saved"))

    # What meets each node: chains hanging there, the start and the end of its own chain.
    none = F.lit(None).cast("long")
    events = (
        hung.join(totals.select("conv", "leaves", F.col("saved").alias("below")), "conv")
        .select(F.col("above").alias("conv"), F.col("hook").alias("depth"), F.lit(1).cast("long").alias("hanging"), "leaves", "below", none.alias("parent"), F.lit(False).alias("end"))
        .unionByName(chains.select("conv", F.col("top").alias("depth"), none.alias("hanging"), none.alias("leaves"), none.alias("below"), F.col("above").alias("parent"), F.lit(False).alias("end")))
        .unionByName(chains.select("conv", F.col("last").alias("depth"), none.alias("hanging"), none.alias("leaves"), none.alias("below"), none.alias("parent"), F.lit(True).alias("end")))
        .groupBy("conv", "depth")
        .agg(F.coalesce(F.sum("hanging"), F.lit(0)).alias("hanging"), F.sum("leaves").alias("leaves"), F.sum("below").alias("below"), F.max("parent").alias("parent"), F.max("end").alias("end"))
    )
    children = F.coalesce("hanging", F.lit(0)) + F.when(F.coalesce("end", F.lit(False)), 0).otherwise(1)
    met = stored(
        nodes.join(events, ["conv", "depth"], "left")
        .withColumn("n_children", children)
        .select(
            *KEY, "p1", "p2", "conv", "n", "n_children", F.floor(F.col("depth") / span).cast("long").alias("block"),
            F.when(F.col("depth") > 0, F.coalesce("parent", "conv")).alias("parent"),
            (F.coalesce("leaves", F.lit(0)) + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
            (F.col("saved") + F.coalesce("below", F.lit(0))).alias("saved"),
        )
    )
    after = Window.partitionBy("conv").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = met.groupBy("conv", "block").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).select("conv", "block", F.sum("l").over(after).alias("l"), F.sum("s").over(after).alias("s")).where(F.col("l").isNotNull())
    down = Window.partitionBy("conv", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    done = met.withColumns({c: F.sum(c).over(down) for c in ("leaves", "saved")}).join(later, ["conv", "block"], "left")
    return Trie(
        done.select(
            *KEY, "p1", "p2", F.col("conv").alias("conv_id"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        ),
        local.where(F.col("ends").isNotNull()).select(*KEY, F.col("ends")[0].alias("first"), F.col("ends").alias("convs")),
    )


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Trie:
    """The trie of whole conversations, as ``numbered`` orders their turns. Only the four columns named are read."""
    turns = numbered(conversations, conv_id, turn, role, text)
    return build_trie(turns, lengths_of(turns))


def with_turns(nodes: DataFrame, conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Adds each node's last role and text (null at the root), for a trie of ``prefix_trie``."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    hashed = conversations.select(F.xxhash64(role_, text_).alias("h1"), F.xxhash64(text_, F.lit(1), role_).alias("h2"), role_.alias("role"), text_.alias("text")).groupBy("h1", "h2").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    turns = numbered(conversations, conv_id, turn, role, text).select(F.col("conv").alias("conv_id"), (F.col("pos") + 1).alias("depth"), "h1", "h2")
    return nodes.join(turns, ["conv_id", "depth"], "left").join(hashed, ["h1", "h2"], "left").drop("h1", "h2")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256): of the decimal ids ending in each node, ascending, comma-joined.

    Pieces of a node stream in order through one hasher, as SHA-256 asks for; a task holds one batch of pieces.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hasher, done = None, None, []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*done)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 3 else pa.string()) for k, c in enumerate(columns)], names=[*KEY, "ends_sha256"])

        for batch in batches:
            for key, convs in zip(zip(*[batch.column(c).to_pylist() for c in KEY]), batch.column("convs")):
                joined = ",".join(map(str, convs.as_py())).encode()
                if key == now:
                    hasher.update(b"," + joined)
                else:
                    if now:
                        done.append((*now, hasher.hexdigest()))
                    now, hasher = key, hashlib.sha256(joined)
            yield rows()
            done = []
        if now:
            done.append((*now, hasher.hexdigest()))
        yield rows()

    on_workers(ends.sparkSession)
    placed = ends.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "convs")
    return placed.mapInArrow(run, "k1 long, k2 long, depth long, ends_sha256 string")
