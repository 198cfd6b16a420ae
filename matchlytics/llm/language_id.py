"""Language identification by a bidirectional gated recurrent network over bytes, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from matchlytics.llm.common import map_blocks, on_workers, stored, utf8, with_schema

#: Hidden units of a direction; bytes of a window, over which the network runs from a zero state; windows handled at a time.
HIDDEN, SPAN, LANES = 12, 64, 2048
UNKNOWN = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def _softsign(x: np.ndarray, scratch: np.ndarray) -> None:
    """x / (1 + |x|) in place."""
    np.abs(x, out=scratch)
    scratch += 1
    x /= scratch


@dataclass
class Network:
    """Weights by direction (forward, backward): of the input byte, of the state, and of the output.

    Gates z, r and candidate n stand one below the other. With s(x) = x / (1 + |x|): z, r = (1 + s(..)) / 2,
    n = s(input + r * (state weights @ h)), h' = n + z * (h - n).
    """

    langs: list[str]
    byte: np.ndarray  # 2 x 3 hidden x 256
    state: np.ndarray  # 2 x 3 hidden x hidden
    bias: np.ndarray  # 2 x 3 hidden
    out: np.ndarray  # 2 x languages x hidden
    base: np.ndarray  # languages

    @classmethod
    def start(cls, langs: Sequence[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        return cls(list(langs), draw(0.3, 2, 3 * hidden, 256), draw(hidden**-0.5, 2, 3 * hidden, hidden), np.zeros((2, 3 * hidden), np.float32), draw(hidden**-0.5, 2, len(langs), hidden), np.zeros(len(langs), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.byte, self.state, self.bias, self.out, self.base]

    def packed(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights()])

    def unpacked(self, values: np.ndarray) -> Network:
        found, at = [], 0
        for w in self.weights():
            found.append(np.array(values[at : at + w.size], w.dtype).reshape(w.shape))
            at += w.size
        return Network(self.langs, *found)

    def probabilities(self, windows: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
        """For each position the probabilities (language, window) of the windows that reach it.

        ``windows`` (position, window) of bytes, windows by falling size. At each step only those long enough take part.
        """
        span, lanes = windows.shape
        hidden = self.state.shape[2]
        reach = np.searchsorted(-sizes, -np.arange(span))  # windows with more than t bytes
        logits = np.empty((span, len(self.langs), lanes), np.float32)
        for way in range(2):
            table = self.byte[way] + self.bias[way][:, None]
            h = np.zeros((hidden, lanes), np.float32)
            a, g = np.empty((2, 3 * hidden, lanes), np.float32)
            scratch = np.empty((2 * hidden, lanes), np.float32)
            for t in range(span) if way == 0 else range(span - 1, -1, -1):
                k = reach[t]
                if not k:
                    continue
                full = k == lanes
                at, gt, st, ht = (a, g, scratch, h) if full else (np.empty((3 * hidden, k), np.float32), np.empty((3 * hidden, k), np.float32), scratch[:, :k], h[:, :k])
                np.take(table, windows[t, :k], axis=1, out=at, mode="clip")
                np.matmul(self.state[way], ht, out=gt)
                gates, n = at[: 2 * hidden], at[2 * hidden :]
                gates += gt[: 2 * hidden]
                _softsign(gates, st)
                gates *= 0.5
                gates += 0.5
                gt[2 * hidden :] *= gates[hidden:]
                n += gt[2 * hidden :]
                _softsign(n, st[:hidden])
                ht -= n
                ht *= gates[:hidden]
                ht += n
                if way == 0:
                    logits[t, :, :k] = self.out[0] @ ht
                else:
                    logits[t, :, :k] += self.out[1] @ ht
        for t in range(span):
            p = logits[t, :, : reach[t]]
            p += self.base[:, None]
            p -= p.max(0)
            np.exp(p, out=p)
            p /= p.sum(0)
            yield p

    def label_text(self, text: bytes) -> np.ndarray:
        """Probabilities (position, language) of every byte of a text."""
        data = np.frombuffer(text, np.uint8)
        return np.concatenate([np.stack([p[:, 0] for p in self.probabilities(data[at : at + SPAN, None], np.array([min(SPAN, len(data) - at)]))]) for at in range(0, len(data), SPAN)] or [np.empty((0, len(self.langs)))])

    def pooled(self, texts: Sequence[bytes]) -> np.ndarray:
        """Mean probabilities (text, language) over all positions; zeros for an empty text."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        sizes = np.diff(ends, prepend=0)
        counts = -(-sizes // SPAN)
        text = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = (ends - sizes)[text] + place * SPAN
        lengths = np.minimum(SPAN, ends[text] - starts)
        total = np.zeros((len(texts), len(self.langs)))
        order = np.argsort(-lengths, kind="stable")
        for a in range(0, len(order), LANES):
            lanes = order[a : a + LANES]
            size = lengths[lanes]
            windows = data[np.minimum(starts[lanes] + np.arange(size[0])[:, None], len(data) - 1)]
            found = np.zeros((len(self.langs), len(lanes)), np.float32)
            for p in self.probabilities(windows, size):
                found[:, : p.shape[1]] += p
            for k, row in enumerate(found):
                total[:, k] += np.bincount(text[lanes], row, len(texts))
        return total / np.maximum(sizes, 1)[:, None]

    def gradient(self, windows: np.ndarray, sizes: np.ndarray, label: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean loss of all positions (each window counting the same) and its gradient, by backpropagation through time."""
        span, lanes = windows.shape
        kind, hidden = self.byte.dtype, self.state.shape[2]
        mask = (np.arange(span)[:, None] < sizes).astype(kind)
        saved = [[], []]
        states = np.zeros((2, span, hidden, lanes), kind)
        for way in range(2):
            h = np.zeros((hidden, lanes), kind)
            for t in range(span) if way == 0 else range(span - 1, -1, -1):
                a = self.byte[way][:, windows[t]] + self.bias[way][:, None]
                g = self.state[way] @ h
                s = a[: 2 * hidden] + g[: 2 * hidden]
                s /= 1 + np.abs(s)
                z, r = 0.5 + 0.5 * s[:hidden], 0.5 + 0.5 * s[hidden:]
                n = a[2 * hidden :] + r * g[2 * hidden :]
                n /= 1 + np.abs(n)
                saved[way].append((t, h, s, z, r, n, g[2 * hidden :]))
                h = (n + z * (h - n)) * mask[t]
                states[way, t] = h
        logits = np.einsum("wlh,wthb->tlb", self.out, states, optimize=True) + self.base[:, None]
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        weight = mask / np.maximum(sizes, 1) / lanes
        picked = p[:, label, np.arange(lanes)]
        loss = -float((np.log(np.maximum(picked, 1e-30)) * weight).sum())
        p[:, label, np.arange(lanes)] -= 1
        p *= weight[:, None, :]
        grads = [np.zeros_like(w) for w in self.weights()]
        grads[3] += np.einsum("tlb,wthb->wlh", p, states, optimize=True)
        grads[4] += p.sum((0, 2))
        for way in range(2):
            dh = np.zeros((hidden, lanes), kind)
            inputs = np.zeros((span, 3 * hidden, lanes), kind)
            for t, before, s, z, r, n, gn in reversed(saved[way]):
                dh = (dh + self.out[way].T @ p[t]) * mask[t]
                dn = dh * (1 - z) * (1 - np.abs(n)) ** 2
                ds = np.concatenate([dh * (before - n), dn * gn]) * 0.5 * (1 - np.abs(s)) ** 2
                inputs[t] = np.concatenate([ds, dn])
                dg = np.concatenate([ds, dn * r])
                grads[1][way] += dg @ before.T
                dh = dh * z + self.state[way].T @ dg
            grads[2][way] += inputs.sum((0, 2))
            of = windows.ravel()
            for k in range(3 * hidden):
                grads[0][way, k] += np.bincount(of, inputs[:, k].ravel(), 256)
        return loss, np.concatenate([g.ravel() for g in grads])


@dataclass
class Adam:
    rate: float
    first: np.ndarray | float = 0.0
    second: np.ndarray | float = 0.0
    steps: int = field(default=0)

    def step(self, values: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.steps += 1
        self.first = 0.9 * self.first + 0.1 * gradient
        self.second = 0.99 * self.second + 0.01 * gradient**2
        return values - self.rate * (self.first / (1 - 0.9**self.steps)) / (np.sqrt(self.second / (1 - 0.99**self.steps)) + 1e-7)


def _trained_on(network: Network, windows: Sequence[bytes], label: np.ndarray, rate: float, passes: int, batch: int, seed: int) -> np.ndarray:
    """The weights after some passes over a shard's windows."""
    sizes = np.array([len(w) for w in windows])
    data = np.zeros((len(windows), SPAN), np.uint8)
    for k, w in enumerate(windows):
        data[k, : len(w)] = np.frombuffer(w, np.uint8)
    values, adam, rng = network.packed(), Adam(rate), np.random.default_rng(seed)
    for _ in range(passes):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), batch):
            rows = order[a : a + batch]
            _, gradient = network.unpacked(values).gradient(np.ascontiguousarray(data[rows].T), sizes[rows], label[rows])
            values = adam.step(values, gradient).astype(np.float32)
    return values


def sample_windows(labelled: DataFrame, text: str, lang: str, per_lang: int, per_text: int, shards: int) -> tuple[DataFrame, list[str]]:
    """(shard, rank, label, window) of at most ``per_lang`` texts a language, and the languages in order.

    Texts are chosen by hash over all rows; of a text, at most ``per_text`` windows spread evenly over the whole of it.
    """
    rows = labelled.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(*[c for c, kind in labelled.dtypes if not kind.startswith("map")]).alias("rank"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not sizes:
        sizes = {"": 1}
    # Four times as many as wanted by hash alone, without a shuffle; then the first of each language.
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1 << 20, (4 * per_lang << 20) // n + 1))]), F.col("lang"))
    thin = rows.where(F.pmod("rank", F.lit(1 << 20)) < share)
    first = stored(thin.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("rank"))).where(F.col("k") <= per_lang).drop("k"))
    langs = sorted(r.lang for r in first.select("lang").distinct().collect())
    number = {x: k for k, x in enumerate(langs)}

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            found = []
            for lang, text, rank in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
                count = -(-len(text) // SPAN)
                for j in range(min(count, per_text)):
                    at = (j * count // min(count, per_text)) * SPAN
                    found.append((rank % shards, rank, number[lang], text[at : at + SPAN]))
            return {n: [f[k] for f in found] for k, n in enumerate(("shard", "rank", "label", "window"))}

        return step

    return stored(map_blocks(first.select("lang", "text", "rank"), make, T.StructType.fromDDL("shard long, rank long, label long, window binary"))), langs


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", per_lang: int = 500, per_text: int = 12, shards: int = 8, rounds: int = 8, passes: int = 2, batch: int = 192, rate: float = 0.02, hidden: int = HIDDEN) -> Network | None:
    """A network trained on rows of (text, language); None where no text has a language.

    In each round every shard of the sample trains from the same weights in a task of its own; the weights are then
    averaged by the shards' sizes. The sample is bounded by ``per_lang`` and ``per_text``, and so is what a task holds;
    only weights reach the driver. Null languages and empty texts teach nothing.
    """
    windows, langs = sample_windows(labelled, text, lang, per_lang, per_text, shards)
    if not langs:
        return None
    on_workers(labelled.sparkSession)
    dealt = windows.repartitionByRange(shards, "shard")  # a task a shard
    network = Network.start(langs, hidden)
    for turn in range(rounds if len(langs) > 1 else 0):
        now = network

        def local(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["rank", "window"], kind="stable")
            speed = rate * (1 - turn / rounds) + rate / 10
            values = _trained_on(now, rows["window"].tolist(), rows["label"].to_numpy(), speed, passes, batch, turn)
            return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "n": [len(rows)], "weights": [values.astype(np.float32).tobytes()]})

        found = dealt.groupBy("shard").applyInPandas(local, "shard long, n long, weights binary").orderBy("shard").collect()
        total = sum(r.n for r in found)
        network = network.unpacked(sum(np.frombuffer(r.weights, np.float32).astype(float) * (r.n / total) for r in found))
    return network


def _has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def identify(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """The columns of ``docs``, lang_pred, score: the most probable language (ties: the first in order) and its probability.

    Every byte of every text is labelled; a document's probabilities are the mean over its positions. ``und`` with score 0
    for null, empty and letterless texts, and for all where nothing was learned. Texts run in windows of ``SPAN`` bytes, so
    very long ones take memory in proportion to their bytes only. Columns named like the new ones are replaced.
    """
    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score") or c == text]
    named = {c: "text" if c == text else f"c{k}" for k, c in enumerate(own)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in named.items()])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            texts = utf8(batch.column("text"))
            known = np.array([network is not None and _has_letter(t) for t in texts], bool)
            langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if known.any():
                p = network.pooled([t for t, k in zip(texts, known) if k])
                best = p.argmax(1)
                langs[known] = [network.langs[k] for k in best]
                scores[known] = np.clip(p[np.arange(len(p)), best], 0, 1)
            return {n: batch.column(n) for n in named.values()} | {"lang_pred": langs.tolist(), "score": pa.array(scores)}

        return step

    found = map_blocks(plain, make, with_schema(plain, ("lang_pred", T.StringType()), ("score", T.DoubleType())))
    return found.select(*[F.col(n).alias(c) for c, n in named.items()], "lang_pred", "score")


def languages(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``, from a network that learned where ``learn`` is true."""
    network = train(docs.where(learn).select(doc_id, text, lang), text, lang)
    return identify(docs.select(doc_id, text), network, text).drop(text)
