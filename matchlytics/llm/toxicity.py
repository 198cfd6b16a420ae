"""Toxicity by weak supervision: voters, a generative model of their accuracies and correlations, a linear classifier.

Voters are groups of lexicon entries (words and word beginnings that toxic documents of a bounded labelled sample have
significantly and far more often), by kind and by how much more often, and patterns of the text. How the voters vote together over all documents gives, without labels, how far each
can be trusted and which ones repeat each other. The model's posterior labels then train the classifier that scores.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from matchlytics.llm.common import list_array, map_blocks, stored, utf8
from matchlytics.llm.sentencepiece import Recent
from matchlytics.llm.sums import matrix, vector_sum

#: Lengths of word beginnings in the lexicon, in characters.
PREFIXES = (4, 5, 6)
KINDS = ("word", *(f"begin{n}" for n in PREFIXES))
#: Each kind of entry has a group for each band of odds, from these multiples of the least odds downwards; the patterns follow.
STEPS = (20.0, 5.0, 2.0)
BANDS = len(STEPS) + 1
PATTERNS = ("shouting", "exclaiming", "drawn out", "hidden letters")
VOTERS = BANDS * len(KINDS) + len(PATTERNS)
WIDTH = 1 + 2 * VOTERS + 1
_EDGES = ".,;:!?\"'()[]|*#$%&<>-"
_DRAWN = re.compile(rb"([a-z])\1\1\1")
_HIDDEN = re.compile(rb"[a-z][0-9@$][a-z]")


def entries_of(word: str) -> list[str]:
    """The lexicon entries that a word may match, as kind and text."""
    core = word.strip(_EDGES)
    if len(core) < 2:
        return []
    return [f"0{core}", *(f"{k}{core[:n]}" for k, n in enumerate(PREFIXES, 1) if len(core) >= n)]


def _terms(docs: DataFrame, text: str) -> DataFrame:
    """(term, n): documents that have each entry."""
    schema = "term string, n long"

    def make():
        known = Recent(entries_of, 100_000)

        def step(batch: pa.RecordBatch) -> dict:
            found: Counter = Counter()
            for data in utf8(batch.column(0)):
                found.update({e for w in set(data.decode().lower().split()) for e in known[w]})
            return {"term": list(found), "n": list(found.values())}

        return step

    counts = map_blocks(docs.select(text), make, T._parse_datatype_string(schema), text)
    return counts.groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, least: int = 5, ratio: float = 10.0, evidence: float = 15.0) -> dict[str, int]:
    """Entry to voter, from the sample of labels, which must be small enough to be broadcast.

    All entries that ``least`` toxic documents have are tested. They are taken if the share of toxic documents is ``ratio`` times
    that of the others (with half a document added) and the log-likelihood ratio (G) of the two counts is ``evidence`` or more.
    The number of entries is bounded by the sample's words.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), text).join(F.broadcast(labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_y"))), "_id")
    n = {r["_y"]: r["n"] for r in labels.groupBy(F.col(label).alias("_y")).agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return {}
    toxic = _terms(rows.where("_y = 1"), text).where(F.col("n") >= least)
    both = toxic.join(_terms(rows.where("_y = 0"), text).withColumnRenamed("n", "others"), "term", "left").select("term", "n", F.coalesce("others", F.lit(0)).alias("others"))
    share = n[1] / (n[0] + n[1])

    def excess(seen: Column, all_seen: Column, part: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (all_seen * part))).otherwise(0.0)

    def half(a: Column, b: Column) -> Column:
        return excess(a, a + b, share) + excess(b, a + b, 1 - share)

    a, b = F.col("n"), F.col("others")
    tested = both.withColumn("odds", (a / n[1]) / ((b + 0.5) / (n[0] + 1))).withColumn("g", 2 * (half(a, b) + half(F.greatest(n[1] - a, F.lit(0)), F.greatest(n[0] - b, F.lit(0)))))
    found = tested.where((F.col("odds") >= ratio) & (F.col("g") >= evidence)).select("term", "odds").collect()
    return {r["term"]: BANDS * int(r["term"][0]) + sum(r["odds"] < step * ratio for step in STEPS) for r in found}


def votes_of(text: bytes, voters: Recent) -> np.ndarray:
    """How often each voter speaks up in the text."""
    out = np.zeros(VOTERS + 1)
    words = text.decode().lower().split()
    for hits in map(voters.__getitem__, words):
        for v in hits:
            out[v] += 1
    n = len(words)
    at = BANDS * len(KINDS)
    letters = len(re.findall(rb"[A-Za-z]", text)) if n else 0
    out[at] = bool(letters > 20 and sum(text.count(bytes([b])) for b in range(65, 91)) > 0.5 * letters)
    out[at + 1] = text.count(b"!") if text.count(b"!") > 0.05 * n else 0
    out[at + 2] = len(_DRAWN.findall(text))
    out[at + 3] = len(_HIDDEN.findall(text))
    out[-1] = n
    return out


def with_votes(docs: DataFrame, entries: dict[str, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, bits, features): which voters vote for toxic, and what the classifier sees."""
    schema = T.StructType([docs.schema[doc_id], T.StructField("bits", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))])
    shared = docs.sparkSession.sparkContext.broadcast(entries)

    def make():
        known = shared.value
        voters = Recent(lambda w: sorted({known[e] for e in entries_of(w) if e in known}), 200_000)

        def step(batch: pa.RecordBatch) -> dict:
            found = np.array([votes_of(t, voters) for t in utf8(batch.column(1))])
            counts, n = found[:, :-1], found[:, -1:]
            bits = ((counts > 0) << np.arange(VOTERS)).sum(1)
            x = np.hstack([np.ones_like(n), np.log1p(counts), np.log1p(100 * counts / np.maximum(n, 1)), np.log1p(n) / 10])
            return {doc_id: batch.column(0), "bits": pa.array(bits), "features": list_array(x.ravel(), np.full(len(x), WIDTH), pa.float64())}

        return step

    return map_blocks(docs.select(doc_id, text), make, schema, text)


@dataclass
class LabelModel:
    """P(vote | toxic), P(vote | clean), the share of toxic documents, and what a vote counts beside those like it."""

    toxic: np.ndarray
    clean: np.ndarray
    prior: float
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        a, b = np.log(self.toxic / self.clean), np.log((1 - self.toxic) / (1 - self.clean))
        logit = np.log(self.prior / (1 - self.prior)) + (votes * a + (1 - votes) * b) @ self.weight
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 30) -> LabelModel:
    """Expectation-maximisation over the vote patterns of all documents.

    Correlations of two voters among the documents of one class make their votes count less: each is divided by one and
    the sum of its positive correlations with the others, averaged over the classes.
    """
    lexical = np.arange(VOTERS) < BANDS * len(KINDS)
    own = (votes * counts[:, None]).sum(0) / max(1, counts.sum())
    model = LabelModel(np.where(lexical, 0.3, np.clip(own, 1e-3, 0.9)), np.where(lexical, 0.01, np.clip(own, 1e-3, 0.9)), min(max(prior, 1e-3), 0.5), np.full(VOTERS, 0.5))
    for _ in range(rounds):
        p = model.posterior(votes)
        rates, like = [], np.zeros((VOTERS, VOTERS))
        for q in (p * counts, (1 - p) * counts):
            rate = (q @ votes + 0.5) / (q.sum() + 1)
            cov = (votes - rate).T @ ((votes - rate) * q[:, None]) / (q.sum() + 1)
            spread = np.sqrt(np.diag(cov) + 1e-9)
            like += np.maximum(cov / np.outer(spread, spread), 0) / 2
            rates.append(np.clip(rate, 1e-5, 1 - 1e-5))
        np.fill_diagonal(like, 0)
        # A lexicon voter speaks for toxic, never against it.
        toxic = np.where(lexical, np.maximum(rates[0], rates[1]), rates[0])
        share = float(np.clip((p * counts).sum() / max(1, counts.sum()), 1e-4, 0.5))
        model = LabelModel(toxic, rates[1], share, 1 / (1 + like.sum(1)))
    return model


def fit_classifier(rows: DataFrame, model: LabelModel, ridge: float = 1.0, rounds: int = 8) -> np.ndarray:
    """Weights of a logistic regression on posterior labels, by Newton steps whose sums are taken over the cluster."""
    weights = np.zeros(WIDTH)
    for _ in range(rounds):
        w = weights

        def part(batch: pa.RecordBatch) -> np.ndarray:
            x = matrix(batch.column(1), WIDTH)
            target = model.posterior((batch.column(0).to_numpy(zero_copy_only=False)[:, None] >> np.arange(VOTERS)) & 1)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            return np.concatenate([x.T @ (target - p), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])

        sums = vector_sum(rows.select("bits", "features"), WIDTH + WIDTH * WIDTH, part)
        gradient, curve = sums[:WIDTH] - ridge * w, sums[WIDTH:].reshape(WIDTH, WIDTH) + ridge * np.eye(WIDTH)
        step = np.linalg.solve(curve, gradient)
        weights = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-3:
            break
    return weights


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_labels: int = 200_000) -> DataFrame:
    """(doc_id, score) for every row of ``docs``; score is the probability of label 1, from 0 to 1.

    Of ``labels`` at most about ``max_labels`` rows are used, chosen by a hash of the id; they are broadcast, make the
    lexicon and the first guess of the share of toxic documents. Votes, their model and the classifier cover all documents.
    Null texts are empty; null labels count for nothing; repeated rows are scored each. Without labels of both classes
    there is no lexicon: only patterns vote, and scores stay near the prior.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(doc_id, F.col(label).cast("int").alias(label))
    n = known.count()
    chosen = F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) < int(min(1.0, max_labels / max(1, n)) * (1 << 30))
    sample = stored(known.where(chosen))
    share = sample.agg(F.avg(label)).first()[0]
    entries = lexicon(docs, sample, doc_id, text, label)
    rows = stored(with_votes(docs, entries, doc_id, text))
    patterns = rows.groupBy("bits").agg(F.count("*").alias("n")).toPandas()  # at most 2 ** VOTERS
    bits = patterns["bits"].to_numpy(np.int64)
    model = fit_label_model((bits[:, None] >> np.arange(VOTERS) & 1).astype(float), patterns["n"].to_numpy(float), 0.05 if share is None else share)
    weights = fit_classifier(rows, model)
    schema = T.StructType([docs.schema[doc_id], T.StructField("score", T.DoubleType())])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            return {doc_id: batch.column(0), "score": pa.array(1 / (1 + np.exp(-np.clip(matrix(batch.column(2), WIDTH) @ weights, -40, 40))))}

        return step

    return map_blocks(rows, make, schema, "features")
