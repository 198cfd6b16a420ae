"""Integer centroid clustering with PCA-rotated filtering: bounds from few coordinates, survivors verified exactly."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from matchlytics.llm.common import list_array, map_blocks, on_workers, stored
from matchlytics.llm.sums import matrix, vector_sum

#: Components below this are squared and summed as 64-bit integers; others as Python's integers, with the same results.
PLAIN = 1 << 25
#: Bytes of vectors that a task handles at a time.
BLOCK = 1 << 20
LONG = (1 << 63) - 1


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles: 64-bit integers where all are small, else Python's."""
    with np.errstate(over="ignore"):
        found = np.floor(x * scale)
    if not x.size or np.abs(found).max() < PLAIN:
        return found.astype(np.int64)
    return np.array([math.floor(Fraction(v) * scale) for v in x.ravel().tolist()], object).reshape(x.shape)


def exact(rows: np.ndarray, centroid: Sequence[int]) -> np.ndarray:
    """Squared distances of integer rows to a centroid of Python integers, never rounded or wrapped."""
    plain = rows.dtype != object and max(map(abs, centroid), default=0) < PLAIN
    gap = rows - np.array(centroid, np.int64) if plain else rows.astype(object) - np.array(centroid, object)
    return (gap * gap).sum(1)


@dataclass
class Rotation:
    """The eigenvectors of the covariance, largest first; ``lead`` of them are kept as coordinates."""

    mean: np.ndarray
    axes: np.ndarray
    lead: int

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Leading coordinates, then the norm of what they leave out. Beyond 1e150 components are cut, which only lowers bounds."""
        turned = (np.clip(rows, -1e150, 1e150).astype(float) - self.mean) @ self.axes
        return np.column_stack([turned[:, : self.lead], np.sqrt((turned[:, self.lead :] ** 2).sum(1))])


def rotation(kept: DataFrame, width: int, scale: int, lead: int) -> Rotation:
    """From the sums and products of all small vectors, added up over the cluster."""

    def part(batch: pa.RecordBatch) -> np.ndarray:
        rows = integers(matrix(batch.column(0).cast(pa.list_(pa.float64())), width), scale)
        rows = rows[(np.abs(rows) < PLAIN).all(1)].astype(float) if rows.dtype == object else rows.astype(float)
        return np.concatenate([[len(rows)], rows.sum(0), (rows.T @ rows).ravel()])

    sums = vector_sum(kept, 1 + width + width * width, part)
    n = max(1.0, sums[0])
    mean = sums[1 : 1 + width] / n
    _, axes = np.linalg.eigh(sums[1 + width :].reshape(width, width) / n - np.outer(mean, mean))
    return Rotation(mean, axes[:, ::-1], min(lead, width))


def nearest(rows: np.ndarray, short: np.ndarray, centroids: Sequence[Sequence[int]], short_centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of each row's nearest centroid (ties: the smaller), and how many distances were computed.

    The squared distance of leading coordinates plus the squared difference of residual norms is never above the true
    one. The centroid of the least bound is verified first; then only those whose bound doesn't exceed what it found.
    """
    size = (short**2).sum(1)[:, None] + (short_centroids**2).sum(1)[None, :]
    bounds = size - 2 * short @ short_centroids.T
    bounds -= 1e-9 * size + 1e-3  # rounding; the true distance is an integer
    first = bounds.argmin(1)
    objects = rows.dtype == object or max((abs(v) for c in centroids for v in c), default=0) >= PLAIN
    best = np.zeros(len(rows), object if objects else np.int64)
    number, verified = first.astype(np.int64), len(rows)
    for k in np.unique(first):
        here = np.flatnonzero(first == k)
        best[here] = exact(rows[here], centroids[k])
    for k, c in enumerate(centroids):
        reach = np.array([float(b) if b < 10**300 else np.inf for b in best]) if objects else best
        here = np.flatnonzero((bounds[:, k] <= reach) & (first != k))
        if not len(here):
            continue
        verified += len(here)
        found = exact(rows[here], c)
        better = (found < best[here]) | ((found == best[here]) & (k < number[here]))
        best[here[better]], number[here[better]] = found[better], k
    return number, best, verified


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A number as signed 32-bit pieces, whose sums over 2^31 tasks still fit into 64 bits."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & 0xFFFFFFFF)
        value, place = value >> 32, place + 1


def _assigner(width: int, scale: int, centroids: list[list[int]], turned: Rotation) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    short_centroids = turned.project(np.array(centroids, object))

    def step(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = integers(matrix(batch.column("vector").cast(pa.list_(pa.float64())), width), scale)
        number, distance, _ = nearest(rows, matrix(batch.column("short"), turned.lead + 1), centroids, short_centroids)
        return rows, number, distance

    return step


def _moved(table: DataFrame, width: int, scale: int, centroids: list[list[int]], turned: Rotation) -> list[list[int]]:
    """The floor of each non-empty cluster's mean. A task sends one sum for each centroid and component."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = _assigner(width, scale, centroids, turned)
        counts, sums = [0] * len(centroids), [[0] * width for _ in centroids]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, number, _ = step(batch)
            for k in np.unique(number):
                own = rows[number == k]
                counts[k] += len(own)
                sums[k] = [a + int(b) for a, b in zip(sums[k], own.sum(0))]
        cells = [(k * (width + 1) + j, place, v) for k, own in enumerate(sums) for j, x in enumerate([counts[k], *own]) for place, v in _limbs(x)]
        yield pa.RecordBatch.from_arrays([pa.array([c[i] for c in cells], pa.int64()) for i in range(3)], names=["cell", "limb", "value"])

    found = table.mapInArrow(run, "cell long, limb long, value long").groupBy("cell", "limb").agg(F.sum("value").alias("value"))
    total = [0] * (len(centroids) * (width + 1))
    for r in found.collect():  # centroids x components x a few pieces, whatever the rows
        total[r.cell] += r.value << (32 * r.limb)
    own = [total[k * (width + 1) : (k + 1) * (width + 1)] for k in range(len(centroids))]
    return [[x // o[0] for x in o[1:]] if o[0] else c for o, c in zip(own, centroids)]


def cluster(vectors: DataFrame, clusters: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, vec_id: str = "vec_id", vector: str = "embedding", lead: int = 12, salt: str = "1", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``vectors`` (None: all), cluster (int), distance (long, squared), cluster_inertia, inertia (long), centroid (array of text).

    Vectors with exactly ``width`` components, none null, NaN or infinite, are kept; a component x becomes floor(scale * x).
    Centroids start as the vectors whose lowercase-hex sha256 of ``<salt>:<vec_id>`` is smallest (repeated ids: by components;
    null ids after all others), in that order; with fewer vectors than ``clusters`` there are as many centroids as vectors.
    Each round assigns all vectors and moves every non-empty centroid to the exact floor of its mean; a last assignment
    follows. Ties go to the smaller number. Repeated rows count each. A distance or sum beyond 64 bits is null; the
    cluster is right all the same. An empty table gives no rows. Columns named like new ones are replaced.

    A table with the vector, ``lead`` coordinates rotated to the principal axes and the residual norm is written once;
    each assignment reads that, compares the few centroids by bounds and verifies those left in integers. Only centroids
    and their sums, of fixed size, reach the driver; nothing is shuffled but a task's sums.
    """
    number = F.col(f"`{vector}`")
    kept = vectors.where((F.size(number) == width) & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    own = [c for c in (vectors.columns if keep is None else keep) if c.lower() not in ("cluster", "distance", "cluster_inertia", "inertia", "centroid") or c in (vec_id, vector)]
    named = {c: "vector" if c == vector else f"c{k}" for k, c in enumerate(own)}
    on_workers(vectors.sparkSession)
    turned = rotation(kept.select(number.cast("array<double>").alias("vector")), width, scale, lead)
    plain = kept.select(number.alias("vector"), F.col(f"`{vec_id}`").alias("id"), *[F.col(f"`{c}`").alias(n) for c, n in named.items() if n != "vector"])
    schema = T.StructType([*plain.schema, T.StructField("short", T.ArrayType(T.DoubleType()))])

    def projected():
        def step(batch: pa.RecordBatch) -> dict:
            rows = matrix(batch.column("vector").cast(pa.list_(pa.float64())), width)
            short = turned.project(integers(rows, scale))
            return {n: batch.column(n) for n in batch.schema.names} | {"short": list_array(short.ravel(), np.full(len(short), short.shape[1]), pa.float64())}

        return step

    table = stored(map_blocks(plain, projected, schema, "vector", BLOCK))
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = table.select(key.alias("key"), "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(clusters).collect()
    centroids = [[int(v) for v in integers(np.array([r.vector], float), scale)[0]] for r in first]
    for _ in range(rounds if centroids else 0):
        centroids = _moved(table, width, scale, centroids, turned)

    out = T.StructType([*[f for f in plain.schema if f.name in named.values()], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def assigned():
        assign = _assigner(width, scale, centroids, turned)

        def step(batch: pa.RecordBatch) -> dict:
            _, k, distance = assign(batch)
            if distance.dtype == object:
                distance = [d if d <= LONG else None for d in distance.tolist()]
            return {n: batch.column(n) for n in named.values()} | {"cluster": pa.array(k, pa.int32()), "distance": pa.array(distance, pa.int64())}

        return step

    # Sums of the last assignment come from a table, so that vectors aren't compared again for the rows.
    found = stored(map_blocks(table, assigned, out, "vector", BLOCK)) if centroids else vectors.sparkSession.createDataFrame([], out)
    sums = {r["cluster"]: r for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), F.max(F.col("distance").isNull()).alias("lost")).collect()}
    inertia = [None if k in sums and (sums[k]["lost"] or sums[k]["d"] > LONG) else int(sums[k]["d"]) if k in sums else 0 for k in range(len(centroids))]
    total = None if None in inertia or sum(inertia) > LONG else sum(inertia)
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    return found.select(
        *[F.col(n).alias(c) for c, n in named.items()],
        "cluster",
        "distance",
        of([F.lit(x).cast("long") for x in inertia] or [F.lit(None).cast("long")]).alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"),
        of([F.array(*[F.lit(str(v)) for v in c]) for c in centroids] or [F.array().cast("array<string>")]).alias("centroid"),
    )
