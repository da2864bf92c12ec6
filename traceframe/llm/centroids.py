"""Centroid clustering in exact integers, with a filter of rotated coordinates.

Vectors are put on an integer grid. The axes are turned to the principal axes of a bounded
sample, and the leading coordinates of every vector are stored beside the length of what is left
(the residual). For a vector and a centroid, the squared distance of the leading
coordinates plus the squared difference of the residual lengths is never more than their squared
distance. So a vector is first compared with the centroid of the least bound, in integers;
of the other centroids only those whose bound does not exceed that distance (with room
for rounding) are verified, in integers as well. The rotation decides how many are spared, never the
result.

A round is one scan: tasks assign their vectors and return, per centroid, how many there are and the
exact sum of each component. The driver gets one row per centroid.

Integers of up to ``narrow_limit`` (27 bits for 64 components) are compared in 64-bit arithmetic, which
cannot overflow; vectors and centroids beyond are compared in Python integers, so that no
finite vector ends the job.

Defined cases: vectors that are null, of another length, or hold null or non-finite components take no
part; rows that repeat an id each count; a row without an id hashes as if its id were the
empty text; equal hashes go by the components; fewer vectors than centroids make as many centroids as
there are vectors; a distance or sum beyond 64 bits is null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from traceframe.llm.common import Scratch

LEADING = 16
SAMPLE = 4096  # vectors the axes are fitted to, first in hash order; bounds what the driver reads
CHUNK = 8192
FAR = 1 << 40  # a centroid with such a component is farther from a narrow vector than any narrow one
LONG = (1 << 63) - 1
STORED = "vec_id long, grid array<int>, wide array<double>, lead array<double>, rest double"


def narrow_limit(width: int) -> int:
    """Components up to this make squared distances of at most 62 bits."""
    return int((1 << 30) / max(1, width) ** 0.5)


def whole(x: float, scale: int) -> int:
    """floor(scale * x) of a finite double; a product beyond the doubles is taken in integers."""
    y = scale * x
    return int(np.floor(y)) if np.isfinite(y) else int(x) * scale


def whole_row(x: np.ndarray, scale: int) -> np.ndarray:
    return np.array([whole(float(v), scale) for v in x], dtype=object)


@dataclass
class Axes:
    mean: np.ndarray
    turn: np.ndarray  # columns are the axes, most spread first
    leading: int

    def of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leading coordinates, residual length) of every row."""
        y = (points - self.mean) @ self.turn
        return y[:, : self.leading], np.sqrt((y[:, self.leading :] ** 2).sum(axis=1))


def fit_axes(sample: np.ndarray, leading: int = LEADING) -> Axes:
    """Principal axes of the sample's rows of moderate size."""
    width = sample.shape[1]
    if not len(sample):
        return Axes(np.zeros(width), np.eye(width), min(leading, width))
    mean = sample.mean(axis=0)
    _, turn = np.linalg.eigh((sample - mean).T @ (sample - mean) / len(sample))
    return Axes(mean, turn[:, ::-1].copy(), min(leading, width))


class Centroids:
    """The centroids of a round, ready for the filter."""

    def __init__(self, points: list[list[int]], axes: Axes):
        self.points = points
        most = narrow_limit(len(axes.mean))
        self.narrow = np.array([all(abs(x) <= most for x in p) for p in points], bool)
        self.far = np.array([any(abs(x) >= FAR for x in p) for p in points], bool)
        self.grid = np.array([[x if n else 0 for x in p] for p, n in zip(points, self.narrow, strict=True)], np.int64)
        # Far centroids need no bound.
        self.lead, self.rest = axes.of(np.array([[float(max(-FAR, min(FAR, x))) for x in p] for p in points]))
        self.exact = [np.array(p, dtype=object) for p in points]

    def assign(self, grid: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, list, int]:
        """(centroid, squared distance, distances verified) of narrow vectors."""
        n, k = len(grid), len(self.points)
        rows = np.arange(n)
        if not self.narrow.any():
            return self._by_integers(grid)
        own = (lead**2).sum(axis=1) + rest**2
        theirs = (self.lead**2).sum(axis=1) + self.rest**2
        bound = own[:, None] + theirs[None, :] - 2 * (lead @ self.lead.T + np.outer(rest, self.rest))
        bound -= 1e-11 * (own[:, None] + theirs[None, :]) + 1e-3  # rounding of the products and the stored coordinates
        bound[:, self.far] = np.inf
        near = np.argmin(np.where(self.narrow[None, :], bound, np.inf), axis=1)
        best = ((grid - self.grid[near]) ** 2).sum(axis=1)
        # One centroid after another, so that what is gathered stays a chunk; the order leaves ties to the smaller number.
        cluster, verified = near.copy(), n
        open_rows = bound <= best[:, None]
        open_rows[rows, near] = False
        for j in np.flatnonzero(open_rows.any(axis=0)):
            at = np.flatnonzero(open_rows[:, j])
            verified += len(at)
            if self.narrow[j]:
                d = ((grid[at] - self.grid[j]) ** 2).sum(axis=1)
            else:
                d = np.array([int(((grid[i].astype(object) - self.exact[j]) ** 2).sum()) for i in at], dtype=object)
            better = (d < best[at]) | ((d == best[at]) & (j < cluster[at]))
            take = at[better.astype(bool)]
            best[take], cluster[take] = d[better.astype(bool)].astype(np.int64), j
        return cluster, best.tolist(), verified

    def _by_integers(self, rows) -> tuple[np.ndarray, list, int]:
        """All distances of rows in Python integers."""
        cluster, best = [], []
        for row in rows:
            d = [int(((row.astype(object) - c) ** 2).sum()) for c in self.exact]
            cluster.append(int(np.argmin(np.array(d, dtype=object))))
            best.append(d[cluster[-1]])
        return np.array(cluster, np.int64), best, len(rows) * len(self.points)


def _ready(vectors: DataFrame, width: int) -> DataFrame:
    """vec_id, embedding (doubles), name (hash of the id) of the vectors that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return own.where(F.col("embedding").isNotNull() & (F.size("embedding") == width)).where(fine)


def _stored(ready: DataFrame, axes: Axes, scale: int) -> DataFrame:
    """Grid (or the vector itself, if it does not fit), leading coordinates and residual length."""
    width = len(axes.mean)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            with np.errstate(over="ignore"):
                y = np.floor(x * scale)
            fits = (np.abs(y) <= narrow_limit(width)).all(axis=1)
            lead, rest = axes.of(np.where(fits[:, None], y, 0.0))
            grid = np.where(fits[:, None], y, 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([g if f else None for g, f in zip(grid, fits, strict=True)], pa.list_(pa.int32())),
                 pa.array([None if f else v for v, f in zip(x, fits, strict=True)], pa.list_(pa.float64())), pa.array(list(lead), pa.list_(pa.float64())), pa.array(rest)],
                names=["vec_id", "grid", "wide", "lead", "rest"],
            )

    return ready.mapInArrow(place, STORED)


def _assigned(batch: pa.RecordBatch, centres: Centroids, width: int, scale: int):
    """Chunks of a batch: (rows, whether narrow, grid or exact rows, cluster, distances, verified)."""
    fits = batch.column("grid").is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(fits)
    grid = batch.column("grid").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)
    lead = batch.column("lead").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)[at]
    rest = batch.column("rest").to_numpy()[at]
    for i in range(0, len(at), CHUNK):
        part = slice(i, i + CHUNK)
        yield at[part], True, grid[part], *centres.assign(grid[part], lead[part], rest[part])
    wide = np.flatnonzero(~fits)
    if len(wide):
        rows = [whole_row(np.array(v), scale) for v in batch.column("wide").take(pa.array(wide)).to_pylist()]
        yield wide, False, rows, *centres._by_integers(rows)


def _sums(stored: DataFrame, centres: Centroids, width: int, scale: int) -> tuple[dict[int, tuple[int, list[int]]], int]:
    """Per centroid (vectors, exact sums of the components), and how many distances were verified."""
    sent = stored.sparkSession.sparkContext.broadcast(centres)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        k = len(own.points)
        count, sums, seen = np.zeros(k, np.int64), np.zeros((k, width), np.int64), 0
        large: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, narrow, rows, cluster, _, verified in _assigned(batch, own, width, scale):
                count += np.bincount(cluster, minlength=k)
                seen += verified
                if narrow:
                    order = np.argsort(cluster, kind="stable")
                    heads = np.flatnonzero(np.diff(cluster[order], prepend=-1))
                    sums[cluster[order][heads]] += np.add.reduceat(rows[order], heads, axis=0)
                else:
                    for row, c in zip(rows, cluster.tolist(), strict=True):
                        large[c] = large.get(c, 0) + row
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(count[used]), pa.array(np.where(used == used[:1], seen, 0), pa.int64()),
             pa.array(list(sums[used]), pa.list_(pa.int64())), pa.array([[str(v) for v in large[c]] if c in large else None for c in used.tolist()], pa.list_(pa.string()))],
            names=["cluster", "n", "verified", "sums", "large"],
        )

    parts = stored.mapInArrow(total, "cluster long, n long, verified long, sums array<long>, large array<string>")
    exact = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    found, verified = {}, 0
    # One row per centroid; large has one list per task that met a vector beyond the grid.
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("verified").alias("verified"), F.collect_list("large").alias("large"), *exact).collect():
        own = [int(r[f"s{i}"]) + sum(int(part[i]) for part in r["large"]) for i in range(width)]
        found[r["cluster"]] = (r["n"], own)
        verified += r["verified"]
    return found, verified


@dataclass
class Clusters:
    rows: DataFrame  # vec_id, cluster, distance
    centroids: list[list[int]]
    verified: list[int]  # exact distances per round
    pairs: int  # vectors x centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int | str = 2, width: int = 64, scale: int = 256, leading: int = LEADING) -> Clusters:
    """Lloyd's rounds over (vec_id, embedding) from the ``k`` vectors with the smallest hash of seed and id."""
    spark = vectors.sparkSession
    ready = _ready(vectors, width)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    sample = ready.select(name.alias("name"), "embedding").orderBy("name", "embedding").limit(max(k, SAMPLE)).collect()
    if not sample:
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], [], 0)
    points = [[int(v) for v in whole_row(np.array(r["embedding"]), scale)] for r in sample[:k]]
    with np.errstate(over="ignore"):
        drawn = np.array([r["embedding"] for r in sample]) * scale
    axes = fit_axes(drawn[(np.abs(drawn) <= narrow_limit(width)).all(axis=1)], leading)
    stored = Scratch(spark, "centroids").save(_stored(ready, axes, scale), "vectors")
    checked = []
    for _ in range(rounds):
        found, verified = _sums(stored, Centroids(points, axes), width, scale)
        checked.append(verified)
        points = [[s // found[j][0] for s in found[j][1]] if j in found else p for j, p in enumerate(points)]
    sent = spark.sparkContext.broadcast(Centroids(points, axes))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for at, _, _, nearest, distance, _ in _assigned(batch, sent.value, width, scale):
                fits = [d if d <= LONG else None for d in distance]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(nearest.astype(np.int32)), pa.array(fits, pa.int64())], names=["vec_id", "cluster", "distance"])

    rows = stored.mapInArrow(label, "vec_id long, cluster int, distance long")
    return Clusters(rows, points, checked, sum(n for n, _ in found.values()) * len(points) if rounds else 0)


def with_inertia(found: Clusters) -> DataFrame:
    """The labelled vectors with cluster_inertia, inertia and a digest of their centroid's components."""
    spark = found.rows.sparkSession
    rows = Scratch(spark, "centroids").save(found.rows, "labels")
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("unknown"))
    sums = {r["cluster"]: (None if r["unknown"] else int(r["total"])) for r in per.collect()}  # one row per centroid
    all_of = None if None in sums.values() else sum(sums.values())
    fits = lambda v: v if v is not None and v <= LONG else None
    table = [
        (j, fits(sums[j]), fits(all_of), hashlib.sha256(",".join(map(str, found.centroids[j])).encode()).hexdigest()) for j in sorted(sums)
    ]
    facts = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
