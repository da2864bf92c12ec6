"""Exact nearest search through an index of cells.

Candidates are dealt into cells, and of every cell the box of its members' coordinates is
kept: at most ``MAX_CELLS`` rows and as many again for gap patterns, whatever the table's
size. From the box follows a lower bound for the distance of a probe to all members at once.

A search goes ring by ring. First, every probe visits the cells of the least bounds that
hold enough members; its k-th best there is a limit. Then it visits the next ``RING``
cells as far as their bound does not exceed the limit, which makes the limit smaller, and at last
all others that are within it; what a cell returns beyond the limit never leaves the task. Probes and members meet by cell; a cell with many members or
many probes is cut into blocks on both sides, so that a hot cell is many small groups.

Two kinds of index share the search. ``GapIndex`` is for columns with gaps: leaves of a k-d tree
over the known values, one set of leaves for each of the frequent gap patterns.
``PivotIndex`` is for vectors compared by cosine: the cell is the nearest pivot, the coordinates are
the distances to all pivots, and the bound is the triangle inequality.

The tree and the pivots are fitted to a bounded sample; every row is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from traceframe.session import cut_lineage

MAX_CELLS = 4096
RING = 6  # cells of the second visit
CELL_ROWS = 4  # members of a cell, while there are fewer than MAX_CELLS cells
PATTERNS = 64  # gap patterns with leaves of their own
PATTERN_BITS = 52  # columns beyond share bits; a box knows which of its members have which columns
SAMPLE = 20_000  # rows a tree or the pivots are fitted to
PIVOTS = 128
MEMBER_BLOCK, PROBE_BLOCK = 32_768, 16_384  # rows of a block; fewer of more than 64 numbers, but not less than an eighth
BLOCK_WIDTH = 64
VISIT_VALUES = 500_000  # numbers in a batch of visits that leaves a task
CHUNK_VALUES = 2_000_000  # numbers in a temporary array of a task


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors of one length as rows; null becomes NaN."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _hashed_sample(df: DataFrame, key: str, n: int) -> list:
    return df.orderBy(F.xxhash64(key), key).limit(n).collect()


@dataclass
class Boxes:
    """What the driver knows of the cells; small by construction."""

    cells: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    known: np.ndarray  # members with the coordinate, per cell


@dataclass
class GapIndex:
    """Cells of rows with gaps. Distance: Euclidean over the common columns, scaled up to all columns."""

    width: int
    dims: np.ndarray
    cuts: np.ndarray
    depths: dict[int, tuple[int, int]]  # gap pattern -> (number, depth of its leaves)
    boxes: Boxes | None = None
    digits: int | None = None

    @classmethod
    def fit(cls, df: DataFrame, width: int, cell_rows: int = CELL_ROWS, max_cells: int = MAX_CELLS) -> GapIndex:
        bit = lambda x, i: F.when(x.isNull(), F.lit(0)).otherwise(F.pow(F.lit(2.0), F.pmod(i, F.lit(PATTERN_BITS))).cast("long"))
        pattern = F.aggregate(F.transform("vector", bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
        counts = df.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        common = counts.orderBy(F.col("n").desc(), "pattern").limit(PATTERNS).collect()
        size = max(cell_rows, -(-total // max_cells))
        depth_of = lambda n: math.ceil(math.log2(max(1, n / size)))
        depths = {r["pattern"]: (i, depth_of(r["n"])) for i, r in enumerate(common)}
        deepest = max((d for _, d in depths.values()), default=0)
        sample = np.array([r["vector"] for r in _hashed_sample(df.select("match_id", "vector"), "match_id", SAMPLE)], dtype=np.float64).reshape(-1, width)
        dims, cuts = np.zeros((1 << deepest) - 1, np.int64), np.full((1 << deepest) - 1, np.inf)
        held = {0: np.arange(len(sample))}
        for node in range(len(dims)):
            own = held.pop(node)
            part = sample[own]
            with np.errstate(invalid="ignore"):
                some = np.isfinite(part).sum(axis=0)
                filled = np.where(np.isfinite(part), part, np.nan)
                spread = np.array([np.ptp(c[np.isfinite(c)]) if s > 1 else 0.0 for c, s in zip(filled.T, some, strict=True)])
            right = np.zeros(len(own), bool)
            if spread.max(initial=0.0) > 0:
                at = int(spread.argmax())
                values = part[:, at]
                cut = float(np.nanmedian(values))
                cut = cut if (values > cut).any() else float(np.nanmin(values))
                dims[node], cuts[node] = at, cut
                right = values > cut
            held[2 * node + 1], held[2 * node + 2] = own[~right], own[right]
        return cls(width, dims, cuts, depths)

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The cell of every row: number of its pattern, then the leaf in that pattern's depth."""
        known = ~np.isnan(rows)
        pattern = np.bitwise_or.reduce(np.where(known, 1 << (np.arange(self.width, dtype=np.int64) % PATTERN_BITS), 0), axis=1)
        levels = (len(self.dims) + 1).bit_length() - 1
        node, leaf_at = np.zeros(len(rows), np.int64), [np.zeros(len(rows), np.int64)]
        for _ in range(levels):
            with np.errstate(invalid="ignore"):
                node = 2 * node + 1 + (rows[np.arange(len(rows)), self.dims[node]] > self.cuts[node])
            leaf_at.append(node)
        out = np.full(len(rows), PATTERNS << 32, np.int64)
        for p, (number, depth) in self.depths.items():
            own = pattern == p
            out[own] = (number << 32) + leaf_at[depth][own]
        return out

    def coordinates(self, rows: np.ndarray) -> np.ndarray:
        return rows

    def wanted(self, probes: np.ndarray) -> np.ndarray:
        return np.isnan(probes)

    def usable(self, rows: np.ndarray) -> np.ndarray:
        return ~np.isnan(rows)

    def members(self) -> np.ndarray:
        """Members that can serve each wanted column, per cell."""
        return self.boxes.known

    def bounds(self, probes: np.ndarray) -> np.ndarray:
        """Least distance each probe can have to any member of each cell; infinite without a common column."""
        b = self.boxes
        squares, most = (np.zeros((len(probes), len(b.cells))) for _ in range(2))
        for c in range(self.width):
            has = ~np.isnan(probes[:, c])
            all_have, some_have = b.known[:, c] == b.rows, b.known[:, c] > 0
            x = np.where(has, probes[:, c], 0.0)[:, None]
            low, high = np.where(some_have, b.low[:, c], 0.0), np.where(some_have, b.high[:, c], 0.0)
            gap = np.maximum(np.maximum(low[None, :] - x, x - high[None, :]), 0.0)
            both = has[:, None] & all_have[None, :] & ~np.isnan(gap)  # no number: both sides infinite
            squares += np.where(both, gap * gap, 0.0)
            most += has[:, None] & some_have[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.sqrt(squares * self.width / most) * (1 - 1e-9)
        out[most == 0] = np.inf
        return out

    def costs(self, probes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distances; NaN without a common column."""
        squares, common = np.zeros((len(probes), len(rows))), np.zeros((len(probes), len(rows)))
        for c in range(self.width):
            d = probes[:, c][:, None] - rows[:, c][None, :]
            ok = ~np.isnan(d)
            common += ok
            squares += np.where(ok, d, 0.0) ** 2
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.sqrt(squares * self.width / common)
        out[common == 0] = np.nan
        return out

    def reach(self, costs: np.ndarray) -> np.ndarray:
        return costs

    def values(self, rows: np.ndarray, wanted: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What a winner brings: the value of the wanted column."""
        return rows[at, wanted]


@dataclass
class PivotIndex:
    """Cells of unit vectors around pivots; cost is the negative cosine."""

    width: int
    pivots: np.ndarray
    boxes: Boxes | None = None
    digits: int = 12

    @classmethod
    def fit(cls, df: DataFrame, width: int, pivots: int = PIVOTS) -> PivotIndex:
        """Pivots are taken from a sample, each as far from the ones before as there is."""
        sample = np.array([r["vector"] for r in _hashed_sample(df.select("match_id", "vector"), "match_id", SAMPLE)], dtype=np.float64).reshape(-1, width)
        total = df.count()
        wanted = max(1, min(pivots, len(sample), int(2 * math.sqrt(total))))
        chosen, away = [0] if len(sample) else [], np.full(len(sample), np.inf)
        while chosen and len(chosen) < wanted:
            away = np.minimum(away, _apart(sample, sample[chosen[-1]][None, :])[:, 0])
            if away.max() <= 1e-9:
                break
            chosen.append(int(away.argmax()))
        return cls(width, sample[chosen].reshape(-1, width))

    def place(self, rows: np.ndarray) -> np.ndarray:
        return _apart(rows, self.pivots).argmin(axis=1)

    def coordinates(self, rows: np.ndarray) -> np.ndarray:
        return _apart(rows, self.pivots)

    def wanted(self, probes: np.ndarray) -> np.ndarray:
        return np.ones((len(probes), 1), bool)

    def usable(self, rows: np.ndarray) -> np.ndarray:
        return np.ones((len(rows), 1), bool)

    def members(self) -> np.ndarray:
        return self.boxes.rows[:, None]

    def bounds(self, probes: np.ndarray) -> np.ndarray:
        away = _apart(probes, self.pivots)
        out = np.zeros((len(probes), len(self.boxes.cells)))
        for j in range(away.shape[1]):
            x = away[:, j][:, None]
            np.maximum(out, np.maximum(self.boxes.low[:, j][None, :] - x, x - self.boxes.high[:, j][None, :]), out=out)
        return np.maximum(out - 1e-6, 0.0)  # rounding of distances near zero

    def costs(self, probes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return -np.round(probes @ rows.T, self.digits)

    def reach(self, costs: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 + 2 * costs, 0.0))

    def values(self, rows: np.ndarray, wanted: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.full(len(at), np.nan)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0.0))


Index = GapIndex | PivotIndex


@dataclass
class Stored:
    """Indexed candidates: a table (match_id, vector, cell) and the boxes of its cells."""

    rows: DataFrame
    index: Index
    compared: list[tuple[int, int]] = field(default_factory=list)  # (pairs compared, probes) of each round


def store(candidates: DataFrame, index: Index) -> Stored:
    """Place every candidate (match_id, vector) in its cell and measure the cells."""
    key = candidates.schema["match_id"]
    schema = T.StructType([key, T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("cell", T.LongType())])
    sent = candidates.sparkSession.sparkContext.broadcast(index)
    width = index.width

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.place(matrix(batch.column("vector"), width)), pa.int64())], names=["match_id", "vector", "cell"])

    rows = cut_lineage(candidates.select("match_id", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(place, schema), "cells")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = sent.value, {}
        for batch in batches:
            at = own.coordinates(matrix(batch.column("vector"), width))
            cells = batch.column("cell").to_numpy()
            order = np.argsort(cells, kind="stable")
            heads = np.flatnonzero(np.diff(cells[order], prepend=-1))
            known = ~np.isnan(at[order])
            low = np.minimum.reduceat(np.where(known, at[order], np.inf), heads, axis=0) if len(heads) else at[:0]
            high = np.maximum.reduceat(np.where(known, at[order], -np.inf), heads, axis=0) if len(heads) else at[:0]
            count = np.add.reduceat(known.astype(np.int64), heads, axis=0) if len(heads) else at[:0]
            sizes = np.diff(np.append(heads, len(cells)))
            for i, c in enumerate(cells[order][heads].tolist()):
                n, a, b, k = held.get(c, (0, np.inf, -np.inf, 0))
                held[c] = (n + int(sizes[i]), np.minimum(a, low[i]), np.maximum(b, high[i]), k + count[i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([v[0] for v in held.values()], pa.int64()), *[pa.array([v[i].tolist() for v in held.values()], pa.list_(pa.float64())) for i in (1, 2)],
             pa.array([v[3].tolist() for v in held.values()], pa.list_(pa.int64()))],
            names=["cell", "n", "low", "high", "known"],
        )

    parts = rows.select("vector", "cell").mapInArrow(measure, "cell long, n long, low array<double>, high array<double>, known array<long>")
    fields = {"low": F.min, "high": F.max, "known": F.sum}
    # One row per cell and coordinate, combined on the map side; then one row per cell.
    places = parts.select("cell", "n", F.posexplode(F.arrays_zip(*fields)).alias("at", "v")).groupBy("cell", "at").agg(F.sum("n").alias("n"), *[f(F.col("v")[c]).alias(c) for c, f in fields.items()])
    found = places.groupBy("cell").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", *fields))).alias("v")).orderBy("cell").collect()
    n_at = len(found[0]["v"]) if found else 1
    column = lambda name: np.array([[v[name] for v in r["v"]] for r in found], dtype=np.float64).reshape(-1, n_at)
    index.boxes = Boxes(np.array([r["cell"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64), column("low"), column("high"), column("known"))
    return Stored(rows, index)


def _places(bounds: np.ndarray, members: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of every cell in the order of a probe's bounds, the last place of its first visit).

    The first visit ends where the cells together hold k members for each wanted column.
    """
    order = np.argsort(bounds, axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(bounds.shape[1]), bounds.shape), 1)
    need = np.zeros(len(bounds), np.int64)
    reachable = np.isfinite(np.take_along_axis(bounds, order, 1))
    for c in range(members.shape[1]):
        have = np.cumsum(np.where(reachable, members[order, c], 0), axis=1)
        enough = (have < k).sum(axis=1)  # the last place if there are too few
        need = np.where(wanted[:, c], np.maximum(need, enough), need)
    return place, need


def _visit_batches(probes: pa.RecordBatch, limits: np.ndarray, who: np.ndarray, where: np.ndarray, cells: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Visits (probe_id, vector, limits, cell) of probes ``who`` to cells ``where``, few at a time, as each holds the probe's vector."""
    some = max(1, VISIT_VALUES // width)
    for i in range(0, len(who), some):
        took, own = probes.take(pa.array(who[i : i + some])), limits[who[i : i + some]]
        listed = pa.ListArray.from_arrays(np.arange(len(own) + 1, dtype=np.int32) * own.shape[1], own.ravel())
        yield pa.RecordBatch.from_arrays([took.column("probe_id"), took.column("vector"), listed, pa.array(cells[where[i : i + some]], pa.int64())], names=["probe_id", "vector", "limits", "cell"])


def _block_rows(width: int) -> tuple[int, int]:
    """Rows of a block of members and of probes; as many as a task can hold, as each goes to all blocks of the other side."""
    parts = min(8, max(1, width // BLOCK_WIDTH))
    return max(1, MEMBER_BLOCK // parts), max(1, PROBE_BLOCK // parts)


def _visits(probes: DataFrame, stored: Stored, k: int, after: int | None = None, upto: int | None = None) -> DataFrame:
    """(probe_id, vector, limits, cell): which cells every probe visits.

    Without ``after`` the first visit; else the cells that are more than ``after`` and at most
    ``upto`` places behind it, within the probe's limits.
    """
    limited = after is not None
    sent = probes.sparkSession.sparkContext.broadcast(stored.index)
    key, width = probes.schema["probe_id"], stored.index.width
    kind = T.ArrayType(T.DoubleType())
    schema = T.StructType([key, T.StructField("vector", kind), T.StructField("limits", kind), T.StructField("cell", T.LongType())])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        n_cells, members = len(index.boxes.cells), index.members()
        step = max(1, CHUNK_VALUES // max(1, n_cells * 4))
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                rows = matrix(part.column("vector"), width)
                bounds, wanted = index.bounds(rows), index.wanted(rows)
                place, first = _places(bounds, members, wanted, k)
                behind = place - first[:, None]
                limits = np.full(wanted.shape, np.inf)
                visit = (behind <= 0) & np.isfinite(bounds)
                if limited:
                    limits = matrix(part.column("limits"), wanted.shape[1])  # NaN where nothing is wanted
                    near = np.zeros(bounds.shape, bool)
                    for c in range(wanted.shape[1]):
                        with np.errstate(invalid="ignore"):
                            near |= (bounds <= index.reach(limits[:, c])[:, None]) & np.isfinite(bounds) & (members[:, c] > 0)[None, :] & wanted[:, c][:, None]
                    visit = near & (behind > after) & (behind <= (upto or n_cells))
                yield from _visit_batches(part, limits, *np.nonzero(visit), index.boxes.cells, width)

    return probes.select("probe_id", "vector", *(["limits"] if limited else [])).mapInArrow(choose, schema)


def _meet(visits: DataFrame, stored: Stored, k: int) -> DataFrame:
    """Winners (probe_id, wanted, match_id, cost, value) of all visits; at most k per visit and wanted column."""
    spark, index = visits.sparkSession, stored.index
    visits = cut_lineage(visits, "visits")
    asked = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per cell
    held = dict(zip(index.boxes.cells.tolist(), index.boxes.rows.tolist(), strict=True))
    stored.compared.append((sum(n * held[c] for c, n in asked.items()), sum(asked.values())))
    m_rows, p_rows = _block_rows(index.width)
    blocks = spark.createDataFrame([(c, -(-held[c] // m_rows), -(-n // p_rows)) for c, n in asked.items()], "cell long, m_blocks long, p_blocks long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))
    blocks = F.broadcast(blocks)  # one row per cell
    left = visits.join(blocks, "cell").withColumn("pb", own("probe_id", "p_blocks")).withColumn("mb", every("m_blocks")).drop("m_blocks", "p_blocks")
    right = stored.rows.join(blocks, "cell").withColumn("mb", own("match_id", "m_blocks")).withColumn("pb", every("p_blocks")).drop("m_blocks", "p_blocks")
    sent = spark.sparkContext.broadcast(index)
    width = index.width
    schema = T.StructType(
        [visits.schema["probe_id"], T.StructField("wanted", T.IntegerType()), stored.rows.schema["match_id"], T.StructField("cost", T.DoubleType()), T.StructField("value", T.DoubleType())]
    )
    names = [f.name for f in schema.fields]

    def compare(probes, rows):
        own = sent.value
        found = {n: [] for n in names}
        p_ids, m_ids = probes.column("probe_id").combine_chunks(), rows.column("match_id").combine_chunks()
        if len(p_ids) and len(m_ids):
            keys = np.array(m_ids.to_pylist())
            order = np.argsort(keys, kind="stable")  # so that a stable order of costs leaves ties to the smaller key
            x, y = matrix(probes.column("vector"), width), matrix(rows.column("vector"), width)[order]
            wanted, usable = own.wanted(x), own.usable(y)
            limits = matrix(probes.column("limits"), wanted.shape[1])
            step = max(1, CHUNK_VALUES // len(y))
            for i in range(0, len(x), step):
                cost = own.costs(x[i : i + step], y)
                for c in range(wanted.shape[1]):
                    who = np.flatnonzero(wanted[i : i + step, c])
                    can = np.flatnonzero(usable[:, c])
                    if not len(who) or not len(can):
                        continue
                    part = cost[np.ix_(who, can)]
                    part = np.where(np.isnan(part) | (part > limits[i + who, c][:, None]), np.inf, part)
                    best = np.argsort(part, axis=1, kind="stable")[:, :k]
                    value = np.take_along_axis(part, best, 1)
                    a, b = np.nonzero(np.isfinite(value))
                    at = can[best[a, b]]
                    found["probe_id"].append(i + who[a])
                    found["match_id"].append(order[at])
                    found["wanted"].append(np.full(len(a), c, np.int32))
                    found["cost"].append(value[a, b])
                    found["value"].append(own.values(y, np.full(len(a), c), at))
        flat = {n: np.concatenate(v) if v else np.zeros(0) for n, v in found.items()}
        take = lambda ids, at: ids.take(pa.array(at.astype(np.int64)))
        return pa.table(
            {"probe_id": take(p_ids, flat["probe_id"]), "wanted": pa.array(flat["wanted"].astype(np.int32)), "match_id": take(m_ids, flat["match_id"]), "cost": pa.array(flat["cost"]),
             "value": pa.array(flat["value"])}
        )

    return left.groupBy("cell", "mb", "pb").cogroup(right.groupBy("cell", "mb", "pb")).applyInArrow(compare, schema)


def _best(winners: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("probe_id", "wanted").orderBy("cost", "match_id")
    return winners.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(probes: DataFrame, stored: Stored, k: int) -> DataFrame:
    """Best ``k`` members per probe (probe_id, vector) and wanted column: probe_id, wanted, match_id, cost, value, rank."""
    index = stored.index
    n_wanted = index.width if isinstance(index, GapIndex) else 1
    if not len(index.boxes.cells):
        return _best(probes.sparkSession.createDataFrame([], _winner_schema(probes, stored)), k)
    probes = probes.select("probe_id", F.col("vector").cast("array<double>").alias("vector"))
    winners = cut_lineage(_best(_meet(_visits(probes, stored, k), stored, k), k).drop("rank"), "winners")
    limit = lambda c: F.coalesce(F.max(F.when(F.col("wanted") == c, F.col("limit"))), F.lit(float("inf")))
    none = F.array(*[F.lit(float("inf"))] * n_wanted)
    for after, upto in ((0, RING), (RING, None)):
        full = winners.groupBy("probe_id", "wanted").agg(F.when(F.count(F.lit(1)) == k, F.max("cost")).otherwise(float("inf")).alias("limit"))
        limits = full.groupBy("probe_id").agg(F.array(*[limit(c) for c in range(n_wanted)]).alias("limits"))
        again = probes.join(limits, "probe_id", "left").withColumn("limits", F.coalesce("limits", none))
        best = _best(winners.unionByName(_meet(_visits(again, stored, k, after, upto), stored, k)), k)
        winners = cut_lineage(best.drop("rank"), "winners") if upto else best
    return winners


def _winner_schema(probes: DataFrame, stored: Stored) -> T.StructType:
    return T.StructType(
        [probes.schema["probe_id"], T.StructField("wanted", T.IntegerType()), stored.rows.schema["match_id"], T.StructField("cost", T.DoubleType()), T.StructField("value", T.DoubleType())]
    )
