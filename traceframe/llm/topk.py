"""Exact top-k search by distributed histogram selection.

Queries are taken in blocks of a fixed size, which bounds what is broadcast. For a block,
every task scores all its candidates and counts the scores of each query in equal cells
of an interval that is known to hold the query's k-th best score; the counts of all tasks
are added, the cell in which the k-th score falls becomes the next interval, and the
candidates are scored again, until a cell is one score wide. Then the k-th score is known:
a last scan keeps all rows above it and, of those that reach it exactly, the smallest ids
that are still needed.

A task may leave out the cells below the one that holds its own k-th best score: the
k-th best of all rows is not lower. So counts are a few rows per query and task.

Defined cases: a vector that is null, has null or non-finite components, or no id takes no
part; only vectors of the same length are compared; the query's own rows are those with its
id; a query that stands in several equal rows is asked once, candidates count row by
row; fewer candidates than k are all returned; vectors whose squared length exceeds 61 bits are
scored in Python integers, so that no finite vector ends the job, and ranked with the others; a
score beyond 64 bits is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from traceframe.llm.common import Scratch

BLOCK = 2048  # queries asked at once
CELLS = 512  # cells of a histogram
CHUNK = 1024  # candidates scored at once
SALTS = 32
NARROW = float(1 << 61)  # squared length of vectors that are scored in 64 bits


def grid(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a long; null unless all are finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cells = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(vector.isNotNull() & fine & (_length(vector, scale) <= NARROW), cells)


def _length(vector: Column, scale: int) -> Column:
    """Squared length on the grid as a double; infinite where it does not fit."""
    return F.aggregate(F.transform(vector, lambda x: (F.abs(x.cast("double")) + 1) * scale), F.lit(0.0), lambda acc, x: acc + x * x)


def wide(vector: Column, scale: int = 256) -> Column:
    """The components as doubles, of finite vectors that are too long for ``grid``."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & fine & (_length(vector, scale) > NARROW), vector.cast("array<double>"))


def _matrix(column: pa.Array, size: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(kind)


def _scored(batches: Iterator[pa.RecordBatch], queries: np.ndarray, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores of all queries) of chunks of candidates; scores are exact integers."""
    left = queries.astype(kind)
    for batch in batches:
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        rows = _matrix(batch.column("grid"), queries.shape[1], kind)
        for i in range(0, len(ids), CHUNK):
            yield ids[i : i + CHUNK], left @ rows[i : i + CHUNK].T


def _histogram(queries: np.ndarray, names: np.ndarray, low: np.ndarray, span: np.ndarray, need: np.ndarray, kind: type):
    """Counts per query and cell of this task's scores in [low, low + span)."""
    width = -(-span // CELLS)

    def count(batches):
        n = len(names)
        held = np.zeros((n, CELLS), np.int64)
        base = (np.arange(n) * CELLS)[:, None]
        for ids, scores in _scored(batches, queries, kind):
            past = scores.astype(np.int64) - low[:, None]
            inside = (past >= 0) & (past < span[:, None]) & (ids[None, :] != names[:, None])
            cell = past // width[:, None]
            held += np.bincount((cell + base)[inside], minlength=n * CELLS).reshape(n, CELLS)
        above = np.cumsum(held[:, ::-1], axis=1)[:, ::-1] - held  # in higher cells of this task
        who, where = np.nonzero((held > 0) & (above < need[:, None]))
        yield pa.RecordBatch.from_pydict({"q": who.astype(np.int32), "cell": where.astype(np.int32), "n": held[who, where]})

    return count


def _last(queries: np.ndarray, names: np.ndarray, kth: np.ndarray, ties: np.ndarray, kind: type):
    """Rows above the k-th score, and of those on it the smallest ids of this task."""

    def keep(batches):
        above: list[pd.DataFrame] = []
        level = pd.DataFrame({"q": np.zeros(0, np.int32), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
        for ids, scores in _scored(batches, queries, kind):
            own = ids[None, :] == names[:, None]
            who, where = np.nonzero((scores >= kth[:, None].astype(kind)) & ~own)
            found = pd.DataFrame({"q": who.astype(np.int32), "vec_id": ids[where], "score": scores[who, where].astype(np.int64)})
            on = found["score"].to_numpy() == kth[who]
            above.append(found[~on])
            level = pd.concat([level, found[on]]).sort_values(["q", "vec_id"], kind="stable")
            level = level[level.groupby("q").cumcount().to_numpy() < ties[level["q"].to_numpy()]]
        out = pd.concat([*above, level])
        out["query_id"] = names[out["q"].to_numpy()]
        yield pa.RecordBatch.from_pandas(out[["query_id", "vec_id", "score"]].reset_index(drop=True), preserve_index=False)

    return keep


def _exact_kind(most: int) -> type:
    """A number type that holds sums of products up to ``most`` exactly."""
    if most < 1 << 24:
        return np.float32
    if most < 1 << 53:
        return np.float64
    if most < 1 << 62:
        return np.int64
    raise ArithmeticError("scores do not fit into 62 bits")


def _block(vectors: DataFrame, block: pd.DataFrame, size: int, bound: int, k: int) -> DataFrame:
    """``bound``: of the squared length of any vector, and so of any score and partial sum."""
    names = block["vec_id"].to_numpy(np.int64)
    queries = np.array(block["grid"].tolist(), np.int64).reshape(len(block), size)
    kind = _exact_kind(bound)
    n = len(block)
    low, span = np.full(n, -bound, np.int64), np.full(n, 2 * bound + 1, np.int64)
    need, left = np.full(n, k, np.int64), np.arange(n)
    while len(left):
        counts = (
            vectors.mapInArrow(_histogram(queries[left], names[left], low[left], span[left], need[left], kind), "q int, cell int, n long")
            .groupBy("q", "cell").agg(F.sum("n").alias("n")).toPandas()  # at most CELLS rows a query
        )
        found = dict(list(counts.sort_values("cell", ascending=False).groupby("q", sort=False)))
        still = []
        for i, q in enumerate(left):
            reach = found[i]["n"].cumsum().to_numpy() if i in found else np.zeros(0, np.int64)
            at = int(np.searchsorted(reach, need[q]))
            if at == len(reach):  # fewer candidates than k: all of them are wanted
                low[q] = -bound - 1
                continue
            need[q] -= reach[at - 1] if at else 0
            width, cell = -(-span[q] // CELLS), int(found[i]["cell"].iloc[at])
            low[q] += cell * width
            span[q] = min(width, span[q] - cell * width)
            if width > 1:
                still.append(q)
        left = np.array(still, np.int64)
    return vectors.mapInArrow(_last(queries, names, low, need, kind), "query_id long, vec_id long, score long")


def _whole(x: float, scale: int) -> int:
    """floor(scale * x); a product beyond the doubles is taken in integers."""
    y = scale * x
    return int(np.floor(y)) if np.isfinite(y) else int(x) * scale


def sortable(score: int) -> str:
    """A text for every integer, in the order of the integers."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):05d}{digits}"
    return f"0{99999 - len(digits):05d}" + digits.translate(str.maketrans("0123456789", "9876543210"))


def _sortable(score: Column) -> Column:
    digits = F.abs(score).cast("string")  # of at most 62 bits
    turned = F.translate(digits, "0123456789", "9876543210")
    below = F.concat(F.lit("0"), F.lpad((99999 - F.length(digits)).cast("string"), 5, "0"), turned)
    return F.when(score < 0, below).otherwise(F.concat(F.lit("1"), F.lpad(F.length(digits).cast("string"), 5, "0"), digits))


def _with_wide(spark, rows: DataFrame, block: list, k: int, scale: int) -> DataFrame:
    """query_id, vec_id, score, place: the k best of each task for a block of queries, of pairs with a long vector.

    Pairs of two short vectors are left to the histograms.
    """
    sent = spark.sparkContext.broadcast([(r["vec_id"], r["grid"], r["wide"]) for r in block])

    def keep(batches):
        whole = lambda g, w: np.array([int(x) for x in g] if g is not None else [_whole(x, scale) for x in w], dtype=object)
        asked = [(i, whole(g, w), g is None) for i, g, w in sent.value]
        best: list[list] = [[] for _ in asked]
        for batch in batches:
            for name, g, w in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "grid", "wide")), strict=True):
                own = whole(g, w)
                for (q, theirs, long), held in zip(asked, best, strict=True):
                    if q != name and (long or g is None):
                        entry = (int((own * theirs).sum()), -name)
                        heapq.heappush(held, entry) if len(held) < k else heapq.heappushpop(held, entry)
        found = [(q, -name, score) for (q, _, _), held in zip(asked, best, strict=True) for score, name in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] if abs(f[2]) < 1 << 63 else None for f in found], pa.int64()),
             pa.array([sortable(f[2]) for f in found], pa.string())],
            names=["query_id", "vec_id", "score", "place"],
        )

    return rows.mapInArrow(keep, "query_id long, vec_id long, score long, place string")


def search(vectors: DataFrame, queries: Column, k: int = 5, block: int = BLOCK, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row that ``queries`` marks.

    Work grows with queries x rows, as scoring everything does; rows that move between tasks
    grow with queries x tasks. Candidates are never shuffled.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    ready = scratch.save(
        vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), grid(F.col("embedding"), scale).alias("grid"), wide(F.col("embedding"), scale).alias("wide"), queries.alias("asked"))
        .where("grid is not null or wide is not null"),
        "vectors",
    )
    length = F.size(F.coalesce("wide", F.col("grid").cast("array<double>")))
    short = F.col("grid").isNotNull()
    sizes = ready.groupBy(length.alias("size")).agg(
        F.max(F.aggregate("grid", F.lit(0).cast("long"), lambda acc, x: acc + x * x)).alias("bound"), F.count_if(F.col("asked") & short).alias("asked"),
        F.count_if(~short).alias("long"), F.count_if("asked").alias("all_asked"),
    ).collect()  # one row per vector length
    found, beyond = [], []
    for row in sizes:
        every = ready.where(length == row["size"])
        if row["long"]:
            who = every.where("asked").select("vec_id", "grid", "wide").distinct()
            blocks = -(-row["all_asked"] // block)
            dealt = who.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks))))
            for b in range(blocks):
                part = dealt.where(F.col("block") == b).drop("block").collect()
                if part:
                    beyond.append(_with_wide(spark, every.select("vec_id", "grid", "wide"), part, k, scale))
        own = every.where(short)
        asked = own.where("asked").select("vec_id", "grid").distinct()
        blocks = -(-row["asked"] // block)
        dealt = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks))))
        for b in range(blocks):
            part = dealt.where(F.col("block") == b).drop("block").orderBy("vec_id").toPandas()
            if len(part):
                found.append(_block(own.select("vec_id", "grid"), part, row["size"], row["bound"], k))
    if not found and not beyond:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id")]
    if beyond:
        found = [*(f.withColumn("place", _sortable(F.col("score"))) for f in found), *beyond]
        order[0] = F.col("place").desc()
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
