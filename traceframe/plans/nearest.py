"""Exact cosine top-k between two tables of vectors, through an index of cells (see ``cells``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from traceframe.functions.signal import l2_normalise
from traceframe.plans import cells


def _unit(df: DataFrame, key: str, width: int) -> tuple[DataFrame, DataFrame]:
    """(unit vectors, keys of vectors without length) of the finite vectors of one width."""
    vector = F.col("vector").cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    top = F.array_max(F.transform("vector", F.abs))
    own = df.select(key, vector.alias("vector")).where(F.col("vector").isNotNull() & (F.size("vector") == width)).where(fine).withColumn("_top", top)
    scaled = F.transform("vector", lambda x: x / F.col("_top"))
    return own.where("_top > 0").select(key, l2_normalise(scaled).alias("vector")), own.where("_top = 0").select(key)


def index_vectors(candidates: DataFrame, pivots: int = cells.PIVOTS) -> tuple[cells.Stored, DataFrame]:
    """Index (match_id, vector): the stored cells, and the ids of vectors without length."""
    width = max(1, candidates.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0])
    full, empty = _unit(candidates, "match_id", width)
    return cells.store(full, cells.PivotIndex.fit(full, width, pivots)), empty


def top_k(probes: DataFrame, candidates: DataFrame, k: int, pivots: int = cells.PIVOTS) -> DataFrame:
    """Best ``k`` candidates (match_id, vector) of every probe (probe_id, vector): probe_id, match_id, score, rank.

    Scores are rounded to 12 digits; equal ones go to the smaller id. A vector without length
    scores 0 with everything; vectors that are null, not finite or of another width than the
    longest candidate take no part. ``probe_id`` names a row.
    """
    stored, empty = index_vectors(candidates, pivots)
    asked, blank = _unit(probes, "probe_id", stored.index.width)
    found = cells.search(asked, stored, k).select("probe_id", "match_id", (-F.col("cost")).alias("score"))
    # Score 0 with every probe: of these only the k smallest ids can win.
    zero = F.broadcast(empty.orderBy("match_id").limit(k))
    found = found.unionByName(asked.select("probe_id").crossJoin(zero).withColumn("score", F.lit(0.0)))
    least = F.broadcast(stored.rows.select("match_id").unionByName(empty).orderBy("match_id").limit(k))
    found = found.unionByName(blank.crossJoin(least).withColumn("score", F.lit(0.0)))
    # 0 in place of -0.
    order = Window.partitionBy("probe_id").orderBy(F.col("score").desc(), "match_id")
    return found.withColumn("score", F.col("score") + F.lit(0.0)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
