"""Exact top-k of sparse vectors with weights that are not negative, by inverted lists and their largest weights.

A probe's score with a candidate is the sum over common terms of the product of weights. Of every
term are known its largest weight, how many candidates have it, and its champions, the candidates
with the largest weights. What a probe's champions score within the champion lists alone is a
lower bound for their scores; the k-th best of it is the probe's threshold. Terms are then ordered
by the most they can add: those that even together stay below the threshold cannot bring a
candidate into the result on their own and their lists, mostly the long ones, are not opened.
Candidates come from the lists of the other terms, leave again if the closed terms could not
lift them to the threshold, and the rest is scored exactly from the stored vectors.

Lists of terms that very many candidates have are dealt into salts, and the probes' terms follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from traceframe.session import cut_lineage

CHAMPIONS = 64  # champions of a term, if k is not more
SALT_ROWS = 200_000  # candidates of a term in one salt
SLACK = 1e-9  # room for rounding in comparisons with the threshold
DIGITS = 12
SCORED_ROWS = 1000  # pairs that a task scores at a time


def _postings(df: DataFrame, key: str) -> DataFrame:
    """(key, term, weight) of the terms with a positive weight."""
    pairs = F.arrays_zip(F.col("at").alias("term"), F.col("vector").alias("weight"))
    return df.select(key, F.inline(pairs).alias("term", "weight")).where("weight > 0")


def term_facts(lists: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(term, top, n, salts) and the champions (term, match_id, weight); as many rows as there are terms, times ``CHAMPIONS``."""
    facts = lists.groupBy("term").agg(F.max("weight").alias("top"), F.count(F.lit(1)).alias("n"))
    place = Window.partitionBy("term").orderBy(F.col("weight").desc(), "match_id")
    champions = lists.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= max(k, CHAMPIONS)).drop("_place")
    return facts.withColumn("salts", F.ceil(F.col("n") / SALT_ROWS).cast("long")), champions


def open_terms(asked: DataFrame, facts: DataFrame, champions: DataFrame, k: int) -> DataFrame:
    """(probe_id, term, weight, salts, threshold, rest): the terms of every probe whose lists are opened.

    ``rest`` is the most that a probe's closed terms can add to a score.
    """
    terms = asked.join(facts, "term")
    known = terms.select("probe_id", "term", F.col("weight").alias("_q")).join(champions, "term").groupBy("probe_id", "match_id").agg(F.sum(F.col("_q") * F.col("weight")).alias("least"))
    order = Window.partitionBy("probe_id").orderBy(F.col("least").desc(), "match_id")
    threshold = known.withColumn("_place", F.row_number().over(order)).where(F.col("_place") == k).select("probe_id", F.col("least").alias("threshold"))
    most = F.col("weight") * F.col("top")
    small_first = Window.partitionBy("probe_id").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
    ranked = terms.withColumn("most", most).withColumn("sum", F.sum("most").over(small_first)).join(threshold, "probe_id", "left").withColumn("threshold", F.coalesce("threshold", F.lit(0.0)))
    closed = F.col("sum") < F.col("threshold") - SLACK
    rest = F.coalesce(F.max(F.when(closed, F.col("sum"))).over(Window.partitionBy("probe_id")), F.lit(0.0))
    return ranked.withColumn("rest", rest).where(~closed).select("probe_id", "term", "weight", "salts", "threshold", "rest")


def _candidates(opened: DataFrame, lists: DataFrame, facts: DataFrame) -> DataFrame:
    """(probe_id, match_id) that can reach the threshold."""
    salt = F.pmod(F.xxhash64("match_id"), F.col("salts"))
    dealt = lists.join(facts.select("term", "salts"), "term").select("term", salt.alias("salt"), "match_id", F.col("weight").alias("_w"))
    asked = opened.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    partial = asked.join(dealt, ["term", "salt"]).groupBy("probe_id", "match_id").agg(F.sum(F.col("weight") * F.col("_w")).alias("part"), F.max("threshold").alias("threshold"), F.max("rest").alias("rest"))
    return partial.where(F.col("part") + F.col("rest") >= F.col("threshold") - SLACK).select("probe_id", "match_id")


def _products(asked: pa.Array, asked_weights: pa.Array, own: pa.Array, own_weights: pa.Array) -> np.ndarray:
    """For every row, the sum of the products of weights of common terms, in the order of ``own``.

    Terms become numbers, so that all rows are looked up at once; a term of null is in no other vector.
    """
    n = len(own)
    of_row = lambda lists: np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    terms = pa.concat_arrays([asked.flatten(), own.flatten()]).dictionary_encode()
    codes = pc.fill_null(terms.indices, len(terms.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
    split, span, row = len(asked.flatten()), len(terms.dictionary) + 1, of_row(own)
    known, wanted = of_row(asked) * span + codes[:split], row * span + codes[split:]
    weights = pc.fill_null(asked_weights.flatten(), 0.0).to_numpy(zero_copy_only=False)
    order = np.argsort(known)
    known, weights = np.append(known[order], -1), np.append(weights[order], 0.0)
    place = np.searchsorted(known[:-1], wanted)
    return np.bincount(row, np.where(known[place] == wanted, weights[place], 0.0) * own_weights.flatten().to_numpy(zero_copy_only=False), n)


def _scored(pairs: DataFrame, probes: DataFrame, candidates: DataFrame) -> DataFrame:
    """(probe_id, match_id, score) of pairs (probe_id, match_id), from the stored vectors."""
    weights = F.map_from_arrays("at", "vector")  # no term twice
    both = pairs.join(probes.select("probe_id", weights.alias("_q")), "probe_id").join(candidates, "match_id")
    both = both.select("probe_id", "match_id", F.map_keys("_q").alias("asked"), F.map_values("_q").alias("weights"), "at", "vector")
    schema = T.StructType([*pairs.select("probe_id", "match_id").schema.fields, T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SCORED_ROWS):
                part = batch.slice(at, SCORED_ROWS)
                found = _products(*(part.column(c) for c in ("asked", "weights", "at", "vector")))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found)], names=["probe_id", "match_id", "score"])

    return both.mapInArrow(score, schema).withColumn("score", F.round("score", DIGITS))


def top_k(probes: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Best ``k`` candidates (match_id, at, vector) of every probe (probe_id, at, vector): probe_id, match_id, score, rank.

    ``at`` has the terms and ``vector`` their weights. Scores are rounded before they are ranked,
    equal ones go to the smaller id. Candidates without a common term score 0 and fill up
    what is missing to ``k``, smaller ids first. ``probe_id`` and ``match_id`` name rows.
    """
    parts = ["at", F.col("vector").cast("array<double>").alias("vector")]
    probes = cut_lineage(probes.select("probe_id", *parts), "probes")
    candidates = cut_lineage(candidates.select("match_id", *parts), "candidates")
    lists, asked = _postings(candidates, "match_id"), _postings(probes, "probe_id")
    facts, champions = (cut_lineage(t, "terms") for t in term_facts(lists, k))
    opened = cut_lineage(open_terms(asked, facts, champions, k), "opened")
    pairs = _candidates(opened, lists, facts)
    order = Window.partitionBy("probe_id").orderBy(F.col("score").desc(), "match_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    hits = cut_lineage(ranked(_scored(pairs, probes, candidates)), "hits")
    short = probes.select("probe_id").join(hits.where(F.col("rank") == k).select("probe_id"), "probe_id", "left_anti")
    # A probe has fewer than k hits here, so k more are among the 2 k smallest ids.
    first = F.broadcast(candidates.select("match_id").orderBy("match_id").limit(2 * k))
    rest = short.crossJoin(first).join(hits, ["probe_id", "match_id"], "left_anti").withColumn("score", F.lit(0.0))
    return ranked(hits.drop("rank").unionByName(rest))
