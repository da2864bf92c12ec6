"""Conflict-constrained best-fit packing of documents into training sequences.

A document is cut into pieces of at most ``capacity`` words; every piece goes to one bin.
Bins are kept ordered by what is left in them, and each carries two bitmaps: the sources
and the duplicate clusters it holds. A piece goes to the tightest bin it fits into whose
bitmaps share no bit with it; the successor search goes on to wider bins until one is
compatible, and a new bin is opened if none is. Pieces come largest first, then by id.

Spark deals documents by a hash of their id into lanes of about ``lane_rows`` documents, so
a source or a group of copies with a third of all rows is spread evenly; each lane packs
its own bins in one task. Only ids, sizes, source and cluster are shuffled, never texts. A
lane's share of half-empty last bins is the price: about one bin per lane and source.

Defined cases: a null or empty text has one piece of 0 words and takes part; a null source
is a source of its own, a null cluster conflicts with nothing; pieces of one document
share source and cluster, so they never meet in a bin; rows that repeat an id are packed
each for itself, in lanes of their own choice if there are very many of them; an empty table has no bins; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from traceframe.llm.common import Scratch

CAPACITY = 4096
LANE_ROWS = 8192
REPEATS = 1024  # rows of one id and cluster that may share a lane
SCHEMA = "doc_id long, piece int, first_word long, n_words long, lane long, bin long, position int, bin_words long"


class Lane:
    """Bins of one lane ordered by residual, with a source and a cluster bitmap each."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (words left, bin)
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.held: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin a piece goes to; ``source`` and ``cluster`` are one-bit masks (0: none)."""
        order, sources, clusters = self.order, self.sources, self.clusters
        at = bisect_left(order, (size, -1))
        while at < len(order):
            left, bin_ = order[at]
            if not (sources[bin_] & source or clusters[bin_] & cluster):
                del order[at]
                break
            at += 1
        else:
            left, bin_ = self.capacity, len(sources)
            sources.append(0)
            clusters.append(0)
            self.held.append(0)
        sources[bin_] |= source
        clusters[bin_] |= cluster
        self.held[bin_] += 1
        if left - size > 0:
            insort(order, (left - size, bin_))
        return bin_


def pack_lane(pieces: list[tuple[int, int | None, int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, position) of every piece (n_words, doc_id, piece, source, cluster), in the given order."""
    lane, bits = Lane(capacity), {}
    groups: dict[object, int] = {}
    for _, _, _, _, cluster in pieces:
        if cluster is not None:
            groups[cluster] = groups.get(cluster, 0) + 1
    shared = {c: 1 << i for i, c in enumerate(c for c, n in groups.items() if n > 1)}  # a single piece needs no bit
    out = []
    for size, _, _, source, cluster in pieces:
        bit = bits.setdefault(source, 1 << len(bits))
        bin_ = lane.place(size, bit, shared.get(cluster, 0))
        out.append((bin_, lane.held[bin_] - 1))
    return out


def text_cluster(text: Column) -> Column:
    """Cluster of copies: digest of the text's lower-cased words; null without any."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.when(F.length(plain) > 0, F.xxhash64(plain))


def pack(
    docs: DataFrame, capacity: int = CAPACITY, lane_rows: int = LANE_ROWS,
    size: Column | None = None, cluster: Column | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, lane, bin, position, bin_words.

    ``size`` is a document's length in words (or tokens), counted from its text by default;
    ``cluster`` names groups of copies, by default those with the same words.
    """
    n_words = F.coalesce(F.regexp_count("text", F.lit(r"\S+")) if size is None else size, F.lit(0)).cast("long")
    group = text_cluster(F.col("text")) if cluster is None else cluster
    rows = docs.count()
    lanes = max(1, -(-rows // lane_rows))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), n_words.alias("words"), F.col("source").cast("string").alias("source"), group.alias("cluster")
    )
    name = [F.coalesce("doc_id", F.lit(-1)), F.coalesce("cluster", F.lit(0))]
    lane = lambda *salt: F.pmod(F.xxhash64(*name, *salt), F.lit(lanes)).alias("lane")
    # Stored: read twice without the texts, and a repeated task finds the same row numbers.
    slim = Scratch(docs.sparkSession, "packing").save(slim.withColumn("_row", F.monotonically_increasing_id()), "rows")
    repeated = slim.groupBy(*[n.alias(f"_{i}") for i, n in enumerate(name)]).agg(F.count("*").alias("_n")).where(F.col("_n") > REPEATS)
    if repeated.limit(1).count():
        # Rows that repeat one name would be one lane.
        joined = slim.join(repeated.withColumn("_many", F.lit(True)), (name[0] == F.col("_0")) & (name[1] == F.col("_1")), "left")
        slim = joined.select("doc_id", "words", "source", "cluster", F.when(F.col("_many"), lane("_row")).otherwise(lane()).alias("lane"))
    else:
        slim = slim.select("doc_id", "words", "source", "cluster", lane())

    def lane_of(own: pd.DataFrame) -> pd.DataFrame:
        number = int(own["lane"].iloc[0])
        pieces = []
        for doc, words, source, key in zip(own["doc_id"].tolist(), own["words"].tolist(), own["source"].tolist(), own["cluster"].tolist(), strict=True):
            doc = None if pd.isna(doc) else int(doc)
            key = None if pd.isna(key) else int(key)
            source = None if pd.isna(source) else source
            for i, first in enumerate(range(0, max(1, words), capacity)):
                pieces.append((min(capacity, words - first), doc, i, source, key))
        pieces.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2], str(p[3]), p[4] or 0))
        placed = pack_lane(pieces, capacity)
        full: dict[int, int] = {}
        for (n, *_), (b, _) in zip(pieces, placed, strict=True):
            full[b] = full.get(b, 0) + n
        return pd.DataFrame(
            {
                "doc_id": pd.array([p[1] for p in pieces], dtype="Int64"), "piece": [p[2] for p in pieces], "first_word": [p[2] * capacity for p in pieces],
                "n_words": [p[0] for p in pieces], "lane": number, "bin": [b for b, _ in placed], "position": [i for _, i in placed], "bin_words": [full[b] for b, _ in placed],
            }
        )

    return slim.groupBy("lane").applyInPandas(lane_of, SCHEMA)
