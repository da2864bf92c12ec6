"""Sharding by extendible hashing.

Documents hang in buckets by the first bits of a digest of their id. A bucket over the byte
limit splits on the next bit, all others stay as they are, until every bucket fits. The
result does not depend on the order of splits: a document's bucket is the shortest prefix
of its digest whose documents fit the limit. So the splits are found from byte sums of
prefixes, many bits at a time, and only oversized prefixes are looked at again.

Defined cases: a null text has no bytes; a null id is digested as an empty string; a
document larger than the limit, and rows that repeat one id, cannot be parted by bits:
they stay together after the last bit and are marked ``fits`` = false; an empty table has no
shards; other columns are carried along by ``shard`` under their own names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from traceframe.llm.common import Scratch

LIMIT_BYTES = 1 << 20
BITS = 60  # 15 hexadecimal digits of the digest
STEP = 12  # bits that one more look adds


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the md5 of the key's text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def prefix(bits: Column, depth: Column | int) -> Column:
    d = depth if isinstance(depth, Column) else F.lit(depth)
    return F.call_function("shiftright", bits, (F.lit(BITS) - d).cast("int"))


def leaves(sizes: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """Directories, one per look: (bits of its cells, cell -> depth, bytes, rows, fits).

    ``sizes`` has one row per document: hash, n_bytes. Every look sums bytes per cell (a
    prefix of ``bits`` bits), adds them up for all shorter prefixes down to the depth already
    known to be too large, and takes the shortest that fits. Cells too large even at their
    full length are looked at again with more bits; the rest of the table is not.
    """
    total = sizes.agg(F.sum("n_bytes").alias("b")).first()["b"] or 0
    bits, low = min(BITS, max(1, math.ceil(math.log2(max(2, 2 * total / limit))) + 2)), 0
    out, left = [], sizes
    scratch = Scratch(sizes.sparkSession, "shards")
    while True:
        cells = left.groupBy(prefix(F.col("hash"), bits).alias("cell")).agg(F.sum("n_bytes").alias("cell_bytes"), F.count("*").alias("cell_rows"))
        cells = scratch.save(cells, f"cells-{bits}")
        depths = F.explode(F.sequence(F.lit(low), F.lit(bits))).alias("depth")
        tops = (
            cells.select("cell", "cell_bytes", "cell_rows", depths)
            .groupBy("depth", F.call_function("shiftright", F.col("cell"), (F.lit(bits) - F.col("depth")).cast("int")).alias("top"))
            .agg(F.sum("cell_bytes").alias("n_bytes"), F.sum("cell_rows").alias("n_rows"), F.min("cell").alias("least"))
        )
        last = bits == BITS
        fit = (F.col("n_bytes") <= limit) | (F.lit(last) & (F.col("depth") == BITS))
        # A prefix that fits is a leaf unless its parent fits as well.
        leaf = (
            tops.where(fit)
            .select("depth", "top", "n_bytes", "n_rows")
            .join(
                cells.select("cell", depths).withColumn("top", F.call_function("shiftright", F.col("cell"), (F.lit(bits) - F.col("depth")).cast("int"))),
                ["depth", "top"],
            )
            .groupBy("cell")
            .agg(F.min(F.struct("depth", "top", "n_bytes", "n_rows")).alias("leaf"))
            .select("cell", "leaf.*")
            .withColumn("fits", F.col("n_bytes") <= limit)
        )
        leaf = scratch.save(leaf, f"directory-{bits}")
        out.append((bits, leaf))
        open_cells = cells.where(F.col("cell_bytes") > limit).select("cell")
        if last or open_cells.limit(1).count() == 0:
            return out
        left = left.withColumn("cell", prefix(F.col("hash"), bits)).join(open_cells, "cell", "left_semi").select("hash", "n_bytes")
        low, bits = bits + 1, min(BITS, bits + STEP)


def shard(docs: DataFrame, limit: int = LIMIT_BYTES, key: str = "doc_id", size: Column | None = None) -> DataFrame:
    """Documents with ``shard`` (its bits as text), ``shard_depth``, ``shard_bytes``, ``shard_rows``, ``fits``.

    ``size`` is a document's bytes, those of its text by default. Columns of the names above
    that ``docs`` already has are replaced. The directory has a few rows per shard.
    """
    kept = docs.drop("shard", "shard_depth", "shard_bytes", "shard_rows", "fits")
    n_bytes = F.coalesce(F.octet_length("text") if size is None else size, F.lit(0)).cast("long")
    scratch = Scratch(docs.sparkSession, "shards")
    sizes = scratch.save(docs.select(hash_bits(F.col(key)).alias("hash"), n_bytes.alias("n_bytes")), "sizes")
    found = leaves(sizes, limit)
    own = kept.withColumn("__hash", hash_bits(F.col(key)))
    picks = []
    for i, (bits, directory) in enumerate(found):
        own = own.withColumn(f"__cell{i}", prefix(F.col("__hash"), bits)).join(
            directory.select(F.col("cell").alias(f"__cell{i}"), F.struct("depth", "top", "n_bytes", "n_rows", "fits").alias(f"__leaf{i}")), f"__cell{i}", "left"
        )
        picks.append(F.col(f"__leaf{i}"))
    leaf = F.coalesce(*picks)
    name = F.when(leaf["depth"] == 0, "").otherwise(F.lpad(F.conv(leaf["top"].cast("string"), 10, 2), leaf["depth"], F.lit("0")))
    return own.select(
        *[F.col(f"`{c}`") for c in kept.columns], name.alias("shard"), leaf["depth"].cast("int").alias("shard_depth"),
        leaf["n_bytes"].alias("shard_bytes"), leaf["n_rows"].alias("shard_rows"), leaf["fits"].alias("fits"),
    )


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> DataFrame:
    """Write every shard as one folder of Parquet; returns what was written, read back.

    One task writes one shard, which the limit bounds.
    """
    out = shard(docs, limit).drop("shard_depth", "shard_bytes", "shard_rows", "fits")
    out.repartition(F.col("shard")).withColumn("shard_name", F.concat(F.lit("b"), "shard")).drop("shard").write.partitionBy("shard_name").parquet(path)
    return docs.sparkSession.read.parquet(path)
