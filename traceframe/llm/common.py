"""Shared pieces of the corpus operators: tables in the shared folder and batch helpers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from traceframe.session import shared_folder

#: Text that a task holds decoded at one time, in bytes.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written below the shared folder. ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.base = shared_folder(spark, purpose)
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.base}/{self.n}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stored_at = path
        return out

    def drop(self, *stored: DataFrame) -> None:
        for df in stored:
            remove(self.spark, df.stored_at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written, on whatever file system it is."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts hold at most ``limit`` bytes, or one longer text."""
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def split_mod(column: str, of: int) -> Column:
    """crc32 of the decimal id modulo ``of``; null ids fall in no class."""
    return F.crc32(F.col(column).cast("string")) % of


def fresh(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
