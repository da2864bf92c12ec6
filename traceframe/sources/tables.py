"""Layer tables, batch files and JSON records on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from traceframe.functions.text import file_id
from traceframe.schemas import conform


def write_layer(
    df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: str | None = None,
    optional: tuple[str, ...] = (), max_records_per_file: int = 1_000_000,
) -> None:
    """Overwrite a layer table after checking it against its declared schema.

    A partitioned write is rebalanced by the partition column first: small
    partitions get one file, a partition that holds a large share of all rows
    is split over tasks and files.
    """
    out = conform(df, schema, optional) if schema is not None else df
    if partition_by:
        out = out.hint("rebalance", F.col(partition_by))
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def read_layer(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Read ``folder/name`` if it is there, else ``folder/name.parquet``.

    With a schema, partition values keep their declared type and nothing is inferred.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    last = None
    for path in (f"{folder}/{name}", f"{folder}/{name}.parquet"):
        try:
            return reader.parquet(path)
        except AnalysisException as e:
            last = e
    raise FileNotFoundError(f"no table {name} in {folder}") from last


def read_batch(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scoring input by suffix: .parquet or .csv with a header."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV input needs a schema")
        return spark.read.schema(schema).option("header", True).csv(path)
    raise ValueError(f"unsupported file format: {path}")


def write_batch(df: DataFrame, path: str) -> None:
    """Scoring output by suffix: .parquet, else CSV with a header."""
    if path.endswith(".parquet"):
        df.write.mode("overwrite").parquet(path)
    else:
        df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file: (source = file name, content)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("source"), F.col("value").alias("content")
    )


def with_file_id(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Append ``file_id`` from the file each row came from."""
    return df.withColumn("file_id", file_id(F.col("_metadata.file_path") if path is None else path))
