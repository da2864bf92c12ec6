"""Output audit: which expected tables are there and how many rows they have."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def observe(tables: dict[str, DataFrame], metrics: dict[str, object] | None = None) -> DataFrame:
    """Rows (layer, num_rows, metric) of the tables that exist; one aggregate each."""
    metrics = metrics or {}
    out = None
    for name, df in tables.items():
        metric = metrics.get(name, F.lit(None)).cast("double")
        row = df.agg(F.count(F.lit(1)).alias("num_rows"), metric.alias("metric")).select(
            F.lit(name).alias("layer"), "num_rows", "metric"
        )
        out = row if out is None else out.unionByName(row)
    return out


def audit(spark, expected: list[str], observed: DataFrame) -> DataFrame:
    """Status of every expected layer and of the whole list."""
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(e) for e in expected])).alias("layer"))
    joined = wanted.join(observed, "layer", "left")
    status = F.when(F.col("num_rows").isNull(), "missing").when(F.col("num_rows") == 0, "empty").otherwise("success")
    rows = joined.withColumn("status", status)
    failed = rows.agg(F.max((F.col("status") != "success").cast("int"))).scalar()
    return rows.withColumn("overall_status", F.when(failed == 1, "failed").otherwise("success"))
