"""Filling gaps in header columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from traceframe.functions.labels import present
from traceframe.plans import cells
from traceframe.plans.ranking import exact_median
from traceframe.session import cut_lineage


def _row_name(df: DataFrame, key: list[str]):
    """One column that names a row: a single key itself, several as text in the order of the keys."""
    if len(key) == 1:
        return F.col(key[0])
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    parts = [F.lpad(F.col(c).cast("string"), 20, "0") if isinstance(df.schema[c].dataType, whole) else F.col(c).cast("string") for c in key]
    return F.concat_ws("\x1f", *parts)


def nearest_donors(df: DataFrame, columns: list[str], key: str, k: int = 2, cell_rows: int = cells.CELL_ROWS) -> tuple[DataFrame, cells.Stored]:
    """The ``k`` nearest donors of every gap: (probe_id, wanted column's place, match_id, cost, value, rank).

    Nearness is Euclidean over the columns both rows have, scaled up to all columns; a donor has
    the wanted column; of equally near ones those with the smaller key are taken. One probe per
    incomplete row, searched through an index of cells; the second result knows how many
    pairs were compared.
    """
    values = F.array(*[present(F.col(c).cast("double")) for c in columns])
    rows = cut_lineage(df.select(F.col(key).alias("match_id"), values.alias("vector")), "rows")
    stored = cells.store(rows, cells.GapIndex.fit(rows, len(columns), cell_rows))
    probes = rows.where(F.exists("vector", lambda x: x.isNull())).withColumnRenamed("match_id", "probe_id")
    return cells.search(probes, stored, k), stored


def impute_nearest(df: DataFrame, columns: list[str], key: str | list[str], k: int = 2, cell_rows: int = cells.CELL_ROWS) -> DataFrame:
    """Replace missing values by the mean of the ``k`` nearest donors, per column.

    Null and NaN are missing. ``key`` names a row, by one column or several such as file and
    trace. Only incomplete rows are searched for; a value without any usable donor gets the
    column mean. Columns come out as doubles.
    """
    row = _row_name(df, [key] if isinstance(key, str) else list(key))
    df = df.withColumn("_row", row)
    found, _ = nearest_donors(df, columns, "_row", k, cell_rows)
    filled = found.groupBy(F.col("probe_id").alias("_row")).agg(*[F.avg(F.when(F.col("wanted") == i, F.col("value"))).alias(f"_f_{c}") for i, c in enumerate(columns)])
    means = df.agg(F.struct(*[F.avg(present(F.col(c).cast("double"))).alias(c) for c in columns])).scalar()
    out = df.join(filled, "_row", "left")
    return out.select(
        *[
            F.coalesce(present(F.col(c).cast("double")), F.col(f"_f_{c}"), means[c]).alias(c) if c in columns else F.col(c)
            for c in df.columns
            if c != "_row"
        ]
    )


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace nulls and NaN by the exact column median."""
    medians = exact_median(df, columns)
    # One entry per column.
    table = medians.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "median")))).scalar()
    return df.select(
        *[
            F.coalesce(present(F.col(c).cast("double")), table[c]).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


