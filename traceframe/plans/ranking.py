"""Exact ranks and order statistics without one task that sees every row.

A rank is the rows in earlier buckets plus the position inside the own bucket.
Buckets are contiguous in the wanted order, their counts are a table of fixed
size, and only single buckets are ever sorted in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from traceframe.functions.hashing import digest
from traceframe.functions.labels import present
from traceframe.session import cut_lineage

# Hash buckets are the leading hex digits of a digest: 16 ** 4 = 65536 of them,
# each holding an even share of the rows whatever the keys look like.
PREFIX = 4


def _previous(by: list[str], order: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _bucket_offsets(df: DataFrame, by: list[str], bucket: str) -> DataFrame:
    """Rows before each bucket and rows in all, per group.

    The windows run over bucket counts only.
    """
    counts = df.groupBy(*by, bucket).agg(F.count(F.lit(1)).alias("_n"))
    out = counts if by else counts.withColumn("_all", F.lit(1))
    group = by or ["_all"]
    before = F.coalesce(F.sum("_n").over(_previous(group, bucket)), F.lit(0))
    return (
        out.withColumn("_before", before)
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*group)))
        .select(*by, bucket, "_n", "_before", "_total")
    )


def hash_rank(
    df: DataFrame,
    keys: list[str],
    seed: str,
    by: list[str] | None = None,
    name: str = "rank",
    first: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Append the 1-based rank of every row in hash order, per group.

    With ``first`` only ranks up to that number are produced: buckets past it
    are dropped while scanning, so little more than ``first`` rows is shuffled.
    With ``total`` the size of the group is appended under that name. The input
    is read twice, the first time for its keys and groups only.
    """
    by = by or []
    tagged = df.withColumn("_h", digest(seed, *keys)).withColumn("_b", F.substring("_h", 1, PREFIX))
    offsets = _bucket_offsets(df.select(*by, F.substring(digest(seed, *keys), 1, PREFIX).alias("_b")), by, "_b")
    if first is not None:
        offsets = offsets.filter(F.col("_before") < first)
    group = []
    if by:
        # Null groups rank among themselves.
        group = ["_g"]
        tagged = tagged.withColumn("_g", F.to_json(F.struct(*by)))
        offsets = offsets.select(F.to_json(F.struct(*by)).alias("_g"), "_b", "_before", "_total")
    else:
        # At most 65536 rows of a few numbers.
        offsets = F.broadcast(offsets.select("_b", "_before", "_total"))
    joined = tagged.join(offsets, [*group, "_b"])
    inside = Window.partitionBy(*group, "_b").orderBy("_h", *keys)
    ranked = joined.withColumn(name, (F.row_number().over(inside) + F.col("_before")).cast("long"))
    if total is not None:
        ranked = ranked.withColumn(total, F.col("_total"))
    ranked = ranked.drop("_h", "_b", "_before", "_total", "_g")
    return ranked if first is None else ranked.filter(F.col(name) <= first)


def bucket_count(df: DataFrame) -> int:
    """Value buckets for this session: as many as shuffle partitions, within limits."""
    return min(4096, max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def quantile_cuts(value: Column, buckets: int) -> Column:
    """Aggregate giving ascending cut points that split ``value`` into even buckets."""
    listed = ", ".join(repr(i / buckets) + "D" for i in range(1, buckets))
    return F.percentile_approx(value, F.expr(f"array({listed})"), F.lit(max(1000, 20 * buckets)))


CUT_GROUPS = 256


def even_cuts(df: DataFrame, values: dict[str, Column], buckets: int) -> DataFrame:
    """One row with cut points of every named value, found in two levels.

    Rows are sketched by up to ``CUT_GROUPS`` groups of scan partitions, each in a task of its
    own, and the cut points of the groups are cut once more: at most groups x buckets
    numbers. Borders decide how even buckets are, never the ranks.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(CUT_GROUPS)).alias("_part")
    first = df.select(part, *[v.alias(n) for n, v in values.items()]).groupBy("_part").agg(
        *[quantile_cuts(F.col(n), buckets).alias(n) for n in values]
    )
    none = {f.name: F.array().cast(f.dataType) for f in first.schema.fields if f.name != "_part"}
    zipped = F.arrays_zip(*[F.coalesce(F.col(n), none[n]).alias(n) for n in values])
    return first.select(F.inline(zipped)).agg(*[quantile_cuts(F.col(n), buckets).alias(n) for n in values])


def with_bucket(df: DataFrame, cuts: Column, value: Column, buckets: int, name: str = "_b") -> DataFrame:
    """Append how many of the ascending ``cuts`` lie below ``value``.

    A binary search, one projected column per halving step, each using the one
    before: plain array reads and comparisons that stay in generated code. Null
    cuts give 0.
    """
    steps = [1 << i for i in reversed(range((buckets - 1).bit_length()))]
    found, columns = F.lit(0), []
    for i, step in enumerate(steps):
        below = F.get(cuts, found + (step - 1)) < value
        columns.append((found + F.when(below, F.lit(step)).otherwise(F.lit(0))).alias(f"_at{i}"))
        found = F.col(f"_at{i}")
    return df.select("*", *columns, found.alias(name)).drop(*[f"_at{i}" for i in range(len(steps))])


def ordered_rank(df: DataFrame, order: str, name: str = "rank", buckets: int | None = None) -> DataFrame:
    """Append the 1-based position of every row by a unique numeric or time column."""
    buckets = buckets or bucket_count(df)
    tagged = with_value_bucket(df, order, buckets)
    offsets = F.broadcast(_bucket_offsets(tagged.select("_b"), [], "_b").select("_b", "_before"))
    inside = Window.partitionBy("_b").orderBy("_v")
    out = tagged.join(offsets, "_b").withColumn(
        name, (F.row_number().over(inside) + F.col("_before")).cast("long")
    )
    return out.drop("_b", "_v", "_before")


def nested_rank(df: DataFrame, order: list[str], name: str = "rank", ranges: int | None = None) -> DataFrame:
    """Append the 1-based position of every row in ``order``, a list of keys from coarse to fine.

    Rows are dealt into ranges of the whole key and stored, so that a file of all rows is spread like
    any other; a range's rows are numbered in its task, and the rows of the ranges
    before it are added. The ranges decide how even the tasks are, never the ranks. Rows that are alike in the
    whole key are numbered among themselves in any order.
    """
    ranges = ranges or bucket_count(df)
    dealt = cut_lineage(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    # One row per range.
    offsets = F.broadcast(_bucket_offsets(dealt.select("_range"), [], "_range").select("_range", "_before"))
    inside = Window.partitionBy("_range").orderBy(*order)
    numbered = dealt.join(offsets, "_range").withColumn(name, (F.row_number().over(inside) + F.col("_before")).cast("long"))
    return numbered.drop("_range", "_before")


def with_value_bucket(df: DataFrame, order: str, buckets: int) -> DataFrame:
    """Append the order value ``_v`` and its even-sized bucket ``_b``.

    The cut points are ``buckets - 1`` numbers fetched once, so both uses of the
    result agree on them. They decide how even the buckets are, never the ranks.
    """
    number = as_number(df, order)
    cuts = even_cuts(df, {"_cut": number}, buckets).first()[0] or []
    listed = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<double>")
    return with_bucket(df.withColumn("_v", number), listed, F.col("_v"), buckets)


def as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp":
        return F.unix_micros(F.col(column))
    if kind == "timestamp_ntz":
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column)


def running_totals(
    counts: DataFrame,
    cuts: DataFrame,
    by: str,
    value: str,
    sums: list[str],
    buckets: int,
) -> DataFrame:
    """Running sums of ``sums`` in ``value`` order inside each ``by`` group.

    ``counts`` has one row per (by, value). ``cuts`` has one row per group with
    an array of cut points; groups are columns or classes, never data keys, so
    it is small by construction. Adds ``cum_<sum>`` (own row included).
    """
    tagged = with_bucket(counts.join(F.broadcast(cuts), by), F.col("cuts"), F.col(value), buckets).drop("cuts")
    per_bucket = tagged.groupBy(by, "_b").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = _previous([by], "_b")
    # Groups x buckets rows.
    offsets = F.broadcast(
        per_bucket.select(
            by, "_b", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums]
        )
    )
    inside = Window.partitionBy(by, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    out = tagged.join(offsets, [by, "_b"])
    totals = {f"cum_{s}": F.sum(s).over(inside) + F.col(f"_o_{s}") for s in sums}
    return out.withColumns(totals).drop("_b", *[f"_o_{s}" for s in sums])


def wide_cuts(df: DataFrame, columns: list[str], name: str, buckets: int) -> DataFrame:
    """Cut points of several numeric columns in one pass: rows (name, cuts)."""
    wide = even_cuts(df, {c: F.col(c).cast("double") for c in columns}, buckets)
    return unpivot(wide, [], columns, name, "cuts")


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row per listed column, by a single generator over one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns])
    return df.select(*ids, F.inline(pairs))


ACCURACY = 10_000  # a sketch's rank is off by one in so many rows at most
ROWS_LEFT = 20_000  # values of a column that may be left in its bracket


@dataclass
class _Bracket:
    """Where the middle of a column is: rows in all, rows below ``low``, rows from ``low`` to ``high``."""

    rows: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0

    def holds_middle(self) -> bool:
        return self.below < (self.rows + 1) // 2 and self.rows // 2 + 1 <= self.below + self.inside

    def shares(self) -> tuple[float, float]:
        """Shares of the bracket's rows between which the middle lies, with room for the sketch's error."""
        places = ((self.rows + 1) // 2 - self.below, self.rows // 2 + 1 - self.below)
        room = 2 / ACCURACY
        return max(0.0, (places[0] - 1) / self.inside - room), min(1.0, (places[1] + 1) / self.inside + room)


def _within(column: str, b: _Bracket) -> Column:
    # Infinite values lie in an open bracket.
    return (F.col(column) >= F.lit(b.low)) & (F.col(column) <= F.lit(b.high))


def middle_brackets(numbers: DataFrame, columns: list[str], rows_left: int = ROWS_LEFT) -> dict[str, _Bracket]:
    """A bracket around the middle of each column that holds few rows, or copies of one value.

    Every round sketches the open brackets in one scan and counts in a second which rows lie
    below and inside the narrower ones; nothing is shuffled but one row per task. A sketch that missed the
    middle is noticed by the counts and its bracket stays as it was.
    """
    first = numbers.agg(*[F.count(c).alias(c) for c in columns]).first()
    out = {c: _Bracket(first[c], inside=first[c]) for c in columns if first[c]}
    open_columns = list(out)
    while open_columns := [c for c in open_columns if out[c].inside > rows_left and out[c].low < out[c].high]:
        ends = {c: out[c].shares() for c in open_columns}
        sketch = lambda c: F.percentile_approx(F.when(_within(c, out[c]), F.col(c)), F.array(*[F.lit(x) for x in ends[c]]), F.lit(ACCURACY))
        found = numbers.agg(*[sketch(c).alias(c) for c in open_columns]).first()
        narrow = {c: _Bracket(out[c].rows, found[c][0], found[c][1]) for c in open_columns}
        counts = numbers.agg(*[F.count_if(F.col(c) < F.lit(b.low)).alias(f"b_{c}") for c, b in narrow.items()], *[F.count_if(_within(c, b)).alias(f"i_{c}") for c, b in narrow.items()]).first()
        shrunk = []
        for c, b in narrow.items():
            b.below, b.inside = counts[f"b_{c}"], counts[f"i_{c}"]
            if b.holds_middle() and b.inside < out[c].inside:
                out[c] = b
                shrunk.append(c)
        open_columns = shrunk
    return out


def exact_median(df: DataFrame, columns: list[str], rows_left: int = ROWS_LEFT) -> DataFrame:
    """Exact median of each column, nulls and NaN left out: rows (column_name, median).

    Only values inside a bracket around the middle are counted one by one.
    """
    numbers = df.select(*[present(F.col(c).cast("double")).alias(c) for c in columns])
    found = middle_brackets(numbers, columns, rows_left)
    inside = numbers.select(*[F.when(_within(c, b), F.col(c)).alias(c) for c, b in found.items()])
    spark = df.sparkSession
    if not found:
        return spark.createDataFrame([], "column_name string, median double")
    counts = unpivot(inside, [], list(found), "column_name", "value").where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    before = spark.createDataFrame([(c, b.below, (b.rows + 1) // 2, b.rows // 2 + 1) for c, b in found.items()], "column_name string, below long, p1 long, p2 long")
    ranked = counts.join(F.broadcast(before), "column_name").withColumn(
        "upto", F.col("below") + F.sum("n").over(Window.partitionBy("column_name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    )
    holds = lambda p: (F.col("upto") - F.col("n") < F.col(p)) & (F.col("upto") >= F.col(p))
    middle = [F.max(F.when(holds(p), F.col("value"))) for p in ("p1", "p2")]
    return ranked.groupBy("column_name").agg(((middle[0] + middle[1]) / 2).alias("median"))
