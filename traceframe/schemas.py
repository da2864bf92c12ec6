"""Declared schemas of the table layers and the check that runs before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Column names and order of the layer tables, below and in the schemas.
HANDCRAFTED = [
    "mean_amplitude",
    "std_amplitude",
    "min_amplitude",
    "max_amplitude",
    "rms_amplitude",
    "energy",
    "zero_crossings",
    "dominant_frequency",
]
EMBEDDING_DIM = 32
EMBEDDINGS = [f"embedding_{i}" for i in range(EMBEDDING_DIM)]
METADATA = ["file_id", "trace_id", "class_label"]
HEADERS = [
    "num_samples",
    "sample_rate",
    "inline",
    "crossline",
    "cdp_x",
    "cdp_y",
    "field_record",
    "trace_number",
]


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


BRONZE = _fields(
    ("file_id", T.StringType()),
    ("trace_id", T.LongType()),
    ("trace_data", T.ArrayType(T.DoubleType())),
    ("num_samples", T.LongType()),
    ("sample_rate", T.DoubleType()),
    *[(c, T.LongType()) for c in HEADERS[2:]],
    ("class_label", T.LongType()),
)

SILVER = _fields(
    ("file_id", T.StringType()),
    ("trace_id", T.LongType()),
    ("class_label", T.LongType()),
    *[(c, T.DoubleType()) for c in HANDCRAFTED + EMBEDDINGS],
    *[(f"{c}_scaled", T.DoubleType()) for c in HANDCRAFTED + EMBEDDINGS],
)

PREDICTIONS = _fields(
    ("file_id", T.StringType()),
    ("trace_id", T.LongType()),
    ("true_label", T.LongType()),
    ("predicted_label", T.LongType()),
    ("correct", T.BooleanType()),
    ("true_class", T.StringType()),
    ("predicted_class", T.StringType()),
    ("prob_normal", T.DoubleType()),
    ("prob_anomaly", T.DoubleType()),
    ("prob_boundary", T.DoubleType()),
)

HISTORY = _fields(
    ("total_traces", T.LongType()),
    ("total_files", T.LongType()),
    ("mean_amplitude", T.DoubleType()),
    ("std_amplitude", T.DoubleType()),
    ("class_distribution", T.MapType(T.StringType(), T.DoubleType())),
)

CHUNKS = _fields(
    ("content", T.StringType()),
    ("metadata", T.MapType(T.StringType(), T.StringType())),
    ("doc_id", T.StringType()),
)


def conform(df: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Order and cast the columns of ``df`` to ``schema``.

    A missing column is an error unless listed in ``optional``, in which case it
    is left out. Unknown columns are an error, so a layer cannot drift silently.
    """
    have = set(df.columns)
    want = [f for f in schema.fields if f.name in have or f.name not in optional]
    missing = [f.name for f in want if f.name not in have]
    extra = sorted(have - {f.name for f in schema.fields})
    if missing or extra:
        raise ValueError(f"schema mismatch: missing {missing}, unexpected {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want])
