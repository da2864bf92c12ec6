"""Chunk tables, TF-IDF vectors, exact top-k search and context assembly."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from traceframe.functions import rules, text as tx
from traceframe.plans import frequent, nearest, postings
from traceframe.session import cut_lineage


def chunk_documents(df: DataFrame, content: str, source: str, **options) -> DataFrame:
    """Chunk table (content, metadata, doc_id) of a table of texts."""
    pieces = df.select(
        F.col(source).cast("string").alias("_s"),
        F.posexplode(tx.chunker(**options)(F.col(content))).alias("chunk_index", "content"),
    )
    return as_chunks(pieces)


def as_chunks(pieces: DataFrame) -> DataFrame:
    """Give pieces (_s, chunk_index, content) their id and metadata."""
    index = F.col("chunk_index").cast("string")
    return pieces.select(
        "content",
        F.create_map(F.lit("source"), F.col("_s"), F.lit("chunk_index"), index).alias("metadata"),
        F.concat(F.col("_s"), F.lit("_"), index).alias("doc_id"),
    )


def union_sources(*chunk_tables: DataFrame) -> DataFrame:
    out = chunk_tables[0]
    for more in chunk_tables[1:]:
        out = out.unionByName(more)
    return out


def vocabulary(
    df: DataFrame, content: str, max_features: int = 1000, stop_words: list[str] | None = None
) -> DataFrame:
    """Most frequent terms with document frequency and idf, most frequent first.

    Texts are read once; only terms that can be among the most frequent are added up over
    the corpus (``plans.frequent``).
    """
    texts = df.filter(F.col(content).isNotNull())
    occurrences = texts.select(F.monotonically_increasing_id().alias("doc"), tx.kept_words(F.col(content), stop_words).alias("term"))
    total = texts.agg(F.count(F.lit(1))).scalar()
    return frequent.most_frequent(occurrences, max_features, pairs=True).withColumn("idf", F.log((total + 1) / (F.col("df") + 1)) + 1)


def term_counts(df: DataFrame, content: str, key: str) -> DataFrame:
    """How often every term occurs and in how many documents: term, corpus_tf, df.

    A document that is one row is counted where it is read, and only the counts of many documents
    together are shuffled. Rows that share a key, null included, are one document; they meet by key and term.
    """
    own = df.select(F.col(key).alias("_k"), F.col(content).alias("_c"))
    shared = cut_lineage(own.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("_k").alias("_s")), "shared-keys")
    if shared.count() <= frequent.SENT_TERMS:
        shared = F.broadcast(shared)  # so that texts stay where they are read
    same = F.col("_k").eqNullSafe(F.col("_s"))
    alone = own.join(shared, same, "left_anti").where("_c is not null")
    rows = alone.select(F.monotonically_increasing_id().alias("doc"), tx.kept_words(F.col("_c")).alias("term"))
    single = frequent.local_lists(rows, 1, pairs=True).where("term is not null").select("term", "tf", "df")
    spread = own.join(shared, same, "left_semi").select("_k", F.explode(tx.terms(F.col("_c"))).alias("term"))
    merged = spread.groupBy("_k", "term").agg(F.count(F.lit(1)).alias("tf")).select("term", "tf", F.lit(1).cast("long").alias("df"))
    return single.unionByName(merged).groupBy("term").agg(F.sum("tf").alias("corpus_tf"), F.sum("df").alias("df"))


@dataclass
class TfidfModel:
    """A fitted vocabulary; encoding is row-local and shuffles nothing."""

    terms: list[str]
    idf: list[float]
    stop_words: list[str] | None = None

    @classmethod
    def fit(
        cls, df: DataFrame, content: str, max_features: int = 1000, stop_words: list[str] | None = None
    ) -> "TfidfModel":
        # At most max_features rows.
        rows = vocabulary(df, content, max_features, stop_words).collect()
        rows = sorted(rows, key=lambda r: (-r["corpus_tf"], r["term"]))
        return cls([r["term"] for r in rows], [r["idf"] for r in rows], stop_words)

    def encode(self, df: DataFrame, content: str, name: str = "vector") -> DataFrame:
        """Append the length-normalised TF-IDF vector (sparse)."""
        listed = df.withColumn("_t", tx.terms(F.coalesce(F.col(content), F.lit("")), self.stop_words))
        counter = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_t", outputCol="_tf")
        weight = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_w")
        unit = Normalizer(p=2.0, inputCol="_w", outputCol=name)
        return unit.transform(weight.transform(counter.transform(listed))).drop("_t", "_tf", "_w")

    def weights(self, df: DataFrame, content: str, key: str) -> DataFrame:
        """Long form (key, term, weight) of the encoded table."""
        coded = self._sparse(df, content, F.col(key))
        names = F.array(*[F.lit(t) for t in self.terms])
        pairs = F.zip_with("at", "vector", lambda i, w: F.struct(F.get(names, i).alias("term"), w.alias("weight")))
        return coded.select(key, F.inline(pairs))

    def search(
        self,
        queries: DataFrame,
        query_key: str,
        query_text: str,
        documents: DataFrame,
        key: str,
        content: str,
        k: int = 5,
        vector: str | None = None,
    ) -> DataFrame:
        """Best ``k`` documents of every query by cosine.

        ``vector`` names stored vectors of the documents, which are then not
        computed again.
        """
        q = self._sparse(queries, query_text, F.col(query_key).alias("probe_id"))
        d = self._sparse(documents, content, F.col(key).alias("match_id"), vector)
        return postings.top_k(q, d, k)

    def _sparse(self, df: DataFrame, content: str, key: Column, vector: str | None = None) -> DataFrame:
        coded = df if vector else self.encode(df, content, "_vector")
        parts = F.unwrap_udt(vector or "_vector")
        return coded.select(key, parts["indices"].alias("at"), parts["values"].alias("vector"))


def vector_search(queries: DataFrame, documents: DataFrame, k: int = 5) -> DataFrame:
    """Exact cosine top-k of (probe_id, vector) among (match_id, vector)."""
    return nearest.top_k(queries, documents, k)


def save_store(chunks: DataFrame, path: str) -> None:
    """Write chunks with their vectors as one table."""
    chunks.write.mode("overwrite").parquet(path)


def load_store(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def assemble_context(hits: DataFrame, query: str = "probe_id") -> DataFrame:
    """One row per query: context text in rank order and its source list.

    ``hits`` has (query, rank, score, source, content); a query has at most k.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "source", "score", "content")))
    block = lambda h: F.concat(F.lit("[Source: "), h["source"], F.lit("]\n"), h["content"])
    entry = lambda h: F.struct(
        h["source"].alias("source"),
        h["score"].alias("score"),
        rules.preview(h["content"]).alias("content_preview"),
    )
    return (
        hits.groupBy(query)
        .agg(ordered.alias("_h"))
        .select(
            query,
            F.array_join(F.transform("_h", block), "\n\n---\n\n").alias("context"),
            F.transform("_h", entry).alias("sources"),
            F.size("_h").alias("num_sources"),
        )
    )


def metadata_text(df: DataFrame) -> DataFrame:
    """Dataset metadata records as text."""
    body = tx.record_lines(
        None,
        [
            ("Dataset", F.col("source_file")),
            ("Total traces", F.col("total_traces")),
            ("Sampled traces", F.col("sampled_traces")),
            ("Samples per trace", F.col("samples_per_trace")),
            ("Sample rate", F.concat(tx.known(F.col("sample_rate_ms")), F.lit(" ms"))),
        ],
    )
    classes = tx.map_lines("Class Distribution:", F.col("class_distribution"))
    return df.select(F.lit("dataset_metadata").alias("source"), F.concat_ws("\n", body, classes).alias("content"))


def validation_text(df: DataFrame) -> DataFrame:
    """Validation result rows as text."""
    body = tx.record_lines(
        "Data Validation Results:",
        [
            ("Total traces", F.col("total_traces")),
            ("Total files", F.col("total_files")),
            ("Validation passed", F.col("validation_passed")),
            ("Sample rate consistent", F.col("sample_rate_consistency")),
            ("Num samples consistent", F.col("num_samples_consistency")),
        ],
    )
    found = F.concat_ws(
        "\n", F.lit("\nAnomalies detected:"), F.transform("anomalies", lambda a: F.concat(F.lit("  - "), a))
    )
    anomalies = F.when(F.size("anomalies") > 0, found).otherwise("\nNo anomalies detected.")
    classes = [tx.map_lines("\nClass Distribution:", F.col("class_counts"))] if "class_counts" in df.columns else []
    return df.select(F.lit("validation_results").alias("source"), F.concat_ws("\n", body, *classes, anomalies).alias("content"))


def feature_summary_text(summary: DataFrame, samples: int | None = None) -> DataFrame:
    """A feature summary table as one text: counts, then every feature with its range."""
    names = F.array_join(F.array_sort(F.collect_list("column_name")), ", ")
    body = F.concat_ws(
        "\n",
        F.lit("Feature Engineering Summary:"),
        F.concat(F.lit("Total features: "), F.count(F.lit(1)).cast("string")),
        F.concat(F.lit("Samples: "), tx.known(F.lit(samples))),
        F.concat(F.lit("Feature names: "), names),
    )
    return summary.agg(body.alias("content")).select(F.lit("feature_summary").alias("source"), "content")


def knowledge_table(
    *texts: DataFrame, model: TfidfModel | None = None, max_features: int = 1000, store: bool = True, **options
) -> tuple[DataFrame, TfidfModel]:
    """Chunk every (source, content) table, union them and encode: (table, model).

    The chunks are stored before the two passes over them (fit, encode), so the
    texts are cut once.
    """
    chunks = union_sources(*[chunk_documents(t, "content", "source", **options) for t in texts])
    if store:
        chunks = cut_lineage(chunks, "chunks")
    model = model or TfidfModel.fit(chunks, "content", max_features)
    return model.encode(chunks, "content"), model
