from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from traceframe.checks.registry import query, rounded
from traceframe.functions import signal, text as tx
from traceframe.operators import quality, retrieval as rt
from traceframe.plans import nearest
from traceframe.session import shared_folder
from traceframe.sources import roles

# The chunk rule as a recursion over (document, start) follows.


def _last(sep: str) -> str:
    """0-based position of the last separator in the window, or -1."""
    literal = "'" + sep.replace("\n", "' || chr(10) || '") + "'"
    return (
        f"(CASE WHEN contains(win, {literal}) THEN length(win) - strpos(reverse(win), reverse({literal})) "
        f"- length({literal}) + 1 ELSE -1 END)"
    )


def _cut(start: str, n: str) -> str:
    whens = " ".join(f"WHEN {_last(s)} > 250 THEN {_last(s)} + {len(s)}" for s in tx.SEPARATORS)
    return f"(CASE WHEN {start} + 499 >= {n} THEN 500 {whens} ELSE 500 END)"


_WALK_SQL = (
    "WITH RECURSIVE texts AS (SELECT doc_id, text, length(text) AS n FROM documents),\n"
    "walk(doc_id, i, piece, next) AS (\n"
    f"  SELECT doc_id, 0, substring(text, 1, cut), 1 + cut - 50 FROM (SELECT doc_id, text, {_cut('1', 'n')} AS cut\n"
    "    FROM (SELECT *, substring(text, 1, 500) AS win FROM texts))\n"
    "  UNION ALL\n"
    "  SELECT doc_id, i + 1, substring(win, 1, cut), start + cut - 50 FROM (SELECT doc_id, i, start, win,\n"
    f"    {_cut('start', 'n')} AS cut FROM (SELECT w.doc_id, w.i, w.next AS start, t.n, substring(t.text, w.next, 500) AS win\n"
    "      FROM walk w JOIN texts t ON t.doc_id = w.doc_id WHERE t.n > 500 AND w.next <= t.n))),\n"
    "cleaned AS (SELECT w.doc_id, i, CASE WHEN t.n <= 500 THEN t.text\n"
    "  ELSE trim(piece, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) END AS content\n"
    "  FROM walk w JOIN texts t ON t.doc_id = w.doc_id),\n"
    "chunks AS (SELECT doc_id AS source, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_index, content\n"
    "  FROM cleaned WHERE content <> '' OR (SELECT n FROM texts t WHERE t.doc_id = cleaned.doc_id) <= 500)"
)


def _chunks(spark, sf, **options):
    return rt.chunk_documents(roles.documents(spark, sf), "text", "doc_id", **options)


@query(
    "text_chunks",
    _WALK_SQL + "\nSELECT source || '_' || chunk_index AS chunk_id, CAST(source AS VARCHAR) AS source, "
    "CAST(chunk_index AS VARCHAR) AS chunk_index, content FROM chunks",
)
def text_chunks(spark, sf):
    return _chunks(spark, sf).select(
        F.col("doc_id").alias("chunk_id"),
        F.col("metadata")["source"].alias("source"),
        F.col("metadata")["chunk_index"].alias("chunk_index"),
        "content",
    )


@query(
    "text_chunks_without_contained_tail",
    _WALK_SQL
    + ",\ntails AS (SELECT *, lag(content) OVER w AS before, lead(content) OVER w IS NULL AS is_last FROM chunks\n"
    "  WINDOW w AS (PARTITION BY source ORDER BY chunk_index))\n"
    "SELECT source || '_' || chunk_index AS chunk_id, content FROM tails\n"
    "WHERE NOT (is_last AND before IS NOT NULL AND ends_with(before, content))",
)
def text_chunks_without_contained_tail(spark, sf):
    return _chunks(spark, sf, drop_contained_tail=True).select(F.col("doc_id").alias("chunk_id"), "content")


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + "]"


def terms_sql(source: str, key: str) -> str:
    """Terms of every text: words without stop words, then neighbouring pairs."""
    return f"""kept AS (SELECT {key} AS k, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
  lambda w: NOT list_contains({STOP_SQL}, w)) AS w FROM {source}),
terms AS (SELECT k, unnest(list_concat(w, list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda p: p[1] || ' ' || p[2]))) AS term FROM kept)"""


@query(
    "document_terms",
    f"WITH {terms_sql('documents', 'doc_id')}\nSELECT term, count(*) AS corpus_tf, count(DISTINCT k) AS df FROM terms GROUP BY term",
)
def document_terms(spark, sf):
    return rt.term_counts(roles.documents(spark, sf), "text", "doc_id")


_VOCAB_SQL = f"""{terms_sql('documents', 'doc_id')},
vocab AS (SELECT term, count(*) AS corpus_tf, count(DISTINCT k) AS df, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(DISTINCT k))) + 1 AS idf
  FROM terms GROUP BY term ORDER BY corpus_tf DESC, term LIMIT 1000)"""


@query("tfidf_vocabulary", f"WITH {_VOCAB_SQL}\nSELECT term, corpus_tf, df, round(idf, 6) AS idf FROM vocab")
def tfidf_vocabulary(spark, sf):
    return rounded(rt.vocabulary(roles.documents(spark, sf), "text"))


_WEIGHTS_SQL = """{name} AS (SELECT k, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY k)) AS weight
  FROM (SELECT t.k, t.term, count(*) AS tf, any_value(v.idf) AS idf FROM {terms} t JOIN vocab v ON v.term = t.term GROUP BY t.k, t.term))"""


@query(
    "tfidf_weights",
    f"WITH {_VOCAB_SQL}, {_WEIGHTS_SQL.format(name='weights', terms='terms')}\nSELECT k AS doc_id, term, round(weight, 6) AS weight FROM weights",
)
def tfidf_weights(spark, sf):
    docs = roles.documents(spark, sf)
    return rounded(rt.TfidfModel.fit(docs, "text").weights(docs, "text", "doc_id"))


def _query_terms() -> str:
    return terms_sql("benchmark", "item_id").replace("kept AS", "qkept AS").replace("terms AS", "qterms AS").replace("FROM kept", "FROM qkept")


_HITS_SQL = f"""{_VOCAB_SQL}, {_query_terms()},
{_WEIGHTS_SQL.format(name='dw', terms='terms')}, {_WEIGHTS_SQL.format(name='qw', terms='qterms')},
pairs AS (SELECT q.k AS item_id, d.k AS doc_id, sum(q.weight * d.weight) AS score FROM qw q JOIN dw d ON d.term = q.term GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM pairs),
hits AS (SELECT * FROM ranked WHERE rank <= 5)"""


def _hits(spark, sf):
    docs = roles.documents(spark, sf)
    model = rt.TfidfModel.fit(docs, "text")
    return model.search(roles.table(spark, sf, "benchmark"), "item_id", "text", docs, "doc_id", "text", k=5)


@query(
    "tfidf_search",
    f"WITH {_HITS_SQL}\nSELECT item_id, rank, doc_id, round(score, 5) AS score FROM hits",
)
def tfidf_search(spark, sf):
    return rounded(
        _hits(spark, sf).select(F.col("probe_id").alias("item_id"), F.col("rank").cast("long").alias("rank"), F.col("match_id").alias("doc_id"), "score"), 5
    )


@query(
    "retrieval_context",
    f"""WITH {_HITS_SQL}
SELECT item_id, string_agg('[Source: ' || d.source || ']' || chr(10) || d.text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context,
  string_agg(d.source, ',' ORDER BY rank) AS sources, count(*) AS num_sources,
  arg_min(CASE WHEN length(d.text) > 200 THEN substring(d.text, 1, 200) || '...' ELSE d.text END, rank) AS first_preview
FROM hits JOIN documents d ON d.doc_id = hits.doc_id GROUP BY item_id""",
)
def retrieval_context(spark, sf):
    docs = roles.documents(spark, sf).select(F.col("doc_id").alias("match_id"), "source", F.col("text").alias("content"))
    out = rt.assemble_context(_hits(spark, sf).join(docs, "match_id"))
    return out.select(
        F.col("probe_id").alias("item_id"),
        "context",
        F.array_join(F.transform("sources", lambda s: s["source"]), ",").alias("sources"),
        F.col("num_sources").cast("long").alias("num_sources"),
        F.element_at("sources", 1)["content_preview"].alias("first_preview"),
    )


def _vectors(spark, sf, key):
    return roles.table(spark, sf, "embeddings").select(F.col("vec_id").alias(key), F.col("embedding").cast("array<double>").alias("vector"))


_COSINE_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
n AS (SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda a: a * a))) AS s FROM v),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id AS match_id, list_dot_product(a.x, b.x) / (a.s * b.s) AS score FROM n a, n b),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, match_id) AS rank FROM pairs)
SELECT query_id, match_id, rank, round(score, 6) AS score FROM r WHERE rank <= 5"""


def _named(df):
    return rounded(df.select(F.col("probe_id").alias("query_id"), "match_id", F.col("rank").cast("long").alias("rank"), "score"))


@query("vector_search", _COSINE_SQL)
def vector_search(spark, sf):
    return _named(rt.vector_search(_vectors(spark, sf, "probe_id"), _vectors(spark, sf, "match_id")))


@query("vector_search_in_blocks", _COSINE_SQL)
def vector_search_in_blocks(spark, sf):
    """With few pivots: large cells, most of them visited by every probe."""
    return _named(nearest.top_k(_vectors(spark, sf, "probe_id"), _vectors(spark, sf, "match_id"), 5, pivots=4))


@query(
    "neighbour_cosine",
    """SELECT a.vec_id, round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) /
  (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) *
   sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))), 6) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def neighbour_cosine(spark, sf):
    a = _vectors(spark, sf, "vec_id")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vector").alias("other"))
    return rounded(a.join(b, "vec_id").select("vec_id", signal.cosine(F.col("vector"), F.col("other")).alias("score")))


@query(
    "vector_store_round_trip",
    f"WITH {_VOCAB_SQL}, {_WEIGHTS_SQL.format(name='weights', terms='terms')}\n"
    "SELECT d.doc_id, d.source, round(coalesce(sum(weight), 0), 5) AS weight_sum, count(weight) AS num_terms FROM documents d LEFT JOIN weights w ON w.k = d.doc_id GROUP BY 1, 2",
)
def vector_store_round_trip(spark, sf):
    path = shared_folder(spark, "store")
    docs = roles.documents(spark, sf)
    rt.save_store(rt.TfidfModel.fit(docs, "text").encode(docs, "text"), path)
    v = vector_to_array("vector")
    stored = rt.load_store(spark, path)
    return rounded(
        stored.select(
            "doc_id",
            "source",
            signal.total(v).alias("weight_sum"),
            F.size(F.filter(v, lambda x: x > 0)).cast("long").alias("num_terms"),
        ),
        5,
    )


@query("knowledge_table")
def knowledge_table(spark, sf):
    """Chunks of documents, conversations, a validation record and a feature summary in one encoded table."""
    docs = roles.documents(spark, sf).select(F.concat(F.lit("doc"), "doc_id").alias("source"), F.col("text").alias("content"))
    talks = roles.documents(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("talk"), "conv_id", "turn").alias("source"), F.col("text").alias("content")
    )
    traces = roles.traces(spark, sf)
    summary = quality.column_summary(traces, ["num_samples", "sample_rate", "inline", "crossline"])
    table, _ = rt.knowledge_table(
        docs, talks, rt.validation_text(quality.validation(traces)), rt.feature_summary_text(summary)
    )
    v = vector_to_array("vector")
    return rounded(
        table.select("doc_id", F.length("content").alias("chars"), F.size(F.filter(v, lambda x: x > 0)).alias("num_terms"), signal.total(v).alias("weight_sum")),
        5,
    )
