"""Registered queries of the corpus operators, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from traceframe.llm import centroids, decontaminate, infill, langid, linededup, neardup, packing, pii, sharding, substring, tokenbin, topk, toxicity
from traceframe.llm.common import split_mod, table
from traceframe.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in sequences of 4096 words: no two of a source or of a group of copies together."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(split_mod("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs.where(~held), table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, model).select(
        "doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), F.col("is_toxic").cast("int").alias("predicted")
    )


@query(
    "op3_suffix_dedup",
    """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49))) AS i FROM d)),
    m AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s),
    f AS (SELECT doc_id, i FROM w JOIN m USING (s) WHERE low < doc_id),
    g AS (SELECT doc_id, i, i - 50 > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) AS fresh FROM f),
    n AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g),
    r AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY doc_id, span),
    e AS (SELECT doc_id, a, b, lag(b) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
    k AS (SELECT e.doc_id, string_agg(substr(h, 2 * coalesce(before, 0) + 1, 2 * (a - coalesce(before, 0))), '' ORDER BY a) AS kept,
            max(b) AS last, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM e JOIN d USING (doc_id) GROUP BY e.doc_id)
    SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
      sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("starts", "ends")


@query(
    "op4_exact_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS g FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.g, c.g), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
    SELECT * FROM r WHERE rank <= 5
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@query("op5_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(split_mod("doc_id", 5) == 0, F.lit(False))
    net = langid.fit(docs.where(~held))
    return langid.language(docs, net).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op6_token_ids")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    tokenbin.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenbin.read(spark, path).drop("ids")


@query(
    "op7_benchmark_decontamination",
    r"""
    WITH fold AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    win AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)),
    lens AS (SELECT DISTINCT n FROM win),
    occ AS (
      SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
      FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM fold, lens WHERE len(w) >= n)),
    hit AS (SELECT o.doc_id, o.i, o.n, w.item_id FROM occ o JOIN win w USING (n, s)),
    pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
    SELECT f.doc_id, len(f.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM fold f LEFT JOIN pos USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query(
    "op8_personal_data",
    r"""
    WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    cut AS (
      SELECT doc_id, kind, rank, m, p FROM (
        SELECT doc_id, 'email' AS kind, 0 AS rank, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS m, string_split_regex(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS p FROM doc
        UNION ALL SELECT doc_id, 'ip', 1, regexp_extract_all(t, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'), string_split_regex(t, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') FROM doc
        UNION ALL SELECT doc_id, 'card', 2, regexp_extract_all(t, '[0-9](?:[\x20-]?[0-9])+'), string_split_regex(t, '[0-9](?:[\x20-]?[0-9])+') FROM doc
        UNION ALL SELECT doc_id, 'phone', 3, regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), string_split_regex(t, '\+[0-9][\x20().0-9-]+[0-9]') FROM doc)
      WHERE len(m) > 0),
    each_one AS (SELECT doc_id, kind, rank, unnest(generate_series(1, len(m))) AS i, m, p FROM cut),
    span AS (
      SELECT doc_id, kind, rank, m[i] AS s,
        (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))::BIGINT AS a FROM each_one),
    digits AS (SELECT *, regexp_replace(s, '[^0-9]', '', 'g') AS d FROM span),
    ok AS (
      SELECT doc_id, kind, rank, a, a + length(s) AS b FROM digits WHERE CASE kind
        WHEN 'email' THEN true
        WHEN 'ip' THEN len(list_filter(string_split(s, '.'), lambda x: x::HUGEINT > 255)) = 0
        WHEN 'phone' THEN length(d) BETWEEN 10 AND 15
        ELSE length(d) BETWEEN 14 AND 19 AND
          list_sum(list_transform(range(length(d)), lambda k: CASE WHEN k % 2 = 0 THEN d[length(d) - k]::INT ELSE (d[length(d) - k]::INT * 2) // 10 + (d[length(d) - k]::INT * 2) % 10 END)) % 10 = 0 END),
    per AS (
      SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
        count(*) FILTER (kind = 'phone') AS n_phone, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans FROM ok GROUP BY doc_id)
    SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card,
      coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM doc LEFT JOIN per USING (doc_id)
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    count = lambda kind: F.size(pii.of_kinds(F.col("pii"), kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.listed(pii.of_kinds(F.col("pii"), *pii.BASE)), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans"),
    )


@query(
    "op9_minhash_near_duplicates",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    sh AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') AS s
           FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept FROM comp c LEFT JOIN n USING (doc_id)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query(
    "op10_extendible_sharding",
    """
    WITH d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
    p AS (SELECT doc_id, h, n_bytes, depth, h >> (60 - depth) AS top FROM d, (SELECT unnest(generate_series(0, 60)) AS depth)),
    s AS (SELECT depth, top, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY ALL),
    fit AS (SELECT p.doc_id, p.n_bytes, p.h, min(p.depth) AS shard_depth FROM p JOIN s USING (depth, top) WHERE s.shard_bytes <= 1048576 OR depth = 60 GROUP BY ALL)
    SELECT f.doc_id, f.n_bytes, CASE WHEN shard_depth = 0 THEN '' ELSE lpad(bin(f.h >> (60 - shard_depth)), shard_depth::INT, '0') END AS shard,
      shard_depth::INT AS shard_depth, s.shard_bytes, s.shard_rows, s.shard_bytes <= 1048576 AS fits
    FROM fit f JOIN s ON s.depth = f.shard_depth AND s.top = f.h >> (60 - shard_depth)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sharding.shard(docs, size=F.col("n_bytes"))


def _lloyd_sql(k: int, rounds: int) -> str:
    """The rounds of centroid clustering, one pair of common table expressions each."""
    def near(centroids: str) -> str:
        return f"""(
      SELECT vec_id, g, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
        SELECT vec_id, g, j, list_sum(list_transform(list_zip(g, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, {centroids})
      GROUP BY vec_id, g)"""

    steps = [
        f"""a{i} AS MATERIALIZED {near(f"c{i}")},
    m{i} AS (SELECT j, pos, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (SELECT j, unnest(g) AS x, unnest(range(1, 65)) AS pos FROM a{i}) GROUP BY j, pos),
    u{i} AS (SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS c FROM m{i} GROUP BY j),
    c{i + 1} AS MATERIALIZED (SELECT o.j, coalesce(u.c, o.c) AS c FROM c{i} o LEFT JOIN u{i} u USING (j))"""
        for i in range(rounds)
    ]
    return f"""
    WITH v AS MATERIALIZED (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS g FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (
      SELECT (row_number() OVER (ORDER BY h))::INT - 1 AS j, g AS c FROM (SELECT g, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h LIMIT {k})),
    {", ".join(steps)},
    z AS MATERIALIZED {near(f"c{rounds}")}
    SELECT vec_id, j::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
      sha256(array_to_string(c, ',')) AS centroid_sha256 FROM z JOIN c{rounds} USING (j)
    """


@query("op11_centroid_clustering", _lloyd_sql(40, 5))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2))


@query(
    "op12_line_dedup",
    r"""
    WITH l AS (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
    k AS (SELECT doc_id, i, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT k.doc_id, i, line, f.key IS NOT NULL AND k.doc_id < f.last AS gone FROM k LEFT JOIN f USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op13_fill_in_middle",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    u AS (SELECT doc_id, t, regexp_extract_all(t, '[^
]*
|[^
]+') AS u, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT for i in range(4)] AS h FROM d),
    c AS (SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, coalesce(array_to_string(u[1 : a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1 : b], ''), '') AS middle, coalesce(array_to_string(u[b + 1 : n], ''), '') AS suffix FROM c)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
      sha256(t) AS restored_sha256 FROM p
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=7, percent=100, spm_percent=50)
    restored = infill.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))
