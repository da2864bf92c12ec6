"""Each stage of the pipeline keeps what a plain loop keeps, on a small table with awkward rows."""

import re
from collections import Counter

import corpus_pipeline
import pytest

from traceframe.llm import pii, toxicity
from traceframe.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, __key long, n int, pii string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, n=5):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def rows(spark):
    item = table(spark, SF, "benchmark").orderBy("item_id").first().text
    base = [f"token{i}" for i in range(150)]
    near = [*base[:70], "changed", *base[71:]]
    texts = [
        (1, "a clean text about the sea and the harbour at night"), (2, "a clean text about the sea and the harbour at night"), (2, "another text that shares its id only"),
        (2, "another text that shares its id only"), (3, " ".join(base)), (4, " ".join(near)), (4, "free of all that, under a used id"), (5, f"before it {item} and after it"),
        (5, "the same id without the passage"), (6, None), (7, ""), (6, None), (8, "  \n "), (9, "write to someone@example.org or call +49 30 1234567 today"), (None, " ".join(base)), (None, None),
        (10, " ".join(f"long{i % 5003} y{i}" for i in range(40_000))), (11, "x"),
    ]
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or ""), "clash", 5, 1, "clash") for k, (i, t) in enumerate(texts)], SCHEMA).repartition(3)


def bag(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


@pytest.fixture(scope="module")
def docs(spark):
    return rows(spark).cache()


def test_toxicity_stage(spark, docs):
    from pyspark.sql import functions as F

    from traceframe.llm.common import split_mod

    known = table(spark, SF, "documents").select(*[F.col(c) if c in ("doc_id", "text", "lang", "source", "n_chars") else F.lit(None).alias(c) for c in ("doc_id", "text", "lang", "source", "n_chars")])
    both = known.unionByName(docs.select(known.columns))
    out = corpus_pipeline.toxic(spark, both, SF)
    held = F.coalesce(split_mod("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit(both.where(~held).select("doc_id", "text"), table(spark, SF, "labels"))
    want = Counter()
    for r in both.collect():
        ids = {w: i for i, w in enumerate(dict.fromkeys(toxicity.words(r.text or "")))}
        order = [ids[w] for w in toxicity.words(r.text or "")]
        values = model.word_values(list(ids))
        worst = None
        for a in toxicity.window_starts(len(order)).tolist():
            window = order[a : a + toxicity.WINDOW]
            # A word counts unless it is among the WINDOW words before it.
            total = sum(values[w] for i, w in enumerate(window, a) if w not in order[max(0, i - toxicity.WINDOW + 1) : i])
            mean = total / len(window) if window else 0.0
            worst = mean if worst is None else max(worst, mean)
        score = 1 / (1 + pow(2.718281828459045, -(model.slope * (model.bias + toxicity.SCALE * worst) + model.shift))) if model.constant is None else model.constant
        assert abs(score - 0.7) > 1e-6
        if score < 0.7:
            want[r.doc_id, r.text] += 1
    assert bag(out) == want and out.columns == known.columns
    assert corpus_pipeline.toxic(spark, both.limit(0), SF).count() == 0


def test_near_duplicate_stage(spark, docs):
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    # Different texts under one id are documents; the smallest id of linked ones stays, copies in both fall together.
    distinct = sorted({(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None}, key=lambda x: (x[0], x[1] or ""))
    linked = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)
    sets = [shingles(t) for _, t in distinct]
    group = list(range(len(distinct)))
    for _ in distinct:
        for i in range(len(distinct)):
            for j in range(len(distinct)):
                if linked(sets[i], sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    nameless = Counter((r.doc_id, r.text) for r in docs.collect() if r.doc_id is None)
    got = bag(out)
    assert sum(got.values()) == len(set(group)) + sum(nameless.values())
    kept_ids = Counter(i for i, _ in got if i is not None)
    assert kept_ids == Counter(min(distinct[j][0] for j in range(len(distinct)) if group[j] == g) for g in set(group))
    assert all(got[k] == n for k, n in nameless.items()) and got[2, "another text that shares its id only"] == 1 and got[4, "free of all that, under a used id"] == 1
    unique = docs.where("doc_id in (1, 3, 8, 9, 10)")
    assert bag(corpus_pipeline.near_duplicates(spark, unique, SF)) == bag(unique)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_decontamination_stage(spark, docs):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = fold(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def hit(text):
        w = fold(text)
        return any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    out = corpus_pipeline.benchmark_items(spark, docs, SF)
    assert bag(out) == Counter((r.doc_id, r.text) for r in docs.collect() if not hit(r.text))
    assert (5, "the same id without the passage") in bag(out) and out.columns == docs.columns
    assert corpus_pipeline.benchmark_items(spark, docs.limit(0), SF).count() == 0


def test_personal_data_stage(spark, docs):
    out = corpus_pipeline.personal_data(spark, docs, SF)
    got = {(r.doc_id, r.text): r.n_chars for r in out.collect()}
    assert got[9, "write to <EMAIL> or call <PHONE> today"] == 38
    spans = {(r.doc_id, r.text): r.pii for r in pii.find(docs.drop("pii")).collect()}
    assert {k for k in got} - {(9, "write to <EMAIL> or call <PHONE> today")} == {k for k, s in spans.items() if not s}
    assert out.columns == docs.columns


def test_packing_stage(spark, docs):
    out = corpus_pipeline.packed(spark, docs, SF)
    placed = Counter()
    for r in out.collect():
        placed[r.doc_id] += r.n_words
    want = Counter()
    for r in docs.collect():
        want[r.doc_id] += len((r.text or "").split())
    assert +placed == +want and set(placed) == set(want)
