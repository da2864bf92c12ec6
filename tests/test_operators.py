"""Operators against brute force on small fixtures, skew included."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from traceframe.functions import signal, text as tx
from traceframe.operators import (
    audit,
    distribution,
    drift,
    evaluation as ev,
    features as ft,
    featureviews as fv,
    imputation,
    quality,
    registry as reg,
    sampling,
)
from traceframe.plans import cells, nearest, postings, ranking
from traceframe.schemas import EMBEDDINGS, HANDCRAFTED

RNG = np.random.default_rng(7)


def _numbers(spark, values, name="v"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


# --- signal ---------------------------------------------------------------


def test_signal_features_against_numpy(spark):
    xs = [RNG.normal(size=n).tolist() for n in (1, 2, 3, 4, 16, 33)] + [[1.0] * 8, [0.0, -0.0, 1.0, -1.0]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, trace_data array<double>")
    rows = {r.i: r for r in signal.handcrafted(df).collect()}
    for i, x in enumerate(xs):
        a, r = np.array(x), rows[i]
        power = np.abs(np.fft.fft(a)) ** 2
        inner = power[1 : len(a) // 2]
        peak = (np.argmax(inner) + 1) / len(a) if len(inner) else 0.0
        expected = [a.mean(), a.std(), a.min(), a.max(), np.sqrt((a**2).mean()), (a**2).sum(), np.sum(np.diff(a < 0)), peak]
        assert [r[c] for c in HANDCRAFTED] == pytest.approx([float(v) for v in expected], abs=1e-9), x


def test_missing_trace_gives_nulls(spark):
    df = spark.createDataFrame([(None,)], "trace_data array<double>")
    r = signal.handcrafted(df).first()
    assert r.mean_amplitude is None and r.rms_amplitude is None and r.min_amplitude is None


def test_fit_length_and_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "x array<double>")
    got = df.select(signal.fit_length(F.col("x"), 3), signal.fit_length(F.col("x"), 1), signal.l2_normalise(F.col("x"))).collect()
    assert [list(v) for v in got[0]] == [[3.0, 4.0, 0.0], [3.0], [0.6, 0.8]]
    assert list(got[1][2]) == [0.0, 0.0]


# --- ranks, halves, medians ------------------------------------------------


def test_hash_rank_is_a_permutation_per_group(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 600, "hot").otherwise("cold").alias("g"))
    out = ranking.hash_rank(df, ["id"], "s", by=["g"], name="r", total="n").toPandas()
    for g, n in (("hot", 600), ("cold", 400)):
        part = out[out.g == g]
        assert sorted(part.r) == list(range(1, n + 1))
        assert set(part.n) == {n}


def test_sample_size_and_ids(spark):
    df = spark.range(500)
    got = sampling.sample_rows(df, 37, ["id"], "1").toPandas()
    assert sorted(got.sample_id) == list(range(37)) and got.id.nunique() == 37
    again = sampling.sample_rows(df.repartition(13), 37, ["id"], "1").toPandas()
    assert set(again.id) == set(got.id)
    assert sampling.sample_rows(df, 9999, ["id"]).count() == 500


@pytest.mark.parametrize("n", [2, 3, 10, 101])
def test_halves(spark, n):
    df = spark.range(n).select((F.col("id") * F.col("id")).alias("k"))
    got = {r.k: r.side for r in sampling.halves(df, "k").collect()}
    expected = {i * i: "reference" if i < n // 2 else "current" for i in range(n)}
    assert got == expected


def test_ordered_rank_with_time(spark):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=i**2),) for i in range(200)]
    df = spark.createDataFrame(rows, "t timestamp").repartition(7)
    out = ranking.ordered_rank(df, "t", "r").orderBy("t").toPandas()
    assert out.r.tolist() == list(range(1, 201))


def test_median_with_hot_value_and_nulls(spark):
    values = [5.0] * 300 + RNG.normal(size=301).tolist()
    df = spark.createDataFrame([(v, None if i % 3 else v * 2) for i, v in enumerate(values)], "a double, b double")
    got = {r.column_name: r["median"] for r in ranking.exact_median(df, ["a", "b"]).collect()}
    assert got["a"] == pytest.approx(np.median(values))
    assert got["b"] == pytest.approx(np.median([v * 2 for i, v in enumerate(values) if i % 3 == 0]))


@pytest.mark.parametrize("rows_left", [1, 10, 20_000])
def test_median_by_brackets(spark, rows_left):
    data = {"even": RNG.normal(size=5000), "odd": RNG.normal(size=4999), "hot": np.where(RNG.random(5000) < 0.4, 1.5, RNG.normal(size=5000)), "two": np.repeat([1.0, 2.0], 2500), "one": np.array([7.0]), "large": np.append(RNG.normal(size=20), [np.inf] * 21)}
    rows = [tuple(float(v[i]) if i < len(v) else None for v in data.values()) + (None,) for i in range(5000)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*data, "none"])).repartition(5)
    got = {r.column_name: r["median"] for r in ranking.exact_median(df, [*data, "none"], rows_left).collect()}
    assert got == pytest.approx({c: np.median(v) for c, v in data.items()})
    brackets = ranking.middle_brackets(df, list(data), rows_left)
    if rows_left < 20_000:
        assert max(brackets["even"].inside, brackets["odd"].inside) < 50


def test_largest_gap_by_cells(spark):
    from traceframe.operators import drift
    from traceframe.plans import gaps

    n = 4000
    data = {"smooth": RNG.normal(size=n), "hot": np.where(RNG.random(n) < 0.4, 0.25, RNG.normal(size=n)), "few": RNG.integers(0, 3, n).astype(float), "gap": RNG.normal(size=n)}
    side = RNG.random(n) < 0.4
    data["smooth"][side] += 0.1
    data["gap"][RNG.random(n) < 0.3] = np.nan
    data["one"] = np.where(side, 1.0, np.nan)
    df = spark.createDataFrame([(bool(side[i]), *[float(v[i]) for v in data.values()]) for i in range(n)], "side boolean, " + ", ".join(f"{c} double" for c in data)).repartition(4)
    for buckets in (2, 64, 1000):
        got = {r.feature: (r.ks_statistic, r.n_reference, r.n_current) for r in drift.ks_statistics(df, list(data), F.col("side"), buckets).collect()}
        assert set(got) == set(data) - {"one"}
        for c in got:
            a, b = (np.sort(data[c][s & ~np.isnan(data[c])]) for s in (side, ~side))
            every = np.concatenate([a, b])
            want = np.abs(np.searchsorted(a, every, "right") / len(a) - np.searchsorted(b, every, "right") / len(b)).max()
            assert got[c] == (pytest.approx(want, abs=1e-12), len(a), len(b))
    sides = df.select(F.col("side").alias("_ref"), "smooth")
    _, counts = gaps.cell_counts(sides, ["smooth"], 400)
    assert gaps.open_cells(counts).where("open").count() < 40


def test_nested_rank_of_one_hot_file(spark):
    rows = [("b", i, i % 7) for i in range(400)] + [("a", i, 0) for i in range(3)] + [(None, 5, 1), ("c", None, 1)]
    df = spark.createDataFrame(rows, "file_id string, trace_id int, x int").repartition(6)
    out = ranking.nested_rank(df, ["file_id", "trace_id"], "r", ranges=16)
    got = [(r.file_id, r.trace_id) for r in sorted(out.collect(), key=lambda r: r.r)]
    assert got == sorted([r[:2] for r in rows], key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0))
    assert out.groupBy(F.spark_partition_id()).count().count() > 1
    assert ranking.nested_rank(df.limit(0), ["file_id", "trace_id"]).count() == 0


@pytest.mark.parametrize("buckets", [1, 2, 64, 100, 1000])
def test_bucket_search(spark, buckets):
    cuts = sorted(RNG.normal(size=buckets - 1).round(1).tolist())
    values = RNG.normal(size=50).round(1).tolist() + cuts[:3]
    array = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<double>")
    out = ranking.with_bucket(_numbers(spark, values), array, F.col("v"), buckets).collect()
    assert [r["_b"] for r in out] == [sum(c < v for c in cuts) for v in values]


def test_split_shares_and_folds(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("y"))
    out = sampling.training_assignment(df, "y", ["id"], k=5).toPandas()
    share = out.split.value_counts(normalize=True)
    assert share["test"] == pytest.approx(0.2, abs=0.01) and share["validation"] == pytest.approx(0.16, abs=0.01)
    per_fold = out.groupby(["y", "fold"]).size()
    assert per_fold.max() - per_fold.min() <= 1
    assert (out.weight * 0 + out.weight).sum() == pytest.approx(1000)


# --- drift and AUC ---------------------------------------------------------


def _ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    return max(abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)))


@pytest.mark.parametrize("kind", ["normal", "hot value", "constant", "signed zeros"])
def test_ks_against_brute_force(spark, kind):
    a, b = RNG.normal(size=300), RNG.normal(0.3, size=200)
    if kind == "hot value":
        a[:150], b[:40] = 0.25, 0.25
    if kind == "constant":
        a[:], b[:] = 1.0, 1.0
    if kind == "signed zeros":
        a[:], b[:] = 0.0, -0.0
    rows = [(True, float(v)) for v in a] + [(False, float(v)) for v in b] + [(True, None)]
    df = spark.createDataFrame(rows, "ref boolean, x double")
    r = drift.feature_drift(df, ["x"], F.col("ref"), buckets=8).first()
    assert (r.n_reference, r.n_current) == (300, 200)
    assert r.ks_statistic == pytest.approx(_ks(a, b))


def test_feature_without_values_is_left_out(spark):
    df = spark.createDataFrame([(True, 1.0, None), (False, 2.0, 3.0)], "ref boolean, x double, y double")
    assert [r.feature for r in drift.ks_statistics(df, ["x", "y"], F.col("ref")).collect()] == ["x"]


def test_auc_with_ties_against_pairs(spark):
    y = RNG.integers(0, 3, 120)
    scores = RNG.integers(0, 5, (120, 3)) / 5
    df = spark.createDataFrame([(int(t), *map(float, s)) for t, s in zip(y, scores)], "y int, a double, b double, c double")
    got = {r.class_column: r.auc for r in ev.roc_auc(df, "y", ["a", "b", "c"], buckets=4).collect()}
    for i, c in enumerate("abc"):
        pos, neg = scores[y == i, i], scores[y != i, i]
        wins = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
        assert got[c] == pytest.approx(wins)


def test_auc_of_absent_class_is_left_out(spark):
    df = spark.createDataFrame([(0, 0.2, 0.1), (0, 0.5, 0.3)], "y int, a double, b double")
    per_class = ev.roc_auc(df, "y", ["a", "b"])
    assert per_class.count() == 0
    assert ev.auc_averages(per_class, 2).first().roc_auc_macro is None


# --- nearest ---------------------------------------------------------------


@pytest.mark.parametrize("pivots, block", [(128, 4096), (4, 7), (1, 3)])
def test_top_k_against_numpy(spark, monkeypatch, pivots, block):
    monkeypatch.setattr(cells, "MEMBER_BLOCK", block)
    monkeypatch.setattr(cells, "PROBE_BLOCK", block)
    q, d = RNG.normal(size=(15, 6)), RNG.normal(size=(80, 6))
    d[40:60] = d[0]  # copies: ties go to the smaller id
    probes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "probe_id bigint, vector array<double>")
    docs = spark.createDataFrame([(f"d{i:03d}", v.tolist()) for i, v in enumerate(d)], "match_id string, vector array<double>")
    out = nearest.top_k(probes, docs.repartition(5), 4, pivots=pivots).toPandas()
    scores = (q / np.linalg.norm(q, axis=1)[:, None]) @ (d / np.linalg.norm(d, axis=1)[:, None]).T
    for i in range(len(q)):
        want = sorted(range(len(d)), key=lambda j: (-round(scores[i, j], 12), j))[:4]
        got = out[out.probe_id == i].sort_values("rank").match_id.tolist()
        assert got == [f"d{j:03d}" for j in want]


def test_nearest_imputation_against_loops(spark, monkeypatch):
    x = RNG.integers(0, 20, (40, 3)).astype(float)
    x[RNG.random((40, 3)) < 0.2] = np.nan
    x[0] = [np.nan, np.nan, np.nan]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "k bigint, a double, b double, c double")
    small = imputation.impute_nearest(df, ["a", "b", "c"], "k").orderBy("k").toPandas()[["a", "b", "c"]].to_numpy()
    monkeypatch.setattr(cells, "MEMBER_BLOCK", 3)
    monkeypatch.setattr(cells, "PROBE_BLOCK", 2)
    fine = imputation.impute_nearest(df, ["a", "b", "c"], "k", cell_rows=4).orderBy("k").toPandas()[["a", "b", "c"]].to_numpy()
    want = x.copy()
    for i, j in zip(*np.nonzero(np.isnan(x))):
        found = []
        for o in range(len(x)):
            ok = ~np.isnan(x[i]) & ~np.isnan(x[o])
            if not np.isnan(x[o, j]) and ok.any():
                found.append((np.sqrt(((x[i] - x[o])[ok] ** 2).sum() * 3 / ok.sum()), o))
        best = [o for _, o in sorted(found)[:2]]
        want[i, j] = x[best, j].mean() if best else np.nanmean(x[:, j])
    assert small == pytest.approx(want)
    assert fine == pytest.approx(want)


def test_few_pairs_are_compared(spark):
    x = RNG.normal(size=(4000, 3)) * 50
    x[RNG.random(x.shape) < 0.03] = np.nan
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)], "k bigint, a double, b double, c double")
    found, stored = imputation.nearest_donors(df, ["a", "b", "c"], "k")
    best = {(r.probe_id, r.wanted, r["rank"]): (r.match_id, r.cost) for r in found.collect()}
    for i, j in list(zip(*np.nonzero(np.isnan(x)), strict=True))[::17]:
        d = np.sqrt(np.nansum((x - x[i]) ** 2, axis=1) * 3 / np.maximum(1, (~np.isnan(x - x[i])).sum(axis=1)))
        d[np.isnan(x[:, j]) | np.isnan(x - x[i]).all(axis=1)] = np.inf
        want = sorted(range(len(x)), key=lambda o: (d[o], o))[:2]
        assert [best[i, j, r][0] for r in (1, 2)] == want
        assert [best[i, j, r][1] for r in (1, 2)] == pytest.approx(d[want])
    incomplete = np.isnan(x).any(axis=1).sum()
    assert sum(pairs for pairs, _ in stored.compared) < 0.05 * incomplete * len(x)


def test_top_k_of_odd_vectors(spark):
    kind = "array<double>"
    docs = [("a", [0.0, 0.0]), ("b", [1e300, 0.0]), ("c", [1e-300, 1e-300]), ("d", [-1.0, 0.0]), ("e", None), ("f", [float("nan"), 1.0]), ("g", [1.0]), ("h", [None, 1.0]), ("i", [0.0, 0.0])]
    asks = [(1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [-1.0, -1.0]), (5, [1.0, 2.0, 3.0])]
    out = nearest.top_k(spark.createDataFrame(asks, f"probe_id int, vector {kind}"), spark.createDataFrame(docs, f"match_id string, vector {kind}"), 3)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.probe_id, r["rank"])):
        got.setdefault(r.probe_id, []).append((r.match_id, round(r.score, 6)))
    assert got == {1: [("b", 1.0), ("c", 0.707107), ("a", 0.0)], 2: [("a", 0.0), ("b", 0.0), ("c", 0.0)], 4: [("d", 0.707107), ("a", 0.0), ("i", 0.0)]}
    empty = spark.createDataFrame([], f"match_id string, vector {kind}")
    assert nearest.top_k(spark.createDataFrame(asks, f"probe_id int, vector {kind}"), empty, 3).count() == 0


@pytest.mark.parametrize("champions, salt_rows", [(64, 200_000), (3, 7)])
def test_sparse_top_k_against_loops(spark, monkeypatch, champions, salt_rows):
    monkeypatch.setattr(postings, "CHAMPIONS", champions)
    monkeypatch.setattr(postings, "SALT_ROWS", salt_rows)
    weight = np.array([0.05, 0.2, 1.0, 2.0, 3.0, 4.0])  # the first terms are common and light

    def vectors(n, common):
        out = []
        for _ in range(n):
            at = [t for t in range(6) if RNG.random() < (common if t < 2 else 0.15)]
            out.append((at, [float(weight[t] * RNG.integers(1, 4)) for t in at]))
        return out

    docs, asks = vectors(150, 0.9), [*vectors(12, 0.9), ([], []), ([5], [1.0])]
    docs[40:60] = [docs[0]] * 20
    p = spark.createDataFrame([(i, *v) for i, v in enumerate(asks)], "probe_id int, at array<int>, vector array<double>")
    m = spark.createDataFrame([(f"d{i:03d}", *v) for i, v in enumerate(docs)], "match_id string, at array<int>, vector array<double>")
    got = {}
    for r in sorted(postings.top_k(p, m.repartition(3), 4).collect(), key=lambda r: (r.probe_id, r["rank"])):
        got.setdefault(r.probe_id, []).append((r.match_id, r.score))
    for i, (at, w) in enumerate(asks):
        mine = dict(zip(at, w, strict=True))
        score = [round(sum(mine.get(t, 0.0) * x for t, x in zip(*d, strict=True)), 12) for d in docs]
        want = sorted(range(len(docs)), key=lambda j: (-score[j], j))[:4]
        assert [n for n, _ in got[i]] == [f"d{j:03d}" for j in want]
        assert [s for _, s in got[i]] == pytest.approx([score[j] for j in want])


def test_light_terms_stay_closed(spark):
    rows = [(i, [0, 1], [0.01, 1.0 + i]) if i < 50 else (i, [0], [0.01]) for i in range(500)]
    lists = spark.createDataFrame(rows, "match_id int, at array<int>, vector array<double>")
    asked = spark.createDataFrame([(1, 0, 1.0), (1, 1, 1.0)], "probe_id int, term int, weight double")
    opened = postings.open_terms(asked, *postings.term_facts(postings._postings(lists, "match_id"), 3), 3)
    assert [r.term for r in opened.collect()] == [1]


# --- point-in-time joins ---------------------------------------------------


@pytest.mark.parametrize("hot_rows, sent_keys", [(10, 1000), (10, 1), (10_000, 1000)])
def test_as_of_join_against_loops(spark, monkeypatch, hot_rows, sent_keys):
    monkeypatch.setattr(fv, "SENT_KEYS", sent_keys)
    start = datetime(2024, 1, 1)
    keys = ["hot"] * 60 + ["a", "b"] * 20
    feats = [(k, start + timedelta(minutes=int(RNG.integers(0, 500))), i, float(i)) for i, k in enumerate(keys)]
    asks = [(i, k, start + timedelta(minutes=int(RNG.integers(0, 600)))) for i, k in enumerate(keys + ["none"] * 3)]
    asks += [(1000 + i, "hot", start + timedelta(minutes=250)) for i in range(5)]
    f = spark.createDataFrame(feats, "k string, t timestamp, e bigint, v double")
    s = spark.createDataFrame(asks, "i bigint, k string, t timestamp")
    ttl = timedelta(minutes=90)
    out = fv.as_of_join(s, f, ["k"], "t", ["v"], ttl, tie_break="e", hot_rows=hot_rows, buckets=4)
    got = {r.i: r.v for r in out.collect()}
    for i, k, t in asks:
        seen = [x for x in feats if x[0] == k and t - ttl <= x[1] <= t]
        assert got[i] == (max(seen, key=lambda x: (x[1], x[2]))[3] if seen else None)
    assert len(got) == len(asks)


def test_online_table_merges_in_buckets(spark, tmp_path):
    online = fv.OnlineTable(spark, str(tmp_path / "online"), ["k"], buckets=4)
    frame = lambda rows: spark.createDataFrame(rows, "k long, event_timestamp timestamp, x double")
    day = lambda d: datetime(2024, 1, d)
    with pytest.raises(ValueError):
        online.read()
    assert online.merge(frame([(i, day(5), float(i)) for i in range(20)])) == 1
    assert online.merge(frame([(1, day(6), -1.0), (2, day(4), -2.0), (50, day(1), 50.0)])) == 2
    (tmp_path / "online" / "version-3").mkdir()  # a merge that was cut short
    again = fv.OnlineTable(spark, str(tmp_path / "online"), ["k"], buckets=4)
    found = again.lookup(frame([(k, day(1), 0.0) for k in (1, 2, 3, 50, 99)]).select("k"), ["x"])
    assert {r.k: r.x for r in found.collect()} == {1: -1.0, 2: 2.0, 3: 3.0, 50: 50.0, 99: None}
    assert again.read().count() == 21
    plan = again.lookup(spark.range(5).withColumnRenamed("id", "k"), ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan  # of the keys; the stored side lies in its buckets


def test_unknown_reference_is_an_error(spark):
    view = fv.FeatureView("v", spark.range(1), ["id"], ["x"])
    with pytest.raises(ValueError):
        fv.historical_features(spark.range(1), [view], ["v:missing"], "t")


# --- quality, comparison ---------------------------------------------------


def test_validation_rules(spark):
    rows = [("f", None, 1, 1, 0.1, 2), ("f", [1.0, 2.0], None, 1, 0.2, 2)]
    df = spark.createDataFrame(rows, "file_id string, trace_data array<double>, cdp_x int, cdp_y int, sample_rate double, num_samples int")
    r = quality.validation(df).first()
    assert r.anomalies == ["Found 1 traces with missing data", "Inconsistent sample rates across traces"]
    assert r.validation_passed is False and r.missing_coordinates == 1


def test_evaluation_without_history(spark):
    from traceframe.sources import roles

    r = quality.evaluate(roles.traces(spark, "/root/testdata/sf0.001")).first()
    assert (r.priority, r.action, r.drift_status) == ("LOW", "PASS", "no_history")


def test_vanished_class_counts_as_change(spark):
    now = spark.createDataFrame([(0, 1.0)], "class_label bigint, share double")
    past = spark.createDataFrame([(0, 0.6), (1, 0.4)], "class_label bigint, share double")
    assert quality.compare_shares(now, past).agg(F.max("change")).first()[0] == pytest.approx(0.4)


def test_shapiro_reports_every_group(spark):
    g = F.when(F.col("id") < 5050, "big").when(F.col("id") < 5052, "two").when(F.col("id") < 5060, "flat").when(F.col("id") < 5063, "three").otherwise("fine")
    df = spark.range(5100).select(g.alias("g"), F.when(g == "flat", 1.0).otherwise(F.rand(1)).alias("x"))
    got = {r.g: r for r in distribution.shapiro(df, "x", ["g"]).collect()}
    assert {k: r.reason for k, r in got.items()} == {
        "big": "more than 5000 values", "two": "fewer than 3 values", "flat": "all values are equal", "three": None, "fine": None
    }
    assert got["big"].statistic is None and 0 < got["fine"].statistic <= 1 and 0 <= got["three"].p_value <= 1


# --- features --------------------------------------------------------------


def test_embedding_is_centred_and_uncorrelated(spark):
    from traceframe.sources import roles

    traces = roles.traces(spark, "/root/testdata/sf0.001")
    model = ft.TraceEmbedder.fit(traces, k=8)
    pc = model.model.pc.toArray()
    assert pc.T @ pc == pytest.approx(np.eye(8), abs=1e-8)
    e = np.array([r.embedding for r in model.encode(traces).select("embedding").collect()])
    assert e.mean(axis=0) == pytest.approx(np.zeros(8), abs=1e-8)
    cov = np.cov(e.T)
    assert cov - np.diag(np.diag(cov)) == pytest.approx(np.zeros((8, 8)), abs=1e-8)
    report = model.report(traces).first()
    assert report.reconstruction_mse == pytest.approx(1 - report.explained_variance, abs=1e-9)


def test_column_sets():
    scaled = [f"{c}_scaled" for c in HANDCRAFTED]
    assert ft.feature_columns(HANDCRAFTED + scaled, True) == scaled
    assert ft.feature_columns(HANDCRAFTED + EMBEDDINGS) == HANDCRAFTED + EMBEDDINGS
    assert ft.scoring_columns(scaled) == scaled
    assert len(ft.scoring_columns([f"embedding_{i}" for i in range(64)])) == 64
    with pytest.raises(ValueError, match="only some"):
        ft.scoring_columns(scaled[:5] + EMBEDDINGS)
    with pytest.raises(ValueError, match="fitted"):
        ft.scoring_columns(scaled, [*scaled, "embedding_0_scaled"])
    assert ft.scoring_columns([*scaled, "more"], scaled[::-1]) == scaled[::-1]
    with pytest.raises(ValueError):
        ft.scoring_columns(["a", "b"])


def test_constant_column_is_not_divided(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.x_scaled for r in ft.standardise(df, ["x"]).collect()] == [0.0, 0.0]


# --- text ------------------------------------------------------------------


def test_chunks_cover_the_text():
    text = " ".join(f"word{i}." if i % 9 == 0 else f"word{i}" for i in range(2000))
    pieces = tx.chunk_text(text)
    assert all(len(p) <= 500 for p in pieces)
    at = 0
    for p in pieces:
        found = text.find(p, max(0, at - 60))
        assert 0 <= found <= at
        at = found + len(p) + 1
    assert at >= len(text)
    assert tx.chunk_text("short") == ["short"] and tx.chunk_text("") == [""]


def test_terms(spark):
    df = spark.createDataFrame([("The quick-brown fox_1 is A ÜBER fox",), ("the",), ("one",)], "t string")
    got = [r[0] for r in df.select(tx.terms(F.col("t"))).collect()]
    assert got[0] == ["quick", "brown", "fox_1", "über", "fox", "quick brown", "brown fox_1", "fox_1 über", "über fox"]
    assert got[1] == [] and got[2] == ["one"]
    assert df.select(tx.terms(F.col("t"), [])).first()[0][0] == "the"


def test_file_id(spark):
    df = spark.createDataFrame([("/a/b_c/synthetic_x_007.sgy",), ("plain.sgy",)], "p string")
    assert [r[0] for r in df.select(tx.file_id(F.col("p"))).collect()] == ["007", "plain"]


# --- registry, audit -------------------------------------------------------


def test_best_trial_ties_keep_the_first(spark):
    trials = spark.createDataFrame(
        [("B", 0, 0.5), ("A", 0, 0.4), ("A", 1, 0.5), ("A", 2, 0.5)], "model_type string, trial bigint, value double"
    )
    got = {r.model_type: (r.trial, r.is_best) for r in reg.best_trial(trials, ["A", "B"]).collect()}
    assert got == {"A": (1, True), "B": (0, False)}


def test_unknown_stage_is_an_error(spark):
    with pytest.raises(ValueError):
        reg.transition(spark.range(1), spark.range(1), "Live")


def test_audit_success(spark):
    observed = audit.observe({"x": spark.range(3), "y": spark.range(1)})
    rows = audit.audit(spark, ["x", "y"], observed).collect()
    assert {r.status for r in rows} == {"success"} and {r.overall_status for r in rows} == {"success"}


def _occurrences(spark, documents, n):
    texts = spark.createDataFrame([(d,) for d in documents], "terms array<string>").repartition(n)
    return texts.withColumn("doc", F.monotonically_increasing_id()).select("doc", F.explode("terms").alias("term"))


@pytest.mark.parametrize("k", [1, 3, 20, 500])
@pytest.mark.parametrize("fold_rows, list_rows", [(1, 1), (7, 40), (250_000, 10**6)])
def test_most_frequent_terms_are_those_of_a_plain_count(spark, monkeypatch, k, fold_rows, list_rows):
    from collections import Counter

    from traceframe.plans import frequent

    monkeypatch.setattr(frequent, "FOLD_ROWS", fold_rows)

    rng = random.Random(k)
    # A few frequent terms, ties, many rare ones, and one that is spread evenly and leads no list.
    documents = [["even"] + [f"t{int(rng.paretovariate(0.7)) % 97}" for _ in range(rng.randint(0, 12))] + [f"rare{i}"] * (i % 3) for i in range(120)]
    tf, df = Counter(t for d in documents for t in d), Counter(t for d in documents for t in set(d))
    want = sorted(tf, key=lambda t: (-tf[t], t))[:k]
    got = frequent.most_frequent(_occurrences(spark, documents, 5), k, list_rows).collect()
    assert [(r.term, r.corpus_tf, r["df"]) for r in got] == [(t, tf[t], df[t]) for t in want]


def test_rare_terms_are_no_candidates(spark):
    from traceframe.plans import frequent
    from traceframe.session import cut_lineage

    documents = [[f"common{j}" for j in range(10)] * 5 + [f"rare{i}-{j}" for j in range(50)] for i in range(60)]
    lists = cut_lineage(frequent.local_lists(_occurrences(spark, documents, 4), 10))
    assert {r.term for r in frequent.candidates(lists, 10).collect()} == {f"common{j}" for j in range(10)}
    empty = frequent.most_frequent(_occurrences(spark, documents, 4).limit(0), 10)
    assert empty.count() == 0 and empty.columns == ["term", "corpus_tf", "df"]


@pytest.mark.parametrize("list_rows", [1, 60, 10**6])
def test_most_frequent_terms_and_pairs_of_whole_documents(spark, list_rows):
    from collections import Counter

    from traceframe.plans import frequent

    rng = random.Random(list_rows)
    words = [[f"w{int(rng.paretovariate(0.8)) % 41}" for _ in range(rng.choice([0, 1, 2, 9, 300]))] for _ in range(150)]
    documents = [d + [f"{a} {b}" for a, b in zip(d, d[1:])] for d in words]
    tf, df = Counter(t for d in documents for t in d), Counter(t for d in documents for t in set(d))
    want = sorted(tf, key=lambda t: (-tf[t], t))[:80]
    rows = spark.createDataFrame(list(enumerate(words)), "doc long, term array<string>").coalesce(3)
    got = frequent.most_frequent(rows, 80, list_rows, pairs=True).collect()
    assert [(r.term, r.corpus_tf, r["df"]) for r in got] == [(t, tf[t], df[t]) for t in want]


def test_local_lists_hold_a_bounded_number_of_terms():
    """A list is closed before its terms weigh a worker down, in rows and in bytes."""
    import numpy as np
    import pyarrow as pa

    from traceframe.plans import frequent

    assert frequent.LIST_ROWS <= 1_000_000 and frequent.LIST_BYTES <= 32 << 20
    rows = pa.RecordBatch.from_pydict({"doc": np.arange(3000), "term": [["x" * 200] * 100] * 3000})
    parts = list(frequent._flat(rows))
    assert max(p.num_rows for p in parts) <= frequent.FOLD_ROWS and sum(p.num_rows for p in parts) == 300_000


def test_the_chunker_holds_a_slice_of_a_batch_at_a_time(spark):
    """Few and large batches come in; each is cut in slices of bounded bytes and rows, in order."""
    import pyarrow as pa

    from traceframe.functions import text as tx

    texts = [None, "", "short", "word. " * 500_000] + [f"{i} " + "some text. " * (i % 200) for i in range(3000)]
    slices = list(tx.chunker(drop_contained_tail=True).func(iter([pa.array(texts), pa.array([], pa.string())])))
    assert len(slices) > 6 and max(len(s) for s in slices) <= tx.SLICE_ROWS
    assert max(sum(len(t or "") for t in texts[a : a + len(s)]) for a, s in zip(_starts(slices), slices) if len(s) > 1) <= tx.SLICE_BYTES
    flat = [p for s in slices for p in s.to_pylist()]
    assert [p and len(p) for p in flat[:3]] == [None, 1, 1] and len(flat) == len(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(2)
    got = dict(rows.select("id", tx.chunker(drop_contained_tail=True)("text")).collect())
    assert [got[i] for i in range(len(texts))] == flat


def _starts(slices):
    at = 0
    for s in slices:
        yield at
        at += len(s)


def test_term_counts_shuffle_no_row_per_document_and_term(spark):
    """Rows of one key are one document, null included; the others are counted where they are read."""
    from collections import Counter, defaultdict
    from traceframe.operators import retrieval as rt

    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["the", "alpha", "beta", "gamma", "x", "delta"], k=rng.randint(0, 9)))) for i in range(60)]
    rows += [(3, "alpha beta"), (3, None), (None, "alpha zeta"), (None, "zeta"), (70, None)]
    tf, df = Counter(), defaultdict(set)
    for key, text in rows:
        kept = [w for w in (text or "").split() if len(w) > 1 and w != "the"]
        for t in kept + [f"{a} {b}" for a, b in zip(kept, kept[1:])]:
            tf[t] += 1
            df[t].add(key)
    got = rt.term_counts(spark.createDataFrame(rows, "doc_id long, text string"), "text", "doc_id")
    assert sorted(map(tuple, got.collect())) == sorted((t, n, len(df[t])) for t, n in tf.items())
    assert "MapInArrow" in got._jdf.queryExecution().toString()


def test_blocks_of_a_search_are_large_and_fewer_for_wide_vectors():
    """Rows moved grow with members times probes over the size of a block."""
    assert cells._block_rows(64) == (32_768, 16_384) and cells._block_rows(4096) == (4096, 2048)


def test_visits_leave_a_task_few_at_a_time():
    import numpy as np
    import pyarrow as pa

    probes = pa.RecordBatch.from_pydict({"probe_id": np.arange(50), "vector": [[float(i)] * 64 for i in range(50)]})
    who, where = np.divmod(np.arange(50 * 800), 800)
    limits = np.arange(50.0)[:, None]
    found = list(cells._visit_batches(probes, limits, who, where, np.arange(800) + 7, 64))
    assert max(b.num_rows for b in found) * 64 <= cells.VISIT_VALUES
    table = pa.Table.from_batches(found)
    assert table["probe_id"].to_pylist() == who.tolist() and table["cell"].to_pylist() == (where + 7).tolist()
    assert [x[0] for x in table["limits"].to_pylist()] == who.tolist() == [x[63] for x in table["vector"].to_pylist()]
