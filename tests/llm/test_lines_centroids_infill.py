"""Line removal, centroid clustering and infilling against brute force on small tables with awkward rows."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from traceframe.llm import centroids, infill, linededup

COMMON = "All rights reserved by the Example Company"
TEXTS = [
    None, "", "\n", "\n\n", "no break at all", "one\n", "one\ntwo", f"{COMMON}\nown words of this text are here\n", f"  {COMMON.upper()}\t\nother",
    f"x\n{COMMON}\r\n{COMMON}\n", f"{COMMON}\f", "a line of exactly 20c", "exactly twenty chars", "EXACTLY TWENTY CHARS", " exactly twenty chars ", "nineteen characters",
    "é" * 20 + "\nshort", "é" * 20, "É" * 20, "é" * 20 + " ", "holds <P> a mark\nnext", "ends with <\nP> begins\n<", "<P\n>S>\n<M", "\n".join(f"line {i} of a long text {i % 50}" for i in range(20_000)),
    "日本語の行はここにあります、そして二十字を超えます\n次", "日本語の行はここにあります、そして二十字を超えます",
    "日本語の行はここにあります、そして二十字を超えます\x0b",
]
SCHEMA = "doc_id long, text string, n long, form string, kept string, n_lines int, hi long, shard string, __h0 string"


def rows():
    out = [(i, t, None, "clash", "clash", 0, i, "clash", "clash") for i, t in enumerate(TEXTS)]
    out += [(None, COMMON, 1, "", "", 1, 1, "", ""), (None, None, 1, "", "", 1, 1, "", "")]
    return [*out, out[7], out[7], out[16], (3, f"{COMMON}\nunder a used id", 1, None, None, 1, 1, "", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4).cache()


def lines_by_hand(data, min_chars, min_docs):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    holders = defaultdict(set)
    for i, t, *_ in data:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t, *_ in data:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < min_docs or len(key(x)) < min_chars or i == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sent, keys, hot", [(linededup.SENT_BYTES, 50_000, 10_000), (linededup.SENT_BYTES, 3, 10_000), (0, 3, 10_000), (0, 3, 5)])
def test_lines(docs, monkeypatch, sent, keys, hot):
    monkeypatch.setattr(linededup, "HOT_KEYS", hot)
    for min_docs in (2, 3):
        found = linededup.drop_shared_lines(docs, 20, min_docs, sent_bytes=sent, shard_keys=keys)
        assert set(found.columns) == {*docs.columns, "n_lines", "n_dropped", "kept"}
        assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found.collect()], key=repr) == lines_by_hand(rows(), 20, min_docs)


def test_lines_of_an_empty_table(docs):
    assert linededup.drop_shared_lines(docs.limit(0)).count() == 0
    assert linededup.drop_shared_lines(docs.where("text is null")).count() == 2


def test_perfect_hash():
    draw = np.random.default_rng(3)
    words = draw.integers(0, 1 << 63, (40_000, 2), dtype=np.uint64) * np.uint64(2) + draw.integers(0, 2, (40_000, 2), dtype=np.uint64)
    words[1, 1] = words[0, 1]  # keys that differ in one word only
    sizes, bits, place = linededup.build(words[:, 0], words[:, 1])
    assert sorted(place) == list(range(len(words))) and bits.sum() == len(words) and sizes.sum() == len(bits) < 5 * len(words)


def by_hand(units, low, high):
    return "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])


@pytest.mark.parametrize("percent, spm", [(100, 50), (60, 0), (0, 50)])
def test_infilling(docs, percent, spm):
    found = infill.fill_in_middle(docs, seed=7, percent=percent, spm_percent=spm).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    want = []
    for i, t, *_ in rows():
        t = t or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", t)
        digest = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
        n = len(units)
        low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        prefix, middle, suffix = by_hand(units, low, high)
        if not t or re.search("<[PSM]>", t) or h[2] % 100 >= percent:
            want.append((i, n, "plain", None, None, t, t))
        elif h[3] % 100 < spm:
            want.append((i, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", t))
        else:
            want.append((i, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", t))
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert "kept" in found.columns and "__h0" in found.columns
    assert infill.fill_in_middle(docs.limit(0)).count() == 0


def vectors(n=600, seed=5):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (12, 64))
    out = [(i, [float(np.float32(x)) for x in centres[i % 12] + draw.normal(0, 0.1, 64)], "c") for i in range(n)]
    out += [(7, out[7][1], "c"), (n, out[8][1], "c"), (None, out[9][1], "c"), (n + 1, None, "c"), (n + 2, [1.0] * 63, "c"), (n + 3, [math.nan] + [0.0] * 63, "c")]
    return [*out, (n + 4, [math.inf] + [0.0] * 63, "c"), (n + 5, [None] + [0.0] * 63, "c"), (n + 6, [0.0] * 64, "c"), (n + 7, [0.0] * 64, "c"), (n + 8, [], "c")]


def lloyd(data, k, rounds):
    whole = lambda x: math.floor(256 * x) if math.isfinite(256 * x) else int(x) * 256
    kept = [(i, [whole(x) for x in v]) for i, v, *_ in data if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    points = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), j) for j, p in enumerate(points))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        points = [[sum(c) // len(groups[j]) for c in zip(*groups[j], strict=True)] if j in groups else p for j, p in enumerate(points)]
    return [(i, nearest(v)) for i, v in kept], points


def check_clusters(spark, data, k=10, rounds=2):
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, cluster string").repartition(4)
    found = centroids.cluster(frame, k=k, rounds=rounds)
    got = sorted([(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in centroids.with_inertia(found).collect()], key=repr)
    rows, points = lloyd(data, k, rounds)
    per = defaultdict(int)
    for _, (d, j) in rows:
        per[j] += d
    fits = lambda v: v if v < 1 << 63 else None
    largest = max((d for _, (d, _) in rows), default=0)
    total = sum(per.values())
    sha = lambda p: hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()
    over = {j for _, (d, j) in rows if d >= 1 << 63}
    want = sorted([(i, j, fits(d), None if j in over else fits(per[j]), None if largest >= 1 << 63 else fits(total), sha(points[j])) for i, (d, j) in rows], key=repr)
    assert got == want
    return found


def test_centroids(spark):
    found = check_clusters(spark, vectors(), rounds=3)
    assert sum(found.verified) < 0.5 * 3 * found.pairs  # most centroids are left out by the bound


def test_centroids_of_large_and_few_vectors(spark):
    data = vectors(40)
    large = [(900, [1e300] + [0.0] * 63, "c"), (901, [-1e9] * 64, "c"), (902, [1.7e308] * 64, "c"), (903, [3e5] * 64, "c"), (904, [6e5] + [0.5] * 63, "c"), (905, [1e12] * 64, "c")]
    check_clusters(spark, data + large, k=6)
    check_clusters(spark, data + large, k=60, rounds=1)
    check_clusters(spark, large, k=4)
    check_clusters(spark, data[:3], k=10)
    assert centroids.with_inertia(centroids.cluster(spark.createDataFrame([], "vec_id long, embedding array<double>"))).count() == 0
