"""Operators against brute force on small tables with awkward rows."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from traceframe.llm import decontaminate, langid, neardup, packing, pii, sharding, substring, tokenbin, topk, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions beneath an old stone bridge"
LONG = " ".join(f"word{i % 977} x{i}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place int, sig binary, bucket string, crc int, pii string"


def rows():
    """Nulls, empty and very long texts, ties, repeated rows, shared passages, copies and near copies."""
    texts = [
        None, "", "   \n\t ", "one", "two words", PASSAGE, PASSAGE, PASSAGE.upper(), f"intro {PASSAGE} outro é è", f"{PASSAGE} tail words follow here now",
        LONG, LONG + " end", "é" * 120, "be " * 400, "be " * 390, "Straße, İstanbul. don't stop", "a\xa0b\x1cc d", "日本語 テキスト <|endoftext|> x",
    ]
    base = [f"token{i}" for i in range(120)]
    for k in range(12):  # a family around one text, some members linked only through others
        words = list(base)
        for j in range(k):
            words[9 * j + 3] = f"edit{k}x{j}"
        texts.append(" ".join(words))
    out = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, len(t or ""), i, None, "clash", 1, "clash") for i, t in enumerate(texts)]
    return [*out, out[8], out[5]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_decontamination(spark, docs, nothing):
    item = PASSAGE.split()
    items = [(1, PASSAGE.title()), (2, " ".join(item[4:15])), (3, "one"), (4, None), (5, "..."), (10, "dog while"), (None, "two words"), (2, " ".join(item[4:15]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+")
    fold = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = []
    for i, text, *_ in rows():
        own, hit, found = fold(text), set(), set()
        for item_id, t in items:
            w = fold(t)
            size = min(10, len(w))
            for a in range(len(w) - size + 1) if w else []:
                for b in range(len(own) - size + 1):
                    if own[b : b + size] == w[a : a + size]:
                        hit |= set(range(b, b + size))
                        found |= {str(item_id)} if item_id is not None else set()  # hit, but not named
        want.append((i, len(own), len(hit), tuple(sorted(found))))
    one = decontaminate.contamination(docs, bench)
    assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in one.collect()) == sorted(want)
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in one.collect()}
    text = dict((r[0], r[1]) for r in rows())
    assert [text[8][a:b] for a, b in spans[8]] == [PASSAGE]
    many = decontaminate.contamination(docs, bench, automaton_words=3)  # several automata
    assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in many.collect()) == sorted(want)
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, bench.limit(0)).collect())


def shingles(text, n):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\\x20\\x09-\\x0d]+", words)
    return {tuple(words[i : i + min(n, len(words))]) for i in range(max(1, len(words) - n + 1))} if words else set()


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, nothing, n, percent):
    sets = [(r[0], shingles(r[1], n)) for r in rows()]
    parent = {i: i for i, _ in sets}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    want = sorted((i, len(s), find(i), find(i) == i) for i, s in sets)
    got = neardup.near_duplicates(docs, n, percent)
    assert sorted(map(tuple, got.collect())) == want
    assert neardup.near_duplicates(nothing, n, percent).count() == 0


def test_sequential_bound_keeps_linked_pairs():
    keep = neardup.least_matches(0.8)
    draw = np.random.default_rng(3)
    left = draw.integers(0, 2**32, (4000, neardup.HASHES)).astype(np.uint32)
    right = np.where(draw.random(left.shape) < 0.8, left, left ^ np.uint32(1))
    assert neardup._survivors(left, right, keep).all()
    apart = np.where(draw.random(left.shape) < 0.4, left, left ^ np.uint32(1))
    assert not neardup._survivors(left, apart, keep).any()


def test_substring_removal(docs, nothing, spark):
    data = rows() + [(None, PASSAGE, *rows()[0][2:])]
    frame = spark.createDataFrame(data, SCHEMA)
    first = {}
    for i, text, *_ in data:
        raw = (text or "").encode()
        if i is not None:
            for a in range(len(raw) - 49):
                w = raw[a : a + 50]
                first[w] = min(first.get(w, i), i)
    want = []
    for i, text, *_ in data:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for a in range(len(raw) - 49) if i is not None else []:
            if first[raw[a : a + 50]] < i:
                gone[a : a + 50] = True
        edges = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        want.append((-1 if i is None else i, len(raw), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest()))
    got = [(-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substring.remove_repeats(frame).collect()]
    assert sorted(got) == sorted(want)
    assert substring.remove_repeats(nothing).count() == 0


def test_substring_removal_with_many_fragments_of_one_anchor(spark):
    draw = np.random.default_rng(8)
    around = lambda n: "".join(draw.choice(list("abcdefghijklmnop"), n))
    texts = [f"{around(60)}{PASSAGE}{around(60)}" for _ in range(300)]
    for i in range(0, 90, 3):  # contexts that two documents share, and one that holds the passage twice
        texts.append(around(40) + texts[i][35:] + (PASSAGE if i % 2 else around(9)))
    data = [(i, t) for i, t in enumerate(texts)] + [(7, texts[9]), (7, PASSAGE + around(30))]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    first = {}
    for i, text in data:
        for a in range(len(text) - 49):
            first[text[a : a + 50]] = min(first.get(text[a : a + 50], i), i)
    want = []
    for i, text in data:
        gone = np.zeros(len(text), bool)
        for a in range(len(text) - 49):
            if first[text[a : a + 50]] < i:
                gone[a : a + 50] = True
        want.append((i, len(text), int(gone.sum()), hashlib.sha256(bytes(np.frombuffer(text.encode(), np.uint8)[~gone])).hexdigest()))
    for frequent in (20, 10_000):
        got = [(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(frame, anchor_bytes=4000, frequent=frequent).collect()]
        assert sorted(got) == sorted(want)

    # No anchor above the bound is left to one task.
    sent = spark.sparkContext.broadcast((8, np.full(32, 255, np.uint8)))
    emitted = frame.selectExpr("doc_id", "cast(text as binary) text").mapInArrow(substring._emit_fragments(2, sent), "place int, doc_id long, crc long, data binary, most long").cache()
    places, heavy = substring.heavy_anchors(emitted, 4000)

    def weights(df):
        held = Counter()
        for r in df.collect():
            for anchor, n in zip(*substring._weights(bytes(r.data)), strict=True):
                held[int(anchor)] += int(n)
        return held

    every, left = weights(emitted.where("place is not null")), weights(substring.without_anchors(emitted, places, heavy))
    assert heavy and heavy == {a for a, n in every.items() if n > 4000}
    assert left == Counter({a: n for a, n in every.items() if a not in heavy})


def test_only_fragments_with_a_common_context_reach_the_transform(monkeypatch):
    draw = np.random.default_rng(4)
    some = lambda n: bytes(draw.choice(list(b"abcdefgh"), n).astype(np.uint8))
    gram = min((some(20) for _ in range(3000)), key=lambda g: int(substring._gram_hashes(np.frombuffer(g, np.uint8))[0]))
    texts = [some(60) + gram + some(60) for _ in range(60)]
    texts += [some(40) + t[30:100] + some(40) for t in texts[:5]]
    texts += [some(9) + texts[7][10:60] + some(20), some(9) + texts[8][55:125]]  # the gram at either end of what is shared
    texts += [b"ab" * 60 + some(9), some(3) + b"ba" * 50, gram * 5, some(30) + gram * 4, texts[0], some(49)]  # several grams in a window
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.binary())})
    emitted, ranges, given, plain = [], [], [], substring.repeated
    for out in substring._emit_fragments(2, SimpleNamespace(value=(8, np.full(32, 255, np.uint8))))(iter([batch])):
        emitted += [r for r in out.to_pylist() if r["place"] is not None]
        ranges += [r for r in out.to_pylist() if r["place"] is None]
    monkeypatch.setattr(substring, "repeated", lambda fragments, docs: given.extend(fragments) or plain(fragments, docs))
    for place in {r["place"] for r in emitted}:
        ranges += substring._resolve(pa.table({"data": pa.array([r["data"] for r in emitted if r["place"] == place], pa.binary())})).to_pylist()

    first = {}
    for i, text in enumerate(texts):
        for a in range(len(text) - 49):
            first.setdefault(text[a : a + 50], i)
    want = {(i, b) for i, t in enumerate(texts) for a in range(len(t) - 49) if first[t[a : a + 50]] < i for b in range(a, a + 50)}
    got = {(r["doc_id"], b) for r in ranges for low, high in np.frombuffer(r["data"], "<u4").reshape(-1, 2).tolist() for b in range(low, high)}
    assert got == want and len(want) > 500
    assert 0 < len(given) < 40  # not every fragment around the common gram


def test_bounded_prefixes_by_brute_force():
    draw = np.random.default_rng(5)
    for n, letters, length in ((300, 2, 6), (500, 3, 9), (64, 1, 50), (2, 2, 5)):
        symbols = draw.integers(1, letters + 1, n)
        symbols[-1] = 0
        order = substring.suffix_order(symbols, length + 1)
        got = substring.bounded_prefixes(symbols, order, length)
        text = bytes(symbols.astype(np.uint8))
        for r in range(1, n):
            a, b = text[order[r - 1] :], text[order[r] :]
            common = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            if 0 not in a[: min(common, length)] and text[order[r]] != 0:
                assert got[r] == (common < length), (n, r)


def test_intervals_are_ordered_without_wide_keys(monkeypatch):
    """Sorting 64-bit keys through an index in every round was most of the operator's time."""
    text = np.frombuffer(b"the cat sat on the mat; the cat sat; a mat on a cat \0" * 40, np.uint8).astype(np.int64) + 1
    text[-1] = 0  # the end of the last fragment
    order, widths, plain = substring.suffix_order(text, 51), [], np.argsort
    want = substring.bounded_prefixes(text, order, 50)
    monkeypatch.setattr(np, "argsort", lambda a, *args, **named: widths.append(a.dtype.itemsize) or plain(a, *args, **named))
    got = substring.bounded_prefixes(text, order, 50)
    assert (got == want).all() and max(widths) <= 2
    own = text.tolist()
    assert got.tolist() == [True] + [own[a : a + 50] != own[b : b + 50] for a, b in zip(order[:-1].tolist(), order[1:].tolist())]


def test_top_k(spark):
    draw = np.random.default_rng(2)
    data = [(i, draw.normal(0, 0.3, 16).tolist()) for i in range(240)]
    hot = data[7][1]
    data += [(1000 + i, hot) for i in range(80)] + [(2000, None), (2001, [None] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] * 16), (None, hot), (2050, [0.5])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).repartition(4)
    fine = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in fine:
        if q % 50 == 0:
            found = sorted((-int(a @ b), i) for i, b in fine if i != q and len(a) == len(b))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(found)]
    for block in (2048, 2):
        got = topk.search(frame, F.col("vec_id") % 50 == 0, 5, block=block)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_personal_data(spark, docs, nothing):
    texts = [
        "mail a.b+c@ex-ample.co.uk, x@y.z_w@q.r @no a@b", "call +1 (234) 555-7890 or +49 30 12 or +123456789012345678", "ip 10.0.0.1 999.1.1.1 1.2.3.4.5.6.7.8 0010.1.1.255",
        "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 4111 1111 1111 1111 2", "IBAN GB82 WEST 1234 5698 7654 32 not GB83 WEST 1234 5698 7654 32",
        "ssn 123-45-6789", "number 123-45-6789", "😀 é a@b.cd 5 5 5", "@" * 300 + "1" * 5000, "a" * 60_000 + "@b.c" + ".d" * 9000, None,
    ]
    base = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    def fine(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else None, "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]

    def spans(t):
        found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(base) for m in re.finditer(p, t or "") if fine(kind, m[0])]
        return [(kind, a, b) for a, _, b, kind in sorted(found)]

    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, pii string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.pii] for r in pii.find(frame).collect()}
    for i, t in enumerate(texts[:9]):
        assert [s for s in got[i] if s[0] in pii.BASE] == spans(t), t
    assert got[9] == [("email", 0, len(texts[9]))] and got[10] == []
    assert [s[0] for s in got[4] if s[0] not in pii.BASE] == ["iban"]
    assert [s[0] for s in got[5]] == ["ssn"] and got[6] == []
    masked = {r.doc_id: r.m for r in pii.find(frame).select("doc_id", pii.mask(F.col("text"), F.col("pii")).alias("m")).collect()}
    assert masked[7] == "😀 é <EMAIL> 5 5 5" and masked[10] is None
    assert pii.find(docs).count() == len(rows()) and pii.find(nothing).count() == 0


def test_packing(docs, nothing):
    got = packing.pack(docs, capacity=500, lane_rows=9).collect()
    words = [(r[0], len(re.findall(r"[^ \t\n\x0b\f\r]+", r[1] or ""))) for r in rows()]
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(i for i, _ in words)
    total = Counter()
    for r in got:
        total[r.doc_id] += r.n_words
    assert all(total[i] == sum(n for j, n in words if i == j) for i, _ in words)
    source = {r[0]: r[3] for r in rows()}
    cluster = {r[0]: " ".join((r[1] or "").lower().split()) for r in rows()}
    bins = {}
    for r in got:
        bins.setdefault((r.lane, r.bin), []).append(r)
    for own in bins.values():
        assert sum(r.n_words for r in own) == own[0].bin_words <= 500
        assert len({source[r.doc_id] for r in own}) == len(own)
        filled = [cluster[r.doc_id] for r in own if cluster[r.doc_id]]
        assert len(set(filled)) == len(filled)
        assert sorted(r.position for r in own) == list(range(len(own)))
    assert packing.pack(nothing).count() == 0


def test_best_fit_by_brute_force():
    draw = np.random.default_rng(4)
    pieces = sorted(((int(draw.integers(0, 60)), i, 0, f"s{draw.integers(9)}", int(draw.integers(40)) if draw.random() < 0.7 else None) for i in range(300)), key=lambda p: (-p[0], p[1]))
    bins, want = [], []
    for size, _, _, source, cluster in pieces:
        fit = [(b["left"], k) for k, b in enumerate(bins) if b["left"] > 0 and b["left"] >= size and source not in b["sources"] and (cluster is None or cluster not in b["clusters"])]
        if fit:
            k = min(fit)[1]
        else:
            k = len(bins)
            bins.append({"left": 100, "sources": set(), "clusters": set(), "n": 0})
        b = bins[k]
        want.append((k, b["n"]))
        b["left"] -= size
        b["n"] += 1
        b["sources"].add(source)
        b["clusters"].add(cluster)
    assert packing.pack_lane(pieces, 100) == want


def test_token_files(spark, docs, nothing, tmp_path):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want, at = [], 0
    for i, text in sorted(((r[0], r[1] or "") for r in rows()), key=lambda r: r[0]):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    tokenbin.write(docs, str(tmp_path / "a"), TOKENIZER, part_ids=50_000)
    assert sorted(map(tuple, tokenbin.read(spark, str(tmp_path / "a")).collect())) == want
    tokenbin.write(nothing, str(tmp_path / "b"), TOKENIZER)
    assert tokenbin.read(spark, str(tmp_path / "b")).count() == 0


def test_block_round_trip_and_damage():
    draw = np.random.default_rng(6)
    for ids in (np.array([7], np.uint32), draw.zipf(1.3, 900_000).clip(1, 60_000).astype(np.uint32), np.full(5000, 3, np.uint32)):
        table = tokenbin.Table(tokenbin.scaled(Counter(ids.tolist())))
        data = tokenbin.encode_block(ids, table)
        block = tokenbin.Block(data)
        assert (block.decode(table) == ids).all()
        alone = block.stretch(len(block.marks) - 1, table)  # the last checkpoint needs no earlier one
        assert (alone == ids[-len(alone) :]).all()
        if len(table.slot) == int(table.frequency.max()):
            continue  # with one id, any state stands for it
        damaged = bytearray(data)
        damaged[-1] ^= 0x55
        with pytest.raises(ValueError, match="checksum"):
            tokenbin.Block(bytes(damaged)).decode(table)


def test_sharding(docs, nothing, spark, tmp_path):
    limit = 3000
    data = [(i, "x" * (i * 37 % 900)) for i in range(400)] + [(None, "abc"), (None, None), (5, "y" * 5000)]
    frame = spark.createDataFrame(data, "doc_id long, text string").withColumn("fits", F.lit("clash"))
    bits = lambda i: bin(int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16))[2:].zfill(60)
    got = sharding.shard(frame, limit).collect()
    size = Counter()
    for i, t in data:
        for d in range(61):
            size[bits(i)[:d]] += len(t or "")
    for r in got:
        depth = next((d for d in range(61) if size[bits(r.doc_id)[:d]] <= limit), 60)
        assert (r.shard, r.shard_depth, r.shard_bytes, r.fits) == (bits(r.doc_id)[:depth], depth, size[bits(r.doc_id)[:depth]], size[bits(r.doc_id)[:depth]] <= limit)
    assert len(got) == len(data) and sharding.shard(nothing).count() == 0
    assert sharding.write_shards(docs, str(tmp_path / "shards"), 100_000).count() == len(rows())


def test_toxicity_generalises(spark, nothing):
    draw = np.random.default_rng(8)
    calm = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    bad = ["idiot", "scumbag", "moronic", "pathetic"]
    data, labels = [], []
    for i in range(500):
        words = draw.choice(calm, int(draw.integers(5, 120))).tolist()
        if i % 4 == 0:
            for _ in range(1 + len(words) // 40):
                words.insert(int(draw.integers(len(words))), str(draw.choice(bad)))
        data.append((i, " ".join(words), "clash"))
        labels.append((i, 1, int(i % 4 == 0)))
    data += [(900, None, "c"), (901, "", "c"), (902, "you are moronicc and pathetik", "c"), (903, " ".join(calm * 40), "c"), (None, "idiot", "c")]
    labels += [(0, 1, None), (903, 1, 0), (903, 1, 1), (None, 1, 1)]
    frame = spark.createDataFrame(data, "doc_id long, text string, toxicity string")
    model = toxicity.fit(frame.where("doc_id % 3 <> 1"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rounds=60)
    got = {r.doc_id: r for r in toxicity.toxicity(frame, model).collect()}
    held = [i for i in range(500) if i % 3 == 1]
    assert np.mean([got[i].is_toxic == (i % 4 == 0) for i in held]) > 0.97
    assert got[902].is_toxic and not got[903].is_toxic and not got[900].is_toxic and got[900].toxicity == got[901].toxicity
    assert toxicity.toxicity(nothing, model).count() == 0
    empty = toxicity.fit(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.toxicity for r in toxicity.toxicity(frame, empty).collect()} == {0.0}


def test_toxicity_of_subwords_is_the_mean_of_hashed_rows():
    buckets, counts = toxicity.subwords([b"abc", b"ab"])
    assert counts.tolist() == [3 + 2 + 1 + 0 + 1, 2 + 1 + 0 + 0 + 1]
    again, _ = toxicity.subwords([b"zz", b"abc"])
    assert sorted(again[4:].tolist()) == sorted(buckets[:7].tolist())


def test_language(spark, docs, nothing):
    draw = np.random.default_rng(9)
    kinds = {"aa": ["the", "shore", "winding", "thought"], "bb": ["über", "schön", "nicht", "weiß"], "cc": ["ça", "être", "leçon", "août"]}
    data = []
    for i in range(360):
        lang = list(kinds)[i % 3]
        data.append((i, " ".join(draw.choice(kinds[lang], int(draw.integers(1, 80)))), lang))
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string")
    net = langid.fit(frame.where("doc_id % 5 <> 0"), sample_docs=80, steps=120)
    more = frame.select("doc_id", "text").unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "12 !?"), (903, "the thought " * 9000)], "doc_id long, text string"))
    got = {r.doc_id: r for r in langid.language(more, net).collect()}
    held = [d for d in data if d[0] % 5 == 0]
    assert np.mean([got[i].lang_pred == lang for i, _, lang in held]) > 0.95
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.language(docs, net).count() == len(rows()) and langid.language(nothing, None).count() == 0
    assert langid.fit(nothing) is None


def test_every_labelled_language_is_learned(spark, monkeypatch):
    names = [f"l{i:02}" for i in range(70)]
    data = [(i * 100 + k, chr(0x4E00 + 97 * i) * (4 + k), name) for i, name in enumerate(names) for k in range(3 if i else 4)]
    data += [(None, "zzz", "rare")] * 3000  # rows that no slice by doc_id can part
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string")
    assert langid.fit(frame, sample_docs=3, steps=1).languages == [*names, "rare"]
    seen = {}
    monkeypatch.setattr(langid, "train", lambda texts, labels, steps: seen.update(labels=Counter(labels)))
    langid.fit(frame, sample_docs=10)
    assert set(seen["labels"]) == {*names, "rare"} and max(seen["labels"].values()) <= 9  # 640 documents among 71


def test_network_gradients():
    draw = np.random.default_rng(1)
    net = langid.train([b"aaa", b"bbb"], ["x", "y"], steps=1)
    for part in (net.inputs, net.gates, net.new, net.out):
        part[...] = draw.normal(0, 0.5, part.shape)
    net = langid.Network(*(p.astype(np.float64) for p in (net.inputs, net.gates, net.new, net.out)), net.languages)
    codes, labels = draw.integers(97, 101, (6, 5)).astype(np.uint8), draw.integers(0, 2, 5)

    def loss():
        p = net.probabilities(net.states(codes, np.ones(codes.shape, np.float32)).astype(np.float64))
        return -np.log(p[:, np.arange(5), labels]).mean()

    for part, grad in zip((net.inputs, net.gates, net.new, net.out), langid._gradients(net, codes, labels), strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        kept, step = part[at], 1e-2
        part[at] = kept + step
        up = loss()
        part[at] = kept - step
        down = loss()
        part[at] = kept
        assert abs((up - down) / (2 * step) - grad[at]) < 0.02 * abs(grad[at]) + 1e-4


def test_top_k_of_long_vectors(spark):
    import math

    draw = np.random.default_rng(21)
    data = [(i, draw.normal(size=4).tolist()) for i in range(60)]
    data += [(100, [1e300, 1.0, -2.0, 0.5]), (101, [-1e300, 3.0, 0.0, 0.0]), (102, [8.5e6] * 4), (103, [1.7e308, -1.7e308, 0.0, 0.0]), (104, [1e9, 2e9, -3e9, 1.0]), (150, [2e9, 1.0, 1.0, 1.0]), (150, [2e9, 1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)
    whole = lambda x: math.floor(256 * x) if math.isfinite(256 * x) else int(x) * 256
    grid = [(i, [whole(x) for x in v]) for i, v in data]
    for block in (2048, 1):
        got = {}
        for r in topk.search(frame, F.col("vec_id") % 50 == 0, 5, block=block).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        for q, own in dict(grid).items():
            if q % 50 == 0:
                scores = sorted(((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in grid if i != q))[:5]
                assert got[q] == [(i, -s if abs(s) < 1 << 63 else None) for s, i in scores]
    assert sorted([0, -5, 7, 10**40, -(10**40), 99, -99], key=topk.sortable) == [-(10**40), -99, -5, 0, 7, 99, 10**40]


def test_windows_of_items_without_id_are_hit(spark):
    docs = spark.createDataFrame([(1, f"before {PASSAGE} after"), (2, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(None, PASSAGE), ("b", " ".join(PASSAGE.split()[:10]))], "item_id string, text string")
    for words in (200_000, 5):
        got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.contamination(docs, items, automaton_words=words).collect()}
        assert got == {1: (len(PASSAGE.split()), ["b"]), 2: (0, [])}


@pytest.mark.parametrize("block, room", [(1024, 64 << 20), (3, 64 << 20), (1024, 3000)])
def test_near_duplicates_of_mixed_buckets(spark, monkeypatch, block, room):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", room)
    draw = np.random.default_rng(31)
    base = [f"w{i}" for i in range(220)]
    data = []
    for i in range(36):  # two loose families whose members are linked by chance, and strays
        words = list(base) if i % 2 else base[::-1]
        for j in draw.choice(220, int(draw.integers(1, 9)), replace=False):
            words[j] = f"x{i}y{j}"
        data.append((i, " ".join(words)))
    sets = [{tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for _, t in data]
    group = list(range(len(data)))
    for _ in data:
        for i in range(len(data)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    found = neardup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(3), words=3, percent=85)
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(group))


def test_packing_deals_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "REPEATS", 50)
    frame = spark.createDataFrame([(1, "same text", "a")] * 400 + [(None, "", "b")] * 200 + [(i, f"text {i}", "c") for i in range(2, 50)], "doc_id long, text string, source string").repartition(5)
    out = packing.pack(frame, capacity=8, lane_rows=20).collect()
    assert Counter(r.doc_id for r in out) == Counter({1: 400, None: 200, **{i: 1 for i in range(2, 50)}})
    assert max(Counter(r.lane for r in out).values()) < 200


def test_toxicity_training_follows_its_loss(monkeypatch):
    """One round of training moves the softmax along the loss: a larger step than noise lowers it, and scores are those of a loop over windows."""
    draw = np.random.default_rng(4)
    texts = [" ".join(draw.choice([f"word{i}" for i in range(40)], int(draw.integers(1, 90)))) + (" scumbag" if i % 3 == 0 else "") for i in range(120)]
    labels = [int(i % 3 == 0) for i in range(120)]
    loss = []
    for rounds in (3, 12, 60):
        model = toxicity.train(list(texts), labels, rounds)
        logits = []
        for t in texts:
            order = toxicity.words(t)
            values = dict(zip(dict.fromkeys(order), model.word_values(list(dict.fromkeys(order))), strict=True))
            means = []
            for a in toxicity.window_starts(len(order)).tolist():
                window = order[a : a + toxicity.WINDOW]
                means.append(sum(values[w] for i, w in enumerate(window, a) if w not in order[max(0, i - toxicity.WINDOW + 1) : i]) / len(window))
            p = 1 / (1 + np.exp(-(model.slope * (model.bias + toxicity.SCALE * max(means)) + model.shift)))
            ids = {w: i for i, w in enumerate(values)}
            order_ids = np.array([ids[w] for w in order])
            assert model.score(np.array(list(values.values()))[order_ids] * toxicity.counted(order_ids)) == pytest.approx(p)
            logits.append(p)
        p = np.clip(np.array(logits), 1e-9, 1 - 1e-9)
        loss.append(-np.mean(np.where(np.array(labels) == 1, np.log(p), np.log(1 - p))))
    assert loss[0] > loss[1] > loss[2] and loss[2] < 0.1


def test_toxicity_of_one_short_word(spark):
    model = toxicity.train(["you scumbag", "a fine day", "the idiot", "calm sea"], [1, 0, 1, 0], 20)
    assert len(model.word_values([b"x"])) == 1 and 0 <= toxicity.toxicity(spark.createDataFrame([(1, "x")], "doc_id long, text string"), model).first().toxicity <= 1


def test_toxicity_training_holds_few_copies_of_its_tokens(monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 1 << 10)
    monkeypatch.setattr(toxicity, "SOME", 1 << 14, raising=False)
    own = np.random.default_rng(3).integers(0, 500, (400, 1000))
    texts = [" ".join(f"w{i}" for i in row) for row in own.tolist()]
    tracemalloc.start()
    toxicity.train(texts, [i % 2 for i in range(400)], 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 35 * own.size


def test_toxicity_fit_reads_texts_in_few_jobs(spark):
    """Every partition of the chosen texts is a job of its own."""
    data = [(i, "alpha beta gamma" if i % 2 else "bad worse worst") for i in range(40)]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in data], "doc_id long, toxic int")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    context = spark.sparkContext
    context.setJobGroup("fit-of-few", "fit")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        toxicity.fit(frame, labels, rounds=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("fit-of-few")) < 50


def test_toxicity_is_learned_in_a_task(spark, monkeypatch):
    """The driver has little memory: it gets the model, neither texts nor what training needs."""
    texts = ["a calm day at sea", "you idiot", "", "what a scumbag you are", "tea and cake", "idiot and scumbag"]
    frame = spark.createDataFrame([*enumerate(texts), (6, None), (3, texts[3])], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    want = toxicity.train(list(texts), [i % 2 for i in range(6)], 5, 0.5)
    monkeypatch.setattr(toxicity, "subwords", lambda *args: pytest.fail("trained at the driver"))
    got = toxicity.fit(frame, labels, rounds=5)
    assert np.allclose(got.per_bucket, want.per_bucket, atol=1e-5) and want.per_bucket.any()  # a task's sums are added by one thread
    assert (got.bias, got.slope, got.shift) == pytest.approx((want.bias, want.slope, want.shift), abs=1e-4) and got.constant is None
    alone = toxicity.fit(frame, labels.where("toxic = 1"), rounds=5)
    assert alone.constant == 1 and not alone.per_bucket.any()
