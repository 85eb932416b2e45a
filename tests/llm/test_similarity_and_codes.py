"""Jaccard join, resampling and vector codes against brute-force versions."""

import hashlib
import math
import random
import re
import signal
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import SMALL, TEXTS, frame, rows_of
from weighbridge.llm import jaccard_join, queries, resampling, vector_codes

# -- Jaccard join --------------------------------------------------------------------------


def set_plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if len(words) < 3:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)}


def join_plain(rows):
    sets = [set_plain(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for j in set().union(*(holders[x] for x in s)) if s else ():
            both = len(s & sets[j])
            if 100 * both >= 90 * (len(s) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
        for x in s:
            holders[x].add(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[top(i)].append(doc_id)
    return Counter(
        (doc_id, len(s), (min(ids[top(i)], default=None) if s else doc_id))
        for i, ((doc_id, _), s) in enumerate(zip(rows, sets))
    )


def joined(docs):
    return rows_of(jaccard_join.similar_groups(docs), "doc_id", "n_shingles", "component_id")


def test_join_on_awkward_rows(spark):
    long = " ".join(f"w{i % 7919} of {i}" for i in range(40_000))
    rows = TEXTS + [(30, long), (31, long + " end"), (None, long + " other"), (32, "a b"), (33, "A\tB"), (34, "a b c")]
    assert joined(frame(spark, rows).repartition(3)) == join_plain(rows)
    assert joined(frame(spark, [])) == Counter()
    assert joined(frame(spark, [(1, None), (2, "")])) == Counter({(1, 0, 1): 1, (2, 0, 2): 1})


def edited(rng, words, share):
    return " ".join(f"z{rng.random()}" if rng.random() < share else w for w in words)


def clusters(seed):
    """Near copies at and around the least similarity, chains, a hot passage and plain texts."""
    rng = random.Random(seed)
    hot = [f"hot{i}" for i in range(80)]
    texts = []
    for n in (2, 5, 40, 150):
        base = [f"b{n}x{rng.randrange(500)}" for _ in range(rng.randrange(60, 200))]
        texts += [edited(rng, base, rng.choice([0.005, 0.01, 0.02])) for _ in range(n)]
    chain = [f"c{i}" for i in range(150)]
    for i in range(40):
        chain[rng.randrange(150)] = f"d{i}"
        chain[rng.randrange(150)] = f"e{i}"
        texts.append(" ".join(chain))
    texts += [" ".join(hot + [f"u{rng.randrange(2000)}" for _ in range(rng.randrange(2, 40))]) for _ in range(150)]
    texts += [texts[3]] * 30 + [" ".join(f"v{rng.randrange(50)}" for _ in range(rng.randrange(6))) for _ in range(60)]
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed, nodes, queries_each", [(1, 256, 4096), (2, 8, 10)])
def test_join_against_all_pairs(spark, monkeypatch, seed, nodes, queries_each):
    monkeypatch.setattr(jaccard_join, "GROUP_NODES", nodes)
    monkeypatch.setattr(jaccard_join, "SLICE_QUERIES", queries_each)
    rows = clusters(seed)
    want = join_plain(rows)
    assert len({c for _, _, c in want}) < len(rows) - 150
    assert joined(frame(spark, rows).repartition(5)) == want


def test_group_counts_only_what_the_query_holds():
    member = np.arange(1, 21, dtype=np.uint64) << np.uint64(58)
    group = jaccard_join.Group({1: (1, member)})
    # 18 of 20 are shared; two others of the query lie just before one and the same of the member's.
    assert group.links(2, np.append(member[:18], member[18] - np.array([2, 1], np.uint64))) == []
    assert group.links(2, np.append(member[:19], member[19] + np.uint64(5))) == [1]


def test_hashes_of_words_and_bounds_of_sketches():
    rng = random.Random(4)
    words = ["a", "a\0", "a\0\0", "\0", "B", "b", "12345678", "123456781", "1234567812345678", "é" * 40, "x" * 64, "x" * 65, "x" * 200, "日本"]
    words += ["".join(rng.choice("ab\0") for _ in range(rng.randrange(1, 100))) for _ in range(300)]
    known = {}
    for _ in range(20):
        rng.shuffle(words)
        raw = rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t\x0b", "\r\n "]).join(words)
        found = jaccard_join.word_hashes(raw.lower().encode())
        for w, h in zip(raw.lower().encode().split(), found.tolist(), strict=True):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    assert all(len(jaccard_join.word_hashes(raw)) == 0 for raw in (b"", b" ", b"\n\t "))
    for size in (1, 50, 3000, 60_000):
        a, b = (np.random.default_rng(size + k).integers(0, 2 * size, size).astype(np.uint64) for k in (0, 1))
        a, b = np.unique(a), np.unique(b)
        sketches = [np.frombuffer(jaccard_join.sketch_of(x), np.uint8)[None] for x in (a, b)]
        assert jaccard_join.most_common(*sketches)[0] >= len(np.intersect1d(a, b))


def test_texts_travel_told_or_joined(spark, monkeypatch):
    rows = clusters(3)
    want = join_plain(rows)
    assert joined(frame(spark, rows).repartition(3)) == want
    monkeypatch.setattr(jaccard_join, "TOLD_TEXTS", 0)
    assert joined(frame(spark, rows).repartition(3)) == want


def test_join_of_the_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = join_plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(queries.op11_jaccard_join(spark, SMALL), "doc_id", "n_shingles", "component_id") == want


# -- resampling ----------------------------------------------------------------------------

PUNCT = "A-b_c.d\x00e\x7fé[日本]0x9 " * 7


def words_plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def resampled_plain(rows, target, percent=10, min_words=20, longest=1, buckets=10_000):
    def found(text):
        words = words_plain(text)
        runs = (" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1))
        return [zlib.crc32(r.encode()) % buckets for r in runs]

    s = Counter(b for _, t in rows for b in found(t))
    t = Counter(b for text in target for b in found(text))
    S, T = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)
    ]
    out, able = [], []
    for n, (doc_id, text) in enumerate(rows):
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found(text))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found(text)), weight, score, None])
        if len(words_plain(text)) >= min_words:
            able.append((-score, doc_id is None, doc_id or 0, n))
    for rank, (*_, n) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        out[n][4] = rank
    return Counter(map(tuple, out))


DRAWN = ["doc_id", "n_features", "weight", "score", "rank"]


def test_resampling_on_awkward_rows(spark):
    rows = TEXTS + [(50 + i, " ".join(["many words, of_a LONG text"] * 5000)) for i in range(3)] + [(50, PUNCT)] * 2
    target = ["some words of a text", None, "passage word1"]
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    for percent, longest in ((10, 1), (50, 2), (100, 1)):
        got = resampling.resampled(frame(spark, rows).repartition(3), aims, percent=percent, longest=longest)
        assert rows_of(got, *DRAWN) == resampled_plain(rows, target, percent, 20, longest)
    got = resampling.resampled(frame(spark, rows), aims.limit(0))
    assert rows_of(got, *DRAWN) == resampled_plain(rows, [])
    assert resampling.resampled(frame(spark, []), aims).count() == 0





def test_resampling_of_the_documents(spark):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = resampled_plain(rows, [r["text"] for r in bench.collect()])
    assert rows_of(queries.op12_resampling(spark, SMALL), *DRAWN) == want
    ranks = {d: r for d, *_, r in want if r}
    drawn = resampling.drawn_documents(docs, bench).collect()
    assert {r["doc_id"]: r["rank"] for r in drawn} == ranks and {(r["doc_id"], r["text"]) for r in drawn} <= set(rows)


@pytest.mark.parametrize("restage", [2, 16])
def test_cutoff_is_the_sorted_one(spark, monkeypatch, restage):
    monkeypatch.setattr(resampling, "RESTAGE", restage)
    rng = random.Random(restage)
    rows = [(rng.choice([0, rng.randrange(-50, 50)]), rng.randrange(2), rng.randrange(5), n) for n in range(2000)]
    keys = spark.createDataFrame(rows, "drop long, unknown long, id long, row long").repartition(7)
    rows.sort()
    for place in (0, 1, 700, 1999):
        assert resampling.cutoff(keys, place) == rows[place]


# -- vector codes --------------------------------------------------------------------------


def coded_plain(rows, entries=256, rounds=4, parts=4):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in kept]
    if not whole:
        return Counter()
    size = len(whole[0][1]) // parts
    first = sorted(whole, key=lambda r: r[0])[:entries]

    def nearest(point, book):
        far = [sum((a - b) ** 2 for a, b in zip(point, entry)) for entry in book]
        return min(zip(far, range(len(far))))

    cut = [[v[p * size : (p + 1) * size] for _, v, _ in whole] for p in range(parts)]
    books = [[v[p * size : (p + 1) * size] for _, v, _ in first] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            owned = defaultdict(list)
            for point in cut[p]:
                owned[nearest(point, books[p])[1]].append(point)
            for e, points in owned.items():
                books[p][e] = [sum(c) // len(points) for c in zip(*points)]
    last = [[nearest(point, books[p]) for point in cut[p]] for p in range(parts)]
    errors = [sum(last[p][n][0] for p in range(parts)) for n in range(len(whole))]
    by_label = Counter()
    for (_, _, label), e in zip(whole, errors):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter(
        (i, "".join(f"{last[p][n][1]:02x}" for p in range(parts)), errors[n], by_label[label], digest)
        for n, (i, _, label) in enumerate(whole)
    )


CODED = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    more = ("id", "code", "vector", "found", "name", "n", "error")
    return spark.createDataFrame(rows, VECTORS).select("*", *[F.lit(None).cast("int").alias(m) for m in more])


def test_codes_on_awkward_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(60)]
    rows += [(100 + i, rows[5][1], 1) for i in range(200)] + [(5, rows[5][1], 1)]
    rows += [(900, None, 1), (901, [None] + [0.0] * 7, 2), (902, [math.nan] + [0.0] * 7, 2), (903, [math.inf] + [1.0] * 7, 2)]
    rows += [(904, [0.0] * 8, None), (905, [1e4, -1e4] * 4, None)]
    rng.shuffle(rows)
    got = vector_codes.coded(vectors(spark, rows).repartition(4))
    assert rows_of(got, *CODED) == coded_plain(rows)
    assert vector_codes.coded(vectors(spark, [])).count() == 0
    assert vector_codes.coded(vectors(spark, [(1, None, 1)])).count() == 0


def test_codes_of_other_widths_are_null(spark):
    rows = [(1, [1.0] * 8, 1), (2, [1.0] * 4, 1), (3, [1e30] * 8, 2), (4, [], None)]
    got = {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in vector_codes.coded(vectors(spark, rows)).collect()}
    assert got == {1: ("00000000", 0, 0), 2: (None, None, 0), 3: (None, None, None), 4: (None, None, None)}
    odd = vector_codes.coded(vectors(spark, [(1, [1.0] * 5, 1)])).collect()
    assert [(r["vec_id"], r["code"]) for r in odd] == [(1, None)]


def test_codes_of_the_embeddings(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label")
    want = coded_plain([tuple(r) for r in table.collect()])
    assert rows_of(queries.op13_vector_codes(spark, SMALL), *CODED) == want


def test_limb_products_are_exact():
    rng = np.random.default_rng(1)
    for bits, width in ((10, 3), (29, 16), (20, 700)):
        a, b = (rng.integers(-(1 << bits), 1 << bits, (5, width)) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert vector_codes.exact_products(a, b).tolist() == want


def test_limbs_of_both_signs_end():
    def late(*_):
        raise TimeoutError

    before = signal.signal(signal.SIGALRM, late)
    signal.setitimer(signal.ITIMER_REAL, 5)
    try:
        for values in ([-1, 1], [-5, 0, 3], [-(1 << 40), (1 << 40) - 1], [-256, 255], [-1, -1], [0]):
            for bits in (8, 24):
                parts = vector_codes.limbs(np.array(values, np.int64), bits)
                assert all(np.abs(p).max() <= 1 << bits for p in parts)
                assert [sum(int(p[i]) << (bits * k) for k, p in enumerate(parts)) for i in range(len(values))] == values
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)
