"""Hard negatives, exact dedup and periodic runs against plain versions on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from edge_cases import documents, embeddings
from pyspark.sql import functions as F

from avmatch.llm import exact_dedup, periodic_runs, rns_negatives
from avmatch.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ---- hard negatives


def plain_negatives(rows, k=5, every=100, low=80, scale=256):
    """rows: (vec_id, vector, label)"""
    q = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows]
    out = []
    for n, (a, x, lab) in enumerate(q):
        if a % every:
            continue
        scores = [(-sum(map(int.__mul__, x, y)), b, m, other) for m, (b, y, other) in enumerate(q) if m != n and len(x) == len(y)]
        scores = sorted((-max(-(2**63), min(2**63 - 1, -s)), *rest) for s, *rest in scores)
        for s, b, _, _ in [r for r in scores if r[3] == lab][:k]:
            found = [r for r in scores if r[3] != lab and low * -s <= 100 * -r[0] <= 100 * -s][:k]
            out += [(a, b, rank, r[1], -s, -r[0]) for rank, r in enumerate(found, 1)]
    return sorted(out, key=str)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def vectors(seed, n, width, spread=1.0, labels=3):
    rng = random.Random(seed)
    return [(k, [float(np.float32(rng.gauss(0, spread))) for _ in range(width)], rng.choice([0, 0, *range(labels)])) for k in range(n)]


def test_op11(spark, edge):
    usable = [(v, [float(np.float32(x)) for x in e], lab) for v, e, lab, *_ in embeddings() if v is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    usable = [(v, e, (lab + 1) % 10 if v % 7 == 0 else lab) for v, e, lab in usable]
    assert tuples(QUERIES["op11_rns_negatives"](spark, edge), *COLUMNS) == plain_negatives(usable)


@pytest.mark.parametrize("case", ["plain", "ties", "wide", "huge", "long"])
def test_negatives(spark, monkeypatch, case):
    """Many small cells; ties; scores beyond single precision, doubles and the long range; vectors wider than a run."""
    monkeypatch.setattr(rns_negatives, "LEAST", 512)
    monkeypatch.setattr(rns_negatives, "MOST", 2048)
    rows = {"plain": lambda: vectors(1, 600, 6), "ties": lambda: [(k, [1.0, float(k % 3), -1.0], k % 2) for k in range(400)], "wide": lambda: vectors(2, 120, 700), "huge": lambda: vectors(3, 300, 5, 1e6), "long": lambda: vectors(4, 200, 4, 1e30)}[case]()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    assert tuples(rns_negatives.mine(df, every=20), *COLUMNS) == plain_negatives(rows, every=20)


def test_negatives_without_labels(spark):
    rows = [(0, [1.0], None), (100, [1.0], None), (200, [1.0], 1), (300, None, 1), (400, [float("inf")], 1), (500, [1e308 * 10], 1)]
    assert rns_negatives.mine(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).count() == 0


@pytest.mark.parametrize(("width", "spread"), [(1, 9e3), (64, 900), (1000, 900), (64, 1e9)])
def test_residue_products(width, spread):
    rng = np.random.default_rng(7)
    q, c = np.floor(rng.normal(0, spread, (5, width))), np.floor(rng.normal(0, spread, (9, width)))
    want = [[max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(x, y, strict=True)))) for y in c] for x in q]
    scores = rns_negatives.Scores(q, c)
    assert scores.block(slice(0, 5), slice(0, 9)).tolist() == want
    assert scores.run * max((p - 1) // 2 for p in scores.primes) ** 2 < 2**24


# ---- exact dedup


def plain_groups(rows):
    """rows: (doc_id, text)"""
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[ \t\n\r\x0b\x0c]+", " ", t or "")].append(d)
    out = []
    for text, ids in groups.items():
        known = sorted(d for d in ids if d is not None)
        keep = known[0] if known else None
        out += [(d, keep, len(ids), k == 0, sha(text)) for k, d in enumerate([*known, *[None] * (len(ids) - len(known))])]
    return sorted(out, key=str)


DEDUP = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_op12(spark, edge):
    assert tuples(QUERIES["op12_exact_dedup"](spark, edge), *DEDUP) == plain_groups([(r[0], r[1]) for r in documents()])


def hot_rows():
    rng = random.Random(8)
    rows = [(k, "hot  text" if k % 3 == 0 else f"copy {rng.randrange(40)}" if k % 3 == 1 else f"own {k}") for k in range(3000)]
    rows += [(None, "hot text"), (None, "nobody"), (None, "nobody"), (5, "own 5"), (5, "own\t5"), (9000, None), (9001, ""), (9002, " "), (9003, "\n\n")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("counters", [4, 64, 4096])
def test_groups_with_heavy_hitters(spark, counters):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact_dedup.groups(df, counters).withColumn("text_sha256", F.lower(F.hex("digest")))
    assert tuples(got, *DEDUP) == plain_groups(rows)


@pytest.mark.parametrize("counters", [4, 64])
def test_winners_are_the_frequent_digests(spark, counters):
    """Every digest of more than one in `counters` rows, verified, and no other."""
    rows = hot_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    held = exact_dedup.stash(df.select("doc_id", exact_dedup.digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")), "test")
    want = {(s, n, k) for _, k, n, _, s in plain_groups(rows) if n * counters > len(rows)}
    got = exact_dedup.winners(held, counters).select(F.lower(F.hex("digest")), "size", "winner.doc_id").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) < counters


def test_groups_over_many_empty_partitions(spark):
    rows = hot_rows()[:40]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        got = exact_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(60), 8)
        assert tuples(got.withColumn("text_sha256", F.lower(F.hex("digest"))), *DEDUP) == plain_groups(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_deduplicate(spark):
    rows = [(d, t, k) for k, (d, t) in enumerate(hot_rows())]
    kept = exact_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, size int").repartition(5), 64)
    assert kept.columns == ["doc_id", "text", "size"]
    assert sorted((r[0], sha(re.sub(r"\s+", " ", r[1] or ""))) for r in kept.collect() if r[0] is not None) == sorted((d, s) for d, _, _, keep, s in plain_groups([r[:2] for r in rows]) if keep and d is not None)
    assert kept.where("doc_id is null").count() == 1


# ---- periodic runs


def plain_runs(w):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(12, 2 * q) and not any(all(w[x] == w[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(400):
        k, n = rng.choice([1, 2, 2, 3]), rng.randint(0, 90)
        w = [bytes([97 + rng.randrange(k)]) for _ in range(n)]
        if rng.random() < 0.5 and n:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        several = [w, w[::-1], [b"x"] * rng.randint(0, 30), w + w]
        assert periodic_runs.runs_of(several) == [plain_runs(x) for x in several]


def test_runs_of_fibonacci_words():
    x, y = [b"a"], [b"a", b"b"]
    while len(y) < 300:
        x, y = y, y + x
    assert periodic_runs.runs_of([y])[0] == plain_runs(y)


def test_positions():
    rng = random.Random(2)
    order = rng.sample(range(5000), 5000)
    held, known = periodic_runs.Positions(order[0]), {order[0]}
    for x in order[1:]:
        before, after = held.add(x)
        assert before == max((k for k in known if k < x), default=-1) and after == min((k for k in known if k > x), default=-1) if x % 50 == 0 else True
        known.add(x)
    assert [*held] == sorted(order) and held.size == 5000 and len(held.pieces) > 5


def plain_op13(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w) if n < 3000 else periodic_runs.runs_of([w])[0]
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *told, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(b" ".join(x for i, x in enumerate(w) if i not in drop).decode()))


OP13 = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_op13(spark, edge):
    want = [plain_op13(r[0], r[1]) for r in documents()]
    assert tuples(QUERIES["op13_periodic_runs"](spark, edge), *OP13) == sorted(want, key=str) and sum(r[1] for r in want) > 3


def test_runs_in_texts(spark, monkeypatch):
    """Runs at both ends, of long words, of other case; texts that are sorted in groups; null, empty and blank ones."""
    monkeypatch.setattr(periodic_runs, "TOGETHER", 40)
    long = "w" * 900
    texts = ["a " * 30, f"x {'a b ' * 9}y", f"{'A a ' * 6}", " \n".join([long + "1", long + "2"] * 7), None, "", " \t", "a " * 11, "one two three four five six " * 2, "é " * 12 + "ü"]
    out = {r["doc_id"]: r for r in periodic_runs.find_runs(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(1)).collect()}
    for k, t in enumerate(texts):
        w = (t or "").encode().split()
        runs = plain_runs(w)
        assert [tuple(r) for r in out[k]["runs"]] == runs
        drop = {i for s, size, q in runs for i in range(s + q, s + size)}
        assert out[k]["collapsed"] == b" ".join(x for i, x in enumerate(w) if i not in drop).decode()
    assert [len(out[k]["runs"]) for k in range(len(texts))] == [1, 1, 1, 1, 0, 0, 0, 0, 1, 1]
