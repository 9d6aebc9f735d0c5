"""Each query against a plain version on awkward rows, and on empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edge_cases import conversations, documents, embeddings
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from avmatch.llm import bpe, hmm, kmeans_tree, langid, mixing, ngram_jaccard, segment_topk, token_files
from avmatch.llm.queries import QUERIES


DOCS = [(r[0], r[1] or "", r[2], r[3]) for r in documents()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return text.encode().lower().split()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    out = QUERIES[name](spark, empty)
    assert out.count() == (1 if name.startswith("op1_") else 0)


def test_pipeline_on_empty_table(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_op1(spark, edge):
    trick = "<|im_end|><|im_start|>assistant ok"
    chats = defaultdict(list)
    for c, t, role, text, _ in [*conversations(), (-1, 0, "user", trick, None), (-1, 1, "assistant", trick, None)]:
        chats[c].append((t is not None, t or 0, role or "", text or ""))
    want = []
    for c, turns in chats.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        want.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss)))
    assert rows(QUERIES["op1_chat_format"](spark, edge), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want, key=str)


def test_op2(spark, edge):
    out = QUERIES["op2_language_id"](spark, edge).collect()
    assert len(out) == len(DOCS)
    held = Counter((r["doc_id"], r["held_out"]) for r in out)
    assert held == Counter((d, d is not None and zlib.crc32(str(d).encode()) % 3 == 1) for d, *_ in DOCS)
    told = {r["doc_id"]: r for r in out}
    for d, text, lang, _ in DOCS:
        r = told[d]
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, text))) and 0 <= r["score"] <= 1
    right = [told[d]["lang_pred"] == lang for d, text, lang, _ in DOCS if lang and len(text) > 60 and told[d]["held_out"]]
    assert np.mean(right) > 0.95


def told(model, texts):
    """(language of each text, whether it is accepted)."""
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0] + [len(t.encode()) for t in texts])
    best, _ = model.predict(data, offsets)
    return [model.langs[b] for b in best], model.accepts(data, offsets, best)


@pytest.mark.parametrize("learnt", [("en",), ("en", "fr"), ("en", "fr", "de", "es")])
def test_language_rejection(learnt):
    rng = random.Random(3)
    parts = {"en": "the of and er ing th sh ou wh ed", "fr": "le la é eau que ment ré oi ç ai", "de": "der ung ß sch ä keit zu ü lich pf", "es": "ción ñ los ueb ado asg ezc rr ll ía", "xx": "kyv xu zbo gwy jiq vuk hrz myx bwq fja"}
    text = lambda lang, n: " ".join("".join(rng.choices(parts[lang].split(), k=rng.randint(1, 3))) for _ in range(n))
    rows = [(k, lang, text(lang, rng.randint(5, 80)).encode()) for k, lang in enumerate(learnt * 120)]
    rows.append((4 * len(rows), "en", b"I"))  # no n-gram
    model = langid.train([langid.example(*r) for r in rows])
    for lang in learnt:
        got, kept = told(model, [text(lang, rng.randint(5, 80)) for _ in range(200)])
        assert np.mean(kept) >= 0.97 and np.mean(np.array(got) == lang) > 0.95
    assert told(model, [t.decode() for _, _, t in rows])[1].mean() > 0.99
    random_letters = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(60)) for _ in range(50)]
    assert not told(model, random_letters)[1].any()
    assert not told(model, [text("xx", 60) for _ in range(50)])[1].any()
    assert not told(model, ["".join(rng.choices("語言識別模型訓練資料", k=60)) for _ in range(20)])[1].any()


def test_language_rejection_of_odd_texts():
    model = langid.train([langid.example(k, "en", b"the other and the rest of them " * 3) for k in range(40)])
    texts = ["", "the rest of them and the other", "qzx jkw vbq xzk qqj wvz kxj", "the", "", "a" * 300]
    assert told(model, texts)[1].tolist() == [True, True, False, True, True, True]
    long = np.frombuffer(("the other rest " * 90_000).encode(), np.uint8)  # more than one run of bytes
    share, count = model.strange(long, np.array([0, len(long)]), np.array([0]))
    assert share[0] < 0.2 and count[0] > 1_000_000
    whole = langid.Grams.of(long)
    assert whole.fresh.sum() == pytest.approx(count[0], abs=4)


def test_op2_scores(spark, edge):
    """Predictions are the plain softmax of the mean embedding on the same weights."""
    model = langid.fit(spark.read.parquet(f"{edge}/documents.parquet").where(~langid.held_out()))
    out = {r["doc_id"]: r for r in QUERIES["op2_language_id"](spark, edge).collect()}
    for d, text, *_ in DOCS:
        if d is None or d == 7 or out[d]["lang_pred"] == "und":
            continue
        data, total, n = [c if c > 127 else c | 32 if chr(c).isalpha() else 32 for c in text.encode()], np.zeros(len(model.langs)), 0
        for size, odd in ((3, 0x9E3779B1), (4, 0x85EBCA77)):
            for k in range(len(data) - size + 1):
                part = data[k : k + size]
                if part == [32] * size:
                    continue
                h = int.from_bytes(bytes(part), "little") * odd & 0xFFFFFFFF
                h = (h ^ h >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
                total += model.table[max(1, h >> 32 - langid.BITS)]
                n += 1
        z = (total / max(1, n) + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert out[d]["lang_pred"] == model.langs[p.argmax()] and out[d]["score"] == pytest.approx(p.max(), abs=1e-6)


def usable(zero):
    return [(v, np.float32(e).astype(float)) for v, e, *_ in embeddings() if v is not None and e and all(x is not None and math.isfinite(x) for x in e) and (zero or any(e))]


def test_op3(spark, edge):
    q = [(v, np.floor(256 * x).astype(int)) for v, x in usable(True)]
    want = []
    for n, (a, x) in enumerate(q):
        if a % 50 == 0:
            best = sorted((-int(x @ y), b) for m, (b, y) in enumerate(q) if m != n and len(x) == len(y))[:5]
            want += [(a, k + 1, b, -s) for k, (s, b) in enumerate(best)]
    assert rows(QUERIES["op3_segment_topk"](spark, edge), "query_id", "rank", "vec_id", "score") == sorted(want, key=str)


def test_op3_repeated_ids(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert rows(segment_topk.search(table), "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 65536), (0, 2, 1, 65536), (0, 3, 1, 32768)]


@pytest.mark.parametrize("size", [1.0, 2.0**21, 2.0**200])
def test_op3_large_components(spark, size):
    rng = random.Random(1)
    data = [(k, [rng.choice([-1, 1]) * size * (1 + rng.randint(0, 2**20) / 2**20) for _ in range(6)]) for k in range(120)]
    q = [[math.floor(256 * x) for x in e] for _, e in data]
    want = []
    for a in range(0, 120, 50):
        best = sorted((-sum(x * y for x, y in zip(q[a], q[b], strict=True)), b) for b in range(120) if b != a)[:5]
        want += [(a, n + 1, b, min(2**63 - 1, -s)) for n, (s, b) in enumerate(best)]
    got = segment_topk.search(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    if size < 2.0**200:
        assert rows(got, "query_id", "rank", "vec_id", "score") == sorted(want, key=str)
    else:
        assert {r["score"] for r in got.collect()} == {2**63 - 1}


def test_op3_drops_pairs():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (20, 64))
    x = np.floor(256 * (centres[rng.integers(0, 20, 4000)] + rng.normal(0, 0.1, (4000, 64))))
    n = np.arange(4000)
    at, ids, score, products = segment_topk.best(x[:300], n[:300], np.full(300, -np.inf), x, n, n, 5)
    full = x[:300] @ x.T
    full[n[:300], n[:300]] = -np.inf
    assert sorted(zip(at.tolist(), score.tolist(), strict=True)) == sorted((k, int(s)) for k in range(300) for s in np.sort(full[k])[-5:])
    assert products < 0.75 * full.size  # the first block has nothing to be held against
    clusters = segment_topk.Clusters(n[::4], x[::4])
    floor = clusters.floors(n[:300], x[:300], 5)
    assert (floor <= np.sort(full, 1)[:, -5]).all()
    assert segment_topk.best(x[:300], n[:300], floor, x, n, n, 5)[3] < 0.15 * full.size


def test_op5(spark, edge):
    x = usable(False)
    got = defaultdict(list)
    for a, n, b, s in QUERIES["op5_kmeans_tree"](spark, edge).select("query_id", "rank", "vec_id", "score").collect():
        got[a].append((n, b, s))
    recall = []
    for a in {a for a, _ in x if a % 100 == 0}:
        (at,) = [n for n, (b, _) in enumerate(x) if b == a]
        best = sorted((float(np.sqrt(((x[at][1] - y) ** 2).sum())), b) for n, (b, y) in enumerate(x) if n != at and len(y) == len(x[at][1]))
        assert [n for n, _, _ in sorted(got[a])] == list(range(1, min(10, len(best)) + 1))
        far = defaultdict(list)
        for s, b in best:
            far[b].append(s)
        for _, b, s in got[a]:
            assert min(abs(s - y) for y in far[b]) <= 1e-12
        if best:
            recall.append(len({b for _, b in best[:10]} & {b for _, b, _ in got[a]}) / len({b for _, b in best[:10]}))
    assert set(got) <= {a for a, _ in x if a % 100 == 0} and np.mean(recall) >= 0.9


def test_op5_doubles_and_repeated_ids(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.5]), (1, [3.0, 0.0]), (100, [9.0, 0.0]), (100, [8.0, 0.0])], "vec_id long, embedding array<double>")
    out = kmeans_tree.search(table, k=2).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out) == [(0, 1, 1, 0.5), (0, 2, 1, 2.0), (100, 1, 100, 1.0), (100, 1, 100, 1.0), (100, 2, 1, 5.0), (100, 2, 1, 6.0)]


def test_op4(spark, edge):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for d, text, *_ in sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*coder.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.append((d, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    out = QUERIES["op4_wavelet_files"](spark, edge)
    assert rows(out, "doc_id", "n_tokens", "ids_crc32") == sorted(want, key=str)
    placed = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in out.collect())
    assert [s for s, _, _ in placed] == list(np.cumsum([0] + [n for _, n, _ in placed])[:-1]) and sum(n for _, n, _ in placed) == start
    ids = [d for _, _, d in placed if d is not None]
    assert ids == sorted(ids)


def test_wavelet_reads():
    rng = np.random.default_rng(9)
    for n, bits, top in ((0, 4, 16), (1, 1, 2), (1500, 5, 20), (5000, 17, 70_001)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        file = token_files.Wavelet(token_files.build(ids, bits))
        assert file.whole().tolist() == ids.tolist() and [file.access(k) for k in range(0, n, 7)] == ids[::7].tolist()
        plane = (ids >> (bits - 1)) & 1
        for at in (0, n // 3, n):
            assert file.rank1(0, at) == plane[:at].sum()
        for bit in (0, 1):
            for k, at in list(enumerate(np.flatnonzero(plane == bit).tolist()))[::97]:
                assert file.select(0, bit, k) == at
        for token in {*ids[:5].tolist(), 3 % top}:
            where = np.flatnonzero(ids == token).tolist()
            assert file.count(token) == len(where) and file.count(token, n // 4, n // 2) == sum(n // 4 <= w < n // 2 for w in where)
            assert [file.locate(token, k) for k in range(min(5, len(where)))] == where[:5]
            with pytest.raises(IndexError):
                file.locate(token, len(where))
    with pytest.raises(ValueError, match="more than 16 bits"):
        token_files.build(np.array([1, 70_000], np.uint32), 16)
    assert token_files.bits_of(public_tokenizers.path("byte_bpe_50k.json"), 0) == 16


NEWER = ["\u1c89b", "x \U00010d50'll go \ua7cb1", "<|endoftext|>\ua7dc \u0378 It's", "plain", "Don't \U0001c8a0", "", "a'll\U00010d50"]


def test_newer_code_points():
    """Code points that the tokenizers library knows and Python's tables may not."""
    for path, coder in ((public_tokenizers.path("byte_bpe_50k.json"), token_files.Words), (public_tokenizers.path("word_bpe_49k.json"), bpe.Encoder)):
        library, mine = Tokenizer.from_file(path), coder(path)
        library.no_padding()
        library.no_truncation()
        if coder is bpe.Encoder:
            ids, n = mine.encode(NEWER)
        else:
            data = [t.encode() for t in NEWER]
            ids, n = mine.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0] + [len(x) for x in data]))
        want = [library.encode(t, add_special_tokens=False).ids for t in NEWER]
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want


def test_op6(spark, edge):
    count, own = Counter(), []
    for d, text, *_ in DOCS:
        toks = [*words(text), None]
        held = d is not None and zlib.crc32(str(d).encode()) % 5 == 1
        own.append((d, held, toks))
        if not held:
            count.update(toks)
    n, v = sum(count.values()), len(count)
    want = sorted((str(d), held, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for d, held, t in own)
    out = QUERIES["op6_hmm_score"](spark, edge).collect()
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], abs=1e-5)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_op6_scores(spark):
    """Scores are a plain scaled forward recursion on the model's own tables, and the model beats the base."""
    rng = random.Random(2)
    topics = [[f"{c}{k}" for k in range(40)] for c in "abc"]
    docs = [(d, " ".join(rng.choice(topics[d % 3]) for _ in range(rng.randint(1, 90)))) for d in range(150)] + [(200, None), (201, "new words only"), (202, "a1 " * 4000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = F.col("doc_id") % 5 == 1
    model, _ = hmm.fit(frame.where(~held))
    out = {r["doc_id"]: r for r in hmm.score_documents(frame, held).collect()}
    count = Counter(w for d, t in docs if d % 5 != 1 for w in [*words(t or ""), None])
    for d, text in docs:
        batch = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
        (_, tokens, tails, _), *_ = hmm.token_rows(batch)
        alpha, total = model.start, 0.0
        for k, (token, cls, tail) in enumerate(zip([*words(text or ""), None], model.classes(tokens, tails), tails, strict=True)):
            inside = 1.0 if cls < hmm.TOP else (count[token] + 0.5) / model.size[tail]
            alpha = (alpha if k == 0 else alpha @ model.move) * model.emit[:, cls]
            total += math.log10(alpha.sum() * inside)
            alpha = alpha / alpha.sum()
        assert out[d]["score"] == pytest.approx(total, rel=1e-9, abs=1e-9)
    kept = [out[d] for d in range(150) if d % 5 == 1]
    assert sum(r["score"] for r in kept) > sum(r["base_score"] for r in kept)


def test_op6_rare_end(spark, monkeypatch):
    """Few long texts: the end token is rarer than the TOP most frequent words."""
    monkeypatch.setattr(hmm, "TOP", 4)
    monkeypatch.setattr(hmm, "CLASSES", 4 + hmm.TAILS)
    rng = random.Random(8)
    docs = [(d, " ".join(f"w{min(rng.randint(0, 30), rng.randint(0, 30))}" for _ in range(400))) for d in range(12)]
    sample, shipped = [], [b.column(c) for b in hmm.ship_counts([pa.RecordBatch.from_arrays([pa.array([t for _, t in docs])], ["text"])], 1) for c in range(4)]
    counted = hmm.sum_counts(pa.Table.from_arrays(shipped, ["bucket", "hs", "cs", "ks"]))
    last = hmm.merge_summaries(pa.concat_tables([counted, counted.slice(0, 0)]))
    tops = list(zip(*(np.frombuffer(last[c][0].as_py(), kind).tolist() for c, kind in (("top_h", np.uint64), ("top_c", np.int64), ("top_k", np.uint16))), strict=True))
    n, v = (np.frombuffer(last[c][0].as_py(), np.int64) for c in "nv")
    model = hmm.Model(tops, n, v)
    types = len({w for _, t in docs for w in words(t)}) + 1
    assert len(model.counts) == 4 and model.counts[model.hashes == hmm.END].tolist() == [12]
    # Every token is in one class: its own or its tail's.
    assert model.counts.sum() + model.size.sum() == 12 * 401 + 0.5 * (types - 4 + hmm.TAILS)
    monkeypatch.setattr(hmm, "begin", lambda model, found: sample.extend(found))
    cloudpickle.register_pickle_by_value(hmm)  # workers get the small TOP too
    try:
        never = F.lit(False)
        out = hmm.score_documents(spark.createDataFrame(docs, "doc_id long, text string"), never).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(hmm)
    count = Counter(w for _, t in docs for w in [*words(t), None])
    assert len(sample) == len(docs) == len(out)
    for r in out:
        toks = [*words(dict(docs)[r["doc_id"]]), None]
        want = sum(math.log10((count[w] + 0.5) / (12 * 401 + 0.5 * (types + 1))) for w in toks)
        assert (r["n_known"], r["base_score"]) == (len(toks), pytest.approx(want, abs=1e-5))


def test_op7(spark, edge):
    out = QUERIES["op7_mix_sources"](spark, edge)
    size = defaultdict(int)
    for _, text, _, source in DOCS:
        size[source] += len(words(text))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    goal, left, free = {}, sum(size.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 3 * size[s]]
        for s in over or list(free):
            goal[s] = 3 * size[s] if over else weight[s] * level
            free.discard(s)
            left -= goal[s] if over else 0
    got = out.collect()
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"]) for r in got) == sorted((str(d), len(words(t)), size[s]) for d, t, _, s in DOCS)
    assert sorted({round(r["target"], 6) for r in got}) == sorted({round(g, 6) for g in goal.values()})
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert abs(sum(r["taken"] for r in got) - sum(goal.values())) <= 0.02 * sum(goal.values())
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    again = mixing.taken(docs.orderBy(F.xxhash64("text"), "doc_id").repartition(7))
    assert rows(out, "doc_id", "taken") == rows(again, "doc_id", "taken")
    by_source = defaultdict(int)
    for r in again.collect():
        by_source[r["source"]] += r["taken"]
    for s in names:  # each source takes what it should, but for a block a shard
        assert abs(by_source[s] - goal[s]) <= mixing.BLOCK * 2
    # Whole copies: within some documents' sizes of the target, but for the one source with a very long document.
    times = {r["doc_id"]: r["times"] for r in mixing.copies(docs).collect()}
    for s in set(names) - {"hot"}:
        sizes = [(times.get(d, 0), len(words(t))) for d, t, _, x in DOCS if x == s and d is not None]
        assert abs(sum(k * n for k, n in sizes) - goal[s]) <= 3 * max(n for _, n in sizes) and max(k for k, _ in sizes) <= 3


@pytest.mark.parametrize(("votes", "seats", "most"), [([5.0, 3, 1], 9, [9, 9, 9]), ([53.0, 24, 23], 7, [9, 9, 9]), ([10.0, 10, 1], 7, [2, 9, 9]), ([0.0, 0], 5, [3, 3]), ([1.0, 1, 1], 2, [1, 1, 1])])
def test_sainte_lague(votes, seats, most):
    held = [0] * len(votes)
    for _ in range(seats):
        best = max((n for n in range(len(votes)) if held[n] < most[n] and votes[n] > 0), key=lambda n: (votes[n] / (2 * held[n] + 1), -n), default=None)
        if best is not None:
            held[best] += 1
    assert mixing.sainte_lague(np.array(votes), seats, np.array(most)).tolist() == held


def test_op8(spark, edge):
    kinds = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]
    want = []
    for d, text, *_ in DOCS:
        found = sorted((m.start(), n, m.end(), kind) for n, (kind, p, g, least) in enumerate(kinds) for m in p.finditer(text) if len(m[g]) >= least)
        n = Counter(f[3] for f in found)
        want.append((d, n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in found))))
    out = QUERIES["op8_secret_scan"](spark, edge)
    assert rows(out, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=str)
    assert out.where("spans like '%hub:0:44%'").count() == 1


def test_op9(spark, edge):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coder.no_padding()
    coder.no_truncation()
    want = []
    for d, text, *_ in DOCS:
        ids = coder.encode(text, add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(coder.decode(ids, skip_special_tokens=False))))
    assert rows(QUERIES["op9_bpe"](spark, edge), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)


def near(docs, n, percent):
    """(sets, component of each id, links of each row)."""
    sets = []
    for d, text, *_ in docs:
        w = words(text)
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = {d: d for d, *_ in docs}
    links = [0] * len(docs)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = find(docs[i][0]), find(docs[j][0])
                root[max(a, b)] = min(a, b)
    return sets, {d: find(d) for d, *_ in docs}, links


def test_op10(spark, edge):
    docs = [r for r in DOCS if r[0] is not None]
    sets, component, links = near(docs, 4, 85)
    out = [r for r in QUERIES["op10_ngram_jaccard"](spark, edge).collect() if r["doc_id"] is not None]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out)
    assert got == sorted((d, len(s), component[d]) for (d, *_), s in zip(docs, sets, strict=True))
    assert len({r["component_id"] for r in out}) < len(out) - 10
    assert {r["doc_id"]: r["n_links"] for r in out if r["doc_id"] > 60} .items() >= {d: n for (d, *_), n in zip(docs, links, strict=True) if 70 <= d < 84}.items()


def test_op10_keeps_links_of_equal_tags(spark, monkeypatch):
    """Classes of one tag within a run are still different classes."""
    rng = random.Random(12)
    a, b = (" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60)) for _ in range(2))
    monkeypatch.setattr(ngram_jaccard, "tags", lambda size, a, b: np.full(len(size), 9, np.uint64))
    cloudpickle.register_pickle_by_value(ngram_jaccard)
    try:
        docs = spark.createDataFrame([(1, b), (2, a), (3, f"{a} extra")], "doc_id long, text string").coalesce(1)
        got = rows(ngram_jaccard.join_classes(docs, n=4, percent=85), "doc_id", "component_id", "n_links")
    finally:
        cloudpickle.unregister_pickle_by_value(ngram_jaccard)
    assert got == [(1, 1, 0), (2, 2, 1), (3, 2, 1)]


def test_op10_repeated_ids(spark):
    """One id with several texts, and null ids: every row has its own links."""
    rng = random.Random(13)
    text = lambda: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(80))
    a, b, c = text(), text(), text()
    data = [(5, a), (5, b), (6, f"{a} x"), (7, f"{b} x"), (None, f"{c} x"), (None, c), (None, f"{a} y"), (9, f"{c} y")]
    got = rows(ngram_jaccard.join_classes(spark.createDataFrame(data, "doc_id long, text string"), n=4, percent=85), "doc_id", "component_id", "n_links")
    assert got == sorted([(5, 5, 2), (5, 5, 1), (6, 5, 2), (7, 5, 1), (None, 9, 2), (None, 9, 2), (None, 5, 2), (9, 9, 2)], key=str)


def test_pipeline_near_duplicates_of_repeated_ids(spark):
    text = " ".join(f"w{k}" for k in range(50))
    data = [(3, text), (3, text), (8, text.upper()), (9, f"{text} more"), (4, "other words"), (5, None), (5, None)]
    docs = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [3, 4, 5, 5]


def test_pipeline(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, edge)
    letters = [d for d, t, *_ in DOCS if any(map(str.isalpha, t)) and len(t) > 100]
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert set(letters) <= set(ids) and kept.columns == corpus_pipeline.COLUMNS
    assert not [d for d in ids if d is not None and d not in (7,) and not any(map(str.isalpha, dict((r[0], r[1]) for r in DOCS)[d]))]
    one = corpus_pipeline.near_duplicates(spark, docs, edge)
    _, component, _ = near([r for r in DOCS if r[0] is not None], 5, 80)
    assert {r["doc_id"] for r in one.select("doc_id").collect()} - {None} == set(component.values())
    masked = {r["doc_id"]: r["text"] for r in corpus_pipeline.mask_secrets(spark, docs, edge).collect() if r["doc_id"] not in (None, 7)}
    spans = {r["doc_id"]: r["spans"] for r in QUERIES["op8_secret_scan"](spark, edge).collect()}
    for d, text, *_ in [(r[0], r[1]) for r in documents() if r[0] not in (None, 7)]:
        want, at = "", 0
        for start, stop in sorted((int(a), int(b)) for _, a, b in (x.split(":") for x in spans[d].split(",") if x)):
            if start >= at:
                want += text[at:start] + corpus_pipeline.MASK
            at = max(at, stop)
        assert masked[d] == (None if text is None else want + text[at:])
    assert sum(t is not None and "<secret>" in t for t in masked.values()) == 3
    mixed = corpus_pipeline.mix_sources(spark, docs, edge)
    times = {r["doc_id"]: r["times"] for r in mixing.copies(docs).collect()}
    assert mixed.columns == corpus_pipeline.COLUMNS
    want = Counter()
    for d, text, *_ in DOCS:
        want[d] += times.get(d, 0) * bool(words(text))
    assert Counter(r["doc_id"] for r in mixed.collect()) == +want
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coder.no_padding()
    coder.no_truncation()
    ids = {r["doc_id"]: (r["n_tokens"], r["ids"]) for r in corpus_pipeline.encode(spark, docs, edge).collect()}
    for d, text, *_ in DOCS:
        if d not in (None, 7):
            want = coder.encode(text, add_special_tokens=False).ids
            assert ids[d] == (len(want), want)
    # The whole: every stage on what the one before has written.
    step = docs
    for name, stage in corpus_pipeline.STAGES:
        step = corpus_pipeline.stash(stage(spark, step, edge), name)
    out = corpus_pipeline.run(spark, edge)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and out.count() > 0
    assert rows(out, *out.columns) == rows(step, *out.columns)
