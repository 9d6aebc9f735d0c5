"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

Subwords are the byte 3- and 4-grams of the text with A-Z lowered and every other ASCII byte a blank. A text's
vector is the mean of its subwords' embeddings; a linear softmax on it gives the language. Since both are linear,
tasks carry one table of embedding times weights, and whole texts stream through it.

Training reads a bounded sample of rows: about ``PER_LANG`` documents of each of the ``LANGS`` commonest languages,
drawn by a hash of doc_id against that language's share. Each is read whole, and comes to the driver as the counts of
its distinct n-grams (at most 2**``FINE``), with a few short cuts of it, since short texts must be told too. A quarter
of the sample is held back and calibrates: a temperature for the probabilities, and what share of a text's n-grams may be
new to the language it is told to be. Of each language, and of texts of about as many n-grams, the limit keeps ``KEEP``
of the held-back rows, and short cuts of them, that were told right; a longer text's limit also holds for shorter ones,
and none is below ``SLACK``. An n-gram that repeats the one before it is not counted, and a text with fewer than
``FEW`` shows too little to be rejected. The held-back rows' n-grams are then known too.

Null texts and texts without a letter get ``und`` and score 0. With no labelled rows every text does. Rows that repeat
are told one by one; rows of one doc_id are in the sample together or not at all. A text of any length is read whole.
An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avmatch.llm import words as W
from avmatch.llm.worker import bounded, release, small_batches

BITS, DIM = 16, 16
PER_LANG, LANGS = 400, 1024
EPOCHS, RATE = 12, 0.5
#: Bits of an n-gram's place in the table of known ones; the share of rightly told rows that rejection keeps.
FINE, KEEP, FEW, BANDS = 20, 0.995, 8, 20
#: A share of new n-grams that is never held against a text: an odd word is no other language.
SLACK = 0.1
#: Rows that a limit needs: with fewer of its own length, those of shorter texts, which vary more, join in.
LEAST = round(1 / (1 - KEEP))
CUTS = (24, 80, 240)


def plain_table() -> np.ndarray:
    table = np.full(256, 32, np.uint8)
    table[97:123] = table[65:91] = np.arange(97, 123, dtype=np.uint8)
    table[128:] = np.arange(128, 256, dtype=np.uint8)
    return table


PLAIN = plain_table()


def subwords(data: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, int]]:
    """(bucket of each n-gram by its first byte, n). An n-gram of blanks has bucket 0."""
    b = PLAIN[data].astype(np.uint32)
    for n, odd in ((3, 0x9E3779B1), (4, 0x85EBCA77)):
        if len(b) < n:
            continue
        code = b[: len(b) - n + 1].copy()
        for k in range(1, n):
            code |= b[k : len(b) - n + 1 + k] << np.uint32(8 * k)
        blank = code == np.uint32(0x20202020 >> (32 - 8 * n))
        code *= np.uint32(odd)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code >>= np.uint32(32 - bits)
        np.maximum(code, np.uint32(1), out=code)
        code[blank] = 0
        yield code, n


def grams(data: np.ndarray, offsets: np.ndarray, bits: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket of each n-gram of a run of bytes, first n-gram of each text there, these texts). Texts lie end to end."""
    for lo in range(0, len(data), step):
        part = data[lo : lo + step + 3]
        for code, n in subwords(part, bits):
            code = code[: min(step, len(data) - lo)]
            at = lo + np.arange(len(code))
            of = np.searchsorted(offsets, at[[0, -1]], "right") - 1
            cuts = np.maximum(offsets[of[0] : of[1] + 1], lo) - lo
            used = np.flatnonzero(np.diff(np.append(cuts, len(code))) > 0)
            ends = offsets[of[0] + 1 : of[1] + 2]
            for k in ends - lo:  # n-grams that reach into the next text
                code[max(0, k - n + 1) : max(0, k)] = 0
            yield code, cuts[used], of[0] + used


class Grams(NamedTuple):
    """A text's distinct n-grams: their fine codes, how often each occurs, and how often not right behind itself."""

    code: np.ndarray
    count: np.ndarray
    fresh: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> Grams:
        codes, fresh = [np.zeros(0, np.uint32)], [np.zeros(0, bool)]
        for lo in range(0, len(data), 1 << 20):  # n-grams that start in this run of bytes
            for code, _ in subwords(data[lo : lo + (1 << 20) + 3], FINE):
                code = code[: 1 << 20]
                before = np.concatenate([np.zeros(1, code.dtype), code[:-1]])
                codes.append(code)
                fresh.append(code != before)
        code, new = np.concatenate(codes), np.concatenate(fresh)
        code, new = code[code > 0], new[code > 0]
        distinct, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
        return cls(distinct, count, np.bincount(inverse, new, len(distinct)).astype(np.int64))

    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets of the embedding table and their shares of the text."""
        at, inverse = np.unique(np.maximum(self.code >> np.uint32(FINE - BITS), 1), return_inverse=True)
        n = np.bincount(inverse, self.count, len(at))
        return at.astype(np.uint32), (n / max(1, n.sum())).astype(np.float32)


class Model:
    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray):
        self.langs, self.table, self.bias, self.temperature = langs, table, bias, 1.0
        self.known = np.zeros((1 << FINE, (len(langs) + 7) // 8), np.uint8)
        self.limits = np.ones((len(langs), BANDS))

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of logits for each text in data (texts end to end)."""
        rows = len(offsets) - 1
        total, count = np.zeros((rows, len(self.langs))), np.zeros(rows)
        for code, cuts, of in grams(data, offsets, BITS, max(1 << 16, (1 << 22) // max(1, len(self.langs)))):
            total[of] += np.add.reduceat(self.table[code], cuts, axis=0)
            count[of] += np.add.reduceat((code > 0).astype(np.float64), cuts)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def told(self, found: Grams) -> np.ndarray:
        """Logits of one text."""
        at, share = found.shares()
        return share.astype(np.float64) @ self.table[at] + self.bias

    def learn(self, found: Grams, lang: int) -> None:
        """The n-grams of a text are known in a language."""
        self.known[found.code, lang >> 3] |= np.uint8(1 << (lang & 7))

    def strange(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share of each text's n-grams that are new to its language, and how many it has."""
        new, count = np.zeros(len(lang)), np.zeros(len(lang))
        for code, cuts, of in grams(data, offsets, FINE, 1 << 20):
            counts = code > 0
            counts[1:] &= code[1:] != code[:-1]
            own = np.repeat(lang[of].astype(np.uint16), np.diff(np.append(cuts, len(code))))
            known = (self.known[code, own >> 3] >> (own & 7).astype(np.uint8)) & 1
            new[of] += np.add.reduceat((counts & (known == 0)).astype(np.int64), cuts)
            count[of] += np.add.reduceat(counts.astype(np.int64), cuts)
        return new / np.maximum(count, 1), count

    def accepts(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray) -> np.ndarray:
        share, count = self.strange(data, offsets, lang)
        return (count < FEW) | (share <= self.limits[lang, bands(count)])

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = softmax(self.logits(data, offsets) / self.temperature)
        best = p.argmax(1)
        return best, p[np.arange(len(p)), best]


def bands(count: np.ndarray) -> np.ndarray:
    """Texts of 2**k to 2**(k + 1) - 1 n-grams have band k."""
    return np.minimum(np.log2(np.maximum(count, 1)).astype(int), BANDS - 1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def example(doc: int, lang: str, text: bytes) -> tuple[int, str, list[Grams]]:
    """A row of the sample: the n-grams of the whole text, then of short cuts of it."""
    data = np.frombuffer(text, np.uint8)
    at = [int(W.mix(np.array([doc & (2**64 - 1)], np.uint64) + np.uint64(size))[0] % np.uint64(max(1, len(data) - size))) for size in CUTS]
    return doc, lang, [Grams.of(data), *(Grams.of(data[a : a + size]) for a, size in zip(at, CUTS, strict=True))]


def train(rows: list[tuple[int, str, list[Grams]]], seed: int = 11) -> Model:
    """rows: examples. Plain SGD, one text at a time, with a falling rate."""
    langs = sorted({lang for _, lang, _ in rows})
    if not langs:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    number = {lang: k for k, lang in enumerate(langs)}
    rng = np.random.default_rng(seed)
    held = [W.mix(np.array([doc & (2**64 - 1)], np.uint64))[0] % np.uint64(4) == 0 for doc, _, _ in rows]
    few = len(rows) <= 8
    cases = [(*t.shares(), number[lang]) for (_, lang, texts), h in zip(rows, held, strict=True) if few or not h for t in texts if len(t.code)]
    embed = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    embed[0] = 0
    weight, bias = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for k in rng.permutation(len(cases)):
            at, share, y = cases[k]
            x = share @ embed[at]
            z = x @ weight + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = weight @ p
            weight -= rate * np.outer(x, p)
            bias -= rate * 0.1 * p
            embed[at] -= rate * 4 * share[:, None] * back
    model = Model(langs, (embed @ weight).astype(np.float32), bias.astype(np.float64))
    checks = [row for row, h in zip(rows, held, strict=True) if h] or rows
    z, y = np.stack([model.told(texts[0]) for _, _, texts in checks]), np.array([number[lang] for _, lang, _ in checks])

    def loss(t: float) -> float:
        return float(-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean())

    model.temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    if not any(held) or all(held):
        return model  # nothing is held back: no limit can be told
    for (_, lang, texts), h in zip(rows, held, strict=True):
        if few or not h:
            model.learn(texts[0], number[lang])
    model.limits = limits(model, [t for _, _, texts in checks for t in texts], np.repeat(y, 1 + len(CUTS)))
    for _, lang, texts in checks:
        model.learn(texts[0], number[lang])
    return model


def limits(model: Model, texts: list[Grams], lang: np.ndarray) -> np.ndarray:
    """Largest share of new n-grams by language and band. A language that no text shows has the loosest of the others."""
    best = np.array([model.told(t).argmax() for t in texts])
    new = np.array([t.fresh[(model.known[t.code, k >> 3] >> (k & 7)) & 1 == 0].sum() for t, k in zip(texts, best.tolist(), strict=True)])
    count = np.array([t.fresh.sum() for t in texts])
    share = new / np.maximum(count, 1)
    use = (best == lang) & (count >= FEW)
    found = np.full((len(model.langs), BANDS), np.nan)
    for k, row in enumerate(found):
        mine, band = share[use & (lang == k)], bands(count[use & (lang == k)])
        for b in range(BANDS):
            low = next((a for a in range(b, 0, -1) if ((band >= a) & (band <= b)).sum() >= LEAST), 0)
            if len(near := mine[(band >= low) & (band <= b)]):
                row[b] = max(SLACK, np.quantile(near, KEEP, method="higher"))
        row[:] = np.fmax.accumulate(row[::-1])[::-1]
    told = ~np.isnan(found[:, 0])
    found[~told] = found[told].max(0) if told.any() else 1.0
    return found


def histograms(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.column_bytes(batch.column("text"))
        docs, langs = batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist()
        for k, (doc, lang) in enumerate(zip(docs, langs, strict=True)):
            _, _, texts = example(doc, lang, data[offsets[k] : offsets[k + 1]].tobytes())
            cells = [pa.array([[getattr(t, name).astype(np.uint32).tobytes() for t in texts]], pa.list_(pa.binary())) for name in Grams._fields]
            yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([lang], pa.string()), *cells], ["doc_id", "lang", *Grams._fields])


def fit(docs: DataFrame) -> Model:
    """A model from labelled rows of docs (doc_id, text, lang)."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null and doc_id is not null")
    counts = docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGS).collect()
    shares = {r["lang"]: min(1.0, PER_LANG / r["n"]) for r in counts}
    if not shares:
        return train([])
    share = F.create_map(*(F.lit(x) for lang, s in shares.items() for x in (lang, int(s * (1 << 30)))))
    few = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) < share[F.col("lang")])
    names = ", ".join(f"{x} array<binary>" for x in Grams._fields)
    rows = few.mapInArrow(lambda b: bounded(histograms(b)), f"doc_id long, lang string, {names}").collect()
    read = lambda r: [Grams(*(np.frombuffer(x, np.uint32) for x in cells)) for cells in zip(*(r[name] for name in Grams._fields), strict=True)]
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], *map(zlib.crc32, r["code"])))
    model = train([(r["doc_id"], r["lang"], read(r)) for r in rows])
    del rows
    release()
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs (with a column text) and lang_pred, score, accepted; docs must not have these names."""
    small_batches(docs.sparkSession)

    def run(batches):
        ascii_letter = np.zeros(256, bool)
        ascii_letter[65:91] = ascii_letter[97:123] = True
        for batch in batches:
            data, offsets = W.column_bytes(batch.column("text"))
            for lo, hi in W.row_chunks(offsets, W.CHUNK):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                rows = batch.slice(lo, hi - lo)
                if model.langs:
                    best, score = model.predict(part, at)
                    like = model.accepts(part, at, best)
                else:
                    best, score, like = np.zeros(hi - lo, int), np.zeros(hi - lo), np.zeros(hi - lo, bool)
                seen = np.concatenate([[0], np.cumsum(ascii_letter[part])])
                has = seen[at[1:]] > seen[at[:-1]]
                for k in np.flatnonzero(~has & (np.diff(at) > 0)).tolist():
                    has[k] = any(map(str.isalpha, part[at[k] : at[k + 1]].tobytes().decode()))
                has &= bool(model.langs)
                lang = [model.langs[b] if h else "und" for b, h in zip(best.tolist(), has.tolist(), strict=True)]
                score = np.where(has, score, 0.0)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(has & like)], [*rows.schema.names, "lang_pred", "score", "accepted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lambda batches: bounded(run(batches)), f"{fields}, lang_pred string, score double, accepted boolean")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
