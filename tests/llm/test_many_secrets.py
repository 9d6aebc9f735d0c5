"""Texts with very many secrets: placed in chunks, in time that grows with their number."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from avmatch.llm import secret_scan

HEX = re.compile("[0-9a-f]{24,}")


def text_of(n, seed=0):
    rng = random.Random(seed)
    return " é ".join("".join(rng.choices("0123456789abcdef", k=rng.randint(20, 30))) for _ in range(n))


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return secret_scan.scan(docs).withColumn("masked", secret_scan.masked(F.coalesce("text", F.lit("")), F.col("spans"), "<secret>"))


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_spans_across_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(secret_scan, "CHUNK", chunk)
    texts = [text_of(n, n) for n in (0, 1, 2, 7, 300)] + ["token=" + "ab12" * 8 + " 😀 secret: " + "0f" * 15, None, "0" * 24]
    for r in scanned(spark, texts).collect():
        text = texts[r["doc_id"]] or ""
        assert [(s["start"], s["stop"]) for s in r["spans"] if s["kind"] == "hex"] == [m.span() for m in HEX.finditer(text)]
        want, at = "", 0
        for s in r["spans"]:
            if s["start"] >= at:
                want += text[at : s["start"]] + "<secret>"
            at = max(at, s["stop"])
        assert r["masked"] == want + text[at:]


def test_time_grows_with_hits(spark):
    took = []
    for n in (2000, 16_000, 32_000):  # the first compiles
        began = time.perf_counter()
        spans, size = scanned(spark, [text_of(n)]).select(F.size("spans"), F.length("masked")).first()
        took.append(time.perf_counter() - began)
        assert spans == len(HEX.findall(text_of(n))) and size < 40 * n
    assert took[2] < 2.5 * took[1] + 1 and took[2] < 15
    print(took)
