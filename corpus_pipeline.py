"""A corpus pipeline: language ID, near-duplicate removal, secret masking, source mixing, BPE ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared folder and
read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avmatch.llm import bitmaps, bpe, langid, mixing, ngram_jaccard, secret_scan
from avmatch.llm.store import stash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MASK = "<secret>"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go: no letter, or too many n-grams that are new to the language told.

    So null, empty and blank texts go. Rows that repeat are judged one by one.
    """
    model = langid.fit(docs)
    return langid.predict(docs.select(*COLUMNS), model).where("accepted").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest doc_id stays.

    Texts without words are no one's copy and stay. Where the id that stays is that of several rows, those of equal text
    count once; rows of one id with other texts are taken for parts of one document and stay.
    """
    found = ngram_jaccard.join_classes(docs, n=5, percent=80)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = stash(found.groupBy("doc_id").agg(F.max(kept).alias("kept"), F.count_if(kept & (F.col("n_shingles") > 0)).alias("times")), "ids")
    # The ids that go are few: texts that are certainly not theirs stay where they are.
    gone = ids.where("not kept").select(F.col("doc_id").alias("_gone"))
    some, rows = bitmaps.split(docs.select(*COLUMNS), "doc_id", gone)
    rows = rows.unionByName(some.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti"))
    again = ids.where("times > 1").select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return rows
    same = F.col("doc_id").eqNullSafe(F.col("_again"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = rows.join(again.withColumn("_many", F.lit(True)), same, "left").withColumn("_many", F.coalesce("_many", F.lit(False)) & has_words).drop("_again")
    once = marked.where("_many").dropDuplicates(["doc_id", "text"])
    return marked.where("not _many").unionByName(once).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is replaced by a mark; documents stay."""
    rows = secret_scan.scan(docs.select(*COLUMNS))
    rows = rows.withColumn("text", secret_scan.masked(F.col("text"), F.col("spans"), MASK))
    return rows.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix takes them, in whole copies: from not at all to three times.

    Documents without words have no part in a mix of words and go.
    """
    times = mixing.copies(docs).select(F.col("doc_id").alias("_doc"), "times")
    rows = docs.select(*COLUMNS).join(times, F.col("doc_id").eqNullSafe(F.col("_doc"))).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids) of each document of the mix, a copy a row. Null texts have no ids."""
    rows = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]

#: SQL can't express the trained language model; the tests hold each stage, on its own input, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
    return docs
