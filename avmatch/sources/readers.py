"""Scans of dated snapshots: JSON arrays in file order, header-normalised CSV, pages and documents.

Paths are read by Spark or its file system API only, so they may lie in any store. Whole-file scans (JSON arrays,
pages) hold one file per row: their files are bounded by one crawl step.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from avmatch.functions import clean
from avmatch.operators import lookup

DATE_IN_PATH = r"/([0-9]{4}-[0-9]{2}-[0-9]{2})(?:/|$)"


def snapshot_dates(spark: SparkSession, path: str) -> list[str]:
    """Child folders of path that are dates, ascending; other names are ignored."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    return sorted(n for n in names if re.fullmatch(r"\d{4}-\d{2}-\d{2}", n))


def latest_snapshot(spark: SparkSession, path: str) -> str | None:
    """The newest dated folder, or None if the source has none: only it is read."""
    dates = snapshot_dates(spark, path)
    return f"{path.rstrip('/')}/{dates[-1]}" if dates else None


def path_date(column: str = "_metadata.file_path") -> Column:
    return F.try_to_timestamp(F.nullif(F.regexp_extract(column, DATE_IN_PATH, 1), F.lit("")), F.lit("yyyy-MM-dd")).cast("date")


def folder_of(parent: str, path: Column) -> Column:
    """The name of the folder right below `parent` in a path; null where the path has none."""
    return F.nullif(F.regexp_extract(path, rf"/{re.escape(parent)}/([^/]+)/", 1), F.lit(""))


def json_records(spark: SparkSession, paths: str | Sequence[str], schema: str, key: str | None = None) -> DataFrame:
    """Records of files that hold one array of objects, or (with key) an object with such a list or the bare list.

    Columns: the schema's, pos (order in the file), file_path and ingestion_date. A file that doesn't parse, or lacks
    the list, has no records.
    """
    files = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("file_path"))
    listed = F.from_json("value", f"array<struct<{schema}>>")
    if key:
        wrapped = F.from_json("value", f"struct<`{key}`: array<struct<{schema}>>>")[key]
        listed = F.when(F.trim("value").startswith("["), listed).otherwise(wrapped)
    rows = files.select("file_path", F.posexplode(listed).alias("pos", "r")).where("r is not null")
    return rows.select("r.*", "pos", "file_path", path_date("file_path").alias("ingestion_date"))


def header_key(name: str) -> str:
    """A header without BOM, white space runs as one blank, upper case."""
    return re.sub(r"\s+", " ", name.replace("﻿", "")).strip().upper()


def csv_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """A CSV's cells as text, with seq: ascending in file order. Short rows are padded, surplus cells dropped."""
    rows = spark.read.csv(paths, header=True, escape='"', multiLine=True, mode="PERMISSIVE")
    return rows.withColumn("seq", F.monotonically_increasing_id())


def registry_csv(spark: SparkSession, paths: str | Sequence[str], columns: Mapping[str, Sequence[str]], required: Sequence[str] = ()) -> DataFrame:
    """Columns by their header spellings (first filled one wins), as trimmed text; unknown headers are ignored.

    A header matches in upper case, with blanks and hyphens alike. A required column without any header is an error;
    other missing ones are null.
    """
    rows = csv_rows(spark, paths)
    found = {header_key(c).replace("-", " "): c for c in rows.columns}
    out = []
    for name, spellings in columns.items():
        held = [found[k] for k in (header_key(s).replace("-", " ") for s in spellings) if k in found]
        if name in required and not held:
            raise ValueError(f"no header for {name}: {', '.join(spellings)}")
        cells = [F.col(f"`{h}`") for h in dict.fromkeys(held)]
        out.append((clean.first_filled(*cells) if cells else F.lit(None).cast("string")).alias(name))
    return rows.select("seq", *out)


def slug(header: str, taken: set[str]) -> str:
    """A column name for an unknown header: csv_ and at most 60 characters, numbered on a clash."""
    base = re.sub(r"[^a-z0-9]+", "_", header_key(header).lower()).strip("_") or "column"
    base = f"c_{base}" if base[0].isdigit() else base
    name, n = f"csv_{base[:60]}", 2
    while name in taken:
        name, n = f"csv_{base[:60]}_{n}", n + 1
    return name


def dynamic_csv(spark: SparkSession, paths: str | Sequence[str], canonical: Mapping[str, tuple[str, str]]) -> DataFrame:
    """canonical: header -> (name, type). Those columns are typed (null where the header is missing), every other
    header becomes a text column csv_<slug>."""
    rows = csv_rows(spark, paths)
    kinds = {"string": clean.strip_nulls, "int": lambda x: clean.whole(clean.strip_nulls(x)), "date": lambda x: clean.fleet_date(clean.strip_nulls(x))}
    known = {header_key(h): v for h, v in canonical.items()}
    out, names = [], {name for name, _ in canonical.values()}
    seen = set()
    for c in rows.columns:
        if c == "seq":
            continue
        cell = F.col(f"`{c}`")
        if header_key(c) in known:
            name, kind = known[header_key(c)]
            out.append((kinds[kind](cell) if kind in kinds else clean.money(clean.strip_nulls(cell), kind)).alias(name))
            seen.add(name)
        else:
            name = slug(c, names)
            names.add(name)
            out.append(clean.strip_nulls(cell).alias(name))
    missing = [F.lit(None).cast(kind).alias(name) for name, kind in canonical.values() if name not in seen]
    return rows.select("seq", *out, *missing)


def row_range(rows: DataFrame, order: str, offset: int, limit: int | None) -> DataFrame:
    out = rows.orderBy(order).offset(offset)
    return out if limit is None else out.limit(limit)


def html_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, file_name, html, ingestion_date) of every *.html below path; page_id is the file's path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(F.col("path").alias("page_id"), name.alias("file_name"), F.decode("content", "UTF-8").alias("html"), path_date("path").alias("ingestion_date"))


def page_kind(name: Column) -> Column:
    """struct(kind, id) from a saved page's name: page_0012, listing_<id> or make_model_<id>."""
    kind = F.regexp_extract(name, r"^(page|listing|make_model)_", 1)
    return F.struct(F.nullif(kind, F.lit("")).alias("kind"), F.nullif(F.regexp_extract(name, r"^(?:page|listing|make_model)_([^.]+)", 1), F.lit("")).alias("id"))


def done_pages(spark: SparkSession, path: str) -> DataFrame:
    """Sorted page numbers that are held already; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", True).load(path).select("path")
    n = F.nullif(F.regexp_extract("path", r"page_(\d+)\.html$", 1), F.lit("")).try_cast("int")
    return files.select(n.alias("page")).where("page is not null").distinct().orderBy("page")


def documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file_path, file_name, file_size, file_hash) of files, one row per content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    rows = files.select(F.col("path").alias("file_path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.col("length").alias("file_size"), "content")
    return lookup.contents(rows).drop("copies")


def unknown_documents(found: DataFrame, known: DataFrame) -> DataFrame:
    """Documents whose content (source_platform, file_hash) is not known yet."""
    return found.join(known.select("source_platform", "file_hash"), ["source_platform", "file_hash"], "left_anti")


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, lines) of each text file, and the total in a row without a name."""
    rows = spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"))
    return rows.rollup("file_name").agg(F.count("*").alias("lines"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(kind, files, bytes) of a saved crawl."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    kind = F.coalesce(page_kind(F.regexp_extract("path", r"([^/]+)$", 1))["kind"], F.lit("other"))
    return files.groupBy(kind.alias("kind")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def seed_urls(listings: DataFrame, part: str = "/listing/", block: str = "analytics") -> DataFrame:
    low = F.lower("listing_url")
    return listings.where(low.contains(part) & ~low.contains(block)).select("listing_url").distinct().orderBy("listing_url")
