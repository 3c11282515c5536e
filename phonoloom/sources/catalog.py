"""Readers of a tree of recordings, transcripts and labels. Schemas are explicit; contents are read only where asked for.

Defined results: a JSON file that is malformed, or no object, is ``valid = false`` and has null fields; an empty folder gives an
empty table; file names without an extension have the extension ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phonoloom.functions import paths, text

ALIGNED = "word_segments array<struct<word:string,start:double,end:double>>"
TRANSCRIPT = "language string, segments array<struct<text:string>>"
SCORES = "file string, analysis array<struct<label:string,score:double>>"
MERGED = "path string, sentence string, analysis array<struct<label:string,score:double>>"


def files(spark: SparkSession, root: str, extensions: list[str] | None = None, recursive: bool = True) -> DataFrame:
    """``path, modificationTime, length, rel_path, dir, base, ext`` of the files below ``root``; the content is never read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    rows = (rows if recursive else rows.option("pathGlobFilter", "*")).load(root).select("path", "modificationTime", "length")
    clean = F.regexp_replace("path", "^file:/+", "/")
    top = "/" + root.replace("file:", "").strip("/")
    rows = rows.withColumn("path", clean).withColumn("rel_path", F.substring(F.col("path"), len(top) + 2, 1 << 30))
    rows = rows.select("*", *paths.parts(F.col("rel_path")))
    return rows.filter(F.col("ext").isin(extensions)) if extensions else rows


def paired(rows: DataFrame, target: str, ext: str | None = None, flat: bool = False) -> DataFrame:
    """Adds ``out_path``: where each file's result goes, in the mirrored tree or flat, with its own or another extension."""
    name = F.concat_ws(".", "base", F.lit(ext) if ext else F.col("ext"))
    tree = F.when(F.lit(flat) | (F.col("dir") == ""), F.concat_ws("/", F.lit(target), name)).otherwise(F.concat_ws("/", F.lit(target), "dir", name))
    return rows.withColumn("out_path", tree)


def group_keys(rows: DataFrame) -> DataFrame:
    return rows.select("dir", "base").distinct()


def _contents(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return rows.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.decode("content", "UTF-8").alias("text"))


def texts(spark: SparkSession, root: str) -> DataFrame:
    """``path, text`` of the .txt files, in any case of the extension, whole."""
    return _contents(spark, root, "*.[tT][xX][tT]")


def text_lines(rows: DataFrame) -> DataFrame:
    return rows.select("path", F.posexplode(text.lines(F.col("text"))).alias("line_no", "line"))


def json_files(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """``path, valid, *fields`` of the .json files."""
    return parsed(_contents(spark, root, "*.json"), "text", schema).drop("text")


def parsed(rows: DataFrame, column: str, schema: str) -> DataFrame:
    bad = "_corrupt"
    got = rows.withColumn("_j", F.from_json(F.col(column), f"{schema}, {bad} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}))
    valid = F.col("_j").isNotNull() & F.col(f"_j.{bad}").isNull() & F.trim(column).startswith("{")
    names = [f.split()[0] for f in _fields(schema)]
    return got.withColumn("valid", F.coalesce(valid, F.lit(False))).select(*rows.columns, "valid", *(F.when(F.col("valid"), F.col(f"_j.{n}")).alias(n) for n in names))


def _fields(schema: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]


def class_map(spark: SparkSession, path: str) -> DataFrame:
    """``class, name`` of a CSV with a header: the first and the third column; shorter rows are left out."""
    rows = spark.read.schema("a string, b string, c string").option("header", "true").csv(path)
    return rows.filter("c IS NOT NULL").select(F.col("a").try_cast("int").alias("class"), F.col("c").alias("name"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor begin with '#'."""
    rows = spark.read.text(path).select(text.strip(F.col("value")).alias("url"))
    return rows.filter((F.col("url") != "") & ~F.col("url").startswith("#"))


def to_download(urls: DataFrame, archive: DataFrame) -> DataFrame:
    """URLs that the archive does not hold yet. Fetching them needs a network and a downloader, which are not part of this."""
    return urls.join(archive, "url", "left_anti")


def needs(rows: DataFrame, done_ext: str) -> DataFrame:
    """Files without a sibling of another extension."""
    done = rows.filter(F.col("ext") == done_ext).select("dir", "base")
    return rows.filter(F.col("ext") != done_ext).join(done, ["dir", "base"], "left_anti")


def present(c: Column) -> Column:
    """``missing``, ``empty`` or ``ok`` of a list."""
    return F.when(c.isNull(), "missing").when(F.size(c) == 0, "empty").otherwise("ok")
