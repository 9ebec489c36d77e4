"""Scans of source trees, text dumps and Markdown, and the sinks for their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.text import decode_utf8, normalize_newlines, relative_path, strip, under_root

RAW = "filename string, filetype string, content string"


def _local(c: Column) -> Column:
    return F.regexp_replace(c, "^file:/+", "/")


def crawl(spark: SparkSession, roots: Sequence[str], extensions: Sequence[str] = (".cry", ".saw"), prefix: str | None = None) -> DataFrame:
    """filename, filetype, content of the files below ``roots`` by extension in any case.

    Bytes that aren't UTF-8 become U+FFFD.  The path test runs before contents
    are read, as a filter on the scan's path column.
    """
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(roots))
    name = _local(F.col("path"))
    wanted = F.lower(name).rlike("(" + "|".join(e.replace(".", r"\.") for e in extensions) + ")$")
    out = relative_path(name, prefix) if prefix else name
    return scan.filter(wanted).select(out.alias("filename"), F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1)).alias("filetype"), decode_utf8(F.col("content")).alias("content"))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with null fields kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str = RAW) -> DataFrame:
    """JSON lines with a declared schema; malformed lines go."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def listed_files(df: DataFrame, root: str, column: str = "filename") -> DataFrame:
    """Distinct paths below ``root`` in the order they were first listed."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != "")).select(under_root(F.col(column), root).alias("path"), "row_ord").groupBy("path").agg(F.min("row_ord").alias("row_ord"))


def read_listed(spark: SparkSession, listed: DataFrame, root: str) -> DataFrame:
    """path, row_ord, content of listed files with line ends normalized; null where a file is missing."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").load(root)
    found = scan.select(_local(F.col("path")).alias("path"), normalize_newlines(decode_utf8(F.col("content"))).alias("content"))
    return listed.join(found, "path", "left")


def prefer_own(df: DataFrame, found: DataFrame) -> DataFrame:
    """The frame's own content where it has one, else the file's."""
    other = found.select("filename", F.col("content").alias("__file"))
    return df.join(other, "filename", "left").withColumn("content", F.coalesce(F.nullif(F.col("content"), F.lit("")), "__file")).drop("__file")


def delimited_blocks(texts: DataFrame, name: str = "path", text: str = "value") -> DataFrame:
    """Blocks between ``<%`` and ``%>``: the last non-blank line before one names it, else its file."""
    pattern = r"(?s)(.*?)<%(.*?)%>"
    before, inside = (F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(g)) for g in (1, 2))
    each = texts.select(F.col(name), F.posexplode(F.arrays_zip(before.alias("b"), inside.alias("c"))).alias("n", "x"))
    lines = F.filter(F.split("x.b", r"\r\n|\n|\r"), lambda l: l.rlike(r"(?U)\S"))
    title = F.when(F.size(lines) > 0, strip(F.element_at(lines, -1))).otherwise(F.substring_index(F.col(name), "/", -1))
    # of several blocks without a line of their own the title is that of the closest one before
    return each.select(title.alias("filename"), F.lit("text").alias("filetype"), strip(F.col("x.c")).alias("content"), "n", F.col(name).alias("source"))


def text_dumps(spark: SparkSession, folder: str, extension: str = ".txt") -> DataFrame:
    whole = spark.read.text(f"{folder}/*{extension}", wholetext=True).select(_local(F.col("_metadata.file_path")).alias("path"), "value")
    return delimited_blocks(whole)


def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    """source, text of every ``.md`` file below a folder, by path."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(folder)
    return scan.select(_local(F.col("path")).alias("source"), decode_utf8(F.col("content")).alias("text")).orderBy("source")


def definition_files(spark: SparkSession, folder: str, pattern: str = "*.json", recursive: bool = True) -> DataFrame:
    """json_path, json of every definition file."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).load(folder)
    return scan.select(_local(F.col("path")).alias("json_path"), decode_utf8(F.col("content")).alias("json"))


def associated_sources(scripts: DataFrame, listing: DataFrame) -> DataFrame:
    """filename, name, code: C and Java sources that scripts load, beside them.

    Of a module's sources the first extension counts; a name counts once a script.
    """
    folder = F.regexp_replace("filename", "[^/]*$", "")
    c = F.col("content")
    c_stems = F.transform(F.regexp_extract_all(c, F.lit(r'llvm_load_module\s+"([^"]+)"'), F.lit(1)), lambda x: F.regexp_replace(F.substring_index(x, "/", -1), r"\.[^.]*$", ""))
    classes = F.transform(F.regexp_extract_all(c, F.lit(r'java_load_class\s+"([^"]+)"'), F.lit(1)), lambda x: F.substring_index(x, ".", -1))
    wanted = scripts.select("filename", folder.alias("folder"), F.explode(F.concat(F.transform(c_stems, lambda x: F.struct(x.alias("stem"), F.lit("C").alias("lang"))), F.transform(classes, lambda x: F.struct(x.alias("stem"), F.lit("java").alias("lang"))))).alias("w")).distinct()
    order = {".c": 0, ".cc": 1, ".cpp": 2, ".cxx": 3, ".java": 0}
    extension = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    rank = F.try_element_at(F.create_map(*[F.lit(v) for k, r in order.items() for v in (k, r)]), extension)
    files = listing.select(
        F.regexp_replace("path", "[^/]*$", "").alias("folder"), F.regexp_extract("path", r"([^/]*)\.[^./]+$", 1).alias("stem"),
        F.when(extension == ".java", "java").otherwise("C").alias("lang"), rank.alias("rank"), F.substring_index("path", "/", -1).alias("name"), "code",
    ).filter("rank IS NOT NULL")
    met = wanted.select("filename", "folder", "w.stem", "w.lang").join(files, ["folder", "stem", "lang"])
    return met.groupBy("filename", "stem", "lang").agg(F.min_by(F.struct("name", "code"), "rank").alias("f")).select("filename", "f.name", F.concat(F.lit("```"), "lang", F.lit("\n"), "f.code", F.lit("\n```")).alias("code"))


def write_index(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV, JSON lines or Parquet by the path's suffix; CSV if it has none of them."""
    flat = df.coalesce(1) if path.endswith((".csv", ".json", ".jsonl")) else df
    writer = flat.write.mode(mode)
    if path.endswith(".parquet"):
        writer.parquet(path)
    elif path.endswith((".json", ".jsonl")):
        writer.option("ignoreNullFields", "false").json(path)
    else:
        writer.option("header", "true").csv(path)


def write_by(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """One folder per value: variants or splits."""
    df.write.mode(mode).partitionBy(column).parquet(path)


def add_to_collection(chunks: DataFrame, path: str, key: str = "id") -> None:
    """Append chunks whose id the collection doesn't have."""
    from corpuskiln.operators.keyed import exists

    spark = chunks.sparkSession
    if exists(spark, path):
        chunks = chunks.join(spark.read.parquet(path).select(key), key, "left_anti")
    chunks.dropDuplicates([key]).write.mode("append").parquet(path)
