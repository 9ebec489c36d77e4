"""Line dedup over overlapping three-line windows.

Each document's lines are hashed in windows of three consecutive lines.  Over
the whole table a window's first occurrence, by document id and position,
stays; every later one covers its three lines.  Covered positions are merged
into runs, and the runs are removed.

Only hashes are shuffled to find repeats.  They are aggregated by (window,
salt) before a second aggregation by window, and the repeats go back to their
occurrences by (window, salt), so a window that a third of all documents share
is spread over all salts.  The texts are shuffled once, to meet their covered
positions.

Defined results: a null text stays null (no lines); a text of fewer than three
lines has no window and stays; windows of blank lines only are ignored; rows
with the same id and text count as one document and all get its result; null
ids come first; of different texts under one id the one with the smaller hash
comes first; an empty table gives an empty one.  Every other column passes
through; the columns used inside have names of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a window.
WINDOW = 3
#: Parts that the occurrences of one window are spread over.
SALTS = 16


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("__ld_id"), F.col(text_col).cast("string").alias("__ld_text")).withColumn("__ld_key", F.xxhash64("__ld_text"))


def _windows(docs: DataFrame) -> DataFrame:
    """A row per window: document, position and 128 bits of hash."""
    lines = docs.select("__ld_id", "__ld_key", F.split("__ld_text", "\n").alias("__ld_lines")).filter(f"size(__ld_lines) >= {WINDOW}")
    parts = ", ".join(f"get(__ld_lines, i + {k})" for k in range(WINDOW))
    each = F.expr(
        f"transform(sequence(0, size(__ld_lines) - {WINDOW}), i -> struct(i AS pos, xxhash64({parts}) AS a, xxhash64(1, {parts}) AS b, trim(concat({parts})) <> '' AS filled))"
    )
    rows = lines.select("__ld_id", "__ld_key", F.inline(each)).filter("filled").drop("filled")
    return rows.withColumn("salt", F.pmod(F.xxhash64("__ld_id", "__ld_key", "pos"), F.lit(SALTS)).cast("int"))


def covered_windows(docs: DataFrame) -> DataFrame:
    """(id, key, pos) of every window that isn't its text's first occurrence."""
    windows = _windows(docs)
    where = F.struct("__ld_id", "__ld_key", "pos")
    by_salt = windows.groupBy("a", "b", "salt").agg(F.min(where).alias("first"), F.min(F.xxhash64("__ld_id", "__ld_key", "pos")).alias("low"), F.max(F.xxhash64("__ld_id", "__ld_key", "pos")).alias("high"))
    repeated = (
        by_salt.groupBy("a", "b")
        .agg(F.min("first").alias("first"), F.min("low").alias("low"), F.max("high").alias("high"), F.collect_set("salt").alias("salts"))
        .filter("low <> high")
        .select("a", "b", F.explode("salts").alias("salt"), "first")
    )
    return windows.join(repeated, ["a", "b", "salt"]).filter(~where.eqNullSafe(F.col("first"))).select("__ld_id", "__ld_key", "pos")


def _deduped(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with __ld_new (the text left), __ld_lines and __ld_removed (line counts)."""
    covered = covered_windows(_keyed(df, id_col, text_col)).groupBy("__ld_id", "__ld_key").agg(F.sort_array(F.collect_set("pos")).alias("__ld_starts"))
    covered = covered.select(F.col("__ld_id").alias("__ld_rid"), F.col("__ld_key").alias("__ld_rkey"), "__ld_starts")
    keyed = df.withColumn("__ld_key", F.xxhash64(F.col(text_col).cast("string")))
    joined = keyed.join(covered, F.col(id_col).eqNullSafe(F.col("__ld_rid")) & (F.col("__ld_key") == F.col("__ld_rkey")), "left")
    # between two covered windows lies a run of kept lines, which is empty where windows overlap or touch
    kept = F.expr(
        f"""transform(array(split({_quote(text_col)}, '\n')), lines -> flatten(transform(sequence(0, size(__ld_starts)), j ->
        slice(lines, if(j = 0, 0, get(__ld_starts, j - 1) + {WINDOW}) + 1,
        greatest(if(j = size(__ld_starts), size(lines), get(__ld_starts, j)) - if(j = 0, 0, get(__ld_starts, j - 1) + {WINDOW}), 0)))))[0]"""
    )
    total = F.size(F.split(F.col(text_col), "\n"))
    joined = joined.withColumn("__ld_kept", F.when(F.col("__ld_starts").isNotNull(), kept))
    return (
        joined.withColumn("__ld_new", F.when(F.col("__ld_starts").isNull(), F.col(text_col)).otherwise(F.array_join("__ld_kept", "\n")))
        .withColumn("__ld_lines", F.when(F.col(text_col).isNull(), 0).otherwise(total))
        .withColumn("__ld_removed", F.when(F.col("__ld_starts").isNull(), 0).otherwise(total - F.size("__ld_kept")))
    )


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the text that is left, n_lines before, n_removed and n_chars after."""
    out = _deduped(df.select(id_col, text_col), id_col, text_col)
    return out.select(
        F.col(id_col),
        F.col("__ld_new").alias(text_col),
        F.col("__ld_lines").cast("long").alias("n_lines"),
        F.col("__ld_removed").cast("long").alias("n_removed"),
        F.length("__ld_new").cast("long").alias("n_chars"),
    )


def remove_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``df`` with shortened texts and the same columns; ``chars_col`` follows the text if it is there."""
    changed = _deduped(df, id_col, text_col)
    out = []
    for name, kind in df.dtypes:
        if name == text_col:
            out.append(F.col("__ld_new").cast(kind).alias(name))
        elif name == chars_col:
            out.append(F.when(F.col("__ld_removed") > 0, F.length("__ld_new")).otherwise(F.col(name)).cast(kind).alias(name))
        else:
            out.append(F.col(_quote(name)))
    return changed.select(*out)


SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (
  SELECT doc_id, p, l[p + 1] || chr(10) || l[p + 2] || chr(10) || l[p + 3] AS k
  FROM (SELECT doc_id, l, unnest(range(0, greatest(len(l) - 2, 0))) AS p FROM d)
),
later AS (
  SELECT doc_id, p
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM w WHERE trim(replace(k, chr(10), '')) <> '')
  WHERE nth > 1
),
covered AS (SELECT DISTINCT doc_id, p + x AS i FROM later, (VALUES (0), (1), (2)) AS v(x)),
kept AS (
  SELECT e.doc_id, e.i, e.line
  FROM (SELECT doc_id, unnest(range(0, len(l))) AS i, unnest(l) AS line FROM d) e
  ANTI JOIN covered c ON e.doc_id = c.doc_id AND e.i = c.i
),
j AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t, count(*) AS n FROM kept GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(j.t, '') END AS text,
  coalesce(len(d.l), 0) AS n_lines, coalesce(len(d.l), 0) - coalesce(j.n, 0) AS n_removed,
  length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(j.t, '') END) AS n_chars
FROM d LEFT JOIN j ON d.doc_id = j.doc_id
"""
