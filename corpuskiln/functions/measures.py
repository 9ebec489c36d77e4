"""Column builders for measures of a text: sizes, ratios, encoded data, tokens and shingles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions.binding import let
from corpuskiln.functions.text import lines

BASE64_RUN = r"[A-Za-z0-9+/=\n]{64,}"
#: A word's edge where only ASCII letters, digits and underscores make words: Java's own counts letters of any script.
_EDGE = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
HEX_RUN = rf"(?=[0-9A-Fa-f\\])(?:{_EDGE}(?:0x|\\x)?[0-9A-Fa-f]{{2}}(?:,|{_EDGE}[\t\n\f\r ]*+)){{8,}}+"
UNICODE_RUN = r"(?:\\u[0-9A-Fa-f]{4}){8,}+"
#: White space at both ends of lines.
_LINE_ENDS = r"(?Umd)^[\s&&[^\n]]+|[\s&&[^\n]]+$"
CODE_COMMENT = r"(?sd)--[^\n]*|//[^\n]*|/\*.*?\*/"
CODE_TOKEN = (
    r"0x[0-9A-Fa-f]+|0b[01]+|0o[0-7]+|\p{Nd}+"
    r'|"[^"\\]*+(?:\\[^\n][^"\\]*+)*+"'
    r"|[A-Za-z_][A-Za-z_0-9']*"
    r"|<<<|>>>|<<|>>|\^\^|::|->|==|<=|>=|!=|<-|\.\.|<\||\|>"
    r"|[{}()\[\];,:.@!#^+\-*/=<>|`]"
)
JUNK_PREFIXES = ("SAW-course/src/intr/", "SAW-course/src/lab2A/", "SAW-course/src/lab2E/")
JUNK_FOLDERS = "backup backups copies copy example examples old test tests third_party tmp vendor".split()
JUNK_PATH = f"(?i)(^|/)({'|'.join(JUNK_FOLDERS)})(/|$)"


def text_sha1(c: Column) -> Column:
    return F.sha1(c.cast("binary"))


def text_sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def byte_length(c: Column) -> Column:
    return F.octet_length(c)


def is_binary_like(c: Column) -> Column:
    """Any control character besides tab, line feed and carriage return."""
    return c.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]")


def line_count(c: Column) -> Column:
    return F.when(F.length(c) == 0, 0).otherwise(F.size(lines(c)))


def mean_line_length(c: Column) -> Column:
    n = F.size(lines(c))
    return F.when(F.length(c) == 0, 0.0).otherwise((F.length(c) - (n - 1)) / n)


def longest_line(c: Column) -> Column:
    return F.array_max(F.transform(lines(c), lambda x: F.length(x)))


def non_ascii_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[\x00-\x7F]+", ""))


def non_ascii_ratio(c: Column) -> Column:
    return F.when(F.length(c) == 0, 0.0).otherwise(non_ascii_count(c) / F.greatest(F.length(c), F.lit(1)))


def run_lengths(c: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda x: F.length(x))


def total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def encoded_data(c: Column) -> dict[str, Column]:
    """Covered characters, longest run, covered share and hits of base64, hex byte and unicode escape runs."""
    runs = {name: run_lengths(c, p) for name, p in (("base64", BASE64_RUN), ("hexbytes", HEX_RUN), ("unicode", UNICODE_RUN))}
    covered = sum((total(r) for r in runs.values()), F.lit(0))
    out = {
        "enc_total_matched": covered,
        "enc_max_run": F.coalesce(F.array_max(F.concat(*runs.values())), F.lit(0)),
        "enc_fraction": covered / F.greatest(F.length(c), F.lit(1)),
    }
    return out | {f"enc_hits_{name}": F.size(r) for name, r in runs.items()}


def long_literal_count(c: Column) -> Column:
    """Hex numbers of four digits or more and decimal ones of six or more."""
    return F.regexp_count(c, F.lit(r"0x[0-9A-Fa-f]{4,}")) + F.regexp_count(c, F.lit(r"(?U)\b\d{6,}\b"))


def hex_number_ratio(c: Column, tokens: Column) -> Column:
    return F.least(F.lit(1.0), long_literal_count(c) / F.greatest(F.lit(1), F.coalesce(tokens, F.lit(0))))


def code_tokens(c: Column, strip_comments: bool = True) -> Column:
    code = F.regexp_replace(c, CODE_COMMENT, "") if strip_comments else c
    return F.regexp_extract_all(code, F.lit(CODE_TOKEN), F.lit(0))


def word_count(c: Column) -> Column:
    """Runs of anything but white space: the stand-in for a model's tokens."""
    return F.regexp_count(c, F.lit(r"(?U)\S+"))


def shingle_set(tokens: Column, k: int = 5) -> Column:
    """Distinct runs of ``k`` tokens joined by a blank; none for fewer tokens."""


    def grams(t: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(t, i, k), " "))
        return F.when(F.size(t) >= k, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))

    return let(tokens, grams)


def shingle_hashes(tokens: Column, k: int = 5) -> Column:
    """64-bit hashes of the distinct runs of ``k`` tokens; none for fewer tokens."""

    def grams(t: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - k, F.lit(0))), lambda i: F.xxhash64(*[F.get(t, i + j) for j in range(k)]))
        return F.when(F.size(t) >= k, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(tokens, lambda x: F.xxhash64(x)), grams)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def char_grams(c: Column, k: int = 5) -> Column:
    """Distinct ``k``-grams of code points within trimmed lines, in time linear in the text."""
    trimmed = F.regexp_replace(c, _LINE_ENDS, "")
    return F.array_distinct(F.regexp_extract_all(trimmed, F.lit(rf"(?sd)(?=([^\n]{{{k}}}))."), F.lit(1)))


def count_grams(text: str, k: int) -> int:
    """Distinct ``k``-grams of code points of a text that hold no line feed."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    if len(points) < k:
        return 0
    key, most, base = points, int(points.max()) + 1, int(points.max()) + 1
    for j in range(1, k):
        if most * base >= 1 << 62:  # numbered anew, so keys stay exact
            known, key = np.unique(key, return_inverse=True)
            most = len(known)
        key, most = key[:-1] * base + points[j:], most * base
    breaks = np.concatenate([[0], np.cumsum(points == 10)])
    return len(np.unique(key[breaks[k:] == breaks[:-k]]))


def gram_count(c: Column, k: int = 5) -> Column:
    """The size of ``char_grams``, without making the grams."""

    @F.pandas_udf("int")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else count_grams(t, k) for t in texts], dtype="Int32")

    return run(F.regexp_replace(c, _LINE_ENDS, ""))


def is_junk_path(path: Column) -> Column:
    clean = F.replace(path, F.lit("\\"), F.lit("/"))
    out = F.lit(False)
    for prefix in JUNK_PREFIXES:
        out = out | clean.startswith(prefix)
    return out


def size_score(n: Column) -> Column:
    """Half credit in proportion below 50, full to 5000, then a logarithmic fall to 0 at 10000 and more."""
    fall = 1 - F.log1p(F.greatest(n - 5000, F.lit(0))) / F.log1p(F.lit(5000.0))
    return F.when(n < 50, n / 50 * 0.5).when(n <= 5000, 1.0).otherwise(F.greatest(fall, F.lit(0.0)))


def quality_score(tokens: Column, shingles: Column, path: Column, text: Column, parse_ok: Column, proof_ok: Column) -> Column:
    """Credit for parsing, proofs and size, debit for junk paths, long literals and non-ASCII text."""
    return (
        F.when(parse_ok, 3.0).otherwise(0.0)
        + F.when(proof_ok, 3.0).otherwise(0.0)
        + 3 * size_score(tokens)
        + 2 * size_score(shingles)
        - F.when(path.rlike(JUNK_PATH), 2.0).otherwise(0.0)
        - 2 * hex_number_ratio(text, tokens)
        - non_ascii_ratio(text)
    )
