"""Column builders for text: layout, paths, hashes, fences and cheap comment rules.

Every builder takes and returns Columns and stays inside Catalyst.  Java
regular expressions get ``(?Ud)``: classes are Unicode and only ``\\n`` ends a
line, as in the text's own line model.  Loops over alternations are possessive,
so long literals can't exhaust the stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions.binding import let

LANGUAGES = {
    "python": (".py",), "javascript": (".js",), "typescript": (".ts",), "java": (".java",), "c": (".c", ".h"), "cpp": (".hpp", ".cpp", ".cc"),
    "go": (".go",), "rust": (".rs",), "ruby": (".rb",), "php": (".php",), "shell": (".sh", ".bash", ".zsh"), "powershell": (".ps1",), "sql": (".sql",),
    "css": (".css", ".scss"), "markdown": (".md",), "text": (".txt",), "yaml": (".yaml", ".yml"), "cryptol": (".cry",), "saw": (".saw",), "lean": (".lean",), "haskell": (".hs",),
}
SLICE_PREFIX = "cryptol_slices/"
LEGAL_WORDS = ("copyright", "license", "warranty", "apache", "mit", "bsd", "gnu")
DOC_WORDS = ("args", "parameters", "returns", "example", "usage", "invariant", "precondition", "postcondition", "proof", "spec")
_COMMENT_LINE = r"^\s*(//|#|--|;|/\*|\*)"


def strip(c: Column) -> Column:
    """White space trimmed at both ends, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def normalize_newlines(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def replace_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\x00"), F.lit("�"))


def decode_utf8(binary: Column) -> Column:
    """Bytes as text; malformed sequences become U+FFFD."""
    return F.make_valid_utf8(binary.cast("string"))


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def collapse_blank_lines(c: Column, strip_leading: bool = True) -> Column:
    """Runs of blank lines become one empty line; leading ones go if asked."""
    kept = let(
        lines(c),
        lambda each: F.filter(
            F.transform(each, lambda x, i: F.struct(x.alias("x"), (is_blank(x) & F.when(i > 0, is_blank(F.get(each, i - 1))).otherwise(F.lit(False))).alias("again"))),
            lambda s: ~s["again"],
        ),
    )
    joined = F.array_join(F.transform(kept, lambda s: F.when(is_blank(s["x"]), F.lit("")).otherwise(s["x"])), "\n")
    return F.regexp_replace(joined, r"^\n", "") if strip_leading else joined


def separation_policy(c: Column) -> Column:
    """No blank lines at the start or between code and code, one at most elsewhere, one line feed at the end."""
    kept = F.filter(F.transform(lines(c), lambda x, i: F.struct(x.alias("x"), i.alias("i"), x.rlike("(?U)" + _COMMENT_LINE).alias("comment"))), lambda s: ~is_blank(s["x"]))

    def with_gap(full: Column, s: Column, k: Column) -> Column:
        before = F.get(full, k - 1)
        gap = (k > 0) & (s["i"] - before["i"] > 1) & (s["comment"] | before["comment"])
        return F.when(F.coalesce(gap, F.lit(False)), F.concat(F.lit("\n"), s["x"])).otherwise(s["x"])

    rows = let(kept, lambda full: F.transform(full, lambda s, k: with_gap(full, s, k)))
    return F.concat(F.array_join(rows, "\n"), F.lit("\n"))


def strip_line_comments(c: Column) -> Column:
    """``//`` comments go, their line ends stay; string and character literals are left alone."""
    pattern = r"""(?s)("[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?\z)|'[^'\\]*+(?:\\.[^'\\]*+)*+(?:'|\\?\z))|//[^\n]*"""
    return F.regexp_replace(c, pattern, "$1")


def strip_copyrights(c: Column) -> Column:
    """Block comments that mention a copyright and ``//`` lines that do."""
    block = F.regexp_replace(c, r"(?is)/\*.*?copyright.*?\*/", "")
    return F.regexp_replace(block, r"(?imd)^.*//.*copyright.*$", "")


def language_of(path: Column) -> Column:
    """Language by the file's extension, else ``text``."""
    table = F.create_map(*[F.lit(v) for lang, exts in LANGUAGES.items() for ext in exts for v in (ext, lang)])
    extension = F.lower(F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]+)$", 1))
    return F.coalesce(F.try_element_at(table, extension), F.lit("text"))


def relative_path(path: Column, prefix: str) -> Column:
    """The path below ``prefix``, or the whole path if it isn't below it."""
    base = prefix.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(path)


def under_root(path: Column, root: str) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def fold_parent(path: Column) -> Column:
    """The last directory becomes part of the file's name."""
    return F.regexp_replace(path, r"([^/]+)/([^/]+)$", "$1_$2")


def add_slice_prefix(path: Column) -> Column:
    return F.when(path.startswith(SLICE_PREFIX), path).otherwise(F.concat(F.lit(SLICE_PREFIX), path))


def drop_slice_prefix(path: Column) -> Column:
    return F.when(path.startswith(SLICE_PREFIX), F.substring(path, len(SLICE_PREFIX) + 1, 1 << 30)).otherwise(path)


def repository_of(path: Column) -> Column:
    """First directory; the second below the folder of slices."""
    parts = F.split(F.regexp_replace(path, "^/+|/+$", ""), "/")
    return F.when((F.get(parts, F.lit(0)) == SLICE_PREFIX.rstrip("/")) & (F.size(parts) > 1), F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0)))


def source_of(path: Column) -> Column:
    """The source file that a derived file belongs to: of a slice, its directory with ``.cry``."""
    return F.when(path.startswith(SLICE_PREFIX), F.concat(F.regexp_replace(drop_slice_prefix(path), "/[^/]*$", ""), F.lit(".cry"))).otherwise(path)


def without_fences(c: Column) -> Column:
    """Markdown fences around a text go."""
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"^```[A-Za-z0-9_+-]*\s*", ""), r"\s*```$", ""))


def first_code_block(c: Column) -> Column:
    """Inside of the first fenced block, trimmed, else the trimmed text."""
    fence = r"(?is)```(?:[a-z0-9_+-]+)?[ \t]*\n(.*?)```"
    return strip(F.when(c.rlike(fence), F.regexp_extract(c, fence, 1)).otherwise(c))


def without_front_matter(c: Column) -> Column:
    return F.regexp_replace(c, r"(?sUd)\A---\s*\n.*?\n---\s*\n", "")


def excerpt(c: Column, most: int, marker: str = "\n... [truncated]") -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit(marker))).otherwise(c)


def keep_comment(c: Column, longest: int = 500) -> Column:
    """Whether the default policy keeps a comment, by the first rule that fires."""
    low = F.lower(c)
    contact = (F.length(c) > 1000) & F.contains(low, F.lit("http")) & F.contains(c, F.lit("@"))
    return (
        F.when(low.rlike("|".join(LEGAL_WORDS)), False)
        .when(contact, False)
        .when(low.rlike("|".join(DOC_WORDS)), True)
        .otherwise(F.length(c) < longest)
    )


def comment_rule(c: Column, longest: int = 500) -> Column:
    """Which rule of the default policy fires."""
    low = F.lower(c)
    contact = (F.length(c) > 1000) & F.contains(low, F.lit("http")) & F.contains(c, F.lit("@"))
    return (
        F.when(low.rlike("|".join(LEGAL_WORDS)), "legal")
        .when(contact, "contact")
        .when(low.rlike("|".join(DOC_WORDS)), "documentation")
        .when(F.length(c) < longest, "short")
        .otherwise("long")
    )


def wrapped_comment(c: Column, width: int = 78) -> Column:
    """Words wrapped to ``width`` with ``// `` before each line."""
    words = F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != "")
    room = width - 3
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("line"))

    def add(acc: Column, w: Column) -> Column:
        fits = (acc["line"] == "") | (F.length(acc["line"]) + 1 + F.length(w) <= room)
        return F.struct(
            F.when(fits, acc["done"]).otherwise(F.concat(acc["done"], F.lit("// "), acc["line"], F.lit("\n"))).alias("done"),
            F.when(fits, F.when(acc["line"] == "", w).otherwise(F.concat_ws(" ", acc["line"], w))).otherwise(w).alias("line"),
        )

    return F.aggregate(words, start, add, lambda acc: F.concat(acc["done"], F.when(acc["line"] == "", "").otherwise(F.concat(F.lit("// "), acc["line"]))))


def import_lines(c: Column) -> Column:
    return F.filter(lines(c), lambda x: F.ltrim(x).startswith("import "))


def estimated_tokens(c: Column, chars_per_token: float = 4.0) -> Column:
    """Code points over a ratio, rounded up; at least one for a text that isn't empty."""
    return F.when(F.length(c) == 0, 0).otherwise(F.greatest(F.lit(1), F.ceil(F.length(c) / F.lit(max(1e-6, chars_per_token))))).cast("int")


def has_module_header(code: Column) -> Column:
    return code.rlike(r"(?mUd)^\s*module\s+\S+(\s*=\s*\S+)?\s+where\s*$")
