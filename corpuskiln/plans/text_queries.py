"""Queries over text functions, measures and filters, each with its SQL.

The documents hold no source code, so queries on comments, fences and imports
build theirs from each document's own text with the same literals on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import measures as M
from corpuskiln.functions import text as X
from corpuskiln.operators import messages, quality
from corpuskiln.plans.registry import Registry, table

R = Registry()

#: Whole texts as files, and the pattern of SQL's view of them.
FILES = "SELECT source || '/' || doc_id AS filename, lang AS filetype, text AS content, doc_id AS row_ord FROM documents"
_B64, _UNI = r"[A-Za-z0-9+/=\n]{64,}", r"(?:\\u[0-9A-Fa-f]{4}){8,}"
_HEXB = r"(?:\b(?:0x|\\x)?[0-9A-Fa-f]{2}(?:,|\b\s*)){8,}"
_TOK = M.CODE_TOKEN.replace("*+", "*").replace(r"\p{Nd}", "[0-9]").replace("'", "''")
_CMT = r"(?s)--[^\n]*|//[^\n]*|/\*.*?\*/"


def _docs(spark, sf) -> DataFrame:
    return table(spark, sf, "documents")


def _files(spark, sf) -> DataFrame:
    return quality.as_files(_docs(spark, sf))


@R.add("exact_dedup", "SELECT doc_id, sha1(text) AS sha1, row_number() OVER (PARTITION BY sha1(text) ORDER BY doc_id) > 1 AS is_duplicate FROM documents")
def exact_dedup(spark, sf):
    rows = _docs(spark, sf).select("doc_id", M.text_sha1(F.col("text")).alias("sha1"))
    return quality.mark_duplicates(rows, "sha1", "doc_id").select("doc_id", "sha1", "is_duplicate")


@R.add("content_hashes", "SELECT doc_id, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents")
def content_hashes(spark, sf):
    return _docs(spark, sf).select("doc_id", M.text_sha1(F.col("text")).alias("sha1"), M.text_sha256(F.col("text")).alias("sha256"))


@R.add(
    "line_stats",
    """SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
    CASE WHEN text = '' THEN 0 ELSE list_sum(list_transform(string_split(text, chr(10)), lambda x: length(x))) END AS line_chars,
    list_max(list_transform(string_split(text, chr(10)), lambda x: length(x))) AS max_line_len FROM documents""",
)
def line_stats(spark, sf):
    c = F.col("text")
    return _docs(spark, sf).select("doc_id", M.line_count(c).alias("n_lines"), F.round(M.mean_line_length(c) * M.line_count(c)).cast("long").alias("line_chars"), M.longest_line(c).alias("max_line_len"))


@R.add("non_ascii_ratio", r"SELECT doc_id, length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) AS non_ascii, length(text) AS chars, CASE WHEN text = '' THEN 0.0 ELSE length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) / length(text) END AS non_ascii_ratio FROM documents")
def non_ascii_ratio(spark, sf):
    return _docs(spark, sf).select("doc_id", M.non_ascii_count(F.col("text")).alias("non_ascii"), F.length("text").alias("chars"), M.non_ascii_ratio(F.col("text")).alias("non_ascii_ratio"))


@R.add("binary_like", r"SELECT doc_id, regexp_matches(text || CASE WHEN doc_id % 7 = 0 THEN chr(1) ELSE '' END, '[\x00-\x08\x0B\x0C\x0E-\x1F]') AS binary_like FROM documents")
def binary_like(spark, sf):
    marked = F.concat("text", F.when(F.col("doc_id") % 7 == 0, F.lit("\x01")).otherwise(F.lit("")))
    return _docs(spark, sf).select("doc_id", M.is_binary_like(marked).alias("binary_like"))


_ENC_TEXT = "text || CASE WHEN doc_id % 3 = 0 THEN repeat('QUJD', 40) || ' ' || repeat('0xab,', 12) ELSE repeat(chr(92) || 'u00e9', doc_id % 11) END"


@R.add(
    "encoded_metrics",
    rf"""WITH d AS (SELECT doc_id, {_ENC_TEXT} AS t FROM documents),
    e AS (SELECT doc_id, t, list_transform(regexp_extract_all(t, '{_B64}'), lambda x: length(x)) AS a, list_transform(regexp_extract_all(t, '{_HEXB}'), lambda x: length(x)) AS b, list_transform(regexp_extract_all(t, '{_UNI}'), lambda x: length(x)) AS c FROM d)
    SELECT doc_id, coalesce(list_sum(a), 0) + coalesce(list_sum(b), 0) + coalesce(list_sum(c), 0) AS enc_total_matched, coalesce(list_max(list_concat(a, b, c)), 0) AS enc_max_run,
    len(a) AS enc_hits_base64, len(b) AS enc_hits_hexbytes, len(c) AS enc_hits_unicode FROM e""",
)
def encoded_metrics(spark, sf):
    extra = F.when(F.col("doc_id") % 3 == 0, F.lit("QUJD" * 40 + " " + "0xab," * 12)).otherwise(F.repeat(F.lit("\\u00e9"), (F.col("doc_id") % 11).cast("int")))
    d = _docs(spark, sf).select("doc_id", F.concat("text", extra).alias("t"))
    m = M.encoded_data(F.col("t"))
    return d.select("doc_id", *[m[k].alias(k) for k in ("enc_total_matched", "enc_max_run", "enc_hits_base64", "enc_hits_hexbytes", "enc_hits_unicode")])


@R.add("hexnum_ratio", r"SELECT doc_id, len(regexp_extract_all(text, '0x[0-9A-Fa-f]{4,}')) + len(regexp_extract_all(text, '\b[0-9]{6,}\b')) AS long_literals FROM documents")
def hexnum_ratio(spark, sf):
    return _docs(spark, sf).select("doc_id", M.long_literal_count(F.col("text")).alias("long_literals"))


@R.add("lang_tokens", f"SELECT doc_id, len(regexp_extract_all(regexp_replace(text, '{_CMT}', '', 'g'), '{_TOK}')) AS num_tokens_lang FROM documents")
def lang_tokens(spark, sf):
    return _docs(spark, sf).select("doc_id", F.size(M.code_tokens(F.col("text"))).alias("num_tokens_lang"))


@R.add("token_estimate", "SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE greatest(1, ceil(length(text) / 4.0)) END::INT AS tokens FROM documents")
def token_estimate(spark, sf):
    return _docs(spark, sf).select("doc_id", X.estimated_tokens(F.col("text")).alias("tokens"))


@R.add(
    "basic_metrics",
    r"""WITH d AS (SELECT doc_id, text AS t, list_transform(string_split(text, chr(10)), lambda x: trim(x)) AS l FROM documents)
    SELECT doc_id, strlen(t) AS bytes, len(l) AS lines, len(regexp_extract_all(t, '[A-Za-z_][A-Za-z0-9_]*')) AS num_tokens_lang,
    len(list_distinct(flatten(list_transform(l, lambda x: list_transform(range(1, greatest(length(x) - 3, 1)), lambda i: substring(x, i, 5)))))) AS num_shingles,
    len(regexp_extract_all(t, '[^\s]+')) AS num_tokens_model, coalesce(list_max(list_transform(regexp_extract_all(t, '[A-Za-z0-9+/=]+'), lambda x: length(x))), 0) AS enc_max_run FROM d""",
)
def basic_metrics(spark, sf):
    d = _docs(spark, sf).select("doc_id", F.col("text").alias("content"))
    return quality.basic_metrics(d).select("doc_id", "bytes", "lines", "num_tokens_lang", "num_shingles", "num_tokens_model", "enc_max_run")


def _verdict_sql(mean: float, longest: float) -> str:
    return rf"""WITH f AS ({FILES}),
    m AS (SELECT filename, row_ord, sha1(content) AS sha1, strlen(content) AS bytes, CASE WHEN content = '' THEN 0 ELSE len(string_split(content, chr(10))) END AS lines,
      CASE WHEN content = '' THEN 0.0 ELSE (length(content) - len(string_split(content, chr(10))) + 1) / len(string_split(content, chr(10))) END AS avg_line_len,
      list_max(list_transform(string_split(content, chr(10)), lambda x: length(x))) AS max_line_len,
      regexp_matches(content, '[\x00-\x08\x0B\x0C\x0E-\x1F]') AS binary_like, length(regexp_replace(content, '[\x00-\x7F]', '', 'g')) / greatest(length(content), 1) AS na,
      list_concat(list_transform(regexp_extract_all(content, '{_B64}'), lambda x: length(x)), list_transform(regexp_extract_all(content, '{_HEXB}'), lambda x: length(x)), list_transform(regexp_extract_all(content, '{_UNI}'), lambda x: length(x))) AS runs,
      length(content) AS chars, len(regexp_extract_all(regexp_replace(content, '{_CMT}', '', 'g'), '{_TOK}')) AS nt,
      len(regexp_extract_all(content, '0x[0-9A-Fa-f]{{4,}}')) + len(regexp_extract_all(content, '\b[0-9]{{6,}}\b')) AS literals, len(regexp_extract_all(content, '[^\s]+')) AS model FROM f),
    v AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY sha1 ORDER BY row_ord) > 1 THEN 'exact_duplicate'
      WHEN coalesce(list_max(runs), 0) > 1024 OR coalesce(list_sum(runs), 0) / greatest(chars, 1) > 0.5 THEN 'encoded_data'
      WHEN lines > 100000 OR avg_line_len > {mean} OR max_line_len > {longest} THEN 'long_lines' WHEN binary_like THEN 'binary_like' WHEN na > 0.2 THEN 'too_much_nonascii'
      WHEN bytes > 200000 THEN 'too_large_bytes' WHEN model < 40 THEN 'too_few_lang_tokens' WHEN model > 3596 THEN 'too_many_lang_tokens'
      WHEN nt - 4 <= 0 THEN 'no_shingles' WHEN least(1.0, literals / greatest(1, nt)) > 0.2 THEN 'hexnum_blob' ELSE 'ok' END AS fail_reason FROM m)
    """


_CODE, _PROSE = _verdict_sql(100, 1000), _verdict_sql(1e9, 1e9)


def _judged(spark, sf, limits=quality.Thresholds()):
    return quality.verdict(quality.file_metrics(_files(spark, sf)), limits)


@R.add("quality_verdict", _CODE + "SELECT filename, sha1, bytes, lines, max_line_len, nt AS num_tokens_lang, model AS num_tokens_model, fail_reason, fail_reason = 'ok' AS quality_ok FROM v")
def quality_verdict(spark, sf):
    return _judged(spark, sf).select("filename", "sha1", "bytes", "lines", "max_line_len", "num_tokens_lang", "num_tokens_model", "fail_reason", "quality_ok")


@R.add("quality_verdict_prose", _PROSE + "SELECT filename, fail_reason FROM v")
def quality_verdict_prose(spark, sf):
    return _judged(spark, sf, quality.Thresholds.prose()).select("filename", "fail_reason")


@R.add("drop_reasons", _CODE + "SELECT fail_reason, count(*) AS n FROM v GROUP BY 1")
def drop_reasons(spark, sf):
    return quality.drop_summary(_judged(spark, sf))


@R.add("survivors_semi", _PROSE + "SELECT f.filename, f.filetype, f.row_ord FROM f SEMI JOIN (SELECT filename FROM v WHERE fail_reason = 'ok') k ON f.filename = k.filename")
def survivors_semi(spark, sf):
    return quality.only_listed(_files(spark, sf), quality.survivors(_judged(spark, sf, quality.Thresholds.prose()))).select("filename", "filetype", "row_ord")


@R.add("not_listed", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def not_listed(spark, sf):
    return quality.not_listed(_docs(spark, sf), table(spark, sf, "labels"), "doc_id").select("doc_id")


@R.add("route_files", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'test_case' WHEN 1 THEN 'dropped' ELSE 'main' END AS route FROM documents")
def route_files(spark, sf):
    middle = F.element_at(F.array(F.lit("/007_testCase/"), F.lit("/tests/"), F.lit("/lib/")), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = _docs(spark, sf).select("doc_id", F.concat("source", middle, F.col("doc_id").cast("string"), F.lit(".cry")).alias("filename"))
    return quality.route_test_cases(rows).select("doc_id", "route")


@R.add("pass_counts", "SELECT source AS repo, count_if(quality = 1) AS passed, count_if(coalesce(quality, 0) <> 1) AS failed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1")
def pass_counts(spark, sf):
    joined = _docs(spark, sf).join(table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("load_ok")), "doc_id", "left")
    return quality.pass_counts(joined, F.col("source").alias("repo"))


@R.add(
    "comment_policy",
    """SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'copyright|license|warranty|apache|mit|bsd|gnu') THEN 'legal' WHEN length(text) > 1000 AND contains(lower(text), 'http') AND contains(text, '@') THEN 'contact'
    WHEN regexp_matches(lower(text), 'args|parameters|returns|example|usage|invariant|precondition|postcondition|proof|spec') THEN 'documentation' WHEN length(text) < 500 THEN 'short' ELSE 'long' END AS rule FROM documents""",
)
def comment_policy(spark, sf):
    return _docs(spark, sf).select("doc_id", X.comment_rule(F.col("text")).alias("rule"))


@R.add("lang_from_ext", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'python' WHEN 1 THEN 'cryptol' WHEN 2 THEN 'cpp' WHEN 3 THEN 'text' ELSE 'text' END AS language FROM documents")
def lang_from_ext(spark, sf):
    extension = F.element_at(F.array(*[F.lit(e) for e in (".PY", ".cry", ".hpp", ".unknown", "")]), (F.col("doc_id") % 5 + 1).cast("int"))
    return _docs(spark, sf).select("doc_id", X.language_of(F.concat(F.lit("a.b/"), "source", extension)).alias("language"))


@R.add("strip_prefix", "SELECT doc_id, CASE WHEN source LIKE 'src1%' THEN substr(p, 4) ELSE p END AS path FROM (SELECT doc_id, source, CASE WHEN source LIKE 'src1%' THEN '/r/' || source ELSE '/other/' || source END AS p FROM documents)")
def strip_prefix(spark, sf):
    p = F.concat(F.when(F.col("source").like("src1%"), "/r/").otherwise("/other/"), "source")
    return _docs(spark, sf).select("doc_id", X.relative_path(p, "/r").alias("path"))


@R.add(
    "line_comment_strip",
    r"""SELECT doc_id, sha256(regexp_replace('a = "x//y" // ' || lang || chr(10) || text || ' // ' || source || chr(10),
    '(?s)("[^"\\]*(?:\\.[^"\\]*)*(?:"|\\?\z)|''[^''\\]*(?:\\.[^''\\]*)*(?:''|\\?\z))|//[^\n]*', '\1', 'g')) AS stripped FROM documents""",
)
def line_comment_strip(spark, sf):
    code = F.concat(F.lit('a = "x//y" // '), "lang", F.lit("\n"), "text", F.lit(" // "), "source", F.lit("\n"))
    return _docs(spark, sf).select("doc_id", M.text_sha256(X.strip_line_comments(code)).alias("stripped"))


@R.add("copyright_strip", r"SELECT doc_id, regexp_replace(regexp_replace('/* Copyright x */' || text || chr(10) || '// copyright y' || chr(10), '(?is)/\*.*?copyright.*?\*/', '', 'g'), '(?im)^.*//.*copyright.*$', '', 'g') AS text FROM documents")
def copyright_strip(spark, sf):
    return _docs(spark, sf).select("doc_id", X.strip_copyrights(F.concat(F.lit("/* Copyright x */"), "text", F.lit("\n// copyright y\n"))).alias("text"))


@R.add(
    "separation_policy",
    r"""WITH l AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(chr(10) || replace(text, '. ', '.' || chr(10) || chr(10)) || chr(10) || chr(10) || '// end' || chr(10), chr(10)) AS l FROM documents)),
    f AS (SELECT *, lag(x) OVER w AS px, lag(i) OVER w AS pi FROM l WHERE regexp_matches(x, '[^\s]') WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    g AS (SELECT doc_id, i, CASE WHEN pi IS NOT NULL AND i - pi > 1 AND (regexp_matches(x, '^\s*(//|#|--|;|/\*|\*)') OR regexp_matches(px, '^\s*(//|#|--|;|/\*|\*)')) THEN chr(10) || x ELSE x END AS y FROM f)
    SELECT doc_id, string_agg(y, chr(10) ORDER BY i) || chr(10) AS text FROM g GROUP BY doc_id""",
)
def separation_policy(spark, sf):
    c = F.concat(F.lit("\n"), F.replace("text", F.lit(". "), F.lit(".\n\n")), F.lit("\n\n// end\n"))
    return _docs(spark, sf).select("doc_id", X.separation_policy(c).alias("text"))


@R.add("blank_lines", r"SELECT doc_id, regexp_replace(regexp_replace(replace(text, '. ', chr(10) || '  ' || chr(10) || chr(10)), '\n([ ]*\n)+', chr(10) || chr(10), 'g'), '^\n+', '') AS text FROM documents")
def blank_lines(spark, sf):
    return _docs(spark, sf).select("doc_id", X.collapse_blank_lines(F.replace("text", F.lit(". "), F.lit("\n  \n\n"))).alias("text"))


@R.add("code_fence", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'x = 1' ELSE trim(replace(text, chr(10), ' ')) END AS code FROM documents")
def code_fence(spark, sf):
    flat = F.replace("text", F.lit("\n"), F.lit(" "))
    answer = F.when(F.col("doc_id") % 2 == 0, F.concat(flat, F.lit("\n```cryptol\nx = 1\n```\n"), flat)).otherwise(flat)
    return _docs(spark, sf).select("doc_id", X.first_code_block(answer).alias("code"))


@R.add("front_matter", "SELECT doc_id, text FROM documents")
def front_matter(spark, sf):
    return _docs(spark, sf).select("doc_id", X.without_front_matter(F.concat(F.lit("---\ntitle: "), F.col("doc_id").cast("string"), F.lit("\n---\n"), "text")).alias("text"))


@R.add("newlines", "SELECT doc_id, replace(replace(replace(text, '. ', chr(13) || chr(10)), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents")
def newlines(spark, sf):
    return _docs(spark, sf).select("doc_id", X.normalize_newlines(F.replace("text", F.lit(". "), F.lit("\r\n"))).alias("text"))


@R.add("excerpts", "SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || chr(10) || '... [truncated]' ELSE text END AS text FROM documents")
def excerpts(spark, sf):
    return _docs(spark, sf).select("doc_id", X.excerpt(F.col("text"), 300).alias("text"))


@R.add("repo_name", "SELECT doc_id, source AS repo FROM documents")
def repo_name(spark, sf):
    p = F.concat(F.when(F.col("doc_id") % 2 == 0, X.SLICE_PREFIX).otherwise(""), "source", F.lit("/b/c.cry"))
    return _docs(spark, sf).select("doc_id", X.repository_of(p).alias("repo"))


@R.add("source_id", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source || '/1.2.cry' ELSE source || '/1.2/f.cry' END AS source_id FROM documents")
def source_id(spark, sf):
    p = F.concat(F.when(F.col("doc_id") % 2 == 0, X.SLICE_PREFIX).otherwise(""), "source", F.lit("/1.2/f.cry"))
    return _docs(spark, sf).select("doc_id", X.source_of(p).alias("source_id"))


@R.add("import_count", "SELECT doc_id, doc_id % 4 AS n_imports FROM documents")
def import_count(spark, sf):
    code = F.concat(F.lit("module M where\n"), F.repeat(F.lit("import A::B\n"), (F.col("doc_id") % 4).cast("int")), F.lit("x = 1\n"))
    return _docs(spark, sf).select("doc_id", messages.import_split(code)["n_imports"].cast("long").alias("n_imports"))


@R.add("recode", "SELECT doc_id, CASE lang WHEN 'en' THEN 'cryptol' WHEN 'de' THEN 'saw' ELSE 'text' END AS filetype FROM documents")
def recode(spark, sf):
    from corpuskiln.operators.splits import recode_filetype

    kind = F.when(F.col("lang") == "en", "cry").when(F.col("lang") == "de", "saw").otherwise(F.col("lang"))
    return _docs(spark, sf).select("doc_id", recode_filetype(kind).alias("filetype"))


@R.add("size_score", "SELECT doc_id, round(CASE WHEN n < 50 THEN n / 50 * 0.5 WHEN n <= 5000 THEN 1.0 ELSE greatest(1 - ln(1 + n - 5000) / ln(5001), 0.0) END, 9) AS score FROM (SELECT doc_id, n_chars AS n FROM documents)")
def size_score(spark, sf):
    return _docs(spark, sf).select("doc_id", F.round(M.size_score(F.col("n_chars")), 9).alias("score"))
