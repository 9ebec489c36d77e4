"""Golden cases of the text functions and scanners."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuskiln.functions import machines as G
from corpuskiln.functions import measures as M
from corpuskiln.functions import text as X


def value(spark, column, **given):
    names = list(given)
    return spark.createDataFrame([tuple(given.values())], ", ".join(f"{n} string" for n in names)).select(column.alias("x")).collect()[0]["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("x = 1 // c\ny = 2\n", "x = 1 y = 2\n"),
        ("/* a /* b */ c */z", "z"),
        ('"a//b" // k\n', '"a//b" '),
        ("g = x' // k\n", "g = x' // k\n"),
        ("a /* never closed", "a "),
        ("", ""),
    ],
)
def test_nested_comments(text, want):
    assert G.strip_nested_comments(text)[0] == want


def test_comment_counts_keep_line_ends():
    assert G.strip_nested_comments("a // x\n/* b /* c */ */d", True) == ("a \nd", 1, 2)


@given(st.text(alphabet="ab/*'\"\\\n ", max_size=40))
def test_stripping_never_lengthens(text):
    assert len(G.strip_nested_comments(text)[0]) <= len(text)


def test_line_comments_and_layout(spark):
    assert value(spark, X.strip_line_comments(F.col("a")), a="x = 1 // c\ny = 2\n") == "x = 1 \ny = 2\n"
    assert value(spark, X.collapse_blank_lines(F.col("a")), a="\n\na\n \n\nb\n") == "a\n\nb\n"
    assert value(spark, X.separation_policy(F.col("a")), a="\n\na = 1\n\n\nb = 2\n\n// c\n\n\n") == "a = 1\nb = 2\n\n// c\n"
    once = value(spark, X.separation_policy(F.col("a")), a="a\n\n// b\n\n\nc\n")
    assert value(spark, X.separation_policy(F.col("a")), a=once) == once


def test_long_literals_dont_exhaust_the_stack(spark):
    long = '"' + "x" * 50_000 + '"'
    assert value(spark, F.size(M.code_tokens(F.col("a"))), a=long) == 1
    assert value(spark, M.encoded_data(F.col("a"))["enc_hits_hexbytes"], a="0xab," * 10_000) == 1
    assert value(spark, F.length(X.strip_line_comments(F.col("a"))), a=long + " // c") == len(long) + 1


def test_comment_policy(spark):
    assert not value(spark, X.keep_comment(F.col("a")), a="Permitted under limit")
    assert value(spark, X.keep_comment(F.col("a")), a="Returns x")
    assert not value(spark, X.keep_comment(F.col("a")), a="n" * 600)


def test_paths(spark):
    assert value(spark, X.repository_of(F.col("a")), a="cryptol_slices/a/b.cry") == "a"
    assert value(spark, X.repository_of(F.col("a")), a="a/b.cry") == "a"
    assert value(spark, X.source_of(F.col("a")), a="cryptol_slices/p/q/002_f.cry") == "p/q.cry"
    assert value(spark, X.language_of(F.col("a")), a="x/Y.CRY") == "cryptol"
    assert value(spark, X.fold_parent(F.col("a")), a="a/b/c.cry") == "a/b_c.cry"


def test_measures(spark):
    assert [value(spark, f(F.col("a")), a="") for f in (M.line_count, M.mean_line_length, M.longest_line)] == [0, 0.0, 0]
    assert value(spark, M.code_tokens(F.col("a")), a="a ... b") == ["a", "..", ".", "b"]
    assert value(spark, X.estimated_tokens(F.col("a")), a="x" * 9) == 3
    assert value(spark, M.jaccard(F.split("a", ","), F.split("b", ",")), a="x,y", b="y,z") == pytest.approx(1 / 3)
    assert value(spark, M.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")), a="") == 0.0
    assert [value(spark, F.round(M.size_score(F.lit(n)), 6), a="") for n in (0, 25, 50, 5000, 10000)] == [0, 0.25, 1, 1, 0]


def test_wrapped_comment(spark):
    out = value(spark, X.wrapped_comment(F.col("a"), 20), a="one two three four five six")
    assert out == "// one two three\n// four five six"


def test_chunks_by_budget():
    assert G.chunk_by_budget("x" * 100, 10, 2) == [(0, 40), (32, 72), (64, 100)]
    text = "a\n" * 300
    spans = G.chunk_by_budget(text, 20, 2)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(b[0] <= a[1] for a, b in zip(spans, spans[1:]))


def test_spans_and_blanking():
    text = "a // one\n// two\nb # c\n/* d // e */ f"
    kinds = [s.kind for s in G.comment_spans(text)]
    assert kinds == ["//", "#", "block"]
    blank, spans = G.blank_comments(text)
    assert blank.count("\n") == text.count("\n") and "two" not in blank and len(spans) == 3


def test_policy_spans_leave_doc_comments():
    text = "/** doc */\n// a\n// b\n\n// c\nx = 1 /* d */\n"
    spans = G.policy_spans(text)
    assert [s.text for s in spans] == ["// a\n// b", "// c", "/* d */"]
    assert G.drop_spans(text, spans, [False, True, False]) == "/** doc */\n\n// c\nx = 1 \n"
    assert G.code_after(text, spans, 1) == "x = 1 "


def test_markdown_chunks():
    page = "---\nt: x\n---\n# A\n" + "word " * 30 + "\n## B\n" + "long " * 600 + "\n## C\nshort\n"
    out = G.markdown_chunks(page, "p.md", most=500, overlap=50, least=100)
    assert all(len(c["text"]) <= 500 for c in out) and out[0]["text"].startswith("# A")
    assert all(c["text"].startswith("## B") for c in out if c["start_char"] is not None)
    assert not any(c["text"] == "## C\nshort" for c in out) and len({c["id"] for c in out}) == len(out)


def test_a_heading_as_long_as_a_chunk_still_ends():
    assert G.markdown_chunks("# " + "h" * 300 + "\n" + "body " * 100, "p", most=100, overlap=99, signal=0)


def test_reflow():
    assert G.split_elements("a, (b, c), [d, e]") == ["a", "(b, c)", "[d, e]"]
    assert G.is_comprehension("x | x <- xs") and not G.is_comprehension("(a | b)")
    assert G.reflow_sequences("s = [1,2,3]\n") == "s = [ 1, 2, 3]\n"
    wrapped = G.reflow_sequences("s = [" + ",".join(["0xff"] * 40) + "]\n", 40)
    assert max(map(len, wrapped.splitlines())) <= 40 and wrapped.count("0xff") == 40
    assert G.reflow_sequences("[x | x <- [1,2]] [") == "[x | x <- [1,2]] ["
    assert G.is_hex_list(" 0x1, 0x2, ") and not G.is_hex_list("0x1, y")
    hexes = G.reflow_hex("t = [\n  0x01, 0x02,\n  0x03]\n", 80)
    assert hexes == "t = [\n  0x01, 0x02, 0x03]\n"
    assert G.reflow_hex("t = [1, 2]") == "t = [1, 2]"


def test_masking():
    text = "f : [8] -> [8]\nf x = g x\n  where g y = y\n\nh = 1\n"
    out = G.mask_definition(text, "f", ["x"], "HOLE")
    assert out["removed_definition"] == "f x = g x\n  where g y = y\n"
    assert out["masked_source"] == "f : [8] -> [8]\nf x = HOLE\n\nh = 1"
    assert G.mask_definition(text, "nope", []) is None
    assert G.mask_definition("property p x = x == x\nq = 1", "p", ["x"])["masked_source"].startswith("property p x = __HOLE_p")


def test_type_definitions():
    assert G.type_definitions("type A = { x : [8],\n y : B }\ntype N = 5\n") == {"A": "{ x : [8],\n y : B }", "N": "5"}


def test_hex_runs_end_at_ascii_edges(spark):
    run = "ab cd ef 01 23 45 67 89"
    texts = [run, "é" + run, run + "é", run.replace(" 45", "\u00a045"), run.replace(" 45", "\x0b45"), "_" + run, "\\x" + run, run.replace(" ", ",")]
    got = [value(spark, M.encoded_data(F.col("a"))["enc_hits_hexbytes"], a=t) for t in texts]
    # SQL's words and white space are ASCII: a letter of another script is an edge, a no-break space isn't white space
    assert got == [1, 1, 1, 0, 0, 0, 0, 1]


def test_grams_are_counted_without_making_them(spark):
    texts = ["", "abcd", "abcde", " abcdeabcde \n  abcdef\t\nxy", "éß漢字😀éß漢字😀\n\n\U0010ffffé퟿漢字😀ß", "aaaaaaaa\r\naaaaaa", "\x1cabcd\x85 \n vwxyz ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "a string").select(M.gram_count(F.col("a")).alias("n"), F.size(M.char_grams(F.col("a"))).alias("m")).collect()
    assert [r["n"] for r in rows[:-1]] == [r["m"] for r in rows[:-1]] and rows[-1]["n"] is None
    assert M.count_grams("".join(map(chr, range(0x10000, 0x10400))), 5) == 1020
