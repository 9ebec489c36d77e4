import hashlib

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuskiln.llm import byte_bpe, token_counts
from corpuskiln.llm.registry import BYTE_BPE

RANKS = byte_bpe.load_ranks(BYTE_BPE)
TRUTH = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PATTERN = regex.compile(P.PATTERN)


def encode(text):
    ids, decoded = byte_bpe.encode_text(text, byte_bpe.Memo(byte_bpe.TreeBpe(RANKS)), PATTERN)
    return [int(i) for i in ids.split(",")] if ids else [], decoded


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library_does(text):
    assert encode(text) == (TRUTH.encode_ordinary(text), text.encode())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abeinrst", min_size=2, max_size=200))
def test_long_words_as_the_library_does(text):
    assert encode(text) == (TRUTH.encode_ordinary(text), text.encode())


def test_the_tree_goes_down_to_single_bytes(monkeypatch):
    bpe = byte_bpe.TreeBpe(RANKS)
    monkeypatch.setattr(byte_bpe, "NODE_BYTES", 0)
    assert bpe.encode(b"unbelievably") == TRUTH.encode_ordinary("unbelievably") and bpe.joins == 11 and bpe.windows > 0
    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    bpe = byte_bpe.TreeBpe(RANKS)
    memo = byte_bpe.Memo(bpe)
    for text in rows:
        ids, decoded = byte_bpe.encode_text(text, memo, PATTERN)
        assert ids == ",".join(map(str, TRUTH.encode_ordinary(text))) and decoded == text.encode()
    assert bpe.joins > len(memo) and bpe.windows > len(memo) / 10


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 256, 257, 5000])
def test_fold(n):
    parts = [str(i) for i in range(n)]
    assert byte_bpe.fold(parts, ",") == ",".join(parts)


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, "é" * 9_000, " " * 9_000 + "x", "thequickbrownfox" * 900, "日本" * 4_000, "\x1c\x85\r\n\t"])
def test_long_pieces(text):
    assert encode(text) == (TRUTH.encode_ordinary(text), text.encode())


def test_edge_rows(spark, docs):
    df = docs([(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "x" * 50_000)])
    rows = byte_bpe.encode_decode(df, BYTE_BPE, P.PATTERN, keep_ids=True).collect()
    assert len(rows) == 5
    for r in rows:
        text = {1: "", 2: "", 3: "one two"}.get(r["doc_id"], "x" * 50_000)
        ids = TRUTH.encode_ordinary(text)
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and bytes(r["decoded"]) == text.encode()
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.encode_decode(docs([]), BYTE_BPE, P.PATTERN).count() == 0


def test_histogram_against_counting(spark, docs):
    texts = [None, "", "a", "a b c", "a b c", "word " * 30, "x" * 9_000]
    lengths = [len(TRUTH.encode_ordinary(t or "")) for t in texts]
    hist = token_counts.length_histogram(token_counts.token_lengths(docs([(i, t) for i, t in enumerate(texts)]), BYTE_BPE, P.PATTERN)).collect()
    assert {r["context_limit"] for r in hist} == set(lengths)
    for r in hist:
        limit = r["context_limit"]
        assert r["n_docs"] == lengths.count(limit) and r["docs_within"] == sum(n <= limit for n in lengths) and r["docs_longer"] == sum(n > limit for n in lengths)
        assert r["tokens_within"] == sum(n for n in lengths if n <= limit) and r["truncated_tokens"] == sum(min(n, limit) for n in lengths)
        assert r["total_tokens"] == sum(lengths) and r["quantile"] == pytest.approx(sum(n <= limit for n in lengths) / len(lengths))
    assert token_counts.length_histogram(token_counts.token_lengths(docs([]), BYTE_BPE, P.PATTERN)).count() == 0


def test_two_levels_and_reports(spark):
    lengths = [0, 1, 4095, 4096, 4096, 9000, 20_000]
    hist = token_counts.length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens bigint"))
    got = {r["limit"]: (r["docs_within"], r["truncated_tokens"]) for r in token_counts.limits_report(hist, [10, 5000]).collect()}
    assert got == {x: (sum(n <= x for n in lengths), sum(min(n, x) for n in lengths)) for x in (10, 5000)}
    assert {r["context_limit"]: r["truncated_tokens"] for r in hist.collect()}[4096] == sum(min(n, 4096) for n in lengths)
    assert {r["share"]: r["n_tokens"] for r in token_counts.length_quantiles(hist, [0.5, 1.0]).collect()} == {0.5: 4096, 1.0: 20_000}
