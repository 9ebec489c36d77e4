import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpuskiln.llm import packing, registry
from corpuskiln.llm.packing import Example, Limits, Packer
from corpuskiln.llm.registry import END_ID, WORD_BPE

TRUTH = Tokenizer.from_file(WORD_BPE)
TRUTH.encode_special_tokens = True


def ids_of(text):
    return np.array(TRUTH.encode(text, add_special_tokens=False).ids, dtype="<u4")


def encode(texts, **options):
    if str(options) not in WORDS:
        WORDS[str(options)] = packing.WordIds(WORD_BPE, **options)
    ids, bounds = WORDS[str(options)].texts(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


WORDS = {}
PLAIN = Tokenizer.from_file(WORD_BPE)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aBé'ſİΣσß1２.,! \n\t\x1c\x85\x00ć <|>endoftext", max_size=40), min_size=1, max_size=4))
def test_words_as_the_tokenizer_does(texts):
    assert encode(texts) == [ids_of(t).tolist() for t in texts]
    assert encode(texts, special_as_text=False) == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_character_as_the_tokenizer_does():
    texts = [f"a{chr(c)}B {chr(c)}" for c in range(0x700) if not 0xD800 <= c < 0xE000]
    assert encode(texts) == [ids_of(t).tolist() for t in texts]


def test_special_tokens():
    text = "hello <|endoftext|> world <|endoftext|>x"
    assert 49407 not in encode([text])[0] and encode([text]) == [ids_of(text).tolist()]
    assert encode([text], special_as_text=False)[0] == PLAIN.encode(text, add_special_tokens=False).ids


def test_words_are_forgotten_and_learned_again(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    for text in ("one two three four five", "two six seven", "one", ""):
        assert encode([text, None, text]) == [ids_of(text).tolist(), [], ids_of(text).tolist()]


def test_a_tokenizer_with_other_steps_encodes_whole_texts(tmp_path):
    steps = json.loads(open(WORD_BPE, encoding="utf-8").read())
    steps["normalizer"] = {"type": "Lowercase"}
    path = str(tmp_path / "other.json")
    open(path, "w", encoding="utf-8").write(json.dumps(steps))
    own, text = packing.WordIds(path), "Ｆull ﬁne\u00a0e\u0301 TEXT"
    assert not own.by_words and own.texts(pa.array([text, None]), 2)[0].tolist() == [*own.whole.encode(text, add_special_tokens=False).ids, 2, 2]


def check(pieces, examples, limits, cut):
    covered, fill = defaultdict(list), defaultdict(list)
    for e, start, n, seq, offset in pieces:
        assert n > 0
        covered[e.key].append((start, n))
        fill[seq].append((offset, n, e.loss_of(start, start + n)))
    for e in examples:
        at = 0
        for start, n in sorted(covered[e.key]):
            assert start == at
            at += n
        assert at == len(e.ids)
    for parts in fill.values():
        parts.sort()
        assert [o for o, _, _ in parts] == list(np.cumsum([0] + [n for _, n, _ in parts])[:-1])
        assert sum(n for _, n, _ in parts) <= limits.tokens and len(parts) <= limits.segments and sum(x for _, _, x in parts) <= limits.loss_tokens
    return [sum(n for _, n, _ in parts) for parts in fill.values()]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=40), st.booleans())
def test_every_id_lies_in_one_piece(sizes, cut):
    limits = Limits(tokens=64, segments=5, loss_tokens=40, pool=6)
    examples = []
    for k, n in enumerate(sizes):
        marks = np.random.default_rng(k).integers(0, 2, n)
        examples.append(Example(k, np.arange(n, dtype="<u4"), np.cumsum(marks)))
    check(list(Packer(limits, cut).pack(examples)), examples, limits, cut)


def brute(sizes, lim, cut):
    """Pieces (key, start, length, sequence, offset) by the rule of the dot product, one example after the other."""
    out, pool, sequence = [], [], 0

    def fill(room):
        nonlocal sequence
        offset, segments, loss = 0, lim.segments, lim.loss_tokens
        while room and segments and pool:
            score = [len(m) * room / lim.tokens**2 + segments / lim.segments**2 + sum(m) * loss / lim.loss_tokens**2 for _, _, m in pool]
            fits = [i for i, (_, _, m) in enumerate(pool) if len(m) <= room and sum(m) <= loss]
            if not fits and not cut:
                break
            at = max(fits or range(len(pool)), key=lambda i: score[i])
            key, start, marks = pool[at]
            n = max(n for n in range(min(len(marks), room) + 1) if sum(marks[:n]) <= loss)
            if not n:
                break
            out.append((key, start, n, sequence, offset))
            loss, offset, room, segments = loss - sum(marks[:n]), offset + n, room - n, segments - 1
            if n < len(marks):
                pool[at] = (key, start + n, marks[n:])
            elif at == len(pool) - 1:
                pool.pop()
            else:
                pool[at] = pool.pop()
        sequence += 1

    def waits():
        return (sum(len(m) for *_, m in pool), len(pool), sum(sum(m) for *_, m in pool))

    for key, marks in enumerate(sizes):
        start = 0
        while len(marks) >= lim.tokens or sum(marks) > lim.loss_tokens:
            n = max(n for n in range(min(len(marks), lim.tokens) + 1) if sum(marks[:n]) <= lim.loss_tokens)
            out.append((key, start, n, sequence, 0))
            sequence, start, marks = sequence + 1, start + n, marks[n:]
        if marks:
            pool.append((key, start, marks))
        while len(pool) > lim.pool and any(x >= y for x, y in zip(waits(), (lim.tokens, lim.segments, lim.loss_tokens))):
            fill(lim.tokens)
    while pool:
        left = waits()[0]
        fill(lim.tokens if left >= lim.tokens or not cut else 1 << left.bit_length() - 1)
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=60), max_size=25), st.booleans())
def test_pieces_against_brute_force(marks, cut):
    limits = Limits(tokens=32, segments=4, loss_tokens=12, pool=5)
    examples = [Example(k, np.arange(len(m), dtype="<u4"), np.cumsum(np.array(m, dtype=np.int64))) for k, m in enumerate(marks)]
    got = [(e.key, int(start), int(n), sequence, int(offset)) for e, start, n, sequence, offset in Packer(limits, cut).pack(examples)]
    assert got == brute(marks, limits, cut)


def test_tiny_examples_fill_whole_sequences():
    examples = [Example(k, np.zeros(3, dtype="<u4")) for k in range(20_000)]
    filled = check(list(Packer(Limits(), True).pack(examples)), examples, Limits(), True)
    assert sum(n not in (4096, 1 << n.bit_length() - 1) for n in filled) == 0 and filled.count(4096) >= 14


def test_conversations_under_three_limits(spark):
    out = registry.queries()["packing_conversations"](spark, "/root/testdata/sf0.01").toPandas()
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").toPandas()
    roles = {(r.conv_id, r.turn): r.role for r in turns.itertuples()}
    assert len(set(zip(out.conv_id, out.turn))) == len(roles)
    out["loss"] = [n if roles[c, t] == "assistant" else 0 for c, t, n in zip(out.conv_id, out.turn, out.length)]
    of = out.groupby("sequence_id").agg(tokens=("length", "sum"), segments=("length", "size"), loss=("loss", "sum"))
    assert of.tokens.max() <= 1024 and of.segments.max() <= 24 and of.loss.max() <= 384
    whole = out[out.start + out.length == out.doc_tokens]
    assert whole.groupby(["conv_id", "turn"]).size().max() == 1 and out.groupby(["conv_id", "turn"]).length.sum().equals(out.groupby(["conv_id", "turn"]).doc_tokens.first().astype("int64"))


def test_examples_that_fit_stay_whole_without_cuts():
    limits = Limits(tokens=100, segments=3, loss_tokens=100, pool=4)
    examples = [Example(k, np.zeros(n, dtype="<u4")) for k, n in enumerate([60, 50, 40, 30, 20, 99, 1])]
    pieces = list(Packer(limits, False).pack(examples))
    assert len(pieces) == len(examples)


def test_cutting_leaves_no_padding():
    limits = Limits(tokens=64, segments=64, loss_tokens=64, pool=8)
    examples = [Example(k, np.zeros(n, dtype="<u4")) for k, n in enumerate([10, 63, 200, 5, 5, 7, 64, 65, 1, 33])]
    for filled in check(list(Packer(limits, True).pack(examples)), examples, limits, True):
        assert filled == 64 or filled & (filled - 1) == 0


def test_edge_documents(spark, docs):
    texts = {1: None, 2: "", 3: "Hello world", 4: "long text " * 6_000, 5: "x" * 30_000}
    df = docs([*texts.items(), (3, "Hello world"), (None, "no id")])
    rows = packing.pack_texts(df, WORD_BPE, END_ID, keep_ids=True).collect()
    for key, text in texts.items():
        want = [*ids_of(text or "").tolist(), END_ID]
        own = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], tuple(r["ids"])) for r in rows if r["doc_id"] == key)
        copies = 2 if key == 3 else 1
        assert sum(n for _, n, *_ in own) == copies * len(want)
        for start, n, crc, total, ids in own:
            assert total == len(want) and list(ids) == want[start : start + n] and crc == zlib.crc32(np.array(want[start : start + n], dtype="<u4").tobytes())
    assert any(r["doc_id"] is None for r in rows)
    assert packing.pack_texts(docs([]), WORD_BPE, END_ID).count() == 0


def test_instruction_examples(spark):
    rows = [(1, [5] * 30, [0] * 20 + [1] * 10), (2, [6] * 50, None), (3, None, None), (4, [], []), (5, [7] * 10, [1, None])]
    df = spark.createDataFrame(rows, "example_id int, ids array<int>, loss array<int>").coalesce(1)
    out = packing.pack_examples(df, Limits(tokens=64, segments=2, loss_tokens=10, pool=4), loss_col="loss").collect()
    assert sorted((r["example_id"], r["length"]) for r in out) == [(1, 30), (2, 50), (5, 10)]
    assert {r["sequence_id"] for r in out if r["example_id"] == 2} & {r["sequence_id"] for r in out if r["example_id"] == 5}


def test_no_room_is_an_error():
    with pytest.raises(ValueError):
        list(Packer(Limits(tokens=8, loss_tokens=0), True).pack([Example(1, np.zeros(9, dtype="<u4"))]))
