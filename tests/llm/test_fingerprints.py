import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import fingerprints as W


def test_windows_against_brute_force(spark, docs):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "longword" * 3, "é"]) for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["", "  \n", "x" * 5_000]
    rows = docs(list(enumerate(texts))).select("doc_id", "text", W.packed_fingerprint("text").alias("p")).withColumn("f", W.fingerprint(F.col("p"))).collect()
    gram_hashes = {}
    for r in rows:
        tokens = [w[i : i + W.TOKEN] for w in r["text"].split() for i in range(0, len(w), W.TOKEN)]
        n = max(len(tokens) - W.GRAM + 1, 1) if tokens else 0
        grams = [tuple(tokens[i : i + W.GRAM]) for i in range(n)]
        for f in r["f"]:
            assert gram_hashes.setdefault(grams[f["pos"]], f["hash"]) == f["hash"]
    # the hashes of grams that are never chosen are unknown, so check windows where all are known
    for r in rows:
        tokens = [w[i : i + W.TOKEN] for w in r["text"].split() for i in range(0, len(w), W.TOKEN)]
        n = max(len(tokens) - W.GRAM + 1, 1) if tokens else 0
        grams = [tuple(tokens[i : i + W.GRAM]) for i in range(n)]
        chosen = {f["pos"] for f in r["f"]}
        assert bool(chosen) == bool(tokens)
        for s in range(max(n - W.WINDOW + 1, 1) if n else 0):
            window = range(s, min(s + W.WINDOW, n))
            assert chosen & set(window)
            if all(grams[i] in gram_hashes for i in window):
                least = min(gram_hashes[grams[i]] for i in window)
                assert max(i for i in window if gram_hashes[grams[i]] == least) in chosen


def test_shared_passages_share_hashes(spark, docs):
    shared = " ".join(f"s{i}" for i in range(W.WINDOW + W.GRAM - 1))
    rows = [(i, f"{' '.join(f'p{i}_{k}' for k in range(i))} {shared} tail{i}") for i in range(20)]
    out = docs(rows).select(W.hashes(W.packed_fingerprint("text")).alias("h")).collect()
    assert all(set(a["h"]) & set(out[0]["h"]) for a in out)


def edit_truth(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        out[i] = hashlib.sha256((t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]).encode()).hexdigest()
    return out


@pytest.mark.parametrize("buckets", [1, 2, 7, 40])
def test_next_documents(spark, docs, buckets):
    rows = [(i * i, f"text {i} " * (i % 5 + 1) + "é日") for i in range(60)] + [(None, "no id"), (10**12, None), (10**12 + 1, "")]
    got = {r["__id"]: r["__next"] for r in W.with_next_document(docs(rows), buckets=buckets).filter("extra = 0").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    assert got == {i: order[(k + 1) % len(order)][1] or "" for k, (i, _) in enumerate(order)}


def test_rows(spark, docs):
    rows = [(i, f"{i} word " * i) for i in range(40)] + [(100, None), (101, "same text here"), (102, "same text here"), (103, "y" * 40_000)]
    out = {r["doc_id"]: r for r in W.fingerprint_and_edit(docs(rows)).collect()}
    assert len(out) == len(rows) and {i: r["edited_sha256"] for i, r in out.items()} == edit_truth(rows)
    assert out[102]["near_next"] == 1.0 and out[101]["fingerprint"] == out[102]["fingerprint"] != out[39]["fingerprint"]
    assert out[100]["n_chars"] == 0 and all(0 <= r[c] <= 1 for r in out.values() for c in ("near_edited", "near_next"))


def test_edges(spark, docs):
    assert W.fingerprint_and_edit(docs([])).count() == 0
    one = W.fingerprint_and_edit(docs([(1, "abc def")])).collect()[0]
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()
    twice = W.fingerprint_and_edit(docs([(1, "a b c"), (1, "a b c"), (2, "d")])).collect()
    assert len(twice) == 3 and W.winnow(docs([(1, None), (2, "a b")])).count() == 1


def test_the_plan_has_no_python(spark, docs):
    plan = W.fingerprint_and_edit(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_unspaced_passages_share_hashes_at_any_offset(spark, docs):
    rng = random.Random(2)
    shared = "".join(rng.choice("日本語中文字漢仮名交文") for _ in range(W.WINDOW + W.GRAM - 1))
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(i)) + shared + "z" * 30) for i in range(20)] + [(20, "ab " + " ".join(shared) + "\ncd")]
    found = docs(rows).select(F.posexplode(W.hashes(W.packed_fingerprint("text"))).alias("n", "h"), "doc_id").groupBy("h").agg(F.count_distinct("doc_id").alias("n"))
    assert found.agg(F.max("n")).collect()[0][0] == len(rows)
    base = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(400))
    pair = docs([(1, base), (2, "x" + base)]).select(W.hashes(W.packed_fingerprint("text")).alias("h")).collect()
    assert len(set(pair[0]["h"]) & set(pair[1]["h"])) >= 0.9 * len(pair[0]["h"])


def test_edited_texts_are_fingerprinted_whole(spark, docs):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é日\n") for _ in range(n)) for n in [*range(90), 200, 300, 1000]] + ["x" * 300, " " * 60 + "ab" * 20, "ab" * 40 + " " * 90, "", " \n"]
    rng.shuffle(texts)
    out = {r["doc_id"]: r["edited_fingerprint"] for r in W.fingerprint_and_edit(docs(list(enumerate(texts)))).collect()}
    edited = [(i, t[: len(t) - len(t) // 3] + texts[i - 1][: len(t) // 3]) for i, t in enumerate(texts)]
    direct = {r["doc_id"]: r["d"] for r in docs(edited).select("doc_id", W.digest(W.packed_fingerprint("text")).alias("d")).collect()}
    assert out == direct
