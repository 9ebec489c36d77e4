import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskiln.llm import language_id as L


def brute(train, text):
    """Code length in bits of ``text`` after ``train``, symbol by symbol with exclusion."""
    counts = {}
    for t in train:
        data = [0, 0, 0, *(b + 1 for b in t)]
        for i in range(3, len(data)):
            for k in range(4):
                counts.setdefault(tuple(data[i - k : i]), {}).setdefault(data[i], 0)
                counts[tuple(data[i - k : i])][data[i]] += 1
    return counts


def rate(counts, seen, text):
    data, bits = [0, 0, 0, *(b + 1 if b + 1 in seen else 0 for b in text)], 0.0
    alphabet = [0, *sorted(seen)]

    def distribution(context):
        if context is None:
            return {s: 1 / 257 for s in alphabet}
        shorter = distribution(context[1:] if context else None)
        own = counts.get(context)
        if not own:
            return shorter
        n, q = sum(own.values()), len(own)
        rest = sum(p for s, p in shorter.items() if s not in own)
        return {s: own[s] / (n + q) if s in own else q / (n + q) * (shorter[s] / rest) for s in alphabet}

    for i in range(3, len(data)):
        bits += -math.log2(distribution(tuple(data[i - 3 : i]))[data[i]])
    return bits


def test_code_lengths_against_brute_force():
    train = {"a": [b"banana bandana", b"ban"], "b": [b"xyzzy", b"xanadu"]}
    merged = {lang: {} for lang in train}
    for lang, texts in train.items():
        for t in texts:
            for g in L._grams(t).tolist():
                merged[lang][g] = merged[lang].get(g, 0) + 1
    langs = sorted(train)
    model = L.PpmModel(langs, [np.array(sorted(merged[x])) for x in langs], [np.array([merged[x][g] for g in sorted(merged[x])]) for x in langs])
    seen = {b + 1 for ts in train.values() for t in ts for b in t}
    tests = [b"banana", b"xyz ban", b"q", b"an\xc3\xa9x", b"", b"banana bandana " * 20]
    got = model.code_lengths(tests) / L.UNIT
    for i, text in enumerate(tests):
        for j, lang in enumerate(langs):
            assert got[i, j] == pytest.approx(rate(brute(train[lang], text), seen, text), abs=0.01 + 0.001 * len(text))


def test_a_hundred_languages_lose_no_context():
    rng = np.random.default_rng(4)
    train = {f"l{k:03}": [bytes(rng.integers(32, 250, 4_000).astype(np.uint8)), bytes(rng.choice(rng.integers(32, 250, 6), 3_000).astype(np.uint8))] for k in range(100)}
    langs, grams, counts = sorted(train), [], []
    for lang in langs:
        g, n = np.unique(np.concatenate([L._grams(t) for t in train[lang]]), return_counts=True)
        grams.append(g), counts.append(n)
    model = L.PpmModel(langs, grams, counts)
    assert [len(tree.orders[-1][2]) for tree in model.trees] == [len(g) for g in grams]
    seen = {b + 1 for ts in train.values() for t in ts for b in t}
    for k in (0, 57, 99):
        text = train[langs[k]][1][-60:] + train[langs[k]][0][:40] + b"\x01"
        got = model.code_lengths([text])[0] / L.UNIT
        for j in (0, 57, 99):
            assert got[j] == pytest.approx(rate(brute(train[langs[j]], text), seen, text), abs=0.2)
        assert got.argmin() == k


def test_ties_go_to_the_smaller_name():
    g, n = np.unique(L._grams(b"same text"), return_counts=True)
    assert L._predict(["same"], L.PpmModel(["b", "c"], [g, g], [n, n]))[0] == ["b"]


@pytest.mark.parametrize("text, letters", [("½ ²", False), ("123 !", False), ("٣", False), ("_", False), ("5a", True), ("日", True), ("ª", True)])
def test_letters(text, letters):
    g, n = np.unique(L._grams(b"same text"), return_counts=True)
    assert (L._predict([text], L.PpmModel(["a"], [g], [n]))[0] != ["und"]) == letters == any(map(str.isalpha, text))


def test_blocks_dont_change_lengths(monkeypatch):
    grams = L._grams(b"abracadabra abracadabra")
    keys, counts = np.unique(grams, return_counts=True)
    model = L.PpmModel(["x"], [keys], [counts])
    texts = [b"abra" * 500, b"", b"cad", b"zzz" * 100]
    whole = model.code_lengths(texts)
    monkeypatch.setattr(L, "BLOCK", 7)
    assert (model.code_lengths(texts) == whole).all()


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.predict_languages(df).join(df.select("doc_id", "lang"), "doc_id").toPandas()
    for r in out.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()


def test_labels_of_held_out_rows_are_never_read(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spoiled = df.withColumn("lang", F.when(L.held_out_fold(), "xx").otherwise(F.col("lang")))
    pick = lambda d: sorted((r["doc_id"], r["lang_pred"]) for r in L.predict_languages(d).collect())
    assert pick(df) == pick(spoiled)


def test_edge_rows(spark, docs):
    text = "the house is on the hill and the dog is here"
    df = docs([(1, text), (2, text), (3, None), (4, ""), (5, "123 !!"), (6, "the dog " * 20_000), (None, text), (1, text)]).withColumn("lang", F.when(F.col("doc_id") == 2, None).otherwise(F.col("lang")))
    out = L.predict_languages(df).collect()
    assert len(out) == 8 and {r["doc_id"]: r["lang_pred"] for r in out if r["doc_id"] in (3, 4, 5)} == {3: "und", 4: "und", 5: "und"}
    assert all(r["lang_pred"] == "en" for r in out if r["doc_id"] in (1, 2, 6))
    kept = L.keep_identified(df)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "2", "6", "None"]
    assert L.predict_languages(docs([])).count() == 0
    unlabelled = docs([(1, text)]).withColumn("lang", F.lit(None).cast("string"))
    assert [r["lang_pred"] for r in L.predict_languages(unlabelled).collect()] == ["und"]
