import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpuskiln.llm import near_dedup as N


def plain_shingles(text):
    """Counts of five-word tuples, by the docstring alone."""
    words = "".join(c if c.isascii() and (c.isalnum() or c == "_") or ord(c) > 127 else " " for c in (text or "").lower()).split(" ")
    words = [w for w in words if w]
    return Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def plain_weights(texts):
    """Weighted shingles of each text: counts times inverse document frequencies."""
    counts = [plain_shingles(t) for t in texts]
    documents = [c for c, t in zip(counts, texts) if t is not None]
    frequency = Counter(g for c in documents for g in c)
    mean = sum(sum(c.values()) for c in documents) / max(len(documents), 1)
    rare = min(max(1 / 128, mean / 2**18), 0.5)
    idf = {g: 1 + math.log(1 / max(n / len(documents), rare)) / math.log(1 / rare) for g, n in frequency.items()}
    return [{g: n * idf.get(g, 2.0) for g, n in c.items()} for c in counts]


def plain_jaccard(a, b):
    shared = sum(min(a[g], b[g]) for g in a.keys() & b.keys())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def truth(rows, threshold=N.THRESHOLD):
    """(class of each row index) by exact weighted Jaccard over all pairs; nothing of it comes from the module but the threshold."""
    texts = [t for _, t in rows]
    weighted = plain_weights(texts)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if texts[i] == texts[j] or (texts[i] is not None and texts[j] is not None and weighted[i].keys() & weighted[j].keys() and plain_jaccard(weighted[i], weighted[j]) >= threshold):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def same_classes(a, b):
    pairs = set(zip(a, b))
    return len(pairs) == len(set(a)) == len(set(b))


def near(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"new{rng.random():.9f}"
    return " ".join(out)


def test_shingles_against_python():
    texts = [b"one two three four five six", b"a b", b"", b"...", "é b-c d_e f9".encode(), b"w " * 40, b"x" * 500 + b" y"]
    owner, value, count = N.shingles(texts)
    for i, text in enumerate(texts):
        words = [w for w in "".join(c if c.isalnum() or c == "_" or ord(c) > 127 else " " for c in text.decode()).split()]
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words)
        assert sorted(count[owner == i].tolist()) == sorted(grams.count(g) for g in set(grams))
    alone = [N.shingles([t])[1].tolist() for t in texts]
    assert [value[owner == i].tolist() for i in range(len(texts))] == alone


def test_samples_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(0)
    common, own = N._mix(rng.integers(1, 1 << 60, 800).astype(np.uint64)), N._mix(rng.integers(1, 1 << 60, 400).astype(np.uint64))
    hits = total = 0
    for trial in range(40):
        a, b = np.sort(common[trial * 10 : trial * 10 + 80]), np.sort(np.concatenate([common[trial * 10 : trial * 10 + 60], own[trial * 5 : trial * 5 + 20]]))
        weights = {int(x): float(rng.uniform(0.5, 6)) for x in np.concatenate([a, b])}
        wa, wb = (np.array([weights[int(x)] for x in s]) for s in (a, b))
        owner = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
        s = N.consistent_samples(owner, np.concatenate([a, b]), np.concatenate([wa, wb]), 2)
        hits += (s[0] == s[1]).sum() - N.SAMPLES * N.weighted_jaccard((a, wa), (b, wb))
        total += N.SAMPLES
    assert abs(hits / total) < 0.05


def test_groups_against_brute_force(spark, docs):
    rng = random.Random(2)
    rows = []
    for g in range(12):
        words = [f"g{g}w{k}" for k in range(120)]
        rows += [(len(rows) + k, near(rng, words, rng.choice([0, 1, 2, 3, 6]))) for k in range(6)]
    rows += [(500 + k, f"short {k}") for k in range(5)] + [(600, "short 1"), (700, None), (701, None), (702, ""), (703, "..."), (704, ""), (None, rows[0][1]), (0, rows[0][1]), (800, "w " * 30_000), (801, "w " * 30_001)]
    rng.shuffle(rows)
    got = N.near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows)
    want = truth(rows)
    least = defaultdict(list)
    for (i, _), c in zip(rows, want):
        least[c].append(i)
    expected = sorted((i, min((x for x in least[c] if x is not None), default=None), len(least[c])) for (i, _), c in zip(rows, want) if i is not None)
    assert sorted((r["doc_id"], r["class_id"], r["class_size"]) for r in got if r["doc_id"] is not None) == expected


def test_one_of_each_stays(spark, docs):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(3, text), (2, text), (2, text), (5, text + " more"), (7, "other"), (None, "lone"), (8, None), (9, None)]
    df = docs(rows)
    kept = N.keep_one_of_each(df)
    assert kept.columns == df.columns and sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted([("2", text), ("7", "other"), ("None", "lone"), ("8", "None")])
    assert N.keep_one_of_each(docs([])).count() == 0 and N.near_duplicates(docs([])).count() == 0


def test_a_large_group_of_near_copies(spark, docs):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(200)]
    rows = [(k, near(rng, words, 1)) for k in range(600)] + [(1000 + k, f"alone {k} " + " ".join(f"u{k}x{j}" for j in range(30))) for k in range(100)]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(rows)).collect()}
    assert all(got[k] == 0 for k in range(600)) and all(got[1000 + k] == 1000 + k for k in range(100))


def test_cross_pairs_reach_across_classes_only(spark):
    buckets = spark.createDataFrame([(1, t, 1.0) for t in "abcde"] + [(1, "z", 0.79), (2, "x", 1.0), (2, "y", 1.0)], "bucket bigint, tid string, weight double")
    classes = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")], "tid string, class string")
    got = {(r["a"], r["b"]) for r in N._cross_pairs(buckets, classes, 0.8).collect()}
    assert got == {("a", "d"), ("b", "d"), ("c", "d"), ("a", "e"), ("b", "e"), ("c", "e"), ("d", "e")}


def test_document_frequencies(spark, docs, monkeypatch):
    rng = random.Random(6)
    common = " ".join(f"c{k}" for k in range(9))
    texts = [" ".join(f"r{i}x{k}" for k in range(20)) + (" " + common if i % 3 else "") + (" " + common if i % 5 == 0 else "") for i in range(200)] + [f"few {rng.randint(0, 3)}" for _ in range(50)] + [""]
    weighted = plain_weights(texts)
    for groups in (1, 256):
        monkeypatch.setattr(N, "DF_GROUPS", groups)
        idf = N.inverse_frequencies(docs(list(enumerate(texts))).repartition(5).selectExpr("text"))
        for text, want in zip(texts, weighted):
            _, value, count = N.shingles([text.encode()])
            assert sorted((count * idf.of(value)).tolist()) == pytest.approx(sorted(want.values()), rel=1e-5)
    assert len(idf.values) == 9 + len(set(texts[200:250]))


def test_a_text_of_many_pairs_is_spread(spark, docs, monkeypatch):
    monkeypatch.setattr(N, "PAIRS_A_TASK", 10)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(200)]
    rows = [(k, near(rng, words, 1)) for k in range(150)] + [(500 + k, f"own {k} " * 20) for k in range(20)]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(rows)).collect()}
    want = truth(rows)
    assert same_classes([got[i] for i, _ in rows], want)
    pairs = spark.createDataFrame([("a", f"b{k}") for k in range(95)] + [("c", "d")], "a string, b string")
    texts = spark.createDataFrame([("a", "A"), ("c", "C")], "__tid string, __text string")
    assert sorted(tuple(r) for r in N._with_first_text(pairs, texts).select("a", "b", "__s").collect()) == sorted([("a", f"b{k}", "A") for k in range(95)] + [("c", "d", "C")])


def test_texts_that_share_a_passage_are_not_listed_in_pairs(spark, docs, monkeypatch):
    listed = []
    verify = N.verify

    def counted(pairs, texts, idf):
        listed.append(pairs.count())
        return verify(pairs, texts, idf)

    monkeypatch.setattr(N, "verify", counted)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"{passage} " + " ".join(f"u{k}x{j}" for j in range(30))) for k in range(200)]
    rows += [(300 + k, f"{rows[k][1]} end") for k in range(5)]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(rows)).collect()}
    assert same_classes([got[i] for i, _ in rows], truth(rows))
    # each text with the first text of each of its buckets, and in small buckets with few others
    assert sum(listed) <= len(rows) * (N.BANDS + N.LISTED)


def test_blocks_against_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(N, "LISTED", 0)
    rng = random.Random(11)
    rows = []
    for g in range(3):
        words = [f"g{g}w{k}" for k in range(150)]
        rows += [(len(rows) + k, near(rng, words, rng.randrange(9))) for k in range(60)]
    rows += [(500 + k, " ".join(f"g{k % 3}w{j}" for j in range(rng.randrange(60, 150)))) for k in range(30)]
    want = truth(rows)
    for weight in (10_000_000, 2_000):
        monkeypatch.setattr(N, "BLOCK_WEIGHT", weight)
        got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(rows)).collect()}
        assert same_classes([got[i] for i, _ in rows], want)


def test_a_block_joins_all_classes_of_alike_texts():
    rng = random.Random(12)
    words = [f"w{k}" for k in range(120)]
    texts = sorted({near(rng, words, rng.randrange(5)) for _ in range(80)}) + [" ".join(words[:k]) for k in (5, 60, 97, 98, 110)] + ["a b c", "a b c d e f"]
    idf = N.Idf(1000, 1 / 128, np.array([], dtype=np.uint64), np.array([], dtype=np.int64))
    tids, classes = [f"t{i:03d}" for i in range(len(texts))], [f"t{i // 2:03d}" for i in range(len(texts))]
    weighted = [{g: 2.0 * n for g, n in plain_shingles(t).items()} for t in texts]
    inside = set(range(0, 20))
    block = [(i, False) for i in range(len(texts))] + [(i, True) for i in range(len(texts)) if i not in inside]
    table = pa.table({"tid": [tids[i] for i, _ in block], "class": [classes[i] for i, _ in block], "outside": [o for _, o in block], "text": [texts[i] for i, _ in block]})
    links = N._block_links(table, idf, 0.8)
    number = {t: i for i, t in enumerate(tids)}
    assert all(a < b and plain_jaccard(weighted[number[a]], weighted[number[b]]) >= 0.8 for a, b in links)

    def closed(edges):
        parent = list(range(len(texts)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, j in edges:
            parent[find(i)] = find(j)
        return [find(i) for i in range(len(texts))]

    given = [(i, int(c[1:])) for i, c in enumerate(classes)]
    alike = [(i, j) for i in range(len(texts)) for j in range(i) if not (i in inside and j in inside) and plain_jaccard(weighted[i], weighted[j]) >= 0.8]
    assert same_classes(closed(given + [(number[a], number[b]) for a, b in links]), closed(given + alike)) and len(links) < len(texts) < len(alike)
