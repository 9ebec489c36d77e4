import numpy as np
import pytest

from corpuskiln.llm import ann


def brute(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    codes[:50] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))
    index = ann.MultiIndex(codes)
    for radius in (0, 1, 5, 7, 8, 20, 27, 33, 64):
        for q in (codes[0], codes[100]):
            assert index.within(q, radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ q) <= radius).tolist()


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_recall(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    pdf = df.orderBy("vec_id").toPandas()
    ids, x = pdf.vec_id.to_numpy(), np.stack(pdf.embedding).astype(np.float64)
    rows = ann.search(df).toPandas()
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        got = rows[rows.query_id == ids[q]].sort_values("rank")
        want = brute(ids, x, q, 10)
        assert got["rank"].tolist() == list(range(1, 11))
        assert got.score.tolist() == pytest.approx([float(np.sqrt(((x[np.searchsorted(ids, v)] - x[q]) ** 2).sum())) for v in got.vec_id])
        hit, total = hit + len({v for v, _ in want} & set(got.vec_id)), total + 10
    assert hit / total >= 0.95


def test_edges(spark, monkeypatch):
    schema = "vec_id bigint, embedding array<float>, label int, v string, qb int"
    row = lambda i, e: (i, e, 0, "x", 9)
    rows = [row(0, [1.0, 0.0]), row(1, [1.0, 0.1]), row(2, [1.0, 0.1]), row(3, [0.0, 0.0]), row(4, None), row(5, [1.0, None]), row(6, [float("nan"), 1.0]), row(7, [float("inf"), 1.0]), row(8, [1.0]), row(None, [1.0, 0.0]), row(100, [0.0, 1.0]), row(100, [0.0, 1.0]), row(200, [0.0, 0.0])]
    got = ann.search(spark.createDataFrame(rows, schema)).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: (r["query_id"], r["rank"]))] == [(0, 1, 1), (0, 2, 2), (0, 3, 100), (100, 1, 1), (100, 2, 2), (100, 3, 0)]
    assert ann.search(spark.createDataFrame([], schema)).count() == 0
    assert ann.search(spark.createDataFrame([row(0, None)], schema)).count() == 0


def test_blocks_dont_change_results(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    pick = lambda: sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(df, k=5, query_modulus=10).collect())
    whole = pick()
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 60)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 7)
    assert len(set(whole) & set(pick())) > 0.97 * len(whole)
