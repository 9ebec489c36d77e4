from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpuskiln.llm import language_id, line_dedup, near_dedup, packing, registry

from . import test_line_dedup, test_near_dedup


def test_stages_against_brute_force(spark, docs, tmp_path):
    passage = "\n".join(f"shared passage line {k} with some words" for k in range(4))
    rows = [(i, f"document {i} says the thing about number {i * 7}\n{passage}\n" + " ".join(f"the{i}word{k}" for k in range(40))) for i in range(12)]
    rows += [(20 + i, " ".join(f"copy{k}" for k in range(60)) + (" end" if i % 2 else "")) for i in range(6)] + [(40, None), (41, "123"), (42, "")]
    df = docs(rows)
    sf = str(tmp_path)
    df.write.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "packing"]
    now = spark.read.parquet(f"{sf}/documents.parquet")
    kept = stages["language_id"](spark, now, sf)
    assert kept.columns == df.columns
    left = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    assert {i for i, _ in rows} - {i for i, _ in left} == {40, 41, 42}
    shorter = stages["line_dedup"](spark, kept, sf)
    after = sorted((r["doc_id"], r["text"]) for r in shorter.collect())
    assert after == sorted(test_line_dedup.brute(left)) and shorter.columns == df.columns
    single = stages["near_dedup"](spark, shorter, sf)
    classes = defaultdict(list)
    for (i, _), c in zip(after, test_near_dedup.truth(after)):
        classes[c].append(i)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(min(c) for c in classes.values()) and single.columns == df.columns
    out = corpus_pipeline.run(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    assert {r["doc_id"] for r in out} == set(texts)
    for key in texts:
        own = [r for r in out if r["doc_id"] == key]
        assert sum(r["length"] for r in own) == own[0]["doc_tokens"]


def test_every_query_is_registered():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{k}" for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)] and "pipeline" in names
    assert set(registry.oracle_sql()) <= set(names)


def test_an_empty_table_and_unlabelled_rows(spark, docs, tmp_path):
    for name, rows in (("empty", []), ("unlabelled", [(1, "the words of a text"), (2, None)])):
        df = docs(rows).withColumn("lang", F.lit(None).cast("string")).withColumn("__nd_id", F.lit(1)).withColumn("__ld_key", F.lit("x"))
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert out.count() == 0 and {"doc_id", "start", "length", "sequence_id"} <= set(out.columns)


@pytest.mark.parametrize("module", [corpus_pipeline, language_id, line_dedup, near_dedup, packing])
def test_modules_state_their_edge_cases(module):
    assert "Defined results" in module.__doc__


def test_near_dedup_stage_keeps_columns_of_any_name(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(near_dedup, "LISTED", 2)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"{passage} " + " ".join(f"u{k}x{j}" for j in range(30))) for k in range(40)]
    rows += [(50 + k, f"{rows[k][1]} end") for k in range(3)] + [rows[7]]
    df = docs(rows).withColumns({c: F.lit(7) for c in ("__nd_id", "__nd_tid", "__nd_nth")})
    out = corpus_pipeline.dedup_documents(spark, df, str(tmp_path))
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["__nd_id"], r["__nd_tid"], r["__nd_nth"]) for r in out.collect()) == [(k, 7, 7, 7) for k in range(40)]
