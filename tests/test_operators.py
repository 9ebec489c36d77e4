"""Operators on small authored tables."""

import json

import pytest
from pyspark.sql import functions as F

from corpuskiln.operators import chunks, code_graph, comments, components, keyed, messages, near_duplicates, providers, quality, splits
from corpuskiln.sources import files


def test_components_of_any_edge_order(spark):
    edges = [(1, 2), (3, 2), (9, 8), (8, 7), (5, 5), (None, 1)]
    for rows in (edges, edges[::-1]):
        got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(rows, "a int, b int"), "a", "b").collect()}
        assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 5: 5}
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.connected_components(path, "a", "b").filter("component <> 0").isEmpty()
    assert components.connected_components(spark.createDataFrame([], "a int, b int"), "a", "b").isEmpty()


def test_buckets_follow_interpolated_quantiles(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(23)], "k int, v double")
    got = {r["bucket"]: r["count"] for r in splits.quantile_buckets(df, "v", "k").groupBy("bucket").count().collect()}
    assert got == {"1": 5, "2": 4, "3": 5, "4": 4, "5": 5}


def test_split_is_disjoint_and_inherited(spark):
    groups = spark.createDataFrame([(f"g{i}", str(i % 3)) for i in range(60)], "source_id string, b string")
    out = splits.stratified_split(groups, "source_id", "b")
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 48, "val": 6, "test": 6}
    files_ = spark.createDataFrame([("g1",), ("g1",), ("zz",)], "source_id string")
    labels = [r["split"] for r in splits.inherit_split(files_, out, "source_id").collect()]
    assert labels.count(None) == 1 and len(set(labels)) == 2


def test_one_to_one_join_fails_on_repeats(spark):
    left, right = spark.createDataFrame([(1, "a")], "k int, x string"), spark.createDataFrame([(1, "b"), (1, "c")], "k int, y string")
    with pytest.raises(Exception, match="isn't unique"):
        splits.join_one_to_one(left, right, "k").collect()


def test_append_and_upsert(spark, tmp_path):
    stored, new = spark.createDataFrame([("a", "X", "old")], "filename string, scenario string, v string"), spark.createDataFrame([("a", "X", "new"), ("b", "X", "new")], "filename string, scenario string, v string")
    pick = lambda df: sorted((r["filename"], r["v"]) for r in df.collect())
    assert pick(keyed.append_new(stored, new)) == [("a", "old"), ("b", "new")]
    assert pick(keyed.upsert(stored, new)) == [("a", "new"), ("b", "new")]
    with pytest.raises(ValueError):
        keyed.append_new(stored, new.drop("scenario"))
    path = str(tmp_path / "t")
    keyed.write_keyed(stored, path)
    keyed.write_keyed(new, path)
    assert pick(spark.read.schema(new.schema).json(path)) == [("a", "old"), ("b", "new")]
    keyed.write_keyed(new, path, overwrite_existing=True)
    assert pick(spark.read.schema(new.schema).json(path)) == [("a", "new"), ("b", "new")]


def test_cached_provider_asks_once(spark, tmp_path):
    requests = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1)], "key string, n int")
    path = str(tmp_path / "cache")
    first = keyed.call_cached(requests, path, lambda pdf: [f"v{n}" for n in pdf["n"]])
    assert sorted(r["value"] for r in first.collect()) == ["v1", "v1", "v2"]
    again = keyed.call_cached(requests, path, lambda pdf: ["never"] * len(pdf))
    assert sorted(r["value"] for r in again.collect()) == ["v1", "v1", "v2"]


def test_exact_pairs_and_lsh(spark):
    base = [f"w{i}" for i in range(60)]
    docs = [("a", " ".join(base)), ("b", " ".join(base[:58] + ["x", "y"])), ("c", " ".join(f"z{i}" for i in range(60))), ("d", "one two"), ("e", "")]
    df = spark.createDataFrame([(n, t, i) for i, (n, t) in enumerate(docs)], "filename string, content string, row_ord int")
    sets = near_duplicates.shingled(df)
    pairs = near_duplicates.exact_pairs(sets).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [("a", "b")] and pairs[0]["jaccard"] == pytest.approx(54 / 58)
    lsh = near_duplicates.lsh_pairs(near_duplicates.minhash(sets, 64), 16, 4).collect()
    assert ("a", "b") in [(r["a"], r["b"]) for r in lsh]
    files_, pairs_, names = near_duplicates.similarity_run(df)
    keep, drop, clusters = near_duplicates.clustering_run(files_, pairs_)
    assert sorted(r["filename"] for r in keep.collect()) == ["a", "c", "d"] and [r["filename"] for r in drop.collect()] == ["b"]
    assert near_duplicates.exact_pairs(near_duplicates.shingled(df.filter("filename = 'c'"))).isEmpty()


def test_id_chunks(spark):
    df = spark.createDataFrame([("f", list(range(10))), ("e", [])], "filename string, input_ids array<int>")
    got = [(r["chunk_index"], r["input_ids"], r["n_tokens"]) for r in chunks.explode_id_chunks(df, max_len=4, stride=1, pad=-1).collect()]
    assert got == [(0, [0, 1, 2, 3], 4), (1, [3, 4, 5, 6], 4), (2, [6, 7, 8, 9], 4)]
    with pytest.raises(ValueError):
        chunks.id_chunks(F.col("input_ids"), 4, 4)


def test_context_stops_at_the_first_overflow(spark):
    hits = spark.createDataFrame([(1, 1, "", "x" * 1), (1, 2, "", "y" * 1), (1, 3, "", "")], "q int, r int, s string, t string")
    out = chunks.packed_context(hits, "q", "r", "s", "t", 21).collect()
    assert out[0]["n_hits"] == 1


CFG = {"entry": 0, "exit": 3, "nodes": [{"id": i, "kind": "n", "label": ""} for i in range(5)], "edges": [{"from": a, "to": b, "kind": k} for a, b, k in ((0, 1, "branch"), (0, 2, "branch"), (1, 3, "control"), (2, 3, "control"), (0, 4, "decl"))]}


def test_complexity():
    assert code_graph.complexity(CFG) == {"mcc": 2, "edges": 4, "nodes": 4, "components": 1}
    assert code_graph.complexity(CFG, False)["mcc"] == 2
    assert code_graph.complexity(None)["mcc"] is None
    loop = {"entry": 0, "nodes": [{"id": i} for i in range(7)], "edges": [{"from": i, "to": i + 1, "kind": "control"} for i in range(6)] + [{"from": 5, "to": 1, "kind": "back"}]}
    assert code_graph.complexity(loop)["mcc"] == 2
    assert code_graph.spanning_tree(CFG)[1] == [(0, 1, 1), (0, 2, 1), (0, 4, 1), (1, 3, 2)]
    assert code_graph.spanning_tree({"nodes": []}) == (None, [])


def test_dependency_trees():
    defs = [{"name": "a", "kind": "declaration", "references": [{"def": "b"}, {"def": "c"}], "mcc": CFG}, {"name": "b", "kind": "declaration", "references": [{"def": "a"}, {"def": "c"}]}]
    tree = code_graph.dependency_tree(defs, "a")
    assert tree == {"mcc": 2, "children": {"b": {"mcc": None, "children": {"c": {"mcc": None, "children": {}}}}}}
    assert code_graph.dependency_tree(defs, "a", only={"b"})["children"] == {"b": {"mcc": None, "children": {}}}
    assert code_graph.dependency_tree(defs, "a", most=0)["children"] == {}


def test_definitions_of_bad_json(spark):
    df = spark.createDataFrame([("p", json.dumps({"imports": ["A"], "definitions": [{"name": "f::g", "kind": "declaration", "params": ["x"], "mcc": CFG}]})), ("q", "not json"), ("r", None)], "json_path string, json string")
    rows = code_graph.definitions(df).collect()
    assert len(rows) == 1 and rows[0]["base"] == "f" and rows[0]["depth"] == 1 and rows[0]["robust"]["mcc"] == 2


def test_graph_of_modules(spark):
    rows = [("a.cry", "module A where\nimport B\ntype T = [8]\nf : T -> U\n", 0, ["b.cry"]), ("b.cry", "x : Bit\n", 1, [])]
    facts = code_graph.module_facts(spark.createDataFrame(rows, "filename string, content string, row_ord int, file_deps array<string>"))
    nodes, edges = code_graph.dependency_graph(facts)
    assert {(r["src"], r["dst"]): r["rel"] for r in edges.collect()} == {("A", "B"): "imports", ("A", "__file__::b"): "imports", ("A", "A.T"): "uses", ("A", "?.U"): "uses"}
    kinds = {r["id"]: (r["kind"], r["unresolved"]) for r in nodes.collect()}
    assert kinds["?.U"] == ("type", True) and kinds["B"] == ("module", False)


def test_variants_and_decisions(spark):
    rows = [("a.cry", "/* License */\n// Returns x\nf = 1 // tail\n")]
    df = spark.createDataFrame(rows, "filename string, content string")
    out = {r["variant"]: r["content"] for r in comments.simple_variants(df).collect()}
    assert out["without_comments"] == "f = 1 \n" and "License" in out["hybrid"] and "Returns" not in out["hybrid"]
    found, kept = comments.strip_by_decision(df)
    assert [r["keep"] for r in found.orderBy("n").collect()] == [False, True, True]
    assert kept.collect()[0]["content"] == "// Returns x\nf = 1 // tail\n"
    cache = spark.createDataFrame([(r["sha1"], False) for r in found.collect()], "sha1 string, keep boolean")
    assert comments.strip_by_decision(df, cache)[1].collect()[0]["content"] == "f = 1 \n"
    text, index = comments.hybrid_policy(df)
    assert index.count() == 3 and "License" not in text.collect()[0]["content"]


def test_decisions_of_files_with_one_name(spark):
    short, long = "f = 1 // short\n", f"g = 2 // {'neutral ' * 80}\n"
    rows = [("a.cry", short), ("a.cry", long), (None, short), (None, long), ("b.cry", short), ("c.cry", None)]
    df = spark.createDataFrame(rows, "filename string, content string").repartition(3)
    for out in (comments.strip_by_decision(df)[1], comments.hybrid_policy(df)[0]):
        got = [(r["filename"], r["content"]) for r in out.select("filename", "content").collect()]
        alone = {c: None if c is None else next(r["content"] for r in comments.strip_by_decision(df.filter(df.content == c))[1].collect()) for c in (short,)}
        assert sum(c == short for _, c in got) == 3 and alone[short] == short
        assert sum(c is not None and "neutral" not in c and "g = 2" in c for _, c in got) == 2 and ("c.cry", None) in got


def test_part_supplier_components_against_union_find(spark, tmp_path):
    import random

    from corpuskiln.plans.catalog import REGISTRY

    rng = random.Random(2)
    rows = [(rng.randint(1, 60), rng.randint(1, 40)) for _ in range(45)]
    spark.createDataFrame(rows, "l_partkey bigint, l_suppkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r["node"]: r["component"] for r in REGISTRY.queries["components"](spark, str(tmp_path)).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for p, q in rows:
        a, b = sorted((find(f"p{p}"), find(f"s{q}")))
        parent[b] = a
    assert got == {x: find(x) for x in parent}


def test_limits_and_templates(spark):
    df = spark.createDataFrame([(2, 1.0), (3, 2.0), (10, 12.5)], "d int, m double")
    got = [tuple(r["x"]) for r in df.select(messages.simple_limits(F.col("d"), F.col("m")).alias("x")).collect()]
    assert got == [(28, "minimal", True), (44, "standard", False), (130, "detailed", False)]
    one = spark.createDataFrame([(10.0, 13, 0)], "t double, d int, p int").select(messages.masked_limits(F.col("t"), F.col("d"), F.lit(None).cast("double"), F.col("p"), F.lit("declaration")).alias("x"))
    assert tuple(one.collect()[0]["x"]) == (23, "standard", True)
    frame = spark.createDataFrame([("n", ["a", "b"], True)], "name string, parts array<string>, flag boolean")
    text = frame.select(messages.template("{{ name }}: {{ parts | join(', ') }}\n{% if flag %}\nyes\n{% else %}\nno\n{% endif %}\nend", frame).alias("x")).collect()[0]["x"]
    assert text == "n: a, b\nyes\nend"
    with pytest.raises(KeyError):
        messages.template("{{ missing }}", frame)


def test_masked_examples(spark):
    df = spark.createDataFrame([("f.cry", "f x = 1\ng = 2\n", "f", ["x"]), ("g.cry", "h = 1\n", "f", [])], "filename string, content string, def_name string, def_params array<string>")
    out = messages.masked_examples(df).collect()
    assert [r["filename"] for r in out] == ["f.cry"] and out[0]["target_definition"] == "f x = 1"


def test_verifier_and_minimiser(spark):
    df = spark.createDataFrame([("a", "cry", "import X\nimport Y\nuse X"), ("b", "cry", "bad")], "filename string, filetype string, content string")

    def check(name, text):
        if text == "bad":
            raise RuntimeError("boom")
        return ("use X" not in text or "import X" in text), ["X"], None

    got = {r["filename"]: (r["load_ok"], r["error"]) for r in providers.verify_files(df, check).collect()}
    assert got == {"a": (True, None), "b": (False, "boom")}
    kept = providers.verify_and_minimise(df, check).collect()
    assert [(r["content"], r["n_imports_original"], r["n_imports_final"]) for r in kept] == [("import X\nuse X", 2, 1)]
    runs = providers.run_scripts(df.limit(1), ["false"]).collect()[0]
    assert not runs["load_ok"] and runs["returncode"] == 1
    assert providers.run_scripts(df.limit(1), ["/no/such/tool"]).collect()[0]["error"] == "not_found"


def test_batches_halve_on_timeout():
    sizes = []

    def decide(part):
        sizes.append(len(part))
        if len(part) > 2:
            raise TimeoutError
        return [True] * len(part)

    assert providers.batched(list(range(6)), 8, decide, lambda p: [False] * len(p)) == [True] * 6
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return 7

    assert providers.Retry().call(flaky, sleep=lambda s: None) == 7


def test_evaluation(spark):
    tasks = spark.createDataFrame([(1, "t", "function", "setup", ["a", "b"]), (2, "t", "property", None, [])], "task_id int, task string, type string, test_setup_code string, test_list array<string>")
    out = {r["task_id"]: r for r in providers.run_suite(tasks, lambda p: f"```\n{p}\n```", lambda code, test: test == "a", "F {task}", "P {task}").collect()}
    assert (out[1]["n_tests"], out[1]["n_passed"], out[1]["passed"]) == (2, 1, False) and not out[2]["passed"]
    assert out[1]["log"] == "PASS a\nFAIL b"
    rows = spark.createDataFrame([(1, 2, 1, "PASS a\nFAIL b", False)], "task_id int, n_tests int, n_passed int, log string, passed boolean")
    assert providers.report(rows).collect()[0]["report"] == "FAIL task 1: 1/2\nPASS a\nFAIL b"


def test_spanning_tree_column(spark):
    df = spark.createDataFrame([(json.dumps(CFG),)], "j string").select(F.from_json("j", code_graph.CFG).alias("c"))
    tree = df.select(code_graph.spanning_tree_of(F.col("c")).alias("t")).collect()[0]["t"]
    assert tree["root"] == 0 and [(e["parent"], e["child"]) for e in tree["edges"]] == [(0, 1), (0, 2), (0, 4), (1, 3)]


def test_quality_marks_and_routes(spark):
    df = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3)], "sha1 string, row_ord int")
    assert {(r["sha1"], r["row_ord"]): r["is_duplicate"] for r in quality.mark_duplicates(df).collect()} == {("x", 2): True, ("x", 1): False, ("y", 3): False}
    judged = spark.createDataFrame([("a", "ok", True), ("b", "ok", True)], "filename string, fail_reason string, quality_ok boolean")
    out = {r["filename"]: r["fail_reason"] for r in quality.mark_similar(judged, judged.filter("filename = 'b'")).collect()}
    assert out == {"a": "ok", "b": "similiar_file_exists"}


def test_sources(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "A.CRY").write_bytes(b"x\xff\r\ny")
    (tmp_path / "d" / "b.txt").write_text("\nhttp://u\n\n<% one %>\ntail\n<% two\nlines %>\n<% three %>")
    (tmp_path / "d" / "m.md").write_text("# T\n" + "words " * 40)
    got = files.crawl(spark, [str(tmp_path)], prefix=str(tmp_path)).collect()
    assert [(r["filename"], r["filetype"], r["content"]) for r in got] == [("d/A.CRY", "cry", "x�\r\ny")]
    blocks = files.text_dumps(spark, str(tmp_path / "d")).orderBy("n").collect()
    assert [(r["filename"], r["content"]) for r in blocks][:2] == [("http://u", "one"), ("tail", "two\nlines")]
    assert blocks[2]["content"] == "three"
    assert files.markdown_files(spark, str(tmp_path)).count() == 1
    listed = files.listed_files(spark.createDataFrame([("d/A.CRY", 2), ("d/A.CRY", 1), ("gone", 3)], "filename string, row_ord int"), str(tmp_path))
    assert {r["path"].split("/")[-1]: r["content"] for r in files.read_listed(spark, listed, str(tmp_path)).collect()} == {"A.CRY": "x�\ny", "gone": None}
    files.write_json_lines(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "out"))
    assert '"y":null' in "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    vectors = spark.createDataFrame([("i", "t"), ("i", "t"), ("j", "u")], "id string, text string")
    for _ in range(2):
        files.add_to_collection(vectors, str(tmp_path / "coll"))
    assert spark.read.parquet(str(tmp_path / "coll")).count() == 2


def test_streaming_ingest(spark, tmp_path):
    from corpuskiln.streaming import ingest

    folder, table = tmp_path / "in", str(tmp_path / "table")
    folder.mkdir()
    (folder / "1.json").write_text('{"filename":"a","scenario":"X","v":1}\n{"filename":"a","scenario":"X","v":1}\n')
    schema = "filename string, scenario string, v int"
    ingest.ingest(ingest.json_stream(spark, str(folder), schema), table, str(tmp_path / "cp"), ("filename", "scenario")).awaitTermination()
    (folder / "2.json").write_text('{"filename":"a","scenario":"X","v":2}\n{"filename":"b","scenario":"X","v":2}\n')
    ingest.ingest(ingest.json_stream(spark, str(folder), schema), table, str(tmp_path / "cp"), ("filename", "scenario")).awaitTermination()
    assert sorted((r["filename"], r["v"]) for r in spark.read.schema(schema).json(table).collect()) == [("a", 1), ("b", 2)]


def test_dependency_trees_of_every_order(spark):
    from corpuskiln.plans.catalog import REGISTRY

    sf = "/root/testdata/sf0.001"
    lines = {}
    for r in spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity").collect():
        mcc = lines.setdefault(str(r[0]), {})
        # a repeated line counts with its branch
        mcc[r[1]] = max(mcc.get(r[1], 1), 2 if r[2] > 25 else 1)

    def tree(mcc, n):
        return {"mcc": mcc.get(n), "children": {f"f{n - 1}": tree(mcc, n - 1)} if n in mcc else {}}

    out = REGISTRY.queries["dependency_trees"](spark, sf).collect()
    assert len(out) == len(lines) and {r["json_path"]: json.loads(r["tree"]) for r in out} == {k: tree(m, 3) for k, m in lines.items()}


def test_nearest_takes_queries_in_blocks(spark, monkeypatch):
    vectors = {i: [float((i * 37 + j * 11) % 23) for j in range(4)] for i in range(60)}
    rows = spark.createDataFrame([(i, v) for i, v in vectors.items()], "vec_id bigint, embedding array<float>")
    monkeypatch.setattr(chunks, "MAX_QUERIES", 7)
    got = chunks.nearest_of_each(rows.filter("vec_id % 2 = 0"), rows, 3).collect()
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(vectors[a], vectors[b]))
    want = {(q, n + 1, v) for q in range(0, 60, 2) for n, v in enumerate(sorted((v for v in vectors if v != q), key=lambda v: (far(q, v), v))[:3])}
    assert len(got) == 90 and {(r["query_id"], r["rank"], r["vec_id"]) for r in got} == want


def _near_copies(spark, groups=3, size=14):
    """Groups of texts that differ from their neighbours in one word, as files."""
    texts = [" ".join(f"g{g}w{i if i not in range(k * 5 + 5, k * 5 + 7) else f'{i}x{k}'}" for i in range(100)) for g in range(groups) for k in range(size)]
    return spark.createDataFrame([(f"f{i:03d}", t, i) for i, t in enumerate(texts)], "filename string, content string, row_ord int")


def _brute_pairs(sets, threshold=0.7):
    known = {r["filename"]: set(r["shingles"]) for r in sets.collect()}
    share = {(a, b): len(known[a] & known[b]) for a in known for b in known if a < b}
    return {(a, b, n) for (a, b), n in share.items() if n and n / (len(known[a]) + len(known[b]) - n) >= threshold}


@pytest.mark.parametrize("most", [1024, 4])
def test_similar_sets_meet_in_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(near_duplicates, "BLOCK_FILES", most)
    sets = near_duplicates.shingled(_near_copies(spark))
    want = _brute_pairs(sets)
    got = {(r["a"], r["b"], r["intersect_shingles"]) for r in near_duplicates.exact_pairs(sets).collect()}
    assert got == want and len(want) > 100
    clustered = near_duplicates.linked_files(sets.select("filename"), near_duplicates.exact_links(sets)).collect()
    assert {r["filename"]: r["cluster"] for r in clustered} == {f"f{i:03d}": f"f{i // 14 * 14:03d}" for i in range(42)}
    # a set is sent once for every block of its group, not once for every pair
    blocks = -(-14 // most)
    assert near_duplicates._blocks(sets, 0.7).count() <= 42 * (blocks + 1) and near_duplicates.exact_links(sets).count() <= 42 * blocks


def test_shared_values_in_both_ways():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40 if i % 2 else 4000, 60)) for i in range(30)]
    values, owner = np.concatenate(sets), np.repeat(np.arange(30), [len(s) for s in sets])
    left, right = np.arange(0, 12), np.arange(9, 30)
    assert near_duplicates._shared(values, owner, left, right).tolist() == [[len(np.intersect1d(sets[i], sets[j])) for j in right] for i in left]


def test_components_are_finished_in_one_task_or_in_rounds(spark, monkeypatch):
    import random

    rng = random.Random(5)
    rows = [(f"n{rng.randint(1, 90)}", f"n{rng.randint(1, 90)}") for _ in range(60)]
    df = spark.createDataFrame(rows, "a string, b string")
    once = {tuple(r) for r in components.connected_components(df, "a", "b").collect()}
    monkeypatch.setattr(components, "SMALL", -1)
    assert once == {tuple(r) for r in components.connected_components(df, "a", "b").collect()} and len(once) > 50


def test_last_row_of_a_repeated_name_counts(spark):
    rows = [("a", "one two three four five six", 1), ("a", "x y z u v w", 2), ("b", "one two three four five six", 1)]
    got = {r["filename"]: r["shingles"] for r in near_duplicates.shingled(spark.createDataFrame(rows, "filename string, content string, row_ord int")).collect()}
    assert len(got) == 2 and set(got["a"]).isdisjoint(got["b"])


def _definition_files(spark):
    one = {"imports": ["A"], "definitions": [{"name": "f", "kind": "declaration", "params": ["x"], "references": [{"def": "f::g"}, {"op": "+"}], "mcc": CFG}, {"name": "f::g", "kind": "declaration", "references": [{"def": "f"}]}, {"name": "T", "kind": "type"}]}
    rows = [("p", json.dumps(one)), ("p", json.dumps({"imports": [], "definitions": [{"name": "h", "kind": "declaration", "mcc": CFG}]})), ("q", "not json"), ("r", None), ("s", "[1]"), ("t", json.dumps({"definitions": []}))]
    return spark.createDataFrame(rows, "json_path string, json string")


def test_trees_and_summaries_of_files(spark):
    files_ = _definition_files(spark)
    trees = sorted((r["json_path"], r["tree"] or "") for r in code_graph.dependency_trees(files_, "f").collect())
    empty = json.dumps({"children": {}, "mcc": None}, sort_keys=True)
    whole = json.dumps({"mcc": 2, "children": {"f::g": {"mcc": None, "children": {}}}}, sort_keys=True)
    assert trees == [*sorted([("p", empty), ("p", whole)]), ("q", ""), ("r", ""), ("s", ""), ("t", empty)]
    rows = [(r["json_path"], r["num_definitions"], r["imports_count"], r["num_declarations"], r["num_types"], r["num_declarations_with_mcc"], r["total_mcc"], r["max_mcc"], r["avg_mcc"]) for r in code_graph.file_summary(files_).collect()]
    assert sorted(rows[:2]) == [("p", 1, 0, 3, 1, 2, 4, 2, 2.0), ("p", 3, 1, 3, 1, 2, 4, 2, 2.0)]
    assert rows[2:] == [(k, 0, 0, 0, 0, 0, 0, None, None) for k in "qrst"]
    defs = code_graph.definitions(files_).collect()
    assert [(r["name"], [x["def"] for x in r["references"]], r["robust"]["mcc"], r["plain"]["mcc"]) for r in defs] == [("f", ["f::g", None], 2, 2), ("f::g", ["f"], None, None), ("T", [], None, None), ("h", [], 2, 2)]
    best = code_graph.hardest_definitions(code_graph.definitions(files_)).collect()
    assert [(r["json_path"], r["def_name"], r["total"], r["def_params"]) for r in best] == [("p", "f", 2, ["x"])]


def test_equal_graphs_are_measured_once(monkeypatch):
    asked = []
    monkeypatch.setattr(code_graph, "complexity", lambda cfg, robust=True: asked.append(robust) or {"mcc": 1})
    measured = code_graph.Measured()
    assert {measured.place(json.loads(json.dumps(CFG))) for _ in range(50)} == {0} and len(asked) == 2


def test_nearest_is_exact_over_batches(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(chunks, "ROWS_AT_ONCE", 8)
    rng = np.random.default_rng(4)
    rows = np.round(rng.normal(size=(70, 5)), 1)
    rows[40:50] = rows[:10]  # equal distances: the smaller id is nearer
    known = chunks._Nearest(np.arange(0, 70, 7), rows[::7], 6)
    for low in range(0, 70, 8):
        known.take(rows[low : low + 8], np.arange(low, min(low + 8, 70)))
    got = [[] for _ in range(10)]
    for q, v, d in zip(known.at, known.who, known.near):
        got[q].append((d, v))
    exact = lambda a, b: sum((x - y) * (x - y) for x, y in zip(rows[a], rows[b]))
    assert got == [sorted((exact(v, q), v) for v in range(70) if v != q)[:6] for q in range(0, 70, 7)]
