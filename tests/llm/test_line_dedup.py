import random

import duckdb

from corpuskiln.llm import line_dedup as D


def brute(rows):
    """Texts after dedup; rows with equal id and text count once."""
    seen, out = {}, {}
    for key in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = key[1].split("\n"), set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if any(x.strip(" ") for x in window):
                if window in seen:
                    gone |= {i, i + 1, i + 2}
                seen.setdefault(window, key)
        out[key] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return [(i, out.get((i, t))) for i, t in rows]


def run(df):
    return sorted(((r["doc_id"], r["text"]) for r in D.line_dedup(df).collect()), key=repr)


def test_random_documents_against_brute_force(spark, docs):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice(["a", "b", "", " ", "c d"]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    assert run(docs(rows)) == sorted(brute(rows), key=repr)


def test_edges(spark, docs):
    rows = [(2, "a\nb\nc\nd"), (1, "x\na\nb\nc"), (3, None), (4, ""), (5, "\n\n\n"), (6, "\n\n\n"), (None, "a\nb\nc"), (1, "x\na\nb\nc"), (7, "p\np\np\np\np"), (8, "a\nb")]
    assert run(docs(rows)) == sorted(brute(rows), key=repr)
    assert D.line_dedup(docs([])).count() == 0


def test_a_hot_window_and_other_columns(spark, docs):
    hot = "l1\nl2\nl3\n"
    df = docs([(i, f"own {i}\n" + hot + f"tail {i}") for i in range(400)]).repartition(7)
    out = D.remove_repeated_lines(df)
    assert out.columns == df.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["text"].count("l2") == 1 and sum("l2" in r["text"] for r in rows.values()) == 1
    assert rows[9]["text"] == "own 9\ntail 9" and rows[9]["n_chars"] == len(rows[9]["text"]) and rows[9]["bucket"] == "z"


def test_long_text(spark, docs):
    long = "\n".join(str(i % 3_000) for i in range(9_000))
    rows = [(1, long), (2, "z")]
    assert run(docs(rows)) == sorted(brute(rows), key=repr)


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = sorted(con.sql(f"SELECT doc_id, text FROM ({D.SQL})").fetchall(), key=repr)
    assert run(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")) == want
