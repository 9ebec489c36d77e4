"""Cached model calls and the command line."""

import subprocess
import sys
from pathlib import Path

import pytest

from corpuskiln.operators import generation as G

MODEL = G.Model("m", "system", "Write about {{ filename }} in {{ instruction_max_words }} words.{% if has_module_header %} A module.{% endif %}")


def test_instructions_are_asked_once(spark, tmp_path):
    df = spark.createDataFrame([("a.cry", "module A where\nx = 1", 1, 1.0), ("b.cry", "y = 2", 9, 9.0)], "filename string, content string, num_declarations int, total_mcc double")
    path = str(tmp_path / "c")
    out = {r["filename"]: r["instruction"] for r in G.instructions(df, MODEL, lambda p: ["```" + x + "```" for x in p["prompt"]], path).collect()}
    assert out == {"a.cry": "Write about a.cry in 28 words. A module.", "b.cry": "Write about b.cry in 110 words."}
    again = {r["instruction"] for r in G.instructions(df, MODEL, lambda p: ["never"] * len(p), path).collect()}
    assert again == set(out.values())
    with pytest.raises(ValueError):
        G.instructions(df.drop("content"), MODEL, lambda p: [], path)


def test_masked_and_explained(spark, tmp_path):
    df = spark.createDataFrame([("a", "f", ["x"], "src", "f x = 1", 2.0, 3, 2.0)], "filename string, def_name string, def_params array<string>, masked_source string, target_definition string, total_mcc double, num_declarations int, max_mcc double")
    told = G.masked_instructions(df, G.Model("m", "s", "{{ def_name }} {{ instruction_max_words }}"), lambda p: list(p["prompt"]), str(tmp_path / "i"))
    assert told.collect()[0]["instruction"] == "f 19"
    out = G.explanations(told, G.Model("m", "s", "{{ masked_source }}"), lambda p: ["some words here"] * len(p), str(tmp_path / "e")).collect()[0]
    assert out["explanation_comment"] == "// some words here"
    chat = G.completion_messages(told, "sys").collect()[0]["messages"]
    assert [m["role"] for m in chat] == ["system", "user", "assistant"] and chat[2]["content"].startswith("```cryptol\nf x = 1")


def test_cleaning_and_parsing(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "content string")
    out = G.cleaned_texts(df, lambda p: [x.upper() for x in p["content"]], str(tmp_path / "t"))
    assert sorted(r["processed"] for r in out.collect()) == ["A", "A", "B"]
    rows = spark.createDataFrame([('{"instruction":"i","input":"","output":""}',), ("nope",)], "value string")
    assert [r["valid"] for r in G.parsed_rows(rows).orderBy("valid").collect()] == [False, True]


def test_command_line(tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.cry").write_text("s = [1,2]\n")
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-m", "corpuskiln", "reflow", str(tmp_path / "src"), "--out", str(tmp_path / "out")], check=True, cwd=root, timeout=120, capture_output=True)
    assert "[ 1, 2]" in "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
