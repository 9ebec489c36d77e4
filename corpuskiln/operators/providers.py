"""External effects as pluggable providers: verifiers, generators, retries, and the deterministic stand-ins."""

from __future__ import annotations

import random
import subprocess
import tempfile
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Retry:
    """How often a call is repeated, and how long to wait in between."""

    attempts: int = 5
    first_wait: float = 0.5
    growth: float = 1.8
    jitter: float = 0.1

    def call(self, fn: Callable[[], object], sleep: Callable[[float], None] = time.sleep) -> object:
        for k in range(self.attempts):
            try:
                return fn()
            except Exception:
                if k + 1 == self.attempts:
                    raise
                sleep(self.first_wait * self.growth**k * (1 + random.random() * self.jitter))
        raise AssertionError


def batched(items: list, size: int, decide: Callable[[list], list], fallback: Callable[[list], list]) -> list:
    """Decisions of ``items`` in batches: a batch that times out is halved, one that succeeds doubles the next."""
    out, at, now = [], 0, max(1, size)
    while at < len(items):
        part = items[at : at + now]
        try:
            out += decide(part)
        except TimeoutError:
            if now > 1:
                now = max(1, now // 2)
                continue
            out += fallback(part)
        at += len(part)
        now = min(size, now * 2)
    return out


Verifier = Callable[[str, str], tuple[bool, list[str], str | None]]
VERIFIED = "filename string, load_ok boolean, file string, error string, file_deps array<string>"


def verify_files(files: DataFrame, verifier: Verifier) -> DataFrame:
    """filename, load_ok, file, error, file_deps: a verifier's verdict on each file; an exception is a failure."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, content in zip(frame["filename"], frame["content"]):
                try:
                    ok, deps, error = verifier(name, content or "")
                except Exception as e:
                    ok, deps, error = False, [], str(e)
                rows.append((name, bool(ok), name, error, list(deps)))
            yield pd.DataFrame(rows, columns=["filename", "load_ok", "file", "error", "file_deps"])

    return files.select("filename", "content").mapInPandas(run, VERIFIED)


def minimise_imports(content: str, loads: Callable[[str], bool], blank: bool = False) -> tuple[str, int, int]:
    """Text with every import dropped (or blanked) that isn't needed to load, and their number before and after."""
    rows = content.split("\n")
    imports = [i for i, r in enumerate(rows) if r.lstrip().startswith("import ")]
    gone: set[int] = set()

    def without(dropped: set[int]) -> str:
        return "\n".join("" if i in dropped else r for i, r in enumerate(rows) if blank or i not in dropped)

    for i in imports:
        if loads(without(gone | {i})):
            gone.add(i)
    return without(gone), len(imports), len(imports) - len(gone)


def verify_and_minimise(files: DataFrame, verifier: Verifier) -> DataFrame:
    """Files that load, with needless imports dropped: filename, filetype, content, n_imports_original, n_imports_final."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, kind, content in zip(frame["filename"], frame["filetype"], frame["content"]):
                def loads(text: str, name=name) -> bool:
                    try:
                        return bool(verifier(name, text)[0])
                    except Exception:
                        return False

                if loads(content or ""):
                    rows.append((name, kind, *minimise_imports(content or "", loads)))
            yield pd.DataFrame(rows, columns=["filename", "filetype", "content", "n_imports_original", "n_imports_final"])

    return files.select("filename", "filetype", "content").mapInPandas(run, "filename string, filetype string, content string, n_imports_original int, n_imports_final int")


RUN = "filename string, load_ok boolean, returncode int, stdout string, stderr string, cmd array<string>, error string"


def run_scripts(files: DataFrame, command: list[str], suffix: str = ".saw", timeout: float = 60.0) -> DataFrame:
    """Result of an external command on each file in a folder of its own; it never raises.

    ``error`` is null, ``timeout``, ``not_found`` or the text of another failure.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, content in zip(frame["filename"], frame["content"]):
                with tempfile.TemporaryDirectory() as folder:
                    path = Path(folder) / f"script{suffix}"
                    path.write_text(content or "", encoding="utf-8")
                    cmd, code, out, err, error = [*command, str(path)], None, "", "", None
                    try:
                        done = subprocess.run(cmd, capture_output=True, text=True, timeout=timeout, cwd=folder, check=False)
                        code, out, err = done.returncode, done.stdout, done.stderr
                    except subprocess.TimeoutExpired:
                        error = "timeout"
                    except FileNotFoundError:
                        error = "not_found"
                    except Exception as e:
                        error = str(e)
                    rows.append((name, code == 0, code, out, err, cmd, error))
            yield pd.DataFrame(rows, columns=["filename", "load_ok", "returncode", "stdout", "stderr", "cmd", "error"]).astype({"returncode": "Int32"})

    return files.select("filename", "content").mapInPandas(run, RUN)


def eval_prompts(tasks: DataFrame, function_template: str, property_template: str) -> DataFrame:
    """``prompt`` of each task by its type, with its setup code."""
    def fill(t: str):
        return F.replace(F.lit(t), F.lit("{task}"), F.col("task"))

    base = F.when(F.coalesce("type", F.lit("function")) == "property", fill(property_template)).otherwise(fill(function_template))
    setup = F.coalesce("test_setup_code", F.lit(""))
    return tasks.withColumn("prompt", F.concat(base, F.when(setup != "", F.concat(F.lit("\n### Additional setup code:\n```cryptol\n"), setup, F.lit("\n```"))).otherwise("")))


def run_tests(answers: DataFrame, check: Callable[[str, str], bool]) -> DataFrame:
    """task_id, n_tests, n_passed, passed, log: every test of a task against the answer's code.

    ``check(code, test)`` decides; code isn't executed here.  A failing check is
    a failed test, a task without tests doesn't pass.
    """
    from corpuskiln.functions.text import first_code_block

    each = answers.select("task_id", first_code_block(F.col("answer")).alias("code"), F.posexplode_outer("test_list").alias("n", "test"))

    @F.udf("boolean", useArrow=True)
    def passed(code, test):
        try:
            return bool(check(code or "", test)) if test is not None else None
        except Exception:
            return False

    done = each.withColumn("ok", passed(F.col("code"), F.col("test")))
    line = F.concat(F.when(F.col("ok"), "PASS ").otherwise("FAIL "), F.col("test"))
    log = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", line.alias("l")))), lambda x: x["l"]), "\n")
    sums = done.groupBy("task_id").agg(F.count("test").alias("n_tests"), F.count_if("ok").alias("n_passed"), log.alias("log"))
    return sums.withColumn("passed", (F.col("n_tests") > 0) & (F.col("n_tests") == F.col("n_passed")))


def report(results: DataFrame) -> DataFrame:
    """One line of text per task: verdict, counts and the tests' log."""
    head = F.concat(F.when(F.col("passed"), "PASS").otherwise("FAIL"), F.lit(" task "), F.col("task_id").cast("string"), F.lit(": "), F.col("n_passed").cast("string"), F.lit("/"), F.col("n_tests").cast("string"))
    return results.select("task_id", F.concat_ws("\n", head, F.nullif(F.col("log"), F.lit(""))).alias("report"))


def pass_rates(results: DataFrame, by: str) -> DataFrame:
    return results.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("passed").cast("double")).alias("pass_rate"))


def run_suite(tasks: DataFrame, generate: Callable[[str], str], check: Callable[[str, str], bool], function_template: str = "{task}", property_template: str = "{task}") -> DataFrame:
    """Prompts, answers by ``generate``, tests by ``check``."""
    prompted = eval_prompts(tasks, function_template, property_template)

    @F.udf("string", useArrow=True)
    def answer(prompt):
        return generate(prompt)

    return run_tests(prompted.withColumn("answer", answer(F.col("prompt"))), check)
