"""Chat examples: messages, prompts, templates, limits and masked definitions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import machines
from corpuskiln.functions.text import excerpt, import_lines, strip

MESSAGE = "array<struct<role:string,content:string>>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _text(c: Column) -> Column:
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def messages(instruction: Column, output: Column, system: str, given: Column | None = None) -> Column:
    """System, user and assistant messages; a non-empty input goes below the instruction."""
    user = F.filter(F.array(_text(instruction)), lambda x: x != "")
    if given is not None:
        user = F.concat(user, F.when(_text(given) != "", F.array(F.concat(F.lit("\n\nInput:\n"), _text(given)))).otherwise(F.array().cast("array<string>")))
    return F.array(message("system", F.lit(system)), message("user", F.array_join(user, "\n")), message("assistant", _text(output)))


def user_content(instruction: Column, given: Column | None = None) -> Column:
    """The instruction, and the input in back-ticks below it."""
    if given is None:
        return _text(instruction)
    return F.when(_text(given) == "", _text(instruction)).otherwise(F.concat(_text(instruction), F.lit("\n`"), _text(given), F.lit("`")))


def fenced(c: Column, language: Column) -> Column:
    return F.concat(F.lit("```"), language, F.lit("\n"), c, F.lit("\n```"))


def chat_by_filetype(df: DataFrame, output: str, prompts: dict[str, str], drop_input: bool = True) -> DataFrame:
    """Messages whose fence and system prompt follow the filetype; code languages are those with a prompt."""
    kind, answer = F.coalesce("filetype", F.lit("")), _text(F.col(output))
    system = F.lit("")
    for language, prompt in prompts.items():
        system = F.when(kind == language, prompt).otherwise(system)
    said = F.when(kind.isin(*prompts), fenced(answer, kind)).otherwise(answer)
    user = user_content(F.col("instruction"), None if drop_input else F.col("input"))
    kept = [c for c in ("filename", "filetype", "set") if c in df.columns]
    return df.select(F.array(message("system", system), message("user", user), message("assistant", said)).alias("messages"), *kept)


def explode_pairs(df: DataFrame) -> DataFrame:
    """One row per question: the page is kept, the answer becomes the content.

    An empty list has no question and goes; a null list does too.
    """
    each = df.filter("qa_pairs IS NOT NULL").select(*[c for c in df.columns if c != "qa_pairs"], F.explode("qa_pairs").alias("__qa"))
    return (
        each.withColumn("page_content", F.col("content"))
        .withColumn("instruction", F.col("__qa.question"))
        .withColumn("content", F.col("__qa.answer"))
        .withColumn("input", F.lit(""))
        .withColumn("output", F.lit(""))
        .withColumn("filetype", F.coalesce("filetype", F.lit("text")))
        .drop("__qa")
    )


def template(source: str, df: DataFrame) -> Column:
    """A template as an expression: ``{{ name }}``, ``{{ name | default('x') }}``, ``{{ name | join(', ') }}`` and if/else/endif.

    An unknown name fails at once.  A line break right after a block tag goes.
    """
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\}\n?)", source, flags=re.S)

    def value(inner: str) -> Column:
        name, *filters = [x.strip() for x in inner.split("|")]
        if name not in df.columns:
            raise KeyError(f"the template needs a column {name}")
        out = F.col(name)
        for f in filters:
            argument = re.search(r"\(\s*(['\"])(.*?)\1\s*\)", f)
            if f.startswith("join"):
                out = F.array_join(out, argument[2] if argument else "")
            elif f.startswith("default"):
                out = F.coalesce(out.cast("string"), F.lit(argument[2] if argument else ""))
            else:
                raise ValueError(f"unknown filter {f}")
        return F.coalesce(out.cast("string"), F.lit(""))

    def truth(name: str) -> Column:
        if name not in df.columns:
            raise KeyError(f"the template needs a column {name}")
        kind = df.schema[name].dataType.simpleString()
        c = F.col(name)
        test = c if kind == "boolean" else F.size(c) > 0 if kind.startswith("array") else c != "" if kind == "string" else c != 0
        return F.coalesce(test, F.lit(False))

    def build(k: int) -> tuple[Column, int, str]:
        out: list[Column] = [F.lit("")]
        while k < len(parts):
            part = parts[k]
            if part.startswith("{{"):
                out.append(value(part[2:-2].strip()))
            elif part.startswith("{%"):
                tag = part.rstrip("\n")[2:-2].strip()
                if tag in ("else", "endif"):
                    return F.concat(*out), k, tag
                if not tag.startswith("if "):
                    raise ValueError(f"unknown tag {tag}")
                yes, k, stop = build(k + 1)
                no = F.lit("")
                if stop == "else":
                    no, k, stop = build(k + 1)
                if stop != "endif":
                    raise ValueError("an if isn't closed")
                out.append(F.when(truth(tag[3:].strip()), yes).otherwise(no))
            elif part:
                out.append(F.lit(part))
            k += 1
        return F.concat(*out), k, ""

    column, _, left = build(0)
    if left:
        raise ValueError(f"{left} without an if")
    return column


def rendered_messages(df: DataFrame, system: str, user: str, assistant: str, out: str = "messages") -> DataFrame:
    return df.withColumn(out, F.array(*[message(role, template(t, df)) for role, t in (("system", system), ("user", user), ("assistant", assistant))]))


def input_mode(code: Column, mode: str, most: int = 512) -> Column:
    """What of the code a prompt shows: nothing, an excerpt, or all."""
    if mode == "none":
        return F.lit("")
    if mode == "full":
        return code
    if mode == "excerpt":
        return excerpt(code, most, "\n")
    raise ValueError(f"unknown mode {mode}")


def simple_limits(declarations: Column, total_mcc: Column) -> Column:
    """Word limit, detail level and thin-wrapper flag of an instruction for a whole file."""
    thin = (declarations <= 2) & (total_mcc <= 1.0)
    budget = 20 + F.least(F.lit(60), declarations * 4) + F.least(F.lit(70), (total_mcc * 6).cast("int"))
    words = F.greatest(F.lit(25), F.least(F.lit(150), budget))
    level = F.when(thin, "minimal").when(words < 110, "standard").otherwise("detailed")
    return F.struct(F.when(thin, 28).otherwise(words).cast("int").alias("instruction_max_words"), level.alias("instruction_detail_level"), thin.alias("is_thin_wrapper"))


def masked_limits(total_mcc: Column, declarations: Column, max_mcc: Column, params: Column, kind: Column) -> Column:
    """Word limit, detail level and one-sentence flag of an instruction for a masked definition."""
    local = F.least(F.lit(18), (F.greatest(F.lit(0.0), max_mcc - 1.0) * 3).cast("int"))
    whole = F.least(F.lit(12), (F.greatest(F.lit(0.0), F.coalesce(total_mcc, F.lit(0.0))) * 0.7).cast("int"))
    size = F.least(F.lit(8), F.floor(F.coalesce(declarations, F.lit(0)) / 6).cast("int"))
    budget = 14 + F.when(max_mcc.isNotNull(), local).otherwise(whole) + size + F.least(F.lit(6), params * 2) - F.when(kind == "property", 3).otherwise(0)
    words = F.greatest(F.lit(10), F.least(F.lit(45), budget)).cast("int")
    return F.struct(words.alias("instruction_max_words"), F.when(words <= 22, "minimal").otherwise("standard").alias("instruction_detail_level"), (words <= 28).alias("is_thin_wrapper"))


def masked_examples(df: DataFrame, hole: str = "/* Finish this definition. */") -> DataFrame:
    """Rows with def_name and def_params, their source masked; those without the definition go."""
    out = df.withColumn("__m", machines.masked(F.col("content"), F.col("def_name"), F.col("def_params"), hole)).filter("__m IS NOT NULL")
    return out.select(*df.columns, F.col("__m.masked_source").alias("masked_source"), F.col("__m.removed_definition").alias("target_definition"), F.col("__m.hole_name").alias("hole_name"))


def clean_instruction(c: Column) -> Column:
    return strip(F.regexp_replace(c, "```[a-z]*|`", ""))


def retrieval_query(filename: Column, language: Column, code: Column, most: int = 1200) -> Column:
    """Text that finds passages for a file: language, path, module, imports and an excerpt."""
    source = F.coalesce(code, F.lit(""))
    names = r"(?mUd)^\s*import\s+([A-Za-z_][\w:.'\"]*)"
    module = F.nullif(F.regexp_extract(source, r"(?mUd)^\s*module\s+([A-Za-z_][\w:]*)", 1), F.lit(""))
    imports = F.slice(F.array_distinct(F.regexp_extract_all(source, F.lit(names), F.lit(1))), 1, 20)
    is_code = F.lower(language).isin("cryptol", "saw", "sawscript")
    return F.concat_ws(
        "\n",
        F.concat(F.lit("language: "), language),
        F.concat(F.lit("file: "), filename),
        F.when((F.lower(language) == "cryptol") & module.isNotNull(), F.concat(F.lit("module: "), module)),
        F.when(is_code & (F.size(imports) > 0), F.concat(F.lit("imports: "), F.array_join(imports, ", "))),
        F.concat(F.lit("code excerpt:\n"), excerpt(source, most)),
    )


def message_text(c: Column) -> Column:
    """Roles and contents joined by line feeds, to be counted."""
    return F.array_join(F.flatten(F.transform(c, lambda m: F.array(m["role"], m["content"]))), "\n")


def import_split(code: Column) -> dict[str, Column]:
    """Header, import block and body of a file, and the number of imports."""
    rows = F.split(code, "\n")
    flags = F.transform(rows, lambda x: F.ltrim(x).startswith("import "))
    first = F.array_position(flags, True)
    last = F.size(rows) + 1 - F.array_position(F.reverse(flags), True)
    return {
        "header": F.when(first > 0, F.array_join(F.slice(rows, F.lit(1), F.greatest(first - 1, F.lit(0)).cast("int")), "\n")).otherwise(F.lit("")),
        "imports": F.when(first > 0, F.array_join(F.slice(rows, F.greatest(first, F.lit(1)).cast("int"), F.greatest(last - first + 1, F.lit(0)).cast("int")), "\n")).otherwise(F.lit("")),
        "body": F.when(first > 0, F.array_join(F.slice(rows, (last + 1).cast("int"), F.size(rows)), "\n")).otherwise(code),
        "n_imports": F.size(import_lines(code)),
    }
