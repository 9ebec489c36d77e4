"""Scanners for what regular expressions can't express: nesting, balance and greedy layout.

Each is a plain function over one text, used through the Arrow wrappers at the
end and tested without Spark.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"""(?P<literal>"(?:[^"\\]|\\.)*+(?:"|\\?\Z)|'(?:[^'\\]|\\.)*+(?:'|\\?\Z))|(?P<line>//)|(?P<block>/\*)""", re.S)
_NEST = re.compile(r"/\*|\*/")


def strip_nested_comments(text: str, keep_line_ends: bool = False) -> tuple[str, int, int]:
    """Text without ``//`` and nested ``/* */`` comments, and how many of each there were.

    Literals in single or double quotes are copied.  Unless ``keep_line_ends``
    the line feed that ends a ``//`` comment goes with it.
    """
    out, at, line_count, block_count = [], 0, 0, 0
    while found := _TOKEN.search(text, at):
        out.append(text[at : found.start()])
        at = found.end()
        if found["literal"] is not None:
            out.append(found["literal"])
        elif found["line"] is not None:
            line_count += 1
            end = text.find("\n", at)
            at = len(text) if end < 0 else end + (not keep_line_ends)
        else:
            block_count, depth = block_count + 1, 1
            while depth:
                edge = _NEST.search(text, at)
                if edge is None:
                    at = len(text)
                    break
                at = edge.end()
                opens = edge[0] == "/*"
                depth += 1 if opens else -1
                block_count += opens
    out.append(text[at:])
    return "".join(out), line_count, block_count


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str
    text: str


_MANY = (("block", re.compile(r"/\*.*?\*/", re.S)), ("//", re.compile(r"(?:^|\s)//[^\n]*", re.M)), ("#", re.compile(r"(?:^|\s)#(?!!).*", re.M)), ("--", re.compile(r"(?:^|\s)--[^\n]*", re.M)), (";", re.compile(r"(?:^|\s);[^\n]*", re.M)))


def comment_spans(text: str) -> list[Span]:
    """Comments of any of five styles by start; runs of ``//`` with only blanks between are one; nested ones are left out."""
    found = sorted((Span(m.start(), m.end(), kind, m[0]) for kind, rx in _MANY for m in rx.finditer(text)), key=lambda s: s.start)
    out: list[Span] = []
    for span in found:
        last = out[-1] if out else None
        if last and span.start < last.end:
            continue
        if last and span.kind == last.kind == "//" and not text[last.end : span.start].strip(" \t\n"):
            out[-1] = Span(last.start, span.end, "//", last.text + span.text)
        else:
            out.append(span)
    return out


def blank_comments(text: str, kept: Callable[[Span], bool] = lambda s: False) -> tuple[str, list[Span]]:
    """Text whose comments are replaced by their line feeds, unless kept; and all spans."""
    spans, out, at = comment_spans(text), [], 0
    for span in spans:
        out += [text[at : span.start], span.text if kept(span) else "\n" * span.text.count("\n")]
        at = span.end
    return "".join([*out, text[at:]]), spans


_CRY_BLOCK, _CRY_LINE, _CRY_DOC = re.compile(r"/\*(?!\*).*?\*/", re.S), re.compile(r"//[^\n]*"), re.compile(r"/\*\*.*?\*/", re.S)
_ONE_BREAK = re.compile(r"\r?\n[ \t]*")


def policy_spans(text: str) -> list[Span]:
    """``//`` and ``/* */`` but not ``/** */``, none inside another; line comments on successive lines are one."""
    found = sorted(((m.start(), m.end(), kind) for kind, rx in (("block", _CRY_BLOCK), ("line", _CRY_LINE)) for m in rx.finditer(text)))
    out: list[tuple[int, int, str]] = []
    for start, end, kind in found:
        if out and start < out[-1][1]:
            continue
        if out and kind == out[-1][2] == "line" and _ONE_BREAK.fullmatch(text, out[-1][1], start):
            out[-1] = (out[-1][0], end, kind)
        else:
            out.append((start, end, kind))
    return [Span(s, e, k, text[s:e]) for s, e, k in out]


def code_after(text: str, spans: list[Span], at: int, most: int = 4000) -> str:
    """Code between a comment and the next, without doc comments and a leading blank line."""
    stop = spans[at + 1].start if at + 1 < len(spans) else len(text)
    return re.sub(r"\A\s*\n", "", _CRY_DOC.sub("", text[spans[at].end : stop][:most]), count=1)


def drop_spans(text: str, spans: list[Span], kept: list[bool]) -> str:
    """Text without the spans that aren't kept; one alone on its lines takes its line end along."""
    out, at = [], 0
    for span, keep in zip(spans, kept):
        if keep:
            continue
        end, eol = span.end, text.find("\n", span.end)
        eol = len(text) if eol < 0 else eol
        if not text[text.rfind("\n", 0, span.start) + 1 : span.start].strip() and not text[span.end : eol].strip():
            end = min(eol + 1, len(text))
        out.append(text[at : max(at, span.start)])
        at = max(at, end)
    return "".join([*out, text[at:]])


def chunk_by_budget(text: str, max_tokens: int, overlap_tokens: int = 64, chars_per_token: float = 4.0, prefer_lines: bool = True) -> list[tuple[int, int]]:
    """(start, end) of windows of so many tokens; one that isn't the last ends at its last line feed if that's in its second half."""
    width, overlap = int(max_tokens * chars_per_token), int(overlap_tokens * chars_per_token)
    if len(text) <= max_tokens * max(1e-6, chars_per_token):
        return [(0, len(text))]
    out, start = [], 0
    while True:
        end = min(len(text), start + width)
        if prefer_lines and end < len(text):
            cut = text.rfind("\n", start, end)
            if cut - start >= int(0.5 * width):
                end = cut + 1
        out.append((start, end))
        if end >= len(text):
            return out
        start = max(start + 1, end - overlap)


_FENCED_HEAD = re.compile(r"(?m)^(#{1,6}\s+.*)$")
_HEAD = re.compile(r"#{1,6}\s+")


def markdown_chunks(text: str, source: str, most: int = 1800, overlap: int = 200, least: int = 600, signal: int = 80) -> list[dict]:
    """Heading sections packed in order into chunks of at most ``most`` characters.

    An oversize section is cut into overlapping windows that repeat its heading.
    Chunks of under ``signal`` characters besides headings go, and one of under
    ``least`` joins the next if both fit.
    """
    text = re.sub(r"\A---\s*\n.*?\n---\s*\n", "", text, count=1, flags=re.S).replace("\r\n", "\n")
    sections: list[str] = []
    heads = list(_FENCED_HEAD.finditer(text))
    bounds = [0, *(m.start() for m in heads), len(text)]
    for begin, end in zip(bounds, bounds[1:]):
        if text[begin:end].strip():
            m = _FENCED_HEAD.match(text, begin)
            sections.append(f"{m[1].strip()}\n{text[m.end():end]}".strip() if m else text[begin:end].strip())

    def chunk(body: str, first: int, last: int, start: int | None = None) -> dict:
        place = f"{source}:{first}:{last if start is None else start}"
        return {"id": hashlib.sha256(f"{place}\n{body}".encode()).hexdigest()[:24], "text": body, "source": source, "section_start": first, "section_end": last, "start_char": start}

    def windows(section: str, k: int) -> Iterator[dict]:
        first, _, rest = section.partition("\n")
        head = first.strip() if first.lstrip().startswith("#") else ""
        body = "\n".join(section.splitlines()[1:]).strip() if head else section
        room, at = max(1, most - len(head) - bool(head)), 0
        while at < len(body):
            end = min(len(body), at + room)
            if part := body[at:end].strip():
                yield chunk(f"{head}\n{part}".strip() if head else part, k, k, at)
            if end == len(body):
                return
            at = max(at + 1, end - overlap)

    packed: list[dict] = []
    waiting: list[str] = []
    first = 0

    def flush(last: int) -> None:
        if waiting and (body := "\n\n".join(waiting).strip()):
            packed.append(chunk(body, first, last))
        waiting.clear()

    for k, section in enumerate(sections):
        if len(section) > most:
            flush(k - 1)
            packed += windows(section, k)
        elif waiting and len("\n\n".join([*waiting, section])) <= most:
            waiting.append(section)
        else:
            flush(k - 1)
            waiting.append(section)
            first = k
    flush(len(sections) - 1)

    def substance(c: dict) -> int:
        return len(" ".join(x for x in c["text"].splitlines() if x.strip() and not _HEAD.match(x.strip())).strip())

    useful, out = [c for c in packed if substance(c) >= signal], []
    while useful:
        now = useful.pop(0)
        if useful and len(now["text"]) < least and len(both := f"{now['text']}\n\n{useful[0]['text']}".strip()) <= most:
            now = chunk(both, now["section_start"], useful.pop(0)["section_end"])
        out.append(now)
    return out


_OPENERS, _CLOSERS = "([{", ")]}"


def _depths(inner: str) -> Iterator[tuple[int, str, bool]]:
    """(place, character, whether every bracket is closed before it)."""
    depth = {c: 0 for c in _OPENERS}
    for i, c in enumerate(inner):
        if c in _CLOSERS:
            depth[_OPENERS[_CLOSERS.index(c)]] -= 1
        yield i, c, not any(depth.values())
        if c in _OPENERS:
            depth[c] += 1


def is_comprehension(inner: str) -> bool:
    return any(c == "|" and top for _, c, top in _depths(inner))


def split_elements(inner: str) -> list[str]:
    cuts = [i for i, c, top in _depths(inner) if c == "," and top]
    return [e for a, b in zip([-1, *cuts], [*cuts, len(inner)]) if (e := inner[a + 1 : b].strip())]


def wrap_list(indent: str, prefix: str, elements: list[str], width: int) -> str:
    """``prefix[ a, b ]`` wrapped to ``width``, later lines under the first element."""
    if not elements:
        return f"{indent}{prefix}[]"
    tokens = [e + "," for e in elements[:-1]] + [elements[-1]]
    rows = [f"{indent}{prefix}[ {tokens[0]}"]
    for token in tokens[1:]:
        if len(rows[-1]) + 1 + len(token) <= width:
            rows[-1] += f" {token}"
        else:
            rows.append(f"{indent}{' ' * (len(prefix) + 1)} {token}")
    if len(rows[-1]) < width:
        rows[-1] += "]"
    else:
        rows.append(f"{indent}{prefix}]")
    return "\n".join(rows)


def reflow_sequences(text: str, width: int = 80) -> str:
    """Every bracketed list with commas that isn't a comprehension is wrapped to ``width``."""
    out, at = "", 0
    while (begin := text.find("[", at)) >= 0:
        out += text[at:begin]
        depth = end = 0
        for m in re.compile(r"[\[\]]").finditer(text, begin):
            depth += 1 if m[0] == "[" else -1
            if not depth:
                end = m.end()
                break
        if not end:
            out, at = out + "[", begin + 1
            continue
        inner, at = text[begin + 1 : end - 1], end
        if "," not in inner or is_comprehension(inner):
            # a line inside a copied list doesn't count as the start of the list's own line
            out += "[" + inner.replace("\n", "\x00") + "]"
            continue
        line = out.rfind("\n") + 1
        before = out[line:]
        code = before.lstrip()
        indent = before[: len(before) - len(code)]
        out = out[:line] + wrap_list(indent, code, split_elements(inner), width)
    return (out + text[at:]).replace("\x00", "\n")


_HEX = re.compile(r"0x[0-9a-fA-F]+")
_HEX_LIST = re.compile(r"\s*0x[0-9a-fA-F]+(?:\s*,\s*0x[0-9a-fA-F]+)*\s*(?:,\s*)?")


def is_hex_list(inner: str) -> bool:
    return _HEX_LIST.fullmatch(inner) is not None


def reflow_hex(text: str, width: int = 80, tab: int = 8) -> str:
    """Lists of hex literals alone are wrapped, on the beginnings of the lines they have."""

    def one(m: re.Match) -> str:
        block = m[0]
        if not is_hex_list(block[1:-1]):
            return block
        rows = block.splitlines()
        starts = [(i, r[: h.start()]) for i, r in enumerate(rows) if (h := _HEX.search(r))]
        closing = next((r[: r.index("]")] for r in rows if "]" in r), starts[0][1])
        tokens = _HEX.findall(block)
        tokens = [t + "," for t in tokens[:-1]] + tokens[-1:]
        done, used = rows[: starts[0][0]], 0
        now = starts[0][1] + (tokens[0] if len((starts[0][1] + tokens[0]).expandtabs(tab)) <= width else "")
        for token in tokens[1:] if now != starts[0][1] or not tokens[0] else tokens:
            if len(f"{now} {token}".expandtabs(tab)) <= width:
                now = f"{now} {token}"
            else:
                done.append(now)
                used = min(used + 1, len(starts) - 1)
                now = starts[used][1] + token
        done += [now + "]"] if len((now + "]").expandtabs(tab)) <= width else [now, closing + "]"]
        return "\n".join(done)

    return re.sub(r"\[[\s\S]*?\]", one, text)


def _top_level(line: str, name: str) -> bool:
    """Whether a line at the margin begins something other than ``name``."""
    if not line or line[0].isspace() or line.startswith(("//", "/*")):
        return False
    if re.match(rf"(?:property\s+)?{re.escape(name)}\b", line):
        return False
    return re.match(r"(?:module|import|include|type|newtype|enum|primitive|parameter|interface|foreign|private|property|infix[lr]?|submodule)\b|[A-Za-z_][\w']*\b.*[:=]|\([^)]*\)\s*[:=]", line) is not None


def mask_definition(text: str, name: str, params: list[str], hole: str | None = None) -> dict | None:
    """The text with the equations of ``name`` replaced by ``name params = hole``; None if there are none.

    A signature stays; one with the equation on its line is split from it.
    """
    hole, quoted, rows = hole or f"__HOLE_{name}", re.escape(name), []
    for line in text.splitlines():
        both = re.match(rf"^(\s*{quoted}\s*:\s*.*?)(\s+{quoted}\b.*)$", line)
        rows += [both[1].rstrip(), both[2].lstrip()] if both else [line]
    begins = re.compile(rf"\s*(?:property\s+{quoted}\b.*?\s*=\s*|(?!{quoted}\s*:\s*){quoted}\b(?!\s*:).*?\s=\s*)")
    start = next((i for i, r in enumerate(rows) if begins.match(r)), None)
    if start is None:
        return None
    indent = len(rows[start]) - len(rows[start].lstrip(" "))
    end = start + 1
    for end in range(start + 1, len(rows) + 1):
        if end == len(rows):
            break
        bare = rows[end].strip()
        if not bare or bare.startswith(("//", "/*")):
            continue
        if len(rows[end]) - len(rows[end].lstrip(" ")) < indent or (not indent and _top_level(rows[end], name)):
            break
    prefix = "property " if re.match(rf"\s*property\s+{quoted}\b", rows[start]) else ""
    stub = prefix + " ".join([name, *params]) + f" = {hole}\n"
    return {"masked_source": "\n".join([*rows[:start], stub, *rows[end:]]), "removed_definition": "\n".join(rows[start:end]), "hole_name": hole}


def balanced_braces(text: str, start: int) -> int:
    """End of the brace group at ``start``; of the text if it never closes."""
    depth = 0
    for m in re.compile(r"[{}]").finditer(text, start):
        depth += 1 if m[0] == "{" else -1
        if not depth:
            return m.end()
    return len(text)


_TYPE_HEAD = re.compile(r"(?m)^\s*type\s+([A-Z][A-Za-z0-9_]*)\b[^\n=]*=\s*")


def type_definitions(text: str) -> dict[str, str]:
    """Type names with their bodies: a brace group, or the rest of the line."""
    out = {}
    for m in _TYPE_HEAD.finditer(text):
        end = balanced_braces(text, m.end()) if text[m.end() : m.end() + 1] == "{" else text.find("\n", m.end())
        out[m[1]] = text[m.end() : len(text) if end < 0 else end].strip()
    return out


# Arrow-batched columns


def over_text(fn: Callable[[str], object], kind: T.DataType | str) -> Callable[[Column], Column]:
    """A Column function that applies ``fn`` to whole texts; null stays null."""

    def column(c: Column) -> Column:
        @F.pandas_udf(kind)
        def run(texts: pd.Series) -> pd.Series:
            return texts.map(fn, na_action="ignore").astype(object).where(texts.notna(), None)

        return run(c)

    return column


def over_texts(fn: Callable[[str], list], kind: str) -> Callable[[Column], Column]:
    """As ``over_text`` for functions that return arrays, maps or structs.

    It counts as nondeterministic, so a plan that explodes its result or takes
    several of its fields can't repeat the call.
    """

    def column(c: Column) -> Column:
        @F.udf(kind, useArrow=True)
        def run(text):
            return None if text is None else fn(text)

        return run.asNondeterministic()(c)

    return column


SPAN_TYPE = "array<struct<start:int,end:int,kind:string,text:string>>"
CHUNK_TYPE = "array<struct<id:string,text:string,source:string,section_start:int,section_end:int,start_char:int>>"

strip_all_comments = over_text(lambda s: strip_nested_comments(s)[0], "string")
strip_comments_counted = over_texts(lambda s: dict(zip(("text", "line", "block"), strip_nested_comments(s, True))), "struct<text:string,line:int,block:int>")
spans_of = over_texts(lambda s: [vars(x) for x in comment_spans(s)], SPAN_TYPE)
policy_spans_of = over_texts(lambda s: [vars(x) | {"context": code_after(s, spans, i)} for spans in [policy_spans(s)] for i, x in enumerate(spans)], SPAN_TYPE[:-2] + ",context:string>>")
without_comments = over_text(lambda s: blank_comments(s)[0], "string")
reflow_lists = over_text(reflow_sequences, "string")
reflow_hex_lists = over_text(reflow_hex, "string")


def budget_chunks(max_tokens: int, overlap_tokens: int = 64, chars_per_token: float = 4.0, prefer_lines: bool = True) -> Callable[[Column], Column]:
    return over_texts(lambda s: [s[a:b] for a, b in chunk_by_budget(s, max_tokens, overlap_tokens, chars_per_token, prefer_lines)], "array<string>")


def markdown_chunks_of(text: Column, source: Column, most: int = 1800, overlap: int = 200, least: int = 600) -> Column:
    @F.udf(CHUNK_TYPE, useArrow=True)
    def run(t, s):
        return None if t is None else markdown_chunks(t, s or "", most, overlap, least)

    return run(text, source)


def masked(text: Column, name: Column, params: Column, hole: str | None = None) -> Column:
    @F.udf("struct<masked_source:string,removed_definition:string,hole_name:string>", useArrow=True)
    def run(t, n, p):
        return None if t is None or n is None else mask_definition(t, n, list(p) if p is not None else [], hole)

    return run(text, name, params)


type_definitions_of = over_texts(type_definitions, "map<string,string>")
