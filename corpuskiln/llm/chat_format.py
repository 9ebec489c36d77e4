"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system message, then user and assistant
messages in turn, the last one the assistant's.  Every turn gets a role by the
cheapest mix of merges (a turn joins the message before it), relabels and
insertions of empty messages.  The repair is a shortest path over the automaton
of legal turns: cost-to-go is computed from the end, then the path is walked
from the start, taking of equally cheap steps the first of STEPS.

A step's costs depend on the turn's role alone, so a run of turns is a 4 x 4
matrix over (min, +), and runs combine by multiplication.  Turns are sorted
into ranges of (conversation, turn), so one huge conversation is spread over
many tasks.  Only the first and last conversation of a range can reach beyond
it; their matrices, two a task, are combined on the driver and give each task
the cost-to-go and the state at its edges.

Output: one row per rendered piece, in order of ``piece``; the pieces of a
conversation joined are its rendering.  A source turn is one piece and an
inserted message is one.

Defined results: a null or unknown role has to be relabelled, at a smaller
cost; a null text is empty; roles are compared lowered and trimmed.  Turns are
ordered by turn (null first), role, text; turns with equal numbers are all kept,
as are repeated rows.  A null conversation id is a conversation.  An empty table
gives an empty one.  Extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpuskiln.session import cut

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
OTHER = 0
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_INF = float("inf")


@dataclass(frozen=True)
class Costs:
    """Costs of the repairs, and the template."""

    merge: float = 1.0
    relabel: float = 3.0
    relabel_unknown: float = 1.5
    insert: float = 2.0
    open: str = "<|im_start|>{role}\n"
    close: str = "<|im_end|>\n"
    joint: str = "\n"


@dataclass(frozen=True)
class Step:
    """From one state to the next over a turn: its new role, whether it merges, what is inserted before it."""

    to: int
    merged: bool = False
    inserted: tuple[int, ...] = field(default=())


def _steps() -> dict[int, list[Step]]:
    out: dict[int, list[Step]] = {}
    for state in range(4):
        steps = [Step(to) for to in _NEXT[state]]
        if state != START:
            steps.append(Step(state, merged=True))
        # one insertion is enough to reach any role that can be reached at all
        steps += [Step(to, inserted=(between,)) for between in (USER, ASSISTANT) if between in _NEXT[state] for to in _NEXT[between]]
        out[state] = steps
    return out


STEPS = _steps()
#: Messages inserted after the last turn, by the state it leaves.
ENDING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def step_cost(step: Step, role: int, costs: Costs) -> float:
    change = 0.0 if step.to == role else costs.relabel_unknown if role == OTHER else costs.relabel
    return change + costs.merge * step.merged + costs.insert * len(step.inserted)


def turn_matrix(role: int, costs: Costs) -> np.ndarray:
    out = np.full((4, 4), _INF)
    for state, steps in STEPS.items():
        for step in steps:
            out[state, step.to] = min(out[state, step.to], step_cost(step, role, costs))
    return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product over (min, +)."""
    return (a[:, :, None] + b[None]).min(1)


def end_costs(costs: Costs) -> np.ndarray:
    return np.array([costs.insert * len(ENDING[s]) for s in range(4)])


def walk(roles: list[int], state: int, after: np.ndarray, costs: Costs, togo: list[np.ndarray] | None = None) -> tuple[list[Step], int]:
    """The steps over these turns and the state they leave, if ``after`` is the cost of going on from each state."""
    togo = togo or costs_to_go(roles, after, costs)
    steps = []
    for i, role in enumerate(roles):
        step = min(STEPS[state], key=lambda s: step_cost(s, role, costs) + togo[i + 1][s.to])
        steps.append(step)
        state = step.to
    return steps, state


def costs_to_go(roles: list[int], after: np.ndarray, costs: Costs) -> list[np.ndarray]:
    matrices = [turn_matrix(r, costs) for r in range(4)]
    out = [after]
    for role in reversed(roles):
        out.append((matrices[role] + out[-1][None]).min(1))
    return out[::-1]


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    return NAMES.index(name) if name in NAMES[1:] else OTHER


Piece = tuple[int | None, str, str, str, str]  # index of the source turn, role, action, text, rendered


def render(roles: list[int], texts: list[str], steps: list[Step], state: int, costs: Costs, last: bool) -> list[Piece]:
    """Pieces of these turns; ``last``: the conversation ends here."""
    out: list[Piece] = []

    def begin(role: int, text: str) -> str:
        nonlocal state
        shut = costs.close if state != START else ""
        state = role
        return shut + costs.open.format(role=NAMES[role]) + text

    for i, (step, text) in enumerate(zip(steps, texts)):
        for role in step.inserted:
            out.append((None, NAMES[role], "insert", "", begin(role, "")))
        action = ("merge" if step.merged else "") + ("+" if step.merged and step.to != roles[i] else "") + ("relabel" if step.to != roles[i] else "")
        out.append((i, NAMES[step.to], action or "keep", text, costs.joint + text if step.merged else begin(step.to, text)))
    if last:
        for role in ENDING[state]:
            out.append((None, NAMES[role], "insert", "", begin(role, "")))
        if out:
            out[-1] = (*out[-1][:4], out[-1][4] + costs.close)
    return out


def repair(roles: list[str | None], texts: list[str | None], costs: Costs = Costs()) -> tuple[float, list[Piece]]:
    """Cost and pieces of one conversation."""
    numbers = [role_number(r) for r in roles]
    togo = costs_to_go(numbers, end_costs(costs), costs)
    steps, _ = walk(numbers, START, end_costs(costs), costs, togo)
    return float(togo[0][START]), render(numbers, [t or "" for t in texts], steps, START, costs, True)


def _runs(batches: Iterable[pa.RecordBatch], with_text: bool) -> Iterator[tuple[object, list, list[int], list[str], bool]]:
    """Conversations of a sorted range in order: id, turns, roles, texts, and whether it is the range's last."""
    held: tuple[object, list, list[int], list[str]] | None = None
    for batch in batches:
        columns = batch.to_pydict()
        for i, conv in enumerate(columns["conv"]):
            if held is not None and held[0] != conv:
                yield *held, False
                held = None
            if held is None:
                held = (conv, [], [], [])
            held[1].append(columns["turn"][i])
            held[2].append(role_number(columns["role"][i]))
            if with_text:
                held[3].append(columns["text"][i] or "")
    if held is not None:
        yield *held, True


@dataclass(frozen=True)
class Edge:
    """What a task has to know of a conversation that reaches beyond its range."""

    state: int
    pieces: int
    after: tuple[float, ...]
    last: bool


def format_chats(df: DataFrame, costs: Costs = Costs(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, piece, turn, source_role, role, action, text, rendered: a row per rendered piece."""
    spark = df.sparkSession
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    keys = ["conv", "turn", "role", "text"]
    # the ranges are written once, so all passes see the same ones
    rows = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv", "turn")]
    conv_kind, turn_kind = (to_arrow_type(rows.schema[c].dataType) for c in ("conv", "turn"))

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for conv, _, roles, _, last in _runs(batches, False):
            if first or last:
                product = np.where(np.eye(4) > 0, 0.0, _INF)
                for role in roles:
                    product = times(product, turn_matrix(role, costs))
                yield _batch([(TaskContext.get().partitionId(), 0 if first else 1, conv, product.ravel().tolist())], [pa.int32(), pa.int32(), conv_kind, pa.list_(pa.float64())], ["part", "side", "conv", "product"])
            first = False

    edges = sorted(rows.select("conv", "role", "turn").mapInArrow(products, f"part int, side int, conv {kinds[0]}, product array<double>").collect(), key=lambda r: (r["part"], r["side"]))
    chains: list[list] = []
    for e in edges:
        if chains and chains[-1][-1]["part"] < e["part"] and chains[-1][-1]["conv"] == e["conv"]:
            chains[-1].append(e)
        else:
            chains.append([e])
    after: dict[tuple[int, object], tuple[float, ...]] = {}
    for chain in (c for c in chains if len(c) > 1):
        value = end_costs(costs)
        for e in reversed(chain):
            after[e["part"], e["conv"]] = tuple(value)
            value = (np.array(e["product"]).reshape(4, 4) + value[None]).min(1)
    known: dict[tuple[int, object], Edge] = {}
    if after:
        shared = spark.sparkContext.broadcast(after)  # two a task at most

        def outcomes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            for conv, _, roles, _, _ in _runs(batches, False):
                if (part, conv) in shared.value:
                    value = np.array(shared.value[part, conv])
                    togo = costs_to_go(roles, value, costs)
                    walked = [walk(roles, s, value, costs, togo) for s in range(4)]
                    row = (part, conv, [end for _, end in walked], [len(roles) + sum(len(s.inserted) for s in steps) for steps, _ in walked])
                    yield _batch([row], [pa.int32(), conv_kind, pa.list_(pa.int32()), pa.list_(pa.int64())], ["part", "conv", "ends", "pieces"])

        found = {(r["part"], r["conv"]): r for r in rows.select("conv", "role", "turn").mapInArrow(outcomes, f"part int, conv {kinds[0]}, ends array<int>, pieces array<bigint>").collect()}
        for chain in (c for c in chains if len(c) > 1):
            state, pieces = START, 0
            for e in chain:
                key = e["part"], e["conv"]
                known[key] = Edge(state, pieces, after[key], e is chain[-1])
                state, pieces = found[key]["ends"][state], pieces + found[key]["pieces"][state]
    edge = spark.sparkContext.broadcast(known)
    whole = Edge(START, 0, tuple(end_costs(costs)), True)

    def rendered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting = TaskContext.get().partitionId(), []
        kinds_out = [conv_kind, pa.int64(), turn_kind, pa.string(), pa.string(), pa.string(), pa.string(), pa.string()]
        names = ["conv", "piece", "turn", "source_role", "role", "action", "text", "rendered"]
        for conv, turns, roles, texts, _ in _runs(batches, True):
            at = edge.value.get((part, conv), whole)
            steps, _ = walk(roles, at.state, np.array(at.after), costs)
            for k, (i, role, action, text, out) in enumerate(render(roles, texts, steps, at.state, costs, at.last)):
                waiting.append((conv, at.pieces + k, None if i is None else turns[i], None if i is None else NAMES[roles[i]] or "other", role, action, text, out))
            if len(waiting) >= 4096:
                yield _batch(waiting, kinds_out, names)
                waiting = []
        if waiting:
            yield _batch(waiting, kinds_out, names)

    schema = f"conv {kinds[0]}, piece bigint, turn {kinds[1]}, source_role string, role string, action string, text string, rendered string"
    return rows.mapInArrow(rendered, schema).withColumnRenamed("conv", conv_col).withColumnRenamed("turn", turn_col)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
