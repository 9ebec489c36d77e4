"""Vector bin packing of examples into training sequences.

An example has three sizes: tokens, segments (one) and loss-bearing tokens.  A
sequence has a limit on each.  The dot-product heuristic fills one sequence
after the other from a pool of waiting examples: of those that fit, it takes
the one whose size vector has the largest dot product with what is left of the
limits, both as shares of the limits (of equals the first in the pool).

With ``cut=True`` an example may be cut anywhere: what is longer than a
sequence fills whole ones first, and where nothing fits a gap, the example with
the largest dot product is cut to close it.  What remains at the end of a task
goes into sequences whose length is a power of two, which need no padding.
With ``cut=False`` only examples that exceed the limits by themselves are cut.

Every task packs the examples of its own input split, so nothing is shuffled
and a lost task repeats the same packing.  It holds one Arrow batch, the pool
and a bounded memo.  ``sequence_id`` holds the number of the split in its upper
bits; which examples share a sequence depends on the splits.

The strings of special tokens in a text are ordinary text, as the vocabulary's
own notes have it; ``special_as_text=False`` makes control tokens of them.

Defined results: a null text counts as empty and is the end token alone; a null
id is kept; repeated rows are packed each time; an empty table gives no rows;
only the id and text columns are read, so extra columns can't clash.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskiln.llm.memory import release

#: Words that a worker keeps with their ids; beyond it they are forgotten before new ones are learned.
KNOWN_WORDS = 800_000
#: Bytes of texts that are encoded together.
GROUP_BYTES = 4 << 20
#: Words in a call of the tokenizer.
WORDS_A_CALL = 256


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold, and how many examples wait in the pool."""

    tokens: int = 4096
    segments: int = 4096
    loss_tokens: int = 4096
    pool: int = 256

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments) < 1 or self.loss_tokens < 0:
            raise ValueError("a sequence must have room for a token")


@dataclass
class Example:
    """ids from ``start`` on are still to be placed; ``loss`` has the running count of loss-bearing ids."""

    key: object
    ids: np.ndarray
    loss: np.ndarray | None = None
    start: int = 0

    def tokens(self) -> int:
        return len(self.ids) - self.start

    def loss_of(self, start: int, stop: int) -> int:
        if self.loss is None:
            return stop - start
        return int(self.loss[stop - 1] - (self.loss[start - 1] if start else 0)) if stop > start else 0

    def longest(self, tokens: int, loss_tokens: int) -> int:
        """The most ids that can be placed into such a room."""
        n = min(tokens, self.tokens())
        if self.loss is None:
            return min(n, loss_tokens)
        used = self.loss[self.start - 1] if self.start else 0
        return min(n, int(np.searchsorted(self.loss, used + loss_tokens, side="right")) - self.start)


Piece = tuple[Example, int, int, int, int]  # example, start, length, sequence, offset


class Packer:
    """Packs a stream of examples; yields pieces as soon as they are placed."""

    def __init__(self, limits: Limits, cut: bool = True) -> None:
        self.limits, self.cut = limits, cut
        self.pool: list[Example] = []
        #: Tokens, segments and loss-bearing tokens of the pool.
        self.waiting = np.zeros(3, dtype=np.int64)
        self.sequence = 0

    def pack(self, examples: Iterable[Example]) -> Iterator[Piece]:
        lim = self.limits
        for example in examples:
            while example.tokens() >= lim.tokens or example.loss_of(example.start, len(example.ids)) > lim.loss_tokens:
                if (n := example.longest(lim.tokens, lim.loss_tokens)) <= 0:
                    raise ValueError("a limit leaves no room for a single token")
                yield example, example.start, n, self.sequence, 0
                self.sequence += 1
                example.start += n
            if example.tokens():
                self.pool.append(example)
                self.waiting += np.array([example.tokens(), 1, example.loss_of(example.start, len(example.ids))])
            while len(self.pool) > lim.pool and (self.waiting >= (lim.tokens, lim.segments, lim.loss_tokens)).any():
                yield from self._fill(lim.tokens)
        while self.pool:
            left = int(self.waiting[0])
            yield from self._fill(lim.tokens if left >= lim.tokens or not self.cut else 1 << (left.bit_length() - 1))

    def _fill(self, room: int) -> Iterator[Piece]:
        """Fill one sequence of ``room`` tokens."""
        lim, offset = self.limits, 0
        segments, loss_left = lim.segments, lim.loss_tokens
        tokens = np.array([e.tokens() for e in self.pool], dtype=np.float64)
        losses = np.array([e.loss_of(e.start, len(e.ids)) for e in self.pool], dtype=np.float64)
        while room and segments and len(tokens):
            # each size and each rest as a share of its limit; every example is one segment
            score = tokens * room / lim.tokens**2 + segments / lim.segments**2 + losses * loss_left / lim.loss_tokens**2
            fits = (tokens <= room) & (losses <= loss_left)
            if fits.any():
                at = int(np.argmax(np.where(fits, score, -1.0)))
                n = self.pool[at].tokens()
            elif self.cut:
                at = int(np.argmax(score))
                n = self.pool[at].longest(room, loss_left)
                if n <= 0:
                    break
            else:
                break
            example = self.pool[at]
            yield example, example.start, n, self.sequence, offset
            loss = example.loss_of(example.start, example.start + n)
            loss_left -= loss
            self.waiting -= np.array([n, example.tokens() == n, loss])
            example.start += n
            offset, room, segments = offset + n, room - n, segments - 1
            if example.tokens():
                tokens[at], losses[at] = example.tokens(), example.loss_of(example.start, len(example.ids))
            else:
                last = self.pool.pop()
                if at < len(self.pool):
                    self.pool[at], tokens[at], losses[at] = last, tokens[-1], losses[-1]
                tokens, losses = tokens[:-1], losses[:-1]
        self.sequence += 1


#: Beyond these characters a word goes through the whole tokenizer: they are all in normal form C, have a lower case of one
#: character that no Unicode version changes, and leave out the separator below.
_OTHER = r"[^\x{1}-\x{12f}\x{131}-\x{24f}]"
#: Between words that are encoded in one call: blanks around a character that no such word has.
_SEPARATOR = " \0 "
#: The steps that may be done before the call, and the first step that drops white space and never merges across it.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}


class WordIds:
    """Ids of texts, for a tokenizer that drops white space and never merges across it.

    A text's ids are then those of its words in a row, so only distinct words are
    encoded.  Words are told apart and kept in Arrow: ``words`` are the known
    ones, and the ids of word i are ``ids[starts[i]:starts[i + 1]]``.  New words
    are lowered in Arrow, joined by a separator and sent to a copy of the
    tokenizer without its normalizer, a few hundred in a call; a word with
    characters for which that could matter goes through the whole tokenizer.

    A file with other steps than those named above has its texts encoded whole.
    ``special_as_text``: the strings of special tokens in a text are ordinary
    text, so no document can bring in a control token.
    """

    def __init__(self, path: str, special_as_text: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        before = steps["pre_tokenizer"] or {}
        self.by_words = (steps["normalizer"] or {}).get("normalizers") == _NORMALIZERS and before.get("pretokenizers", [None])[0] == _SPLIT and not steps["post_processor"]
        self.whole, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.whole.encode_special_tokens = self.bare.encode_special_tokens = special_as_text
        # a word that could be part of a special token isn't split off from its text where those count
        self.other = _OTHER if special_as_text else f"{_OTHER}|<"
        self.separator = self.bare.encode(_SEPARATOR, add_special_tokens=False).ids[0]
        self._forget()

    def _forget(self) -> None:
        self.words, self.ids, self.starts = pa.array([], pa.large_string()), np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and where each begins (with the end of the last)."""
        if not len(words):
            return np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)
        other = pc.match_substring_regex(words, self.other).to_numpy(zero_copy_only=False)
        simple = pc.utf8_lower(words.filter(pa.array(~other)))
        offsets = pa.array(np.append(np.arange(0, len(simple), WORDS_A_CALL), len(simple)), pa.int32())
        calls = pc.binary_join(pa.ListArray.from_arrays(offsets, simple), pa.scalar(_SEPARATOR, pa.large_string())).to_pylist() if len(simple) else []
        found = [np.array(e.ids, dtype="<u4") for e in self.bare.encode_batch_fast([c + _SEPARATOR for c in calls], add_special_tokens=False)]
        flat = np.concatenate(found) if found else np.zeros(0, dtype="<u4")
        ends = np.flatnonzero(flat == self.separator)
        lengths = np.zeros(len(words), dtype=np.int64)
        lengths[~other] = np.diff(ends, prepend=-1) - 1
        flat = flat[flat != self.separator]
        rest = [np.array(e.ids, dtype="<u4") for e in self.whole.encode_batch_fast(words.filter(pa.array(other)).to_pylist(), add_special_tokens=False)]
        lengths[other] = list(map(len, rest))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.empty(starts[-1], dtype="<u4")
        theirs = np.repeat(other, lengths)
        ids[~theirs] = flat
        ids[theirs] = np.concatenate(rest) if rest else np.zeros(0, dtype="<u4")
        return ids, starts

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words among the known ones; new ones are added."""
        if len(self.words) > KNOWN_WORDS:
            self._forget()
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        ids, starts = self._encode(new)
        places = at.fill_null(-1).to_numpy().astype(np.int64)
        places[places < 0] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, new])
        self.starts = np.concatenate([self.starts, starts[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        return places

    def texts(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, each followed by ``end``, and where each text begins (with the end of the last); null is empty."""
        column = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_words:
            each = [np.array(e.ids, dtype="<u4") for e in self.whole.encode_batch_fast(column.to_pylist(), add_special_tokens=False)]
            out, bounds = np.concatenate([np.zeros(0, dtype="<u4"), *each]), np.cumsum([0, *map(len, each)])
        else:
            split = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
            coded = split.flatten().dictionary_encode()
            places = self._learn(coded.dictionary)[coded.indices.to_numpy()]
            starts, lengths = self.starts[places], self.starts[places + 1] - self.starts[places]
            ends = np.cumsum(lengths)
            # a word's ids lie in a row from its start: the shift from places in the output is constant over a word
            kind = np.int32 if max(len(self.ids), ends[-1] if len(ends) else 0) < 1 << 31 else np.int64
            place = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
            place += np.arange(len(place), dtype=kind)
            out = self.ids[place]
            bounds = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        if end is not None:
            out, bounds = np.insert(out, bounds[1:], end), bounds + np.arange(len(bounds))
        return out, bounds


_WORDS: dict[tuple[str, bool], WordIds] = {}


def _word_ids(path: str, special_as_text: bool) -> WordIds:
    key = path, special_as_text
    if key not in _WORDS:
        _WORDS[key] = WordIds(*key)
    return _WORDS[key]


def _pieces_to_batches(pieces: Iterable[Piece], key_type: pa.DataType, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 40 if TaskContext.get() else 0
    names = ["__id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids
    pieces = iter(pieces)
    while rows := [(e.key, start, n, zlib.crc32(e.ids[start : start + n]), len(e.ids), base + sequence, offset, e) for e, start, n, sequence, offset in islice(pieces, 4096)]:
        key, *numbers, examples = zip(*rows)
        arrays = [pa.array(key, key_type), *(pa.array(np.array(x, dtype=np.int64)) for x in numbers)]
        if keep_ids:
            arrays.append(pa.array([e.ids[start : start + n].astype(np.int64) for e, start, n in zip(examples, numbers[0], numbers[1])], pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays(arrays, names)


def groups(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(sizes):
        before = sizes[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield begin, stop
        begin = stop


def _schema(df: DataFrame, keep_ids: bool) -> str:
    schema = f"__id {df.schema[0].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return schema + ", ids array<bigint>" * keep_ids


def pack_texts(
    df: DataFrame, tokenizer_path: str, end_id: int, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", cut: bool = True, keep_ids: bool = False, special_as_text: bool = True
) -> DataFrame:
    """Tokenize whole texts, end each with ``end_id`` and pack them; one row per piece."""
    source = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def examples() -> Iterator[Example]:
            for batch in batches:
                types[:] = [batch.column(0).type]
                words = _word_ids(tokenizer_path, special_as_text)
                for begin, stop in groups(batch.column(1), GROUP_BYTES):
                    ids, bounds = words.texts(batch.column(1)[begin:stop], end_id)
                    for key, low, high in zip(batch.column(0)[begin:stop].to_pylist(), bounds, bounds[1:]):
                        # a copy, or what waits in the pool would hold the whole group
                        yield Example(key, ids[low:high].copy())

        pieces = Packer(limits, cut).pack(examples())
        first = next(pieces, None)
        if first is not None:
            yield from _pieces_to_batches((p for group in ([first], pieces) for p in group), types[0], keep_ids)
        release()

    return source.mapInArrow(run, _schema(source, keep_ids)).withColumnRenamed("__id", id_col)


def encode_turns(df: DataFrame, tokenizer_path: str, end_id: int, role_col: str = "role", text_col: str = "text", loss_role: str = "assistant", special_as_text: bool = True) -> DataFrame:
    """Adds ``ids`` of each turn, ended by ``end_id``, and ``loss``: 1 for each id of a turn of ``loss_role``, else 0.  A map over turns."""
    at = df.columns.index(text_col)
    bears = df.columns.index(role_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _word_ids(tokenizer_path, special_as_text)
            for begin, stop in groups(batch.column(at), GROUP_BYTES):
                part = batch.slice(begin, stop - begin)
                ids, bounds = words.texts(part.column(at), end_id)
                marks = np.repeat([(role or "").strip().lower() == loss_role for role in part.column(bears).to_pylist()], np.diff(bounds)).astype(np.int32)
                offsets = pa.array(bounds, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(marks))]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], [*part.schema.names, "ids", "loss"])

    added = [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("loss", T.ArrayType(T.IntegerType()))]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of lists one after the other (null values as 0) and the bounds of each list; a null list is empty."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = pc.fill_null(column.flatten(), 0).to_numpy(zero_copy_only=False)
    return values, np.concatenate([[0], np.cumsum(lengths)])


def pack_examples(df: DataFrame, limits: Limits = Limits(), id_col: str = "example_id", ids_col: str = "ids", loss_col: str | None = None, cut: bool = False, keep_ids: bool = False) -> DataFrame:
    """Pack examples that are tokenized already; ``loss_col`` marks the loss-bearing ids with true or 1.

    Null or empty ids have nothing to place.  A null or missing mark bears no loss.
    """
    columns = [F.col(id_col).alias("__id"), F.col(ids_col).cast("array<bigint>").alias("__ids")]
    if loss_col:
        columns.append(F.col(loss_col).cast("array<int>").alias("__loss"))
    source = df.select(*columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def examples() -> Iterator[Example]:
            for batch in batches:
                types[:] = [batch.column(0).type]
                ids, bounds = _lists(batch.column(1))
                marks, marked = _lists(batch.column(2)) if batch.num_columns > 2 else (None, None)
                for at, key in enumerate(batch.column(0).to_pylist()):
                    own = ids[bounds[at] : bounds[at + 1]].astype("<u4")
                    loss = None
                    if marks is not None:
                        bears = np.zeros(len(own), dtype=np.int64)
                        given = marks[marked[at] : marked[at + 1]][: len(own)]
                        bears[: len(given)] = given != 0
                        loss = np.cumsum(bears)
                    yield Example(key, own, loss)

        pieces = Packer(limits, cut).pack(examples())
        first = next(pieces, None)
        if first is not None:
            yield from _pieces_to_batches((p for group in ([first], pieces) for p in group), types[0], keep_ids)

    return source.mapInArrow(run, _schema(source, keep_ids)).withColumnRenamed("__id", id_col)
