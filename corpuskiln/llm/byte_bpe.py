"""Byte-level BPE encoding and decoding by tree reduction.

A piece is encoded as the fold of a monoid over its bytes: single bytes are the
leaves, both halves are encoded on their own and joined.  A join re-encodes a
window of tokens around the boundary and grows it until the pairs of tokens at
its two edges are *compatible*.  Two neighbours are compatible if encoding their
joined bytes gives the same two tokens again; a sequence whose neighbours are
all compatible is the encoding of its bytes, so tokens outside the window can't
change any more.  Pieces never merge with each other, so above them the join is
concatenation: a text's ids and its decoded bytes are folded up a tree of
``FAN`` branches over its pieces.

Every node of a tree depends on its bytes alone, so short ones are kept: the
halves of new words are mostly known.

Defined results: a null text counts as the empty text; the empty text has no
tokens and decodes to nothing.  Every text is encoded whole, however long it
is.  Repeated rows give repeated results, an empty table an empty one.  Only
``id_col`` and ``text_col`` are read, so extra columns can't clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Branches of the tree above the pieces.
FAN = 16
#: Bytes of the longest node that is kept, and how many are; they are forgotten when there are more.
NODE_BYTES, NODES = 8, 200_000
#: Entries of a worker's memo of pieces; it is emptied when full.
MEMO_ENTRIES = 400_000
#: Longer pieces aren't kept in the memo.
MEMO_PIECE_CHARS = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class TreeBpe:
    """Encoder of single pieces; ``encode`` is exact for every byte string."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        #: What two neighbours become, by both tokens: themselves if they are compatible.
        self._pairs: dict[tuple[int, int], list[int]] = {}
        self._nodes: dict[bytes, list[int]] = {}
        #: Joins done, and those of them that had to re-encode a window.
        self.joins = self.windows = 0

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of the piece; the list may be shared and must not be changed."""
        known = self._nodes.get(piece)
        if known is not None:
            return known
        if len(piece) <= 1:
            out = [self.ranks[piece]] if piece else []
        else:
            middle = len(piece) // 2
            out = self._join(self.encode(piece[:middle]), self.encode(piece[middle:]))
        if len(piece) <= NODE_BYTES:
            if len(self._nodes) >= NODES:
                self._nodes.clear()
            self._nodes[piece] = out
        return out

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated up the tree."""
        return fold([self.token[i] for i in ids], b"")

    def _leaf(self, piece: bytes) -> list[int]:
        """Merge the lowest-ranked pair, the leftmost of equals, until none is left."""
        ranks = self.ranks
        parts = [piece[i : i + 1] for i in range(len(piece))]
        merged = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        while merged:
            low = min(merged)
            if low == 1 << 60:
                break
            i = merged.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del merged[i]
            if i < len(merged):
                merged[i] = ranks.get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                merged[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 60)
        return [ranks[p] for p in parts]

    def _heap(self, piece: bytes) -> list[int]:
        """As ``_leaf`` with a heap, for windows that grew long."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def rank(i: int) -> int | None:
            return ranks.get(piece[i : end[end[i]]]) if end[i] < n else None

        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            if not alive[i] or end[i] != middle or middle >= n or end[middle] != stop:
                continue
            alive[middle] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
            for at in (i, before[i]):
                if at >= 0 and (r := rank(at)) is not None:
                    heapq.heappush(heap, (r, at, end[at], end[end[at]]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def _small(self, piece: bytes) -> list[int]:
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        return self._leaf(piece) if len(piece) <= 128 else self._heap(piece)

    def _pair(self, left: int, right: int) -> list[int]:
        """What the two tokens become when they are neighbours."""
        found = self._pairs.get((left, right))
        if found is None:
            if len(self._pairs) >= NODES:
                self._pairs.clear()
            found = self._pairs[left, right] = self._small(self.token[left] + self.token[right])
        return found

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when they are neighbours."""
        found = self._pair(left, right)
        return len(found) == 2 and found[0] == left

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left or right
        self.joins += 1
        window = self._pair(left[-1], right[0])
        if len(window) == 2 and window[0] == left[-1]:
            return left + right
        self.windows += 1
        i = j = 1
        while True:
            open_left = i < len(left) and not self._fits(left[-i - 1], window[0])
            open_right = j < len(right) and not self._fits(window[-1], right[j])
            if not open_left and not open_right:
                return left[: len(left) - i] + window + right[j:]
            if open_left:
                i = min(len(left), 2 * i)
            if open_right:
                j = min(len(right), 2 * j)
            window = self._small(b"".join([self.token[t] for t in left[-i:] + right[:j]]))


def fold(parts: list, joint: str | bytes) -> str | bytes:
    """The parts joined up a tree of FAN branches."""
    while len(parts) > FAN:
        parts = [joint.join(parts[i : i + FAN]) for i in range(0, len(parts), FAN)]
    return joint.join(parts)


class Memo(dict):
    """piece -> (ids joined by commas, decoded bytes), filled on a miss."""

    def __init__(self, bpe: TreeBpe) -> None:
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> tuple[str, bytes]:
        ids = self.bpe.encode(piece.encode())
        entry = ",".join(map(str, ids)), self.bpe.decode(ids)
        if len(piece) <= MEMO_PIECE_CHARS:
            self[piece] = entry
        return entry


_MEMOS: dict[tuple[str, str], tuple[Memo, regex.Pattern]] = {}


def memo(ranks_path: str, pattern: str) -> tuple[Memo, regex.Pattern]:
    """The worker's memo for a vocabulary; emptied when it is full."""
    key = ranks_path, pattern
    if key not in _MEMOS:
        _MEMOS[key] = Memo(TreeBpe(load_ranks(ranks_path))), regex.compile(pattern)
    found = _MEMOS[key]
    if len(found[0]) > MEMO_ENTRIES:
        found[0].clear()
    return found


def encode_text(text: str, known: Memo, pattern: regex.Pattern) -> tuple[str, bytes]:
    """Ids of a whole text joined by commas, and the bytes they decode to."""
    entries = list(map(known.__getitem__, pattern.findall(text)))
    return fold([ids for ids, _ in entries], ","), fold([decoded for _, decoded in entries], b"")


def encode_decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per text: n_tokens, ids_sha256, decoded_sha256 (and ids, decoded if ``keep_ids``).

    It is a narrow map without any shuffle; a task holds one Arrow batch and
    the bounded memo, and a lost task is recomputed from its input split.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, pieces = memo(ranks_path, pattern)
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(1):
                ids, decoded = encode_text(text.as_py() or "", known, pieces)
                out[0].append(ids.count(",") + 1 if ids else 0)
                out[1].append(hashlib.sha256(ids.encode()).hexdigest())
                out[2].append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    out[3].append([int(i) for i in ids.split(",")] if ids else [])
                    out[4].append(decoded)
                if len(known) > MEMO_ENTRIES:
                    known.clear()
            arrays = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = ["__id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                arrays += [pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    source = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    schema = f"__id {source.schema[0].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<bigint>, decoded binary"
    return source.mapInArrow(run, schema).withColumnRenamed("__id", id_col)
