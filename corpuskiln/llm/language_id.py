"""Language identification by prediction by partial matching.

Every language has a context tree of byte contexts up to order three, grown on
a bounded sample of labelled documents.  In a context seen ``n`` times with
``q`` different next bytes, a byte seen ``c`` times has the probability
``c / (n + q)`` and the escape ``q / (n + q)``, which the next shorter context
shares out among the bytes not seen here (exclusion).  The statistics are
frozen after the sample, so the code length of a byte after its three
predecessors is a constant; it is kept in 1/65536 bit, and a text's code length
is an exact integer sum over all its bytes, free of the order of adding.  The
language with the shortest code wins, equal lengths go to the smaller name.

The sample (``sample_docs`` and SAMPLE_BYTES a language, chosen by a hash of the
id) bounds a tree; no context of the sample is left out.  Counting it is
distributed and only counts reach the driver.  Scoring is a narrow map over
whole texts; a worker holds the trees of all languages, sparse.

Defined results: a null text or one without a letter (Unicode category L) is ``und`` with score 0,
as is every text if nothing could be learned; documents without a label are
never learned from; a null id counts as the empty text in the fold's checksum.
Repeated rows get equal results, an empty table an empty result.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskiln.llm.memory import release

UND = "und"
#: Symbols of the longest context.
ORDER = 3
#: Documents a language that are learned from, and bytes of text, at most about (but some documents of each).
SAMPLE_DOCS, SAMPLE_BYTES, SAMPLE_LEAST = 1_000, 8 << 20, 8
#: Parts of a bit.
UNIT = 65536
#: Bytes scored at once.
BLOCK = 1 << 19
_BASE = 257
_LETTER = regex.compile(r"\p{L}")


def held_out_fold(id_col: str = "doc_id", folds: int = 5) -> F.Column:
    """Whether a document is held out: crc32 of its id as text is divisible by ``folds``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0


def _grams(text: bytes) -> np.ndarray:
    """Keys of all four-byte windows; three start marks (0) come before the first byte."""
    s = np.zeros(len(text) + 3, dtype=np.int64)
    s[3:] = np.frombuffer(text, dtype=np.uint8).astype(np.int64) + 1
    return ((s[:-3] * _BASE + s[1:-2]) * _BASE + s[2:-1]) * _BASE + s[3:]


def count_grams(sample: DataFrame) -> DataFrame:
    """(__lang, gram, n) over the sample's whole texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in waiting.items():
                grams, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(counts, pa.int64())], ["__lang", "gram", "n"])
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                data = (text.as_py() or "").encode()
                for at in range(0, len(data), BLOCK):
                    part = _grams(data[max(0, at - 3) : at + BLOCK])
                    waiting.setdefault(lang.as_py(), []).append(part[3:] if at else part)
                    size += len(part)
                if size > 4 * BLOCK:
                    yield from flush()
                    size = 0
        yield from flush()

    return sample.select("__lang", "__text").mapInArrow(run, "__lang string, gram bigint, n bigint").groupBy("__lang", "gram").agg(F.sum("n").alias("n"))


class Tree:
    """Frozen code lengths of one language's context tree, in bits, kept sparse.

    For each order: the contexts seen with the length of an escape (shared out
    over what wasn't seen), and the (context, byte) pairs seen with their code
    lengths.  A pair that wasn't seen costs its context's escape, if there is
    such a context, and then what it costs in the next shorter one.  Memory goes
    with the distinct pairs learned, whatever the number of languages.
    """

    def __init__(self, size: int, grams: np.ndarray, counts: np.ndarray) -> None:
        """``grams`` are keys of ORDER + 1 symbols out of ``size``."""
        self.size = size
        zero = np.bincount(grams % size, counts, size)
        q = np.count_nonzero(zero)
        self.zero = -np.log2(np.where(zero > 0, zero, q / max(size - q, 1)) / (zero.sum() + q))
        self.orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for order in range(1, ORDER + 1):
            pairs, at = np.unique(grams % size ** (order + 1), return_inverse=True)
            seen = np.bincount(at, counts)
            contexts, of = np.unique(pairs // size, return_inverse=True)
            n, q = np.bincount(of, seen), np.bincount(of)
            # what the shorter context leaves for the bytes not seen here; symbol 0 never follows, so some is always left
            rest = np.maximum(1 - np.bincount(of, np.exp2(-self.bits(pairs % size**order, order - 1))), 1e-15)
            self.orders.append((contexts, -np.log2(q / (n + q) / rest), pairs, -np.log2(seen / (n + q)[of])))

    def bits(self, grams: np.ndarray, order: int | None = None) -> np.ndarray:
        """Code lengths of the last symbols of distinct keys, in contexts of at most ``order``."""
        order = ORDER if order is None else order
        if not order:
            return self.zero[grams]
        contexts, escapes, pairs, own = self.orders[order - 1]
        at = np.minimum(np.searchsorted(pairs, grams), len(pairs) - 1)
        out = own[at]
        new = np.flatnonzero(pairs[at] != grams)
        if len(new):
            at = np.minimum(np.searchsorted(contexts, grams[new] // self.size), len(contexts) - 1)
            escape = np.where(contexts[at] == grams[new] // self.size, escapes[at], 0.0)
            out[new] = escape + self.bits(grams[new] % self.size**order, order - 1)
        return out


class PpmModel:
    """Context trees of all languages over one alphabet."""

    def __init__(self, langs: list[str], grams: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.langs = langs
        seen = np.unique(np.concatenate([g % _BASE for g in grams]))
        self.symbol = np.zeros(_BASE, dtype=np.int64)  # 0: start mark, and any byte never learned
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.size = len(seen) + 1
        self.trees = []
        for g, n in zip(grams, counts):
            keys = np.zeros(len(g), dtype=np.int64)
            for k in range(ORDER, -1, -1):
                keys = keys * self.size + self.symbol[(g // _BASE**k) % _BASE]
            self.trees.append(Tree(self.size, keys, n))

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """int64 code lengths in 1/UNIT bit: a row per text, a column per language.

        A block's distinct keys are looked up once in each tree.
        """
        out = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
        symbol = self.symbol[1:]
        group: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush() -> None:
            if not group:
                return
            s = np.concatenate([part for _, part in group])
            lengths = np.array([len(part) for _, part in group])
            starts = np.cumsum(lengths) - lengths
            keys = s[ORDER:].copy()
            for k in range(1, ORDER + 1):
                keys += s[ORDER - k : -k] * self.size**k
            codes, distinct = pd.factorize(keys)
            for lang, tree in enumerate(self.trees):
                costs = np.rint(tree.bits(distinct) * UNIT).astype(np.int64)
                sums = np.concatenate([[0], np.cumsum(costs[codes])])
                # the windows that reach into the next text's leading symbols don't count
                np.add.at(out[:, lang], [at for at, _ in group], sums[starts + lengths - ORDER] - sums[starts])
            group.clear()

        for at, text in enumerate(texts):
            data = np.concatenate([np.zeros(ORDER, dtype=np.int64), symbol[np.frombuffer(text, dtype=np.uint8)]])
            for begin in range(0, len(data) - ORDER, BLOCK):
                part = data[begin : begin + BLOCK + ORDER]
                group.append((at, part))
                size += len(part)
                if size >= BLOCK:
                    flush()
                    size = 0
        flush()
        return out


_MODELS: dict[str, PpmModel | None] = {}


def _model(blob: bytes) -> PpmModel | None:
    """The worker's model, built once from the counts."""
    key = hashlib.md5(blob).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        with np.load(io.BytesIO(blob), allow_pickle=False) as data:
            langs = [str(x) for x in data["langs"]]
            _MODELS[key] = PpmModel(langs, [data[f"g{i}"] for i in range(len(langs))], [data[f"n{i}"] for i in range(len(langs))]) if langs else None
    return _MODELS[key]


def learn(df: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> bytes:
    """Counts of the sample's grams a language, as bytes.

    The share of each language's learnable documents that gives about
    ``sample_docs`` of them is taken by a hash of the id, so the sample is the
    same however the table is split.
    """
    labelled = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"), F.col(lang_col).cast("string").alias("__lang"))
    labelled = labelled.filter(F.col("__lang").isNotNull() & ~held_out_fold("__id"))
    sizes = {r["__lang"]: (r["n"], r["b"] or 0) for r in labelled.groupBy("__lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("__text")).alias("b")).collect()}
    buffer = io.BytesIO()
    if not sizes:
        np.savez(buffer, langs=np.array([], dtype="U1"))
        return buffer.getvalue()
    parts = 1_000_000
    wanted = {k: max(min(sample_docs, SAMPLE_BYTES * n // max(b, 1)), SAMPLE_LEAST) / n for k, (n, b) in sizes.items()}
    share = F.create_map(*[F.lit(v) for k, x in sorted(wanted.items()) for v in (k, min(parts, -int(-x * parts // 1)))])
    sample = labelled.filter(F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit(7)), F.lit(parts)) < share[F.col("__lang")])
    counted = count_grams(sample).toPandas()
    langs = sorted(counted["__lang"].unique())
    arrays = {}
    for i, lang in enumerate(langs):
        own = counted[counted["__lang"] == lang].sort_values("gram")
        arrays |= {f"g{i}": own["gram"].to_numpy(), f"n{i}": own["n"].to_numpy()}
    np.savez_compressed(buffer, langs=np.array(langs, dtype=str) if langs else np.array([], dtype="U1"), **arrays)
    return buffer.getvalue()


def _predict(texts: list[str | None], model: PpmModel | None) -> tuple[list[str], list[float], list[float]]:
    """Language, posterior probability and code length a byte."""
    langs, scores, rates = [UND] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
    at = [i for i, x in enumerate(texts) if x and _LETTER.search(x)] if model else []
    if not at:
        return langs, scores, rates
    data = [texts[i].encode() for i in at]
    lengths = model.code_lengths(data)
    best = lengths.argmin(1)
    low = lengths[np.arange(len(at)), best]
    with np.errstate(under="ignore"):
        posterior = 1 / np.exp2(-np.minimum((lengths - low[:, None]) / UNIT, 1000.0)).sum(1)
    for k, i in enumerate(at):
        langs[i], scores[i], rates[i] = model.langs[best[k]], float(posterior[k]), float(low[k]) / UNIT / len(data[k])
    return langs, scores, rates


def identify(df: DataFrame, model: bytes, text_col: str = "__text", texts_at_once: int = 256) -> DataFrame:
    """Adds lang_pred, score and bits_per_byte to ``df``."""
    kept = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ready = _model(kept.value)
            for begin in range(0, batch.num_rows, texts_at_once):
                part = batch.slice(begin, texts_at_once)
                langs, scores, rates = _predict(part.column(at).to_pylist(), ready)
                arrays = [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names, "lang_pred", "score", "bits_per_byte"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))


def predict_languages(df: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits_per_byte of every document."""
    model = learn(df, sample_docs, id_col, text_col, lang_col)
    source = df.select(F.col(id_col).alias("__id"), held_out_fold(id_col).alias("held_out"), F.col(text_col).cast("string").alias("__text"))
    return identify(source, model).select(F.col("__id").alias(id_col), "held_out", "lang_pred", "score", "bits_per_byte")


def keep_identified(df: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language is identified, with their columns unchanged.

    Rejected are texts without a letter (or null), and texts that no learned
    language codes in less than the eight bits a byte that plain bytes take.
    """
    model = df.sparkSession.sparkContext.broadcast(learn(df, sample_docs, id_col, text_col, lang_col))
    at = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ready = _model(model.value)
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                langs, _, rates = _predict(part.column(at).to_pylist(), ready)
                yield part.filter(pa.array([lang != UND and rate < 8 for lang, rate in zip(langs, rates)], pa.bool_()))
        release()

    return df.mapInArrow(run, df.schema)
