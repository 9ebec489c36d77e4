"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text's features are its shingles of five words, weighted by term frequency
times inverse document frequency.  ``SAMPLES`` consistent samples (Ioffe 2010)
agree between two texts each with the probability of their weighted Jaccard
similarity.  Samples are banded; texts that share a band are candidates, and a
candidate pair is linked if its exact weighted Jaccard similarity reaches the
threshold.  Classes are the connected components of the links.

Document frequencies are exact for every shingle that a share of RARE of all
documents holds; a rarer one has the weight of one right at RARE.  As a share
doesn't depend on the table's size, neither does a weight.  A first pass counts
all shingles in ``2 ** DF_BITS`` hashed features, which bounds each frequency
from above; a second one counts the shingles of the features that reach the
share by themselves.  No more than mean shingles a document / RARE can reach it,
and RARE grows with the mean so that these are at most COMMON: that many, and a
bit a feature, is what every task is sent, whatever the table's size.

Candidates.  Equal texts are put together first and only one of each takes
part.  In a band's bucket every text is paired with the bucket's first text
only, which joins a group of near copies in as many pairs as it has texts.
Then, in a bucket that still holds several classes, every text outside its
largest class is compared with the texts of all its other classes.  So each two
different texts that share a bucket are in one class or were compared, yet the
pairs within a class are never listed.  A pair whose total weights are too far
apart to reach the threshold is left out before its texts are fetched.

Pairs are listed only in buckets with LISTED texts outside the largest class at
most, so their number is in proportion to the texts.  Other buckets (texts that
share a passage, or large groups of copies of copies) are taken to tasks as
blocks of whole texts, which join the same classes without the pairs.  Features
are ordered from rare to common in the block; the first one that two texts share
bounds the weight that they share, so only texts with a common feature early
enough in both are compared, and none that is of the text's class by then.

Words are runs of ASCII letters, digits, underscores and any other code points
above 127 of the lowered text; a text of fewer than five words is one shingle
of all its words.

Defined results: null texts and texts without a word have no features; equal
ones are a class (null is not equal to the empty text), otherwise they stay
alone.  Of a class the smallest id stays (null ids last), of repeated rows one.
An empty table gives an empty one.  Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.memory import release
from corpuskiln.operators.components import connected_components
from corpuskiln.session import cut

WORDS = 5
THRESHOLD = 0.8
#: Bands, and samples of a band: a pair at the threshold misses all bands with a probability of (1 - 0.8 ** 3) ** 10 = 0.0008.
BANDS, ROWS = 10, 3
SAMPLES = BANDS * ROWS
#: Hashed features of the first pass are summed in parts of so many, which meet over two levels of so many groups.
DF_BITS, DF_PART, DF_GROUPS = 20, 16_384, 256
#: Share of the documents below which a shingle counts as rare, and shingles that may be common at most.
RARE, COMMON = 1 / 128, 1 << 18
#: Bytes of text, or shingles, worked on at once.
BLOCK_BYTES = 1 << 19
SHINGLES_AT_ONCE = 1 << 14
#: Parts that a bucket's texts are spread over.
SALTS = 8
#: Pairs of one text that one task compares; texts with more of them, if they aren't too many, are sent to all tasks that compare them.
PAIRS_A_TASK, SENT_TEXTS = 4096, 100_000
#: Texts outside a bucket's largest class up to which its pairs are listed, and total weight of a block of texts in a bucket of more.
LISTED, BLOCK_WEIGHT = 8, 1_000_000
#: Texts that one text is compared with before those of its class are left out again; then twice as many, and so on.
COMPARED_AT_ONCE = 32

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_WORD_BYTE = np.array([chr(b).isalnum() or b == 95 if b < 128 else True for b in range(256)], dtype=bool)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of a byte array."""
    inside = _WORD_BYTE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, stops = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    # each byte is mixed with its place in the word, so a word's hash is a plain sum over its bytes
    lengths = stops - starts
    at = np.repeat(starts, lengths)
    within = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    mixed = _BYTE_MIX[np.minimum(within, _BYTE_PLACES - 1), data[at + within]]
    far = within >= _BYTE_PLACES
    if far.any():
        mixed[far] = _mix((within[far].astype(np.uint64) << np.uint64(8)) + data[at + within][far] + _M3)
    sums = np.add.reduceat(mixed, np.cumsum(lengths) - lengths)
    return starts, _mix(sums + lengths.astype(np.uint64) * _M3)


_BYTE_PLACES = 64
_BYTE_MIX = _mix(((np.arange(_BYTE_PLACES, dtype=np.uint64)[:, None] << np.uint64(8)) + np.arange(256, dtype=np.uint64)[None]) * _M3 + _M2)


def occurrences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For lowered texts: text number and shingle hash of every shingle, by text, then place (those of short texts at the end)."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    offsets = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    starts, words = _word_hashes(data)
    count = np.diff(np.searchsorted(starts, np.append(offsets, len(data))))
    of = np.repeat(np.arange(len(texts)), count)
    hashed = np.zeros(len(words), dtype=np.uint64)
    for k in range(min(WORDS, len(words))):
        end = len(words) - k
        hashed[:end] = _mix(hashed[:end] * _M3 + words[k:])
    begin = np.cumsum(count) - count
    whole = np.arange(len(words)) - begin[of] + WORDS <= count[of]
    owner, value = of[whole], hashed[whole]
    short = np.flatnonzero((count < WORDS) & (count > 0))
    if len(short):
        few = [_short_hash(words[begin[i] : begin[i] + count[i]]) for i in short]
        owner, value = np.concatenate([owner, short]), np.concatenate([value, np.array(few, dtype=np.uint64)])
    return owner, value


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lowered texts: text number, shingle hash and count, by text and hash."""
    owner, value = occurrences(texts)
    if not len(owner):
        return owner, value, np.zeros(0, dtype=np.int64)
    bits = np.uint64(max(1, len(texts).bit_length()))
    order = np.argsort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (value >> bits))
    o, v = owner[order], value[order]
    if ((o[1:] == o[:-1]) & (v[1:] < v[:-1])).any():
        # hashes that differ in their last bits only
        order = np.lexsort((value, owner))
        o, v = owner[order], value[order]
    new = np.concatenate(([True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])))
    first = np.flatnonzero(new)
    return o[first], v[first], np.diff(np.append(first, len(o)))


def _short_hash(words: np.ndarray) -> np.uint64:
    value = np.array([len(words)], dtype=np.uint64)
    for w in words:
        value = _mix(value * _M3 + w)
    return value[0]


def _feature(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - DF_BITS)).astype(np.int64)


def _groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about BLOCK_BYTES; a longer text is a run of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_BYTES:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


#: Texts whose lowered bytes are held at once.
TEXTS_AT_ONCE = 512


def _lowered_groups(column: pa.Array) -> Iterator[list[bytes]]:
    """All texts of a column, lowered, in groups of about BLOCK_BYTES."""
    for begin in range(0, len(column), TEXTS_AT_ONCE):
        for _, group in _groups(_lowered(column[begin : begin + TEXTS_AT_ONCE])):
            yield group


def _lowered(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in pc.utf8_lower(column).cast(pa.binary()).to_pylist()]


class Idf:
    """Weights of shingles: between 1 (in every document) and 2 (rare)."""

    def __init__(self, documents: int, rare: float, values: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(values)
        self.rare, self.values = rare, values[order]
        share = np.minimum(counts[order] / max(documents, 1), 1.0)
        # held to a factor of two, the weights leave near copies alike that many documents share
        self.weights = (1 + np.log(1 / np.maximum(share, rare)) / np.log(1 / rare)).astype(np.float32)
        self.common = np.zeros(1 << DF_BITS, dtype=bool)
        self.common[_feature(values)] = True

    def of(self, value: np.ndarray) -> np.ndarray:
        out = np.full(len(value), 2.0, dtype=np.float32)
        maybe = np.flatnonzero(self.common[_feature(value)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.values, value[maybe]), len(self.values) - 1)
            hit = self.values[at] == value[maybe]
            out[maybe[hit]] = self.weights[at[hit]]
        return out


def feature_counts(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and shingles with repeats in each hashed feature, over the whole table.

    A task sends its counts in parts; those of a part are added up in groups of
    tasks first, so no task reads the counts of all.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(1 << DF_BITS, dtype=np.int64), 0
        for batch in batches:
            for group in _lowered_groups(batch.column(0)):
                total += np.bincount(_feature(occurrences(group)[1]), minlength=1 << DF_BITS)
            docs += batch.num_rows
        if docs:
            parts = [np.array([docs]), *total.reshape(-1, DF_PART)]
            group = TaskContext.get().partitionId() % DF_GROUPS
            yield _parts([(k - 1, group, x.astype("<i8")) for k, x in enumerate(parts) if x.any()])
        release()

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, group, counts in zip(*(c.to_pylist() for c in batch.columns)):
                one = np.frombuffer(counts, dtype="<i8")
                sums[part, group] = sums[part, group] + one if (part, group) in sums else one
        yield _parts([(part, group, x) for (part, group), x in sums.items()])

    schema = "part int, group int, counts binary"
    by_group = texts.mapInArrow(run, schema).repartition("part", "group").mapInArrow(add, schema).withColumn("group", F.lit(0))
    out, docs = np.zeros(1 << DF_BITS, dtype=np.int64), 0
    for r in by_group.repartition("part").mapInArrow(add, schema).collect():
        counts = np.frombuffer(bytes(r["counts"]), dtype="<i8")
        if r["part"] < 0:
            docs = int(counts[0])
        else:
            out[r["part"] * DF_PART : (r["part"] + 1) * DF_PART] = counts
    return docs, out


def _parts(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    part, group, counts = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(group, pa.int32()), pa.array([x.tobytes() for x in counts], pa.binary())], ["part", "group", "counts"])


def inverse_frequencies(texts: DataFrame) -> Idf:
    """Weights by the documents that hold each shingle, over the whole table (one column of non-null texts)."""
    documents, counts = feature_counts(texts)
    rare = min(max(RARE, counts.sum() / max(documents, 1) / COMMON), 0.5)
    least = rare * documents
    wanted = texts.sparkSession.sparkContext.broadcast(np.packbits(counts >= least))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = np.unpackbits(wanted.value).astype(bool)
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["value", "n"])

        for batch in batches:
            for group in _lowered_groups(batch.column(0)):
                owner, value = occurrences(group)
                at = np.flatnonzero(chosen[_feature(value)])
                owner, value = owner[at], value[at]
                order = np.lexsort((value, owner))
                owner, value = owner[order], value[order]
                held.append(value[np.concatenate(([True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])))] if len(value) else value)
                size += len(held[-1])
                if size > 1 << 20:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    common = texts.mapInArrow(run, "value bigint, n bigint").groupBy("value").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).toPandas()
    return Idf(documents, rare, common["value"].to_numpy(np.int64).view(np.uint64), common["n"].to_numpy(np.int64))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Upper 24 bits as a number inside (0, 1)."""
    return ((x >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2**-24)


def consistent_samples(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """uint64 samples: a row for each of ``n`` texts, a column for each of SAMPLES.

    Sample k takes the feature with the least ln c - r * (t - beta) - r, where
    t = floor(ln w / r + beta), r and c are Gamma(2, 1), beta is uniform, all
    drawn from a hash of the feature and k; the sample is (feature, t).
    """
    out = np.zeros((n, SAMPLES), dtype=np.uint64)
    if not len(owner):
        return out
    log_weight = np.log(weight).astype(np.float32)
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    # runs of whole texts of about SHINGLES_AT_ONCE shingles stay in the cache
    bounds, last = [0], 0
    for f in [*first[1:], len(owner)]:
        if f - last >= SHINGLES_AT_ONCE or f == len(owner):
            bounds.append(int(f))
            last = f
    for begin, end in zip(bounds, bounds[1:]):
        begins = first[(first >= begin) & (first < end)] - begin
        rows = owner[begins + begin]
        run = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, end - begin)))
        v, lw = value[begin:end], log_weight[begin:end]
        for k in range(SAMPLES):
            h = (v ^ _SEEDS[k]) * _M1
            h ^= h >> np.uint64(29)
            h *= _M2
            h ^= h >> np.uint64(32)
            g = h * _M3
            g ^= g >> np.uint64(31)
            r = -np.log(_uniform(h) * _uniform(h << np.uint64(24)))
            g *= _M1
            beta = ((g & np.uint64(0xFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2**-16)
            c = -np.log(_uniform(g) * _uniform(g << np.uint64(24)))
            t = np.floor(lw / r + beta)
            a = np.log(c) - r * (t - beta) - r
            least = np.minimum.reduceat(a, begins)
            at = np.flatnonzero(a == least[run])
            which, index = np.unique(run[at], return_index=True)
            chosen = at[index]
            out[rows[which], k] = _mix(v[chosen] + t[chosen].astype(np.int64).astype(np.uint64) * _M3) | np.uint64(1)
    return out


_SEEDS = _mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _M3)


def signatures(texts: DataFrame, idf: Broadcast) -> DataFrame:
    """Adds ``bands`` to ``texts`` (which must have __tid, equal for equal texts, and __text): a hash per band, or none for a text without features; and its total ``weight``."""
    at, own = texts.columns.index("__text"), texts.columns.index("__tid")
    keep = [c for c in texts.columns if c != "__text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands: list[list[int]] = []
            weights: list[float] = []
            # copies in a batch are signed once
            coded = batch.column(own).dictionary_encode()
            codes = coded.indices.to_numpy()
            _, first = np.unique(codes, return_index=True)
            for group in _lowered_groups(batch.column(at).take(pa.array(first))):
                owner, value, count = shingles(group)
                weight = count * idf.value.of(value)
                weights += np.bincount(owner, weight, len(group)).tolist()
                samples = consistent_samples(owner, value, weight, len(group))
                for row in samples:
                    if not row[0]:
                        bands.append([])
                        continue
                    h = np.arange(1, BANDS + 1, dtype=np.uint64)
                    for r in range(ROWS):
                        h = _mix(h * _M3 + row[r::ROWS])
                    bands.append(h.view(np.int64).tolist())
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(bands, pa.list_(pa.int64())).take(coded.indices), pa.array(weights, pa.float64()).take(coded.indices)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "bands", "weight"])
        release()

    kept = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in keep)
    return texts.mapInArrow(run, f"{kept}, bands array<bigint>, weight double")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller weights over sum of larger ones; features are sorted and distinct."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64)
    total = a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - shared
    return float(shared / total) if total > 0 else 0.0


def verify(pairs: DataFrame, texts: DataFrame, idf: Broadcast) -> DataFrame:
    """(a, b, similarity) of the candidate pairs; ``texts`` has __tid and __text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def features(key: str, text: bytes) -> tuple[np.ndarray, np.ndarray]:
            if key not in known:
                if len(known) >= 64:
                    known.clear()
                _, value, count = shingles([text])
                known[key] = value, count * idf.value.of(value)
            return known[key]

        for batch in batches:
            like: list[float] = []
            for begin in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(begin, TEXTS_AT_ONCE)
                pairs_of = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), _lowered(part.column(2)), _lowered(part.column(3)))
                like += [weighted_jaccard(features(x, s), features(y, t)) for x, y, s, t in pairs_of]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(like, pa.float64())], ["a", "b", "similarity"])
        release()

    both = _with_first_text(pairs, texts).join(texts.select(F.col("__tid").alias("b"), F.col("__text").alias("__t")), "b").select("a", "b", "__s", "__t")
    return both.mapInArrow(run, "a string, b string, similarity double")


def _with_first_text(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` with __s, the text of a; a text of many pairs is sent to as many parts as they fill."""
    firsts = texts.select(F.col("__tid").alias("a"), F.col("__text").alias("__s"))
    hot = cut(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PAIRS_A_TASK).select("a", F.expr(f"1 + n div {PAIRS_A_TASK}").alias("parts")))
    n = hot.count()
    if not n:
        return pairs.join(firsts, "a")
    if n <= SENT_TEXTS:
        hot = F.broadcast(hot)
    parts = F.coalesce("parts", F.lit(1))
    spread = pairs.join(hot, "a", "left").withColumn("part", F.pmod(F.xxhash64("b"), parts)).drop("parts")
    firsts = firsts.join(hot, "a", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
    return spread.join(firsts, ["a", "part"]).drop("part")


def _linked(pairs: DataFrame, texts: DataFrame, idf: Broadcast, threshold: float) -> DataFrame:
    return verify(pairs, texts, idf).filter(F.col("similarity") >= threshold).select("a", "b")


def _may_reach(threshold: float, a: str, b: str) -> F.Column:
    """Whether texts of these total weights can be alike enough: no more than the smaller weight is shared, no less than the larger is in all."""
    return F.least(a, b) >= F.greatest(a, b) * (threshold * (1 - 1e-6))


def _first_pairs(buckets: DataFrame, threshold: float) -> DataFrame:
    """Every text of a bucket with the bucket's first text, if they may reach the threshold."""
    firsts = buckets.groupBy("bucket").agg(F.min(F.struct("tid", "weight")).alias("first"))
    both = buckets.join(firsts, "bucket").select(F.col("first.tid").alias("a"), F.col("first.weight").alias("w"), F.col("tid").alias("b"), "weight")
    return both.filter((F.col("a") != F.col("b")) & _may_reach(threshold, "w", "weight")).select("a", "b").distinct()


def _cross_pairs(buckets: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """In buckets of several classes: texts outside the largest class, with the texts of all other classes that may reach the threshold.

    A bucket's rows are spread over SALTS parts and the few texts outside the
    largest class are sent to each part.
    """
    members = buckets.join(classes, "tid", "left").withColumn("class", F.coalesce("class", "tid"))
    sizes = members.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy("bucket").agg(F.max_by("class", F.struct("n", "class")).alias("largest"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    rows = members.join(several, "bucket").withColumn("salt", F.pmod(F.xxhash64("tid"), F.lit(SALTS)).cast("int"))
    outside = rows.filter("class <> largest").select("bucket", F.col("tid").alias("x"), F.col("class").alias("of"), F.col("weight").alias("w"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = rows.join(outside, ["bucket", "salt"]).filter((F.col("class") != F.col("of")) & _may_reach(threshold, "w", "weight"))
    return met.select(F.least("tid", "x").alias("a"), F.greatest("tid", "x").alias("b")).distinct()


def _crowded(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Buckets with more than LISTED texts outside the largest class: that class, and blocks that all texts and the outside ones fill."""
    members = buckets.join(classes, "tid", "left").withColumn("class", F.coalesce("class", "tid"))
    sizes = members.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    of = sizes.groupBy("bucket").agg(F.max(F.struct("n", "class", "w")).alias("top"), F.sum("n").alias("n"), F.sum("w").alias("w"))
    blocks = [F.floor(w / BLOCK_WEIGHT).cast("long") + 1 for w in (F.col("w"), F.greatest(F.col("w") - F.col("top.w"), F.lit(0.0)))]
    return of.filter(F.col("n") - F.col("top.n") > LISTED).select("bucket", F.col("top.class").alias("largest"), blocks[0].alias("blocks"), blocks[1].alias("outside_blocks"))


def _crowded_links(buckets: DataFrame, classes: DataFrame, crowded: DataFrame, texts: DataFrame, idf: Broadcast, threshold: float) -> DataFrame:
    """Links (a, b) that join the classes of each of the ``crowded`` buckets; every block of outside texts meets every block of all texts."""
    rows = buckets.join(crowded, "bucket").join(classes, "tid", "left").withColumn("class", F.coalesce("class", "tid"))
    row = ["bucket", "tid", "class"]

    def spread(by: str, over: str) -> list:
        return [F.pmod(F.xxhash64("tid"), F.col(by)).alias(by), F.explode(F.sequence(F.lit(0).cast("long"), F.col(over) - 1)).alias(over)]

    every = rows.select(*row, F.lit(False).alias("outside"), *spread("blocks", "outside_blocks"))
    outside = rows.filter("class <> largest").select(*row, F.lit(True).alias("outside"), *spread("outside_blocks", "blocks"))
    met = every.unionByName(outside).join(texts.select(F.col("__tid").alias("tid"), F.col("__text").alias("text")), "tid")

    def run(table: pa.Table) -> pa.Table:
        pairs = _block_links(table, idf.value, threshold)
        release()
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return met.groupBy("bucket", "blocks", "outside_blocks").applyInArrow(run, "a string, b string").distinct()


def _block_links(table: pa.Table, idf: Idf, threshold: float) -> list[tuple[str, str]]:
    """Links between the outside texts and all texts of a block that join their classes; ``table`` has tid, class, outside and text of texts with features."""
    tids, where, inverse = np.unique(np.array(table["tid"].to_pylist(), dtype=object), return_index=True, return_inverse=True)
    outside = table["outside"].to_numpy(zero_copy_only=False)
    xs, rows = np.unique(inverse[outside]), np.unique(inverse[~outside])
    first = table.take(pa.array(where))
    root = np.unique(np.array(first["class"].to_pylist(), dtype=object), return_inverse=True)[1]
    member = np.zeros(len(tids), dtype=bool)
    member[rows] = True
    owners, values, weights, done = [], [], [], 0
    for begin in range(0, len(tids), TEXTS_AT_ONCE):
        for _, group in _groups(_lowered(first["text"].slice(begin, TEXTS_AT_ONCE).combine_chunks())):
            owner, value, count = shingles(group)
            owners.append(owner + done)
            values.append(value)
            weights.append(count * idf.of(value))
            done += len(group)
    owner, value, weight = np.concatenate(owners), np.concatenate(values), np.concatenate(weights)
    total = np.bincount(owner, weight, len(tids))
    start = np.searchsorted(owner, np.arange(len(tids) + 1))

    def features(x: int) -> tuple[np.ndarray, np.ndarray]:
        own = np.arange(start[x], start[x + 1])
        own = own[np.argsort(value[own])]
        return value[own], weight[own]

    # a text's features from rare to common in the block, each with the weight of those before it
    feature = np.unique(value, return_inverse=True)[1]
    frequency = np.bincount(feature[member[owner]], minlength=feature.max(initial=-1) + 1)
    order = np.lexsort((feature, frequency[feature], owner))
    feature, value, weight = feature[order], value[order], weight[order]
    before = np.cumsum(weight) - weight
    before -= np.repeat(before[start[:-1]], np.diff(start))
    # members by feature, if it is one that an alike text may share first
    held = np.flatnonzero(member[owner] & (before <= (1 - threshold + _SLACK) * total[owner]))
    held = held[np.argsort(feature[held], kind="stable")]
    begins = np.searchsorted(feature[held], np.arange(len(frequency) + 1))
    dense = np.zeros(len(frequency))
    links: list[tuple[str, str]] = []
    for x in xs:
        own = slice(start[x], start[x + 1])
        rare = np.arange(start[x], start[x] + np.searchsorted(before[own], (1 - threshold + _SLACK) * total[x], side="right"))
        at, lengths = _ranges(begins[feature[rare]], begins[feature[rare] + 1])
        at = held[at]
        other = owner[at]
        # texts alike enough share this weight, so what either has before the first feature they share is at most the rest
        least = threshold / (1 + threshold) * (total[other] + total[x]) * (1 - _SLACK)
        other = np.unique(other[(before[at] <= total[other] - least) & (np.repeat(before[rare], lengths) <= total[x] - least)])
        dense[feature[own]] = weight[own]
        size = COMPARED_AT_ONCE
        while len(other := other[root[other] != root[x]]):
            some, other = other[:size], other[size:]
            size *= 2
            at, lengths = _ranges(start[some], start[some + 1])
            shared = np.add.reduceat(np.minimum(dense[feature[at]], weight[at]), np.cumsum(lengths) - lengths)
            like = shared / (total[some] + total[x] - shared)
            for k in np.flatnonzero(like >= threshold - _SLACK):
                y = some[k]
                # right at the threshold the order of the sums counts
                if root[y] != root[x] and (like[k] >= threshold + _SLACK or weighted_jaccard(features(x), features(y)) >= threshold):
                    links.append((min(tids[x], tids[y]), max(tids[x], tids[y])))
                    root[root == root[y]] = root[x]
        dense[feature[own]] = 0
    return links


#: Relative error that sums of weights stay under by far.
_SLACK = 1e-6


def _ranges(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges in a row, and the ranges' lengths."""
    lengths = ends - begins
    return np.arange(lengths.sum()) + np.repeat(begins - np.cumsum(lengths) + lengths, lengths), lengths


def _salted_join(left: DataFrame, right: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join on ``key`` whose hot keys are spread over SALTS parts by a hash of ``spread``."""
    left = left.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [key, "__salt"], "left").drop("__salt")


def classify_texts(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(__tid, class) of the texts that are near another one; ``rows`` has __id, __tid (hash of the text) and __text."""
    rows = rows.filter("__text IS NOT NULL")
    idf = rows.sparkSession.sparkContext.broadcast(inverse_frequencies(rows.select("__text")))
    signed = signatures(rows, idf).filter("size(bands) > 0").groupBy("__tid").agg(F.min("__id").alias("__id"), F.first("bands").alias("bands"), F.first("weight").alias("weight"))
    signed = cut(signed)
    in_bands = signed.select(F.col("__tid").alias("tid"), "weight", F.explode("bands").alias("bucket"))
    shared = in_bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    buckets = cut(in_bands.join(shared, "bucket"))
    involved = signed.join(buckets.select(F.col("tid").alias("__tid")).distinct(), "__tid", "left_semi").select("__tid", F.col("__id").alias("__rid"))
    # a text meets its one representative by text and id, so the copies of a text are spread over all parts
    chosen = (rows["__tid"] == involved["__tid"]) & rows["__id"].eqNullSafe(involved["__rid"])
    texts = cut(rows.join(involved.hint("shuffle_hash"), chosen, "left_semi").select("__tid", "__text").dropDuplicates(["__tid"]))
    first_pairs = cut(_first_pairs(buckets, threshold))
    least = first_pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = cut(_linked(least, texts, idf, threshold))
    links = cut(links.union(_linked(_across(first_pairs, _classes(links)).join(least, ["a", "b"], "left_anti"), texts, idf, threshold)))
    classes = cut(_classes(links))
    crowded = cut(_crowded(buckets, classes))
    listed = _cross_pairs(buckets.join(crowded, "bucket", "left_anti"), classes, threshold).join(first_pairs, ["a", "b"], "left_anti")
    more = cut(_linked(listed, texts, idf, threshold).union(_crowded_links(buckets, classes, crowded, texts, idf, threshold)))
    return _classes(links.union(more)).withColumnRenamed("tid", "__tid")


def _classes(links: DataFrame) -> DataFrame:
    return connected_components(links, "a", "b").select(F.col("node").alias("tid"), F.col("component").alias("class"))


def _across(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose texts aren't of one class."""
    both = pairs.join(classes.select(F.col("tid").alias("b"), F.col("class").alias("__b")), "b", "left")
    both = _salted_join(both, classes.select(F.col("tid").alias("a"), F.col("class").alias("__a")), "a", "b")
    return both.filter(F.coalesce("__a", "a") != F.coalesce("__b", "b")).select("a", "b")


def _with_class(df: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(__id, __tid, __class) of every row of ``df``."""
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    rows = rows.withColumn("__tid", F.when(F.col("__text").isNull(), F.lit("null")).otherwise(F.md5(F.col("__text").cast("binary"))))
    classes = classify_texts(rows, threshold)
    return _salted_join(rows.select("__id", "__tid"), classes, "__tid", "__id").select("__id", "__tid", F.coalesce("class", "__tid").alias("__class"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the smallest id of its class), class_size and kept of every row."""
    rows = cut(_with_class(df, id_col, text_col, threshold))
    large = rows.groupBy("__class").agg(F.min("__id").alias("__least"), F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    joined = _salted_join(rows, large, "__class", "__id")
    return joined.select(
        F.col("__id").alias(id_col),
        F.when(F.col("__n").isNull(), F.col("__id")).otherwise(F.col("__least")).alias("class_id"),
        F.coalesce("__n", F.lit(1)).alias("class_size"),
        (F.col("__n").isNull() | F.col("__id").eqNullSafe(F.col("__least"))).alias("kept"),
    )


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, that with the smallest id, then the smallest text hash; columns unchanged."""
    rows = _with_class(df, id_col, text_col, threshold)
    rank = F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__tid"))
    kept = rows.groupBy("__class").agg(F.min(rank).alias("__least"))
    kept = cut(kept.select(F.col("__least")["__id"].alias("__nd_id"), F.col("__least")["__tid"].alias("__nd_tid")))
    tid = F.when(F.col(text_col).isNull(), F.lit("null")).otherwise(F.md5(F.col(text_col).cast("string").cast("binary")))
    # columns of kept go by its frame, as df may have any names
    out = df.join(kept.hint("shuffle_hash"), F.col(id_col).eqNullSafe(kept["__nd_id"]) & (tid == kept["__nd_tid"]), "left_semi")
    # only where an id occurs more than once can a row be repeated
    if not df.groupBy(id_col).count().filter("count > 1").limit(1).count():
        return out
    order = Window.partitionBy(F.col(id_col), tid).orderBy(*[F.col(c).cast("string") for c in df.columns])
    nth = "__nd_nth" + "_" * max(map(len, df.columns))
    return out.withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1).select(*df.columns)
