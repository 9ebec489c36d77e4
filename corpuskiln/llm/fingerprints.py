"""Document fingerprints by winnowing, in DataFrame functions only.

A text is taken without its white space, and the ``k``-gram at every code point
of the rest is hashed; of every window of ``w`` consecutive hashes the smallest
is chosen, of equal ones the rightmost.  A chosen hash keeps its position (in
code points other than white space), and any passage of ``w + k - 1`` such code
points that two texts share is guaranteed a common hash, wherever it lies.

A hash (33 bits of xxhash64) and its position share one long, the position
turned round, so the least long of a window is just its rightmost minimum.
Texts are taken as UTF-32, in which a gram is a slice at a fixed offset, and
windows are doubled, so the work is in proportion to the length of a text.  An
edited text is made of the starts of two texts, whose windows are known already;
only those across the joint are hashed anew.

Defined results: a null text counts as empty; a text of white space alone has
no hashes; fewer than ``k`` code points are one gram; fewer than ``w`` grams are
one window; two empty fingerprints are alike (1.0), an empty and a full one
not (0.0).  Rows are ordered by descending id, nulls last, then by hash of the
text; a repeated row is a document of its own, whose next one may be its copy.
Extra columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points between two grams' starts, code points of a gram, and grams of a window.
TOKEN, GRAM, WINDOW = 1, 8, 16
_MASK = (1 << 30) - 1


def _bare(text: str) -> str:
    """The text in SQL without its white space."""
    return f"regexp_replace(coalesce({text}, ''), '(?U)\\\\s+', '')"


def packed_fingerprint(text: str, k: int = GRAM, w: int = WINDOW) -> Column:
    """Chosen hashes of the text column named ``text``, each with its turned position in the lower 30 bits, by position."""
    # transform over an array of one is a binding: its value is taken once, not for each gram
    grams = f"""transform(sequence(0, greatest(octet_length(b) div 4 - {k}, 0)), i ->
        shiftleft(shiftrightunsigned(xxhash64(substring(b, 4 * i + 1, {4 * k})), 31), 30) + ({_MASK} - i))"""
    # least() passes over the nulls beyond the end of a text
    low, width = "array(h)", 1
    while width < w:
        step = min(width, w - width)
        low = f"transform({low}, m -> zip_with(m, slice(m, {step + 1}, size(m)), (x, y) -> least(x, y)))"
        width += step
    chosen = f"array_distinct(slice({low}[0], 1, greatest(size(h) - {w - 1}, 1)))"
    return F.expr(
        f"""transform(transform(array(encode({_bare(text)}, 'UTF-32')), b -> if(octet_length(b) = 0, array(), {grams})),
        h -> if(size(h) = 0, array(), {chosen}))[0]"""
    ).cast("array<bigint>")


def edited_fingerprint(paired: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Adds ``__changed``, the packed fingerprint of __head followed by __tail.

    __own and __own_next are the packed fingerprints of texts that begin with
    __head and __tail.  What the windows inside a text's start chose is chosen
    there already, up to the least of the last such window; the windows across
    the joint lie within ``w + k - 2`` code points on either side.
    """
    whole = w + k - 1

    def start(own: str, length: str) -> str:
        at = f"({_MASK} - (x & {_MASK}))"
        last = f"array_min(filter({own}, x -> {at} BETWEEN {length} - {whole} AND {length} - {k}))"
        return f"if({length} < {whole}, array(), slice({own}, 1, cast(array_position({own}, {last}) as int)))"

    # the code points of one side alone hold no window across the joint
    alone = f"(__p >= {whole} AND __q = 0) OR (__q >= {whole} AND __p = 0)"
    bare = paired.withColumns({"__head": F.expr(_bare("__head")), "__tail": F.expr(_bare("__tail"))}).withColumns({"__p": F.length("__head"), "__q": F.length("__tail")})
    bare = bare.withColumn("__joint", F.expr(f"if({alone}, '', concat(right(__head, {whole - 1}), left(__tail, {whole - 1})))"))
    parts = f"""{start("__own", "__p")}, transform(__across, x -> x - greatest(__p - {whole - 1}, 0)), transform({start("__own_next", "__q")}, x -> x - __p)"""
    return bare.withColumn("__across", packed_fingerprint("__joint", k, w)).withColumn("__changed", F.expr(f"array_distinct(concat({parts}))"))


def fingerprint(packed: Column) -> Column:
    """array<struct<pos, hash>> of a packed fingerprint."""
    return F.transform(packed, lambda x: F.struct((F.lit(_MASK) - x.bitwiseAND(F.lit(_MASK))).alias("pos"), F.shiftright(x, 30).alias("hash")))


def hashes(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda x: F.shiftright(x, 30)))


def digest(packed: Column) -> Column:
    """128 bits over all chosen hashes and positions, as text."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(packed)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(1), packed)), 16, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Shared distinct hashes over all distinct hashes."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every == 0, 1.0).otherwise(shared / F.when(every == 0, 1).otherwise(every))


def winnow(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """(doc_id, pos, hash): one row per chosen hash, ready to be joined on the hash."""
    source = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    rows = source.select(F.col("__id").alias(id_col), F.inline(fingerprint(packed_fingerprint("__text", k, w))))
    return rows


def _bucket(bounds: list[int]) -> Column:
    """How many of the ascending bounds an id reaches, as a balanced tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("__id") < F.lit(bounds[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return F.when(F.col("__id").isNull(), F.lit(-1)).otherwise(tree(0, len(bounds)))


def with_next_document(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """__id, __text and __next, the text of the next row by descending id (after the last: the first).

    Rows are put into ranges of ids, and each range's first row is also sent to
    the range before it, so no window spans the table.  The ranges come from
    approximate quantiles; there are as many as four times the shuffle
    partitions, which bounds all that reaches the driver.
    """
    spark = df.sparkSession
    source = df.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = source.agg(F.percentile_approx("__id", [i / n for i in range(1, n)], 10 * n).alias("q")).collect()[0]["q"] if n > 1 else []
    bounds = sorted(set(quantiles or []))
    keyed = source.withColumn("__key", F.xxhash64("__text")).withColumn("__bucket", _bucket(bounds))
    firsts = keyed.groupBy("__bucket").agg(F.max(F.struct("__id", "__key")).alias("first")).collect()
    present = sorted((r["__bucket"] for r in firsts), reverse=True)
    # by descending id the bucket before a bucket is the next higher one; the first row of all follows the last
    send = {b: present[i - 1] for i, b in enumerate(present)}
    kind = source.schema["__id"].dataType.simpleString()
    firsts = spark.createDataFrame([(r["__bucket"], r["first"]["__id"], r["first"]["__key"], send[r["__bucket"]]) for r in firsts], f"b int, i {kind}, k bigint, t int")
    # as many rows as there are buckets
    keyed = keyed.join(F.broadcast(firsts), (F.col("__bucket") == F.col("b")) & F.col("__id").eqNullSafe(F.col("i")) & (F.col("__key") == F.col("k")), "left")
    own, copy = F.struct(F.col("__bucket").alias("at"), F.lit(0).alias("extra")), F.struct(F.col("t").alias("at"), F.lit(1).alias("extra"))
    to = F.when(F.col("t").isNull(), F.array(own)).otherwise(F.array(own, copy))
    rows = keyed.select("__id", "__text", "__key", F.inline(to))
    order = Window.partitionBy("at").orderBy("extra", F.col("__id").desc_nulls_last(), F.col("__key").desc())
    return rows.withColumn("__next", F.lead("__text").over(order))


def fingerprint_and_edit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document, and how alike they are.

    The edited text has its last third of code points replaced by as many of
    the first ones of the next document.
    """
    order = Window.partitionBy("at").orderBy("extra", F.col("__id").desc_nulls_last(), F.col("__key").desc())
    paired = with_next_document(df, id_col, text_col).withColumn("__own", packed_fingerprint("__text", k, w))
    paired = paired.withColumn("__n", F.length("__text")).withColumn("__own_next", F.lead("__own").over(order)).filter("extra = 0")
    cuts = {"__head": F.expr("substring(__text, 1, __n - __n div 3)"), "__tail": F.expr("substring(__next, 1, __n div 3)")}
    paired = paired.withColumns(cuts).withColumn("edited_sha256", F.sha2(F.concat("__head", "__tail").cast("binary"), 256))
    return (
        edited_fingerprint(paired.select("__id", "__n", "__own", "__own_next", "edited_sha256", "__head", "__tail"), k, w)
        .select("*", hashes(F.col("__own")).alias("__a"), hashes(F.col("__changed")).alias("__b"), hashes(F.col("__own_next")).alias("__c"))
        .select(
            F.col("__id").alias(id_col),
            F.col("__n").cast("long").alias("n_chars"),
            "edited_sha256",
            digest(F.col("__own")).alias("fingerprint"),
            digest(F.col("__changed")).alias("edited_fingerprint"),
            likeness(F.col("__a"), F.col("__b")).alias("near_edited"),
            likeness(F.col("__a"), F.col("__c")).alias("near_next"),
        )
    )
