"""Connected components of a graph of edges, as an iteration over DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from corpuskiln.session import cut

#: Rounds after which the iteration gives up; it takes about log2 of the longest path.
MAX_ROUNDS = 60
#: Edges that one task may hold: a graph of so many is finished there.
SMALL = 1 << 20


def _finished(stars: DataFrame) -> DataFrame:
    """(u, v): every node but the smallest of its component with that one, by union-find in one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        edges = pa.Table.from_batches(held)
        nodes = pc.unique(pa.chunked_array([*edges["u"].chunks, *edges["v"].chunks]))
        nodes = nodes.take(pc.sort_indices(nodes))
        parent = list(range(len(nodes)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(*(pc.index_in(edges[c], value_set=nodes).to_pylist() for c in ("u", "v"))):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        root = [find(x) for x in range(len(nodes))]
        others = pa.array([x for x in range(len(nodes)) if root[x] != x], pa.int64())
        yield pa.RecordBatch.from_arrays([nodes.take(others), nodes.take(pa.array(root, pa.int64()).take(others))], ["u", "v"])

    return cut(stars.coalesce(1).mapInArrow(run, stars.schema))


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component): every node of ``edges`` with the smallest node it is connected to.

    Large-star and small-star rounds (Kiveris et al., 2014) replace the edges
    until they are stars around the smallest nodes.  A round only takes minima
    by node and one join back on the node; its lineage is cut by a checkpoint in
    the shared folder.  When SMALL edges or fewer are left, one task finishes
    them.  Edges with a null end are left out, self loops keep their node.
    """
    both = cut(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL"))  # read by nodes and stars
    nodes = both.select(F.col("u").alias("node")).union(both.select(F.col("v").alias("node")))
    stars = cut(both.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    plain = all(isinstance(f.dataType, (StringType, IntegralType)) for f in stars.schema)
    seen, count = None, stars.count()
    for _ in range(MAX_ROUNDS):
        if plain and count <= SMALL:
            stars = _finished(stars)
            break
        # large star: neighbours above a node go to the least of the node and its neighbours
        around = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        stars = cut(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct())
        mark = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).collect()[0]
        if seen == mark:
            break
        seen, count = mark, mark["n"]
    else:
        raise RuntimeError(f"the components didn't settle in {MAX_ROUNDS} rounds")
    return nodes.distinct().join(stars.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))
