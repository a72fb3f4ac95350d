"""Exact top-k inner-product search: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards of bounded size; a task meets its shards one after another, builds
each one's ball tree once and searches it for all blocks of queries, which are of bounded size.
A first round searches one shard per block and so gives every query a k-th best score; the
second round takes it to all other shards. In a shard, nodes are visited in the order of their
upper bound q.c + |q| r and a search ends when the bound falls below the current k-th score.
What a shard makes of a block's k-th scores is kept for the next shards of the same task, as
numbers only, so that a task holds 8 bytes a query beside one tree and one block.

Defined results: a vector that is null, or has a null or non-finite component, or no id,
takes no part; only vectors of the same length are compared; scores are exact integers (the
tree's bounds are doubles with room for their rounding; products beyond 2^53 are summed in
Python integers and clipped to 64 bits); ties go to the smaller id; rows that
repeat an id are one vector (the smallest by components); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchgrid.llm.common import block_batches, table
from touchgrid.session import cut_lineage

K = 5
SCALE = 256
QUERY_EVERY = 50
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LEAF_ROWS = 64
FOUND = "query_id long, vec_id long, score long"


def quantized(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as a long."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return embedding.isNotNull() & finite


class BallTree:
    """Balls over the rows of `points` (integers), split at the median of the widest direction."""

    def __init__(self, points, leaf_rows: int = LEAF_ROWS):
        import numpy as np

        self.exact, points = points, points.astype(float)
        self.points = points
        self.most = int(np.abs(points).max(initial=0)) + 1
        self.centers, self.radii, self.children, self.rows = [], [], [], []
        todo = [(np.arange(len(points)), None)]
        while todo:
            rows, parent = todo.pop()
            own = points[rows]
            center = own.mean(axis=0)
            node = len(self.radii)
            self.centers.append(center)
            self.radii.append(float(np.sqrt(((own - center) ** 2).sum(axis=1).max())))
            self.children.append([])
            self.rows.append(rows)
            if parent is not None:
                self.children[parent].append(node)
            if len(rows) > leaf_rows and self.radii[node] > 0:
                far = own[((own - center) ** 2).sum(axis=1).argmax()]
                other = own[((own - far) ** 2).sum(axis=1).argmax()]
                order = np.argsort(own @ (other - far), kind="stable")
                half = len(rows) // 2
                todo += [(rows[order[:half]], node), (rows[order[half:]], node)]
        self.centers = np.array(self.centers)
        self.radii = np.array(self.radii)

    def bounds(self, queries):
        """For each query and node no less than the greatest inner product inside the node."""
        import numpy as np

        norms = np.sqrt((queries**2).sum(axis=1))
        reach = np.sqrt((self.centers**2).sum(axis=1)) + self.radii
        loose = queries @ self.centers.T + norms[:, None] * self.radii
        # Room for rounding in proportion to the lengths, as the product itself may cancel. Scores
        # are clipped to 64 bits, so none lies below the least of these.
        return np.maximum(loose + 1e-9 * norms[:, None] * reach + 1e-6, -float(1 << 63))

    def scores(self, rows, query):
        """The exact scores of some rows with a query of integers, given as it is and as doubles."""
        import numpy as np

        whole, flat, largest = query
        if self.most * largest * max(len(flat), 1) < 1 << 53:
            return self.points[rows] @ flat
        products = self.exact[rows].astype(object) @ whole.astype(object)
        low, high = -(1 << 63), (1 << 63) - 1
        return np.array([min(max(int(x), low), high) for x in products], object)


def search_shard(tree, ids, queries, query_ids, best, k):
    """Improve `best` (per query a sorted list of (-score, id)) with the rows of one shard."""
    import heapq

    flat = queries.astype(float)
    bounds = tree.bounds(flat)
    for i, q in enumerate(zip(queries, flat, [int(abs(f).max(initial=0)) + 1 for f in flat], strict=True)):
        found, limit = best[i], bounds[i].tolist()
        kth = -found[k - 1][0] if len(found) >= k else None
        heap = [(-limit[0], 0)]
        while heap:
            most, node = heapq.heappop(heap)
            if kth is not None and -most < kth:
                break
            if tree.children[node]:
                for child in tree.children[node]:
                    if kth is None or limit[child] >= kth:
                        heapq.heappush(heap, (-limit[child], child))
                continue
            rows = tree.rows[node]
            scores = tree.scores(rows, q)
            if kth is not None:
                near = (scores >= kth).astype(bool)
                rows, scores = rows[near], scores[near]
            if len(rows):
                mine = [(-int(s), int(v)) for s, v in zip(scores, ids[rows], strict=True) if v != query_ids[i]]
                found = sorted(found + mine)[:k]
                kth = -found[k - 1][0] if len(found) >= k else None
        best[i] = found
    return best


def packed(values) -> bytes:
    """Whole numbers in as few bytes each as the largest needs: 2, 4 or 8."""
    import numpy as np

    low, high = values.min(initial=0), values.max(initial=0)
    kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return values.astype(kind).tobytes()


def unpacked(data: bytes, rows: int, dim: int):
    """What packed() made of rows of dim numbers, as 64-bit numbers."""
    import numpy as np

    return np.frombuffer(data, f"<i{len(data) // max(rows * dim, 1) or 8}").astype("<i8").reshape(rows, dim)


def _gather(rows: DataFrame, by: str) -> DataFrame:
    """One row for each (dim, by) with its ids and components, packed as bytes."""

    def pack(group):
        import numpy as np
        import pyarrow as pa

        group = group.sort_by("vec_id")
        values = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<i8")
        ids = group.column("vec_id").to_numpy().astype("<i8")
        kth = group.column("kth").to_pylist()
        kth = np.array([np.iinfo("<i8").min if x is None else x for x in kth], "<i8")
        return pa.table({
            "dim": group.column("dim")[:1], by: group.column(by)[:1],
            "ids": pa.array([ids.tobytes()], pa.binary()), "values": pa.array([packed(values)], pa.binary()),
            "kths": pa.array([kth.tobytes()], pa.binary()),
        })

    return rows.groupBy("dim", by).applyInArrow(pack, f"dim int, {by} long, ids binary, values binary, kths binary")


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Search rows (dim, shard, block, ids/values of the shard, ids/values/kths of the block).

    Rows come shard by shard, so that each tree is built once in a task.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        none, filler = np.iinfo("<i8").min, np.iinfo("<i8").max
        tree, here, shared = None, None, {}
        for batch in batches:
            for row in (r for one in range(batch.num_rows) for r in batch.slice(one, 1).to_pylist()):
                dim = row["dim"]
                if here != (dim, row["shard"]):
                    ids, here = np.frombuffer(row["shard_ids"], "<i8"), (dim, row["shard"])
                    tree = BallTree(unpacked(row["shard_values"], len(ids), dim))
                query_ids = np.frombuffer(row["ids"], "<i8")
                queries = unpacked(row["values"], len(query_ids), dim)
                floor = np.frombuffer(row["kths"], "<i8")
                floor = np.maximum(floor, shared.get((dim, row["block"]), floor))
                # A known k-th score stands as k places that any row as good may take.
                best = [[(-s, filler)] * k if s != none else [] for s in floor.tolist()]
                best = search_shard(tree, ids, queries, query_ids, best, k)
                now = [-found[k - 1][0] if len(found) >= k else none for found in best]
                shared[dim, row["block"]] = np.maximum(floor, np.array(now, "<i8"))
                out = [(q, v, -s) for q, found in zip(query_ids.tolist(), best, strict=True) for s, v in found if v != filler]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[c] for o in out], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"]
                )

    return block_batches(pairs).mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_topk(
    vectors: DataFrame, is_query: Column, k: int = K, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score) for vectors (vec_id, embedding); queries are a part of them."""
    valid = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    valid = valid.select("vec_id", quantized(F.col("embedding")).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    valid = cut_lineage(valid.select("vec_id", "v", F.size("v").alias("dim"), is_query.alias("asks")))
    rows, asking = valid.agg(F.count("*"), F.count_if("asks")).first()
    n_shards, n_blocks = max(1, -(-rows // shard_rows)), max(1, -(-asking // block_rows))
    kth = F.lit(None).cast("long").alias("kth")
    placed = F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).alias("shard")
    shards = cut_lineage(_gather(valid.select("vec_id", "v", "dim", placed, kth), "shard"))
    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(n_blocks)).alias("block")
    queries = valid.where("asks").select("vec_id", "v", "dim", block)
    trees = shards.select(
        F.col("dim").alias("d"), "shard", F.col("ids").alias("shard_ids"), F.col("values").alias("shard_values")
    )

    def search(blocks: DataFrame, chosen: Column) -> DataFrame:
        # A block stands once for each shard, which no size estimate knows: neither side may be broadcast.
        asked = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("s")).where(chosen).hint("merge")
        met = asked.join(trees, (F.col("dim") == F.col("d")) & (F.col("s") == F.col("shard")))
        met = met.select("dim", "shard", "block", "ids", "values", "kths", "shard_ids", "shard_values")
        return _search(met.sortWithinPartitions("dim", "shard"), k)

    home = F.pmod(F.col("block"), F.lit(n_shards))
    first = cut_lineage(search(_gather(queries.withColumn("kth", kth), "block"), F.col("s") == home))
    known = _ranked(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("q"), F.col("score").alias("kth"))
    again = queries.join(known, F.col("vec_id") == F.col("q"), "left").select("vec_id", "v", "dim", "block", "kth")
    rest = search(_gather(again, "block"), F.col("s") != home)
    return _ranked(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_topk(vectors, F.col("vec_id") % QUERY_EVERY == 0)


QUERIES = {"op8_exact_topk": op8_exact_topk}
ORACLES = {
    "op8_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""
}
