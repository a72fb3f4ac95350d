"""Centroid clustering by heap-ordered bounds.

Vectors are packed into blocks of bounded size that stay together over all rounds, so the rounds
shuffle nothing but sums. In a block each cluster keeps a heap of its vectors, ordered by the gap
between a lower bound on the distance to every other centroid and an upper bound on the distance
to the own one. When the centroids move, a gap shrinks by at most the own centroid's drift plus
the largest drift of the others. That sum is accumulated per cluster, and a gap enters the heap
with the sum of that moment added, so no stored gap is ever touched again: only vectors whose
gap is used up stand at the top of their heap. They are popped and compared exactly with all
centroids. A round writes the blocks anew below the shared checkpoint folder (the table before is
deleted then) with the sums of the vectors that changed their cluster; Spark adds these up, and
only k rows of sums reach the driver.

Distances are exact integers; the bounds are doubles, widened by more than their rounding.

Defined results: a vector that is null, has another number of components than asked for, or a
null or non-finite component takes no part; components beyond 64 bits are clipped, as are
distances, and then their sums; ties go to the smaller centroid number; rows that repeat an id are
vectors of their own, equal start hashes are ordered by components; a row without an id is
clustered but starts a centroid only where the others are too few; with fewer than k vectors there are
fewer centroids; an empty centroid stays where it is; an empty table gives no rows; columns beside
id and vector are ignored.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchgrid.llm.common import block_batches, drop_folder, shared_folder, table
from touchgrid.llm.topk import quantized, usable

K = 16
ROUNDS = 3
SCALE = 64
DIM = 64
SEED = 1
#: Vectors of a block: its heaps and the distances of a whole rescan are held by one task.
BLOCK_ROWS = 4096
#: Relative rounding allowed for in a bound; doubles round by about 2e-16 a step.
SLACK = 1e-12
LONG_MAX = (1 << 63) - 1


def squared_distances(points, centroids):
    """Exact squared distances (rows by centroids), as doubles while these hold every integer met."""
    import numpy as np

    reach = max(int(np.abs(points.astype(float)).max(initial=0)), max(abs(x) for c in centroids for x in c)) + 1
    kind = float if 4 * reach * reach * max(points.shape[1], 1) < 1 << 53 else object
    own, other = points.astype(kind), np.array(centroids, dtype=kind)
    return (own * own).sum(axis=1)[:, None] - 2 * (own @ other.T) + (other * other).sum(axis=1)


class Block:
    """Vectors with their clusters, and per cluster the heap of (gap and offset, row)."""

    def __init__(self, points, k: int):
        import numpy as np

        self.points = points
        self.cluster = np.full(len(points), -1, np.int32)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]

    def due(self, offsets: list[float]) -> list[int]:
        """The rows whose gap the drifts since its entry may have used up, taken off their heaps."""
        from heapq import heappop

        out = [i for i in range(len(self.cluster)) if self.cluster[i] < 0]
        for heap, offset in zip(self.heaps, offsets, strict=True):
            while heap and heap[0][0] <= offset + SLACK * (1 + abs(offset) + abs(heap[0][0])):
                out.append(heappop(heap)[1])
        return out

    def assign(self, centroids: list[list[int]], offsets: list[float]) -> dict[int, list[int]]:
        """Rescan what is due; per cluster that changed the sums of components and the count, as differences."""
        from heapq import heappush

        import numpy as np

        rows = self.due(offsets)
        if not rows:
            return {}
        rows = np.array(rows)
        distances = squared_distances(self.points[rows], centroids)
        nearest = distances.argmin(axis=1)
        at = np.arange(len(rows))
        upper = np.sqrt(distances[at, nearest].astype(float))
        if len(centroids) > 1:
            distances[at, nearest] = distances.max() + 1
            lower = np.sqrt(distances.min(axis=1).astype(float))
        else:
            lower = np.full(len(rows), math.inf)
        gaps = lower * (1 - SLACK) - upper * (1 + SLACK)
        for row, cluster, gap in zip(rows.tolist(), nearest.tolist(), gaps.tolist(), strict=True):
            heappush(self.heaps[cluster], (gap + offsets[cluster], row))
        changed: dict[int, list[int]] = {}
        before = self.cluster[rows]
        moved = before != nearest
        for cluster in set(before[moved].tolist()) | set(nearest[moved].tolist()):
            if cluster >= 0:
                came = self.points[rows[moved & (nearest == cluster)]].astype(object)
                went = self.points[rows[moved & (before == cluster)]].astype(object)
                sums = came.sum(axis=0) - went.sum(axis=0)
                changed[cluster] = [*(int(x) for x in np.broadcast_to(sums, self.points.shape[1:])), len(came) - len(went)]
        self.cluster[rows] = nearest
        return changed

    def own_distances(self, centroids: list[list[int]]) -> list[int]:
        import numpy as np

        out = np.zeros(len(self.points), object)
        for cluster in np.unique(self.cluster).tolist():
            mine = self.cluster == cluster
            out[mine] = squared_distances(self.points[mine], [centroids[cluster]])[:, 0]
        return [int(x) for x in out]

    # A block as columns of a table and back.
    def stored(self) -> dict[str, object]:
        import numpy as np

        small = np.abs(self.points.astype(float)).max(initial=0)
        kind = next(t for t, most in (("<i1", 127), ("<i2", 32767), ("<i4", (1 << 31) - 1), ("<i8", math.inf)) if small <= most)
        flat = [entry for heap in self.heaps for entry in heap]
        return {
            "kind": kind, "points": self.points.astype(kind).tobytes(), "cluster": self.cluster.astype("<i4").tobytes(),
            "heap_sizes": np.array([len(h) for h in self.heaps], "<i4").tobytes(),
            "heap_gaps": np.array([g for g, _ in flat], "<f8").tobytes(),
            "heap_rows": np.array([r for _, r in flat], "<i4").tobytes(),
        }

    @classmethod
    def read(cls, row: dict, dim: int) -> Block:
        import numpy as np

        sizes = np.frombuffer(row["heap_sizes"], "<i4").tolist()
        block = cls(np.frombuffer(row["points"], row["kind"]).reshape(-1, dim).astype(np.int64), len(sizes))
        block.cluster = np.frombuffer(row["cluster"], "<i4").copy()
        flat = list(zip(np.frombuffer(row["heap_gaps"], "<f8").tolist(), np.frombuffer(row["heap_rows"], "<i4").tolist(), strict=True))
        at = 0
        for c, size in enumerate(sizes):
            block.heaps[c] = flat[at:at + size]
            at += size
        return block


STORED = "kind string, points binary, cluster binary, heap_sizes binary, heap_gaps binary, heap_rows binary"
SUMS = "sums array<struct<cluster: int, place: int, value: decimal(38,0)>>"


def _sums(changed: dict[int, list[int]]) -> list[dict]:
    return [
        {"cluster": c, "place": p, "value": Decimal(v)} for c, values in changed.items() for p, v in enumerate(values) if v
    ]


def _sums_type():
    import pyarrow as pa

    return pa.list_(pa.struct([("cluster", pa.int32()), ("place", pa.int32()), ("value", pa.decimal128(38, 0))]))


class _Rounds:
    """The rounds over written tables of blocks; the driver holds k centroids and their sums."""

    def __init__(self, valid: DataFrame, start: list[list[int]], dim: int, block_rows: int):
        self.spark, self.valid, self.dim, self.block_rows = valid.sparkSession, valid, dim, block_rows
        self.id_type = valid.schema["vec_id"].dataType.simpleString()
        self.centroids = start
        self.sums = [[0] * (dim + 1) for _ in start]
        self.offsets = [0.0] * len(start)
        self.path: str | None = None

    def assign(self, last: bool) -> DataFrame:
        """Assign every vector to the present centroids; the blocks as written."""
        centroids, offsets, dim, block_rows = self.centroids, self.offsets, self.dim, self.block_rows

        def out(ids, block):
            import pyarrow as pa

            changed = block.assign(centroids, offsets)
            row = {n: pa.array([v]) for n, v in block.stored().items()}
            sums = _sums(changed)
            if last:
                far = [min(d, LONG_MAX) for d in block.own_distances(centroids)]
                spread = dict.fromkeys(set(block.cluster.tolist()), 0)
                for c, d in zip(block.cluster.tolist(), far, strict=True):
                    spread[c] += d
                # After the last round the sums are those of the distances.
                sums = [{"cluster": c, "place": 0, "value": Decimal(d)} for c, d in spread.items()]
                row |= {"clusters": pa.array([block.cluster.tolist()], pa.list_(pa.int32())),
                        "distances": pa.array([far], pa.list_(pa.int64()))}
            row = {"ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)} | row
            return pa.RecordBatch.from_pydict(row | {"sums": pa.array([sums], _sums_type())})

        def begin(batches):
            import numpy as np
            import pyarrow as pa

            def packed(held):
                whole = pa.Table.from_batches(held).combine_chunks()
                values = whole.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                block = Block(values.astype(np.int64).reshape(whole.num_rows, dim), len(centroids))
                return out(whole.column("vec_id").combine_chunks(), block)

            held, rows = [], 0
            for batch in batches:
                at = 0
                while at < batch.num_rows:
                    part = batch.slice(at, block_rows - rows)
                    held.append(part)
                    rows, at = rows + part.num_rows, at + part.num_rows
                    if rows == block_rows:
                        yield packed(held)
                        held, rows = [], 0
            if rows:
                yield packed(held)

        def again(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n not in ("ids", "sums")}
                    yield out(batch.column("ids")[i].values, Block.read(row, dim))

        schema = f"ids array<{self.id_type}>, {STORED}" + ", clusters array<int>, distances array<long>" * last + f", {SUMS}"
        source = self.valid.select("vec_id", "v") if self.path is None else block_batches(self.spark.read.parquet(self.path))
        path = shared_folder(self.spark, "heap-blocks")
        source.mapInArrow(begin if self.path is None else again, schema).write.option("compression", "zstd").parquet(path)
        if self.path is not None:
            drop_folder(self.spark, self.path)
        self.path = path
        return self.spark.read.schema(schema).parquet(path)

    def added(self, blocks: DataFrame) -> list:
        """The blocks' sums, added up: at most k * (dim + 1) rows."""
        each = blocks.select(F.explode("sums").alias("s")).select("s.*")
        return each.groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect()

    def move(self, blocks: DataFrame) -> None:
        """Centroids to the floor of their vectors' mean; the drifts onto the offsets."""
        for row in self.added(blocks):
            self.sums[row["cluster"]][row["place"]] += int(row["value"])
        moved = [[x // s[-1] for x in s[:-1]] if s[-1] else c for s, c in zip(self.sums, self.centroids, strict=True)]
        drifts = [
            math.sqrt(sum((a - b) ** 2 for a, b in zip(new, old, strict=True))) * (1 + SLACK)
            for new, old in zip(moved, self.centroids, strict=True)
        ]
        for c in range(len(moved)):
            others = max(drifts[:c] + drifts[c + 1:], default=0.0)
            self.offsets[c] = (self.offsets[c] + drifts[c] + others) * (1 + SLACK)
        self.centroids = moved


def cluster_vectors(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for vectors (vec_id, embedding).

    The k centroids start as the vectors with the smallest sha256 of `<seed>:<vec_id>`.
    """
    spark = vectors.sparkSession
    valid = vectors.where(usable(F.col("embedding")) & (F.size("embedding") == dim))
    valid = valid.select("vec_id", quantized(F.col("embedding"), scale).alias("v"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = valid.select(order.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    id_type = valid.schema["vec_id"].dataType.simpleString()
    if not first:
        return spark.createDataFrame(
            [], f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    work = _Rounds(valid, [[int(x) for x in r["v"]] for r in first], dim, block_rows)
    for _ in range(rounds):
        work.move(work.assign(last=False))
    blocks = work.assign(last=True)
    spread = {r["cluster"]: int(r["value"]) for r in work.added(blocks)}
    # One row for each of the k centroids.
    known = spark.createDataFrame(
        [
            (c, min(spread.get(c, 0), LONG_MAX), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())
            for c, own in enumerate(work.centroids)
        ],
        "number int, cluster_inertia long, centroid_sha256 string",
    )
    rows = blocks.select(F.explode(F.arrays_zip("ids", "clusters", "distances")).alias("r"))
    rows = rows.select(F.col("r.ids").alias("vec_id"), F.col("r.clusters").alias("cluster"), F.col("r.distances").alias("distance"))
    return rows.join(F.broadcast(known), F.col("cluster") == F.col("number")).select(
        "vec_id", "cluster", "distance", "cluster_inertia",
        F.lit(min(sum(spread.values()), LONG_MAX)).cast("long").alias("inertia"), "centroid_sha256",
    )


def op11_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _oracle(k: int = K, rounds: int = ROUNDS) -> str:
    """Every round as two views: the nearest centroid of each vector, then the floored means."""
    floored = "(s - (s % n + n) % n) // n"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (
  SELECT v.vec_id, v.e, c.number,
         list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS distance
  FROM v, c{r} c
), a{r} AS (
  SELECT vec_id, any_value(e) AS e, arg_min(number, (distance, number)) AS number, min(distance) AS distance
  FROM d{r} GROUP BY vec_id
)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (
  SELECT number, place, sum(x)::HUGEINT AS s, count(*) AS n
  FROM (SELECT number, unnest(e) AS x, generate_subscripts(e, 1) AS place FROM a{r}) GROUP BY number, place
), m{r} AS (SELECT number, list({floored} ORDER BY place)::BIGINT[] AS e FROM s{r} GROUP BY number),
c{r + 1} AS (SELECT c.number, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN m{r} m USING (number))""")
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS number, e FROM (
    SELECT sha256('{SEED}:' || vec_id) AS h, e FROM v ORDER BY h LIMIT {k}
  )
), {", ".join(steps)}
SELECT vec_id, number AS cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY number))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (number)
"""


QUERIES = {"op11_heap_clusters": op11_heap_clusters}
ORACLES = {"op11_heap_clusters": _oracle()}
