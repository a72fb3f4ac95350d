"""Hard-negative mining with rotated one-bit codes.

Vectors are sorted by label and packed into shards of bounded size. A shard stores, beside the
integer components, for each vector its rotated one-bit code (the signs after a fixed random
rotation), its norm, and how well the code is aligned with it: a = <o, b> for the unit vector o
and the unit code b. As o = a b + r with r orthogonal to b and |r| = sqrt(1 - a^2), any query q has

    <q, o> = a <q, b> + <q, r>,  |<q, r>| <= sqrt(|q|^2 - <q, b>^2) sqrt(1 - a^2)

by Cauchy-Schwarz: a deterministic interval around the estimate. <q, b> is a popcount: the query's
rotated components are rounded to a few bits, so that it is a weighted sum of the common bits of
its bit planes and the code; what rounding takes away, times the vector's norm, widens the
interval. A vector is scored in integers only if its interval reaches what is asked for.

Anchors travel in blocks of bounded size to groups of shards; the best scores found in one shard
of a group serve as thresholds in the next. A first pass finds each anchor's positives and meets
only shards that hold the label; a second asks, for each positive, for the best rows of other
labels inside the score band, and meets only shards that hold another label.

Defined results: a vector without an id or a label, or that is null, or has a null or non-finite
component, takes no part; only vectors of the same length are compared; rows that repeat an id
are one vector (the smallest by label, then components); scores are exact integers, clipped to 64
bits; ties go to the smaller id; an anchor without another row of its label gives no rows, nor
does a positive whose band holds none (as for a negative score); an empty table gives no
rows; columns beside id, vector and label are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchgrid.llm.common import block_batches, stage_table, table
from touchgrid.llm.topk import QUERY_EVERY, SCALE, quantized, usable

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 50, 95
RELABEL_EVERY, LABELS = 7, 10
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
#: Shards, on average, that one task searches for one block.
GROUP_SHARDS = 8
#: Anchors whose intervals with a shard are held at a time.
ANCHORS_AT_ONCE = 64
#: Bits of a query's rotated components.
QUERY_BITS = 6
ROTATION_SEED = 17
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def rotation(dim: int):
    """A fixed random rotation of `dim` dimensions."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng([ROTATION_SEED, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def packed_bits(bits):
    """Rows of booleans as rows of 64-bit words."""
    import numpy as np

    short = -bits.shape[1] % 64
    wide = np.pad(bits, ((0, 0), (0, short)))
    return np.packbits(wide, axis=1).view(np.uint64)


def encode(points, turn):
    """(codes, norms, alignments) of the rows of `points`."""
    import numpy as np

    turned = points.astype(float) @ turn
    # Scaled first, so that huge components do not overflow when squared.
    top = np.abs(turned).max(axis=1, initial=0)
    unit = turned / np.where(top > 0, top, 1)[:, None]
    length = np.sqrt((unit * unit).sum(axis=1))
    full = np.sqrt(max(turned.shape[1], 1)) * np.where(length > 0, length, 1)
    return packed_bits(turned > 0), length * top, np.minimum(np.abs(unit).sum(axis=1) / full, 1.0)


def intervals(queries, codes, norms, alignments, turn, bits: int = QUERY_BITS):
    """(low, high), queries by vectors: between them lies every inner product."""
    import numpy as np

    dim = max(queries.shape[1], 1)
    turned = queries.astype(float) @ turn
    low = turned.min(axis=1, initial=0)
    step = (turned.max(axis=1, initial=0) - low) / ((1 << bits) - 1)
    levels = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1)[:, None]).astype(np.int64)
    rounded = low[:, None] + step[:, None] * levels
    lost = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
    size = np.sqrt((rounded**2).sum(axis=1))
    common = np.zeros((len(queries), len(codes)), np.int64)
    for plane in range(bits):
        mask = packed_bits((levels >> plane & 1).astype(bool))
        for word in range(codes.shape[1]):
            common += np.bitwise_count(mask[:, word, None] & codes[None, :, word]).astype(np.int64) << plane
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    along = low[:, None] * (2 * ones - dim) + step[:, None] * (2 * common - levels.sum(axis=1)[:, None])
    along = along / np.sqrt(dim)
    rest = np.sqrt(np.maximum(size[:, None] ** 2 - along**2, 0)) * np.sqrt(np.maximum(1 - alignments**2, 0))
    # Doubles round; a billionth of the lengths is far more than that.
    rest += lost[:, None] + 1e-9 * (size + lost)[:, None]
    middle = along * alignments
    return (middle - rest) * norms - 1e-6, (middle + rest) * norms + 1e-6


def exact_scores(points, query):
    """Integer inner products, in doubles where these hold them."""
    import numpy as np

    reach = float(np.abs(points.astype(float)).max(initial=0)) * float(np.abs(query.astype(float)).max(initial=0))
    if reach * max(points.shape[1], 1) < 1 << 53:
        return (points.astype(float) @ query.astype(float)).astype(np.int64)
    exact = points.astype(object) @ query.astype(object)
    return np.array([min(max(int(s), LONG_MIN), LONG_MAX) for s in exact], np.int64)


class Want:
    """The `most` best rows with a score from `low` to `high` that were found so far."""

    def __init__(self, low: int, high: int, most: int):
        self.low, self.high, self.most = low, high, most
        self.found: list[tuple[int, int]] = []

    def least(self) -> int:
        """A row below this score can no longer come in."""
        return max(self.low, -self.found[-1][0]) if len(self.found) == self.most else self.low

    def take(self, ids, scores) -> None:
        import numpy as np

        fit = np.flatnonzero((scores >= self.least()) & (scores <= self.high))
        if len(fit) > self.most:
            own = scores[fit]
            fit = fit[own >= np.partition(own, len(own) - self.most)[len(own) - self.most]]
        came = [(-int(s), int(i)) for s, i in zip(scores[fit], ids[fit], strict=True)]
        self.found = sorted(self.found + came)[:self.most]


def search(shard: dict, anchors: dict, wants: list[list[Want]], same_label: bool, turn) -> int:
    """Improve the wants of each anchor with the rows of one shard; how many rows were scored."""
    import numpy as np

    scored = 0
    for at in range(0, len(anchors["ids"]), ANCHORS_AT_ONCE):
        queries = anchors["points"][at:at + ANCHORS_AT_ONCE]
        low, high = intervals(queries, shard["codes"], shard["norms"], shard["alignments"], turn)
        for i in range(len(queries)):
            mine = [w for w in wants[at + i] if w.low <= w.high]
            if not mine:
                continue
            # The bounds become doubles, so one unit in the last place is given away.
            least, most = float(min(w.least() for w in mine)), float(max(w.high for w in mine))
            near = (high[i] >= least - abs(least) * 1e-15) & (low[i] <= most + abs(most) * 1e-15)
            near &= (shard["labels"] == anchors["labels"][at + i]) == same_label
            near &= shard["ids"] != anchors["ids"][at + i]
            rows = np.flatnonzero(near)
            scored += len(rows)
            if len(rows):
                scores, ids = exact_scores(shard["points"][rows], queries[i]), shard["ids"][rows]
                for w in mine:
                    w.take(ids, scores)
    return scored


PACKED = (
    "part long, dim int, low long, high long, kind string, points binary, ids binary, labels binary, "
    "codes binary, norms binary, alignments binary, asked array<array<struct<name: long, score: long>>>"
)


def _pack(rows: DataFrame, most: int, coded: bool) -> DataFrame:
    """Rows (dim, label, vec_id, v, asked), sorted by label -> parts of bounded size, of one length each."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        turns, number = {}, TaskContext.get().partitionId() << 32

        def part(held, number):
            whole = pa.Table.from_batches(held).combine_chunks()
            dim = whole.column("dim")[0].as_py()
            values = whole.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            points = values.astype(np.int64).reshape(whole.num_rows, dim)
            reach = np.abs(points.astype(float)).max(initial=0)
            kind = "<i2" if reach < 1 << 15 else "<i4" if reach < 1 << 31 else "<i8"
            labels = whole.column("label").to_numpy().astype("<i8")
            row = {
                "part": number, "dim": dim, "low": int(labels[0]), "high": int(labels[-1]), "kind": kind,
                "points": points.astype(kind).tobytes(), "ids": whole.column("vec_id").to_numpy().astype("<i8").tobytes(),
                "labels": labels.tobytes(), "codes": None, "norms": None, "alignments": None, "asked": None,
            }
            if coded:
                if dim not in turns:
                    turns[dim] = rotation(dim)
                stored = encode(points, turns[dim])
                row |= {n: x.tobytes() for n, x in zip(("codes", "norms", "alignments"), stored, strict=True)}
            else:
                row["asked"] = whole.column("asked").to_pylist()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        asked = pa.list_(pa.list_(pa.struct([("name", pa.int64()), ("score", pa.int64())])))
        binary = ("points", "ids", "labels", "codes", "norms", "alignments")
        schema = pa.schema([
            ("part", pa.int64()), ("dim", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("kind", pa.string()),
            *((n, pa.binary()) for n in binary), ("asked", asked),
        ])
        held, size, dim = [], 0, None
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            at = 0
            while at < batch.num_rows:
                if size and dims[at] != dim:
                    yield part(held, number)
                    held, size, number = [], 0, number + 1
                dim = dims[at]
                other = np.flatnonzero(dims[at:] != dim)
                taken = batch.slice(at, min(most - size, int(other[0]) if len(other) else batch.num_rows - at))
                held.append(taken)
                size, at = size + taken.num_rows, at + taken.num_rows
                if size == most:
                    yield part(held, number)
                    held, size, number = [], 0, number + 1
        if size:
            yield part(held, number)

    order = ("dim", "label", "vec_id")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, "v", "asked")
    return stage_table(dealt.mapInArrow(run, PACKED), "shards" if coded else "anchors")


FOUND = "anchor_id long, name long, asked_score long, vec_id long, score long"


def _met(
    shards: DataFrame, blocks: DataFrame, same_label: bool, most: int, group_shards: int, band: tuple[int, int]
) -> DataFrame:
    """What each block finds in each group of shards."""
    names = shards.select(F.col("dim").alias("of"), "part", F.col("low").alias("a"), F.col("high").alias("b"))
    groups = max(1, -(-shards.count() // group_shards))
    names = names.withColumn("grp", F.pmod(F.xxhash64("part"), F.lit(groups)))
    asking = blocks.select("dim", F.col("part").alias("block"), "low", "high")
    if same_label:
        useful = (F.col("a") <= F.col("high")) & (F.col("low") <= F.col("b"))
    else:
        useful = ~((F.col("a") == F.col("b")) & (F.col("low") == F.col("high")) & (F.col("a") == F.col("low")))
    pairs = names.join(asking, F.col("of") == F.col("dim")).where(useful).select("part", "block", "grp")
    left = pairs.join(shards.drop("asked", "low", "high"), "part")
    whole = blocks.select(F.col("part").alias("asks"), "dim", "kind", "points", "ids", "labels", "asked")
    right = pairs.select(F.col("block").alias("asks"), F.col("grp").alias("into")).distinct().join(whole, "asks")
    least, greatest = band

    def find(met, block):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([(n, pa.int64()) for n in ("anchor_id", "name", "asked_score", "vec_id", "score")])
        if not met.num_rows or not block.num_rows:
            return schema.empty_table()
        # A group may come as several pieces; a block is one row.
        one = block.slice(0, 1).to_pylist()[0]
        dim = one["dim"]
        turn = rotation(dim)

        def read(row):
            own = {n: np.frombuffer(row[n], "<i8") for n in ("ids", "labels")}
            return own | {"points": np.frombuffer(row["points"], row["kind"]).reshape(len(own["ids"]), dim).astype(np.int64)}

        anchors = read(one)
        asked = [x if x is not None else [None] for x in one["asked"]]
        wants = [
            [
                Want(LONG_MIN, LONG_MAX, most) if a is None
                else Want(-(-least * a["score"] // 100), greatest * a["score"] // 100, most) for a in x
            ]
            for x in asked
        ]
        for i in range(met.num_rows):
            row = met.slice(i, 1).to_pylist()[0]
            shard = read(row) | {n: np.frombuffer(row[n], "<f8") for n in ("norms", "alignments")}
            shard["codes"] = np.frombuffer(row["codes"], np.uint64).reshape(len(shard["ids"]), -1)
            search(shard, anchors, wants, same_label, turn)
        out = [
            (anchor, a and a["name"], a and a["score"], v, -s)
            for anchor, x, own in zip(anchors["ids"].tolist(), asked, wants, strict=True)
            for a, w in zip(x, own, strict=True) for s, v in w.found
        ]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)] if out else schema.empty_table().columns, schema=schema)

    return left.groupBy("block", "grp").cogroup(right.groupBy("asks", "into")).applyInArrow(find, FOUND)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = LEAST, most: int = MOST, scale: int = SCALE,
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, group_shards: int = GROUP_SHARDS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for (vec_id, embedding, label).

    `is_anchor` is a condition on vec_id. For each of an anchor's `positives` best rows of its
    label, the `negatives` best rows of other labels whose score is `least` to `most` hundredths
    of the positive's.
    """
    block_batches(vectors)
    valid = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    own = F.struct(F.col("label").cast("long").alias("label"), quantized(F.col("embedding"), scale).alias("v"))
    valid = valid.select("vec_id", own.alias("own")).groupBy("vec_id").agg(F.min("own").alias("own"))
    valid = stage_table(valid.select("vec_id", "own.label", "own.v", F.size("own.v").alias("dim")), "vectors")
    no_asked = F.lit(None).cast("array<struct<name: long, score: long>>").alias("asked")
    shards = _pack(valid.select("*", no_asked), shard_rows, coded=True)
    anchors = valid.where(is_anchor)
    band = (least, most)
    first = _met(shards, _pack(anchors.select("*", no_asked), block_rows, coded=False), True, positives, group_shards, band)
    order = W.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    first = first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    # At most `positives` to an anchor.
    asked = first.groupBy("anchor_id").agg(
        F.collect_list(F.struct(F.col("vec_id").alias("name"), "score")).alias("asked")
    )
    again = anchors.join(asked, F.col("vec_id") == F.col("anchor_id")).select("dim", "label", "vec_id", "v", "asked")
    found = _met(shards, _pack(again, block_rows, coded=False), False, negatives, group_shards, band)
    order = W.partitionBy("anchor_id", "name").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", F.col("name").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("asked_score").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = rows.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % QUERY_EVERY == 0)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLES = {
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.other AS negative_id, n.score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other))::INTEGER AS rank
  FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
}
