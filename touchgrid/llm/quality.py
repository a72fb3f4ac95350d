"""Quality grades by ordinal cumulative-link regression over hashed text.

P(grade <= j) = sigmoid(threshold_j - w.x) with one weight vector for all grades and ordered
thresholds. x holds the hashed words and word beginnings of a text (present or not) and the
shares of its token shapes. The result is the expected grade and the tail probability P(grade >= wanted).

Fitting uses at most `FIT_ROWS_PER_GRADE` labelled documents of each grade, chosen by a hash
of the id from those outside the held-out fifth; scoring covers every document and its whole text.
Most words of a text say nothing about its grade, so the weights carry a lasso penalty, which
leaves a few hundred of them; every grade counts alike in the fit, however rare it is.

Defined results: a null text, or one without tokens, has expected grade 0, tail probability
0 and is not selected; documents without labels are scored like all others; repeated rows
get equal scores; labels with a null part, or of unknown documents, are not used; an empty
table gives no rows, and with no usable label at all the model is undecided (equal
probability for each grade).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchgrid.llm.common import table

GRADES = 3
#: toxic -> 0, poor -> 1, good -> 2.
GRADE_SQL = (
    "CASE WHEN toxic IS NULL OR quality IS NULL THEN NULL WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 "
    "WHEN quality = 1 AND toxic = 0 THEN 2 END"
)
FIT_ROWS_PER_GRADE = 1000
HASH_BITS = 18
ROUNDS = 300
L1 = 1e-3
#: Documents of the sample that must hold a feature before it gets a weight.
LEAST_DOCS = 8
#: How many times the wanted rows pass the first choice of the sample, by a bound on their hash.
SPARE = 4
WANTED, SELECT_AT = 2, 0.5
CACHE_WORDS = 300_000
SCORES = "expected_grade double, tail_prob double, grade int"


def held_out(doc_id: Column) -> Column:
    """The fifth of documents that no model is fitted on."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Features:
    """Texts -> sparse rows. Words seen before are looked up; the cache is bounded."""

    def __init__(self, bits: int = HASH_BITS):
        self.mask = (1 << bits) - 1
        self.known: dict[str, tuple[int, int, int]] = {}

    def _look_up(self, token: str) -> tuple[int, int, int]:
        from zlib import crc32

        word = token.strip(".,;:!?\"'()").lower() or token
        shape = "".join("a" if c.isalpha() else "0" if c.isdigit() else c for c in token)
        while "aa" in shape:
            shape = shape.replace("aa", "a")
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        names = word, "\1" + word[:5], "\0" + shape[:8]
        found = tuple(crc32(x.encode("utf-8", "replace")) & self.mask for x in names)
        self.known[token] = found
        return found

    def row(self, text: str | None):
        """(columns, values) of one text; both empty when it has no token."""
        import numpy as np

        tokens = (text or "").split()
        if not tokens:
            return np.empty(0, np.int64), np.empty(0)
        get, look_up = self.known.get, self._look_up
        pairs = np.array([get(t) or look_up(t) for t in tokens], np.int64)
        words, stems = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
        shapes, counts = np.unique(pairs[:, 2], return_counts=True)
        again = np.mean(pairs[1:, 0] == pairs[:-1, 0]) if len(pairs) > 1 else 0.0
        variety = len(words) / len(pairs)
        columns = np.concatenate([words, stems, shapes, [1, 2]])
        values = np.concatenate([np.ones(len(words) + len(stems)), 4 * counts / len(pairs), [4 * again, 4 * variety]])
        return columns, values


def _sparse_rows(docs: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        features = Features()
        for batch in batches:
            rows = [features.row(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rows], pa.list_(pa.float32()))], ["grade", "columns", "values"],
            )

    return docs.select("grade", "text").mapInArrow(run, "grade int, columns array<int>, values array<float>")


def _chosen(grades: DataFrame, fit_rows: int) -> DataFrame:
    """(doc_id, grade) of the `fit_rows` documents of each grade with the least hashes.

    Few of them can pass the bound on the hash, so the rows that are ranked in one place do not
    grow with the labels; documents with several ratings have the lowest.
    """
    mark = F.xxhash64(F.lit("fit"), "doc_id")
    rated = grades.where("grade IS NOT NULL").where(~held_out(F.col("doc_id")))
    rated = rated.groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    # One row for each grade.
    counts = rated.groupBy("grade").agg(F.count(F.lit(1)).alias("rows")).withColumnRenamed("grade", "of")
    share = (mark / F.lit(2.0**64) + 0.5) * F.col("rows") <= SPARE * fit_rows
    near = rated.join(F.broadcast(counts), F.col("grade") == F.col("of")).where(share).select("doc_id", "grade")
    order = W.partitionBy("grade").orderBy(mark, "doc_id")
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= fit_rows)


def loss_and_slopes(s, y, theta, weight):
    """The weighted mean of -log P(grade), and its slopes by each row's score `s` and by `theta`.

    theta holds the first threshold and the logarithms of the steps to the next ones, which
    keeps them in order.
    """
    import numpy as np

    cuts = np.concatenate([[-np.inf], thresholds_of(theta), [np.inf]])
    with np.errstate(over="ignore"):
        upper, lower = 1 / (1 + np.exp(s - cuts[y + 1])), 1 / (1 + np.exp(s - cuts[y]))
    p = np.maximum(upper - lower, 1e-9)
    up, low = upper * (1 - upper) / p * weight / len(y), lower * (1 - lower) / p * weight / len(y)
    by_cut = np.array([low[y == j + 1].sum() - up[y == j].sum() for j in range(GRADES - 1)])
    by_theta = [by_cut.sum(), *(np.exp(theta[j]) * by_cut[j:].sum() for j in range(1, GRADES - 1))]
    return -float(np.mean(weight * np.log(p))), up - low, np.array(by_theta)


def thresholds_of(theta):
    import numpy as np

    return theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))])


def train(lengths, columns, values, y, rounds: int = ROUNDS, l1: float = L1):
    """(weights, thresholds) of sparse rows: `lengths` features each, laid end to end; y: grades."""
    import numpy as np

    n = len(y)
    which = np.repeat(np.arange(n, dtype=np.int32), lengths)
    active, place, often = np.unique(columns, return_inverse=True, return_counts=True)
    number = np.where(often >= LEAST_DOCS, np.cumsum(often >= LEAST_DOCS) - 1, -1)[place]
    active, common = active[often >= LEAST_DOCS], number >= 0
    values, place, which = values[common], number[common].astype(np.int32), which[common]
    even = np.log(np.arange(1, GRADES) / np.arange(GRADES - 1, 0, -1))
    w, theta = np.zeros(len(active)), np.array([even[0], *np.log(np.diff(even))])
    weight = (1 / np.maximum(np.bincount(y, minlength=GRADES), 1))[y]
    weight /= weight.mean()
    moment, speed = np.zeros(len(w) + len(theta)), np.zeros(len(w) + len(theta))
    for step in range(1, rounds + 1):
        s = np.bincount(which, values * w[place], n)
        _, by_score, by_theta = loss_and_slopes(s, y, theta, weight)
        g = np.concatenate([np.bincount(place, values * by_score[which], len(w)), by_theta])
        moment, speed = 0.9 * moment + 0.1 * g, 0.99 * speed + 0.01 * g * g
        rate = 0.05 * (1 - 0.9 * step / rounds) / (np.sqrt(speed / (1 - 0.99**step)) + 1e-4)
        move = rate * (moment / (1 - 0.9**step))
        w, theta = w - move[: len(w)], theta - move[len(w):]
        # The lasso's own step: a weight nearer to zero than the penalty's pull stays there.
        w = np.sign(w) * np.maximum(np.abs(w) - rate[: len(w)] * l1, 0)
    weights = np.zeros(1 << HASH_BITS)
    weights[active] = w
    return weights, thresholds_of(theta)


def fit(docs: DataFrame, grades: DataFrame, fit_rows: int = FIT_ROWS_PER_GRADE, rounds: int = ROUNDS):
    """(weights, thresholds) from documents (doc_id, text) and ratings (doc_id, grade)."""
    import numpy as np

    # Rows that repeat a rated doc_id are one document here, so the bound holds for rows too.
    chosen = F.broadcast(_chosen(grades, fit_rows))
    sample = docs.join(chosen, "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    rows = _sparse_rows(sample).where(F.size("columns") > 0).toArrow()
    if not rows.num_rows:
        return np.zeros(1 << HASH_BITS), np.log(np.arange(1, GRADES) / np.arange(GRADES - 1, 0, -1))
    lists = rows.column("columns").combine_chunks()
    columns, values = lists.flatten().to_numpy(), rows.column("values").combine_chunks().flatten().to_numpy()
    return train(np.diff(lists.offsets.to_numpy()), columns, values, rows.column("grade").to_numpy(), rounds)


def score(docs: DataFrame, model, wanted: int = WANTED) -> DataFrame:
    """`docs` (doc_id, text) -> doc_id, expected_grade, tail_prob, grade."""
    weights, thresholds = model
    shared = docs.sparkSession.sparkContext.broadcast((weights.astype("float32"), thresholds))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        weights, thresholds = shared.value
        features = Features()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = [features.row(t) for t in texts]
            s = np.array([float(weights[c] @ v) if len(c) else 0.0 for c, v in rows])
            above = 1 / (1 + np.exp(thresholds[None, :] - s[:, None]))  # P(grade > j)
            some = np.array([len(c) > 0 for c, _ in rows], bool)
            expected = np.where(some, above.sum(axis=1), 0.0)
            tail = np.where(some, above[:, wanted - 1], 0.0)
            full = np.concatenate([np.ones((len(s), 1)), above, np.zeros((len(s), 1))], axis=1)
            grade = np.where(some, (full[:, :-1] - full[:, 1:]).argmax(axis=1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(expected), pa.array(tail), pa.array(grade, pa.int32())],
                ["doc_id", "expected_grade", "tail_prob", "grade"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCORES}")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = table(spark, sf_dir, "labels").select("doc_id", F.expr(GRADE_SQL).alias("grade"))
    scored = score(docs, fit(docs, ratings))
    return scored.select("*", (F.col("tail_prob") >= SELECT_AT).alias("selected"))


QUERIES = {"op1_quality": op1_quality}
ORACLES: dict[str, str] = {}
