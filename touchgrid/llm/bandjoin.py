"""N-gram Jaccard join by MinHash banding.

Documents with equal word sequences collapse to one representative first. Band and row
counts follow from the similarity and the target recall at exactly that similarity.
Representatives that share a band hash are chained to the bucket's least member; a chain's
members are then compared in full, block against block, on their whole n-gram sets. Only
counts and chains leave a task, never the pairs, so a large group of near copies makes few
rows although all its links are counted.

Defined results: words are lower-cased runs between ASCII white space; a text with fewer
words than n has its whole word sequence as its only n-gram; a null text or one without
words is linked to nothing and is its own class; rows that repeat a doc_id are one document
(the smallest text counts); `n_links` counts the other documents at the similarity or more,
copies included; a class is what links connect, named by its smallest doc_id; rows with a
null doc_id are left out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchgrid.llm.common import ascii_words, table
from touchgrid.operators.components import connected_components
from touchgrid.session import cut_lineage

NGRAM = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.9999
#: Hash functions a signature may have; more rows to a band mean fewer false candidates.
MOST_HASHES = 420
SEED = 11
#: Sets compared with each other in one task at a time.
BLOCK_SETS = 256


def bands_and_rows(similarity: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows per band, and the fewest bands, that reach the recall at the similarity."""
    best = (1, 1)
    for rows in range(1, 33):
        miss = 1 - similarity**rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(miss))) if miss > 0 else 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


def ngram_sets(values, lengths, n: int):
    """(hashes, counts): the distinct n-gram hashes of each text, sorted, laid end to end."""
    import numpy as np

    values = values.astype(np.uint64, copy=False)
    size = np.where(lengths > 0, np.maximum(lengths - n + 1, 1), 0)
    text = np.repeat(np.arange(len(lengths)), size)
    first = np.cumsum(lengths) - lengths
    at = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size) + first[text]
    last = (first + lengths)[text]
    mixed = np.zeros(len(text), np.uint64)
    for i in range(n):
        inside = at + i < last
        word = np.where(inside, values[np.minimum(at + i, max(len(values) - 1, 0))], np.uint64(0)) if len(values) else mixed
        mixed = (mixed ^ word) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.lexsort((mixed, text))
    mixed, text = mixed[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (mixed[1:] != mixed[:-1]) | (text[1:] != text[:-1])
    return mixed[new], np.bincount(text[new], minlength=len(lengths))


def band_hashes(hashes, counts, bands: int, rows: int):
    """One 64-bit hash for each (text, band); texts without n-grams are not expected."""
    import numpy as np

    rng = np.random.default_rng(SEED)
    k = bands * rows
    odd = (rng.integers(0, 1 << 32, k, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    salt = rng.integers(0, 1 << 32, k, dtype=np.uint64).astype(np.uint32)
    mixers = (rng.integers(0, 1 << 63, k, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
    low = hashes.astype(np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(counts) - counts
    out = np.zeros((len(counts), bands), np.uint64)
    for i in range(k):
        mixed = (low ^ salt[i]) * odd[i] + high
        mixed ^= mixed >> np.uint32(15)
        least = np.minimum.reduceat(mixed * odd[k - 1 - i], starts).astype(np.uint64)
        band = i // rows
        out[:, band] = (out[:, band] ^ (least + np.uint64(1))) * mixers[i]
        out[:, band] ^= out[:, band] >> np.uint64(31)
    return out


def _texts_in(batch):
    """The word hashes of a batch as (values, lengths)."""
    import numpy as np

    words = batch.column("words")
    lengths = np.diff(words.offsets.to_numpy())
    return words.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), lengths


def signatures(docs: DataFrame, n: int, bands: int, rows: int, piece_rows: int = 200) -> DataFrame:
    """(doc_id, k1, k2, n, marks) of documents (doc_id, text): the text's key, its words, its band hashes."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, piece_rows):
                batch = whole.slice(at, piece_rows)
                hashes, counts = ngram_sets(*_texts_in(batch), n)
                some = counts > 0
                marks = np.zeros((len(counts), bands), np.int64)
                if some.any():
                    marks[some] = band_hashes(hashes, counts[some], bands, rows).view(np.int64)
                offsets = pa.array(np.arange(0, marks.size + 1, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("doc_id", "k1", "k2", "n")),
                     pa.ListArray.from_arrays(offsets, pa.array(marks.reshape(-1)))], ["doc_id", "k1", "k2", "n", "marks"],
                )

    return hashed_words(docs).mapInArrow(run, "doc_id long, k1 long, k2 long, n int, marks array<long>")


def hashed_words(docs: DataFrame, *kept: str) -> DataFrame:
    """(doc_id, k1, k2, n, words, *kept): the hashes of a text's words, their number, and a 128-bit key."""
    words = docs.where("doc_id IS NOT NULL").select("doc_id", ascii_words(F.col("text")).alias("ws"), *kept)
    words = words.select("doc_id", F.size("ws").alias("n"), F.transform("ws", lambda w: F.xxhash64(w)).alias("words"), *kept)
    key = F.xxhash64("words").alias("k1"), F.xxhash64(F.lit("second"), "words").alias("k2")
    return words.select("doc_id", *key, "n", "words", *kept)


def _compare(met: DataFrame, n: int, similarity: float) -> DataFrame:
    """Rows (chain, a, b, side, rep, copies, words) -> (rep, links, top) within each block pair."""

    def compare(group):
        import numpy as np
        import pyarrow as pa

        group = group.sort_by("rep").combine_chunks()
        batch = group.to_batches()[0]
        hashes, counts = ngram_sets(*_texts_in(batch), n)
        reps, copies = batch.column("rep").to_numpy(), batch.column("copies").to_numpy()
        side, same = batch.column("side").to_numpy(), batch.column("a")[0] == batch.column("b")[0]
        owner = np.repeat(np.arange(len(counts)), counts)
        order = np.argsort(hashes, kind="stable")
        ids = np.empty(len(hashes), np.int64)
        fresh = np.ones(len(hashes), np.int64)
        fresh[1:] = np.diff(hashes[order].view(np.int64)) != 0
        ids[order] = np.cumsum(fresh) - 1
        holders = owner[order]
        begins = np.concatenate([np.flatnonzero(fresh), [len(hashes)]])
        links, top = np.zeros(len(counts), np.int64), np.arange(len(counts))

        def root(x):
            while top[x] != x:
                top[x] = x = top[top[x]]
            return x

        starts = np.cumsum(counts) - counts
        for x in np.flatnonzero((side == 0) & (counts > 0)) if not same else np.flatnonzero(counts > 0):
            own = ids[starts[x]:starts[x] + counts[x]]
            lengths = begins[own + 1] - begins[own]
            at = np.repeat(begins[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            shared = np.bincount(holders[at], minlength=len(counts))
            near = shared >= similarity * (counts[x] + counts - shared) * (1 - 1e-12)
            near &= (np.arange(len(counts)) > x) if same else (side == 1)
            near &= counts > 0
            others = np.flatnonzero(near)
            links[x] += copies[others].sum()
            links[others] += copies[x]
            for y in others.tolist():
                r, s = root(x), root(y)
                if r != s:
                    top[max(r, s)] = min(r, s)
        tops = np.array([reps[root(x)] for x in range(len(counts))])
        kept = links > 0
        return pa.table({"rep": reps[kept], "links": links[kept], "top": tops[kept]})

    return met.groupBy("chain", "a", "b").applyInArrow(compare, "rep long, links long, top long")


def similar_documents(
    docs: DataFrame, n: int = NGRAM, similarity: float = SIMILARITY, recall: float = TARGET_RECALL,
    block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """(doc_id, class_id, n_links) of every document (doc_id, text)."""
    bands, rows = bands_and_rows(similarity, recall)
    docs = docs.select("doc_id", "text")
    signed = cut_lineage(signatures(docs, n, bands, rows))
    # One text for each doc_id, then the copies of each text.
    member = signed.groupBy("doc_id").agg(F.min(F.struct("k1", "k2", "n")).alias("k")).select("doc_id", "k.*")
    copies = member.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    member = cut_lineage(
        member.join(copies, ["k1", "k2"], "left").select(
            "doc_id", "k1", "k2", "n",
            F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep"),
            F.when(F.col("n") > 0, F.col("copies")).otherwise(1).alias("copies"),
        )
    )
    reps = member.where("n > 0 AND doc_id = rep").select("rep", F.col("k1").alias("r1"), F.col("k2").alias("r2"), "copies")
    own = (F.col("doc_id") == F.col("rep")) & (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2"))
    marks = signed.join(reps, own).select("rep", F.posexplode("marks").alias("band", "h"))
    least = marks.groupBy("band", "h").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first < last")
    chains = connected_components(marks.join(least, ["band", "h"]).select("rep", "first").distinct(), "rep", "first")

    members = chains.select(F.col("node").alias("rep"), F.col("component").alias("chain"))
    sizes = members.groupBy("chain").agg(F.ceil(F.count("*") / block_sets).cast("int").alias("blocks"))
    placed = members.join(sizes, "chain").withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "rep"), F.col("blocks")).cast("int"))
    # Only here whole texts move, and only the members of a chain get past the join.
    wanted = placed.join(reps, "rep")
    found = docs.join(wanted, F.col("doc_id") == F.col("rep"))
    found = hashed_words(found, "chain", "block", "blocks", "rep", "copies", "r1", "r2")
    texts = found.where("k1 = r1 AND k2 = r2").dropDuplicates(["rep"])
    met = texts.select(
        "chain", "block", "rep", "copies", "words", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "chain", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "copies", "words",
    )
    linked = cut_lineage(_compare(met, n, similarity))
    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = connected_components(linked.select("rep", "top").distinct(), "rep", "top")
    classes = classes.select(F.col("node").alias("rep"), F.col("component").alias("class_id"))
    return member.join(links, "rep", "left").join(classes, "rep", "left").select(
        "doc_id", F.coalesce("class_id", "rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op6_ngram_join": op6_ngram_join}
ORACLES = {
    "op6_ngram_join": """
WITH RECURSIVE ws AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t-\\r]+'), lambda w: w <> '') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM ws WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 5 * c >= 4 * (p.n + q.n - c)
), walk AS (
  SELECT doc_id, doc_id AS reach FROM documents
  UNION SELECT walk.doc_id, links.y FROM walk JOIN links ON links.x = walk.reach
), classes AS (SELECT doc_id, min(reach) AS class_id FROM walk GROUP BY doc_id),
degree AS (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM classes LEFT JOIN degree USING (doc_id)
"""
}
