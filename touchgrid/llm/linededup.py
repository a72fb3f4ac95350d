"""Corpus-wide line deduplication that ships hashes and bitmaps, never texts.

Lines become 128-bit hashes, range-partitioned with a secondary sort by document and
position. Two passes stream the first occurrences: the first inside (hash, document
bucket), so that a line of a third of all documents is spread over many tasks, the second
over the first document of each bucket. What comes back per document is a run-length
compressed keep bitmap.

Defined results: a null or empty text is one empty line; a line whose key has fewer than
`min_chars` code points always stays; rows repeating a doc_id count as one document, and
each of them is cleaned by its own text; a null doc_id is one document that comes after all
others; an empty table gives an empty table; columns beside id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchgrid.llm.common import table

MIN_CHARS = 10
#: Parts into which the documents of one line are dealt in the first pass.
DOCUMENT_BUCKETS = 1024
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    """The lines of a text; null is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, part, doc, body, n_lines, pos), one row for each line that can be a repeat."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    rows = rows.select(
        "doc", F.xxhash64("text").alias("body"), split_lines(F.col("text")).alias("lines")
    )
    rows = rows.select(
        "doc", "body", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line")
    )
    rows = rows.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    return rows.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), "key").alias("h2"),
        F.pmod(F.xxhash64("doc"), F.lit(DOCUMENT_BUCKETS)).cast("int").alias("part"),
        "doc", "body", "n_lines", "pos",
    )


def _first_document(*keys: str) -> Column:
    order = W.partitionBy(*keys).orderBy(F.col("doc").asc_nulls_last(), "body", "pos")
    return F.first("doc").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, body, n_lines, pos) of every line to drop."""
    hashed = hashed_lines(docs, id_col, text_col, min_chars).repartitionByRange("h1", "h2", "part")
    marked = hashed.withColumn("leader", _first_document("h1", "h2", "part"))
    leads = F.col("doc").eqNullSafe(F.col("leader"))
    heads = marked.where(leads).withColumn("leader", _first_document("h1", "h2"))
    columns = ("doc", "body", "n_lines", "pos")
    return marked.where(~leads).select(*columns).unionByName(heads.where(~leads).select(*columns))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """Sorted positions to drop -> the kept stretches (first, length), in order."""
    starts = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) < x - 1))
    ends = F.filter(dropped, lambda x, i: (i == F.size(dropped) - 1) | (F.get(dropped, i + 1) > x + 1))
    first = F.concat(F.array(F.lit(0)), F.transform(ends, lambda x: x + 1))
    after = F.concat(starts, F.array(n_lines))
    runs = F.zip_with(first, after, lambda a, b: F.struct(a.alias("first"), (b - a).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """(doc, body, n_dropped, keep) for every document that loses a line; the others keep all.

    `body` is the hash of the text the bitmap belongs to, `keep` the run-length compressed
    bitmap of the lines that stay.
    """
    lost = repeated_lines(docs, id_col, text_col, min_chars).groupBy("doc", "body").agg(
        F.sort_array(F.collect_set("pos")).alias("dropped"), F.max("n_lines").alias("n_lines")
    )
    return lost.select(
        "doc", "body", F.size("dropped").cast("long").alias("n_dropped"),
        keep_runs(F.col("dropped"), F.col("n_lines")).alias("keep"),
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    names: tuple[str, str, str] = ("kept_text", "n_lines", "n_dropped"),
) -> DataFrame:
    """`docs` with the kept text, the number of lines (before) and of those dropped appended under `names`.

    A column of docs that has one of these names gives way.
    """
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars).alias("bitmap")
    whole = docs.alias("docs")
    text, keep = F.col(f"docs.{text_col}"), F.col("bitmap.keep")
    joined = whole.join(
        bitmaps,
        F.col(f"docs.{id_col}").eqNullSafe(F.col("bitmap.doc")) & (F.xxhash64(text) == F.col("bitmap.body")),
        "left",
    )
    lines = split_lines(text)
    pieces = F.flatten(F.transform(keep, lambda r: F.slice(lines, r["first"] + 1, r["length"])))
    taken = {n.lower() for n in names}
    return joined.select(
        *[F.col(f"docs.`{c}`") for c in docs.columns if c.lower() not in taken],
        F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(pieces, "\n")).alias(names[0]),
        F.size(lines).cast("long").alias(names[1]),
        F.coalesce(F.col("bitmap.n_dropped"), F.lit(0)).alias(names[2]),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLES = {
    "op3_line_dedup": """
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS pos FROM cut
), keyed AS (
  SELECT *, translate(regexp_replace(l, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeats AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT keyed.*, r.k IS NOT NULL AND doc_id <> owner AS gone FROM keyed LEFT JOIN repeats r ON keyed.k = r.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
}
