"""The corpus pipeline: five stages over `documents`, each calling one training-data operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and reread as the next stage's docs. All but the last return the columns of
documents. Each stage judges whatever its predecessor kept, and its decisions take effect.

Defined results, beside those of the operators: a document without a letter, or whose best
language explains less than `LEAST_LANGUAGE` of its words, goes; line deduplication changes
texts (and n_chars) but drops no document; of a class of near copies the smallest doc_id
stays; a document holding a benchmark item goes; rows with a null doc_id pass the stages that
compare ids; rows repeating a doc_id share its fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchgrid.llm import bandjoin, decontaminate, langid, linededup, pieces
from touchgrid.llm.common import shared_folder, table

LEAST_LANGUAGE = 0.3
#: Characters of a chunk of the last stage.
STAGED_CHARS = 4 << 20


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` less the ids of `gone`; every column of docs as it was."""
    gone = gone.select(F.col("doc_id").alias("gone_id")).where("gone_id IS NOT NULL").distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    label = langid.identify(langid.fit(docs.select("doc_id", "text", "lang")), spark)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(*columns, label("text").alias("language found here"))
    found = F.col("`language found here`")
    kept = (found["lang_pred"] != langid.UNKNOWN) & (found["score"] >= LEAST_LANGUAGE)
    return marked.where(kept).select(*columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Names that no column has, so that none of docs gives way.
    done = linededup.dedup_lines(docs, names=("kept text found here", "lines found here", "lines dropped here"))
    changed = {"text": F.when(F.col("text").isNotNull(), F.col("`kept text found here`"))}
    changed["n_chars"] = F.char_length(changed["text"]).cast("long")
    return done.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, bandjoin.similar_documents(docs.select("doc_id", "text")).where("doc_id <> class_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return _without(docs, decontaminate.contaminated(docs.select("doc_id", "text"), items))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The pipeline has disk to spare rather than memory.
    return pieces.encoded_and_decoded(docs.select("doc_id", "text"), pieces.PieceTable.load(), STAGED_CHARS, staged=True)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", piece_encoding),
]

#: The first and the last stage are beyond SQL; tests hold each stage against a brute-force form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
