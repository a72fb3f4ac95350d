"""Benchmark decontamination: a BM25 index of the test items, asked by every training passage.

The inverted index holds the test items, in blocks of a bounded number of postings; a block
travels to the tasks as a broadcast, and the corpus is read once for each. Documents are cut
into overlapping passages, long enough that any item lies whole in one. Block-max WAND finds
all items whose BM25 score, as a share of the score of the item's own text, reaches
`LEAST_SHARE`; retrieved items are kept if the passage also holds enough of the n-grams of
both their question and their answer.

Skipping is exact: a passage is left out only if, in every block of items, the block maxima
of its distinct terms add up to less than the threshold. That is decided for many passages at
once; the lists are opened for the others only.

Defined results: words are lower-cased runs of letters and digits, so that punctuation hides
nothing; a null text or one without words matches nothing, as item and as document;
the last sentence of an item is its answer, and an item of one sentence has a question only;
an item part shorter than n words is one gram; equal items each get their own row; repeated
documents get a row each; null ids are carried; empty tables give no rows.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchgrid.llm.common import letter_words, table

K1, B = 1.2, 0.75
LEAST_SHARE = 0.6
NGRAM = 5
LEAST_QUESTION, LEAST_ANSWER = 0.6, 0.6
#: Postings that are broadcast at a time, and those of one index among them.
BLOCK_POSTINGS, INDEX_POSTINGS = 400_000, 20_000
#: Postings under one block maximum.
SKIP = 16
#: Items under one bound when whole passages are ruled out, and passages weighed at a time.
ITEM_BLOCK, WEIGHED = 4, 1500
MATCHES = "item_id long, bm25_share double, question_overlap double, answer_overlap double"


def indexed_terms(items: DataFrame) -> DataFrame:
    """(item_id, row, term, share) of items (item_id, text): a term's part of the item's own BM25 score."""
    words = items.select("item_id", F.xxhash64("item_id", "text").alias("row"), letter_words(F.col("text")).alias("ws"))
    words = words.where(F.size("ws") > 0).dropDuplicates(["item_id", "row"])
    terms = words.select("item_id", "row", F.size("ws").alias("dl"), F.explode("ws").alias("w"))
    terms = terms.groupBy("item_id", "row", "dl", F.xxhash64("w").alias("term")).agg(F.count("*").alias("tf"))
    whole = words.agg(F.count("*").alias("n"), F.avg(F.size("ws")).alias("avg_dl")).first()
    n, avg_dl = whole["n"], whole["avg_dl"] or 1.0
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    rated = terms.join(df, "term").withColumn(
        "impact",
        F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (K1 + 1)
        / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(avg_dl))),
    )
    own = rated.groupBy("item_id", "row").agg(F.sum("impact").alias("own")).withColumnRenamed("item_id", "i")
    return rated.join(own.withColumnRenamed("row", "r"), F.col("item_id").eqNullSafe(F.col("i")) & (F.col("row") == F.col("r"))).select(
        "item_id", "row", "term", (F.col("impact") / F.col("own")).alias("share")
    )


def question_and_answer(items: DataFrame) -> DataFrame:
    """(item_id, row, question, answer) as arrays of word hashes; the last sentence is the answer."""
    text = F.trim(F.coalesce("text", F.lit("")))
    cut = items.select(
        "item_id", F.xxhash64("item_id", "text").alias("row"), text.alias("text"),
        F.regexp_extract(text, r"(?s)^(.*[.!?\n])\s*(\S.*)$", 1).alias("question"),
    )
    question = F.when(F.col("question") == "", F.col("text")).otherwise(F.col("question"))
    answer = F.when(F.col("question") == "", F.lit("")).otherwise(
        F.substring("text", F.char_length("question") + 1, F.char_length("text"))
    )

    def hashed(c):
        return F.transform(letter_words(c), lambda w: F.xxhash64(w))

    return cut.select("item_id", "row", hashed(question).alias("question"), hashed(answer).alias("answer")).dropDuplicates(["item_id", "row"])


def grams_of(words, n: int = NGRAM) -> set[tuple]:
    """The distinct n-grams of a word sequence; a shorter one is a single gram."""
    words = list(words)
    return {tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, min(1, len(words))))}


class Index:
    """Postings of one index block with block maxima, and the items' n-grams."""

    def __init__(self, terms, items):
        """terms: (item number, term, share) rows; items: (item_id, question, answer) by number."""
        import numpy as np

        self.items = [(i, list(q), list(a)) for i, q, a in items]
        self.longest = max((len(q) + len(a) for _, q, a in self.items), default=1)
        terms = sorted((t, i, s) for i, t, s in terms)
        self.terms = np.array(sorted({t for t, _, _ in terms}), np.int64)
        place = {t: j for j, t in enumerate(self.terms.tolist())}
        self.docs: list[list[int]] = [[] for _ in place]
        self.shares: list[list[float]] = [[] for _ in place]
        for t, i, s in terms:
            self.docs[place[t]].append(i)
            self.shares[place[t]].append(s)
        self.skips = [[max(s[j:j + SKIP]) for j in range(0, len(s), SKIP)] for s in self.shares]
        self.most = np.array([max(s) for s in self.shares] or [], float)
        self.grams = [(grams_of(q), grams_of(a)) for _, q, a in self.items]
        # Greatest share of each term in each block of ITEM_BLOCK items.
        self.block_most = np.zeros((len(self.terms), -(-len(self.items) // ITEM_BLOCK)), np.float32)
        for t, (docs, shares) in enumerate(zip(self.docs, self.shares, strict=True)):
            np.maximum.at(self.block_most[t], np.array(docs) // ITEM_BLOCK, np.array(shares, np.float32))

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """Block-max WAND: every (item number, share) of at least `least` for distinct query terms."""
        docs, shares, skips, most = self.docs, self.shares, self.skips, self.most
        least -= 1e-9
        cursors = [[docs[t][0], 0, t] for t in terms]
        found = []
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for j, c in enumerate(cursors):
                total += most[c[2]]
                if total >= least:
                    pivot = j
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            ready = cursors[:pivot + 1]
            bound, reach = 0.0, None
            for c in ready:
                at = bisect_left(docs[c[2]], item, c[1])
                if at < len(docs[c[2]]):
                    bound += skips[c[2]][at // SKIP]
                    last = docs[c[2]][min((at // SKIP + 1) * SKIP, len(docs[c[2]])) - 1]
                    reach = last if reach is None else min(reach, last)
            if bound < least:
                # No item up to the first block end can reach the threshold with these lists.
                beyond = max(item, reach if reach is not None else item) + 1
                if pivot + 1 < len(cursors):
                    beyond = min(beyond, max(cursors[pivot + 1][0], item + 1))
            else:
                if ready[0][0] == item:
                    score = sum(shares[c[2]][c[1]] for c in ready)
                    if score >= least:
                        found.append((item, float(score)))
                    beyond = item + 1
                else:
                    beyond = item
            for c in ready:
                c[1] = bisect_left(docs[c[2]], beyond, c[1])
                c[0] = docs[c[2]][c[1]] if c[1] < len(docs[c[2]]) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def matches(self, values, lengths, least: float, least_q: float, least_a: float) -> list[list[tuple]]:
        """For each document the verified (item_id, share, question overlap, answer overlap)."""
        import numpy as np

        out: list[list[tuple]] = [[] for _ in lengths]
        if not len(self.terms) or not len(values):
            return out
        place = np.minimum(np.searchsorted(self.terms, values), len(self.terms) - 1)
        hit = self.terms[place] == values
        step = self.longest
        first = np.cumsum(lengths) - lengths
        count = np.where(lengths > 0, np.maximum(1, -(-(lengths - step) // step)), 0)
        doc = np.repeat(np.arange(len(lengths)), count)
        start = first[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * step
        stop = np.minimum(start + 2 * step, (first + lengths)[doc])
        for at in range(0, len(doc), WEIGHED):
            for p, terms in self._live(place, hit, start[at:at + WEIGHED], stop[at:at + WEIGHED], least):
                self._verify(out[int(doc[at + p])], values[start[at + p]:stop[at + p]].tolist(), terms, least, least_q, least_a)
        return [self._best(found) for found in out]

    def _live(self, place, hit, start, stop, least: float):
        """(passage, its distinct terms) for passages that some block of items leaves in play."""
        import numpy as np

        size = stop - start
        passage = np.repeat(np.arange(len(start)), size)
        at = np.arange(len(passage)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
        known = hit[at]
        pairs = np.unique(passage[known] * len(self.terms) + place[at[known]])
        passage, term = np.divmod(pairs, len(self.terms))
        if not len(pairs):
            return
        begins = np.flatnonzero(np.diff(passage, prepend=-1))
        bound = np.add.reduceat(self.block_most[term], begins, axis=0).max(axis=1)
        ends = np.append(begins[1:], len(pairs))
        for i in np.flatnonzero(bound >= least - 1e-4).tolist():
            yield int(passage[begins[i]]), term[begins[i]:ends[i]].tolist()

    def _verify(self, out: list, words: list, terms: list[int], least: float, least_q: float, least_a: float) -> None:
        grams: dict[int, set] = {}
        for item, share in self.search(terms, least):
            q, a = (self._overlap(g, words, grams) for g in self.grams[item])
            if q >= least_q and a >= least_a:
                out.append((self.items[item][0], share, q, a))

    @staticmethod
    def _overlap(wanted: set, words: list, grams: dict[int, set]) -> float:
        if not wanted:
            return 1.0
        n = len(next(iter(wanted)))
        if n not in grams:
            grams[n] = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}
        return len(wanted & grams[n]) / len(wanted)

    @staticmethod
    def _best(found: list[tuple]) -> list[tuple]:
        best: dict = {}
        for f in found:
            if f[0] not in best or f[1:] > best[f[0]][1:]:
                best[f[0]] = f
        return [best[i] for i in sorted(best, key=lambda i: (i is None, i))]


def _ask(docs: DataFrame, indexes: list[Index], least: float, least_q: float, least_a: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(indexes)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            words = batch.column("words")
            values, lengths = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(words.offsets.to_numpy())
            rows = [
                (i, *m) for index in shared.value
                for i, ms in enumerate(index.matches(values, lengths, least, least_q, least_a)) for m in ms
            ]
            ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
            columns = [pa.array([r[j] for r in rows], pa.int64() if j == 1 else pa.float64()) for j in range(1, 5)]
            yield pa.RecordBatch.from_arrays(
                [ids, *columns], ["doc_id", "item_id", "bm25_share", "question_overlap", "answer_overlap"]
            )

    hashed = docs.select("doc_id", F.transform(letter_words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))
    return hashed.mapInArrow(run, f"doc_id {kind}, {MATCHES}")


def _indexes(terms: list[tuple], rows: dict) -> list[Index]:
    """Indexes of about INDEX_POSTINGS each over (item_id, row, term, share) and the items' words."""
    per_item: dict = {}
    for i, r, t, share in terms:
        per_item.setdefault((i, r), []).append((t, share))
    done, keys, size = [], [], 0
    order = sorted(per_item, key=lambda k: (k[0] is None, k))
    for k in order:
        keys.append(k)
        size += len(per_item[k])
        if size >= INDEX_POSTINGS or k == order[-1]:
            done.append(Index(
                [(n, t, share) for n, key in enumerate(keys) for t, share in per_item[key]],
                [(key[0], rows[key]["question"], rows[key]["answer"]) for key in keys],
            ))
            keys, size = [], 0
    return done


def contaminated(
    docs: DataFrame, items: DataFrame, least: float = LEAST_SHARE, least_question: float = LEAST_QUESTION,
    least_answer: float = LEAST_ANSWER, block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """(doc_id, item_id, bm25_share, question_overlap, answer_overlap) of verified leaks.

    docs (doc_id, text), items (item_id, text).
    """
    spark = docs.sparkSession
    terms, parts = indexed_terms(items).persist(), question_and_answer(items)
    blocks = max(1, -(-terms.count() // block_postings))
    block = F.pmod(F.xxhash64("item_id", "row"), F.lit(blocks))
    found = None
    for b in range(blocks):
        own = [tuple(r) for r in terms.where(block == b).select("item_id", "row", "term", "share").toLocalIterator()]
        if not own:
            continue
        rows = {(r["item_id"], r["row"]): r for r in parts.where(block == b).toLocalIterator()}
        part = _ask(docs, _indexes(own, rows), least, least_question, least_answer)
        found = part if found is None else found.unionByName(part)
    terms.unpersist()
    if found is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {kind}, {MATCHES}")
    return found


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES = {"op9_decontaminate": op9_decontaminate}
ORACLES: dict[str, str] = {}
