"""Language of words and texts by a linear-chain conditional random field.

Words carry affix, character n-gram and lexicon features; transitions between the languages
of neighbouring words are learned with them. Forward-backward gives each word its label
probabilities, also in code-switched text; the mean over a text's words is its language
profile.

The field learns from text and lang of at most `FIT_DOCS` documents per language, chosen by
a hash of the id outside the held-out fifth. Training sequences are cut from whole texts at
random places, and half of them join two documents, so that switches occur. Prediction
reads the text alone, and all of it, in blocks linked exactly by their transfer matrices.

Defined results: `und` with score 0 for a null text or one without a letter; with no usable
training row every text is `und`; equal profiles go to the first language by name; repeated
rows get equal answers; an empty table gives no rows; columns beside id and text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchgrid.llm.common import table

UNKNOWN = "und"
FIT_DOCS = 300
SEGMENT, SEGMENTS = 48, 4
HASH_BITS = 16
LEXICON_WORDS = 4000
ROUNDS = 60
L2 = 2e-3
SEED = 7
CACHE_WORDS = 200_000
BLOCK = 64
#: Words in one forward-backward sweep.
SWEEP_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; numerals that are no letters do not make a word."""
    found = WORD.findall(text.lower()) if text else []
    return found if all(map(str.isalpha, found)) else [w for w in found if any(map(str.isalpha, w))]


def word_features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Feature numbers of a word: hashed affixes and n-grams, then its lexicon place."""
    from zlib import crc32

    mask, n = (1 << HASH_BITS) - 1, len(word)
    edged = f"<{word}>"
    names = {"b" + word[:k] for k in range(1, min(4, n) + 1)} | {"e" + word[-k:] for k in range(1, min(4, n) + 1)}
    names |= {edged[i:i + k] for k in (2, 3) for i in range(len(edged) - k + 1)}
    found = [crc32(x.encode("utf-8", "replace")) & mask for x in sorted(names)]
    place = lexicon.get(word)
    return found if place is None else [*found, (1 << HASH_BITS) + place]


def _chains(scores, transitions, lengths):
    """Label probabilities of each word, and the expected transitions, for short sequences."""
    import numpy as np

    k, n, longest = scores.shape[1], len(lengths), int(lengths.max())
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    mask = np.arange(longest)[None, :] < lengths[:, None]
    p = np.ones((n, longest, k))
    p[mask] = np.exp(scores - scores.max(axis=1, keepdims=True))
    t = np.exp(transitions)
    alpha, beta = np.zeros((n, longest, k)), np.ones((n, longest, k))
    before = np.full((n, k), 1.0 / k)
    for i in range(longest):
        a = (before @ t) * p[:, i]
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, i] = before = np.where(mask[:, i, None], a, before)
    for i in range(longest - 2, -1, -1):
        b = (beta[:, i + 1] * p[:, i + 1]) @ t.T
        beta[:, i] = np.where(mask[:, i + 1, None], b / b.sum(axis=1, keepdims=True), 1.0)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    pairs = np.zeros((k, k))
    for i in range(longest):
        left = alpha[:, i - 1] if i else np.full((n, k), 1.0 / k)
        joint = left[:, :, None] * t[None] * (p[:, i] * beta[:, i])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pairs += joint[mask[:, i]].sum(axis=0)
    return gamma[mask], pairs, at


def posteriors(scores, transitions, lengths):
    """Label probabilities of each word for texts of any length, laid end to end.

    Texts are cut into blocks; transfer matrices of whole blocks carry the messages from
    block to block, then all blocks are swept side by side. The result is exact.
    """
    import numpy as np

    k = scores.shape[1]
    per = -(-lengths // BLOCK)
    first = np.concatenate([[0], np.cumsum(per)])
    n = int(first[-1])
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    block, slot = first[text] + inside // BLOCK, inside % BLOCK
    p = np.ones((BLOCK, n, k))
    p[slot, block] = np.exp(scores - scores.max(axis=1, keepdims=True))
    real = np.zeros((BLOCK, n), bool)
    real[slot, block] = True
    t = np.exp(transitions - transitions.max())
    carry = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for i in range(BLOCK):
        step = (carry.reshape(-1, k) @ t).reshape(n, k, k) * p[i][:, None, :]
        step /= step.max(axis=(1, 2), keepdims=True)
        carry = np.where(real[i][:, None, None], step, carry)
    ahead, behind = np.full((n, k), 1.0 / k), np.ones((n, k))
    order = np.argsort(-per, kind="stable")
    for j in range(1, int(per.max())):
        own = first[order[: int((per > j).sum())]] + j
        moved = np.einsum("nk,nkl->nl", ahead[own - 1], carry[own - 1])
        ahead[own] = moved / moved.sum(axis=1, keepdims=True)
    for j in range(int(per.max()) - 2, -1, -1):
        own = first[order[: int((per > j + 1).sum())]] + j
        moved = np.einsum("nkl,nl->nk", carry[own + 1], behind[own + 1])
        behind[own] = moved / moved.sum(axis=1, keepdims=True)
    alpha = np.empty((BLOCK, n, k))
    for i in range(BLOCK):
        a = (ahead @ t) * p[i]
        ahead = np.where(real[i][:, None], a / a.sum(axis=1, keepdims=True), ahead)
        alpha[i] = ahead
    for i in range(BLOCK - 1, -1, -1):
        alpha[i] *= behind
        b = (behind * p[i]) @ t.T
        behind = np.where(real[i][:, None], b / b.sum(axis=1, keepdims=True), behind)
    found = alpha[slot, block]
    return found / found.sum(axis=1, keepdims=True)


def _sample(docs: DataFrame, fit_docs: int) -> DataFrame:
    """(lang, place, text) of the training documents."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    order = W.partitionBy("lang").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("place", F.row_number().over(order)).where(F.col("place") <= fit_docs)
    # Rows that repeat a doc_id are one document here, so the bound holds for rows too.
    chosen = chosen.groupBy(F.col("doc_id").alias("d"), F.col("lang").alias("l")).agg(F.min("place").alias("place"))
    met = usable.join(F.broadcast(chosen), (F.col("doc_id") == F.col("d")) & (F.col("lang") == F.col("l")))
    met = met.groupBy("d", "lang", "place").agg(F.min("text").alias("text"))
    return met.select("lang", "place", "text")


def _training_sequences(rows, langs):
    """Sequences of words with the label of each word."""
    import numpy as np

    rng = np.random.default_rng(SEED)
    cuts = []
    for lang, text in rows:
        words = words_of(text)
        for _ in range(SEGMENTS if len(words) > SEGMENT else 1 if words else 0):
            at = int(rng.integers(0, max(1, len(words) - SEGMENT)))
            cuts.append((langs.index(lang), words[at:at + SEGMENT]))
    order = rng.permutation(len(cuts)).tolist()
    done = []
    while order:
        parts = [cuts[order.pop()] for _ in range(min(len(order), 1 + len(done) % 2))]
        done.append(([w for _, ws in parts for w in ws], [y for y, ws in parts for _ in ws]))
    return done


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> dict:
    """Learn the field from `docs` (doc_id, text, lang); one task holds the bounded sample, the driver the model."""

    def learn(group):
        import pickle

        import pyarrow as pa

        group = group.sort_by([(c, "ascending") for c in ("lang", "place", "text")])
        rows = list(zip(group.column("lang").to_pylist(), group.column("text").to_pylist(), strict=True))
        return pa.table({"model": pa.array([pickle.dumps(learned(rows, rounds))], pa.binary())})

    import pickle

    found = _sample(docs, fit_docs).groupBy(F.lit(0).alias("all")).applyInArrow(learn, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else learned([], rounds)


def learned(rows: list[tuple[str, str]], rounds: int) -> dict:
    """The field of (lang, text) rows."""
    import numpy as np

    langs = sorted({lang for lang, _ in rows})
    sequences = _training_sequences(rows, langs)
    if not sequences:
        return {"langs": [], "lexicon": {}, "weights": None, "transitions": None}
    counts: dict[str, int] = {}
    for words, _ in sequences:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    frequent = sorted((w for w in counts if counts[w] > 2), key=lambda w: (-counts[w], w))[:LEXICON_WORDS]
    lexicon = {w: i for i, w in enumerate(frequent)}
    vocabulary = {w: i for i, w in enumerate(sorted(counts))}
    features = [word_features(w, lexicon) for w in vocabulary]
    flat = np.concatenate(features)
    starts = np.concatenate([[0], np.cumsum([len(f) for f in features])[:-1]])
    owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
    ids = np.array([vocabulary[w] for words, _ in sequences for w in words])
    y = np.array([v for _, ys in sequences for v in ys])
    lengths = np.array([len(words) for words, _ in sequences])
    k, size = len(langs), (1 << HASH_BITS) + len(lexicon)
    active, place = np.unique(flat, return_inverse=True)
    truth, observed = np.eye(k)[y], np.zeros((k, k))
    starts_of = np.cumsum(lengths) - lengths
    follows = np.ones(len(y), bool)
    follows[starts_of] = False
    np.add.at(observed, (y[np.flatnonzero(follows) - 1], y[follows]), 1.0)
    np.add.at(observed, (slice(None), y[starts_of]), 1.0 / k)
    w, trans = np.zeros((len(active), k)), np.zeros((k, k))
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (w, trans)]
    for step in range(1, rounds + 1):
        emission = np.add.reduceat(w[place], starts, axis=0)
        gamma, pairs, _ = _chains(emission[ids], trans, lengths)
        miss = gamma - truth
        per_word = np.stack([np.bincount(ids, miss[:, j], len(features)) for j in range(k)], axis=1)
        g_w = np.stack([np.bincount(place, per_word[owner, j], len(active)) for j in range(k)], axis=1)
        grads = (g_w / len(y) * 50 + L2 * w, (pairs - observed) / len(y) + L2 * trans)
        for x, g, (m, v) in zip((w, trans), grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    weights = np.zeros((size, k), "float32")
    weights[active] = w
    return {"langs": langs, "lexicon": lexicon, "weights": weights, "transitions": trans}


class Labeler:
    """Word labels of texts under a fitted field; emissions of words are cached, boundedly."""

    def __init__(self, model: dict):
        import numpy as np

        self.model, self.rows = model, {}
        self.emissions = np.zeros((0, len(model["langs"])), "float32")

    def _emissions_of(self, words: list[str]):
        import numpy as np

        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if len(self.rows) + len(new) > CACHE_WORDS:
            self.rows, self.emissions = {}, self.emissions[:0]
            new = list(dict.fromkeys(words))
        if new:
            features = [word_features(w, self.model["lexicon"]) for w in new]
            starts = np.concatenate([[0], np.cumsum([len(f) for f in features])[:-1]])
            own = np.add.reduceat(self.model["weights"][np.concatenate(features)], starts, axis=0)
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.emissions = np.concatenate([self.emissions, own])
        get = self.rows.__getitem__
        return self.emissions[np.fromiter(map(get, words), np.int64, len(words))]

    def _sweep(self, texts: list[list[str]]) -> list:
        import numpy as np

        lengths = np.array([len(t) for t in texts])
        scores = self._emissions_of([w for t in texts for w in t]).astype(float)
        found = posteriors(scores, self.model["transitions"], lengths)
        return np.split(found, np.cumsum(lengths)[:-1])

    def label(self, texts: list[str | None]) -> list:
        """(language, score, runs) of each text; runs are (language, words) in order."""
        import numpy as np

        langs = self.model["langs"]
        out: list = [(UNKNOWN, 0.0, [])] * len(texts)
        waiting, size = [], 0

        def flush():
            for (i, _), p in zip(waiting, self._sweep([w for _, w in waiting]), strict=True):
                mean = p.mean(axis=0)
                best = p.argmax(axis=1)
                ends = np.concatenate([np.flatnonzero(np.diff(best)) + 1, [len(best)]])
                runs = zip(best[ends - 1].tolist(), np.diff(ends, prepend=0).tolist(), strict=True)
                top = int(mean.argmax())
                out[i] = langs[top], min(1.0, float(mean[top])), [{"lang": langs[j], "words": c} for j, c in runs]

        for i, text in enumerate(texts):
            words = words_of(text) if langs else []
            if words:
                waiting.append((i, words))
                size += len(words)
            if size >= SWEEP_WORDS:
                flush()
                waiting, size = [], 0
        if waiting:
            flush()
        return out


def identify(model: dict, spark: SparkSession):
    """A column function: text -> struct(lang_pred, score, runs)."""
    import pandas as pd

    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        labeler = Labeler(shared.value)
        for texts in batches:
            found = labeler.label([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame(found, columns=["lang_pred", "score", "runs"])

    from collections.abc import Iterator

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang_pred string, score double, runs array<struct<lang: string, words: long>>")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    label = identify(fit(docs), spark)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), label("text").alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


QUERIES = {"op2_language_id": op2_language_id}
ORACLES: dict[str, str] = {}
