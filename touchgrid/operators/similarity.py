"""Near-duplicate text families: shingles, MinHash bands, verified links, components.

Families are connected components over verified pairs. Listing every pair of a large
group of near copies would be quadratic, so links are found in two passes:

1. Every text is compared with one representative per band bucket, or in a small bucket with
   all others. This is linear and already joins the big groups of near copies.
2. Only pairs whose texts still sit in different components are compared, and for each
   key the texts of its dominant component meet only the others. Buckets that stay
   large are narrowed by the rare-shingle prefix rule, which cannot lose a pair that
   reaches the threshold.

The result equals the components of the full verified pair set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import md5
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchgrid import vocab
from touchgrid.functions.text import words
from touchgrid.operators.components import connected_components
from touchgrid.session import Scratch, stored

SHORT_WORDS = 25


def _windows(text: Column | str, k: int, finish) -> Column:
    """finish(window) for every k-word window.

    The word array is bound once as a lambda variable and read by position, so a long
    text costs one split and one step per word.
    """

    def of(ws: Column) -> Column:
        last = F.greatest(F.size(ws) - k, F.lit(0))
        each = F.transform(F.sequence(F.lit(0), last), lambda i: finish(*[F.get(ws, i + j) for j in range(k)]))
        return F.array_distinct(F.when(F.size(ws) > 0, each).otherwise(F.slice(each, 1, 0)))

    return F.transform(F.array(words(text)), of)[0]


def shingles(text: Column | str, k: int = vocab.DEFAULT_SHINGLE_WORDS) -> Column:
    """Distinct k-word windows; a shorter text is one window, an empty one has none."""
    return _windows(text, k, lambda *w: F.concat_ws(" ", *w))


def hashed_shingles(text: Column | str, k: int = vocab.DEFAULT_SHINGLE_WORDS) -> Column:
    return _windows(text, k, F.xxhash64)


def jaccard(a: Column, b: Column) -> Column:
    """|a n b| / |a u b|; two empty sets are equal, one empty set shares nothing."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def portable_shingles(text: Column | str, k: int = vocab.DEFAULT_SHINGLE_WORDS) -> Column:
    """Distinct k-word windows as 60-bit numbers that any SQL engine can compute: the head of their md5."""
    def head(*w: Column) -> Column:
        return F.conv(F.substring(F.md5(F.concat_ws(" ", *w)), 1, 15), 16, 10).cast("bigint")

    return _windows(text, k, head)


def minhash_coefficients(permutations: int = vocab.MINHASH_PERMUTATIONS) -> list[tuple[int, int]]:
    """(a, b) of each permutation x -> (a x + b) mod p: powers of two generators modulo p."""
    p = vocab.MINHASH_PRIME
    return [(pow(48271, i + 1, p), pow(69621, i + 1, p)) for i in range(permutations)]


def _least_permuted(permutations: int):
    """Smallest permuted hash per permutation, as a function of an array of hashes."""
    p, pairs = vocab.MINHASH_PRIME, minhash_coefficients(permutations)
    by, plus = (np.array(part, dtype=np.int64)[:, None] for part in zip(*pairs))

    def of(own: np.ndarray) -> np.ndarray:
        # Both factors are below 2^31, so nothing overflows.
        least = [(np.asarray(part, dtype=np.int64) % p * by + plus) % p for part in np.split(own, range(4096, len(own), 4096))]
        return np.min([part.min(axis=1) for part in least], axis=0) if len(own) else np.zeros(permutations, dtype=np.int64)

    return of


def minhash(hashes: Column, permutations: int = vocab.MINHASH_PERMUTATIONS) -> Column:
    """Smallest permuted hash per permutation; an empty set gives zeros.

    Pass sets that are stored: the helper cannot stand right above the aggregate of unique_texts.
    """
    of = _least_permuted(permutations)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def signature(sets: pd.Series) -> pd.Series:
        return sets.map(of)

    return signature(hashes)


def close_keys(sets: DataFrame, keys: int = vocab.MINHASH_BANDS) -> DataFrame:
    """(text_key, key): neighbours among a text's smallest shingle hashes; near copies share some.

    Only the exact mode may use them: it needs early links, whichever they are, and no signatures.
    """
    least = F.slice(F.sort_array("score"), 1, keys + 1)
    pairs = F.transform(F.array(least), lambda s: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(s) - 2, F.lit(0))), lambda i: F.xxhash64(F.get(s, i), F.get(s, i + 1))
    ))[0]
    return sets.select("text_key", F.explode(pairs).alias("key"))


def band_keys(
    sets: DataFrame, permutations: int = vocab.MINHASH_PERMUTATIONS, bands: int = vocab.MINHASH_BANDS
) -> DataFrame:
    """(text_key, key): one row per text and band, as any SQL engine can compute it; equal keys make a candidate pair."""
    rows = permutations // bands
    signed = sets.select("text_key", minhash(F.col("block")).alias("sig"))
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.md5(F.concat_ws(",", b.cast("string"), F.slice("sig", b * rows + 1, rows).cast("array<string>"))),
    )
    return signed.select("text_key", F.explode(keys).alias("key"))


def band_members(
    unique: DataFrame, k: int = vocab.DEFAULT_SHINGLE_WORDS, permutations: int = vocab.MINHASH_PERMUTATIONS, bands: int = vocab.MINHASH_BANDS
) -> DataFrame:
    """(text_key, key): as band_keys, straight from the texts and with 64-bit keys; no set of windows is written."""
    of = _least_permuted(permutations)

    def heads(ws: list[str]) -> np.ndarray:
        own = {" ".join(ws[i:i + k]) for i in range(max(len(ws) - k + 1, 1))} if ws else ()
        digests = b"".join(md5(w.encode("utf-8", "surrogatepass")).digest() for w in own)
        return (np.frombuffer(digests, dtype=">u8")[::2] >> np.uint64(4)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = [of(heads((x.as_py() or "").split())) for x in batch.column(1)]
            if not signed:
                continue
            parts = np.array(signed).astype(np.uint64).reshape(len(signed), bands, -1)
            keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
            for i in range(parts.shape[2]):
                keys = _mixed(keys * np.uint64(WINDOW_BASE) + parts[:, :, i])
            yield pa.RecordBatch.from_arrays([
                pc.take(batch.column(0), pa.array(np.repeat(np.arange(len(signed)), bands))), pa.array(keys.reshape(-1).view(np.int64)),
            ], ["text_key", "key"])

    return unique.select("text_key", "text").mapInArrow(run, "text_key string, key long")


def unique_texts(corpus: DataFrame, text: str = "core_norm") -> DataFrame:
    """(text_key, text, copies): exact duplicates folded before anything is compared."""
    key = F.col("text_key") if "text_key" in corpus.columns else F.md5(F.col(text))
    return (
        corpus.groupBy(key.alias("text_key"))
        .agg(F.any_value(text).alias("text"), F.count(F.lit(1)).alias("copies"))
    )


#: Bytes of text hashed at once, and shingles dealt out at once or met in one bucket.
TEXT_BYTES, BUCKET_SHINGLES = 1 << 20, 1 << 20
WINDOW_BASE = 0xD6E8FEB86659FD93


def _mixed(x: np.ndarray) -> np.ndarray:
    """One-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, dtype=np.uint64)
    x[0] = 1
    return np.cumprod(x, dtype=np.uint64)


def window_sets(parts: list[list[str]], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's k-word windows; a shorter text is one window.

    A window's hash is a polynomial in its bytes, so the running sum over all texts gives each by one difference.
    """
    m = np.array([len(w) for w in parts if w], dtype=np.int64)
    if not len(m):
        return [np.zeros(0, dtype=np.uint64)] * len(parts)
    raw = np.frombuffer(" ".join(" ".join(w) for w in parts if w).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    stop = np.append(np.flatnonzero(raw == 32), len(raw))
    start = np.append(0, stop[:-1] + 1)
    of_byte = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    run = np.append(np.uint64(0), np.cumsum(of_byte[raw] * _powers(WINDOW_BASE, len(raw)), dtype=np.uint64))
    windows = np.maximum(m - k + 1, 1)
    place = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    first = np.repeat(np.cumsum(m) - m, windows) + place
    a, b = start[first], stop[first + np.repeat(np.minimum(m, k), windows) - 1]
    hashes = _mixed((run[b] - run[a]) * _powers(pow(WINDOW_BASE, -1, 1 << 64), len(raw))[a])
    found = iter(np.split(hashes, np.cumsum(windows)[:-1]))
    return [np.unique(next(found)) if w else np.zeros(0, dtype=np.uint64) for w in parts]


def _hash_texts(k: int):
    """(text_key, tokens, n, n_words) of texts: all hashes of a text as one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts, size = [], [], 0
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                keys.append(batch.column(0)[i])
                parts.append(text.split())
                size += len(text)
                if size >= TEXT_BYTES or i + 1 == batch.num_rows:
                    sets = window_sets(parts, k)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x.as_py() for x in keys], pa.string()), pa.array([x.tobytes() for x in sets], pa.binary()),
                        pa.array([len(x) for x in sets], pa.int32()), pa.array([len(w) for w in parts], pa.int32()),
                    ], ["text_key", "tokens", "n", "n_words"])
                    keys, parts, size = [], [], 0

    return run


def _deal(buckets: int):
    """(bucket, tids, tokens): the hashes of many texts, packed by ranges of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tid, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            done = 0
            while done < len(n):
                rows = max(1, int(np.searchsorted(np.cumsum(n[done:], dtype=np.int64), BUCKET_SHINGLES, "right")))
                tokens = np.frombuffer(b"".join(batch.column(1).slice(done, rows).to_pylist()), dtype=np.uint64)
                owner = np.repeat(tid[done:done + rows], n[done:done + rows])
                bucket = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)
                order = np.argsort(bucket, kind="stable")
                count = np.bincount(bucket, minlength=buckets)
                ends = np.cumsum(count)
                tokens, owner, used = tokens[order], owner[order], np.flatnonzero(count)
                cut = [slice(ends[b] - count[b], ends[b]) for b in used]
                yield pa.RecordBatch.from_arrays([
                    pa.array(used, pa.int32()), pa.array([owner[c].tobytes() for c in cut], pa.binary()),
                    pa.array([tokens[c].tobytes() for c in cut], pa.binary()),
                ], ["bucket", "tids", "tokens"])
                done += rows

    return run


def _met_in_bucket(parts: int):
    """(part, tids, tokens, dfs): the hashes of a bucket that more than one text has, packed by text."""

    def run(table: pa.Table) -> pa.Table:
        tid, token = (np.frombuffer(b"".join(table[c].to_pylist()), dtype=np.int64) for c in ("tids", "tokens"))
        order = np.argsort(token)
        token, tid = token[order], tid[order]
        head = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        df = np.diff(np.append(head, len(token)))
        df = np.repeat(df, df)
        kept = np.flatnonzero(df > 1)
        part = (_mixed(tid[kept].view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        kept = kept[np.argsort(part, kind="stable")]
        count = np.bincount(part, minlength=parts)
        ends, used = np.cumsum(count), np.flatnonzero(count)
        cut = [kept[ends[p] - count[p]:ends[p]] for p in used]
        packed = {to: pa.array([x[c].tobytes() for c in cut], pa.binary()) for to, x in (("tids", tid), ("tokens", token), ("dfs", df))}
        return pa.table({"part": pa.array(used, pa.int32())} | packed)

    return run


def _by_rarity(table: pa.Table) -> pa.Table:
    """(tid, score): the hashes of each text in the order of (number of texts, hash)."""
    tid, token, df = (np.frombuffer(b"".join(table[c].to_pylist()), dtype=np.int64) for c in ("tids", "tokens", "dfs"))
    order = np.lexsort((token, df, tid))
    tid, token = tid[order], token[order]
    head = np.flatnonzero(np.append(True, tid[1:] != tid[:-1]))
    score = pa.LargeListArray.from_arrays(np.append(head, len(tid)), token).cast(pa.list_(pa.int64()))
    return pa.table({"tid": tid[head], "score": score})


def shared_sets(unique: DataFrame, k: int) -> DataFrame:
    """(text_key, score, n, n_words), stored: all that the exact mode reads.

    score holds the k-word windows that other texts have too, rarest first; n counts all windows. A window
    of one text only meets nothing, so two texts share the same windows and are as similar as by whole sets.

    Windows travel as packed 64-bit hashes in buckets of the hash, whose number grows with the corpus;
    a bucket holds about BUCKET_SHINGLES of them, and what its commonest windows add (one number a text).
    """
    scratch = Scratch(unique.sparkSession, "sets")
    hashed = unique.select("text_key", "text").mapInArrow(
        _hash_texts(k), "text_key string, tokens binary, n int, n_words int"
    )
    whole = scratch.write(hashed.withColumn("tid", F.monotonically_increasing_id()))
    buckets = max(1, ceil((whole.agg(F.sum("n")).first()[0] or 0) / BUCKET_SHINGLES))
    met = (
        whole.where("n > 0").select("tid", "tokens", "n")
        .mapInArrow(_deal(buckets), "bucket int, tids binary, tokens binary")
        .groupBy("bucket").applyInArrow(_met_in_bucket(max(1, buckets // 8)), "part int, tids binary, tokens binary, dfs binary")
    )
    ranked = met.groupBy("part").applyInArrow(_by_rarity, "tid long, score array<bigint>")
    score = F.coalesce("score", F.array().cast("array<bigint>")).alias("score")
    sets = scratch.write(whole.drop("tokens").join(ranked, "tid", "left").select("text_key", score, "n", "n_words"))
    scratch.drop(whole)
    return sets


def text_sets(unique: DataFrame, k: int) -> DataFrame:
    """Blocking set (4-word windows), scoring set (k-word windows) and word count."""
    block = portable_shingles("text", vocab.DEFAULT_SHINGLE_WORDS)
    score = F.col("block") if k == vocab.DEFAULT_SHINGLE_WORDS else hashed_shingles("text", k)
    return unique.withColumn("block", block).select(
        "text_key", "block", score.alias("score"), F.size(score).alias("n"), F.size(words("text")).alias("n_words")
    )


def pair_threshold(threshold: float, length_aware: bool, a: Column, b: Column) -> Column:
    """Short texts may match at a slightly lower similarity."""
    if not length_aware:
        return F.lit(threshold)
    eased = max(0.3, threshold - 0.1)
    return F.when(F.least(a, b) < SHORT_WORDS, F.lit(eased)).otherwise(F.lit(threshold))


def verify(pairs: DataFrame, sets: DataFrame, threshold: float, length_aware: bool = False) -> DataFrame:
    """Pairs (a, b) whose similarity reaches the threshold, with the similarity."""
    def side(to: str) -> DataFrame:
        return sets.select(*[F.col(c).alias(x) for c, x in (("text_key", to), ("score", f"s{to}"), ("n", f"n{to}"), ("n_words", f"w{to}"))])

    common = F.size(F.array_intersect("sa", "sb"))
    union = F.col("na") + F.col("nb") - common
    sim = F.when(union == 0, F.lit(1.0)).otherwise(common / union)
    scored = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("sim", sim)
    limit = pair_threshold(threshold, length_aware, F.col("wa"), F.col("wb"))
    return scored.where(F.col("sim") >= limit).select("a", "b", "sim")


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def star_pairs(members: DataFrame) -> DataFrame:
    """Each text with the smallest text of every bucket it is in."""
    heads = members.groupBy("key").agg(F.min("text_key").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        members.join(heads, "key").where("text_key <> head").select(*_ordered(F.col("text_key"), F.col("head"))).distinct()
    )


def cross_pairs(members: DataFrame, least_ratio: float | Column) -> DataFrame:
    """Distinct pairs that share a key but not a component.

    members: key..., text_key, comp, size; least_ratio: a number or one of the keys. Texts of a key's dominant component are
    compared only with texts outside it; sizes too far apart to reach the threshold
    are skipped. With a column `rest` (a text's shingles from this key on, in one order for all
    texts) keys that the two texts' shared shingles cannot begin with are skipped too.
    """
    keys = [c for c in members.columns if c not in ("text_key", "comp", "size", "rest")]
    if "rest" not in members.columns:
        members = members.withColumn("rest", F.col("size"))
    parts = members.groupBy(*keys, "comp").agg(F.count(F.lit(1)).alias("m"))
    mixed = parts.groupBy(*keys).agg(F.max_by("comp", "m").alias("main"), F.count(F.lit(1)).alias("c")).where("c > 1")
    mixed = mixed.drop("c")
    live = members.join(mixed, keys)
    x = live.where("comp <> main").select(
        *keys, F.col("text_key").alias("xa"), F.col("comp").alias("xc"), F.col("size").alias("xs"),
        F.col("rest").alias("xr"),
    )
    y = live.select(*keys, F.col("text_key").alias("yb"), F.col("comp").alias("yc"), F.col("size").alias("ys"), F.col("rest").alias("yr"))
    # Sizes are whole numbers, so the slack only undoes the rounding of the product.
    near = F.least("xs", "ys") + F.lit(1e-6) >= F.greatest("xs", "ys") * F.lit(least_ratio)
    enough = F.least("xr", "yr") + F.lit(1e-6) >= (F.col("xs") + F.col("ys")) * F.lit(least_ratio / (1 + least_ratio))
    return x.join(y, keys).where((F.col("xc") != F.col("yc")) & near & enough).select(*_ordered(F.col("xa"), F.col("yb"))).distinct()


def _set_rows(ks: Sequence[int]):
    """(text_key, k, tokens): the hashes of a text's k-word windows, for each k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ws = (batch.column(1)[i].as_py() or "").split()
                found = [window_sets([ws], k)[0].view(np.int64) for k in ks]
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column(0)[i].as_py()] * len(ks), pa.string()), pa.array(ks, pa.int32()), pa.array(found, pa.list_(pa.int64())),
                ], ["text_key", "k", "tokens"])

    return run


def prefix_tokens(texts: DataFrame, cells: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(cell, text_key, token, size, rest): the rarest shingles of a text; two texts that reach a cell's `least` share one.

    A set of n shingles can lose at most n - ceil(least * n) of them to the other text,
    so its n - ceil(least * n) + 1 rarest shingles are enough to meet. cells: cell, k, least.
    """
    n, least = F.col("size"), F.col("least")
    sets = texts.select("text_key", "text").mapInArrow(_set_rows(ks), "text_key string, k int, tokens array<bigint>")
    tokens = sets.select("text_key", "k", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    # Shingles of one text only come first and meet nothing: their number is all that counts.
    df = tokens.groupBy("k", "token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = (
        tokens.join(df, ["k", "token"])
        .groupBy("text_key", "k", "size")
        .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    )
    keep = n - F.ceil(n * least - F.lit(1e-9)).cast("int") + 1
    left = F.greatest(F.least(keep, n) - (n - F.size("t")), F.lit(0))
    return ranked.join(F.broadcast(cells), "k").select(
        "cell", "text_key", "size", F.size("t").alias("m"), F.posexplode(F.slice("t", F.lit(1), left)).alias("i", "x")
    ).select("cell", "text_key", "size", F.col("x.token").alias("token"), (F.col("m") - F.col("i")).alias("rest"))


def _similar(ks: Sequence[int]):
    """(a, b, k, sim, words) of pairs of texts: similarity by k-word windows, words of the shorter text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, size = [], [], 0
            for i in range(batch.num_rows):
                both = [batch.column(c)[i].as_py() or "" for c in (2, 3)]
                rows.append(i)
                parts += [t.split() for t in both]
                size += sum(map(len, both))
                if size >= TEXT_BYTES or i + 1 == batch.num_rows:
                    words = [min(len(x), len(y)) for x, y in zip(parts[::2], parts[1::2], strict=True)]
                    for k in ks:
                        sets = window_sets(parts, k)
                        sims = []
                        for x, y in zip(sets[::2], sets[1::2], strict=True):
                            common = len(np.intersect1d(x, y, assume_unique=True))
                            union = len(x) + len(y) - common
                            sims.append(common / union if union else 1.0)
                        yield pa.RecordBatch.from_arrays([
                            pc.take(batch.column(0), pa.array(rows)), pc.take(batch.column(1), pa.array(rows)),
                            pa.array([k] * len(rows), pa.int32()), pa.array(sims, pa.float64()), pa.array(words, pa.int32()),
                        ], ["a", "b", "k", "sim", "words"])
                    rows, parts, size = [], [], 0

    return run


#: Pairs of texts that a task compares.
TASK_PAIRS = 1000


def text_sims(pairs: DataFrame, texts: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(a, b, k, sim, words) of stored pairs (a, b), from the two texts.

    Tasks are dealt out by the number of pairs, as comparing costs more than the bytes of the texts tell;
    and stored texts are far larger than their files, so they are not broadcast.
    """
    def side(to: str) -> DataFrame:
        return texts.select(F.col("text_key").alias(to), F.col("text").alias(f"t{to}")).hint("merge")

    tasks = min(max(1, ceil(pairs.count() / TASK_PAIRS)), 10_000)
    met = pairs.repartition(tasks, "a").join(side("a"), "a").repartition(tasks, "b").join(side("b"), "b")
    return met.select("a", "b", "ta", "tb").mapInArrow(_similar(ks), "a string, b string, k int, sim double, words int")


#: Texts a band bucket may have to list all its pairs; a larger one is met by its head and the prefix rule.
BUCKET_TEXTS = 64


def _few_pairs(members: DataFrame) -> DataFrame:
    """All pairs of each bucket; only for buckets of bounded size."""
    of = members.groupBy("key").agg(F.sort_array(F.collect_list("text_key")).alias("t"))
    pairs = F.flatten(F.transform("t", lambda x, i: F.transform(
        F.slice("t", i + 2, F.size("t")), lambda y: F.struct(x.alias("a"), y.alias("b"))
    )))
    return of.select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def _components_by_cell(links: DataFrame) -> DataFrame:
    """(cell, text_key, family) of links (cell, a, b): all cells go through the same rounds."""
    def inside(c: str) -> Column:
        return F.concat(F.format_string("%06d", "cell"), c).alias(c)

    comps = connected_components(links.select(inside("a"), inside("b")))
    return comps.select(
        F.substring("node", 1, 6).cast("int").alias("cell"), F.expr("substring(node, 7)").alias("text_key"),
        F.expr("substring(component, 7)").alias("family"),
    )


def band_families(unique: DataFrame, cells: Sequence[tuple[int, float]], length_aware: bool = False) -> DataFrame:
    """(cell, text_key, family) of every text that is linked to another, for each (k, threshold) by its place in cells.

    Candidates are texts that share a band. They are the same for all cells, and so are their similarities but for k:
    every pair is read once. Buckets of up to BUCKET_TEXTS texts list their pairs; of larger ones each text meets
    the head, and then the texts that are still in another component in some cell and may reach that cell's threshold.
    unique: text_key and text, stored.
    """
    ks = sorted({k for k, _ in cells})
    rows = [(i, k, float(t), max(0.3, t - 0.1) if length_aware else float(t)) for i, (k, t) in enumerate(cells)]
    limits = unique.sparkSession.createDataFrame(rows, "cell int, k int, threshold double, least double")
    limit = F.when(F.col("words") < SHORT_WORDS, F.col("least")).otherwise(F.col("threshold"))

    def linked(sims: DataFrame) -> DataFrame:
        return sims.join(F.broadcast(limits), "k").where(F.col("sim") >= limit).select("cell", "a", "b")

    scratch = Scratch(unique.sparkSession, "bands")
    members = scratch.write(band_members(unique))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = scratch.write(members.join(shared, "key"))
    scratch.drop(members)
    texts = scratch.write(unique.select("text_key", "text").join(live.select("text_key").distinct(), "text_key", "left_semi"))
    large = live.where(F.col("n") > BUCKET_TEXTS).select("key", "text_key")
    pairs = scratch.write(_few_pairs(live.where(F.col("n") <= BUCKET_TEXTS)).unionByName(star_pairs(large)).distinct())
    sims = stored(text_sims(pairs, texts, ks).where(F.col("sim") >= min(r[3] for r in rows)))
    first = linked(sims)
    families = _components_by_cell(first)
    if large.isEmpty():
        return families
    placed = large.join(F.broadcast(limits.select("cell", "least"))).join(families, ["cell", "text_key"], "left")
    placed = placed.select("cell", "least", "key", "text_key", F.coalesce("family", "text_key").alias("comp"))
    mixed = placed.groupBy("cell", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    apart = scratch.write(placed.join(mixed.select("cell", "key"), ["cell", "key"], "left_semi"))
    if apart.isEmpty():
        return families
    rare = prefix_tokens(texts.join(apart.select("text_key").distinct(), "text_key", "left_semi"), limits, ks)
    rest = cross_pairs(apart.join(rare, ["cell", "text_key"]), F.col("least")).join(pairs, ["a", "b"], "left_anti")
    second = scratch.write(linked(text_sims(scratch.write(rest), texts, ks)))
    return families if second.isEmpty() else _components_by_cell(first.unionByName(second))


def _meeting(least: float) -> Column:
    """How many of a shared set's windows are among the rarest that prefix_tokens keeps."""
    n = F.col("n")
    keep = n - F.ceil(n * F.lit(least) - F.lit(1e-9)).cast("int") + 1
    return F.greatest(F.least(keep, n) - (n - F.size("score")), F.lit(0))


def shared_prefix(sets: DataFrame, least: float) -> DataFrame:
    """prefix_tokens of shared sets, which have their windows in order: (text_key, token, rest)."""
    firsts = sets.select("text_key", F.size("score").alias("m"), F.posexplode(F.slice("score", F.lit(1), _meeting(least))).alias("i", "token"))
    return firsts.select("text_key", "token", (F.col("m") - F.col("i")).alias("rest"))


def family_links(
    sets: DataFrame, threshold: float = vocab.DEFAULT_FAMILY_THRESHOLD, length_aware: bool = False,
    bands: DataFrame | None = None, stars: DataFrame | None = None,
) -> DataFrame:
    """Verified links with the connectivity of every pair >= threshold: the exact mode.

    Callers with several thresholds give the bands, and the pairs of star_pairs with their similarity.
    sets: shared_sets.
    """
    least = max(0.3, threshold - 0.1) if length_aware else threshold
    # The others have too few shared windows to reach any text.
    sets = sets.where((F.col("n") == 0) | (_meeting(least) > 0))
    if bands is None:
        bands = stored(close_keys(sets))
    if stars is None:
        first = stored(verify(star_pairs(bands), sets, threshold, length_aware).select("a", "b"))
    else:
        first = stars.where(F.col("sim") >= threshold).select("a", "b")
    comps = connected_components(first)
    texts = sets.select("text_key", F.col("n").alias("size")).join(
        comps.select(F.col("node").alias("text_key"), "component"), "text_key", "left"
    )
    texts = stored(
        texts.select("text_key", "size", F.coalesce("component", "text_key").alias("comp"))
    )
    members = shared_prefix(sets, least).join(texts, "text_key")
    # Most windows lie in one component; only the others go on.
    ends = members.groupBy("token").agg(F.min(F.xxhash64("comp")).alias("lo"), F.max(F.xxhash64("comp")).alias("hi"))
    members = stored(members.join(ends.where("lo <> hi").select("token"), "token", "left_semi"))
    rest = cross_pairs(members.select("token", "text_key", "comp", "size", "rest"), least)
    second = verify(rest, sets, threshold, length_aware).select("a", "b")
    return stored(first.unionByName(second))


def text_families(
    unique: DataFrame, k: int = vocab.DEFAULT_SHINGLE_WORDS, threshold: float = vocab.DEFAULT_FAMILY_THRESHOLD,
    exact: bool = False, length_aware: bool = False,
) -> DataFrame:
    """(text_key, family): family is the smallest text_key of the connected texts.

    Candidates are texts that share a band; with `exact` every pair is one.
    """
    if exact:
        sets = shared_sets(unique, k)
        return linked_families(sets, family_links(sets, threshold, length_aware))
    unique = stored(unique.select("text_key", "text"))
    return _all_texts(unique, band_families(unique, [(k, threshold)], length_aware).select("text_key", "family"))


def _all_texts(unique: DataFrame, families: DataFrame) -> DataFrame:
    """(text_key, family); a text without a link is a family."""
    return unique.select("text_key").join(families, "text_key", "left").select(
        "text_key", F.coalesce("family", "text_key").alias("family")
    )


def linked_families(unique: DataFrame, links: DataFrame) -> DataFrame:
    """(text_key, family) of texts by their links."""
    comps = connected_components(links)
    return _all_texts(unique, comps.select(F.col("node").alias("text_key"), F.col("component").alias("family")))


#: Representatives a shingle may have to be joined one by one; commoner ones go by signature.
POSTINGS = 64


def nearest_other(
    left: DataFrame, reps: DataFrame, k: int = vocab.DEFAULT_SHINGLE_WORDS, postings: int = POSTINGS
) -> DataFrame:
    """(text_key, nearest_family, nearest_j): best representative of another family.

    left: text_key, family, text. reps: family, text.
    """
    a = left.select("text_key", "family", hashed_shingles("text", k).alias("score"))
    b = reps.select("family", hashed_shingles("text", k).alias("score"))
    return nearest_by_sets(a.withColumn("n", F.size("score")), b.withColumn("n", F.size("score")), postings)


def nearest_by_sets(left: DataFrame, reps: DataFrame, postings: int = POSTINGS) -> DataFrame:
    """nearest_other by sets: left: text_key, family, score, n; reps: family, score, n.

    score may leave out what no representative of another family has; n counts all. A top-1 set join in two steps:

    1. Shingles of few representatives: texts meet them through the inverted index, and every
       pair that meets is scored whole (what it shares of common shingles is counted in).
    2. A representative not met yet shares common shingles only. With h of these, a text of n
       shingles cannot score above h / n, so texts that have as much already are done. The others
       are folded by the set of their common shingles, as are the representatives; signatures
       meet, and of all representatives with one signature only the two smallest can win.

    A shingle that sits on every text and every representative thus makes rows for signatures, not
    for pairs. Texts and families travel as 64-bit hashes of their keys. A shingle that only the representative of a
    text's own family has is dropped: in a large family that is nearly all of them.
    """
    a = left.select("text_key", F.xxhash64("text_key").alias("tid"), F.xxhash64("family").alias("own"), "score", F.col("n").alias("na"))
    b = reps.select(F.col("family").alias("rep_family"), F.xxhash64("family").alias("rid"), "score", F.col("n").alias("nb"))
    b_tok = stored(b.select("rid", F.explode("score").alias("tok")))
    held = stored(b_tok.groupBy("tok").agg(F.count(F.lit(1)).alias("df"), F.min("rid").alias("lone")))
    a_tok = a.select("tid", "own", F.explode("score").alias("tok")).join(held, "tok")
    a_tok = stored(a_tok.where((F.col("df") > 1) | (F.col("lone") != F.col("own"))).select("tid", "own", "tok", "df"))
    b_tok = b_tok.join(held.select("tok", "df"), "tok")
    counts, names = a.select("tid", "na"), stored(b.select("rid", "rep_family", "nb"))
    rare, common = F.col("df") <= postings, F.col("df") > postings

    def signature(rows: DataFrame, *by: str) -> DataFrame:
        return rows.where(common).groupBy(*by).agg(F.sort_array(F.collect_list("tok")).alias("sig"))

    a_sig = stored(signature(a_tok, "tid", "own").join(counts, "tid"))
    b_sig = stored(signature(b_tok, "rid").join(names, "rid"))
    met = (
        a_tok.where(rare).select("tid", "own", "tok").join(b_tok.where(rare).select("tok", "rid"), "tok").where("own <> rid")
        .groupBy("tid", "rid").agg(F.count(F.lit(1)).alias("shared"))
        .join(counts, "tid").join(names, "rid")
        .join(a_sig.select("tid", F.col("sig").alias("sa")), "tid", "left")
        .join(b_sig.select("rid", F.col("sig").alias("sb")), "rid", "left")
    )
    shared = F.col("shared") + F.coalesce(F.size(F.array_intersect("sa", "sb")), F.lit(0))
    score = F.struct((-(shared / (F.col("na") + F.col("nb") - shared))).alias("d"), "rep_family")
    first = stored(met.groupBy("tid").agg(F.min(score).alias("m")))

    bound = F.size("sig") / F.col("na")
    # Of equal scores the first family by name counts, so a text that may tie is still open.
    still = a_sig.join(first, "tid", "left").where(F.col("m").isNull() | (bound >= -F.col("m.d")))
    still = still.select("tid", "own", "na", "sig")
    smallest = Window.partitionBy("sig").orderBy("nb", "rep_family")
    two = b_sig.withColumn("n", F.row_number().over(smallest)).where("n <= 2").select(F.col("sig").alias("sb"), "rep_family", "nb")
    x = still.select(F.col("sig").alias("sa")).distinct().withColumn("tok", F.explode("sa"))
    y = b_sig.select(F.col("sig").alias("sb")).distinct().withColumn("tok", F.explode("sb"))
    overlaps = x.join(y, "tok").groupBy("sa", "sb").agg(F.count(F.lit(1)).alias("shared"))
    ask = still.select(F.col("sig").alias("sa"), "na").distinct().join(overlaps, "sa").join(two, "sb")
    score = F.struct((-(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")))).alias("d"), "rep_family")
    best = Window.partitionBy("sa", "na").orderBy("m")
    ask = ask.withColumn("m", score).withColumn("n", F.row_number().over(best)).where("n <= 2").select("sa", "na", "m")
    second = still.join(ask.withColumnRenamed("na", "n"), (F.col("sig") == F.col("sa")) & (F.col("na") == F.col("n")))
    second = second.where(F.xxhash64("m.rep_family") != F.col("own")).select("tid", "m")
    best = first.unionByName(second).groupBy("tid").agg(F.min("m").alias("m"))
    return a.select("text_key", "tid").distinct().join(best, "tid", "left").select(
        "text_key", F.col("m.rep_family").alias("nearest_family"),
        F.coalesce(-F.col("m.d"), F.lit(0.0)).alias("nearest_j"),
    )
