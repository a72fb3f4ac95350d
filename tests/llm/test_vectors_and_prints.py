"""Centroid clustering, SimHash near-duplicates and hard negatives against brute force and on odd input."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from touchgrid.llm import hardneg, heapmeans, pivotdups


def brute_clusters(rows, k, rounds, scale, dim, seed):
    """Plain Lloyd rounds in Python integers."""
    kept = [
        (i, [int(np.floor(scale * float(x))) for x in e]) for i, e in rows
        if e is not None and len(e) == dim and all(x is not None and np.isfinite(x) for x in e)
    ]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    spread = defaultdict(int)
    for _, c, d in found:
        spread[c] += min(d, (1 << 63) - 1)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    top = (1 << 63) - 1
    return sorted(
        ((i, c, min(d, top), min(spread[c], top), min(sum(spread.values()), top), sha[c]) for i, c, d in found), key=repr
    )


VECTORS = "vec_id long, embedding array<float>, label int, cluster int, number int"


@pytest.mark.parametrize("spread", [0.05, 1e7, 3e8])
def test_clusters_against_plain_rounds(spark, spread):
    rng = random.Random(int(spread * 10))
    centers = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(7)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(centers)]) for i in range(400)]
    rows += [(i, rows[i][1]) for i in range(30)] + [(1000 + i, rows[5][1]) for i in range(150)]
    rows += [(2000, None), (2001, [1.0] * 5), (2002, [1.0] * 5 + [None]), (2003, [float("nan")] * 6), (2004, [float("inf")] * 6)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS).repartition(5)
    for rounds in (0, 4):
        got = heapmeans.cluster_vectors(df, k=9, rounds=rounds, dim=6, block_rows=64)
        want = brute_clusters(rows, 9, rounds, 64, 6, 1)
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_clusters_of_few_or_no_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert heapmeans.cluster_vectors(none).count() == 0
    some = spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.5]), (3, None)], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, heapmeans.cluster_vectors(some, dim=2).select("vec_id", "cluster", "distance").collect()), key=repr)
    assert got == [(1, 0, 0), (None, 1, 0)]
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(r["distance"] for r in heapmeans.cluster_vectors(huge, dim=2, k=1).collect()) == [(1 << 63) - 1] * 2


def test_heaps_spare_most_vectors():
    """Once centroids move little, only vectors near a border are looked at again."""
    rng = np.random.default_rng(3)
    centers = rng.integers(-4000, 4000, (8, 16))
    points = (centers[rng.integers(0, 8, 3000)] + rng.integers(-60, 60, (3000, 16))).astype(np.int64)
    block = heapmeans.Block(points, 8)
    start = centers.tolist()
    block.assign(start, [0.0] * 8)
    moved = (centers + rng.integers(-3, 4, (8, 16))).tolist()
    assert len(block.due([0.0] * 8)) == 0
    offsets = [2 * float(np.sqrt(((np.array(moved) - centers) ** 2).sum(axis=1)).max())] * 8
    again = heapmeans.Block.read(block.stored(), 16)
    assert len(again.due(offsets)) < 300
    block.assign(moved, offsets)
    want = heapmeans.squared_distances(points, moved).argmin(axis=1)
    assert (block.cluster == want).all()


def plain_print(text):
    words = [w for w in _split(text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return lowered.split(" ")


def brute_components(prints):
    """prints: (doc_id, fingerprint); doc ids linked by fingerprints at 3 bits or fewer."""
    top = {i: i for i, _ in prints}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(i), root(j)
                top[max(x, y)] = min(x, y)
    return sorted((i, f"{p:016x}", root(i)) for i, p in prints)


def test_fingerprints_and_components(spark):
    rng = random.Random(8)
    base = [f"W{rng.randrange(60)}" for _ in range(300)]
    texts = [None, "", " \t\n", "one", "ONE  two", "one\ntwo three", "Straße Ähre ÄHRE   x y", "a\x0bb\x1cc d"]
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(300)] = f"n{rng.randrange(9)}"
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    texts += [" ".join(rng.choice(base) for _ in range(rng.randrange(1, 40))) for _ in range(150)] + texts[10:20]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(3, texts[40], "x", "y"), (200, texts[90], "x", "y")]
    df = spark.createDataFrame(rows + [(None, "one", "x", "y")], "doc_id long, text string, fp string, member string").repartition(4)
    prints = [(i, plain_print(t)) for i, t, _, _ in rows]
    want = brute_components(prints)
    for run_rows in (4096, 16):
        got = pivotdups.near_duplicates(df, run_rows=run_rows).select("doc_id", "fingerprint", "component_id").collect()
        assert sorted(map(tuple, got)) == want
    assert len({c for _, _, c in want}) < 240
    assert pivotdups.near_duplicates(df.where("false")).count() == 0


def test_long_texts_in_segments(monkeypatch):
    rng = random.Random(2)
    text = " ".join("w" * rng.randrange(1, 30) + str(rng.randrange(50)) for _ in range(400)) + "  "
    want = pivotdups.shingle_bits(text)
    for size in (1, 7, 64):
        monkeypatch.setattr(pivotdups, "SEGMENT_BYTES", size)
        got = pivotdups.shingle_bits(text)
        assert got[1] == want[1] and (got[0] == want[0]).all()
        assert pivotdups.shingle_bits("x" * 500)[1] == 1 and pivotdups.shingle_bits("  a   b ")[1] == 1


def test_links_inside_and_across_runs():
    """Random fingerprints around a few centres, and one large room, against all pairs."""
    rng = np.random.default_rng(4)
    pivots = pivotdups.references()
    centres = rng.integers(0, 1 << 64, 5, dtype=np.uint64)
    fps = []
    for _ in range(400):
        fp = int(centres[rng.integers(5)])
        for b in rng.integers(0, 64, rng.integers(0, 9)):
            fp ^= 1 << int(b)
        fps.append(fp)
    fps = np.array(sorted(set(fps)), np.uint64)
    fps = fps[np.argsort(pivotdups.distance_table(fps, pivots)[0], kind="stable")]

    def groups_of(top):
        return {frozenset(np.flatnonzero(top == t).tolist()) for t in set(top.tolist())}

    def brute(pairs, n):
        g = pivotdups.Groups(n)
        for i, j in pairs:
            if np.bitwise_count(fps[i] ^ fps[j]) <= 3:
                g.merge(np.array([i]), np.array([j]))
        return groups_of(g.top)

    n = len(fps)
    inside = pivotdups.link_inside(np.zeros(n, int), fps, pivotdups.distance_table(fps, pivots), 3)
    assert groups_of(inside) == brute([(i, j) for i in range(n) for j in range(i)], n)
    across = pivotdups.link_across(fps[:n // 2], fps[n // 2:], pivots, 3)
    assert groups_of(across) == brute([(i, j) for i in range(n // 2) for j in range(n // 2, n)], n)


def test_every_link_shares_a_room():
    masks = pivotdups.slice_masks()
    assert len(masks) == 20
    rng = random.Random(1)
    for _ in range(300):
        flips = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(flips & m == 0 for m in masks)


def test_hash_is_sparks(spark):
    """The same 64-bit hash that Spark's own function gives."""
    words = ["", "a b c", "Straße x y", "x" * 100]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()]
    assert [g % (1 << 64) for g in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def brute_negatives(rows, is_anchor, scale=256):
    kept = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        v = (label, [int(np.floor(scale * float(x))) for x in e])
        kept[i] = min(kept.get(i, v), v)
    out = []
    for a, (label, q) in kept.items():
        if not is_anchor(a):
            continue
        scores = [
            (-sum(x * y for x, y in zip(q, v)), i, own == label) for i, (own, v) in kept.items() if i != a and len(v) == len(q)
        ]
        for p, positive, same in sorted(x for x in scores if x[2])[:5]:
            fit = sorted((s, i) for s, i, same in scores if not same and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(a, positive, n + 1, i, -p, -s) for n, (s, i) in enumerate(fit[:3])]
    return sorted(out)


@pytest.mark.parametrize("spread", [1.0, 1e6])
def test_hard_negatives_against_every_pair(spark, spread):
    rng = random.Random(6)
    centers = [[rng.gauss(0, spread) for _ in range(70)] for _ in range(4)]

    def near(n):
        return [float(np.float32(x + rng.gauss(0, 0.8 * spread))) for x in centers[n]]

    rows = [(i, near(i % 4), i % 3) for i in range(300)]
    rows += [(1000 + i, rows[3][1], 2) for i in range(60)] + [(2000, [0.0] * 70, 1), (2010, [0.0] * 70, 1), (2001, [0.0] * 70, 2)]
    rows += [(3000 + 10 * i, [1.0, float(i)], i % 2) for i in range(8)]
    rows += [(5, near(1), 0), (10, near(1), 1), (None, near(0), 1), (4000, near(0), None), (4010, None, 1), (4020, [None] * 70, 1)]
    rows += [(4030, [float("nan")] * 70, 1), (4040, [], 1), (5000, near(0), 77)]
    schema = "vec_id long, embedding array<float>, label int, name string, part int, low int"
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema).repartition(3)
    got = hardneg.hard_negatives(df, F.col("vec_id") % 10 == 0, shard_rows=40, block_rows=9, group_shards=3)
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) > 150
    assert hardneg.hard_negatives(df.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_intervals_hold_every_product():
    rng = np.random.default_rng(9)
    for dim in (1, 5, 64, 130):
        points = rng.integers(-300, 300, (200, dim))
        points[0] = 0
        queries = np.concatenate([points[:5], rng.integers(-300, 300, (20, dim))])
        turn = hardneg.rotation(dim)
        assert np.allclose(turn @ turn.T, np.eye(dim))
        low, high = hardneg.intervals(queries, *hardneg.encode(points, turn), turn)
        exact = queries @ points.T
        assert (low <= exact).all() and (exact <= high).all()
        if dim > 5:
            length = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(points, axis=1)
            assert ((high - low)[:, 1:] < 2 * length[:, 1:] + 1)[1:].all()


def test_codes_spare_rows():
    """Rows far from an anchor are ruled out by their interval alone."""
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(64)
    points = np.concatenate([centre + 0.2 * rng.standard_normal((100, 64)), -centre + 0.2 * rng.standard_normal((900, 64))])
    points = np.floor(256 * points).astype(np.int64)
    turn = hardneg.rotation(64)
    codes, norms, alignments = hardneg.encode(points, turn)
    shard = {"ids": np.arange(1000), "labels": np.zeros(1000, int), "points": points, "codes": codes, "norms": norms, "alignments": alignments}
    anchors = {"ids": np.arange(3), "labels": np.zeros(3, int), "points": points[:3]}
    wants = [[hardneg.Want(hardneg.LONG_MIN, hardneg.LONG_MAX, 5)] for _ in range(3)]
    hardneg.search(shard, anchors, wants, True, turn)
    assert hardneg.search(shard, anchors, wants, True, turn) < 3 * 150
