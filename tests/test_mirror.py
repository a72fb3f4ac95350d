"""The copy-on-write mirror: what an update writes, what a replay writes, and how long old numbers live."""

import os
import random

import pytest

from touchgrid.sources import mirror

SCHEMA = "id string, v int, modified int"


def files(base):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{base}/data") for f in fs if f.endswith(".parquet")}


def test_a_small_batch_writes_its_buckets_only(spark, tmp_path):
    base = str(tmp_path / "m")
    rows = [(f"k{i}", i, 1) for i in range(3000)]
    assert mirror.upsert_mirror(spark.createDataFrame(rows, SCHEMA), base, "modified", buckets=100) == 1
    before = files(base)
    batch = spark.createDataFrame([("k7", 70, 2), ("k7", 71, 3), ("k8", 80, 0)], SCHEMA)
    assert mirror.upsert_mirror(batch, base, "modified") == 2
    added = files(base) - before
    # k8 came with an older row, so only the bucket of k7 is written: one of a hundred.
    assert len(added) == 1 and before <= files(base)
    size = sum(os.path.getsize(f) for f in added)
    assert size < 0.03 * sum(os.path.getsize(f) for f in before)
    now = {r.id: r.v for r in mirror.read_mirror(spark, base, SCHEMA).collect()}
    assert len(now) == 3000 and now["k7"] == 71 and now["k8"] == 8
    # A replay publishes nothing, whole or in part.
    assert mirror.upsert_mirror(batch, base, "modified") is None
    assert mirror.upsert_mirror(spark.createDataFrame(rows[:50], SCHEMA), base, "modified") is None
    assert mirror.numbers(spark, base) == [1, 2]


def test_old_numbers_stay_readable_until_retention(spark, tmp_path):
    base = str(tmp_path / "m")
    for n in range(5):
        mirror.upsert_mirror(spark.createDataFrame([("a", n, n), (f"b{n}", n, n)], SCHEMA), base, "modified", buckets=8, kept=2)
    assert mirror.numbers(spark, base) == [4, 5]
    assert {r.id: r.v for r in mirror.read_mirror(spark, base, SCHEMA, 4).collect()} == {"a": 3, "b0": 0, "b1": 1, "b2": 2, "b3": 3}
    assert mirror.read_mirror(spark, base, SCHEMA).count() == 6
    with pytest.raises(FileNotFoundError):
        mirror.read_mirror(spark, base, SCHEMA, 3)
    # Only folders that number 4 or 5 names are left.
    named = {f for n in (4, 5) for f in mirror._manifest(spark, base, n)[1].values()}
    assert {os.path.relpath(os.path.dirname(f), base) for f in files(base)} == named


def test_any_split_into_batches_gives_the_same_state(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(20)}", rng.randrange(100), rng.randrange(6)) for _ in range(120)] + [(None, 1, 1)]
    states = []
    for n in range(2):
        rng.shuffle(rows)
        base, at = str(tmp_path / f"m{n}"), 0
        while at < len(rows):
            size = rng.randrange(30, 80)
            mirror.upsert_mirror(spark.createDataFrame(rows[at:at + size], SCHEMA), base, "modified", buckets=4)
            at += size
        states.append(sorted(map(tuple, mirror.read_mirror(spark, base, SCHEMA).collect())))
    assert states[0] == states[1]
    best = {}
    for k, _, m in rows:
        if k:
            best[k] = max(best.get(k, m), m)
    assert {(k, m) for k, _, m in states[0]} == set(best.items())
    assert mirror.read_mirror(spark, str(tmp_path / "none"), SCHEMA).count() == 0
