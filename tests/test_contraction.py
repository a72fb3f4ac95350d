"""Ordered guarded union against a plain fold over the sorted edges."""

import random

import pytest

from touchgrid.operators import contraction


def fold(edges, sets):
    group = {n: {n} for e in edges for n in e[1:3]}
    items = {n: set(sets.get(n, ())) for n in group}
    for _, x, y, _, free in sorted(edges, key=lambda e: e[3]):
        a, b = min(group[x]), min(group[y])
        if a == b:
            continue
        left = items[a] | items[b] if free else items[a] & items[b]
        if left or free:
            whole = group[a] | group[b]
            for n in whole:
                group[n] = whole
            items[min(whole)] = left
    return sorted({tuple(sorted(g)) for g in group.values()})


def got(spark, edges, sets):
    e = spark.createDataFrame(edges, "part long, x long, y long, at long, free boolean")
    s = spark.createDataFrame([(n, i) for n, own in sets.items() for i in own], "node long, item string")
    by = {}
    for r in contraction.guarded_groups(e, s).collect():
        by.setdefault(r.top, []).append(r.node)
    return sorted(tuple(sorted(g)) for g in by.values())


@pytest.mark.parametrize("seed,free", [(1, 0.0), (2, 0.3)])
def test_random_graphs(spark, seed, free):
    rng = random.Random(seed)
    edges, sets = [], {}
    for part in range(5):
        nodes = [part * 100 + i for i in range(rng.randrange(3, 9))]
        sets |= {n: rng.sample("abcde", rng.randrange(0, 4)) for n in nodes}
        pairs = [(x, y) for x in nodes for y in nodes if x < y and rng.random() < 0.5]
        rng.shuffle(pairs)
        # The same two nodes may have a second edge.
        pairs += rng.sample(pairs, len(pairs) // 4)
        edges += [(part, x, y, k, rng.random() < free) for k, (x, y) in enumerate(pairs)]
    want = fold([(p, x, y, (p, k), f) for p, x, y, k, f in edges], sets)
    assert got(spark, edges, sets) == want
    assert any(len(g) > 2 for g in want)


@pytest.mark.parametrize("folded", [0, 12, 10_000])
def test_small_parts_are_folded_and_large_ones_take_rounds(spark, monkeypatch, folded):
    rng = random.Random(5)
    edges, sets = [], {}
    for part, size in enumerate((3, 4, 9)):
        nodes = [part * 100 + i for i in range(size)]
        sets |= {n: rng.sample("abc", rng.randrange(0, 3)) for n in nodes}
        pairs = [(x, y) for x in nodes for y in nodes if x < y]
        edges += [(part, x, y, k, rng.random() < 0.2) for k, (x, y) in enumerate(rng.sample(pairs, len(pairs)))]
    rounds, plain = [], contraction._runs
    monkeypatch.setattr(contraction, "_runs", lambda e: rounds.append(1) or plain(e))
    whole = contraction.guarded_groups
    monkeypatch.setattr(contraction, "guarded_groups", lambda e, s: whole(e, s, folded))
    assert got(spark, edges, sets) == fold([(p, x, y, (p, k), f) for p, x, y, k, f in edges], sets)
    assert bool(rounds) == (folded < 10_000)


def test_a_hub_takes_its_run_at_once(spark, monkeypatch):
    """A hundred copies of one message and a row that bridges them to another take few rounds."""
    edges = [(0, 0, i, i, False) for i in range(1, 100)] + [(0, 1, 100, 200, False), (0, 100, 101, 201, False)]
    sets = {i: ["a"] for i in range(100)} | {100: ["a", "b"], 101: ["b"]}
    rounds, plain = [], contraction._runs
    monkeypatch.setattr(contraction, "_runs", lambda e: rounds.append(1) or plain(e))
    assert got(spark, edges, sets) == fold(edges, sets) == [tuple(range(101)), (101,)]
    assert len(rounds) <= 3
