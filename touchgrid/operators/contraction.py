"""Ordered union of nodes whose sets must keep something in common.

Edges are taken in their order. An edge joins the groups of its ends if these still share an
item, and the new group has what both had; a `free` edge always joins them, and the new group has
what either had. What an edge does depends on every earlier edge of the groups it touches, so the
whole is a fold by nature; but an edge that is the earliest of both its groups depends on nothing
else. Such edges exist all over the graph, and each round decides them everywhere at once:

1. Every group finds its earliest edge. Where two groups name each other, one is a hub.
2. A hub takes a whole run of its edges: those to groups whose earliest edge leads to this hub,
   as long as no edge from a group already taken would come in between. An item survives until
   the first of them that lacks it, so the last surviving item says where the run is refused.
3. Edges, sets and nodes are renamed after the hubs.

Where no free edge is left, sets only shrink: an edge between groups without a common item is
then lost whatever comes, and so is every second edge of the same two groups. Both go at once.

The rounds are joins and aggregates; no group is ever held by one task. They cost the same
however little a round decides, so parts of few edges and items do not take them: each is one row,
and a small helper folds it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchgrid.session import Scratch

NEVER = (1 << 31) - 1
#: Rounds after which the nodes are renamed, all at once.
RENAMED_AT_ONCE = 8
#: Edges plus items that a part may have to be folded as one row.
FOLDED_AT_ONCE = 2_000


def _relevant(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges between two groups that may still do something."""
    edges = edges.where("x <> y")
    calm = edges.groupBy("part").agg((~F.bool_or("free")).alias("calm"))
    marked = edges.join(calm, "part")
    marked = marked.groupBy(
        "part", "calm", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"),
        F.when(~F.col("calm"), F.col("edge")).alias("own"),
    ).agg(F.min(F.struct("at", "edge", "free")).alias("e"))
    marked = marked.select("part", "x", "y", "e.at", "e.edge", "e.free", "calm")
    left = sets.select(F.col("node").alias("x"), "item")
    right = sets.select(F.col("node").alias("y"), "item")
    alive = marked.where("calm").select("edge", "x", "y").join(left, "x").join(right, ["y", "item"]).select("edge").distinct()
    columns = ("part", "x", "y", "at", "edge", "free")
    return marked.where("calm").join(alive, "edge", "left_semi").select(*columns).unionByName(
        marked.where("NOT calm").select(*columns)
    )


def _runs(edges: DataFrame) -> DataFrame:
    """(hub, leaf, edge, free, k): the run of edges each hub can decide in this round."""
    ends = edges.select(F.col("x").alias("g"), F.col("y").alias("h"), "at", "edge", "free").unionByName(
        edges.select(F.col("y").alias("g"), F.col("x").alias("h"), "at", "edge", "free")
    )
    nearest = ends.groupBy("g", "h").agg(F.min("at").alias("at"))
    order = Window.partitionBy("g").orderBy("at")
    first = nearest.withColumn("n", F.row_number().over(order)).withColumn("then", F.lead("at").over(order)).where("n = 1")
    first = first.select("g", F.col("h").alias("to"), "then")
    back = first.select(F.col("g").alias("to"), F.col("to").alias("back"))
    hubs = first.join(back, "to").where("back = g AND g < to").select("g")
    # `then`: the earliest edge of a leaf that leads elsewhere.
    leaf = first.select(F.col("g").alias("h"), F.col("to").alias("leads"), "then")
    mine = ends.join(hubs, "g").join(leaf, "h").withColumn("ready", F.col("leads") == F.col("g"))
    order = Window.partitionBy("g").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    broken = (
        ~F.col("ready") | (F.col("free") != F.first("free").over(order))
        | F.coalesce(F.min("then").over(before) < F.col("at"), F.lit(False))
    )
    taken = mine.withColumn("k", F.row_number().over(order)).withColumn("broken", broken)
    taken = taken.withColumn("broken", F.max("broken").over(until)).where("NOT broken")
    return taken.select(F.col("g").alias("hub"), F.col("h").alias("leaf"), "edge", "free", "k")


def _judged(runs: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hub, leaf, edge, joins) of decided edges, and (node, item) of the hubs that took a guarded run."""
    guarded = runs.where("NOT free").select("hub", "leaf", "k")
    asked = guarded.join(sets.select(F.col("node").alias("hub"), "item"), "hub")
    held = sets.select(F.col("node").alias("leaf"), "item", F.lit(True).alias("held"))
    lost = asked.join(held, ["leaf", "item"], "left").groupBy("hub", "item").agg(
        F.coalesce(F.min(F.when(F.col("held").isNull(), F.col("k"))), F.lit(NEVER)).alias("lost")
    )
    stops = lost.groupBy("hub").agg(F.max("lost").alias("stop"))
    # A hub without items refuses its first edge.
    judged = runs.join(stops, "hub", "left").withColumn(
        "stop", F.when(F.col("free"), F.lit(NEVER)).otherwise(F.coalesce("stop", F.lit(1)))
    )
    judged = judged.where("k <= stop").select("hub", "leaf", "edge", "free", (F.col("k") < F.col("stop")).alias("joins"))
    left = lost.join(stops, "hub").where("lost = stop").select(F.col("hub").alias("node"), "item")
    return judged, left


def _moved(judged: DataFrame) -> DataFrame:
    """(node, hub) of the groups that went into a hub."""
    merged = judged.where("joins").groupBy("leaf").agg(F.min("hub").alias("hub"))
    return merged.select(F.col("leaf").alias("node"), "hub")


def _renamed(scratch: Scratch, names: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """The names after some rounds; the rounds' tables are spent then."""
    if not rounds:
        return names
    new = names
    for judged in rounds:
        new = new.join(_moved(judged).withColumnRenamed("node", "top"), "top", "left")
        new = new.select("node", F.coalesce("hub", "top").alias("top"))
    new = scratch.write(new)
    scratch.drop(names, *rounds)
    return new


@F.pandas_udf(T.ArrayType(T.LongType()))
def fold(nodes: pd.Series, items: pd.Series, xs: pd.Series, ys: pd.Series, free: pd.Series) -> pd.Series:
    """The ordered union of one part per row: the group of each of its nodes, by the edges in order."""

    def of(nodes, items, xs, ys, free):
        top = {n: n for n in nodes}
        held = {n: set(own) for n, own in zip(nodes, items)}

        def find(n):
            while top[n] != n:
                top[n] = n = top[top[n]]
            return n

        for x, y, always in zip(xs, ys, free):
            a, b = sorted((find(x), find(y)))
            both = held[a] | held[b] if always else held[a] & held[b]
            if a != b and (always or both):
                top[b], held[a] = a, both
        return [find(n) for n in nodes]

    return pd.Series([of(*row) for row in zip(nodes, items, xs, ys, free)], dtype=object)


def _folded(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, top) of small parts."""
    ordered = edges.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("at", "x", "y", "free"))).alias("e"))
    nodes = edges.select("part", F.col("x").alias("node")).union(edges.select("part", "y")).distinct()
    held = nodes.join(sets, "node", "left").groupBy("part", "node").agg(F.collect_list("item").alias("items"))
    held = held.groupBy("part").agg(F.collect_list(F.struct("node", "items")).alias("n"))
    parts = ordered.join(held, "part").select("n.node", fold("n.node", "n.items", "e.x", "e.y", "e.free").alias("top"))
    return parts.select(F.explode(F.arrays_zip("node", "top")).alias("f")).select("f.node", "f.top")


def guarded_groups(edges: DataFrame, sets: DataFrame, folded: int = FOLDED_AT_ONCE) -> DataFrame:
    """(node, top) for every node of an edge; top names the group the ordered union ends in.

    edges: (part, x, y, at, free), each once, where `part` is any label that edges of one connected
    component share, and `at` orders the edges of a component without ties. sets: (node, item),
    each once. Nodes are longs. Parts of up to `folded` edges and items are folded one by one.
    """
    scratch = Scratch(edges.sparkSession, "guarded-groups")
    given, sets = scratch.write(edges), scratch.write(sets)
    nodes = given.select("part", F.col("x").alias("node")).union(given.select("part", "y")).distinct()
    weights = nodes.join(sets, "node").select("part").unionByName(given.select("part"))
    large = scratch.write(weights.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > folded).select("part"))
    if large.isEmpty():
        return _folded(given, sets)
    small = _folded(given.join(large, "part", "left_anti"), sets)
    return small.unionByName(_by_rounds(scratch, given.join(large, "part", "left_semi"), sets))


def _by_rounds(scratch: Scratch, edges: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, top) by rounds, for parts of any size."""
    given = scratch.write(edges)
    nodes = given.select(F.col("x").alias("node")).union(given.select("y")).distinct()
    names = scratch.write(nodes.select("node", F.col("node").alias("top")))
    sets = scratch.write(sets.join(names, "node", "left_semi"))
    numbered = scratch.write(given.withColumn("edge", F.monotonically_increasing_id()))
    edges = scratch.write(_relevant(numbered, sets))
    scratch.drop(given, numbered)
    waiting: list[DataFrame] = []
    while not edges.isEmpty():
        judged, guarded = _judged(_runs(edges), sets)
        judged = scratch.write(judged)
        moved = _moved(judged)
        renewed = judged.where("NOT free").select(F.col("hub").alias("node")).distinct()
        # A guarded hub keeps what survived and its leaves bring nothing; a free one takes what they bring.
        brought = judged.where("joins AND free").select("leaf").distinct().withColumnRenamed("leaf", "node")
        kept = sets.join(moved, "node", "left_anti").join(renewed, "node", "left_anti")
        came = sets.join(brought, "node", "left_semi").join(moved, "node").select(F.col("hub").alias("node"), "item")
        new_sets = scratch.write(kept.unionByName(guarded).unionByName(came).distinct())
        rest = edges.join(judged.where("NOT joins").select("edge"), "edge", "left_anti")
        for end in ("x", "y"):
            rest = rest.join(moved.select(F.col("node").alias(end), F.col("hub").alias("to")), end, "left")
            rest = rest.withColumn(end, F.coalesce("to", end)).drop("to")
        new_edges = scratch.write(_relevant(rest, new_sets))
        scratch.drop(sets, edges)
        sets, edges = new_sets, new_edges
        waiting.append(judged)
        if len(waiting) == RENAMED_AT_ONCE:
            names, waiting = _renamed(scratch, names, waiting), []
    names = _renamed(scratch, names, waiting)
    scratch.drop(sets, edges)
    return names
