"""Chunk-stitched chains and ranks against direct computation."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchgrid.operators.components import connected_components
from touchgrid.operators.keyed import gap_groups, id_order, rank_in_key
from touchgrid.plans import meetings, model

T0 = dt.datetime(2024, 1, 1)


def test_call_gap_boundaries(spark):
    rows = [("1", "u", "k", T0), ("2", "u", "k", T0 + dt.timedelta(seconds=1800)), ("3", "u", "k", T0 + dt.timedelta(seconds=3601)),
            ("4", "u", None, T0), ("5", "u", "k", None)]
    df = spark.createDataFrame(rows, "id string, user_id string, contact_id string, start_date timestamp_ntz")
    got = {r.id: r.call_group_id for r in model.group_calls(df).collect()}
    assert got == {"1": "u:k:1", "2": "u:k:1", "3": "u:k:3", "4": "solo:4", "5": "solo:5"}


def test_gap_groups_across_chunks(spark):
    rng = random.Random(5)
    rows = [(str(i), rng.choice("ab"), T0 + dt.timedelta(seconds=rng.randrange(0, 200000))) for i in range(800)]
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz")
    got = {r.id: r.g for r in gap_groups(df, ["k"], "ts", "id", 400, out="g", chunk_seconds=1000).collect()}
    want = {}
    for k in "ab":
        head = last = None
        for i, _, ts in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], int(r[0]))):
            if last is None or (ts - last).total_seconds() > 400:
                head = i
            want[i], last = head, ts
    assert got == want


def test_rank_in_key(spark):
    rng = random.Random(6)
    rows = [(str(i), "h", T0 + dt.timedelta(hours=rng.randrange(0, 300))) for i in range(400)]
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz")
    got = rank_in_key(df, ["k"], F.col("ts").cast("date"), [F.col("ts"), F.col("id")])
    direct = df.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
    assert got.join(direct, "id").where("rn <> want").count() == 0


def test_id_order(spark):
    df = spark.createDataFrame([("100",), ("99",), ("b",), ("a",), ("007",)], "id string")
    assert [r.id for r in df.orderBy(id_order("id")).collect()] == ["007", "99", "100", "a", "b"]


def test_components_random(spark):
    rng = random.Random(8)
    edges = [(f"n{rng.randrange(90):03d}", f"n{rng.randrange(90):03d}") for _ in range(70)] + [("n000", f"z{i:03d}") for i in range(200)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}


def test_sixty_day_walk(spark):
    days = [0, 40, 60, 61, 80]
    rows = [(str(i), "rep", (T0 + dt.timedelta(days=d)).date(), T0 + dt.timedelta(days=d), None, "meeting", True) for i, d in enumerate(days)]
    act = spark.createDataFrame(rows, "activity_id string, ca_id string, activity_date date, occurred_at timestamp_ntz, outcome string, channel string, counts boolean")
    amap = spark.createDataFrame([(str(i), "acc") for i in range(5)], "activity_id string, account_id string")
    got = {r.activity_id: r.bucket for r in meetings.meeting_flags(act, amap).collect()}
    new, follow = "new_stakeholder", "follow_up"
    assert [got[str(i)] for i in range(5)] == [new, follow, follow, new, follow]
