"""Recordings matched to meeting slots through time bins of growing length."""

import datetime as dt
import random

from pyspark.sql import functions as F

from touchgrid.plans import meetings

T0 = dt.datetime(2024, 5, 1, 10, 0, 0)


def test_slots_of_any_length(spark):
    rng = random.Random(4)
    day = 24 * 60
    slots = [(f"a{i}", f"m{i}", T0 + dt.timedelta(minutes=rng.randrange(30 * day)),
              rng.choice([None, 0, 20, 45, 300, 3 * day, 40 * day, 3650 * day])) for i in range(60)]
    slots = [(a, m, s, None if n is None else s + dt.timedelta(minutes=n)) for a, m, s, n in slots]
    slots += [("edge", "me", T0, T0 + dt.timedelta(minutes=30)), ("none", "mn", None, T0), ("back", "mb", T0, T0 - dt.timedelta(days=9))]
    calls = [(f"c{i}", f"t{i}", T0 + dt.timedelta(minutes=rng.randrange(60 * day)), "COMPLETED", 1) for i in range(80)]
    calls += [("e0", "t", T0 - dt.timedelta(minutes=15), "COMPLETED", 1), ("e1", "t", T0 - dt.timedelta(minutes=15, seconds=1), "COMPLETED", 1)]
    mc = [(m, f"p{rng.randrange(4)}") for _, m, _, _ in slots if m != "me"] + [("me", "solo")]
    rc = [(c, f"p{rng.randrange(4)}") for c, *_ in calls if c[0] == "c"] + [("e0", "solo"), ("e1", "solo")]
    frames = [
        spark.createDataFrame(slots, "activity_id string, meeting_id string, start_time timestamp, end_time timestamp"),
        spark.createDataFrame(calls, "id string, title string, call_time timestamp, call_status string, last_seen_at int"),
        spark.createDataFrame(mc, "meeting_id string, contact_id string"), spark.createDataFrame(rc, "call_id string, contact_id string"),
    ]
    want = {}
    for a, m, start, end in slots:
        if start is None:
            continue
        low = start - dt.timedelta(minutes=15)
        high = (end or start + dt.timedelta(minutes=30)) + dt.timedelta(minutes=30)
        who = {p for x, p in mc if x == m}
        found = [(t, c) for c, _, t, _, _ in calls if low <= t <= high and who & {p for x, p in rc if x == c}]
        if found:
            want[a] = min(found)[1]
    got = {r.activity_id: r.recording_id for r in meetings.recording_verification(*frames).collect()}
    assert got == want and got["edge"] == "e0" and len(want) > 10


def test_a_slot_of_ten_years_costs_two_rows(spark):
    rows = [(T0, T0 + dt.timedelta(days=3650)), (T0, T0), (T0, T0 + dt.timedelta(hours=1)), (T0, T0 + dt.timedelta(seconds=3601))]
    bins = meetings.slot_bins(spark.createDataFrame(rows, "lo timestamp, hi timestamp"), "lo", "hi", 3600)
    assert bins.groupBy("lo", "hi").count().agg(F.max("count")).first()[0] <= 2
    assert bins.count() <= 8
