"""New and follow-up meetings of a replayed stream against the batch rule."""

import datetime as dt
import random

from pyspark.sql import functions as F

from touchgrid.plans import meetings
from touchgrid.streaming import meetings as online

FIELDS = "activity_id string, account_id string, activity_date date, occurred_at timestamp, ca_id string, outcome string, channel string, counts boolean"


def _rows(seed, accounts=6, n=260, days=420):
    rng, first, out = random.Random(seed), dt.date(2024, 1, 1), []
    for i in range(n):
        day = first + dt.timedelta(days=rng.randrange(days))
        at = None if rng.random() < 0.2 else dt.datetime.combine(day, dt.time(rng.randrange(24)))
        account = rng.choice([None, "hot", "hot", *map(str, range(accounts))])
        out.append((f"m{i:03d}", account, day, at, "r", "held", "meeting", True))
    return sorted(out, key=lambda r: (r[2], r[0]))


def _run(spark, src, base):
    stream = spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(src)
    return online.follow_meetings(stream, base, "5 days")


def test_stream_equals_batch(spark, tmp_path):
    rows = _rows(3)
    src, base = str(tmp_path / "src"), str(tmp_path / "base")
    # Neighbouring rows change places by up to four days, across the border of two batches too.
    shaken = sorted(rows, key=lambda r: (r[2] + dt.timedelta(days=(7 * int(r[0][1:])) % 5 if int(r[0][1:]) % 3 == 0 else 0), r[0]))
    half = len(shaken) // 2
    end = ("end", "nobody", dt.date(2030, 1, 1), None, "r", "held", "meeting", True)
    for part in (shaken[:half], shaken[half:], [end]):
        spark.createDataFrame(part, FIELDS).coalesce(1).write.mode("append").parquet(src)
        days = _run(spark, src, base)  # stopped and started again after every file
    assert days.groupBy("account_id", "activity_date").count().where("count > 1").isEmpty()
    df = spark.createDataFrame(rows, FIELDS)
    got = {(r.activity_id, r.account_id, r.bucket) for r in online.flags_from_days(df, days).collect()}
    want = meetings.meeting_flags(df.drop("account_id"), df.select("activity_id", "account_id"))
    want = {(r.activity_id, r.account_id, r.bucket) for r in want.collect()}
    assert got == want and {b for *_, b in want} == set(meetings.BUCKETS)
    assert days.where("account_id = 'hot'").agg(F.sum("meetings")).first()[0] == sum(r[1] == "hot" for r in rows)


def test_open_days_wait(spark, tmp_path):
    """A day inside the lateness is not settled; a meeting beyond it is dropped, and an empty stream gives nothing."""
    src, base = str(tmp_path / "src"), str(tmp_path / "base")
    day = lambda i, d: (f"m{i}", "a", d, None, "r", "held", "meeting", True)
    spark.createDataFrame([], FIELDS).write.parquet(src)
    assert _run(spark, src, base).isEmpty()
    for part in ([day(1, dt.date(2024, 1, 1)), day(2, dt.date(2024, 1, 8))], [day(3, dt.date(2023, 6, 1)), day(4, dt.date(2024, 1, 9))]):
        spark.createDataFrame(part, FIELDS).coalesce(1).write.mode("append").parquet(src)
        days = _run(spark, src, base)
    got = [(r.activity_id, r.opened) for r in days.collect()]
    assert got == [("m1", True)]
