"""Idempotent landing, publishing, sheets, streaming, and the registry's own shape."""

import datetime as dt

import pytest

from touchgrid import vocab
from touchgrid.catalog import all_oracles, all_queries, coverage
from touchgrid.functions import parse
from touchgrid.plans import deals, identity, quality
from touchgrid.sources import landing
from touchgrid.streaming import landing as live


def test_append_and_upsert_are_idempotent(spark):
    held = spark.createDataFrame([("1", 10, 1), ("2", 20, 1)], "id string, v int, at int")
    batch = spark.createDataFrame([("2", 21, 2), ("3", 30, 2), ("3", 31, 3)], "id string, v int, at int")
    new = landing.append_absent(held, batch)
    assert {r.id for r in new.collect()} == {"3"}
    assert landing.append_absent(held.unionByName(new), batch).count() == 0
    once = landing.upsert(held, batch, "at")
    assert {(r.id, r.v) for r in once.collect()} == {("1", 10), ("2", 21), ("3", 31)}
    assert {tuple(r) for r in landing.upsert(once, batch, "at").collect()} == {tuple(r) for r in once.collect()}


def test_publish_moves_all_tables_at_once(spark, tmp_path):
    base = str(tmp_path / "snap")
    assert landing.current_version(spark, base) is None
    landing.publish(spark, base, "v1", {"a": spark.range(2), "b": spark.range(3)})
    landing.publish(spark, base, "v2", {"a": spark.range(5), "b": spark.range(6)})
    spark.range(9).write.parquet(f"{base}/v3/a")  # a crash before the pointer moved
    assert landing.read_published(spark, base, "a").count() == 5


def test_rollback_and_retention(spark, tmp_path):
    base = str(tmp_path / "snap")
    assert landing.publish(spark, base, "v1", {"a": spark.range(1), "b": spark.range(10)}) == 1
    assert landing.publish(spark, base, "v2", {"a": spark.range(2), "b": spark.range(20)}) == 2
    reader = landing.read_published(spark, base, "a", 2)
    assert landing.rollback(spark, base, 1) == 3
    # Both tables go back together, and a reader of the newer publication still has it.
    assert [landing.read_published(spark, base, n).count() for n in "ab"] == [1, 10]
    assert reader.count() == 2 and landing.read_published(spark, base, "b", 2).count() == 20
    assert landing.publish(spark, base, "v4", {"a": spark.range(4), "b": spark.range(40)}, kept=2) == 4
    assert landing.read_published(spark, base, "a").count() == 4
    # Publication 3 names v1, so v1 stays; v2 is named by none of the last two.
    assert landing.read_published(spark, base, "a", 3).count() == 1
    with pytest.raises(FileNotFoundError):
        landing.read_published(spark, base, "a", 2)
    with pytest.raises(FileNotFoundError):
        landing.rollback(spark, base, 2)


def test_money_and_config(spark, tmp_path):
    df = spark.createDataFrame([("3",), ("$488K",), ("$4.1M",), ("1,200",), ("",), ("#VALUE!",), ("n/a",)], "c string")
    got = [None if r[0] is None else float(r[0]) for r in df.select(parse.money("c")).collect()]
    assert got == [3.0, 488000.0, 4100000.0, 1200.0, None, None, None]
    path = tmp_path / "teams.json"
    path.write_text('{"note": "x",\n "ca_teams": [{"ca_team": "A", "parent_team": "P"}]}')
    assert [tuple(r) for r in landing.team_config(spark, str(path)).collect()] == [("A", "P")]


def test_deal_edges(spark):
    stages = spark.createDataFrame(
        [("p", "Sales", "s", "Closed", True, None), ("p", "Sales", "w", "Won", True, 1.0), ("r", "Renewals", "x", "Lost", True, 0.0)],
        "pipeline_id string, pipeline_label string, stage_id string, stage_label string, is_closed boolean, probability double")
    cls = deals.deal_stage_class(stages)
    assert {(r.stage_id, r["class"], r.loss_kind) for r in cls.collect()} == {("s", "lost", None), ("w", "won", None), ("x", "lost", "churn")}
    d = dt.datetime
    rows = [("1", "p", "w", d(2024, 1, 1), d(2023, 1, 1)), ("2", "r", "x", d(2024, 1, 1), d(2023, 1, 1))]
    held = spark.createDataFrame([(*r, d(2024, 2, 1)) for r in rows],
                                 "id string, pipeline string, dealstage string, closedate timestamp, createdate timestamp, last_seen_at timestamp")
    links = spark.createDataFrame([("1", "c"), ("2", "c")], "deal_id string, company_id string")
    cw = spark.createDataFrame([("c", "c")], "company_id string, resolved_company_id string")
    r = deals.account_deal_status(held, links, cw, cls, "2024-02-01").first()
    assert not r.is_customer and r.shield == "churned_recently"  # churn on the day of the last win


def test_guards(spark):
    import pytest

    owners = spark.createDataFrame([("1", "a@x.y", "A", "B", False, ["T"])],
                                   "id string, email string, first_name string, last_name string, archived boolean, teams array<string>")
    cfg = spark.createDataFrame([("T", "P")], "ca_team_name string, parent_team_name string")
    roster = identity.derive_roster(owners, cfg)
    assert [r.ca_id for r in roster.collect()] == ["1"]
    with pytest.raises(identity.RosterError):
        identity.guard_roster(roster, owners, cfg)
    with pytest.raises(quality.QualityError):
        quality.require_empty(spark.range(1), "rows left")


def test_stream_replay_adds_nothing(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id string, v int"
    spark.createDataFrame([("1", 1), ("2", 2)], schema).write.mode("append").parquet(src)
    live.append_stream(spark.readStream.schema(schema).parquet(src), out, str(tmp_path / "c1")).awaitTermination(60)
    spark.createDataFrame([("2", 2), ("3", 3)], schema).write.mode("append").parquet(src)
    live.append_stream(spark.readStream.schema(schema).parquet(src), out, str(tmp_path / "c1")).awaitTermination(60)
    live.append_stream(spark.readStream.schema(schema).parquet(src), out, str(tmp_path / "c2")).awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_registry_is_consistent():
    assert set(all_oracles()) <= set(all_queries()) == set(coverage())
    assert set(vocab.COUNTED_CHANNELS) <= set(vocab.CHANNELS)


def test_first_arrival_wins(spark):
    held = spark.createDataFrame([("a", 0, 0)], "id string, v int, n int")
    batch = spark.createDataFrame([("b", 1, 3), ("b", 2, 1), ("a", 9, 0), ("c", 5, 2)], "id string, v int, n int")
    assert sorted(tuple(r) for r in landing.append_absent(held, batch, arrival="n").collect()) == [("b", 2, 1), ("c", 5, 2)]
    assert {r.id: r.v for r in landing.append_absent(held, batch.coalesce(1)).collect()} == {"b": 1, "c": 5}


def test_last_publication_wins(spark, tmp_path):
    one = spark.range(1)
    landing.publish(spark, str(tmp_path), "v9", {"t": one})
    landing.publish(spark, str(tmp_path), "v10", {"t": one})
    assert landing.current_version(spark, str(tmp_path)) == "v10"


def test_upsert_stream_continues_on_a_new_checkpoint(spark, tmp_path):
    from touchgrid.sources import mirror
    from touchgrid.streaming.landing import append_stream, upsert_stream

    src, base = str(tmp_path / "src"), str(tmp_path / "mirror")
    schema = "id string, v int, modified int"
    for n, rows in enumerate(([("a", 1, 1)], [("b", 2, 1), ("a", 3, 2), ("b", 1, 0)])):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{src}{n}")
        stream = spark.readStream.schema(schema).parquet(f"{src}{n}")
        upsert_stream(stream, base, str(tmp_path / f"c{n}"), "modified").awaitTermination()
    got = mirror.read_mirror(spark, base, schema).collect()
    assert sorted(tuple(r) for r in got) == [("a", 3, 2), ("b", 2, 1)]
    for n in (0, 1, 1):
        stream = spark.readStream.schema(schema).parquet(f"{src}{n}")
        append_stream(stream, str(tmp_path / "log"), str(tmp_path / f"d{n}{len(str(got))}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_late_repeats_are_dropped(spark, tmp_path):
    from touchgrid.streaming.landing import fresh_rows

    rows = [("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 11:00:00"), ("b", "2024-01-02 10:00:00")]
    src = str(tmp_path / "s")
    spark.createDataFrame(rows, "id string, t string").selectExpr("id", "cast(t as timestamp) ts").write.parquet(src)
    stream = spark.readStream.schema("id string, ts timestamp").parquet(src)
    q = fresh_rows(stream, "ts").writeStream.format("memory").queryName("fresh").option("checkpointLocation", str(tmp_path / "k"))
    q.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.table("fresh").collect()) == ["a", "b"]


def _streamed(spark, tmp_path, df, transform, name):
    df.write.parquet(str(tmp_path / "in"))
    out = transform(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = out.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", str(tmp_path / "k"))
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).collect()


def test_daily_counts_as_a_stream(spark, tmp_path):
    rows = [("call", "2024-01-01 10:00:00", True), ("call", "2024-01-01 23:59:59", True), ("call", "2024-01-02 00:00:00", True),
            ("meeting", "2024-01-01 10:00:00", False)]
    df = spark.createDataFrame(rows, "channel string, t string, counts boolean").selectExpr("channel", "counts", "cast(t as timestamp) occurred_at")
    got = _streamed(spark, tmp_path, df, live.daily_channel_counts, "daily")
    assert sorted((str(r.day), r.channel, r.n) for r in got) == [("2024-01-01", "call", 2), ("2024-01-02", "call", 1)]


def test_dial_sessions_as_a_stream(spark, tmp_path):
    times = ["10:00:00", "10:20:00", "11:00:01", "10:29:59"]
    df = spark.createDataFrame([("u", "c", f"2024-01-01 {t}") for t in times], "user_id string, contact_id string, t string")
    df = df.selectExpr("user_id", "contact_id", "cast(t as timestamp) start_date")
    got = _streamed(spark, tmp_path, df, live.dial_sessions, "dials")
    assert sorted((str(r.first_dial)[11:], r.dials) for r in got) == [("10:00:00", 3), ("11:00:01", 1)]
