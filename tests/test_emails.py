"""Copy collapsing: known cases and random data against a plain pairwise replay."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from touchgrid.operators import emails as em

INTERNAL = ("corp.example.com",)
T0 = dt.datetime(2024, 3, 1, 9, 0, 0)
SCHEMA = (
    "id string, hs_timestamp timestamp_ntz, subject string, from_email string, to_email string, cc_email string, "
    "bcc_email string, body_preview string, object_source string, object_source_detail string, activity_date date"
)


def mail(id_, sec, subject="Hello", sender="rep@corp.example.com", to="a@x.example.org", cc=None, body=None,
         source="INTEGRATION", detail="Sequencer"):
    ts = None if sec is None else T0 + dt.timedelta(seconds=sec)
    return (id_, ts, subject, sender, to, cc, None, body, source, detail, T0.date())


def groups(spark, rows, shuffle=False):
    if shuffle:
        rows = random.sample(rows, len(rows))
    df = spark.createDataFrame(rows, SCHEMA)
    out = em.cluster_emails(em.stage_emails(df, INTERNAL)).collect()
    by = {}
    for r in out:
        by.setdefault(r.cluster_id, set()).add(r.id)
    return sorted(sorted(g) for g in by.values())


def replay(spark, rows, window=180):
    """Every pair in order, union with the recipient guard."""
    p = [r.asDict() for r in em.prep_emails(spark.createDataFrame(rows, SCHEMA), INTERNAL).collect()]
    root = {r["id"]: r["id"] for r in p}
    common = {r["id"]: set(r["external_recipients"] if r["direction"] == "outbound" else r["recipients"]) for r in p}
    own = {k: set(v) for k, v in common.items()}
    live = sorted((r for r in p if r["ts"] and r["sender"]), key=lambda r: (r["ts"], int(r["id"])))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(live):
        for b in live[i + 1:]:
            if (a["sender"], a["direction"]) != (b["sender"], b["direction"]):
                continue
            if (b["ts"] - a["ts"]).total_seconds() > window:
                continue
            if a["is_invite"] and b["is_invite"]:
                ok = a["subject_norm"] and a["subject_norm"] == b["subject_norm"]
            elif not own[a["id"]] & own[b["id"]]:
                ok = False
            elif a["body_norm"] is not None and b["body_norm"] is not None:
                s, l = sorted((a["body_norm"], b["body_norm"]), key=len)
                ok = s == l or (len(s) >= 20 and l.startswith(s))
            else:
                ok = a["subject_norm"] == b["subject_norm"]
            if not ok:
                continue
            x, y = find(a["id"]), find(b["id"])
            if x == y:
                continue
            if a["is_invite"] and b["is_invite"]:
                both = common[x] | common[y]
            else:
                both = common[x] & common[y]
                if not both:
                    continue
            root[y], common[x] = x, both
    by = {}
    for r in p:
        by.setdefault(find(r["id"]), set()).add(r["id"])
    return sorted(sorted(g) for g in by.values())


def test_known_cases(spark):
    rows = [
        mail("1", 0, "Intro", body="same body text that is long enough"), mail("2", 5, "Re: Intro", body="same body text that is long enough"),
        # blast: one text, different people
        mail("10", 1000, "Blast", to="b1@x.example.org", body="blast body that is long enough"),
        mail("11", 1001, "Blast", to="b2@x.example.org", body="blast body that is long enough"),
        # window edges
        mail("20", 5000, "Edge", to="e@x.example.org"), mail("21", 5180, "Edge", to="e@x.example.org"),
        mail("22", 9000, "Edge2", to="e@x.example.org"), mail("23", 9181, "Edge2", to="e@x.example.org"),
        # invite fan-out to different people
        mail("30", 20000, "Invitation: Sync", to="p@x.example.org"), mail("31", 20008, "Invitation: Sync", to="q@x.example.org"),
        # signature on one copy; a short prefix is not enough
        mail("40", 30000, "S", to="s@x.example.org", body="please look at the attached plan"),
        mail("41", 30010, "S", to="s@x.example.org", body="please look at the attached plan -- regards"),
        mail("50", 40000, "T", to="t@x.example.org", body="thanks!"), mail("51", 40010, "T", to="t@x.example.org", body="thanks! one more"),
        # no time, no sender
        mail("60", None), mail("61", None), mail("62", 0, sender=None), mail("63", 0, sender=None),
    ]
    assert groups(spark, rows) == sorted(sorted(g) for g in [
        ["1", "2"], ["10"], ["11"], ["20", "21"], ["22"], ["23"], ["30", "31"], ["40", "41"], ["50"], ["51"],
        ["60"], ["61"], ["62"], ["63"],
    ])


def test_bridge_never_joins_two_sends(spark):
    rows = [
        mail("1", 0, to="a@x.example.org"), mail("2", 10, to="a@x.example.org; b@x.example.org"), mail("3", 20, to="b@x.example.org"),
    ]
    got = groups(spark, rows)
    assert got == replay(spark, rows)
    assert not any({"1", "3"} <= set(g) for g in got)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_replay(spark, seed):
    rng = random.Random(seed)
    people = [f"p{i}@x.example.org" for i in range(4)]
    bodies = [None, None, "short one", "the quick brown fox jumps over", "the quick brown fox jumps over the dog",
              "another body that is long enough"]
    rows = []
    for i in range(260):
        subject = rng.choice(["A", "Re: A", "B", "Invitation: A", "Accepted: A"])
        inbound = rng.random() < 0.3
        rows.append(mail(
            str(i + 1), rng.randrange(0, 12000), subject,
            sender="buyer@x.example.org" if inbound else rng.choice(["rep@corp.example.com", "two@corp.example.com"]),
            to="; ".join(rng.sample(people, rng.choice([1, 1, 2]))), body=rng.choice(bodies),
        ))
    want = replay(spark, rows)
    assert groups(spark, rows) == want
    assert groups(spark, rows, shuffle=True) == want
    assert any(len(g) > 2 for g in want)


def test_links_are_mergeable_pairs(spark):
    rng = random.Random(7)
    rows = [mail(str(i), rng.randrange(0, 3000), rng.choice(["A", "B", "Invitation: A"]),
                 to=rng.choice(["a@x.example.org", "b@x.example.org"]), body=rng.choice([None, "a body that is long enough"]))
            for i in range(120)]
    p = em.stage_emails(spark.createDataFrame(rows, SCHEMA), INTERNAL)
    links = em.merge_links(p)
    left = p.select(F.col("rid").alias("a"), F.struct("*").alias("x"))
    right = p.select(F.col("rid").alias("b"), F.struct("*").alias("y"))
    bad = links.join(left, "a").join(right, "b").where(~em.mergeable("x", "y"))
    assert links.count() > 0 and bad.count() == 0


def test_one_hot_sender_and_time(spark):
    rows = [mail(str(i), 7, "Hot", body="one and the same body for all") for i in range(300)]
    assert groups(spark, rows) == [sorted(str(i) for i in range(300))]


def test_window_longer_than_a_chunk(spark):
    hours = 3600
    rows = [mail("1", 0), mail("2", 13 * hours), mail("3", 26 * hours), mail("4", 41 * hours), mail("5", 90 * hours)]
    p = em.stage_emails(spark.createDataFrame(rows, SCHEMA), INTERNAL)
    got = {r.id: r.cluster_id for r in em.cluster_emails(p, window=14 * hours).collect()}
    assert got == {"1": "1", "2": "1", "3": "1", "4": "4", "5": "5"}
    assert groups(spark, rows) == [["1"], ["2"], ["3"], ["4"], ["5"]]


@pytest.mark.parametrize("most,chunk", [(64, 86_400), (3, 86_400), (64, 700), (0, 86_400)])
def test_islands_and_links_give_the_same_groups(spark, monkeypatch, most, chunk):
    """Small islands are decided as one row each; those cut by a chunk's end and large ones by links."""
    rng = random.Random(11)
    rows = [
        mail(str(i + 1), rng.randrange(0, 6000), rng.choice(["A", "Re: A", "Invitation: A"]),
             sender=rng.choice(["rep@corp.example.com", "two@corp.example.com", "buyer@x.example.org"]),
             to="; ".join(rng.sample(["a@x.example.org", "b@x.example.org", "c@x.example.org"], rng.choice([1, 2]))),
             body=rng.choice([None, "the quick brown fox jumps over", "the quick brown fox jumps over the dog"]))
        for i in range(70)
    ]
    whole = em.small_islands
    monkeypatch.setattr(em, "small_islands", lambda p, w, _: whole(p, w, most, chunk))
    staged = em.stage_emails(spark.createDataFrame(rows, SCHEMA), INTERNAL)
    decided = {r.whole for r in whole(staged, 180, most, chunk).collect()}
    assert decided == ({False} if most == 0 else {True} if (most, chunk) == (64, 86_400) else {True, False})
    assert groups(spark, rows) == replay(spark, rows)


def test_clusters_tell_what_their_copies_say(spark):
    """Groups of islands, of links and of rows without a time agree with one aggregate over their copies."""
    rng = random.Random(5)
    rows = [
        mail(str(i + 1), rng.choice([None, 40_000, 40_050, 53_990, 54_010, 70_000]), rng.choice(["A", "Re: A", "Invitation: A"]),
             sender=rng.choice(["rep@corp.example.com", "no-reply@x.example.org", None]), source=rng.choice(["EMAIL", "INTEGRATION", None]),
             to=rng.choice(["", "a@x.example.org", "ops@corp.example.com; b@x.example.org"]), detail=rng.choice(["Sequencer", "Other", None]),
             body=rng.choice([None, "the quick brown fox jumps over"]))
        for i in range(90)
    ]
    staged = em.stage_emails(spark.createDataFrame(rows, SCHEMA), INTERNAL)
    found = em.decide_emails(staged)
    assert found.copies.count() == found.copies.select("id").distinct().count() == len(rows)
    want = em.copy_facts(staged.select(*em.copy_columns()).join(found.copies.select("rid", "lead"), "rid"), "lead")
    assert want.where("can.rid <> lead").isEmpty()
    flat = lambda df: sorted(
        (r.cluster_id, tuple(r.can), r.is_invite, r.is_noise, r.dup_count, sorted(map(str, r.origins)), str(r.first_external))
        for r in df.collect()
    )
    assert flat(found.groups) == flat(want)


def test_shuffle_files_of_a_written_step_are_deleted(spark):
    held = lambda: sum(
        1 for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        ) if f.getName().startswith("shuffle_")
    )
    before = held()
    em.stored(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    assert held() <= before


@pytest.mark.parametrize("most", [64, 3])
def test_small_islands_are_linked_without_keys(spark, monkeypatch, most):
    """Components of merge_links over all rows, of which small islands now make no key rows."""
    rng = random.Random(13)
    rows = [
        mail(str(i + 1), rng.randrange(0, 9000), rng.choice(["A", "Re: A", "Invitation: A"]),
             sender=rng.choice(["rep@corp.example.com", "two@corp.example.com", "buyer@x.example.org"]),
             to="; ".join(rng.sample(["a@x.example.org", "b@x.example.org", "c@x.example.org"], rng.choice([1, 2]))),
             body=rng.choice([None, "the quick brown fox jumps over", "the quick brown fox jumps over the dog"]))
        for i in range(80)
    ]
    staged = em.stage_emails(spark.createDataFrame(rows, SCHEMA), INTERNAL)
    comps = em.connected_components(em.merge_links(staged)).withColumnRenamed("node", "rid")
    named = staged.join(comps, "rid", "left").select("id", F.coalesce("component", "rid").alias("c")).collect()
    want = {r.id: min(x.id for x in named if x.c == r.c) for r in named}
    linked, links = [], em.merge_links
    monkeypatch.setattr(em, "merge_links", lambda p, w: linked.append(p.count()) or links(p, w))
    got = em.linked_emails(staged, most=most).collect()
    assert len(got) == len(rows) and {r.id: r.component for r in got} == want
    assert sum(linked) < len(rows) and (most == 64) == (not linked)


def test_facts_without_bodies_leave_the_raw_rows_alone(spark):
    """Once clusters are decided, only queries that show bodies join the raw rows again."""
    from touchgrid.catalog import domain, facts, raw_reports

    t = domain.Domain(spark, "/root/testdata/sf0.001")
    reads = lambda df: df.drop("body_html")._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey")
    bare, full = facts.email_fact(t), facts.email_fact(t, bodies=True)
    assert reads(full) == reads(bare) + 1 and bare.dtypes == full.dtypes
    assert reads(raw_reports.flat(t, bodies=True)) == reads(raw_reports.flat(t)) + 1
    assert bare.drop("body_html").exceptAll(full.drop("body_html")).isEmpty() and bare.count() == full.count()
    assert not full.where("body_html IS NOT NULL").isEmpty() and bare.where("body_html IS NOT NULL").isEmpty()
