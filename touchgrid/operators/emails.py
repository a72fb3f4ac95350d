"""Collapse the copies several tools log for one sent or received message.

Two copies are mergeable when sender and direction agree, they lie within the window,
and either both are calendar invites with one subject, or they share a recipient and
their bodies match (subjects decide when a body is missing). Clusters are transitive,
with one guard: a merge that is not invite-with-invite needs a recipient that every
copy of both clusters has.

Plan:
1. Mergeable copies lie in one time island of a sender and direction. An island that ends inside
   its time chunk and is small is one row: `small_islands` lists its mergeable pairs and folds them.
   Most rows leave here, after one shuffle. The rest, and islands of any size, go on:
2. `merge_links` connects every copy to its nearest mergeable neighbours per shared
   key, which keeps the connectivity of the full pair set at a linear number of links.
3. Connected components of the links. Where all copies of a component share a
   recipient, the guard can never refuse, so the component is the cluster.
4. In the remaining components Spark joins the mergeable pairs, and `guarded_groups` takes them
   in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.functions.text import (
    bodies_match, extract_emails, is_internal, norm_body_prefix, norm_subject, sender_is_noise,
    subject_is_autoreply, subject_is_invite,
)
from touchgrid.operators.components import connected_components
from touchgrid.operators.contraction import fold, guarded_groups
from touchgrid.operators.keyed import DAY_SECONDS, id_order, micros, nulls_last, order_struct
from touchgrid.session import stored

LINK_CHUNK_SECONDS = 6 * 3600
#: Rows and recipients an island may have to be folded as one row.
ISLAND_ROWS, ISLAND_RECIPIENTS = 64, 2_000


def prep_emails(emails: DataFrame, internal_domains: Sequence[str]) -> DataFrame:
    """Fields every rule reads. Direction follows the sender's domain, never the owner."""
    sender = F.try_element_at(extract_emails("from_email"), F.lit(1))
    recipients = F.array_distinct(
        F.concat(extract_emails("to_email"), extract_emails("cc_email"), extract_emails("bcc_email"))
    )
    rows = emails.select(
        "id", F.col("hs_timestamp").alias("ts"), "activity_date", "subject",
        norm_subject("subject").alias("subject_norm"),
        norm_body_prefix("body_preview").alias("body_norm"), "body_preview",
        "object_source", "object_source_detail",
        sender.alias("sender"), recipients.alias("recipients"),
        subject_is_invite("subject").alias("is_invite"),
        subject_is_autoreply("subject").alias("_auto"),
    )
    outbound = F.coalesce(is_internal("sender", internal_domains), F.lit(False))
    return (
        rows.withColumn("external_recipients", F.filter("recipients", lambda a: ~is_internal(a, internal_domains)))
        .withColumn("direction", F.when(outbound, "outbound").otherwise("inbound"))
        .withColumn("is_noise", ~outbound & (sender_is_noise("sender") | F.col("_auto")))
        .drop("_auto")
    )


def stage_emails(emails: DataFrame, internal_domains: Sequence[str]) -> DataFrame:
    """Prepared rows written once and numbered (`rid`); the steps below read them several times."""
    return stored(prep_emails(emails, internal_domains).withColumn("rid", F.monotonically_increasing_id()))


def overlap_set(direction: Column, external: Column, everyone: Column) -> Column:
    """Recipients that can prove a copy: outside ones for sent mail, all for received."""
    return F.when(direction == "outbound", external).otherwise(everyone)


def mergeable(a: str, b: str, window: int = vocab.DEDUP_WINDOW_SECONDS) -> Column:
    """The pair rule as one expression over two struct columns of prepared rows."""
    x = lambda c: F.col(f"{a}.{c}")
    y = lambda c: F.col(f"{b}.{c}")
    near = F.abs(micros(x("ts")) - micros(y("ts"))) <= window * 1_000_000
    side = (x("sender") == y("sender")) & (x("direction") == y("direction"))
    invites = x("is_invite") & y("is_invite")
    same_subject = x("subject_norm") == y("subject_norm")
    shared = F.arrays_overlap(
        overlap_set(x("direction"), x("external_recipients"), x("recipients")),
        overlap_set(y("direction"), y("external_recipients"), y("recipients")),
    )
    text = F.when(
        x("body_norm").isNotNull() & y("body_norm").isNotNull(), bodies_match(x("body_norm"), y("body_norm"))
    ).otherwise(same_subject)
    return side & near & F.when(invites, same_subject & (x("subject_norm") != "")).otherwise(shared & text)


# -------------------------------------------------------------- small islands
def _alike(x: Column, y: Column) -> Column:
    """`mergeable` for two copies of one sender and direction within the window."""
    same_subject = x["subject"] == y["subject"]
    text = F.when(x["body"].isNotNull() & y["body"].isNotNull(), bodies_match(x["body"], y["body"])).otherwise(same_subject)
    return F.when(x["is_invite"] & y["is_invite"], same_subject & x["named"]).otherwise(
        F.arrays_overlap(x["who"], y["who"]) & text
    )


def copy_columns() -> list[Column]:
    """What `copy_facts` reads of a prepared row."""
    return [
        F.col("rid"), F.col("id"), micros("ts").alias("us"), F.col("is_invite"), F.col("is_noise"), F.col("object_source"),
        F.col("object_source_detail"), F.col("body_norm").isNull().alias("bare"), (F.size("recipients") == 0).alias("nobody"),
        F.try_element_at("external_recipients", F.lit(1)).alias("outside"),
    ]


def copy_facts(copies: DataFrame, *keys: str) -> DataFrame:
    """Per group its smallest id, the copy that represents it, and what all copies say together.

    The representative has a body, has recipients, is earliest, has the lowest id. Recipients are never
    gathered: the first outside one is a minimum over (time, id).
    """
    at = [*nulls_last("us"), id_order("id")]
    return copies.groupBy(*keys).agg(
        F.min("id").alias("cluster_id"),
        F.min_by(F.struct("rid", "id"), order_struct([F.col("bare"), F.col("nobody"), *at])).alias("can"),
        F.bool_or("is_invite").alias("is_invite"), F.bool_or("is_noise").alias("is_noise"),
        F.count(F.lit(1)).cast("int").alias("dup_count"),
        F.collect_set(F.struct("object_source", "object_source_detail")).alias("origins"),
        F.min_by("outside", F.when(F.col("outside").isNotNull(), order_struct(at))).alias("first_external"),
    )


def members(copies: Column | str) -> Column:
    return F.transform(copies, lambda x: F.struct(x["rid"].alias("rid"), x["id"].alias("id")))


def _array_facts(m: Column) -> list[Column]:
    """`copy_facts` of a group held as an array of copies."""
    rank = lambda x: F.struct(x["bare"], x["nobody"], x["us"], x["by"], x["rid"].alias("rid"), x["id"].alias("id"))
    first = F.array_min(F.transform(m, rank))
    sent = F.filter(m, lambda x: x["outside"].isNotNull())
    origin = lambda x: F.struct(
        x["object_source"].alias("object_source"), x["object_source_detail"].alias("object_source_detail")
    )
    return [
        F.array_min(F.transform(m, lambda x: x["id"])).alias("cluster_id"),
        F.struct(first["rid"].alias("rid"), first["id"].alias("id")).alias("can"),
        F.exists(m, lambda x: x["is_invite"]).alias("is_invite"), F.exists(m, lambda x: x["is_noise"]).alias("is_noise"),
        F.size(m).alias("dup_count"), F.array_distinct(F.transform(m, origin)).alias("origins"),
        F.array_min(F.transform(sent, lambda x: F.struct(x["us"], x["by"], x["outside"].alias("outside"))))["outside"].alias("first_external"),
    ]


def small_islands(
    prepped: DataFrame, window: int = vocab.DEDUP_WINDOW_SECONDS, most: int = ISLAND_ROWS, chunk_seconds: int = DAY_SECONDS,
    guarded: bool = True,
) -> DataFrame:
    """Groups of the rows with a time and a sender: `copy_facts`, whole, and members (rid, id).

    Without the guard a group is all that mergeable pairs connect.

    `whole` groups are decided. The others are single rows of islands that reach the end of their
    time chunk, or have more rows or recipients than fit into one row. Subjects and addresses travel
    as 64-bit hashes, which only meet inside an island; groups come straight out of the rows of islands.
    """
    span, reach = chunk_seconds * 1_000_000, window * 1_000_000
    who = overlap_set(F.col("direction"), F.col("external_recipients"), F.col("recipients"))
    rows = prepped.where(F.col("ts").isNotNull() & F.col("sender").isNotNull()).select(
        F.xxhash64(F.lit(1), "sender", "direction").alias("k1"), F.xxhash64(F.lit(2), "sender", "direction").alias("k2"),
        F.floor(micros("ts") / span).cast("long").alias("chunk"), *copy_columns(),
        F.xxhash64("subject_norm").alias("subject"), (F.col("subject_norm") != "").alias("named"),
        F.col("body_norm").alias("body"), F.transform(who, lambda a: F.xxhash64(a)).alias("who"),
    )
    place = ["k1", "k2", "chunk"]
    by_time = Window.partitionBy(*place).orderBy("us", "rid")
    gap = F.col("us") - F.lag("us").over(by_time)
    rows = rows.withColumn("starts", F.when(gap <= reach, 0).otherwise(1))
    rows = rows.withColumn("isle", F.sum("starts").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    isle = Window.partitionBy(*place, "isle")
    rows = rows.withColumns({
        "n": F.count(F.lit(1)).over(isle), "people": F.sum(F.size("who")).over(isle),
        "first": F.min("us").over(isle), "last": F.max("us").over(isle),
    })
    inside = (F.col("first") - F.col("chunk") * span > reach) & ((F.col("chunk") + 1) * span - F.col("last") > reach)
    rows = rows.withColumn("whole", inside & (F.col("n") <= most) & (F.col("people") <= ISLAND_RECIPIENTS))
    said = ("id", "is_noise", "object_source", "object_source_detail", "bare", "nobody", "outside")
    copy = F.struct("us", id_order("id").alias("by"), "rid", "is_invite", "subject", "named", "body", "who", *said)
    # A row that is not decided here is a group of its own, so that no large island is gathered.
    own = F.when(~F.col("whole"), F.col("rid")).alias("own")
    isles = rows.groupBy(*place, "isle", "whole", own).agg(F.array_sort(F.collect_list(copy)).alias("m"))

    def later(a: Column, i: Column) -> Column:
        near = F.filter(F.slice("m", i + 2, F.size("m")), lambda b: (b["us"] - a["us"] <= reach) & _alike(a, b))
        return F.transform(near, lambda b: F.struct(
            a["rid"].alias("x"), b["rid"].alias("y"), ((a["is_invite"] & b["is_invite"]) if guarded else F.lit(True)).alias("free")
        ))

    isles = isles.select("whole", "m", F.flatten(F.transform("m", later)).alias("e"))
    isles = isles.withColumn("top", fold("m.rid", "m.who", "e.x", "e.y", "e.free"))
    copies = F.arrays_zip("top", "m")
    of = F.transform(F.array_distinct("top"), lambda g: F.transform(F.filter(copies, lambda x: x["top"] == g), lambda x: x["m"]))
    return isles.select("whole", F.explode(of).alias("m")).select("whole", *_array_facts(F.col("m")), members("m").alias("members"))


# ---------------------------------------------------------------------- links
def _keyed_rows(prepped: DataFrame) -> DataFrame:
    """(key, hub, flagged, rid, us, sender, direction): one row per copy and shared key.

    Two rows of a key are mergeable when at least one is a hub and not both are flagged.
    """
    base = prepped.where(F.col("ts").isNotNull() & F.col("sender").isNotNull()).select(
        "rid", micros("ts").alias("us"), "sender", "direction", "is_invite", "subject_norm", "body_norm",
        overlap_set(F.col("direction"), F.col("external_recipients"), F.col("recipients")).alias("who"),
    )
    invites = base.where(F.col("is_invite") & (F.col("subject_norm") != "")).select(
        "rid", "us", "sender", "direction", F.struct(
            F.lit("invite").alias("kind"), F.lit("").alias("who"), F.col("subject_norm").alias("text")
        ).alias("key"), F.lit(True).alias("hub"), F.lit(False).alias("flagged"),
    )
    each = base.withColumn("r", F.explode("who"))
    has_body = F.col("body_norm").isNotNull()

    def rows(df: DataFrame, kind: str, text: str, hub: Column) -> DataFrame:
        key = F.struct(F.lit(kind).alias("kind"), F.col("r").alias("who"), F.col(text).alias("text"))
        return df.select("rid", "us", "sender", "direction", key.alias("key"), hub.alias("hub"),
                         F.col("is_invite").alias("flagged"))

    same_body = rows(each.where(has_body), "body", "body_norm", F.lit(True))
    subject = rows(each, "subject", "subject_norm", ~has_body)

    # a short body that starts a longer one: the longer rows look up only those prefix
    # lengths that exist for the same sender, recipient and opening characters
    least, full = vocab.BODY_PREFIX_MATCH_MIN, vocab.BODY_PREFIX_CHARS
    bodied = each.where(has_body & (F.length("body_norm") >= least)).withColumn("open", F.left("body_norm", F.lit(least)))
    place = ["sender", "direction", "r", "open"]
    short = bodied.where(F.length("body_norm") < full)
    lengths = short.groupBy(*place).agg(F.collect_set(F.length("body_norm")).alias("lens"))
    longer = (
        bodied.join(lengths, place)
        .withColumn("n", F.explode(F.filter("lens", lambda n: n < F.length("body_norm"))))
        .withColumn("prefix", F.left("body_norm", F.col("n")))
    )
    known = short.select("sender", "direction", "r", F.col("body_norm").alias("prefix")).distinct()
    tails = longer.join(known, ["sender", "direction", "r", "prefix"], "left_semi")
    used = tails.select("sender", "direction", "r", F.col("prefix").alias("body_norm")).distinct()
    heads = short.join(used, ["sender", "direction", "r", "body_norm"], "left_semi")
    prefix = rows(heads, "prefix", "body_norm", F.lit(True)).unionByName(rows(tails, "prefix", "prefix", F.lit(False)))
    return invites.unionByName(same_body).unionByName(subject).unionByName(prefix)


def merge_links(
    prepped: DataFrame, window: int = vocab.DEDUP_WINDOW_SECONDS, chunk_seconds: int = LINK_CHUNK_SECONDS
) -> DataFrame:
    """(a, b) links between copies, by row number; same connectivity as all mergeable pairs.

    Keys travel as two 64-bit hashes. A key's rows are cut into time chunks no shorter than
    the window (rows in a chunk's last `window` seconds are also shown to the next chunk), so
    one busy sender spreads over many tasks.
    """
    span, reach = max(chunk_seconds, window) * 1_000_000, window * 1_000_000
    chunk = F.floor(F.col("us") / span).cast("long")
    late = F.col("us") - chunk * span >= span - reach
    full_key = ("sender", "direction", "key")
    rows = _keyed_rows(prepped).select(
        "rid", "us", "hub", "flagged",
        F.xxhash64(F.lit(1), *full_key).alias("k1"), F.xxhash64(F.lit(2), *full_key).alias("k2"),
        F.explode(F.when(late, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))).alias("chunk"),
    )
    part = Window.partitionBy("k1", "k2", "chunk")
    ahead = part.orderBy(F.asc("us"), F.asc("rid")).rowsBetween(Window.unboundedPreceding, -1)
    back = part.orderBy(F.desc("us"), F.desc("rid")).rowsBetween(Window.unboundedPreceding, -1)
    me = F.struct("rid", "us")
    kinds = {
        "a0": F.col("hub") & ~F.col("flagged"),
        "a1": F.col("hub") & F.col("flagged"),
        "b0": ~F.col("hub") & ~F.col("flagged"),
    }
    rows = rows.withColumns(
        {f"p_{k}": F.last(F.when(c, me), ignorenulls=True).over(ahead) for k, c in kinds.items()}
    ).withColumns({f"n_{k}": F.last(F.when(c, me), ignorenulls=True).over(back) for k, c in kinds.items()})
    targets = (
        F.when(kinds["a0"], F.array("p_a0"))
        .when(kinds["a1"], F.array("p_a0", "n_a0", "p_b0", "n_b0"))
        .when(kinds["b0"], F.array("p_a0", "n_a0", "p_a1", "n_a1"))
        .otherwise(F.array("p_a0", "n_a0"))
    )
    return (
        rows.select("rid", "us", F.explode(targets).alias("t"))
        .where(F.abs(F.col("t.us") - F.col("us")) <= reach)
        .select(F.least("rid", F.col("t.rid")).alias("a"), F.greatest("rid", F.col("t.rid")).alias("b"))
        .where("a < b")
        .distinct()
    )


# ------------------------------------------------------------------- clusters
_PAIR_FIELDS = ("ts", "sender", "direction", "is_invite", "subject_norm", "body_norm", "external_recipients", "recipients")


def ordered_pairs(members: DataFrame, window: int) -> DataFrame:
    """(part, x, y, at, free) of mergeable pairs inside the given components.

    `x`/`y` are row numbers, `at` orders the pairs, and `free` marks invite pairs, which need no
    shared recipient. Each row looks for partners in its own time bucket and the next one.
    """
    place = F.struct(micros("ts").alias("us"), id_order("id").alias("by"))
    rows = members.select("component", "rid", place.alias("place"), F.struct(*_PAIR_FIELDS).alias("row"))
    span = window * 1_000_000 + 1
    bucket = F.floor(micros("row.ts") / span)
    early = rows.withColumn("b", F.explode(F.array(bucket, bucket + 1)))
    later = rows.select("component", bucket.alias("b"), F.col("place").alias("place2"), F.col("rid").alias("y"),
                        F.col("row").alias("row2"))
    met = early.join(later, ["component", "b"]).where(F.col("place") < F.col("place2"))
    return met.where(mergeable("row", "row2", window)).select(
        F.col("component").alias("part"), F.col("rid").alias("x"), "y", F.struct("place", "place2").alias("at"),
        (F.col("row.is_invite") & F.col("row2.is_invite")).alias("free"),
    )


class Clusters(NamedTuple):
    """Clusters of copies, one row each (`copy_facts`), and the copies: (rid, id, cluster_id, lead).

    `lead` is the rid of the copy that represents the cluster.
    """

    groups: DataFrame
    copies: DataFrame


def decide_emails(prepped: DataFrame, window: int = vocab.DEDUP_WINDOW_SECONDS, most: int = ISLAND_ROWS) -> Clusters:
    """Pass staged rows (`stage_emails`): they are read once per kind of key."""
    found = stored(small_islands(prepped, window, most))
    whole = found.where("whole").drop("whole")
    lone = prepped.where(F.col("ts").isNull() | F.col("sender").isNull()).select(*copy_columns(), F.col("rid").alias("top"))
    rest = stored(found.where("NOT whole").select("can.rid"))
    if not rest.isEmpty():
        few = stored(prepped.join(rest, "rid", "left_semi"))
        linked = few.select(*copy_columns()).join(_linked_groups(few, window), "rid", "left")
        lone = lone.unionByName(linked.withColumn("top", F.coalesce("top", "rid")))
    lone = stored(lone)
    told = stored(copy_facts(lone, "top"))
    place = ["cluster_id", F.col("can.rid").alias("lead")]
    copies = whole.select(F.explode("members").alias("c"), *place).select("c.rid", "c.id", "cluster_id", "lead")
    copies = copies.unionByName(lone.select("rid", "id", "top").join(told.select("top", *place), "top").drop("top"))
    return Clusters(whole.drop("members").unionByName(told.drop("top")), copies)


def cluster_emails(
    prepped: DataFrame, window: int = vocab.DEDUP_WINDOW_SECONDS, most: int = ISLAND_ROWS
) -> DataFrame:
    """(id, cluster_id) for every prepared row; cluster_id is the smallest member id."""
    return decide_emails(prepped, window, most).copies.select("id", "cluster_id")


def linked_emails(
    prepped: DataFrame, window: int = vocab.DEDUP_WINDOW_SECONDS, most: int = ISLAND_ROWS
) -> DataFrame:
    """(id, component) of staged rows: what mergeable pairs connect, without the guard; component is the smallest id.

    As in `decide_emails` only the rows of large islands, and of those at the end of a day, are linked by keys.
    """
    found = stored(small_islands(prepped, window, most, guarded=False).select("whole", "cluster_id", "members"))
    said = found.where("whole").select(F.explode("members.id").alias("id"), F.col("cluster_id").alias("component"))
    lone = prepped.where(F.col("ts").isNull() | F.col("sender").isNull()).select("id", F.col("id").alias("component"))
    rest = stored(found.where("NOT whole").select(F.explode("members.rid").alias("rid")))
    if not rest.isEmpty():
        few = stored(prepped.select("rid", "id", *_PAIR_FIELDS).join(rest, "rid", "left_semi"))
        comps = connected_components(merge_links(few, window)).withColumnRenamed("node", "rid")
        named = few.select("id", "rid").join(comps, "rid", "left").select("id", F.coalesce("component", "rid").alias("c"))
        least = named.groupBy("c").agg(F.min("id").alias("component"))
        lone = lone.unionByName(named.join(least, "c").select("id", "component"))
    return said.unionByName(lone)


def _linked_groups(prepped: DataFrame, window: int) -> DataFrame:
    """(rid, top) of rows that merge with others, in islands of any size."""
    links = merge_links(prepped, window)
    comps = stored(connected_components(links).withColumnRenamed("node", "rid"))
    who = overlap_set(F.col("direction"), F.col("external_recipients"), F.col("recipients"))
    members = prepped.join(comps, "rid").withColumn("who", who)

    # a component is settled when some recipient is on every one of its rows
    sizes = comps.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    widest = (
        members.select("component", F.explode("who").alias("r"))
        .groupBy("component", "r")
        .agg(F.count(F.lit(1)).alias("k"))
        .groupBy("component")
        .agg(F.max("k").alias("k"))
    )
    open_ = (
        sizes.join(widest, "component", "left")
        .where(F.col("k").isNull() | (F.col("k") < F.col("n")))
        .select("component")
    )
    open_ = stored(open_)
    grouped = comps.select("rid", F.col("component").alias("top"))
    if open_.isEmpty():
        return grouped
    settled = comps.join(open_, "component", "left_anti").select("rid", F.col("component").alias("top"))
    inside = stored(members.join(open_, "component", "left_semi"))
    people = inside.select(F.col("rid").alias("node"), F.explode(F.array_distinct("who")).alias("item"))
    return settled.unionByName(guarded_groups(ordered_pairs(inside, window), people).withColumnRenamed("node", "rid"))


# ------------------------------------------------------------- cluster summary
def summarize_clusters(
    prepped: DataFrame, clusters: Clusters, addresses: DataFrame, known_tools: Sequence[str] = vocab.KNOWN_SYNC_TOOLS,
) -> DataFrame:
    """All decisions of a cluster, taken over every copy of it.

    Only the representative's row is fetched whole. The first rep-owned recipient, which received mail
    alone needs, is a minimum over (time, id, position) of the recipients that some rep owns.
    """
    owned = addresses.where("ca_id IS NOT NULL").select("address", F.col("ca_id").alias("owner"))
    heard = prepped.where((F.col("direction") == "inbound") & F.col("sender").isNotNull())
    heard = heard.select("rid", "id", "ts", F.posexplode("recipients").alias("pos", "address")).join(owned, "address")
    at = order_struct([*nulls_last("ts"), id_order("id"), F.col("pos")])
    owners = heard.join(clusters.copies.select("rid", "lead"), "rid").groupBy("lead").agg(F.min_by("owner", at).alias("first_owner"))

    shown = ("ts", "activity_date", "subject", "subject_norm", "body_preview", "sender", "direction")
    rows = prepped.select(F.col("rid").alias("lead"), F.struct("id", *shown).alias("row"))
    j = clusters.groups.withColumn("lead", F.col("can.rid")).drop("can").join(rows, "lead").join(owners, "lead", "left")
    j = j.withColumnRenamed("row", "can")

    def tool(x: Column) -> Column:
        human = F.coalesce(x["object_source"].isin(*vocab.HUMAN_EMAIL_SOURCES), F.lit(False))
        return F.coalesce(~human & x["object_source_detail"].isin(*known_tools), F.lit(False))

    logged = F.transform("origins", lambda x: F.coalesce(x["object_source_detail"], x["object_source"], F.lit("unknown")))
    j = j.withColumns({"all_tool": F.forall("origins", tool), "logged_by": F.array_sort(F.array_distinct(logged))})
    j = j.join(
        addresses.select(F.col("address").alias("_sender"), F.col("ca_id").alias("sender_ca")),
        F.col("can.sender") == F.col("_sender"), "left",
    )
    no_sender = F.col("can.sender").isNull()
    out = ~no_sender & (F.col("can.direction") == "outbound")
    inb = ~no_sender & ~out
    ca_id = F.when(out, F.col("sender_ca")).when(inb, F.col("first_owner"))
    invite, noise = F.col("is_invite"), F.col("is_noise")
    channel = (
        F.when(no_sender, "inbound_email")
        .when(invite, "meeting")
        .when(out & F.col("all_tool"), "auto_email")
        .when(out, "manual_email")
        .otherwise("inbound_email")
    )
    reason = (
        F.when(no_sender, "no_sender")
        .when(invite, "invite_email")
        .when(out & ca_id.isNull(), "non_ca_sender")
        .when(out & F.col("first_external").isNull(), "internal_only_recipients")
        .when(inb & noise, "noise_auto_generated")
        .when(inb & ca_id.isNull(), "inbound_no_ca_recipient")
    )
    judged = out & ~invite
    return j.select(
        "cluster_id", "can",
        channel.alias("channel"),
        F.when(no_sender, "inbound").otherwise(F.col("can.direction")).alias("direction"),
        ca_id.alias("ca_id"),
        reason.isNull().alias("counts"),
        reason.alias("excluded_reason"),
        F.when(out, F.col("first_external")).when(inb, F.col("can.sender")).alias("contact_email"),
        F.when(judged, F.col("all_tool")).alias("is_automated"),
        F.when(judged, "low").alias("automated_confidence"),
        "dup_count", "logged_by",
    )
