"""Registered landing and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.catalog import outcomes as oc
from touchgrid.catalog import reports as rp
from touchgrid.catalog.registry import query
from touchgrid.functions import parse
from touchgrid.plans import audit, meetings, model, quality, trends
from touchgrid.plans import scorecard as sc
from touchgrid.sources import landing, sheet

AS_OF = "2024-01-31"


@query("json_extraction", "A1", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, nullif(json_extract_string(props, '$.note'), '') AS note FROM {events}""")
def _(t):
    return landing.extract_record(t["events"], "props", "k bigint, note string", ["note"]).select("event_id", "k", "note")


@query("day_window_scan", "A2", "SELECT event_id FROM {events} WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'")
def _(t):
    return landing.day_window(t["events"], "ts", "2024-01-05 00:00:00", "2024-01-06 00:00:00").select("event_id")


@query("lookback_sweep", "A8 A2", "SELECT event_id FROM {events} WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-26' AND DATE '2024-01-30'")
def _(t):
    return landing.lookback_sweep(t["events"].withColumn("day", F.col("ts").cast("date")), "day", AS_OF).select("event_id")


WARM = "SELECT event_id, CASE WHEN event_type = 'error' THEN 'LemWarmup: hello' ELSE 'About ' || event_type END AS subject FROM {events}"


@query("warmup_filtered", "A3", "SELECT event_id, subject FROM {warm} WHERE NOT contains(lower(subject), 'lemwarm')", {"warm": WARM})
def _(t):
    return landing.split_warmup(t.sql(WARM))[0]


@query("warmup_tally", "A3", "SELECT count(*) AS fetched, count(*) FILTER (WHERE contains(lower(subject), 'lemwarm')) AS warmup FROM {warm}", {"warm": WARM})
def _(t):
    return landing.split_warmup(t.sql(WARM))[1]


HELD = """SELECT CASE WHEN o_orderstatus = 'O' THEN 'old' ELSE '' END || CAST(o_orderkey AS STRING) AS id, o_totalprice AS v,
  o_orderdate AS modified FROM {orders}"""
BATCH = """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'new' ELSE '' END || CAST(o_orderkey AS STRING) AS id, o_totalprice + 1 AS v,
  o_orderdate + INTERVAL '1' DAY AS modified FROM {orders}"""


@query("append_if_absent", "A4", "SELECT id, v FROM {batch} WHERE id NOT IN (SELECT id FROM {held})", {"held": HELD, "batch": BATCH})
def _(t):
    return landing.append_absent(t.sql(HELD), t.sql(BATCH)).select("id", "v")


LOG = "SELECT CAST(l_orderkey AS STRING) AS id, max(l_extendedprice) AS v, l_shipdate AS modified FROM {lineitem} GROUP BY l_orderkey, l_shipdate"


@query("upsert_latest", "A5", """
SELECT id, v FROM {held} WHERE id NOT IN (SELECT id FROM {log}) UNION ALL
SELECT id, arg_max(v, modified) FROM {log} GROUP BY 1""", {"held": HELD, "log": LOG})
def _(t):
    return landing.upsert(t.sql(HELD), t.sql(LOG), "modified").select("id", "v")


@query("changed_since_watermark", "A7", "SELECT id FROM {batch} WHERE modified >= (SELECT max(modified) - INTERVAL 1 HOUR FROM {held})",
       {"held": HELD, "batch": BATCH})
def _(t):
    return landing.changed_since(t.sql(BATCH), t.sql(HELD), "modified").select("id")


@query("link_table", "A10", "SELECT DISTINCT l_orderkey || ':' || l_suppkey AS id, l_orderkey, l_suppkey FROM {lineitem}")
def _(t):
    return landing.link_table(t["lineitem"], "l_orderkey", "l_suppkey")


@query("schema_evolution", "A20", """
SELECT o_orderkey AS id, o_totalprice AS v, CAST(NULL AS STRING) AS extra FROM {orders} UNION ALL
SELECT c_custkey, c_acctbal, c_mktsegment FROM {customer}""")
def _(t):
    return landing.merge_schemas(
        t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v")),
        t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"), F.col("c_mktsegment").alias("extra")),
    )


MONEY = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '$' || CAST(o_custkey AS STRING) || 'K'
  WHEN '2-HIGH' THEN '$1.' || CAST(o_custkey % 10 AS STRING) || 'M' WHEN '3-MEDIUM' THEN '#VALUE!' WHEN '5-LOW' THEN ' 1,' || lpad(CAST(o_custkey % 1000 AS STRING), 3, '0')
  ELSE '' END AS cell, o_custkey FROM {orders}"""


@query("money_parse", "A13", """
SELECT o_orderkey, CAST(CASE WHEN cell LIKE '$%K' THEN o_custkey * 1000 WHEN cell LIKE '$%M' THEN 1000000 + (o_custkey % 10) * 100000
  WHEN cell LIKE ' 1,%' THEN 1000 + o_custkey % 1000 END AS DOUBLE) AS amount FROM {cells}""", {"cells": MONEY})
def _(t):
    return t.sql(MONEY).select("o_orderkey", parse.money("cell").alias("amount"))


@query("date_parse", "A14 A15", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS m, CAST(o_orderdate AS DATE)::VARCHAR AS d,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts FROM {orders}""")
def _(t):
    d = F.col("o_orderdate")
    return t["orders"].select(
        "o_orderkey", parse.month(F.date_format(d, "MMM yyyy")).alias("m"), parse.day(F.date_format(d, "d MMM yyyy")).alias("d"),
        parse.timestamp(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("ts"),
    )


RUNS = """SELECT CAST(o_orderdate AS DATE) AS activity_date, CASE WHEN o_custkey % 2 = 0 THEN 'crm' ELSE 'dialer' END AS source,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'companies' WHEN '2-HIGH' THEN 'owners' ELSE 'emails' END AS object_type,
  o_orderdate + INTERVAL '5' DAY AS started_at,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL '5' DAY + INTERVAL '9' MINUTE END AS finished_at,
  o_custkey AS rows_fetched, o_custkey % 7 AS rows_new, o_custkey % 3 AS warm,
  CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'ok' END AS status FROM {orders}"""


def runs(t):
    return landing.run_log(t.sql(RUNS).withColumn("exclusion_breakdown", F.create_map(F.lit("warmup"), F.col("warm"))))


@query("run_rollup", "A16", """SELECT source, object_type, count(*) AS runs, CAST(sum(rows_fetched) AS BIGINT) AS rows_fetched,
  CAST(sum(rows_new) AS BIGINT) AS rows_new, CAST(sum(warm) AS BIGINT) AS rows_excluded, count(*) FILTER (WHERE status <> 'ok') AS failed
  FROM {runs} GROUP BY 1, 2""", {"runs": RUNS})
def _(t):
    return landing.run_rollup(runs(t))


@query("last_run", "F19", "SELECT strftime(max(finished_at), '%Y-%m-%d %H:%M:%S') AS finished_at FROM {runs} WHERE status = 'ok'", {"runs": RUNS})
def _(t):
    return audit.last_run(runs(t))


@query("last_daily_run", "F19", """SELECT strftime(max(finished_at), '%Y-%m-%d %H:%M:%S') AS finished_at FROM {runs}
WHERE status = 'ok' AND object_type IN ('companies','contacts','owners','users')""", {"runs": RUNS})
def _(t):
    return audit.last_daily_run(runs(t))


@query("active_run", "F19", """SELECT strftime(min(started_at), '%Y-%m-%d %H:%M:%S') AS started_at FROM {runs}
WHERE finished_at IS NULL AND started_at > TIMESTAMP '2001-08-01 01:00:00' - INTERVAL 2 HOUR HAVING count(*) > 0""", {"runs": RUNS})
def _(t):
    return audit.active_run(runs(t), F.lit("2001-08-01 01:00:00").cast("timestamp_ntz"))


@query("late_arrivals", "K8", """SELECT CAST(activity_date AS STRING) AS activity_date, source, rows_new FROM {runs}
WHERE date_diff('day', activity_date, CAST(started_at AS DATE)) >= 5 AND rows_new > 0""", {"runs": RUNS})
def _(t):
    return quality.late_arrivals(runs(t)).select("activity_date", "source", "rows_new")


# ---- monthly results sheet -----------------------------------------------------------
SHEET_ROWS = """SELECT s_nationkey AS sheet, s_suppkey, s_name, s_acctbal FROM {supplier}"""


def sheet_lines(t):
    """One exported sheet per nation: header, one line per rep and block, and a total line."""
    r = t.sql(SHEET_ROWS)
    pad = lambda *c: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in c])
    months = [F.lit("Jan 2024"), F.lit("Feb 2024")]
    furniture = [F.lit(""), F.lit("1 Jan 2023"), F.lit(""), F.lit(""), F.lit("Active"), F.lit("East")]
    per_sheet = r.select("sheet").distinct()
    top = per_sheet.select("sheet", F.lit(0).alias("line"), pad("", "SAOs Achieved", "", *furniture[:6], *months).alias("cells"))
    reps = r.select("sheet", (F.lit(1) + F.col("s_suppkey")).alias("line"), pad(
        "", F.col("s_name"), F.when(F.col("s_suppkey") % 2 == 0, "(Ramping)").otherwise(""), *furniture,
        (F.col("s_suppkey") % 9).cast("string"), F.lit("#VALUE!")).alias("cells"))
    total = r.groupBy("sheet").agg((F.sum(F.col("s_suppkey") % 9) + F.col("sheet") % 2).cast("string").alias("n")).select(
        "sheet", F.lit(10**8).alias("line"), pad("", "Overall", "", *furniture, F.col("n"), "").alias("cells"))
    cash = per_sheet.select("sheet", F.lit(10**9).alias("line"), pad("", "Pipeline Created", "", *furniture, *months).alias("cells"))
    money = r.select("sheet", (F.lit(10**9 + 1) + F.col("s_suppkey")).alias("line"), pad(
        "", F.col("s_name"), "", *furniture, F.concat(F.lit("$"), F.col("s_suppkey").cast("string"), F.lit("K")), F.lit("$1.5M")).alias("cells"))
    out = top
    for p in (reps, total, cash, money):
        out = out.unionByName(p)
    return out


@query("monthly_results", "A12 A13 A14", """
SELECT s_nationkey AS sheet, s_name AS rep_name, '2024-01-01' AS month, CAST(s_suppkey % 9 AS DOUBLE) AS saos, CAST(s_suppkey * 1000 AS DOUBLE) AS pipeline_usd,
  s_suppkey % 2 = 0 AS is_ramping, 'Active' AS status FROM {supplier}
UNION ALL SELECT s_nationkey, s_name, '2024-02-01', NULL, 1500000.0, s_suppkey % 2 = 0, 'Active' FROM {supplier}""")
def _(t):
    return sheet.monthly_results(sheet_lines(t)).select("sheet", "rep_name", "month", "saos", "pipeline_usd", "is_ramping", "status")


@query("sheet_checksum", "H10", """
SELECT s_nationkey AS sheet, '2024-01-01' AS month, CAST(sum(s_suppkey % 9) + s_nationkey % 2 AS DOUBLE) AS sheet_total,
  CAST(sum(s_suppkey % 9) AS DOUBLE) AS rep_total, s_nationkey % 2 = 0 AS matches FROM {supplier} GROUP BY s_nationkey""")
def _(t):
    lines = sheet_lines(t)
    return sheet.checksum(lines, sheet.monthly_results(lines))


@query("sheet_header_months", "A12", """
SELECT DISTINCT s_nationkey AS sheet, CASE WHEN s_nationkey % 5 = 0 THEN 0 ELSE 2 END AS months, s_nationkey % 5 <> 0 AS whole FROM {supplier}""")
def _(t):
    cut = sheet_lines(t).where("NOT (sheet % 5 = 0 AND line = 0)")
    return sheet.header_months(cut, 2)


ROSTER_SQL = """SELECT CASE WHEN CAST(ca_id AS BIGINT) % 17 = 3 THEN 'New ' || name ELSE name END AS name FROM {dim_ca} WHERE is_active"""


@query("sheet_roster_drift", "H10", f"""
SELECT s_name AS rep_name, TRUE AS in_sheet, FALSE AS in_roster FROM {{supplier}} WHERE s_name NOT IN (SELECT name FROM ({ROSTER_SQL}))
UNION ALL SELECT name, FALSE, TRUE FROM ({ROSTER_SQL}) WHERE name NOT IN (SELECT s_name FROM {{supplier}})""")
def _(t):
    return sheet.roster_drift(sheet.monthly_results(sheet_lines(t)), t.sql(ROSTER_SQL))


@query("results_vs_activity", "J11 E13", """
SELECT ca.ca_id, CAST(s_suppkey % 9 AS DOUBLE) AS saos, CAST(s_suppkey % 9 - coalesce(CASE WHEN s_suppkey % 3 = 0 THEN 1 END, 0) AS DOUBLE) AS saos_outbound,
  CAST(round(CAST((s_suppkey % 9) * 100 AS DECIMAL(18,4)) / nullif(s_suppkey % 4, 0), 0) AS DOUBLE) AS attainment_pct
FROM {dim_ca} ca JOIN {supplier} ON CAST(s_suppkey AS STRING) = ca.ca_id""")
def _(t):
    monthly = sc.rep_monthly_scorecard(t["activity"], t["dim_ca"], t["dim_account"], "2024-01-31")
    dec = lambda e: F.expr(f"CAST({e} AS DECIMAL(38,6))")
    res = t["supplier"].select(
        F.col("s_name").alias("rep_name"), F.lit("2024-01-01").cast("date").alias("month"), dec("s_suppkey % 9").alias("saos"),
        dec("s_suppkey % 4").alias("sao_target"), dec("CASE WHEN s_suppkey % 3 = 0 THEN 1 END").alias("saos_inbound"),
        dec("NULL").alias("saos_event"), F.lit(None).cast("boolean").alias("is_ramping"))
    split = monthly.select("month_start", "ca_name", F.lit(0).alias("meetings_new_stakeholder"),
                           F.lit(0).alias("meetings_follow_up"), F.lit(0).alias("meetings_no_account"))
    return trends.results_vs_activity(monthly, res, split).select("ca_id", "saos", "saos_outbound", "attainment_pct")


# ---- quality -----------------------------------------------------------------------------
SEEN = f"activity_date BETWEEN DATE '{oc.START}' AND DATE '{oc.END}'"


@query("lineage_breaks", "K1", """SELECT "table", id, CAST(1 AS BIGINT) AS held, CAST(0 AS BIGINT) AS used FROM (
  SELECT 'raw_calls' AS "table", id, human FROM {raw_calls}) WHERE human""")
def _(t):
    raw = t["raw_calls"].select(F.lit("raw_calls").alias("table"), "id")
    return quality.lineage_breaks(raw, model.row_sources(t["raw_calls"].where("NOT human"), "raw_calls", "call:"))


@query("undeclared_labels", "K2", "SELECT 'channel' AS kind, channel AS label, count(*) AS n FROM {activity} WHERE channel IN ('call', 'meeting') GROUP BY 2")
def _(t):
    return quality.undeclared_labels(t["activity"], [c for c in vocab.CHANNELS if c not in ("call", "meeting")])


@query("drill_reconciliation", "K3", f"""
SELECT ca_id, 'inbound_replies' AS measure, count(*) AS shown, CAST(0 AS BIGINT) AS drilled FROM {{activity}}
WHERE counts AND ca_id IS NOT NULL AND channel = 'inbound_email' AND {rp.IN_WIN} GROUP BY 1""")
def _(t):
    card = sc.rep_scorecard(t["activity"], t["dim_ca"], t["dim_account"], rp.START, rp.END)
    drilled = audit.drill_counts(t["activity"], t["dim_ca"], rp.START, rp.END)
    return quality.drill_mismatches(card, drilled.where("measure <> 'inbound_replies'"))


@query("account_drill_identity", "K5", f"""
SELECT c.ca_id, count(a.ca_id) FILTER (WHERE a.channel <> 'meeting') AS expected, count(a.ca_id) FILTER (WHERE a.channel <> 'meeting') AS drilled
FROM {{dim_ca}} c LEFT JOIN (SELECT * FROM {{activity}} WHERE counts AND {rp.IN_WIN}) a ON a.ca_id = c.ca_id GROUP BY 1""")
def _(t):
    card = sc.rep_scorecard(t["activity"], t["dim_ca"], t["dim_account"], rp.START, rp.END)
    return quality.account_drill_totals(card, rp.rep_accounts(t))


@query("partition_identities", "K4", f"""
SELECT ca.ca_id, CASE WHEN coalesce(m.held + m.canceled + m.scheduled + m.unknown, 0) <> coalesce(m.booked, 0) THEN 'outcomes'
    WHEN coalesce(b.fresh + b.later + b.unmapped, 0) <> coalesce(m.booked, 0) THEN 'buckets'
    WHEN coalesce(v.verified, 0) > coalesce(m.unknown, 0) THEN 'verified' ELSE 'ok' END AS rule
FROM {{dim_ca}} ca LEFT JOIN (
  SELECT ca_id, count(*) AS booked, count(*) FILTER (WHERE outcome = 'COMPLETED') AS held,
    count(*) FILTER (WHERE outcome = 'CANCELED') AS canceled, count(*) FILTER (WHERE outcome IN ('SCHEDULED', 'RESCHEDULED')) AS scheduled,
    count(*) FILTER (WHERE coalesce(outcome, '?') NOT IN ('COMPLETED', 'CANCELED', 'SCHEDULED', 'RESCHEDULED')) AS unknown
  FROM {{meetings}} WHERE counts AND channel = 'meeting' AND {SEEN} GROUP BY ca_id) m ON m.ca_id = ca.ca_id
LEFT JOIN (
  SELECT ca_id, count(*) FILTER (WHERE bucket = 'new_stakeholder') AS fresh, count(*) FILTER (WHERE bucket = 'follow_up') AS later,
    count(*) FILTER (WHERE bucket = 'no_account') AS unmapped FROM {{flags}} WHERE {SEEN} GROUP BY ca_id) b ON b.ca_id = ca.ca_id
LEFT JOIN (
  SELECT m.ca_id, count(*) AS verified FROM {{meetings}} m JOIN {{verified}} w ON w.activity_id = m.activity_id
  WHERE m.counts AND {SEEN} AND coalesce(m.outcome, '?') NOT IN ('COMPLETED', 'CANCELED', 'SCHEDULED', 'RESCHEDULED')
  GROUP BY m.ca_id) v ON v.ca_id = ca.ca_id""", oc.MAP_VIEWS)
def _(t):
    card = sc.rep_scorecard(t.sql(rp.MEETING_FACT_SQL), t["dim_ca"], t["dim_account"], oc.START, oc.END)
    split = meetings.rep_meeting_breakdown(oc.flags(t), t["dim_ca"], oc.START, oc.END)
    held = trends.held_with_verified(card, meetings.verified_unknown(t["meetings"], oc.verification(t), oc.START, oc.END))
    breaks = quality.identity_breaks(card, split, held)
    return card.select("ca_id").join(breaks, "ca_id", "left").select("ca_id", F.coalesce("rule", F.lit("ok")).alias("rule"))


@query("content_fingerprint", "K6")
def _(t):
    return quality.fingerprint(t["activity"])


EDITED = """SELECT activity_date, CASE WHEN activity_date = DATE '2024-01-10' AND channel = 'call' THEN NULL ELSE ca_id END AS ca_id,
  channel, counts FROM {activity} WHERE NOT (activity_date = DATE '2024-01-12' AND channel = 'meeting') AND activity_date <> DATE '2024-01-25'"""
DAY_COUNTS = "SELECT activity_date, ca_id, channel, count(*) AS n FROM {rows} WHERE counts GROUP BY ALL"


@query("settled_changes", "K6", """
SELECT CAST(activity_date AS STRING) AS activity_date, ca_id, channel, CAST(sum(was) AS BIGINT) AS was, CAST(sum(is_now) AS BIGINT) AS is FROM (
  SELECT activity_date, ca_id, channel, n AS was, 0 AS is_now FROM {before} UNION ALL SELECT activity_date, ca_id, channel, 0, n FROM {after})
WHERE activity_date <= DATE '2024-01-20' GROUP BY activity_date, ca_id, channel HAVING sum(was) <> sum(is_now)""", {
    "edited": EDITED, "before": DAY_COUNTS.replace("{rows}", "{activity}"), "after": DAY_COUNTS.replace("{rows}", "{edited}")})
def _(t):
    return quality.settled_changes(quality.day_counts(t["activity"]), quality.day_counts(t.sql(EDITED)), "2024-01-20")


@query("silent_days", "K7", """SELECT CAST(d AS STRING) AS day FROM (SELECT CAST(unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS d)
WHERE d NOT IN (SELECT activity_date FROM {activity})""")
def _(t):
    return quality.silent_days(t["activity"], "2023-12-25", "2024-02-05")
