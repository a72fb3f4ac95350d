"""Registered scorecard and drill-down queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchgrid.catalog import outcomes as oc
from touchgrid.catalog.domain import ACTIVITY_AS_OF as AS_OF
from touchgrid.catalog.registry import query
from touchgrid.functions.text import contains_text
from touchgrid.plans import audit, trends
from touchgrid.plans import drilldown as dd
from touchgrid.plans import meetings as mt
from touchgrid.plans import scorecard as sc
from touchgrid.vocab import EMAIL_CHANNELS, NO_ACCOUNT

START, END = "2024-01-08", "2024-01-21"

MEASURES_SQL = """
count(*) FILTER (WHERE channel = 'auto_email') AS auto_email,
count(*) FILTER (WHERE channel = 'manual_email') AS manual_email,
count(*) FILTER (WHERE channel IN ('auto_email','manual_email')) AS emails,
count(*) FILTER (WHERE channel = 'call') AS dials,
count(DISTINCT call_group_id) FILTER (WHERE channel = 'call') AS pursuits,
count(*) FILTER (WHERE channel = 'call' AND is_conversation) AS conversations,
count(*) FILTER (WHERE starts_with(channel, 'li_')) AS linkedin,
count(*) FILTER (WHERE channel = 'li_connect') AS li_connect,
count(*) FILTER (WHERE channel = 'li_message') AS li_message,
count(*) FILTER (WHERE channel = 'li_other') AS li_other,
count(*) FILTER (WHERE channel IN ('whatsapp','sms','other')) AS other_outreach,
count(*) FILTER (WHERE channel = 'inbound_email') AS inbound_replies,
count(*) FILTER (WHERE channel = 'meeting') AS meetings_booked,
count(*) FILTER (WHERE channel = 'meeting' AND outcome = 'COMPLETED') AS meetings_held,
count(*) FILTER (WHERE channel = 'meeting' AND outcome = 'CANCELED') AS meetings_canceled,
count(*) FILTER (WHERE channel = 'meeting' AND outcome IN ('SCHEDULED','RESCHEDULED')) AS meetings_scheduled,
count(*) AS total_counted,
count(DISTINCT company_id) AS accounts_touched,
count(DISTINCT contact_id) AS contacts_touched,
count(DISTINCT company_id) FILTER (WHERE owner_rep_id = ca_id) AS owned_touched
"""
ZEROED = (
    "auto_email manual_email emails dials pursuits conversations linkedin li_connect li_message li_other "
    "other_outreach inbound_replies meetings_booked meetings_held meetings_canceled meetings_scheduled "
    "total_counted accounts_touched contacts_touched owned_touched"
).split()
FINAL_SQL = (
    ", ".join(f"coalesce(p.{m}, 0) AS {m}" for m in ZEROED)
    + """, coalesce(p.meetings_booked - p.meetings_held - p.meetings_canceled - p.meetings_scheduled, 0) AS meetings_unknown,
CAST(round(CAST(p.contacts_touched AS DECIMAL(20,0)) / nullif(p.accounts_touched, 0), 1) AS DOUBLE) AS contacts_per_account,
coalesce(o.accounts_owned, 0) AS accounts_owned,
CAST(round(100.0 * coalesce(p.owned_touched, 0) / nullif(o.accounts_owned, 0), 1) AS DOUBLE) AS coverage_pct"""
)
OWNED_SQL = "SELECT owner_rep_id AS ca_id, count(*) AS accounts_owned FROM {dim_account} WHERE owner_rep_id IS NOT NULL GROUP BY 1"
COUNTED_SQL = """SELECT a.*, d.owner_rep_id FROM {activity} a
LEFT JOIN {dim_account} d ON d.account_id = a.company_id WHERE a.counts AND a.ca_id IS NOT NULL"""


def scorecard_sql(where: str) -> str:
    return f"""
SELECT ca.ca_id, ca.name AS ca_name, {FINAL_SQL}
FROM {{dim_ca}} ca
LEFT JOIN (SELECT ca_id, {MEASURES_SQL} FROM {{counted}} WHERE {where} GROUP BY ca_id) p ON p.ca_id = ca.ca_id
LEFT JOIN {{owned}} o ON o.ca_id = ca.ca_id
"""


SC_VIEWS = {"counted": COUNTED_SQL, "owned": OWNED_SQL}


def _tables(t):
    return t["activity"], t["dim_ca"], t["dim_account"]


@query("rep_scorecard_alltime", "F1 F2 F3 F4 F5 F6 F7",
       scorecard_sql(f"activity_date BETWEEN DATE '2000-01-01' AND DATE '{AS_OF}'"), SC_VIEWS)
def _(t):
    return sc.rep_scorecard_alltime(*_tables(t), AS_OF)


@query("rep_scorecard_window", "F1",
       scorecard_sql(f"activity_date BETWEEN DATE '{START}' AND DATE '{END}'"), SC_VIEWS)
def _(t):
    return sc.rep_scorecard(*_tables(t), START, END)


@query("rep_scorecard_7d", "F7",
       scorecard_sql(f"activity_date BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}' - 1"), SC_VIEWS)
def _(t):
    return sc.rep_scorecard_7d(*_tables(t), AS_OF)


@query("rep_scorecard_30d", "F7",
       scorecard_sql(f"activity_date BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' - 1"), SC_VIEWS)
def _(t):
    return sc.rep_scorecard_30d(*_tables(t), AS_OF)


def period_sql(period: str) -> str:
    step, end = ("7 DAY", "+ 6") if period == "week" else ("1 MONTH", "")
    end_sql = "w.s + 6" if period == "week" else "last_day(w.s)"
    return f"""
SELECT CAST(w.s AS STRING) AS {period}_start, CAST({end_sql} AS STRING) AS {period}_end,
       ca.ca_id, ca.name AS ca_name, {FINAL_SQL}
FROM (SELECT CAST(unnest(generate_series(
        (SELECT date_trunc('{period}', min(activity_date)) FROM {{activity}}),
        date_trunc('{period}', DATE '{AS_OF}'), INTERVAL {step})) AS DATE) AS s) w
CROSS JOIN {{dim_ca}} ca
LEFT JOIN (SELECT CAST(date_trunc('{period}', activity_date) AS DATE) AS s, ca_id, {MEASURES_SQL}
           FROM {{counted}} GROUP BY 1, 2) p ON p.ca_id = ca.ca_id AND p.s = w.s
LEFT JOIN {{owned}} o ON o.ca_id = ca.ca_id
"""


@query("rep_weekly_trend", "F15 E9 B18", period_sql("week"), SC_VIEWS)
def _(t):
    return sc.rep_weekly_trend(*_tables(t), AS_OF)


@query("rep_monthly_scorecard", "F15 E9 B18", period_sql("month"), SC_VIEWS)
def _(t):
    return sc.rep_monthly_scorecard(*_tables(t), AS_OF)


WINDOWS_SQL = """
WITH r AS (SELECT min(activity_date) AS f, max(activity_date) AS l FROM {activity} WHERE counts),
m AS (SELECT CAST(unnest(generate_series(date_trunc('month', f), date_trunc('month', l), INTERVAL 1 MONTH)) AS DATE) AS s, f, l FROM r)
SELECT 'Last 7 days' AS win, greatest(l - 6, f) AS a, l AS b FROM r
UNION ALL SELECT 'Last 30 days', greatest(l - 29, f), l FROM r
UNION ALL SELECT 'All time', f, l FROM r
UNION ALL SELECT strftime(s, '%b %Y'), greatest(s, f), least(last_day(s), l) FROM m
"""


@query("multi_window_scorecard", "J12", f"""
SELECT w.win AS "window", CAST(w.a AS STRING) AS window_start, CAST(w.b AS STRING) AS window_end,
       ca.ca_id, ca.name AS ca_name, {FINAL_SQL}
FROM {{wins}} w CROSS JOIN {{dim_ca}} ca
LEFT JOIN (SELECT win, ca_id, {MEASURES_SQL} FROM {{counted}} JOIN {{wins}} ON activity_date BETWEEN a AND b
           GROUP BY 1, 2) p ON p.ca_id = ca.ca_id AND p.win = w.win
LEFT JOIN {{owned}} o ON o.ca_id = ca.ca_id
""", {**SC_VIEWS, "wins": WINDOWS_SQL})
def _(t):
    return sc.multi_window_scorecard(*_tables(t))


@query("team_distincts", "F11", f"""
SELECT count(DISTINCT company_id) AS accounts_touched, count(DISTINCT contact_id) AS contacts_touched
FROM {{activity}} WHERE counts AND ca_id IS NOT NULL AND activity_date BETWEEN DATE '{START}' AND DATE '{END}'
""")
def _(t):
    return sc.team_distincts(t["activity"], START, END)


_db = [k for k, kind, _ in sc.LAYOUT if kind == "db"]
_layout_cols = ", ".join(f"CAST({k} AS BIGINT) AS {k}" for k in _db)
_layout_sql = (
    f"SELECT ca_name, {_layout_cols}, CAST(auto_email + manual_email AS BIGINT) AS emails, "
    "CAST(round(CAST(owned_touched AS DECIMAL(18,0)) / nullif(accounts_owned, 0), 6) AS DOUBLE) AS coverage_pct FROM "
)
CARD_VIEWS = {**SC_VIEWS, "card": scorecard_sql(f"activity_date BETWEEN DATE '{START}' AND DATE '{END}'")}


@query("scorecard_layout", "A19", _layout_sql + "{card}", CARD_VIEWS)
def _(t):
    return sc.scorecard_layout(sc.rep_scorecard(*_tables(t), START, END))


_sums = ", ".join(
    f"sum({k}) AS {k}" for k in _db if k not in ("accounts_touched", "contacts_touched")
)


@query("scorecard_with_total", "F12 A19", _layout_sql + "{card} UNION ALL BY NAME " + _layout_sql + f"""
(SELECT 'All ' || count(*) || ' reps' AS ca_name, {_sums},
  (SELECT count(DISTINCT company_id) FROM {{counted}} WHERE activity_date BETWEEN DATE '{START}' AND DATE '{END}') AS accounts_touched,
  (SELECT count(DISTINCT contact_id) FROM {{counted}} WHERE activity_date BETWEEN DATE '{START}' AND DATE '{END}') AS contacts_touched
 FROM {{card}})""", CARD_VIEWS)
def _(t):
    return sc.scorecard_with_total(*_tables(t), START, END)


# ------------------------------------------------------------------ drill-downs
IN_WIN = f"activity_date BETWEEN DATE '{START}' AND DATE '{END}'"
TOUCH = f"counts AND channel <> 'meeting' AND ca_id IS NOT NULL AND {IN_WIN}"
CHANNEL_COUNTS = {
    "auto_email": "channel = 'auto_email'", "manual_email": "channel = 'manual_email'",
    "emails": "channel IN ('auto_email','manual_email')", "calls": "channel = 'call'",
    "linkedin": "starts_with(channel, 'li_')", "inbound_replies": "channel = 'inbound_email'",
    "other_outreach": "channel IN ('whatsapp','sms','other')",
}


def ch_sql(*names):
    return ", ".join(f"count(*) FILTER (WHERE {CHANNEL_COUNTS[n]}) AS {n}" for n in names)


DD_VIEWS = {
    "rep_accounts": f"""SELECT a.ca_id, a.ca_name, a.company_id AS account_id,
        coalesce(a.account_name, '{NO_ACCOUNT}') AS account_name, a.account_domain,
        a.account_icp_tier_validated AS icp_tier, d.owner_rep_id AS owned_by_rep_id,
        d.owner_rep_id = a.ca_id AS owned_by_this_rep, count(*) AS touchpoints,
        count(DISTINCT a.contact_id) AS people_touched,
        {ch_sql('auto_email', 'manual_email', 'calls', 'linkedin', 'inbound_replies', 'other_outreach')},
        CAST(min(a.activity_date) AS STRING) AS first_touch, CAST(max(a.activity_date) AS STRING) AS last_touch
        FROM {{activity_flat}} a LEFT JOIN {{dim_account}} d ON d.account_id = a.company_id WHERE {TOUCH}
        GROUP BY a.ca_id, a.ca_name, a.company_id, a.account_name, a.account_domain,
                 a.account_icp_tier_validated, d.owner_rep_id""",
    "coverage": f"""SELECT ca.ca_id AS owner_ca_id, ca.name AS owner_name, d.account_id, d.name AS account_name,
        d.domain AS account_domain, d.icp_tier_validated AS icp_tier, d.vertical,
        count(w.company_id) FILTER (WHERE w.ca_id = ca.ca_id) AS owner_touches,
        CAST(max(w.activity_date) FILTER (WHERE w.ca_id = ca.ca_id) AS STRING) AS owner_last_touch,
        count(w.company_id) AS team_touches, CAST(max(w.activity_date) AS STRING) AS team_last_touch,
        count(DISTINCT w.ca_id) AS team_reps
        FROM {{dim_account}} d JOIN {{dim_ca}} ca ON ca.ca_id = d.owner_rep_id
        LEFT JOIN (SELECT company_id, ca_id, activity_date FROM {{activity}}
                   WHERE {TOUCH} AND company_id IS NOT NULL) w ON w.company_id = d.account_id
        GROUP BY ca.ca_id, ca.name, d.account_id, d.name, d.domain, d.icp_tier_validated, d.vertical""",
    "sparse_coverage": f"""SELECT ca.ca_id AS owner_ca_id, ca.name AS owner_name, d.account_id,
        d.name AS account_name, d.icp_tier_validated AS icp_tier, d.vertical,
        count(w.company_id) FILTER (WHERE w.ca_id = ca.ca_id) AS owner_touches,
        count(w.company_id) AS team_touches
        FROM {{dim_account}} d JOIN {{dim_ca}} ca ON ca.ca_id = d.owner_rep_id
        LEFT JOIN (SELECT company_id, ca_id FROM {{activity}} WHERE counts AND channel <> 'meeting'
                   AND ca_id IS NOT NULL AND company_id IS NOT NULL
                   AND activity_date BETWEEN DATE '2024-01-20' AND DATE '2024-01-21') w
          ON w.company_id = d.account_id
        GROUP BY ca.ca_id, ca.name, d.account_id, d.name, d.icp_tier_validated, d.vertical""",
}


def rep_accounts(t):
    return dd.rep_account_drilldown(t["activity_flat"], t["dim_account"], START, END)


def coverage(t, start=START, end=END):
    return dd.owned_account_coverage(t["activity"], t["dim_account"], t["dim_ca"], start, end)


@query("rep_account_drilldown", "F8", "SELECT * FROM {rep_accounts}", DD_VIEWS)
def _(t):
    return rep_accounts(t)


@query("account_contact_drilldown", "F9 B17", f"""
SELECT ca_id, ca_name, company_id AS account_id, coalesce(account_name, '{NO_ACCOUNT}') AS account_name,
       account_icp_tier_validated AS icp_tier, contact_id,
       nullif(trim(coalesce(contact_firstname, '') || ' ' || coalesce(contact_lastname, '')), '') AS contact_name,
       contact_email, contact_jobtitle AS jobtitle, count(*) AS touchpoints,
       {ch_sql('emails', 'calls', 'linkedin', 'inbound_replies')}, CAST(max(activity_date) AS STRING) AS last_touch
FROM {{activity_flat}} WHERE {TOUCH} AND contact_id IS NOT NULL
GROUP BY ca_id, ca_name, company_id, account_name, account_icp_tier_validated, contact_id, contact_firstname,
         contact_lastname, contact_email, contact_jobtitle""")
def _(t):
    return dd.account_contact_drilldown(t["activity_flat"], START, END)


@query("owned_account_coverage", "F10", "SELECT * FROM {coverage}", DD_VIEWS)
def _(t):
    return coverage(t)


@query("owned_summary", "F13 G9 B21", """
SELECT owner_name, count(*) AS owned, count(*) FILTER (WHERE owner_touches > 0) AS touched,
       count(*) FILTER (WHERE owner_touches = 0 AND icp_tier IN ('Tier 0','Tier 1')) AS top_untouched,
       count(*) FILTER (WHERE owner_touches = 0) AS untouched,
       CAST(round(100.0 * count(*) FILTER (WHERE owner_touches > 0) / count(*), 1) AS DOUBLE) AS coverage_pct
FROM {coverage} GROUP BY owner_name""", DD_VIEWS)
def _(t):
    return dd.owned_summary(coverage(t))


@query("neglect_order", "F14 G9", """
SELECT owner_name, account_id, icp_tier, team_touches, CAST(CASE icp_tier WHEN 'Tier 0' THEN 0 WHEN 'Tier 1' THEN 1
       WHEN 'Tier 2' THEN 2 WHEN 'Tier 3' THEN 3 WHEN 'Tier 4' THEN 4 ELSE 9 END AS BIGINT) AS tier_rank
FROM {coverage} ORDER BY tier_rank, team_touches, owner_name""", DD_VIEWS)
def _(t):
    return dd.neglect_order(coverage(t)).select("owner_name", "account_id", "icp_tier", "team_touches", "tier_rank")


@query("touch_depth_buckets", "J5", f"""
SELECT ca_name, CASE WHEN touchpoints <= 9 THEN '1-9' WHEN touchpoints <= 24 THEN '10-24'
  WHEN touchpoints <= 49 THEN '25-49' WHEN touchpoints <= 99 THEN '50-99' ELSE '100+' END AS bucket,
  count(*) AS accounts FROM {{rep_accounts}} WHERE account_name <> '{NO_ACCOUNT}' GROUP BY 1, 2""", DD_VIEWS)
def _(t):
    return dd.depth_buckets(rep_accounts(t))


@query("share_of_total", "J7", f"""
SELECT r.ca_id, r.ca_name, r.account_id, r.account_name, r.touchpoints, CAST(s.n AS BIGINT) AS rep_touches,
       CAST(round(100.0 * r.touchpoints / s.n, 1) AS DOUBLE) AS share_pct
FROM {{rep_accounts}} r JOIN (SELECT ca_id, sum(touchpoints) AS n FROM {{rep_accounts}} GROUP BY 1) s ON s.ca_id = r.ca_id
WHERE r.account_name <> '{NO_ACCOUNT}'""", DD_VIEWS)
def _(t):
    return dd.share_of_total(rep_accounts(t))


@query("top_accounts_of_rep", "G7 J7", f"""
SELECT account_name, touchpoints, people_touched FROM {{rep_accounts}}
WHERE ca_name = 'Supplier#000000008' AND account_name <> '{NO_ACCOUNT}'
ORDER BY touchpoints DESC, account_name LIMIT 15""", DD_VIEWS)
def _(t):
    return dd.top_accounts(t["activity_flat"], t["dim_account"], "Supplier#000000008", START, END).select(
        "account_name", "touchpoints", "people_touched")


# ---------------------------------------------------------------------- audit
def flat(t):
    return t["activity_flat"].withColumn("logged_by", F.split("logged_by_text", ";"))


PEEK_SQL = """SELECT activity_id, CAST(activity_date AS STRING) AS activity_date, ca_name, channel, account_name, subject,
  contact_email, strftime(occurred_at, '%Y-%m-%d %H:%M:%S') AS occurred_at, (SELECT count(*) FROM {rows}) AS total
  FROM {rows} ORDER BY {rows}.occurred_at DESC, activity_id LIMIT 8"""
ACTIVE_SQL = "ca_name IN (SELECT name FROM {dim_ca} WHERE is_active)"


@query("drill_rows_peek", "J13 G2 E10", PEEK_SQL, {
    "rows": f"SELECT * FROM {{activity_flat}} WHERE counts AND {IN_WIN} AND {ACTIVE_SQL} "
            "AND channel IN ('auto_email','manual_email')"})
def _(t):
    return audit.peek(audit.drill_rows(flat(t), t["dim_ca"], START, END, channels=EMAIL_CHANNELS))


@query("drill_rows_account_outcome", "J13", PEEK_SQL, {
    "rows": f"SELECT * FROM {{activity_flat}} WHERE counts AND {IN_WIN} AND {ACTIVE_SQL} "
            f"AND channel = 'meeting' AND coalesce(account_name, '{NO_ACCOUNT}') = '{NO_ACCOUNT}' "
            "AND outcome = 'COMPLETED'"})
def _(t):
    return audit.peek(audit.drill_rows(
        flat(t), t["dim_ca"], START, END, channels=("meeting",), account=NO_ACCOUNT, outcome="COMPLETED"))


@query("audit_rows", "J15 G7 B23", f"""
SELECT CAST(activity_date AS STRING) AS activity_date, strftime(occurred_at, '%Y-%m-%d %H:%M:%S') AS occurred_at,
  ca_name, channel, direction, is_automated, subject, account_name, contact_email, counts, excluded_reason,
  CAST(dup_count AS BIGINT) AS dup_count, replace(logged_by_text, ';', '|') AS logged_by, source, activity_id
FROM {{activity_flat}} a WHERE {IN_WIN} AND counts
  AND (contains(lower(subject), '100%_1') OR contains(lower(account_name), '100%_1'))
ORDER BY a.occurred_at DESC, activity_id LIMIT 500""")
def _(t):
    return audit.audit_rows(flat(t), START, END, state="counted", search="100%_1")


@query("audit_counts", "F17", f"""
SELECT count(*) FILTER (WHERE counts) AS counted, count(*) FILTER (WHERE NOT counts) AS excluded
FROM {{activity_flat}} WHERE {IN_WIN} AND channel = 'call'""")
def _(t):
    return audit.audit_counts(flat(t), START, END, channel="call")


@query("substring_search", "B23", """
SELECT activity_id, subject FROM {activity} WHERE contains(lower(subject), 'click 100%_7')""")
def _(t):
    return t["activity"].where(contains_text("subject", "CLICK 100%_7")).select("activity_id", "subject")


@query("data_range", "F18", """
SELECT CAST(min(activity_date) AS STRING) AS first_day, CAST(max(activity_date) AS STRING) AS last_day
FROM {activity} WHERE counts""")
def _(t):
    return sc.data_range(t["activity"])


@query("meetings_by_scheduler_tag", "F16", f"""
SELECT ca_name, count(*) AS meetings FROM {{activity_flat}} WHERE counts AND channel = 'meeting'
  AND list_contains(split(logged_by_text, ';'), 'Scheduler') AND {IN_WIN} GROUP BY 1""")
def _(t):
    return audit.meetings_logged_by(flat(t), "Scheduler", START, END)


@query("channel_options", "J17", "SELECT DISTINCT channel FROM {activity}")
def _(t):
    return audit.channel_options(t["activity"])


@query("rep_options_active", "J17", "SELECT name AS ca_name FROM {dim_ca} WHERE is_active")
def _(t):
    return audit.rep_options(t["dim_ca"])


@query("rep_options_inactive", "J17", "SELECT name AS ca_name FROM {dim_ca} WHERE NOT is_active")
def _(t):
    return audit.rep_options(t["dim_ca"], active=False)


@query("single_record", "J18", """
SELECT activity_id, channel, ca_name, account_name, contact_lastname, outcome FROM {activity_flat}
WHERE activity_id = 'ev:77'""")
def _(t):
    return audit.record(flat(t), "ev:77").select(
        "activity_id", "channel", "ca_name", "account_name", "contact_lastname", "outcome")


@query("active_rows_semi", "E10", f"SELECT activity_id, ca_name FROM {{activity_flat}} WHERE {ACTIVE_SQL}")
def _(t):
    return audit.only_active(t["activity_flat"], t["dim_ca"]).select("activity_id", "ca_name")


@query("denylist_anti", "E11", """SELECT activity_id, ca_name FROM {activity_flat}
WHERE ca_name IS NULL OR ca_name NOT IN (SELECT name FROM {dim_ca} WHERE NOT is_active)""")
def _(t):
    return audit.drop_inactive(t["activity_flat"], t["dim_ca"]).select("activity_id", "ca_name")


# --------------------------------------------------------------------- trends
TREND_VIEWS = {**SC_VIEWS, "weekly": period_sql("week"), "monthly": period_sql("month"),
               "card": scorecard_sql(IN_WIN)}
KPIS = ("total_counted", "emails", "auto_email", "manual_email", "dials", "conversations", "linkedin",
        "inbound_replies", "meetings_booked", "meetings_held", "meetings_canceled", "meetings_unknown",
        "other_outreach")


@query("kpi_totals", "J3", "SELECT " + ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}" for k in KPIS)
       + " FROM {card} WHERE ca_name NOT IN (SELECT name FROM {dim_ca} WHERE NOT is_active)", TREND_VIEWS)
def _(t):
    return trends.kpi_totals(audit.drop_inactive(sc.rep_scorecard(*_tables(t), START, END), t["dim_ca"]), KPIS)


@query("channel_mix_long", "J4", """
SELECT ca_name, measure, n FROM (SELECT ca_name, auto_email, manual_email, dials, linkedin, inbound_replies FROM {card})
UNPIVOT (n FOR measure IN (auto_email, manual_email, dials, linkedin, inbound_replies))""", TREND_VIEWS)
def _(t):
    return trends.melt(sc.rep_scorecard(*_tables(t), START, END), ["ca_name"],
                       ["auto_email", "manual_email", "dials", "linkedin", "inbound_replies"])


@query("last_weeks", "G8", """
SELECT week_start, ca_id, total_counted FROM {weekly}
WHERE week_start IN (SELECT DISTINCT week_start FROM {weekly} ORDER BY week_start DESC LIMIT 2)""", TREND_VIEWS)
def _(t):
    return trends.last_weeks(sc.rep_weekly_trend(*_tables(t), AS_OF), 2).select("week_start", "ca_id", "total_counted")


@query("team_and_reps_trend", "J8", """
SELECT week_start, ca_name AS who, accounts_touched FROM {weekly}
UNION ALL SELECT week_start, 'Whole team', CAST(sum(accounts_touched) AS BIGINT) FROM {weekly} GROUP BY 1""", TREND_VIEWS)
def _(t):
    return trends.team_and_reps(sc.rep_weekly_trend(*_tables(t), AS_OF), "accounts_touched")


@query("pivot_weeks", "J9", """
SELECT ca_name, avg(emails) FILTER (WHERE week_start = '2024-01-08') AS "2024-01-08",
  avg(emails) FILTER (WHERE week_start = '2024-01-15') AS "2024-01-15",
  avg(emails) FILTER (WHERE week_start = '2024-01-22') AS "2024-01-22"
FROM {weekly} GROUP BY 1""", TREND_VIEWS)
def _(t):
    return trends.pivot_weeks(sc.rep_weekly_trend(*_tables(t), AS_OF), "emails",
                              ["2024-01-08", "2024-01-15", "2024-01-22"])


@query("partial_period_flags", "J10", """
SELECT ca_id, week_start, week_start = (SELECT max(week_start) FROM {weekly}) AS is_latest_week,
  date_trunc('month', CAST(week_start AS DATE)) = (SELECT date_trunc('month', min(activity_date)) FROM {activity} WHERE counts)
    AS month_is_partial FROM {weekly}""", TREND_VIEWS)
def _(t):
    first = sc.data_range(t["activity"]).select("first_day").scalar()
    return trends.partial_flags(sc.rep_weekly_trend(*_tables(t), AS_OF), first)


SCORE_GOOD, SCORE_BAD = ("total_counted", "emails"), ("meetings_canceled",)


def _score(c, flip):
    pos = (f"coalesce(CAST({c} - (SELECT min({c}) FROM {{card}}) AS DOUBLE) / nullif((SELECT max({c}) - min({c}) FROM {{card}}), 0), 0.5)")
    return f"CAST(CAST(round({'1 - ' if flip else ''}{pos}, 4) AS DECIMAL(10,4)) AS DOUBLE) AS {c}"


@query("column_scores", "J16", "SELECT ca_name, " + ", ".join(
    [_score(c, False) for c in SCORE_GOOD] + [_score(c, True) for c in SCORE_BAD]) + " FROM {card}", TREND_VIEWS)
def _(t):
    return trends.column_scores(sc.rep_scorecard(*_tables(t), START, END), ["ca_name"], SCORE_GOOD, SCORE_BAD)


@query("rep_tier_heatmap", "E3", """
SELECT ca_name, count(*) FILTER (WHERE account_icp_tier_validated = 'Tier 0') AS "Tier 0",
  count(*) FILTER (WHERE account_icp_tier_validated = 'Tier 1') AS "Tier 1" FROM {activity_flat}
WHERE counts AND ca_id IS NOT NULL GROUP BY 1""")
def _(t):
    return trends.tier_heatmap(t["activity_flat"], ["Tier 0", "Tier 1"]).fillna(0, ["Tier 0", "Tier 1"])


# ----------------------------------------- combined with meetings and deals
MEETING_FLAT_SQL = """SELECT m.activity_id, m.activity_date, m.channel, m.occurred_at, m.counts, m.outcome,
  m.ca_id, c.name AS ca_name, a.name AS account_name, 'Meeting ' || m.activity_id AS subject,
  CAST(NULL AS STRING) AS contact_email
  FROM {meetings} m LEFT JOIN {dim_ca} c ON c.ca_id = m.ca_id
  LEFT JOIN {dim_account} a ON a.account_id = m.ca_id"""


def meeting_flat(t):
    return t.sql(MEETING_FLAT_SQL)


M_WIN = f"activity_date BETWEEN DATE '{oc.START}' AND DATE '{oc.END}'"
ALL_VIEWS = {**SC_VIEWS, **DD_VIEWS, **oc.MAP_VIEWS}
MPEEK = PEEK_SQL


@query("drill_verified_peek", "J14 G2", MPEEK, {**oc.MAP_VIEWS, "mflat": MEETING_FLAT_SQL,
    "rows": f"""SELECT * FROM {{mflat}} WHERE counts AND {M_WIN} AND {ACTIVE_SQL}
      AND coalesce(outcome, '?') NOT IN ('COMPLETED','CANCELED','SCHEDULED','RESCHEDULED')
      AND activity_id IN (SELECT activity_id FROM {{verified}})"""})
def _(t):
    return audit.peek(audit.drill_verified(
        meeting_flat(t), oc.verification(t), t["dim_ca"], oc.START, oc.END, verified=True))


@query("drill_unverified_peek", "J14", MPEEK, {**oc.MAP_VIEWS, "mflat": MEETING_FLAT_SQL,
    "rows": f"""SELECT * FROM {{mflat}} WHERE counts AND {M_WIN} AND {ACTIVE_SQL}
      AND coalesce(outcome, '?') NOT IN ('COMPLETED','CANCELED','SCHEDULED','RESCHEDULED')
      AND activity_id NOT IN (SELECT activity_id FROM {{verified}})"""})
def _(t):
    return audit.peek(audit.drill_verified(
        meeting_flat(t), oc.verification(t), t["dim_ca"], oc.START, oc.END, verified=False))


@query("drill_bucket_peek", "J14", MPEEK, {**oc.MAP_VIEWS, "mflat": MEETING_FLAT_SQL,
    "rows": f"""SELECT * FROM {{mflat}} WHERE {M_WIN} AND {ACTIVE_SQL}
      AND activity_id IN (SELECT activity_id FROM {{flags}} WHERE bucket = 'follow_up')"""})
def _(t):
    return audit.peek(audit.drill_bucket(meeting_flat(t), oc.flags(t), t["dim_ca"], oc.START, oc.END, "follow_up"))


@query("workable_coverage", "J1", """
SELECT owner_ca_id, owner_name, count(*) AS workable, count(*) FILTER (WHERE owner_touches > 0) AS touched,
  CAST(round(100.0 * count(*) FILTER (WHERE owner_touches > 0) / count(*), 1) AS DOUBLE) AS workable_pct
FROM {coverage} c LEFT JOIN {status} s ON s.account_id = c.account_id WHERE s.shield IS NULL GROUP BY 1, 2""", ALL_VIEWS)
def _(t):
    return dd.workable_coverage(coverage(t), oc.deal_status(t))


LABEL_SQL = """CASE WHEN s.shield IS NULL THEN 'Neglected' WHEN s.shield = 'customer' THEN 'Customer'
  WHEN s.shield = 'open_deal' THEN coalesce('Open deal (' || s.oldest_open_deal_days || 'd old)', 'Open deal')
  WHEN s.shield = 'churned_recently' THEN 'Churned ' || strftime(CAST(s.last_churned_date AS DATE), '%b %Y')
  ELSE 'Lost ' || strftime(CAST(s.last_lost_date AS DATE), '%d %b') END"""
SPARSE = ("2024-01-20", "2024-01-21")


@query("neglected_top_tier", "J6 B22", f"""
SELECT c.owner_name, c.account_id, c.account_name, c.icp_tier, c.vertical, s.shield, {LABEL_SQL} AS status
FROM {{sparse_coverage}} c LEFT JOIN {{status}} s ON s.account_id = c.account_id
WHERE c.icp_tier IN ('Tier 0','Tier 1') AND c.team_touches = 0""", ALL_VIEWS)
def _(t):
    return dd.neglected_top_tier(coverage(t, *SPARSE), oc.deal_status(t))


@query("neglected_counts", "J6", """
SELECT c.owner_name, c.icp_tier, count(*) AS n
FROM {sparse_coverage} c LEFT JOIN {status} s ON s.account_id = c.account_id
WHERE c.icp_tier IN ('Tier 0','Tier 1') AND c.team_touches = 0 AND s.shield IS NULL GROUP BY 1, 2""", ALL_VIEWS)
def _(t):
    return dd.neglected_counts(dd.neglected_top_tier(coverage(t, *SPARSE), oc.deal_status(t)))


MEETING_FACT_SQL = """SELECT ca_id, channel, activity_date, outcome, counts, CAST(NULL AS STRING) AS company_id,
  CAST(NULL AS STRING) AS contact_id, CAST(NULL AS STRING) AS call_group_id, FALSE AS is_conversation FROM {meetings}"""


HELD_VIEWS = {**oc.MAP_VIEWS, "held_s": f"""SELECT ca_id, count(*) AS b, count(*) FILTER (WHERE outcome = 'COMPLETED') AS h,
   count(*) FILTER (WHERE outcome = 'CANCELED') AS x,
   count(*) FILTER (WHERE outcome IN ('SCHEDULED','RESCHEDULED')) AS s FROM {{meetings}} WHERE counts AND {M_WIN} GROUP BY 1""",
 "held_v": f"""SELECT m.ca_id, count(*) AS v FROM {{meetings}} m JOIN {{verified}} r ON r.activity_id = m.activity_id
   WHERE m.counts AND {M_WIN} AND coalesce(m.outcome, '?') NOT IN ('COMPLETED','CANCELED','SCHEDULED','RESCHEDULED') GROUP BY 1"""}


@query("held_with_verified", "J2 E13", """
SELECT c.ca_id, c.name AS ca_name, coalesce(s.b, 0) AS meetings_booked, coalesce(s.h, 0) + coalesce(v.v, 0) AS meetings_held,
  coalesce(s.x, 0) AS meetings_canceled, coalesce(s.s, 0) AS meetings_scheduled,
  coalesce(s.b - s.h - s.x - s.s, 0) - coalesce(v.v, 0) AS meetings_unknown
FROM {dim_ca} c LEFT JOIN {held_s} s ON s.ca_id = c.ca_id LEFT JOIN {held_v} v ON v.ca_id = c.ca_id""", HELD_VIEWS)
def _(t):
    card = sc.rep_scorecard(t.sql(MEETING_FACT_SQL), t["dim_ca"], t["dim_account"], oc.START, oc.END)
    return trends.held_with_verified(
        card, mt.verified_unknown(t["meetings"], oc.verification(t), oc.START, oc.END))
