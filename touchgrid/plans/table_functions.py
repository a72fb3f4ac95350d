"""SQL table functions over the published tables, for users who write SQL.

`register` names the tables as temporary views and creates five functions of a window
(first day, last day); each gives the rows of the DataFrame function of the same name. A function
is a query that Spark inlines, so the dates reach the scan and unused columns are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchgrid import vocab


def _quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


EMAIL, OTHER = _quoted(vocab.EMAIL_CHANNELS), _quoted(vocab.OTHER_CHANNELS)
SCHEDULED = _quoted(vocab.SCHEDULED_OUTCOMES)

#: Counted rows by a condition on the row.
SCORES = {
    "auto_email": "channel = 'auto_email'", "manual_email": "channel = 'manual_email'", "emails": f"channel IN ({EMAIL})",
    "dials": "channel = 'call'", "conversations": "channel = 'call' AND is_conversation",
    "linkedin": "channel LIKE 'li\\_%'", "li_connect": "channel = 'li_connect'", "li_message": "channel = 'li_message'",
    "li_other": "channel = 'li_other'", "other_outreach": f"channel IN ({OTHER})", "inbound_replies": "channel = 'inbound_email'",
    "meetings_booked": "channel = 'meeting'", "meetings_held": "channel = 'meeting' AND outcome = 'COMPLETED'",
    "meetings_canceled": "channel = 'meeting' AND outcome = 'CANCELED'",
    "meetings_scheduled": f"channel = 'meeting' AND outcome IN ({SCHEDULED})", "total_counted": "true",
}
CALLS = "channel = 'call'"


def _counts(tests: dict[str, str]) -> str:
    return ", ".join(f"count_if({test}) AS {name}" for name, test in tests.items())


def _picked(*names: str) -> str:
    return _counts({n: CALLS if n == "calls" else SCORES[n] for n in names})


IN_WINDOW = "activity_date BETWEEN window_start AND window_end"
TOUCH = f"counts AND channel <> 'meeting' AND ca_id IS NOT NULL AND {IN_WINDOW}"

FUNCTIONS = {
    "rep_scorecard": f"""
WITH pairs AS (
  SELECT ca_id, company_id, {_counts(SCORES)} FROM {{p}}activity WHERE counts AND ca_id IS NOT NULL AND {IN_WINDOW} GROUP BY ca_id, company_id
), per_rep AS (
  SELECT ca_id, {", ".join(f"sum({n}) AS {n}" for n in SCORES)}, count(company_id) AS accounts_touched,
         count_if(owner_rep_id = ca_id) AS owned_touched
  FROM pairs LEFT JOIN (SELECT account_id, owner_rep_id FROM {{p}}dim_account) ON account_id = company_id GROUP BY ca_id
), people AS (
  SELECT ca_id, count(DISTINCT contact_id) AS contacts_touched,
         count(DISTINCT CASE WHEN {CALLS} THEN call_group_id END) AS pursuits
  FROM {{p}}activity WHERE counts AND ca_id IS NOT NULL AND {IN_WINDOW} GROUP BY ca_id
), owned AS (
  SELECT owner_rep_id, count(*) AS accounts_owned FROM {{p}}dim_account WHERE owner_rep_id IS NOT NULL GROUP BY owner_rep_id
)
SELECT r.ca_id, r.name AS ca_name, {", ".join(f"coalesce(m.{n}, 0) AS {n}" for n in SCORES)}, coalesce(q.pursuits, 0) AS pursuits,
  coalesce(m.meetings_booked - m.meetings_held - m.meetings_canceled - m.meetings_scheduled, 0) AS meetings_unknown,
  coalesce(m.accounts_touched, 0) AS accounts_touched, coalesce(q.contacts_touched, 0) AS contacts_touched,
  CAST(round(CAST(q.contacts_touched AS DECIMAL(20, 0)) / nullif(m.accounts_touched, 0), 1) AS DOUBLE) AS contacts_per_account,
  coalesce(o.accounts_owned, 0) AS accounts_owned, coalesce(m.owned_touched, 0) AS owned_touched,
  CAST(round(CAST(100 * coalesce(m.owned_touched, 0) AS DECIMAL(20, 0)) / nullif(o.accounts_owned, 0), 1) AS DOUBLE) AS coverage_pct
FROM {{p}}dim_ca r LEFT JOIN per_rep m ON m.ca_id = r.ca_id LEFT JOIN people q ON q.ca_id = r.ca_id
LEFT JOIN owned o ON o.owner_rep_id = r.ca_id""",
    "rep_account_drilldown": f"""
SELECT t.ca_id, t.ca_name, t.company_id AS account_id, coalesce(t.account_name, '{vocab.NO_ACCOUNT}') AS account_name,
  t.account_domain, t.account_icp_tier_validated AS icp_tier, d.owner_rep_id AS owned_by_rep_id,
  d.owner_rep_id = t.ca_id AS owned_by_this_rep, t.touchpoints, t.people_touched, t.auto_email, t.manual_email, t.calls, t.linkedin,
  t.inbound_replies, t.other_outreach, t.first_touch, t.last_touch
FROM (
  SELECT ca_id, ca_name, company_id, account_name, account_domain, account_icp_tier_validated, count(*) AS touchpoints,
    count(DISTINCT contact_id) AS people_touched,
    {_picked("auto_email", "manual_email", "calls", "linkedin", "inbound_replies", "other_outreach")},
    min(activity_date) AS first_touch, max(activity_date) AS last_touch
  FROM {{p}}activity_flat WHERE {TOUCH}
  GROUP BY ca_id, ca_name, company_id, account_name, account_domain, account_icp_tier_validated
) t LEFT JOIN {{p}}dim_account d ON d.account_id = t.company_id""",
    "account_contact_drilldown": f"""
SELECT ca_id, ca_name, company_id AS account_id, coalesce(account_name, '{vocab.NO_ACCOUNT}') AS account_name,
  account_icp_tier_validated AS icp_tier, contact_id,
  nullif(trim(concat(coalesce(contact_firstname, ''), ' ', coalesce(contact_lastname, ''))), '') AS contact_name,
  contact_email, contact_jobtitle AS jobtitle, count(*) AS touchpoints,
  {_picked("emails", "calls", "linkedin", "inbound_replies")}, max(activity_date) AS last_touch
FROM {{p}}activity_flat WHERE {TOUCH} AND contact_id IS NOT NULL
GROUP BY ca_id, ca_name, company_id, account_name, account_icp_tier_validated, contact_id, contact_firstname, contact_lastname,
  contact_email, contact_jobtitle""",
    "owned_account_coverage": f"""
WITH pairs AS (
  SELECT company_id, ca_id, count(*) AS n, max(activity_date) AS latest FROM {{p}}activity WHERE {TOUCH} AND company_id IS NOT NULL
  GROUP BY company_id, ca_id
)
SELECT d.owner_rep_id AS owner_ca_id, r.name AS owner_name, d.account_id, d.name AS account_name, d.domain AS account_domain,
  d.icp_tier_validated AS icp_tier, d.vertical, coalesce(sum(p.n) FILTER (WHERE p.ca_id = d.owner_rep_id), 0) AS owner_touches,
  max(p.latest) FILTER (WHERE p.ca_id = d.owner_rep_id) AS owner_last_touch, coalesce(sum(p.n), 0) AS team_touches,
  max(p.latest) AS team_last_touch, count(p.ca_id) AS team_reps
FROM {{p}}dim_account d JOIN {{p}}dim_ca r ON r.ca_id = d.owner_rep_id LEFT JOIN pairs p ON p.company_id = d.account_id
GROUP BY d.owner_rep_id, r.name, d.account_id, d.name, d.domain, d.icp_tier_validated, d.vertical""",
    "rep_meeting_breakdown": f"""
SELECT r.ca_id, r.name AS ca_name, coalesce(b.n, 0) AS meetings_booked, coalesce(b.fresh, 0) AS meetings_new_stakeholder,
  coalesce(b.later, 0) AS meetings_follow_up, coalesce(b.unmapped, 0) AS meetings_no_account
FROM {{p}}dim_ca r LEFT JOIN (
  SELECT ca_id, count(*) AS n, count_if(bucket = 'new_stakeholder') AS fresh, count_if(bucket = 'follow_up') AS later,
    count_if(bucket = 'no_account') AS unmapped
  FROM {{p}}meeting_flags WHERE {IN_WINDOW} GROUP BY ca_id
) b ON b.ca_id = r.ca_id""",
}


def register(
    spark: SparkSession, activity: DataFrame, activity_flat: DataFrame, dim_ca: DataFrame, dim_account: DataFrame,
    meeting_flags: DataFrame | None = None, prefix: str = "",
) -> list[str]:
    """Views `<prefix>activity` and so on, and the functions `<prefix>rep_scorecard` and so on; the functions' names.

    Without meeting_flags there is no rep_meeting_breakdown.
    """
    tables = {"activity": activity, "activity_flat": activity_flat, "dim_ca": dim_ca, "dim_account": dim_account}
    if meeting_flags is not None:
        tables["meeting_flags"] = meeting_flags
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    made = [f for f in FUNCTIONS if f != "rep_meeting_breakdown" or meeting_flags is not None]
    for name in made:
        body = FUNCTIONS[name].replace("{p}", prefix)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(window_start DATE, window_end DATE) RETURNS TABLE RETURN {body}"
        )
    return [prefix + f for f in made]
