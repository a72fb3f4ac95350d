"""Outreach tables derived from the generic test tables.

Each view is one SQL text in the subset that Spark and DuckDB share, so a Spark job
and its SQL check start from the same rows. `{name}` refers to a parquet table or
to an earlier view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Declared, so that opening a table needs no footer-reading job.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

INTERNAL_DOMAINS = ("corp.example.com", "corp.example.org", "reach.example.com")
LINKABLE_DOMAINS = ("corp.example.com", "corp.example.org")
SYNC_TOOLS = ("Sequencer", "Dialer Sync")
AS_OF = "2001-08-01"
ACTIVITY_AS_OF = "2024-01-31"

VIEWS: dict[str, str] = {}

# ----------------------------------------------------------- report-side tables
VIEWS["dim_ca"] = """
SELECT CAST(s_suppkey AS STRING) AS ca_id, s_name AS name,
       'rep' || CAST(s_suppkey AS STRING) || '@corp.example.com' AS primary_email,
       s_suppkey % 10 <> 9 AS is_active
FROM {supplier}
"""

VIEWS["dim_account"] = """
SELECT CAST(c_custkey AS STRING) AS account_id, c_name AS name,
       'acct' || CAST(c_custkey AS STRING) || '.example.org' AS domain,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Tier 0' WHEN 'AUTOMOBILE' THEN 'Tier 1'
            WHEN 'MACHINERY' THEN 'Tier 2' WHEN 'HOUSEHOLD' THEN 'Tier 3' END AS icp_tier_validated,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS icp_tier_new,
       c_mktsegment AS vertical,
       CASE WHEN c_custkey % 3 = 0 THEN NULL
            ELSE CAST(c_custkey % (SELECT count(*) FROM {supplier}) AS STRING) END AS owner_rep_id,
       c_custkey % 3 <> 0 AS is_target
FROM {customer}
"""

VIEWS["dim_contact"] = """
SELECT CAST(c_custkey AS STRING) AS contact_id,
       'buyer' || CAST(c_custkey AS STRING) || '@acct' || CAST(c_custkey AS STRING) || '.example.org' AS email,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'First' || CAST(c_custkey % 13 AS STRING) END AS firstname,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'Last' || CAST(c_custkey AS STRING) END AS lastname,
       CASE WHEN c_nationkey < 5 THEN 'Head of Data' WHEN c_nationkey < 15 THEN 'Engineer' END AS jobtitle,
       'lead' AS lifecyclestage,
       CAST(c_custkey AS STRING) AS account_id
FROM {customer}
"""

VIEWS["activity"] = """
SELECT 'ev:' || CAST(event_id AS STRING) AS activity_id,
       CASE WHEN event_type = 'purchase' THEN 'dialer' ELSE 'crm' END AS source,
       CASE event_type
            WHEN 'click' THEN 'manual_email'
            WHEN 'purchase' THEN 'call'
            WHEN 'signup' THEN 'meeting'
            WHEN 'view' THEN CASE event_id % 3 WHEN 0 THEN 'li_connect' WHEN 1 THEN 'li_message' ELSE 'li_other' END
            ELSE CASE event_id % 4 WHEN 0 THEN 'inbound_email' WHEN 1 THEN 'whatsapp' ELSE 'auto_email' END
       END AS channel,
       CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'inbound' ELSE 'outbound' END AS direction,
       CASE WHEN value >= 400 THEN NULL
            ELSE CAST(user_id % (SELECT count(*) FROM {supplier}) AS STRING) END AS ca_id,
       CASE WHEN event_id % 6 = 0 THEN NULL
            ELSE CAST((event_id * 7 + user_id) % (SELECT count(*) FROM {customer}) AS STRING) END AS contact_id,
       CASE WHEN event_id % 5 = 0 THEN NULL
            ELSE CAST((event_id * 13 + user_id * 3) % (SELECT count(*) FROM {customer}) AS STRING) END AS company_id,
       'buyer' || CAST(user_id AS STRING) || '@example.org' AS contact_email,
       ts AS occurred_at,
       CAST(ts AS DATE) AS activity_date,
       event_type = 'error' AS is_automated,
       'About ' || event_type || ' 100%_' || CAST(user_id AS STRING) AS subject,
       CASE WHEN event_type = 'signup' THEN
            CASE event_id % 5 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'CANCELED' WHEN 2 THEN 'SCHEDULED'
                 WHEN 3 THEN 'RESCHEDULED' END
            WHEN event_type = 'purchase' THEN CASE WHEN value > 60 THEN 'conversation' ELSE 'attempt' END
       END AS outcome,
       value >= 2 AS counts,
       CASE WHEN value >= 2 THEN NULL WHEN value >= 1 THEN 'non_ca_user' ELSE 'invite_email' END AS excluded_reason,
       CAST(1 + event_id % 3 AS INT) AS dup_count,
       CASE WHEN event_id % 4 = 0 THEN 'Scheduler;Sequencer' ELSE 'Sequencer' END AS logged_by_text,
       CASE WHEN event_type = 'purchase' THEN 'g' || CAST(user_id AS STRING) || '-' || CAST(event_id % 50 AS STRING)
       END AS call_group_id,
       CASE WHEN event_type = 'purchase' THEN value > 60 END AS is_conversation
FROM {events}
"""

VIEWS["activity_flat"] = """
SELECT a.*, ca.name AS ca_name, ca.primary_email AS ca_email,
       dc.firstname AS contact_firstname, dc.lastname AS contact_lastname, dc.jobtitle AS contact_jobtitle,
       acc.name AS account_name, acc.domain AS account_domain,
       acc.icp_tier_validated AS account_icp_tier_validated, acc.icp_tier_new AS account_icp_tier_new,
       acc.vertical AS account_vertical, acc.is_target AS account_is_target
FROM {activity} a
LEFT JOIN {dim_ca} ca ON ca.ca_id = a.ca_id
LEFT JOIN {dim_contact} dc ON dc.contact_id = a.contact_id
LEFT JOIN {dim_account} acc ON acc.account_id = a.company_id
"""

# --------------------------------------------------- deals, meetings, recordings
VIEWS["deal_stages"] = """
SELECT DISTINCT o_orderpriority AS pipeline_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Renewals' WHEN '3-MEDIUM' THEN 'Partnerships'
            WHEN '4-NOT SPECIFIED' THEN 'Expansion' ELSE 'Opportunity' END AS pipeline_label,
       o_orderstatus AS stage_id,
       CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN 'Churned' ELSE 'Stage ' || o_orderstatus
       END AS stage_label,
       NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'O') AS is_closed,
       CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 1.0
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL ELSE 0.0 END AS probability
FROM {orders}
"""

VIEWS["deals"] = """
SELECT CAST(o_orderkey AS STRING) AS id, o_orderpriority AS pipeline, o_orderstatus AS dealstage,
       CASE WHEN o_totalprice > 450000 OR (o_orderpriority = '5-LOW' AND o_orderstatus = 'O') THEN NULL
            ELSE o_orderdate + INTERVAL '30' DAY END AS closedate,
       o_orderdate AS createdate,
       CASE WHEN o_totalprice < 20000 THEN TIMESTAMP '2001-07-31 02:00:00'
            ELSE TIMESTAMP '2001-08-01 02:00:00' END AS last_seen_at
FROM {orders}
"""

VIEWS["deal_companies"] = """
SELECT CAST(o_orderkey AS STRING) || ':' || CAST(o_custkey AS STRING) AS id,
       CAST(o_orderkey AS STRING) AS deal_id, CAST(o_custkey AS STRING) AS company_id
FROM {orders}
"""

VIEWS["company_crosswalk"] = """
SELECT CAST(c_custkey AS STRING) AS company_id,
       CASE WHEN c_custkey % 3 = 0 OR c_mktsegment = 'BUILDING' THEN CAST(c_custkey AS STRING)
            ELSE CAST(c_custkey - c_custkey % 3 AS STRING) END AS resolved_company_id,
       CASE WHEN c_nationkey = 3 THEN NULL
            ELSE 'acct' || CAST(c_custkey - c_custkey % 3 AS STRING) || '.example.org' END AS domain_norm,
       c_custkey % 3 = 0 OR c_mktsegment = 'BUILDING' AS is_canonical
FROM {customer}
"""

VIEWS["contact_crosswalk"] = """
SELECT CASE WHEN c_nationkey < 12 THEN 'buyer' ELSE 'former' END || CAST(c_custkey AS STRING) || '@acct'
           || CAST(c_custkey - c_custkey % 3 AS STRING) || '.example.org' AS email,
       CAST(c_custkey AS STRING) AS contact_id,
       CASE WHEN c_nationkey < 11 THEN CAST(c_custkey - c_custkey % 3 AS STRING) END AS resolved_company_id
FROM {customer}
"""

VIEWS["meetings"] = """
SELECT 'mt:' || CAST(o_orderkey AS STRING) AS activity_id, 'meeting' AS channel,
       CAST(o_orderkey AS STRING) AS meeting_id,
       CAST(o_custkey % (SELECT count(*) FROM {supplier}) AS STRING) AS ca_id,
       CAST(o_orderdate AS DATE) AS activity_date,
       o_orderdate + INTERVAL '1' MINUTE * (o_orderkey % 600) AS occurred_at,
       CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'SCHEDULED' END AS outcome,
       o_totalprice >= 20000 AS counts,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS start_time,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL '1' HOUR END AS end_time
FROM {orders}
"""

VIEWS["meeting_copies"] = """
SELECT activity_id, meeting_id AS id FROM {meetings}
UNION ALL SELECT activity_id, 'x' || meeting_id AS id FROM {meetings}
"""

VIEWS["meeting_attendee_links"] = """
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'x' ELSE '' END || CAST(l_orderkey AS STRING) AS meeting_id,
       CASE WHEN l_discount < 0.04 THEN 'guest' || CAST(l_linenumber AS STRING) || '@nowhere.example.net'
            WHEN l_quantity > 48 THEN NULL
            WHEN l_quantity > 45 THEN 'someone@gmail.com'
            WHEN l_quantity > 42 THEN 'host@corp.example.com'
            ELSE 'buyer' || CAST(c_custkey AS STRING) || '@acct' || CAST(c_custkey - c_custkey % 3 AS STRING)
                 || '.example.org' END AS contact_email
FROM {lineitem} JOIN {customer} ON c_custkey = (l_partkey * 7 + l_orderkey) % (SELECT count(*) FROM {customer})
"""

VIEWS["meeting_contacts"] = """
SELECT CAST(o_orderkey AS STRING) AS meeting_id,
       CAST(o_custkey % (SELECT count(*) FROM {supplier}) AS STRING) AS contact_id
FROM {orders}
"""

VIEWS["recordings"] = """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
           || '-' || CAST(l_suppkey AS STRING) AS id,
       'Call ' || l_returnflag AS title, l_shipdate AS call_time,
       CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'QUEUED' END AS call_status,
       CASE WHEN l_returnflag = 'R' THEN TIMESTAMP '2001-07-31 02:00:00'
            ELSE TIMESTAMP '2001-08-01 02:00:00' END AS last_seen_at,
       CAST(l_suppkey AS STRING) AS contact_id
FROM {lineitem}
"""

# ------------------------------------------------------------- raw landing tables
_REP = "CAST(o_custkey % (SELECT count(*) FROM {supplier}) AS STRING)"
_BUYER = "'buyer' || CAST(o_custkey AS STRING) || '@acct' || CAST(o_custkey - o_custkey % 3 AS STRING) || '.example.org'"

VIEWS["raw_owners"] = """
SELECT CAST(s_suppkey AS STRING) AS id,
       CASE WHEN s_acctbal < -900 THEN NULL
            ELSE 'Rep.' || CAST(s_suppkey AS STRING) || '@corp.example.com' END AS email,
       CASE WHEN s_nationkey = 2 THEN NULL ELSE 'First' || CAST(s_suppkey AS STRING) END AS first_name,
       'Last' || CAST(s_suppkey AS STRING) AS last_name,
       CASE WHEN s_suppkey % 10 = 9 THEN TRUE WHEN s_suppkey % 2 = 0 THEN FALSE END AS archived,
       CASE WHEN s_nationkey < 10 THEN 'East Reps' WHEN s_nationkey < 18 THEN 'West Reps'
            WHEN s_nationkey < 20 THEN 'East Reps;East Sales' WHEN s_nationkey < 22 THEN 'West Sales' ELSE 'Support' END
         || CASE WHEN s_acctbal > 8000 THEN ';West Reps' ELSE '' END AS teams_text
FROM {supplier}
UNION ALL
SELECT 'd' || CAST(s_suppkey AS STRING) AS id, 'rep' || CAST(s_suppkey AS STRING) || '@partner.example.net' AS email,
       'Twin' AS first_name, NULL AS last_name, FALSE AS archived, 'Support' AS teams_text
FROM {supplier} WHERE s_nationkey = 5
"""

VIEWS["team_config"] = """
SELECT 'East Reps' AS ca_team_name, 'East Sales' AS parent_team_name
UNION ALL SELECT 'West Reps' AS ca_team_name, 'West Sales' AS parent_team_name
"""

VIEWS["prior_ca"] = """
SELECT CAST(s_suppkey AS STRING) AS ca_id, 'First' || CAST(s_suppkey AS STRING) AS name,
       'rep.' || CAST(s_suppkey AS STRING) || '@corp.example.com' AS primary_email, 'East Reps' AS ca_teams
FROM {supplier}
"""

VIEWS["prior_address"] = """
SELECT 'rep' || CAST(s_suppkey AS STRING) || '@corp.example.org' AS address, CAST(s_suppkey AS STRING) AS ca_id
FROM {supplier}
UNION ALL
SELECT 'old.rep' || CAST(s_suppkey AS STRING) || '@corp.example.org' AS address, CAST(s_suppkey AS STRING) AS ca_id
FROM {supplier}
"""

VIEWS["prior_user"] = """
SELECT 'gone' || CAST(s_suppkey AS STRING) AS user_id, CAST(s_suppkey AS STRING) AS ca_id
FROM {supplier}
"""

VIEWS["raw_users"] = """
SELECT 'u' || CAST(s_suppkey AS STRING) AS id,
       CASE s_nationkey % 4 WHEN 0 THEN 'rep' || CAST(s_suppkey AS STRING) || '@gmail.com'
            WHEN 1 THEN 'REP' || CAST(s_suppkey AS STRING) || '@reach.example.com'
            ELSE 'rep.' || CAST(s_suppkey AS STRING) || '@corp.example.org' END AS email,
       CASE WHEN s_nationkey % 3 = 0 THEN 'r.e.p' || CAST(s_suppkey AS STRING) || '@corp.example.com;shared'
                 || CAST(s_suppkey AS STRING) || '@corp.example.com'
            WHEN s_nationkey % 3 = 1 THEN 'rep' || CAST(s_suppkey AS STRING) || '@corp.example.org' END AS mailboxes_text
FROM {supplier}
"""

VIEWS["raw_emails"] = """
SELECT CAST(l_orderkey AS STRING) || CAST(l_linenumber AS STRING) || lpad(CAST(l_partkey AS STRING), 9, '0')
           || lpad(CAST(l_suppkey AS STRING), 8, '0') AS id,
       o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 37) % 80000 + l_linenumber * 70) AS hs_timestamp,
       CASE l_returnflag WHEN 'A' THEN '[Mailer] [Email] ' WHEN 'R' THEN 'Re: ' ELSE '' END
         || CASE WHEN o_orderpriority = '1-URGENT' THEN 'Invitation: ' ELSE '' END
         || 'Order   ' || CAST(o_orderkey AS STRING) AS subject,
       CASE WHEN l_linestatus = 'O' THEN 'INTEGRATION' WHEN l_returnflag = 'N' THEN 'EMAIL' ELSE 'INTEGRATION'
       END AS object_source,
       CASE WHEN l_linestatus = 'O' THEN 'Sequencer' WHEN l_returnflag = 'A' THEN 'Dialer Sync'
            WHEN l_returnflag = 'R' THEN 'Other Tool' END AS object_source_detail,
       CASE WHEN o_totalprice > 490000 THEN NULL
            WHEN o_orderstatus = 'P' THEN
              CASE WHEN o_orderpriority = '5-LOW' THEN 'no-reply@notify.example.net'
                   ELSE 'Buyer <' || """ + _BUYER + """ || '>' END
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'rep' || """ + _REP + """ || '@reach.example.com'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'REP.' || """ + _REP + """ || '@corp.example.org'
            ELSE 'Rep <rep.' || """ + _REP + """ || '@corp.example.com>' END AS from_email,
       CASE WHEN o_orderstatus = 'P' THEN 'rep.' || """ + _REP + """ || '@corp.example.com'
            WHEN o_totalprice < 15000 THEN 'team@corp.example.com'
            WHEN o_orderkey % 13 = 5 THEN
              CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'Buyer <' || """ + _BUYER + """ || '>' END
                || CASE WHEN l_linenumber % 3 = 1 THEN '' ELSE '; desk' || CAST(o_orderkey AS STRING) || '@partner.example.net' END
            ELSE 'Buyer <' || """ + _BUYER + """ || '>; ops@corp.example.com' END AS to_email,
       CASE WHEN l_returnflag = 'N' THEN 'cc' || CAST(l_suppkey AS STRING) || '@partner.example.net' END AS cc_email,
       CASE WHEN l_quantity > 45 THEN 'bcc' || CAST(l_partkey AS STRING) || '@partner.example.net' END AS bcc_email,
       CASE WHEN l_quantity < 12 THEN NULL
            ELSE 'Hello  there, order ' || CAST(o_orderkey AS STRING) || ' has shipped to you today.'
                 || CASE WHEN l_tax > 0.04 THEN ' -- kind regards, the team' ELSE '' END END AS body_preview,
       '<div><p>Your order number ' || CAST(o_orderkey % 12 AS STRING) || ' left our house by truck '
         || CAST(l_suppkey % 3 AS STRING) || ' and should arrive with all its parts by the end of week '
         || CAST(l_linenumber AS STRING) || '</p></div>' AS body_html,
       CAST(o_orderdate AS DATE) AS activity_date
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
"""

VIEWS["raw_companies"] = """
SELECT CAST(c_custkey AS STRING) AS id,
       CASE WHEN c_nationkey = 7 THEN 'The Group'
            ELSE c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' Holdings Ltd' ELSE ' Group' END END AS name,
       CASE WHEN c_nationkey = 3 THEN 'gmail.com' WHEN c_nationkey = 4 THEN NULL WHEN c_nationkey = 5 THEN 'no domain'
            ELSE 'https://www.Acct' || CAST(c_custkey - c_custkey % 3 AS STRING) || '.example.org/about' END AS domain,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'Tier 0' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Tier 1' END AS icp_tier_validated,
       CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_acctbal < 0 THEN NULL
            ELSE CAST(c_custkey % (SELECT count(*) FROM {supplier}) AS STRING) END AS target_account_owner,
       CASE WHEN c_nationkey = 9 THEN NULL
            ELSE TIMESTAMP '2020-01-01 00:00:00' + INTERVAL '1' HOUR * ((c_custkey * 37) % 50) END AS created
FROM {customer}
"""

VIEWS["raw_contacts"] = """
SELECT CAST(c_custkey AS STRING) AS id,
       CASE WHEN c_nationkey = 2 THEN NULL
            WHEN c_nationkey < 6 THEN 'Buyer' || CAST(c_custkey - c_custkey % 2 AS STRING) || '@acct'
                 || CAST(c_custkey - c_custkey % 2 - (c_custkey - c_custkey % 2) % 3 AS STRING) || '.example.org'
            ELSE 'Buyer' || CAST(c_custkey AS STRING) || '@acct' || CAST(c_custkey - c_custkey % 3 AS STRING)
                 || '.example.org' END AS email,
       'First' || CAST(c_custkey AS STRING) AS firstname, 'Last' AS lastname, 'Engineer' AS jobtitle,
       CASE WHEN c_nationkey = 8 THEN NULL ELSE CAST(c_custkey AS STRING) END AS associated_company_id
FROM {customer}
"""

VIEWS["raw_calls"] = """
SELECT CAST(event_id AS STRING) AS id,
       'u' || CAST(user_id % (SELECT count(*) FROM {supplier}) AS STRING) AS user_id,
       CASE WHEN value < 1 THEN NULL ELSE ts END AS start_date,
       CAST(value AS INT) AS duration, value > 60 AS human,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'k' || CAST(user_id % 40 AS STRING) END AS contact_id,
       CASE WHEN event_type = 'view' THEN NULL
            ELSE 'Buyer <buyer' || CAST(user_id AS STRING) || '@acct' || CAST(user_id - user_id % 3 AS STRING)
                 || '.example.org>' END AS contact_email,
       CAST(ts AS DATE) AS activity_date
FROM {events}
"""

VIEWS["raw_tasks"] = """
SELECT CAST(event_id AS STRING) AS id,
       CASE WHEN value > 300 THEN 'nobody' ELSE 'u' || CAST(user_id % (SELECT count(*) FROM {supplier}) AS STRING)
       END AS user_id,
       CASE event_type WHEN 'click' THEN 'email' WHEN 'view' THEN 'linkedin_visit' WHEN 'purchase' THEN 'phone_call'
            WHEN 'signup' THEN 'linkedin_connect' ELSE CASE WHEN value > 50 THEN 'custom step' END END AS type,
       event_id % 2 = 0 AS automatic, ts AS finished_on,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'k' || CAST(user_id % 60 AS STRING) END AS contact_id,
       'buyer' || CAST(user_id * 2 AS STRING) || '@acct' || CAST(user_id * 2 - (user_id * 2) % 3 AS STRING)
           || '.example.org' AS contact_email,
       CAST(ts AS DATE) AS activity_date
FROM {events}
"""

VIEWS["raw_meetings"] = """
SELECT CAST(o_orderkey AS STRING) AS id, o_orderdate + INTERVAL '5' MINUTE AS hs_timestamp,
       CASE WHEN o_totalprice > 480000 THEN NULL ELSE o_orderpriority END AS title,
       'INTEGRATION' AS object_source,
       CASE WHEN o_orderstatus = 'F' THEN 'Scheduler' END AS object_source_detail,
       CASE WHEN o_totalprice < 10000 THEN NULL ELSE """ + _REP + """ END AS owner_id,
       CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'SCHEDULED' END AS outcome,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL
            ELSE CAST((o_custkey * 3) % (SELECT count(*) FROM {supplier}) AS STRING) || '; '
                 || CAST((o_custkey * 5) % (SELECT count(*) FROM {supplier}) AS STRING) || ';' END AS attendee_owner_ids,
       CASE WHEN o_totalprice > 470000 THEN NULL ELSE o_orderdate END AS start_time,
       CAST(o_orderdate AS DATE) AS activity_date
FROM {orders}
"""

VIEWS["text_cases"] = """
SELECT CAST(o_orderkey AS STRING) AS id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'EXT: Automatic Reply: away ' WHEN '2-HIGH' THEN '[Mailer] [<<] Re: FWD:  '
            WHEN '3-MEDIUM' THEN CASE WHEN o_custkey % 2 = 0 THEN 'R.e. '
                 ELSE '[Tool]' || chr(160) || '[Email]' || chr(160) || 'Re:' || chr(160) || 'Re:' || chr(160) END WHEN '4-NOT SPECIFIED' THEN 'external : Undeliverable: '
            ELSE '[Sync] Declined:   ' END || 'Order  ' || CAST(o_orderkey AS STRING) AS subject,
       CASE o_orderstatus
            WHEN 'F' THEN 'This is the first time you''re receiving an email from this person. '
            WHEN 'P' THEN '[EXTERNAL EMAIL]:  '
            ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'Caution: this email originated from outside of us. '
                      WHEN o_orderpriority = '2-HIGH' THEN 'You don''t often get email from a@b.c. ' ELSE '' END END
         || CASE WHEN o_totalprice < 30000 THEN '' ELSE 'Thank you  for order ' || CAST(o_custkey AS STRING)
            || ' which we will now handle with all the care that it deserves and send along to your door as soon as '
            || 'we possibly can, which is to say within the next week or two.' END AS body,
       CASE o_orderstatus WHEN 'F' THEN 'No-Reply' WHEN 'P' THEN 'bounce+1' ELSE 'Jane.Doe' END
         || CAST(o_custkey AS STRING) || '@Mail.example.org' AS sender
FROM {orders}
"""

_REF = re.compile(r"\{(\w+)\}")


def refs(text: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(text)))


class Domain:
    """Lazy access to the base tables and the derived views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._seen: dict[str, DataFrame] = {}
        # staged results, written once for the steps of one query
        self.memo: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._seen:
            if name in VIEWS:
                text = VIEWS[name]
                self._seen[name] = self.spark.sql(text, **{r: self[r] for r in refs(text)})
            else:
                self._seen[name] = self.spark.read.schema(BASE_SCHEMAS[name]).parquet(
                    f"{self.sf_dir}/{name}.parquet"
                )
        return self._seen[name]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{r: self[r] for r in refs(text)})


def ctes(text: str, extra: dict[str, str] | None = None) -> str:
    """The check SQL with every view it needs (views and `extra`) as WITH items."""
    views = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(t: str) -> None:
        for r in refs(t):
            if r in views and r not in order:
                visit(views[r])
                order.append(r)

    visit(text)
    body = _REF.sub(lambda m: m.group(1), text)
    if not order:
        return body
    items = ",\n".join(f"{n} AS MATERIALIZED ({_REF.sub(lambda m: m.group(1), views[n])})" for n in order)
    return f"WITH RECURSIVE {items}\n{body}"
