"""Registered identity-resolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchgrid.catalog.domain import INTERNAL_DOMAINS, LINKABLE_DOMAINS
from touchgrid.catalog.registry import query
from touchgrid.plans import identity as idn
from touchgrid.vocab import FREE_EMAIL_DOMAINS, NAME_STOPWORDS


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


INTERNAL, LINKABLE = sql_list(INTERNAL_DOMAINS), sql_list(LINKABLE_DOMAINS)
DOMAIN_OF = "regexp_extract({}, '[^@]*$')"


def emails_sql(c: str) -> str:
    """Header field -> list of plain addresses (DuckDB)."""
    return (
        f"list_filter(list_transform(split(coalesce({c}, ''), ';'), lambda p: lower(trim("
        "CASE WHEN contains(p, '<') AND contains(p, '>') THEN regexp_extract(p, '<([^>]*)>', 1) ELSE p END))), "
        "lambda e: contains(e, '@') AND contains(regexp_extract(e, '[^@]*$'), '.'))"
    )


def local_sql(c: str) -> str:
    return f"lower(replace(split_part({c}, '@', 1), '.', ''))"


def id_order_sql(c: str) -> str:
    n = f"regexp_full_match({c}, '[0-9]+')"
    return (
        f"CASE WHEN {n} THEN 0 ELSE 1 END, CASE WHEN {n} THEN length(ltrim({c}, '0')) ELSE 0 END, "
        f"CASE WHEN {n} THEN ltrim({c}, '0') ELSE {c} END, {c}"
    )


TOKENS = (
    "CASE WHEN len(list_filter(list_distinct(regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+')), "
    "lambda x: NOT list_contains([" + sql_list(NAME_STOPWORDS) + "], x))) > 0 "
    "THEN list_filter(list_distinct(regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+')), "
    "lambda x: NOT list_contains([" + sql_list(NAME_STOPWORDS) + "], x)) "
    "ELSE list_distinct(regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+')) END"
)


def tokens_sql(c: str) -> str:
    return TOKENS.replace("{c}", c)


NORM_DOMAIN = """CASE WHEN contains(x, '.') AND NOT contains(x, ' ') THEN x END"""

ID_VIEWS = {
    "owner_team": """SELECT id, unnest(list_distinct(split(teams_text, ';'))) AS team, teams_text, first_name,
        last_name, email FROM {raw_owners} WHERE NOT coalesce(archived, FALSE) AND email IS NOT NULL""",
    "roster_now": """SELECT id AS ca_id, trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) AS name,
        lower(email) AS primary_email, string_agg(ca_team_name, '; ' ORDER BY ca_team_name) AS ca_teams
        FROM {owner_team} o JOIN {team_config} c ON c.ca_team_name = o.team
        WHERE NOT list_contains(split(teams_text, ';'), parent_team_name)
        GROUP BY id, first_name, last_name, email""",
    "roster_all": """SELECT *, TRUE AS is_active FROM {roster_now}
        UNION ALL SELECT *, FALSE FROM {prior_ca} WHERE ca_id NOT IN (SELECT ca_id FROM {roster_now})""",
    "by_local": f"SELECT {local_sql('primary_email')} AS local, * FROM {{roster_all}}",
    "user_addr": """SELECT id AS user_id, pos, lower(boxes[pos]) AS address FROM (
          SELECT id, [email] || coalesce(split(mailboxes_text, ';'), []) AS boxes,
                 unnest(range(1, 2 + len(coalesce(split(mailboxes_text, ';'), [])))) AS pos FROM {raw_users})
        WHERE boxes[pos] IS NOT NULL""",
    "user_match": f"""SELECT user_id, arg_min(b.ca_id, pos) AS ca_id FROM {{user_addr}} u
        JOIN {{by_local}} b ON b.local = {local_sql('u.address')}
        WHERE {DOMAIN_OF.format('u.address')} IN ({INTERNAL}) GROUP BY 1""",
    "boxes": f"""SELECT u.user_id, u.address, m.ca_id AS user_ca, b.ca_id,
          {DOMAIN_OF.format('u.address')} IN ({LINKABLE}) AS linkable
        FROM {{user_addr}} u JOIN {{user_match}} m ON m.user_id = u.user_id
        LEFT JOIN {{by_local}} b ON b.local = {local_sql('u.address')}""",
    "senders": f"""SELECT address, count(*) AS n FROM (
          SELECT unnest(list_distinct({emails_sql('lower(from_email)')})) AS address FROM {{raw_emails}}
          WHERE from_email IS NOT NULL) GROUP BY 1""",
    "seen": f"""SELECT s.address, s.n, b.ca_id, b.is_active,
          {DOMAIN_OF.format('s.address')} IN ({LINKABLE}) AS linkable,
          coalesce(v.address IS NOT NULL OR s.address = b.primary_email, FALSE) AS is_own
        FROM {{senders}} s LEFT JOIN {{by_local}} b ON b.local = {local_sql('s.address')}
        LEFT JOIN (SELECT DISTINCT address, user_ca FROM {{boxes}}) v ON v.address = s.address AND v.user_ca = b.ca_id
        WHERE {DOMAIN_OF.format('s.address')} IN ({INTERNAL})""",
    "addresses": f"""SELECT address, ca_id, source FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY rank, ca_id) AS rn FROM (
          SELECT primary_email AS address, ca_id, 'owner_primary' AS source, 0 AS rank FROM {{by_local}}
            WHERE {DOMAIN_OF.format('primary_email')} IN ({LINKABLE})
          UNION ALL SELECT address, ca_id, 'user_mailbox', 1 FROM {{boxes}} WHERE ca_id IS NOT NULL AND linkable
          UNION ALL SELECT address, ca_id, CASE WHEN is_own THEN 'observed_sender' ELSE 'observed_sender_departed' END, 2
            FROM {{seen}} WHERE ca_id IS NOT NULL AND linkable AND (is_own OR NOT is_active))) WHERE rn = 1""",
    "all_addr": """SELECT address, ca_id, source FROM {addresses}
        UNION ALL SELECT address, ca_id, 'retained_departed' FROM {prior_address}
        WHERE ca_id IN (SELECT ca_id FROM {roster_all} WHERE NOT is_active)
          AND address NOT IN (SELECT address FROM {addresses})""",
    "all_user": """SELECT user_id, ca_id FROM {user_match} UNION ALL SELECT user_id, ca_id FROM {prior_user}
        WHERE ca_id IN (SELECT ca_id FROM {roster_all} WHERE NOT is_active)
          AND user_id NOT IN (SELECT user_id FROM {user_match})""",
    "parked_rows": """SELECT address AS key, 0 AS rank,
          CASE WHEN ca_id IS NULL THEN 'mailbox of a matched user, no rep has this local part'
               ELSE 'mailbox of a matched user, domain cannot be linked' END AS detail
          FROM {boxes} WHERE ca_id IS NULL OR NOT linkable
        UNION ALL SELECT address, 1, CASE WHEN ca_id IS NULL THEN 'internal sender, no rep has this local part'
               ELSE 'shares a rep''s local part but is not verified' END || ' (' || n || ' emails)'
          FROM {seen} WHERE NOT coalesce(ca_id IS NOT NULL AND linkable AND (is_own OR NOT is_active), FALSE)""",
    "parked": """SELECT 'address_parked' AS kind, key, detail FROM (
          SELECT *, row_number() OVER (PARTITION BY key ORDER BY rank, detail) AS rn FROM {parked_rows})
        WHERE rn = 1 AND key NOT IN (SELECT address FROM {addresses})""",
    "comp": f"""SELECT id, name, created, coalesce(target_account_owner <> '', FALSE) AS has_owner,
          CASE WHEN d NOT IN ({sql_list(FREE_EMAIL_DOMAINS)}) THEN d END AS domain_norm FROM (
          SELECT *, {NORM_DOMAIN} AS d FROM (SELECT *, regexp_replace(rtrim(trim(split_part(regexp_replace(lower(trim(domain)),
            '^.*//', ''), '/', 1)), '.'), '^www\\.', '') AS x FROM {{raw_companies}}))""",
    "best": f"""SELECT domain_norm, id AS best_id, name AS best_name FROM (SELECT *, row_number() OVER (
          PARTITION BY domain_norm ORDER BY has_owner DESC, created NULLS LAST, {id_order_sql('id')}) AS rn FROM {{comp}}
          WHERE domain_norm IS NOT NULL) WHERE rn = 1""",
    "resolved": f"""SELECT id AS company_id, CASE WHEN folds THEN best_id ELSE id END AS resolved_company_id, domain_norm,
          (NOT folds) OR id = best_id AS is_canonical, name, best_id, best_name, has_owner, folds FROM (
          SELECT c.*, b.best_id, b.best_name, b.best_id IS NOT NULL AND (c.id = b.best_id OR
            list_has_any({tokens_sql('c.name')}, {tokens_sql('b.best_name')})) AS folds
          FROM {{comp}} c LEFT JOIN {{best}} b ON b.domain_norm = c.domain_norm)""",
    "company_review": """SELECT CASE WHEN best_id IS NULL THEN 'company_no_domain' ELSE 'company_domain_conflict' END AS kind,
          company_id AS key, CASE WHEN best_id IS NULL THEN name ELSE name || ' shares ' || domain_norm || ' with '
            || best_name || ' (' || best_id || '), names disagree' END AS detail
        FROM {resolved} WHERE (best_id IS NOT NULL AND NOT folds) OR (domain_norm IS NULL AND has_owner)""",
    "contact_cw": f"""SELECT x.email, x.id AS contact_id, r.resolved_company_id FROM (
          SELECT lower(email) AS email, id, associated_company_id, row_number() OVER (PARTITION BY lower(email)
            ORDER BY {id_order_sql('id')}) AS rn FROM {{raw_contacts}} WHERE email IS NOT NULL) x
        LEFT JOIN {{resolved}} r ON r.company_id = x.associated_company_id WHERE rn = 1""",
    "ext_map": f"""SELECT e.external_contact_id, e.email, c.contact_id FROM (
          SELECT contact_id AS external_contact_id, ({emails_sql('min(lower(contact_email))')})[1] AS email FROM (
            SELECT contact_id, contact_email FROM {{raw_tasks}} UNION ALL SELECT contact_id, contact_email FROM {{raw_calls}})
          WHERE contact_id IS NOT NULL AND contact_email IS NOT NULL GROUP BY 1) e
        LEFT JOIN {{contact_cw}} c ON c.email = e.email""",
    "seen_all": f"""SELECT unnest(a) AS email, f FROM (
          SELECT {emails_sql('contact_email')} AS a, 'c' AS f FROM {{raw_tasks}}
          UNION ALL SELECT {emails_sql('contact_email')}, 'c' FROM {{raw_calls}}
          UNION ALL SELECT {emails_sql('from_email')}, 'f' FROM {{raw_emails}}
          UNION ALL SELECT {emails_sql('to_email')}, 't' FROM {{raw_emails}}
          UNION ALL SELECT {emails_sql('cc_email')}, 'cc' FROM {{raw_emails}}
          UNION ALL SELECT {emails_sql('bcc_email')}, 'bcc' FROM {{raw_emails}})""",
    "unmatched": f"""SELECT DISTINCT 'contact_email_unmatched' AS kind, email AS key, 'seen in activity, no contact' AS detail
        FROM {{seen_all}} WHERE f <> 'bcc' AND {DOMAIN_OF.format('email')} NOT IN ({INTERNAL})
          AND email NOT IN (SELECT email FROM {{contact_cw}})""",
    "account_dim": """SELECT c.id AS account_id, c.name, c.domain, c.icp_tier_validated,
          nullif(target_account_owner, '') AS owner_rep_id, nullif(target_account_owner, '') IS NOT NULL AS is_target
        FROM {raw_companies} c JOIN {resolved} r ON r.company_id = c.id AND r.is_canonical AND r.resolved_company_id = c.id""",
}


# ---- Spark-side inputs ----------------------------------------------------------
def owners(t):
    return t["raw_owners"].withColumn("teams", F.split("teams_text", ";"))


def users(t):
    return t["raw_users"].withColumn("mailboxes", F.split("mailboxes_text", ";"))


def roster(t):
    return idn.derive_roster(owners(t), t["team_config"])


def roster_all(t):
    return idn.retain_departed(roster(t), t["prior_ca"])


def links(t):
    return idn.link_addresses(
        roster_all(t), users(t), t["raw_emails"], owners(t), INTERNAL_DOMAINS, LINKABLE_DOMAINS
    )


def all_addresses(t):
    return idn.retain_links(links(t).addresses, t["prior_address"], roster_all(t), "address")


def all_users(t):
    return idn.retain_links(links(t).users, t["prior_user"], roster_all(t), "user_id")


def companies(t):
    return idn.resolve_companies(t["raw_companies"])


def contacts_cw(t):
    return idn.contact_crosswalk(t["raw_contacts"], companies(t))


def external_map(t):
    return idn.external_contact_map(t["raw_tasks"], t["raw_calls"], contacts_cw(t))


# ---- queries ---------------------------------------------------------------------
@query("rep_roster", "C1 B17", "SELECT * FROM {roster_now}", ID_VIEWS)
def _(t):
    return roster(t)


@query("roster_config_gaps", "C2", """
SELECT ca_team_name, parent_team_name, missing FROM (
  SELECT ca_team_name, parent_team_name, unnest([ca_team_name, parent_team_name]) AS missing FROM {cfg})
WHERE missing NOT IN (SELECT unnest(split(teams_text, ';')) FROM {raw_owners} WHERE NOT coalesce(archived, FALSE))""",
       {"cfg": "SELECT * FROM {team_config} UNION ALL SELECT 'North Reps', 'North Sales'"})
def _(t):
    cfg = t.sql("SELECT * FROM {team_config} UNION ALL SELECT 'North Reps', 'North Sales'")
    return idn.unmatched_config(owners(t), cfg)


@query("roster_with_departed", "C3", "SELECT * FROM {roster_all}", ID_VIEWS)
def _(t):
    return roster_all(t)


@query("retained_addresses", "C4", "SELECT address, ca_id, source FROM {all_addr}", ID_VIEWS)
def _(t):
    return all_addresses(t)


@query("retained_users", "C4", "SELECT user_id, ca_id FROM {all_user}", ID_VIEWS)
def _(t):
    return all_users(t)


@query("owner_local_twins", "C5 B4", f"""
SELECT local, reps FROM (SELECT {local_sql('domain_free')} AS local, count(*) AS reps FROM (
  SELECT replace(contact_email, 'buyer', 'b.') AS domain_free FROM {{raw_tasks}}) GROUP BY 1) WHERE reps > 1""")
def _(t):
    return idn.shared_locals(
        t["raw_tasks"].select(F.replace("contact_email", F.lit("buyer"), F.lit("b.")).alias("primary_email"))
    )


@query("user_rep_match", "C6", "SELECT user_id, ca_id FROM {user_match}", ID_VIEWS)
def _(t):
    return idn.match_users(users(t), roster_all(t), INTERNAL_DOMAINS)


@query("linked_addresses", "C7 C8 B2", "SELECT address, ca_id, source FROM {addresses}", ID_VIEWS)
def _(t):
    return links(t).addresses


@query("parked_addresses", "C8", "SELECT kind, key, detail FROM {parked}", ID_VIEWS)
def _(t):
    return links(t).parked


@query("identity_collisions", "C9", f"""
SELECT DISTINCT 'user' AS kind, u.user_id AS record_id, u.address, b.ca_id FROM {{user_addr}} u
JOIN {{by_local}} b ON b.local = {local_sql('u.address')} WHERE u.user_id NOT IN (SELECT user_id FROM {{user_match}})
UNION ALL
SELECT 'owner', o.id, lower(o.email), b.ca_id FROM {{raw_owners}} o JOIN {{by_local}} b ON b.local = {local_sql('o.email')}
WHERE NOT coalesce(o.archived, FALSE) AND o.email IS NOT NULL AND o.id NOT IN (SELECT ca_id FROM {{roster_all}})""", ID_VIEWS)
def _(t):
    return links(t).collisions


@query("company_crosswalk", "C10 C11 B5 B6 B7", """
SELECT company_id, resolved_company_id, domain_norm, is_canonical FROM {resolved}""", ID_VIEWS)
def _(t):
    return companies(t).select("company_id", "resolved_company_id", "domain_norm", "is_canonical")


@query("company_review", "C11 C12", "SELECT * FROM {company_review}", ID_VIEWS)
def _(t):
    return idn.company_review(companies(t))


@query("contact_crosswalk", "C13 B7", "SELECT * FROM {contact_cw}", ID_VIEWS)
def _(t):
    return contacts_cw(t)


@query("external_contact_map", "C14 B1", "SELECT * FROM {ext_map}", ID_VIEWS)
def _(t):
    return external_map(t)


@query("activity_addresses", "A9 B1", f"""
SELECT DISTINCT email FROM {{seen_all}} WHERE {DOMAIN_OF.format('email')} NOT IN ({INTERNAL})""", ID_VIEWS)
def _(t):
    return idn.activity_addresses(t["raw_tasks"], t["raw_calls"], t["raw_emails"], INTERNAL_DOMAINS)


@query("activity_scoped_contacts", "A9", f"""
SELECT id, lower(email) AS email FROM {{raw_contacts}} WHERE lower(email) IN (
  SELECT email FROM {{seen_all}} WHERE {DOMAIN_OF.format('email')} NOT IN ({INTERNAL}))""", ID_VIEWS)
def _(t):
    seen = idn.activity_addresses(t["raw_tasks"], t["raw_calls"], t["raw_emails"], INTERNAL_DOMAINS)
    return idn.activity_scoped_contacts(t["raw_contacts"], seen).select("id", F.lower("email").alias("email"))


def unmatched(t):
    seen = idn.activity_addresses(
        t["raw_tasks"], t["raw_calls"], t["raw_emails"], INTERNAL_DOMAINS,
        email_fields=("from_email", "to_email", "cc_email"),
    )
    return idn.unmatched_contacts(seen, contacts_cw(t))


@query("unmatched_contacts", "C15", "SELECT * FROM {unmatched}", ID_VIEWS)
def _(t):
    return unmatched(t)


@query("identity_review", "C16 E12", """
SELECT * FROM {parked} UNION ALL SELECT * FROM {company_review} UNION ALL SELECT * FROM {unmatched}""", ID_VIEWS)
def _(t):
    return idn.review_list(links(t).parked, idn.company_review(companies(t)), unmatched(t))


@query("attribution_coverage", "C17", f"""
SELECT 'calls' AS what, count(*) AS total, count(m.ca_id) AS attributed FROM {{raw_calls}} c LEFT JOIN {{user_match}} m USING (user_id)
UNION ALL SELECT 'tasks', count(*), count(m.ca_id) FROM {{raw_tasks}} c LEFT JOIN {{user_match}} m USING (user_id)
UNION ALL SELECT 'internal_sends', count(*), count(*) FILTER (WHERE known) FROM (
  SELECT len(list_filter(a, lambda x: regexp_extract(x, '[^@]*$') IN ({INTERNAL}))) > 0 AS internal,
         list_has_any(a, (SELECT list(address) FROM {{addresses}})) AS known FROM (
    SELECT {emails_sql('lower(from_email)')} AS a FROM {{raw_emails}} WHERE from_email IS NOT NULL)) WHERE internal""", ID_VIEWS)
def _(t):
    l = links(t)
    return idn.attribution_coverage(t["raw_calls"], t["raw_tasks"], t["raw_emails"], l.users, l.addresses, INTERNAL_DOMAINS)


@query("dim_account_built", "E1", "SELECT * FROM {account_dim}", ID_VIEWS)
def _(t):
    return idn.dim_account(t["raw_companies"], companies(t))


@query("dim_contact_built", "E2", """
SELECT c.id AS contact_id, lower(c.email) AS email, c.firstname, c.lastname, c.jobtitle, w.resolved_company_id AS account_id
FROM {raw_contacts} c LEFT JOIN {contact_cw} w ON w.contact_id = c.id AND w.email = lower(c.email)""", ID_VIEWS)
def _(t):
    return idn.dim_contact(t["raw_contacts"], contacts_cw(t))


@query("activity_flat_built", "E3", """
SELECT activity_id, ca_name, ca_email, contact_firstname, contact_lastname, contact_jobtitle, account_name,
  account_domain, account_icp_tier_validated, account_icp_tier_new, account_vertical, account_is_target
FROM {activity_flat}""")
def _(t):
    return idn.activity_flat(t["activity"], t["dim_ca"], t["dim_contact"], t["dim_account"]).select(
        "activity_id", "ca_name", "ca_email", "contact_firstname", "contact_lastname", "contact_jobtitle",
        "account_name", "account_domain", "account_icp_tier_validated", "account_icp_tier_new",
        "account_vertical", "account_is_target",
    )
