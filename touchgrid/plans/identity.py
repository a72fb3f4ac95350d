"""Identity resolution: reps and their addresses, companies, contacts, review lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchgrid import vocab
from touchgrid.functions.text import (
    display_name, domain_of, extract_emails, is_internal, name_tokens, norm_domain, norm_local,
)
from touchgrid.operators.keyed import first_per_key, id_order, nulls_last, order_struct


class RosterError(RuntimeError):
    """The derived roster is unsafe to publish."""


# --------------------------------------------------------------------- roster
def derive_roster(owners: DataFrame, config: DataFrame) -> DataFrame:
    """Current owners in a rep team and not in that team's parent; one row per owner.

    `owners.teams` is an array of team names.
    """
    live = owners.where(~F.coalesce(F.col("archived"), F.lit(False)) & F.col("email").isNotNull())
    member = live.withColumn("ca_team_name", F.explode(F.array_distinct("teams"))).join(config, "ca_team_name")
    return (
        member.where(~F.array_contains("teams", F.col("parent_team_name")))
        .groupBy(F.col("id").alias("ca_id"), "first_name", "last_name", "email")
        .agg(F.array_join(F.array_sort(F.collect_list("ca_team_name")), "; ").alias("ca_teams"))
        .select(
            "ca_id", F.coalesce(display_name("first_name", "last_name"), F.lit("")).alias("name"),
            F.lower("email").alias("primary_email"), "ca_teams",
        )
    )


def unmatched_config(owners: DataFrame, config: DataFrame) -> DataFrame:
    """Config rows whose team or parent team no current owner is in."""
    present = (
        owners.where(~F.coalesce(F.col("archived"), F.lit(False)))
        .select(F.explode("teams").alias("team"))
        .distinct()
    )
    names = config.select(
        "ca_team_name", "parent_team_name", F.explode(F.array("ca_team_name", "parent_team_name")).alias("team")
    )
    return names.join(present, "team", "left_anti").select("ca_team_name", "parent_team_name", F.col("team").alias("missing"))


def shared_locals(roster: DataFrame) -> DataFrame:
    """Dot-insensitive local parts that more than one rep has."""
    return (
        roster.groupBy(norm_local("primary_email").alias("local"))
        .agg(F.count(F.lit(1)).alias("reps"))
        .where("reps > 1")
    )


def guard_roster(roster: DataFrame, owners: DataFrame, config: DataFrame) -> None:
    """Raise before anything is written when the roster looks wrong."""
    if roster.isEmpty():
        raise RosterError("no rep could be derived from owners and team config")
    bad = [r.asDict() for r in unmatched_config(owners, config).limit(20).collect()]
    if bad:
        raise RosterError(f"team config matches no current owner: {bad}")


def guard_locals(roster: DataFrame) -> None:
    twins = [r.local for r in shared_locals(roster).limit(20).collect()]
    if twins:
        raise RosterError(f"reps share a local part, address matching is ambiguous: {twins}")


def retain_departed(current: DataFrame, prior: DataFrame | None, purge: bool = False) -> DataFrame:
    """Current reps plus earlier ones marked inactive; `purge` forgets the earlier ones."""
    active = current.withColumn("is_active", F.lit(True))
    if purge or prior is None:
        return active
    gone = prior.select(*current.columns).join(current.select("ca_id"), "ca_id", "left_anti")
    return active.unionByName(gone.withColumn("is_active", F.lit(False)))


def retain_links(links: DataFrame, prior: DataFrame, roster: DataFrame, key: str) -> DataFrame:
    """Add earlier links of inactive reps where the key has no live link now."""
    inactive = roster.where("NOT is_active").select("ca_id")
    kept = prior.join(inactive, "ca_id", "left_semi").join(links.select(key), key, "left_anti")
    if "source" in links.columns:
        kept = kept.withColumn("source", F.lit("retained_departed"))
    return links.unionByName(kept.select(*links.columns))


# ------------------------------------------------------------------ addresses
@dataclass
class AddressLinks:
    addresses: DataFrame   # address, ca_id, source
    users: DataFrame       # user_id, ca_id
    parked: DataFrame      # kind, key, detail
    collisions: DataFrame  # kind, record_id, address, ca_id


def _by_local(roster: DataFrame) -> DataFrame:
    return roster.select(
        norm_local("primary_email").alias("local"), "ca_id", F.col("name").alias("ca_name"),
        "primary_email", "is_active",
    )


def user_addresses(users: DataFrame) -> DataFrame:
    """(user_id, pos, address): the user's e-mail first, then the mailboxes in order.

    `users.mailboxes` is an array of addresses.
    """
    boxes = F.concat(F.array(F.col("email")), F.coalesce("mailboxes", F.array().cast("array<string>")))
    return (
        users.select(F.col("id").alias("user_id"), F.posexplode(boxes).alias("pos", "address"))
        .where(F.col("address").isNotNull())
        .withColumn("address", F.lower("address"))
    )


def match_users(users: DataFrame, roster: DataFrame, internal_domains: Sequence[str]) -> DataFrame:
    """user_id -> rep through the first internal address whose local part is a rep's."""
    return (
        user_addresses(users)
        .where(is_internal("address", internal_domains))
        .withColumn("local", norm_local("address"))
        .join(_by_local(roster), "local")
        .groupBy("user_id")
        .agg(F.min_by("ca_id", "pos").alias("ca_id"))
    )


def observed_senders(emails: DataFrame) -> DataFrame:
    """(address, n): how many messages carry an address in their sender field."""
    heads = (
        emails.where(F.col("from_email").isNotNull())
        .groupBy(F.lower("from_email").alias("head"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        heads.select(F.explode(F.array_distinct(extract_emails("head"))).alias("address"), "n")
        .groupBy("address")
        .agg(F.sum("n").alias("n"))
    )


def link_addresses(
    roster: DataFrame, users: DataFrame, emails: DataFrame, owners: DataFrame,
    internal_domains: Sequence[str], linkable_domains: Sequence[str],
) -> AddressLinks:
    """Sending addresses of every rep; the first source that proves an address wins.

    Sources in order: the rep's own e-mail, the mailboxes of a matched user, and
    addresses seen as senders. A seen address is linked only when it is known to be the
    rep's own or the rep has left; everything else is parked for review.
    """
    reps = _by_local(roster)
    linkable = is_internal("address", linkable_domains)

    own = reps.where(is_internal("primary_email", linkable_domains)).select(
        F.col("primary_email").alias("address"), "ca_id", F.lit("owner_primary").alias("source"), F.lit(0).alias("rank")
    )
    matched = match_users(users, roster, internal_domains)
    boxes = user_addresses(users).join(matched.withColumnRenamed("ca_id", "user_ca"), "user_id")
    boxes = boxes.withColumn("local", norm_local("address")).join(
        reps.select("local", "ca_id"), "local", "left"
    )
    mailbox = boxes.where(F.col("ca_id").isNotNull() & linkable).select(
        "address", "ca_id", F.lit("user_mailbox").alias("source"), F.lit(1).alias("rank")
    )
    verified = boxes.select("address", F.col("user_ca").alias("ca_id"), F.lit(True).alias("verified")).distinct()

    seen = (
        observed_senders(emails)
        .where(is_internal("address", internal_domains))
        .withColumn("local", norm_local("address"))
        .join(reps, "local", "left")
        .join(verified, ["address", "ca_id"], "left")
    )
    is_own = F.coalesce(F.col("verified"), F.lit(False)) | (F.col("address") == F.col("primary_email"))
    proven = F.col("ca_id").isNotNull() & linkable & (is_own | ~F.col("is_active"))
    observed = seen.where(proven).select(
        "address", "ca_id",
        F.when(is_own, "observed_sender").otherwise("observed_sender_departed").alias("source"),
        F.lit(2).alias("rank"),
    )
    addresses = first_per_key(
        own.unionByName(mailbox).unionByName(observed), ["address"], [F.col("rank"), F.col("ca_id")]
    ).drop("rank")

    parked_box = boxes.where(F.col("ca_id").isNull() | ~linkable).select(
        F.lit("address_parked").alias("kind"), F.col("address").alias("key"),
        F.when(F.col("ca_id").isNull(), "mailbox of a matched user, no rep has this local part")
        .otherwise("mailbox of a matched user, domain cannot be linked").alias("detail"),
        F.lit(0).alias("rank"),
    )
    parked_seen = seen.where(~F.coalesce(proven, F.lit(False))).select(
        F.lit("address_parked").alias("kind"), F.col("address").alias("key"),
        F.concat(
            F.when(F.col("ca_id").isNull(), "internal sender, no rep has this local part")
            .otherwise("shares a rep's local part but is not verified"),
            F.lit(" ("), F.col("n").cast("string"), F.lit(" emails)"),
        ).alias("detail"),
        F.lit(1).alias("rank"),
    )
    parked = first_per_key(parked_box.unionByName(parked_seen), ["kind", "key"], [F.col("rank"), F.col("detail")])
    parked = parked.drop("rank").join(addresses.select(F.col("address").alias("key")), "key", "left_anti")

    stray_users = (
        user_addresses(users)
        .join(matched, "user_id", "left_anti")
        .withColumn("local", norm_local("address"))
        .join(reps.select("local", "ca_id"), "local")
        .select(F.lit("user").alias("kind"), F.col("user_id").alias("record_id"), "address", "ca_id")
        .distinct()
    )
    stray_owners = (
        owners.where(~F.coalesce(F.col("archived"), F.lit(False)) & F.col("email").isNotNull())
        .select(F.col("id").alias("record_id"), F.lower("email").alias("address"))
        .join(roster.select(F.col("ca_id").alias("record_id")), "record_id", "left_anti")
        .withColumn("local", norm_local("address"))
        .join(reps.select("local", "ca_id"), "local")
        .select(F.lit("owner").alias("kind"), "record_id", "address", "ca_id")
    )
    return AddressLinks(
        addresses, matched, parked.select("kind", "key", "detail"), stray_users.unionByName(stray_owners)
    )


# ------------------------------------------------------------------ companies
def _with_domain(companies: DataFrame, free_domains: Sequence[str]) -> DataFrame:
    usable = norm_domain("domain")
    return companies.withColumns(
        {
            "domain_norm": F.when(~usable.isin(*free_domains), usable),
            "has_owner": F.coalesce(F.col("target_account_owner") != "", F.lit(False)),
        }
    )


def resolve_companies(
    companies: DataFrame, free_domains: Sequence[str] = vocab.FREE_EMAIL_DOMAINS,
    stopwords: Sequence[str] = vocab.NAME_STOPWORDS,
) -> DataFrame:
    """Company crosswalk with its review reason.

    Companies of one domain fold into the best member (has an owner, created first,
    lowest id), but only when their names share a meaningful token with it; the rest
    stay canonical on their own and are flagged.
    """
    c = _with_domain(companies, free_domains).select("id", "name", "domain_norm", "has_owner", "created")
    best = (
        c.where(F.col("domain_norm").isNotNull())
        .groupBy("domain_norm")
        .agg(
            F.min_by(
                F.struct("id", "name"),
                order_struct([~F.col("has_owner"), *nulls_last("created"), id_order("id")]),
            ).alias("_best")
        )
        .select("domain_norm", F.col("_best.id").alias("best_id"), F.col("_best.name").alias("best_name"))
    )
    j = c.join(best, "domain_norm", "left")
    is_best = F.col("id") == F.col("best_id")
    agrees = F.arrays_overlap(name_tokens("name", stopwords), name_tokens("best_name", stopwords))
    folds = F.col("best_id").isNotNull() & (is_best | agrees)
    return j.select(
        F.col("id").alias("company_id"),
        F.when(folds, F.col("best_id")).otherwise(F.col("id")).alias("resolved_company_id"),
        "domain_norm",
        (~folds | is_best).alias("is_canonical"),
        "name", "best_id", "best_name",
        F.when(F.col("best_id").isNotNull() & ~folds, "company_domain_conflict")
        .when(F.col("domain_norm").isNull() & F.col("has_owner"), "company_no_domain")
        .alias("review"),
    )


def company_review(resolved: DataFrame) -> DataFrame:
    """Review rows: owned companies without a domain, and name conflicts."""
    conflict = F.concat(
        F.coalesce("name", F.lit("")), F.lit(" shares "), F.coalesce("domain_norm", F.lit("")), F.lit(" with "),
        F.coalesce("best_name", F.lit("")), F.lit(" ("), F.coalesce("best_id", F.lit("")), F.lit("), names disagree"),
    )
    return resolved.where(F.col("review").isNotNull()).select(
        F.col("review").alias("kind"), F.col("company_id").alias("key"),
        F.when(F.col("review") == "company_no_domain", F.col("name")).otherwise(conflict).alias("detail"),
    )


# ------------------------------------------------------------------- contacts
def contact_crosswalk(contacts: DataFrame, company_crosswalk: DataFrame) -> DataFrame:
    """e-mail -> lowest contact id -> resolved company."""
    lowest = (
        contacts.where(F.col("email").isNotNull())
        .groupBy(F.lower("email").alias("email"))
        .agg(F.min_by(F.struct("id", "associated_company_id"), id_order("id")).alias("_c"))
    )
    companies = company_crosswalk.select(F.col("company_id").alias("_company"), "resolved_company_id")
    return lowest.join(companies, F.col("_c.associated_company_id") == F.col("_company"), "left").select(
        "email", F.col("_c.id").alias("contact_id"), "resolved_company_id"
    )


def external_contact_map(tasks: DataFrame, calls: DataFrame, contacts_by_email: DataFrame) -> DataFrame:
    """Dialer contact id -> its e-mail -> contact id."""
    both = tasks.select("contact_id", "contact_email").unionByName(calls.select("contact_id", "contact_email"))
    first = (
        both.where(F.col("contact_id").isNotNull() & F.col("contact_email").isNotNull())
        .groupBy(F.col("contact_id").alias("external_contact_id"))
        .agg(F.min(F.lower("contact_email")).alias("_raw"))
        .select("external_contact_id", F.try_element_at(extract_emails("_raw"), F.lit(1)).alias("email"))
    )
    return first.join(contacts_by_email.select("email", "contact_id"), "email", "left").select(
        "external_contact_id", "email", "contact_id"
    )


def activity_addresses(
    tasks: DataFrame, calls: DataFrame, emails: DataFrame, internal_domains: Sequence[str],
    email_fields: Sequence[str] = ("from_email", "to_email", "cc_email", "bcc_email"),
) -> DataFrame:
    """Distinct outside addresses seen in activity; a header text that recurs is parsed once."""
    heads = (
        tasks.select(F.col("contact_email").alias("head"))
        .unionByName(calls.select(F.col("contact_email").alias("head")))
        .unionByName(emails.select(F.explode(F.array(*email_fields)).alias("head")))
    )
    return (
        heads.where("head IS NOT NULL").distinct()
        .select(F.explode(F.array_distinct(extract_emails("head"))).alias("email"))
        .where(~is_internal("email", internal_domains))
        .distinct()
    )


def unmatched_contacts(addresses: DataFrame, contacts_by_email: DataFrame) -> DataFrame:
    return addresses.join(contacts_by_email.select("email"), "email", "left_anti").select(
        F.lit("contact_email_unmatched").alias("kind"), F.col("email").alias("key"),
        F.lit("seen in activity, no contact").alias("detail"),
    )


def activity_scoped_contacts(contacts: DataFrame, addresses: DataFrame) -> DataFrame:
    """Contacts that appear in activity."""
    return contacts.join(addresses, F.lower(contacts["email"]) == addresses["email"], "left_semi")


def review_list(*parts: DataFrame) -> DataFrame:
    """All review rows, one per (kind, key); earlier parts win."""
    ranked = None
    for i, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(i))
        ranked = p if ranked is None else ranked.unionByName(p)
    return first_per_key(ranked, ["kind", "key"], [F.col("_part"), F.col("detail")]).drop("_part")


# ------------------------------------------------------------------- coverage
def attribution_coverage(
    calls: DataFrame, tasks: DataFrame, emails: DataFrame, users: DataFrame, addresses: DataFrame,
    internal_domains: Sequence[str],
) -> DataFrame:
    """(what, total, attributed) for calls, tasks and internally sent messages."""

    def by_user(rows: DataFrame, what: str) -> DataFrame:
        per_user = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        return per_user.join(users, "user_id", "left").agg(
            F.lit(what).alias("what"), F.sum("n").alias("total"),
            F.coalesce(F.sum(F.when(F.col("ca_id").isNotNull(), F.col("n"))), F.lit(0)).alias("attributed"),
        )

    heads = (
        emails.where(F.col("from_email").isNotNull())
        .groupBy(F.lower("from_email").alias("head"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("address", F.explode(extract_emails("head")))
        .join(addresses.select("address", "ca_id"), "address", "left")
        .groupBy("head", "n")
        .agg(
            F.bool_or(is_internal("address", internal_domains)).alias("internal"),
            F.bool_or(F.col("ca_id").isNotNull()).alias("known"),
        )
    )
    sent = heads.where("internal").agg(
        F.lit("internal_sends").alias("what"), F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("attributed"),
    )
    return by_user(calls, "calls").unionByName(by_user(tasks, "tasks")).unionByName(sent)


# ----------------------------------------------------------------- dimensions
def dim_account(companies: DataFrame, company_crosswalk: DataFrame) -> DataFrame:
    """Canonical companies with owner; an empty owner is no owner."""
    canon = company_crosswalk.where(F.col("is_canonical") & (F.col("resolved_company_id") == F.col("company_id")))
    owner = F.nullif(F.col("target_account_owner"), F.lit(""))
    extra = [c for c in ("icp_tier_validated", "icp_tier_new", "vertical") if c in companies.columns]
    return companies.join(canon.select(F.col("company_id").alias("id")), "id").select(
        F.col("id").alias("account_id"), "name", "domain", *extra,
        owner.alias("owner_rep_id"), owner.isNotNull().alias("is_target"),
    )


def dim_contact(contacts: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Contacts with the account their crosswalk row (same id and address) resolves to."""
    cw = crosswalk.select(
        F.col("contact_id").alias("_id"), F.col("email").alias("_email"),
        F.col("resolved_company_id").alias("account_id"),
    )
    c = contacts.withColumn("email", F.lower("email"))
    return c.join(cw, (F.col("id") == F.col("_id")) & (F.col("email") == F.col("_email")), "left").select(
        F.col("id").alias("contact_id"), "email", "firstname", "lastname", "jobtitle", "account_id"
    )


def activity_flat(activity: DataFrame, dim_ca: DataFrame, contact: DataFrame, account: DataFrame) -> DataFrame:
    """The fact table with rep, contact and account attributes attached."""
    ca = dim_ca.select("ca_id", F.col("name").alias("ca_name"), F.col("primary_email").alias("ca_email"))
    ct = contact.select(
        "contact_id", F.col("firstname").alias("contact_firstname"), F.col("lastname").alias("contact_lastname"),
        F.col("jobtitle").alias("contact_jobtitle"),
    )
    ac = account.select(
        F.col("account_id").alias("company_id"), F.col("name").alias("account_name"),
        F.col("domain").alias("account_domain"),
        *[F.col(c).alias(f"account_{c}") for c in ("icp_tier_validated", "icp_tier_new", "vertical", "is_target")
          if c in account.columns],
    )
    return activity.join(ca, "ca_id", "left").join(ct, "contact_id", "left").join(ac, "company_id", "left")
