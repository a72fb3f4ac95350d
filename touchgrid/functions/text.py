"""Whole-column text rules: addresses, subjects, bodies, names, labels.

Everything here is a Column expression, so it stays inside the JVM and inside
whole-stage code generation wherever the builtin allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchgrid import vocab


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# every character that counts as white space, for literal trims and one regex class
SPACE_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# The same class for long texts: single characters are looked up in a table, and others are mostly told by one comparison.
BLANKS = (
    r"[ \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]+"
)


def wide(pattern: str) -> str:
    """The pattern with its white-space class widened to every character in SPACE_CHARS."""
    return pattern.replace(r"\s", SPACE)


def strip(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(_col(c), F.lit(SPACE_CHARS))


def squeeze(c: Column | str) -> Column:
    """Runs of white space become one blank."""
    return F.regexp_replace(_col(c), BLANKS, " ")


def java_quote(text: str) -> str:
    """Regex-quote a literal for the JVM."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def any_literal(options: Sequence[str]) -> str:
    return "(?:" + "|".join(java_quote(o) for o in options) + ")"


# ------------------------------------------------------------------ addresses
def extract_emails(c: Column | str) -> Column:
    """Ordered lower-case plain addresses of a ';'-separated header field."""

    def bracketed(x: Column) -> Column:
        lo, hi = F.instr(x, F.lit("<")), F.instr(x, F.lit(">"))
        return F.when((lo > 0) & (hi > 0), strip(F.substring(x, lo + 1, hi - lo - 1))).otherwise(x)

    parts = F.transform(F.split(F.lower(F.coalesce(_col(c), F.lit(""))), ";"), strip)
    return F.filter(
        F.transform(parts, bracketed),
        lambda x: (F.instr(x, F.lit("@")) > 0) & (F.instr(domain_of(x), F.lit(".")) > 0),
    )


def domain_of(c: Column | str) -> Column:
    return F.substring_index(_col(c), "@", -1)


def second_part(c: Column | str) -> Column:
    """The piece between the first and the second '@'."""
    return F.split_part(_col(c), F.lit("@"), F.lit(2))


def is_internal(c: Column | str, internal_domains: Sequence[str]) -> Column:
    return domain_of(c).isin(list(internal_domains))


def norm_local(c: Column | str) -> Column:
    """Local part, dots removed: 'a.b@x' and 'ab@x' are the same person."""
    return F.lower(F.replace(F.substring_index(_col(c), "@", 1), F.lit("."), F.lit("")))


def norm_domain(c: Column | str) -> Column:
    """Web address -> comparable host, NULL when it cannot be one."""
    d = F.lower(strip(c))
    d = F.substring_index(F.substring_index(d, "//", -1), "/", 1)
    d = F.regexp_replace(strip(d), r"\.+$", "")
    d = F.regexp_replace(d, r"^www\.", "")
    return F.when(d.contains(".") & ~d.contains(" "), d)


def name_tokens(c: Column | str, stopwords: Sequence[str] = vocab.NAME_STOPWORDS) -> Column:
    toks = F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    )
    kept = F.array_except(toks, F.array(*[F.lit(s) for s in stopwords]))
    return F.when(F.size(kept) > 0, kept).otherwise(toks)


def display_name(first: Column | str, last: Column | str) -> Column:
    full = F.concat(F.coalesce(_col(first), F.lit("")), F.lit(" "), F.coalesce(_col(last), F.lit("")))
    return F.nullif(F.trim(full), F.lit(""))


# ------------------------------------------------------------------- subjects
def strip_tool_prefixes(c: Column | str) -> Column:
    return F.regexp_replace(strip(F.coalesce(_col(c), F.lit(""))), wide(vocab.TOOL_PREFIX_PATTERN), "")


def strip_reply_prefixes(c: Column | str) -> Column:
    return strip(F.regexp_replace(strip(F.coalesce(_col(c), F.lit(""))), wide(vocab.REPLY_PREFIX_PATTERN), ""))


def norm_subject(c: Column | str) -> Column:
    """Comparable subject; never NULL."""
    return F.lower(strip(squeeze(strip_reply_prefixes(strip_tool_prefixes(c)))))


def classification_subject(c: Column | str) -> Column:
    """Tool tags and one external-mail tag removed; reply markers stay."""
    s = F.regexp_replace(strip_tool_prefixes(c), wide(vocab.EXTERNAL_TAG_PATTERN), "")
    return F.ltrim(F.lower(s), F.lit(SPACE_CHARS))


def subject_is_invite(c: Column | str) -> Column:
    return classification_subject(c).rlike("^" + any_literal(vocab.INVITE_SUBJECT_PREFIXES))


def subject_is_autoreply(c: Column | str) -> Column:
    return classification_subject(c).rlike("^" + any_literal(vocab.AUTOREPLY_SUBJECT_PREFIXES))


def sender_is_noise(c: Column | str) -> Column:
    """Machine sender by its local part (text before the last '@'); NULL -> false."""
    local = F.lower(F.regexp_replace(_col(c), r"@[^@]*$", ""))
    return F.coalesce(local.rlike(any_literal(vocab.NOISE_SENDER_LOCAL_MARKERS)), F.lit(False))


def has_warmup_marker(c: Column | str, markers: Sequence[str] = vocab.WARMUP_SUBJECT_MARKERS) -> Column:
    return F.coalesce(F.lower(_col(c)).rlike(any_literal(markers)), F.lit(False))


# --------------------------------------------------------------------- bodies
def norm_body_prefix(c: Column | str, chars: int = vocab.BODY_PREFIX_CHARS) -> Column:
    """First characters of a body after white space and client banners are gone."""
    t = F.lower(strip(squeeze(c)))
    for banner in vocab.BODY_BANNER_PATTERNS:
        t = F.regexp_replace(t, banner, "")
    return F.nullif(F.left(t, F.lit(chars)), F.lit(""))


def bodies_match(a: Column | str, b: Column | str, least: int = vocab.BODY_PREFIX_MATCH_MIN) -> Column:
    """Equal, or the shorter (>= `least` characters) starts the longer."""
    a, b = _col(a), _col(b)
    shorter = F.least(F.length(a), F.length(b)) >= least
    return (a == b) | (shorter & (F.startswith(a, b) | F.startswith(b, a)))


def preview_text(preview: Column | str, html: Column | str) -> Column:
    """Stored preview, or the tag-stripped HTML when the preview is empty."""
    bare = strip(squeeze(F.regexp_replace(_col(html), r"<[^>]+>", " ")))
    return F.coalesce(F.nullif(_col(preview), F.lit("")), bare)


# --------------------------------------------------------------------- labels
def task_channel(c: Column | str, mapping: dict[str, str] | None = None) -> Column:
    mapping = vocab.TASK_CHANNEL if mapping is None else mapping
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, F.coalesce(_col(c), F.lit(""))), F.lit("other"))


def rate(num: Column, den: Column, scale: float | int = 100, digits: int = 1) -> Column:
    """round(scale * num / den), half up, NULL when den is 0."""
    n = num.cast("decimal(20,0)") * F.lit(int(scale)).cast("decimal(5,0)")
    return F.round(n / F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")), digits)


def contains_text(c: Column | str, needle: str) -> Column:
    """Case-insensitive substring search with the wildcard characters taken literally."""
    if needle == "":
        return F.lit(True)
    safe = needle.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.coalesce(_col(c).ilike(f"%{safe}%"), F.lit(False))


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words; '' and NULL have none."""
    t = strip(F.coalesce(_col(c), F.lit("")))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE + "+")))


def words(c: Column | str) -> Column:
    t = strip(F.coalesce(_col(c), F.lit("")))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE + "+"))


# ---------------------------------------------------------------------- dates
def week_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "week")


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "month")


def month_end(d: Column | str) -> Column:
    return F.last_day(_col(d))


def churn_label(d: Column | str) -> Column:
    return F.concat(F.lit("Churned "), F.date_format(_col(d), "MMM yyyy"))


def lost_label(d: Column | str) -> Column:
    return F.concat(F.lit("Lost "), F.date_format(_col(d), "dd MMM"))
