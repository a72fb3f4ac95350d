"""Controlled labels, word lists and constants the rules depend on."""

# ---- fixed values: labels ------------------------------------------------
CHANNELS = (
    "auto_email", "manual_email", "inbound_email", "call", "meeting",
    "li_connect", "li_message", "li_other", "whatsapp", "sms", "other",
    "email_task", "call_task",
)
EXCLUDED_REASONS = (
    "email_task_shadow", "call_task_shadow", "non_ca_sender", "non_ca_user",
    "non_ca_meeting", "internal_only_recipients", "noise_auto_generated",
    "inbound_no_ca_recipient", "invite_email", "no_sender",
)
COUNTED_CHANNELS = (
    "auto_email", "manual_email", "call", "li_connect", "li_message",
    "li_other", "inbound_email", "meeting", "whatsapp", "sms", "other",
)
EMAIL_CHANNELS = ("auto_email", "manual_email")
LINKEDIN_CHANNELS = ("li_connect", "li_message", "li_other")
OTHER_CHANNELS = ("whatsapp", "sms", "other")
NO_ACCOUNT = "(no account matched)"

# ---- fixed values: drill measure -> channels -------------------------------
DRILL_CHANNELS = {
    "total_counted": COUNTED_CHANNELS,
    "emails": EMAIL_CHANNELS,
    "auto_email": ("auto_email",),
    "manual_email": ("manual_email",),
    "dials": ("call",),
    "calls": ("call",),
    "linkedin": LINKEDIN_CHANNELS,
    "inbound_replies": ("inbound_email",),
    "meetings_booked": ("meeting",),
    "other_outreach": OTHER_CHANNELS,
}
KNOWN_OUTCOMES = ("COMPLETED", "CANCELED", "SCHEDULED", "RESCHEDULED")
SCHEDULED_OUTCOMES = ("SCHEDULED", "RESCHEDULED")

# ---- fixed values: windows and lengths --------------------------------------
DEDUP_WINDOW_SECONDS = 180
BODY_PREFIX_CHARS = 150
BODY_PREFIX_MATCH_MIN = 20
CALL_GROUP_GAP_SECONDS = 1800
NEW_MEETING_DAYS = 60
CHURN_SHIELD_MONTHS = 9
LOST_SHIELD_DAYS = 60
LOOKBACK_DAYS = 5
WATERMARK_OVERLAP_SECONDS = 3600

# ---- fixed values: word lists and patterns -----------------------------------
INVITE_SUBJECT_PREFIXES = (
    "invitation:", "updated invitation:", "canceled event", "cancelled event",
    "accepted:", "declined:", "tentatively accepted:", "tentative:",
    "new event:", "event confirmed:", "event canceled:", "event cancelled:",
)
NOISE_SENDER_LOCAL_MARKERS = (
    "noreply", "no-reply", "no_reply", "donotreply", "do-not-reply",
    "mailer-daemon", "postmaster", "notification", "bounce",
)
AUTOREPLY_SUBJECT_PREFIXES = (
    "automatic reply", "auto reply", "auto-reply", "autoreply",
    "out of office", "respuesta autom", "automatische antwort",
    "reponse automatique", "réponse automatique", "risposta automatica",
    "resposta autom", "autosvar", "abwesenheit",
    "undeliverable", "undelivered mail", "delivery status notification",
    "mail delivery", "delivery failure", "failure notice", "returned mail",
)
TASK_CHANNEL = {
    "email": "email_task",
    "phone_call": "call_task",
    "linkedin_message": "li_message",
    "linkedin_voice_message": "li_message",
    "linkedin_video_message": "li_message",
    "linkedin_connect": "li_connect",
    "linkedin_visit": "li_other",
    "linkedin_follow": "li_other",
    "linkedin_like_last_post": "li_other",
    "whatsapp": "whatsapp",
    "sms": "sms",
}
HUMAN_EMAIL_SOURCES = ("EMAIL", "CRM_UI")
KNOWN_SYNC_TOOLS = ("Amplemarket", "Apollo Integration")
WARMUP_SUBJECT_MARKERS = ("lemwarmup", "lemwarm", "amplemarketwarmup", "warmupemail")
TOOL_PREFIX_PATTERN = r"^(?:\[[^\]]{1,40}\]\s*)+"
REPLY_PREFIX_PATTERN = r"(?i)^(?:(?:(?:re|aw|fw|fwd|sv|vs|wg|antw|tr|rv)\s*:|r\.e\.:?)\s*)+"
EXTERNAL_TAG_PATTERN = r"(?i)^(?:ext|external)\s*:\s*"
BODY_BANNER_PATTERNS = (
    r"^this is the first time you'?re receiving an email from this person\.?\s*"
    r"(?:make sure you check the email address[^.]*\.\s*)?",
    r"^you don'?t often get email from \S+\.?\s*(?:learn why this is important\.?)?\s*",
    r"^caution:? this email originated from outside[^.]*\.\s*",
    r"^\[?external(?: email)?\]?:?\s+",
)
FREE_EMAIL_DOMAINS = (
    "gmail.com", "googlemail.com", "yahoo.com", "yahoo.co.uk", "hotmail.com",
    "hotmail.co.uk", "outlook.com", "live.com", "msn.com", "aol.com",
    "icloud.com", "me.com", "mac.com", "proton.me", "protonmail.com",
    "gmx.com", "gmx.de", "qq.com", "163.com", "126.com", "yandex.com",
    "mail.com", "zoho.com",
)
NAME_STOPWORDS = (
    "inc", "ltd", "llc", "gmbh", "co", "corp", "corporation", "company",
    "group", "holdings", "holding", "technologies", "technology", "tech",
    "ai", "labs", "io", "the", "plc", "sa", "ab", "bv", "oy", "limited",
)

# ---- fixed values: monthly results sheet --------------------------------------
SHEET_BLOCKS = {
    "SAOs Achieved": "saos",
    "% Target Hit": None,
    "SAOs Target": "sao_target",
    "Pipeline Created": "pipeline_usd",
    "Inbounds SAOs": "saos_inbound",
    "Event SAOs": "saos_event",
    "Overall CA Performance": None,
}
SHEET_LEAST_MONTHS = 12
SHEET_NON_REP_ROWS = (
    "", "Overall", "Overall %", "UK CA", "US CA", "Reps in Seat",
    "Ramping Reps", "SAOs per CA (effectiveness)", "SAO ACV Band",
    "Forecasted SAOs", "Nuances", "SAOs per rep in seat", "Inbounds SAOs",
)

# ---- fixed values: message-reuse normalisation ---------------------------------
GREETING_PATTERN = (
    r"(?i)^\s*(?:hi|hey|hello|hiya|dear|good morning|good afternoon|good evening)\b"
    r"[ \t]*(?:[A-Z][\w'’.\-]*(?:[ \t]+[A-Z][\w'’.\-]*){0,2})?[ \t]*[,\-–—:!.]*[ \t]*"
)
SIGNOFF_PATTERN = (
    r"(?i)^\s*(?:best regards|kind regards|warm regards|best wishes|all the best|"
    r"many thanks|thank you|thanks|cheers|best|regards|sincerely|speak soon|"
    r"talk soon|warmly|looking forward)\s*[,.!]?\s*$"
)
TITLE_LINE_PATTERN = (
    r"(?i)^\s*(?:commercial associate|technical pm|enterprise ai|ai\s*/\s*ml|"
    r"account executive|sales development|growth|founder|partnerships)\s*$"
)
DISCLAIMER_PATTERN = (
    r"(?i)^\s*(?:reg\.?\s*address|registered address|this email|this e-mail|"
    r"confidential|the information contained)"
)
QUOTE_HEADER_PATTERN = r"(?ims)^\s*On\s.{4,90}\bwrote:\s*$"
QUOTE_SENDER_PATTERN = r"(?is)On\s.{4,120}?<\s*([^>\s]+@[^>\s]+)\s*>\s*wrote:"
ORIGINAL_MESSAGE_PATTERN = r"(?im)^\s*-{2,}\s*Original Message\s*-{2,}"
UNDERSCORE_RULE_PATTERN = r"(?im)^\s*_{5,}\s*$"
CONTACT_LINE_PATTERN = r"(?i)(?:@{domain}|www\.{domain}|linkedin|\| {brand}\b|website\s*:)"
SPACE_BEFORE_MARK_PATTERN = r"\s+([,.!?;:])"
MERGE_TOKEN_PATTERN = r"<(?:fn|ln|acct|title|url|email)>"
HTML_DROPPED_PATTERN = r"(?is)<(script|style|head|title)[^>]*>.*?</\1>"
HTML_BREAK_PATTERN = r"(?i)<br\s*/?>"
HTML_BLOCK_END_PATTERN = r"(?i)</(?:div|p|tr|li|blockquote|h[1-6]|table)>"
HTML_TAG_PATTERN = r"<[^>]+>"
URL_PATTERN = r"https?://\S+|www\.\S+"
EMAIL_PATTERN = r"[\w.+-]+@[\w-]+\.[\w.-]+"
DEFAULT_SHINGLE_WORDS = 4
DEFAULT_FAMILY_THRESHOLD = 0.45
DEFAULT_FAMILY_SIZE = 3
MINHASH_PRIME = (1 << 31) - 1
MINHASH_PERMUTATIONS = 64
MINHASH_BANDS = 16
