"""Word lists, formats and constants that results depend on."""

# ---- Fixed values: message states -------------------------------------------
STATUSES = (
    "pending",
    "filtering",
    "pending_classification",
    "classifying",
    "deal",
    "not_deal",
    "filter_rejected",
    "failed",
    "dead",
)
ACTIVE_STATUSES = ("pending", "filtering", "pending_classification", "classifying")
BATCH_TYPES = ("filter", "classify")
BATCH_EVENT_TYPES = ("new", "retrigger", "complete", "dead_letter")
MEGA_BATCH_PREFIX = "mega:"

# ---- Fixed values: job parameters -------------------------------------------
STUCK_MINUTES = 5
ORPHAN_MINUTES = 30
MAX_ATTEMPTS = 6

# ---- Fixed values: rejection word lists -------------------------------------
AUTH_PASS_MARKS = ("dkim=pass", "spf=pass", "dmarc=pass")
BLOCKED_PREFIXES = (
    "accountservices@",
    "accounts@",
    "admin@",
    "alerts@",
    "auto@",
    "automated@",
    "billing@",
    "care@",
    "contact@",
    "customerservice@",
    "do-not-reply@",
    "do_not_reply@",
    "donotreply@",
    "edm.support@",
    "help@",
    "imports@",
    "info@",
    "invitations@",
    "mailer@",
    "marketing@",
    "meetings-noreply@google.com",
    "no-reply@",
    "noreply@",
    "notification@",
    "notify@",
    "promotions@",
    "quickbooks@",
    "robot@",
    "sales@",
    "service@",
    "social@",
    "socials@",
    "subscriptions@",
    "support@",
    "team@",
    "updates@",
    "verify@",
    "welcome@",
)
BLOCKED_DOMAIN_TOKENS = (
    ".gov",
    "automations.",
    "crm.",
    "email.",
    "mailer.",
    "marketing.",
    "news.",
    "newsletter.",
    "transactional.",
    "updates.",
    "mailer-",
)
BULK_HEADERS = ("list-id", "precedence", "x-mailing-list")
BULK_PRECEDENCE_VALUES = ("auto_reply", "bulk")
MAILING_TOOLS = ("activecampaign", "constantcontact", "hubspot", "mailchimp", "sendgrid")
AUTOMATED_SUBJECT_TERMS = (
    "newsletter",
    "order confirmation",
    "promo",
    "promotion",
    "receipt for your purchase",
    "special offer",
    "subscription confirmation",
    "thank you for your order",
    "updates",
    "weekly digest",
)
IMPERSONAL_NAMES = (
    "ad",
    "customer support",
    "daily update",
    "digest",
    "mailing list",
    "newsletter",
    "promo",
    "subscription",
    "system notifications",
    "the team",
    "updates team",
    "weekly update",
)
FREE_MAIL_PATTERNS = (
    r"^(info|support|updates|no-?reply|notifications|newsletter|promo)[a-z0-9]*"
    r"@(gmail|yahoo|outlook|hotmail)\.(com|net)$",
)

# ---- Fixed values: text of a classification batch ---------------------------
BODY_MAX_CHARS = 3000
TRUNCATION_MARK = "\n[... truncated]"
THREAD_HEADER_FORMAT = (
    "THREAD_ID_INDEX: %d\nMODE: FULL_THREAD\nMessage Count: %d\nPREVIOUS_AI_SUMMARY: %s\n\n"
)
MESSAGE_FORMAT = "[Message %d]\nFrom: %s\nDate: %s\nSubject: %s\n\n%s\n\n"
THREAD_FOOTER = "===\n"
NO_SUMMARY = "None"
NO_BODY = "[no body]"
CREATOR_LINE_FORMAT = "Creator email: %s\n\n"
THREAD_DATA_MARK = "{{THREAD_DATA}}"
LLAMA_MODEL_MARK = "llama"

# ---- Fixed values: model replies --------------------------------------------
CATEGORIES = (
    "new",
    "in_progress",
    "completed",
    "not_interested",
    "likely_scam",
    "low_confidence",
)
DEAL_TYPES = (
    "brand_collaboration",
    "sponsorship",
    "affiliate",
    "product_seeding",
    "ambassador",
    "content_partnership",
    "paid_placement",
    "other_business",
)
DEFAULT_CATEGORY = "low_confidence"
DEFAULT_DEAL_TYPE = "other_business"
SCAM_CATEGORY = "likely_scam"
DEFAULT_SCORE = 5
SCORE_RANGE = (1, 10)
SUMMARY_MAX_CHARS = 1000
DEFAULT_CURRENCY = "USD"
CONTACT_TYPE = "primary"
REPLY_LAYERS = ("cached", "primary", "corrective", "fallback")
CORRECTIVE_SUFFIX = "(corrective-retry)"
NO_JSON_ERROR = "No valid JSON found in response"
NO_SINGLE_ARRAY_ERROR = "Cannot extract JSON array from response"
NOT_AN_ARRAY_ERROR = "Response is not a JSON array"

# ---- Fixed values: quality of model runs ------------------------------------
INPUT_TOKEN_COST = 0.000001
OUTPUT_TOKEN_COST = 0.000002
WINNER_MARGIN = 0.001
MIN_RECALL = 0.95
MIN_PRECISION = 0.4
MAX_RECALL_STDDEV = 0.03

# ---- Fixed values: scans and look-back windows ------------------------------
LOOKBACK = "LOOKBACK"
SYNC_SUCCESS_EVENTS = ("metadata_ingestion_end", "content_ingestion_end", "completed")
SYNC_FAILURE_EVENTS = ("metadata_ingestion_failed", "content_ingestion_failed")
SCAN_COMPLETE_EVENT = "scan_complete"
LOOKBACK_DAYS = 60
LOOKBACK_FALLBACK_DAYS = 45
LOOKBACK_MAX_DAYS = 3650
LOOKBACK_FALLBACK_EVENT = "uei_lookback_fallback"
LOOKBACK_FALLBACK_REASONS = (
    "gmail_quota",
    "gmail_rate_limit",
    "batch_processing_constraint",
    "operational_window_exceeded",
)

# ---- Fixed values: identifiers and quotes -----------------------------------
ID_PATTERN = r"^[a-zA-Z0-9_:-]+$"
CURLY_SINGLE_QUOTES = "‘’‚‛"
CURLY_DOUBLE_QUOTES = "“”„‟"
