"""Configuration values of the ingestion system.

Everything under "FIXED VALUES" must keep these exact values for results to match the
system this package re-implements; everything else is ours.
"""

from __future__ import annotations

# ----------------------------------------------------------------------------------------
# FIXED VALUES (must equal the re-implemented system's configuration)
# ----------------------------------------------------------------------------------------

# Landing layout: <root>/source=mongo/year=YYYY/month=MM/day=DD/database=<db>/collection=<c>/
LANDING_SOURCE_SEGMENT = "source=mongo"

# Tier -> (files per micro-batch, micro-batch interval in seconds)
TIER_PARAMS = {
    "high": (3000, 90),
    "medium": (500, 90),
    "low": (100, 90),
}
TIER_ORDER = ("high", "medium", "low")

# Concurrent streams: default and hard cap.
DEFAULT_MAX_CONCURRENT = 8
MAX_CONCURRENT_CAP = 32

# Restart budget of one stream.
RESTART_BACKOFF_SECONDS = 10
MAX_RESTARTS = 5
MAX_SCHEMA_RESTARTS = 50
HEALTHY_RESET_SECONDS = 300

# Worker counts of the drain projection.
PROJECTED_WORKERS = (4, 6, 8, 12, 16)

# Failure text identifiers that mark an expected schema-evolution restart.
SCHEMA_EVOLUTION_TYPES = ("UnknownFieldException",)          # matched case-sensitively
SCHEMA_EVOLUTION_ERROR_CLASSES = ("NEW_FIELDS_IN_RECORD_WITH_FILE_PATH",)  # on upper-cased text

# Message truncation lengths.
OUTCOME_MESSAGE_CHARS = 160
LISTING_ERROR_PART_CHARS = 300
LISTING_ERROR_CHARS = 2000
STOP_ERROR_CHARS = 500
DRAIN_ERROR_CHARS = 1000

# Default parent collections per tier (bare collection names, in declared order).
DEFAULT_PARENTS = {
    "high": [
        "userwithdrawalaccessibilities", "transactions", "adminreviews",
        "foreclosurerequests", "contractors", "preapprovals", "videokyccallrequests",
        "disbursementpermissiondenieds", "experimentscreens", "users", "leads",
        "attendances", "underwritingauditlogs", "salarytopups",
    ],
    "medium": [
        "videokycs", "videokycpreprocessings", "userpaymentlinks", "paymentlinks",
        "autokycs", "videokycv2", "videokycadmins", "userlocations", "departments",
    ],
    "low": [
        "otps", "refundv2", "batchjobs", "principalemployers", "userauthproviders",
        "digigoldaccounts", "digigoldtransactions", "surveyresponseactions", "surveys",
        "lenderloanentityreferences", "deductions", "collectionwebhooks",
        "leadworkermatchattempts", "statements", "debitnotes", "employers",
        "insurancepolicies", "billingcycles", "salarytopupconfigs", "upiaccounts",
        "lenderretailodloanapplications", "upitransactions",
        "bankstatementanalyserrequests", "accountaggregatorrequests",
        "bankchangerequests", "admintransactions", "ui-elements", "subscriptions",
    ],
}

# Synthetic landing data: anchor day, defaults, and the collection catalogue
# (collection, tier, format, parent).
SYNTH_ANCHOR_DATE = "2025-01-01"
SYNTH_DEFAULTS = {"num_days": 3, "files_per_day": 5, "rows_per_file": 200, "seed": 42}
SYNTH_COLLECTIONS = [
    ("transactions", "high", "parquet", None),
    ("transactions_statuslogs", "high", "parquet", "transactions"),
    ("users", "high", "parquet", None),
    ("videokycs", "medium", "csv", None),
    ("departments", "medium", "parquet", None),
    ("otps", "low", "parquet", None),
]

# Synthetic value domains per collection.
SYNTH_TRANSACTION_STATUSES = ["PENDING", "COMPLETED", "FAILED", "REVERSED"]
SYNTH_STATUSLOG_STATUSES = ["PENDING", "COMPLETED", "FAILED"]
SYNTH_KYC_STATES = ["PENDING", "APPROVED", "REJECTED"]
SYNTH_CALL_STATES = ["SCHEDULED", "COMPLETED", "MISSED", "CANCELLED"]
SYNTH_DEPARTMENT_NAMES = ["Engineering", "HR", "Finance", "Operations", "Sales", "Legal"]
SYNTH_OTP_PURPOSES = ["LOGIN", "WITHDRAWAL", "KYC", "BANK_CHANGE", "DISBURSEMENT"]
SYNTH_ROW_JITTER_MS = 3_600_000        # row timestamps: day midnight + 0..3,600,000 ms
SYNTH_FILE_JITTER_MS = 86_399_999      # file name epoch: day midnight + 0..86,399,999 ms

# ----------------------------------------------------------------------------------------
# Our own settings
# ----------------------------------------------------------------------------------------

# Spark's file source skips files older than the newest seen one by more than its maximum age
# (seven days unless set). This is longer than any two file times can lie apart.
MAX_FILE_AGE = "36500000d"

# Raw batches smaller than this are put together by a compaction.
COMPACT_BYTES = 128 << 20

RESCUED_COLUMN = "_rescued_data"
LINEAGE_COLUMNS = ("_ingested_at", "_source_file", "_file_epoch_ms")
# Names of our own that no source column may take; a source column so named is rescued.
BATCH_COLUMN = "__loamflow_batch"
FILE_COLUMN = "__loamflow_file"


def tier_rows():
    """Tier table rows: (tier, max_files, interval_seconds)."""
    return [(t, TIER_PARAMS[t][0], TIER_PARAMS[t][1]) for t in TIER_ORDER]


def default_topic_rows():
    """Topic table rows (topic, tier, position) in declared order."""
    rows, pos = [], 0
    for tier in TIER_ORDER:
        for name in DEFAULT_PARENTS[tier]:
            rows.append((name, tier, pos))
            pos += 1
    return rows
