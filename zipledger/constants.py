"""Fixed values that must equal the original tool's for identical results.

Everything here is a literal the export/retention behaviour depends on:
status names, the fetch URL layout, reason texts, archive names, units.
"""

# --- fixed values: ledger status names (case-sensitive) ---
PENDING = "PENDING"
PROCESSING = "PROCESSING"
COMPLETED = "COMPLETED"
FAILED = "FAILED"
# a status made of two double-quote characters also counts as "not exported yet"
QUOTED_EMPTY = '""'

# --- fixed values: archive location and fetch URL ---
LOCATION_SEPARATOR = ":"
LOCATION_PARTS = 5  # serverIP:orgID:domain:date:id
URL_PREFIX = "http://"
URL_PORT_AND_PATH = ":8686/archive/read/"
API_KEY_HEADER = "X-API-KEY"

# --- fixed values: fetch retry policy ---
MAX_ATTEMPTS = 3
FETCH_TIMEOUT_SECONDS = 30
HTTP_OK = 200

# --- fixed values: failure reason texts ---
REASON_PARSE = "Parse error: invalid archive location format"
REASON_API = "API returned status %d after %d attempts"
REASON_NETWORK = "Network error after %d attempts: %s"
REASON_REQUEST = "Request build error: %s"
REASON_ZIP = "ZIP error: %s"

# --- fixed values: archive files ---
ARCHIVE_NAME_FORMAT = "emails_%04d.zip"
ARCHIVE_NAME_PREFIX = "emails_"
ARCHIVE_NAME_SUFFIX = ".zip"
ENTRY_SUFFIX = ".eml"
LEDGER_COPY_NAME = "sql-lite.db"

# --- fixed values: sizing defaults ---
DEFAULT_WORKERS = 50
DEFAULT_MAX_ZIP_MB = 1024
DEFAULT_BATCH_SIZE = 500
DEFAULT_FLUSH_BATCH = 200
DEFAULT_FLUSH_INTERVAL_SECONDS = 10
MIN_AUTO_SLOTS = 5
WORKERS_PER_SLOT = 5
UNLIMITED_BYTES = 9223372036854775807  # 2**63 - 1
MB = 1024 * 1024

# --- fixed values: human-readable sizes ---
SIZE_UNIT = 1024
SIZE_PREFIXES = "KMGTPE"

# --- fixed values: retention ---
RETENTION_EXTENSIONS = (".zip", ".db")
DEFAULT_MAX_AGE_DAYS = 7

# --- fixed values: audit channels ---
CHANNEL_GENERAL = "general"
CHANNEL_PROCESS = "process"
CHANNEL_ERRORS = "errors"
