"""Fixed parameters of the registered queries (shared by the Spark side and the SQL oracle)."""

NOW = "2026-01-01 00:00:00"
BATCH_SIZE = 500
WORKERS = 50
SLOTS = 10            # max(5, 50 div 5)
PACK_CAP_MB = 4       # small enough that every slot rotates many times at sf0.01
SINK_CAP_BYTES = 256 * 1024  # declared sizes reach ~500 KB: some rows rotate, others fit
RESUME_START = 9990   # numbering resumes here, so names grow past four digits
JOB_ID = "job-0001"
BASE_URL = "https://portal.example///"
RETENTION_NOW = "2024-01-31 00:00:00"
MAX_AGE_DAYS = 7      # cutoff 2024-01-24 00:00:00
FLUSH_BATCH = 200
FLUSH_INTERVAL_SECONDS = 86400  # events are sparse (days apart), so tick daily
FLUSH_START = "2024-01-01 00:00:00"
REPORT_JOB = "job7"
LEDGER_BUCKETS = 16
CLAIM_ROWS = 3000
CHUNK_BYTES = 1024    # most bodies take several chunks
LOST, COPIED, SET_BACK = 3, 5, 7  # archives of the reconciliation query
BLOCK_ROWS = 500      # several blocks and rounds of the one-slot packer at sf0.01
FAN_IN = 4
LANES = 16            # of the timed commits and the status counts
COMMIT_SECONDS = 3
