"""Column expressions. Everything here builds Catalyst expressions, no Python UDFs."""

from .formatting import (archive_name, backoff_seconds, failure_reason, format_size, gb_text,
                         portal_link, progress_text)
from .location import build_url, entry_name, parse_location
from .paths import age_days, archive_index, base_name, file_extension
from .sizing import cap_bytes, slot_count
from .status import is_eligible
from .time import as_timestamp

__all__ = [
    "archive_name", "backoff_seconds", "failure_reason", "format_size", "gb_text", "portal_link",
    "progress_text", "build_url", "entry_name", "parse_location", "age_days", "archive_index",
    "base_name", "file_extension", "cap_bytes", "slot_count", "is_eligible", "as_timestamp",
]
