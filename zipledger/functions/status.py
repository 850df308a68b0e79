from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def is_eligible(status: Column | str = "export_status") -> Column:
    """Rows still to be exported: NULL, empty or spaces only, the literal "" or exactly PENDING.

    Only U+0020 counts as a space (a tab is not eligible), and the match is
    case-sensitive (``pending`` is not eligible).

    The second conjunct is implied by the first and exists for the Parquet
    reader: ``IsNull OR In OR LessThan`` is pushed to the scan, so row groups
    whose statuses are all e.g. COMPLETED/FAILED are skipped without decoding.
    All-space strings sort below "!" (0x21), so the superset is exact-safe.
    """
    s = F.col(status) if isinstance(status, str) else status
    # NULL is handled by coalesce (not IS NULL) so the optimizer cannot factor a
    # shared term out of both conjuncts, which would stop the pushdown.
    exact = F.coalesce((F.trim(s) == "") | (s == C.QUOTED_EMPTY) | (s == C.PENDING), F.lit(True))
    pushable = s.isNull() | s.isin(C.QUOTED_EMPTY, C.PENDING) | (s < "!")
    return exact & pushable
