from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slot_count(workers: Column | str, zip_slots: Column | str) -> Column:
    """Configured slots if positive, else max(5, workers div 5); never below one."""
    w = _c(workers).cast("long")
    z = _c(zip_slots).cast("long")
    auto = F.greatest(_div(w, C.WORKERS_PER_SLOT), F.lit(C.MIN_AUTO_SLOTS).cast("long"))
    return F.greatest(F.when(z <= 0, auto).otherwise(z), F.lit(1).cast("long"))


def _div(x: Column, d: int) -> Column:
    # integer division truncating toward zero
    return F.when(x >= 0, F.floor(x / d)).otherwise(-F.floor(-x / d)).cast("long")


def cap_bytes(max_zip_mb: Column | str) -> Column:
    """Archive cap in bytes; zero or negative means unlimited (2**63 - 1)."""
    m = _c(max_zip_mb).cast("long")
    return F.when(m > 0, m * F.lit(C.MB).cast("long")).otherwise(F.lit(C.UNLIMITED_BYTES).cast("long"))
