from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(value) -> Column:
    """A zone-less timestamp literal (TIMESTAMP_NTZ) from a str/datetime, or a Column as is.

    Convention: zone-less timestamps hold UTC wall-clock time. ``None`` means now.
    """
    if value is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")
