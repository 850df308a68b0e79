from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_extension(path: Column | str) -> Column:
    """Text from the last '.' of the last path element ('' if none): ``a.zip/b`` -> ''."""
    return F.regexp_extract(_c(path), r"([.][^./]*)$", 1)


def base_name(path: Column | str) -> Column:
    """Last path element."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def age_days(mtime: Column | str, now: Column) -> Column:
    """Whole days between mtime and now, truncated toward zero."""
    micros = F.timestamp_diff("MICROSECOND", _c(mtime), now)
    day = F.lit(86_400_000_000)
    return F.when(micros >= 0, F.floor(micros / day)).otherwise(-F.floor(-micros / day)).cast("long")


def archive_index(name: Column | str) -> Column:
    """Index of an ``emails_<int>.zip`` name; NULL when the name does not match.

    A prefix match: text after ``.zip`` is tolerated (``emails_0007.zip.tmp``
    counts), the match is case-sensitive (``.ZIP`` does not), blanks before the
    number and a sign are accepted, and values outside int32 are rejected.
    """
    digits = F.regexp_extract(_c(name), r"^emails_[ \t]*([+-]?[0-9]+)[.]zip", 1)
    # try_cast keeps int32 overflow as NULL instead of an error under ANSI mode.
    return F.nullif(digits, F.lit("")).try_cast("int")
