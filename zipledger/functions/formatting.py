from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def archive_name(index: Column | str) -> Column:
    """``emails_%04d.zip``: zero-padded to four digits, wider numbers are kept whole."""
    return F.format_string(C.ARCHIVE_NAME_FORMAT, _c(index))


def _two_decimals(x: Column) -> Column:
    # The original formats the exact binary value; that rounds half-to-even on
    # true ties (1.125 -> 1.12), so round with bround before printing.
    return F.format_string("%.2f", F.bround(x, 2))


def format_size(nbytes: Column | str) -> Column:
    """``N B`` below 1 KiB, else two decimals and K/M/G/T/P/E in steps of 1024.

    The unit is the largest power of 1024 that keeps the integer quotient below
    1024 (so 1048575 bytes is ``1024.00 KB``).
    """
    b = _c(nbytes).cast("long")
    out = F.when(b < C.SIZE_UNIT, F.concat(b.cast("string"), F.lit(" B")))
    for exp, prefix in enumerate(C.SIZE_PREFIXES):
        div = C.SIZE_UNIT ** (exp + 1)
        upper = C.SIZE_UNIT ** (exp + 2)
        text = F.concat(_two_decimals(b.cast("double") / F.lit(float(div))), F.lit(f" {prefix}B"))
        if exp == len(C.SIZE_PREFIXES) - 1:
            out = out.otherwise(text)
        else:
            out = out.when(b < F.lit(upper), text)
    return out


def gb_text(nbytes: Column | str) -> Column:
    """Bytes as GiB with two decimals (retention summary)."""
    return _two_decimals(_c(nbytes).cast("double") / F.lit(float(1024 ** 3)))


def portal_link(base: Column | str, job: Column | str) -> Column:
    """Strip every trailing '/' from the base URL and append ``/{job}``."""
    return F.concat(F.rtrim(_c(base), F.lit("/")), F.lit("/"), _c(job))


def progress_text(current: Column | str, total: Column | str) -> Column:
    return F.concat(_c(current).cast("string"), F.lit("/"), _c(total).cast("string"))


def failure_reason(kind: Column | str, http_status: Column | str = None, detail: Column | str = None,
                   max_attempts: int = C.MAX_ATTEMPTS) -> Column:
    """Reason text by failure kind: ``parse``, ``api``, ``network``, ``request`` or ``zip``."""
    k = _c(kind)
    s = _c(http_status) if http_status is not None else F.lit(None).cast("int")
    d = _c(detail) if detail is not None else F.lit(None).cast("string")
    return (
        F.when(k == "parse", F.lit(C.REASON_PARSE))
        .when(k == "api", F.format_string(C.REASON_API, s, F.lit(max_attempts)))
        .when(k == "network", F.format_string(C.REASON_NETWORK, F.lit(max_attempts), d))
        .when(k == "request", F.format_string(C.REASON_REQUEST, d))
        .when(k == "zip", F.format_string(C.REASON_ZIP, d))
    )


def backoff_seconds(attempts_used: Column | str) -> Column:
    """Total sleep before the deciding attempt: attempt**2 seconds after each earlier attempt.

    Closed form of sum_{a=1}^{n-1} a^2 = (n-1) n (2n-1) / 6, so 1 -> 0, 2 -> 1, 3 -> 5.
    """
    n = _c(attempts_used).cast("long")
    return F.when(n <= 1, F.lit(0).cast("long")).otherwise((n - 1) * n * (2 * n - 1) / 6).cast("long")
