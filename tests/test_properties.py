"""Property checks of the column functions against exact Python models."""

import re
from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from zipledger.functions import archive_index, format_size, parse_location


def model_size(b: int) -> str:
    """Two decimals of the value over the largest power of 1024 not above it, half to even on the float's exact value."""
    power = max(0, b.bit_length() - 1) // 10
    if power == 0:
        return f"{b} B"
    scaled = Decimal(float(b)) / (1 << 10 * power)
    return f"{scaled.quantize(Decimal('0.01'), rounding=ROUND_HALF_EVEN)} {' KMGTPE'[power]}B"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1 << 20), st.integers(0, (1 << 63) - 1),
                          st.integers(0, 1 << 40).map(lambda x: x * 1024 + 512)), min_size=400, max_size=400))
def test_format_size_matches_exact_model(spark, values):
    ties = [v * 1024 + 5 * 1024 // 1000 for v in range(1, 50)] + [1152, 1153, 2560, 10 * 1024 + 5]
    vals = values + ties
    df = spark.createDataFrame([(v,) for v in vals], "b long")
    got = [r[0] for r in df.select(format_size("b")).collect()]
    assert got == [model_size(v) for v in vals]


def model_parse(loc):
    if loc is None:
        return (False, None, None, None, None, None)
    parts = loc.split(":")
    if len(parts) != 5:
        return (False, None, None, None, None, None)
    return (True, *parts)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=":ab.1 ", max_size=12)), min_size=300, max_size=300))
def test_parse_location_matches_split(spark, locs):
    df = spark.createDataFrame([(v,) for v in locs], "loc string")
    got = [tuple(r) for r in df.select(parse_location("loc").alias("p")).select("p.*").collect()]
    assert got == [model_parse(v) for v in locs]


def model_index(name: str):
    """A model of scanning 'emails_%d.zip' as a prefix: blanks, sign, digits, literal '.zip'."""
    m = re.match(r"emails_[ \t]*([+-]?[0-9]+)\.zip", name)
    if not m:
        return None
    v = int(m.group(1))
    return v if -(1 << 31) <= v < (1 << 31) else None


@settings(max_examples=1, deadline=None)
@given(st.lists(st.builds(lambda pre, num, suf: pre + num + suf,
                          st.sampled_from(["emails_", "emails_ ", "email_", "Emails_", "emails_+", "emails_-", ""]),
                          st.sampled_from(["0", "0007", "2147483647", "2147483648", "99999999999", "x", ""]),
                          st.sampled_from([".zip", ".zip.tmp", ".ZIP", ".tar", "zip", ""])),
                min_size=200, max_size=200))
def test_archive_index_matches_model(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(archive_index("n")).collect()]
    assert got == [model_index(n) for n in names]
