"""Column functions: plain cases and edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from zipledger.functions import (age_days, archive_index, archive_name, backoff_seconds, build_url,
                                 cap_bytes, failure_reason, file_extension, format_size, is_eligible,
                                 parse_location, portal_link, slot_count)


def _one_col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_location_names_its_parts(spark):
    df = spark.createDataFrame([("172.16.4.9:acme:post.test:1999-12-31:m-7",), ("172.16.4.9",), (":",)], "loc string")
    out = df.select(parse_location("loc").alias("p")).select("p.*").collect()
    assert tuple(out[0]) == (True, "172.16.4.9", "acme", "post.test", "1999-12-31", "m-7")
    assert [r["valid"] for r in out] == [True, False, False]
    assert out[1]["server_ip"] is None


def test_parse_location_edges(spark):
    vals = ["a:b:c:d", "a:b:c:d:e", "a:b:c:d:e:f", "::::", "a:b:c:d:", "::1:org:d:2026-01-01:x", None]
    df = spark.createDataFrame([(v,) for v in vals], "loc string")
    out = df.select(parse_location("loc").alias("p")).select("p.*").collect()
    assert [r["valid"] for r in out] == [False, True, False, True, True, False, False]
    assert tuple(out[3])[1:] == ("", "", "", "", "")
    assert out[4]["id"] == ""


def test_build_url_keeps_the_order_of_parts(spark):
    df = spark.createDataFrame([("host:o:d:t:i",)], "loc string")
    url = df.select(build_url(parse_location("loc")).alias("u")).first()["u"]
    assert url == "http://host:8686/archive/read/o/d/t/i"


def test_eligibility(spark):
    vals = [None, "", "  ", "\t", '""', "PENDING", "pending", "PROCESSING", "COMPLETED", "FAILED", " PENDING"]
    got = _one_col(spark, vals, "string", is_eligible)
    assert got == [True, True, True, False, True, True, False, False, False, False, False]


def test_format_size(spark):
    vals = [0, 1023, 1024, 1152, 232064, 1048575, 1179648, 1073741824, 1 << 60, 1152921504606846976 + (1 << 59)]
    got = _one_col(spark, vals, "long", format_size)
    assert got == ["0 B", "1023 B", "1.00 KB", "1.12 KB", "226.62 KB", "1024.00 KB", "1.12 MB",
                   "1.00 GB", "1.00 EB", "1.50 EB"]


def test_archive_name_width(spark):
    got = _one_col(spark, [1, 5, 9999, 10000, 12345], "long", archive_name)
    assert got == ["emails_0001.zip", "emails_0005.zip", "emails_9999.zip", "emails_10000.zip", "emails_12345.zip"]


def test_archive_index(spark):
    vals = ["emails_0005.zip", "emails_0007.zip.tmp", "emails_0009.tar", "emails_0008.ZIP", "emails_10000.zip",
            "emails_99999999999.zip", "emails_x.zip", "emails_+12.zip", "emails_-3.zip", "xemails_1.zip"]
    got = _one_col(spark, vals, "string", archive_index)
    assert got == [5, 7, None, None, 10000, None, None, 12, -3, None]


def test_file_extension(spark):
    vals = ["/a/b.zip", "/a/b.tar.zip", "a.zip/b", "/a/.zip", "/a/b.", "/a/b", "/a/b.ZIP"]
    got = _one_col(spark, vals, "string", file_extension)
    assert got == [".zip", ".zip", "", ".zip", ".", "", ".ZIP"]


def test_age_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 24),), (dt.datetime(2024, 1, 23, 23, 59, 59),),
                                (dt.datetime(2024, 1, 31),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(age_days("t", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))).collect()]
    assert got == [7, 7, 0]


def test_backoff_and_reasons(spark):
    assert _one_col(spark, [1, 2, 3], "int", backoff_seconds) == [0, 1, 5]
    df = spark.createDataFrame([("api", 503, None), ("network", None, "timeout"), ("parse", None, None),
                                ("zip", None, "disk full"), ("request", None, "bad url")],
                               "k string, s int, d string")
    got = [r[0] for r in df.select(failure_reason("k", "s", "d")).collect()]
    assert got == ["API returned status 503 after 3 attempts", "Network error after 3 attempts: timeout",
                   "Parse error: invalid archive location format", "ZIP error: disk full",
                   "Request build error: bad url"]


def test_portal_link_and_sizing(spark):
    df = spark.createDataFrame([("https://x.example///", "j1"), ("https://x.example", "j2")], "b string, j string")
    assert [r[0] for r in df.select(portal_link("b", "j")).collect()] == ["https://x.example/j1", "https://x.example/j2"]
    cfg = spark.createDataFrame([(50, 0, 1024), (100, 0, 0), (10, 3, -1), (0, -1, 2)], "w int, z int, m int")
    out = cfg.select(slot_count("w", "z").alias("s"), cap_bytes("m").alias("c")).collect()
    assert [r["s"] for r in out] == [10, 20, 3, 5]
    assert [r["c"] for r in out] == [1024 << 20, (1 << 63) - 1, (1 << 63) - 1, 2 << 20]
