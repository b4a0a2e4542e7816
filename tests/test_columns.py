from __future__ import annotations

import ipaddress
import re
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from huntspark.functions import indicators as ind
from huntspark.functions import names
from huntspark.functions.severity import investigation_priority, rule_severity, severity_rounded_and_category
from huntspark.functions.times import (
    convert_alert_timestamps,
    convert_event_timestamps,
    day_bounds,
    java_pattern,
    parse_bound,
    time_range,
)


def test_dotted_names_and_flatten(spark):
    df = spark.sql("select named_struct('b', named_struct('c', named_struct('d', named_struct('e', 1)))) as a, array(1) as l")
    assert names.flatten_struct(df, 3).columns == ["a.b.c.d", "l"]
    assert names.flatten_struct(df, None).columns == ["a.b.c.d.e", "l"]
    assert names.flatten_struct(names.flatten_struct(df, 3), None).columns == ["a.b.c.d.e", "l"]
    assert rows(names.flatten_struct(df, None), "a.b.c.d.e") == [(1,)]


def test_drop_all_null(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, `b.c` string, d string")
    assert names.drop_all_null(df).columns == ["a", "d"]


def test_coalesce_and_valid_column(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "c")], "x string, `y.z` string")
    assert rows(df.select(names.coalesce_columns(df, ["no", "x", "y.z"]).alias("v"))) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        names.return_valid_column(df, [])
    with pytest.raises(ValueError):
        names.return_valid_column(df, "x")
    with pytest.raises(ValueError):
        names.return_valid_column(df, ["no"])


def test_tenant_id_forms(spark):
    df = spark.createDataFrame([(7, "['8']", ["9", "1"], 1.5)], "n int, s string, l array<string>, d double")
    got = df.select(*[names.get_tenant_id(df, c).alias(c) for c in "nsl"])
    assert rows(got) == [("7", "8", "9")]
    with pytest.raises(ValueError):
        names.get_tenant_id(df, "d")


def test_pickers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`event_data.tenant_id` int, id int, `asset_info.host_id` int")
    assert names.tenant_id_column(df) == "event_data.tenant_id"
    assert names.evidence_id_column(df) == "id"
    with pytest.raises(ValueError):
        names.host_id_column(df)
    assert names.host_id_column(df.withColumn("event_data.host_id", F.lit(1))) == "event_data.host_id"


def test_default_columns():
    assert names.default_schema_columns("AUTH")[:2] == ["source_address", "target_user_name"]
    assert names.default_schema_columns("nope") == []
    assert len(names.DEFAULT_COLUMNS) == 23


def test_prefix_suffix_dedup_json_catalogue(spark):
    df = spark.sql("select 1 as id, array(1,2) as l, named_struct('x', 2) as s union all select 1, array(3), named_struct('x', 2)")
    assert names.prefix_columns(df, "p.").columns == ["p.id", "p.l", "p.s"]
    assert names.suffix_clashes(df, df.select("id"), ".r").columns == ["id.r", "l", "s"]
    assert names.drop_duplicates_by_hashables(df).count() == 1
    assert rows(names.json_columns(df), "l", "s") == [("[1,2]", '{"x":2}'), ("[3]", '{"x":2}')]
    assert rows(names.schema_catalogue(df)) == [("id",), ("l",), ("s.x",)]


def test_alert_timestamps(spark):
    df = spark.createDataFrame([(1736968618, None)], "`metadata.created_at.seconds` long, `metadata.ended_at.seconds` long")
    out = convert_alert_timestamps(df)
    assert rows(out, "x_metadata_created_at_seconds", "x_metadata_ended_at_seconds") == [("2025-01-15T19:16:58Z", "N/A")]
    assert convert_alert_timestamps(out).columns == out.columns
    assert rows(convert_alert_timestamps(df, "%d/%m/%Y"), "x_metadata_created_at_seconds") == [("15/01/2025",)]


def test_event_timestamps(spark):
    df = spark.createDataFrame([(1736968618000000, 1736968682000000)], "event_time_usec long, file_mod_time_us long")
    out = convert_event_timestamps(df)
    assert rows(out, "x_event_time_usec", "x_file_mod_time_us") == [("2025-01-15T19:16:58Z", "2025-01-15T19:18:02Z")]
    assert convert_event_timestamps(out).columns == out.columns


def test_formats_and_bounds():
    assert java_pattern("%Y-%m-%dT%H:%M:%SZ") == "yyyy-MM-dd'T'HH:mm:ss'Z'"
    with pytest.raises(ValueError):
        java_pattern("%j")
    now = datetime(2024, 1, 10, tzinfo=timezone.utc)
    assert parse_bound("-7d", now) == datetime(2024, 1, 3, tzinfo=timezone.utc) == parse_bound("7d", now)
    assert parse_bound("'2024-01-01T00:00:00Z'") == datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_time_range_types(spark):
    df = spark.sql(
        """select timestamp_ntz'2024-01-02 00:00:00' as n, timestamp'2024-01-02 00:00:00' as t,
        1704153600L as `a.seconds`, 1704153600000000L as event_time_usec"""
    )
    for column in df.columns:
        assert time_range(df, column, "2024-01-02T00:00:00Z", "2024-01-02T00:00:00Z").count() == 1
        assert time_range(df, column, "2024-01-02T00:00:01Z").count() == 0
        assert time_range(df, column, latest="2024-01-01T23:59:59Z").count() == 0


def test_day_bounds(spark):
    first, last = day_bounds(F.lit("20240229"))
    got = spark.range(1).select(first.cast("string").alias("a"), last.cast("string").alias("b"))
    assert rows(got) == [("2024-02-29 00:00:00", "2024-02-29 23:59:59")]


def test_severity(spark):
    data = [(0.795, None), (None, 0.575), (None, None), (0.2, 0.9), (0.194, 0.0), (0.6, None)]
    df = spark.createDataFrame(data, "`metadata.severity` double, severity double")
    got = rows(severity_rounded_and_category(df), "x_severity", "x_severity_category")
    assert sorted(got, key=repr) == sorted(
        [(0.8, "Critical"), (0.57, "Medium"), (None, None), (0.2, "Low"), (0.19, "Informational"), (0.6, "High")], key=repr
    )
    with pytest.raises(Exception, match="severity is missing"):
        severity_rounded_and_category(df, strict=True).collect()
    with pytest.raises(ValueError):
        severity_rounded_and_category(df.select(F.lit(1).alias("x")))
    text = spark.createDataFrame([("0.85",), ("bad",)], "severity string")
    assert rows(severity_rounded_and_category(text), "x_severity_category") == [("Critical",), (None,)]


def test_enum_maps(spark):
    got = spark.range(1).select(rule_severity(F.lit("HIGH")), investigation_priority(F.lit("critical")), rule_severity(F.lit("?")))
    assert rows(got) == [(0.6, 4, None)]


ADDRESSES = [
    "1.2.3.4", "01.2.3.4", "256.1.1.1", "1.2.3", "1.2.3.4.5", "0.0.0.0", "::", "::1", "1::", "1:2:3:4:5:6:7:8",
    "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", "1:::2", "12345::", "g::1", "fe80::1%eth0",
    "fe80::1%", "fe80::1%a%b", "::ffff:1.2.3.4", "::ffff:1.2.3.400", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", ":1:2:3:4:5:6:7",
    "1:2:3:4:5:6:7:", "1.2.3.4::", "::1.2.3.4%x", "2001:db8::ff00:42:8329", "", "a.b.c.d", "12:30:45", "1:2:3:4::5:6:7:8",
]


def test_ip_addresses_agree_with_the_standard_library(spark):
    def valid(text):
        try:
            ipaddress.ip_address(text)
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(a,) for a in ADDRESSES], "v string")
    got = {r.v: r.ok for r in df.select("v", ind.is_ip_address(F.col("v")).alias("ok")).collect()}
    assert got == {a: valid(a) for a in ADDRESSES}


def test_domains_and_hashes(spark):
    pattern = r"^(?!-)[A-Za-z0-9-]{1,63}(?<!-)\.[A-Za-z]{2,}$"
    values = ["ab.com", "a.b.com", "-a.com", "a-.com", "a.c", "x" * 63 + ".org", "x" * 64 + ".org", "1.22", "a_b.com"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: r.ok for r in df.select("v", ind.is_domain(F.col("v")).alias("ok")).collect()}
    assert got == {v: re.match(pattern, v) is not None for v in values}
    assert df.where(ind.is_domain(F.col("v"), fqdn=True) & (F.col("v") == "a.b.com")).count() == 1
    sizes = {n: n in (32, 40, 64) for n in (31, 32, 33, 40, 64, 65)}
    df = spark.createDataFrame([(n, "aF0"[n % 3] * n) for n in sizes], "n int, v string")
    assert {r.n: r.ok for r in df.select("n", ind.is_hash(F.col("v")).alias("ok")).collect()} == sizes
    kinds = spark.createDataFrame([("a" * 32,), ("ab.com",), ("::1",), ("what",)], "v string")
    assert rows(kinds.select(ind.classify_indicator(F.col("v")))) == [("Error",), ("domain",), ("hash",), ("ip",)]


def test_extract_from_the_end_of_a_long_text(spark):
    text = "word " * 50_000 + "10.1.2.3 and mail5.example and " + "ab" * 20 + " 999.1.1.1"
    df = spark.createDataFrame([(text,)], "t string")
    found = df.select(*[ind.extract_indicators(F.col("t"), k).alias(k) for k in ind.KINDS]).first()
    assert found.ip == ["10.1.2.3"] and found.domain == ["mail5.example"] and found.hash == ["ab" * 20]


def test_extract_whole_words(spark):
    """Host names keep their labels, sentences end, addresses are found in both forms, parts of other words are not."""
    md5 = "d41d8cd98f00b204e9800998ecf8427e"
    text = (
        "See www.example.com at the end.The a.b.evil.com, http://mail.host.org:8080/x.y?z=1 or me@corp.example. Émile.com foo_bar.com -x.com y-.com a..b.com 1.2 v1.2.3 "
        f"10.0.0.1. 10.0.0.2:443 (10.0.0.3) 10.0.0.256 1.10.0.0.4 2001:db8::1 2001:db8::2: ::1. fe80:0:0:0:0:0:0:1 12:30:45 10:20 a::b::c 1:2:3:4:5:6:7:8:9 "
        f"md5:{md5} {md5}0 x{md5} {md5.upper()}, abc::def"
    )
    df = spark.createDataFrame([(text,), ("",), (None,), ("no such thing at all",)], "t string")
    found = df.select(*[ind.extract_indicators(F.col("t"), k).alias(k) for k in ind.KINDS]).collect()
    assert sorted(found[0].domain) == ["a.b.evil.com", "corp.example", "mail.host.org", "www.example.com", "x.com"]
    assert sorted(found[0].ip) == sorted(["10.0.0.1", "10.0.0.2", "10.0.0.3", "2001:db8::1", "2001:db8::2", "::1", "fe80:0:0:0:0:0:0:1", "abc::def"])
    assert found[0].hash == [md5, md5.upper()]
    for value in found[0].ip:
        ipaddress.ip_address(value)
    assert tuple(found[1]) == ([], [], []) == tuple(found[3]) and tuple(found[2]) == (None, None, None)


def test_list_predicates(spark):
    df = spark.createDataFrame([("secureXcom", 1), ("secure.com", 2), (None, 3)], "v string, n int")
    assert rows(df.where(ind.matches_regex(F.col("v"), ["secure.com", "a|b"])), "n") == [(2,)]
    assert rows(df.where(ind.not_matches_regex(F.col("v"), ["secure.com"])), "n") == [(1,)]
    assert rows(df.where(ind.any_compare(F.col("n"), [1, 3])), "n") == [(1,), (3,)]
    assert rows(df.where(ind.all_compare(F.col("n"), [1, 3], "!=")), "n") == [(2,)]
    assert rows(df.where(ind.any_compare(F.col("v"), ["Xco"], "CONTAINS")), "n") == [(1,)]
    assert rows(df.where(ind.none_of(F.col("n"), [1, 2])), "n") == [(3,)]


def test_logical_and_event_schema(spark):
    df = spark.createDataFrame([("event://priv:s.process:1", "1.1.1.1", "1.1.1.1", None)], "r string, a string, b string, c string")
    assert df.select(ind.logical(df, ["a", "b", "c", "no"])).first()[0] == ["1.1.1.1"]
    assert df.select(ind.logical(df, ["no"])).first()[0] == []
    assert df.select(ind.event_schema(F.col("r"))).first()[0] == "process"
    assert df.select(ind.event_schema(F.lit("odd"))).first()[0] is None


def test_times_are_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select 1704067200L as `a.seconds`, 1710055800123456L as t_time_usec, timestamp'2024-01-01 00:00:00+00:00' as ts")
        shown = convert_event_timestamps(convert_alert_timestamps(df))
        assert [shown.first()[c] for c in shown.columns if c.startswith("x_")] == ["2024-01-01T00:00:00Z", "2024-03-10T07:30:00Z"]
        assert time_range(df, "ts", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z").count() == 1
        start, end = day_bounds(F.lit("20240101"))
        assert df.select(start == F.col("ts"), end.cast("long")).first() == (True, 1704067200 + 86399)
        odd = spark.sql("select -1L as `a.seconds` union all select cast(null as bigint)")
        assert sorted(r[1] for r in convert_alert_timestamps(odd, "%d/%m/%Y %H%%").collect()) == ["31/12/1969 23%", "N/A"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
