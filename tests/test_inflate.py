from __future__ import annotations

import pytest
from conftest import rows

from huntspark.operators import inflate as op


def test_raw_events(spark):
    df = spark.sql(
        """select 'a' as id, array(named_struct('resource_id', 'r1', 'n', 1), named_struct('resource_id', 'r2', 'n', 2)) as event_ids
        union all select 'b', array() union all select 'c', null"""
    )
    out = op.inflate_raw_events(df)
    got = rows(out, "id", "event_data.resource_id", "event_data.n")
    assert got == sorted([("a", "r1", 1), ("a", "r2", 2), ("b", None, None), ("c", None, None)], key=repr)
    assert op.inflate_raw_events(out).columns == out.columns
    with pytest.raises(ValueError):
        op.inflate_raw_events(df.drop("event_ids"))


def test_filters_and_prompts(spark):
    df = spark.sql("select 1 as r, array(named_struct('id', 'f', 'deep', named_struct('x', 2))) as filters union all select 2, null")
    out = op.inflate_filters(df)
    assert rows(out, "r", "filters.id", "filters.deep.x") == [(1, "f", 2), (2, None, None)]
    assert op.inflate_filters(out) is out
    prompts = spark.sql("select 1 as r, array(named_struct('q', 'x'), named_struct('q', 'y')) as prompts")
    assert rows(op.inflate_prompt_examples(prompts), "example.q") == [("x",), ("y",)]


def test_third_party_details_last_duplicate_wins(spark):
    record = "named_struct('generic', named_struct('generic', named_struct('record', array({}))))".format
    pair = "named_struct('key', '{}', 'value', '{}')".format
    df = spark.sql(
        f"""select 1 as id, array({record(pair('a', '1') + ',' + pair('b', '2'))}, {record(pair('a', '3'))}) as third_party_details
        union all select 2, array({record(pair('c', '4'))}) union all select 3, null"""
    )
    out = op.inflate_third_party_details(df, ["a", "b", "c"])
    assert rows(out, "id", *[f"third_party_details.{k}" for k in "abc"]) == sorted(
        [(1, "3", "2", None), (2, None, None, "4"), (3, None, None, None)], key=repr
    )
    assert op.inflate_third_party_details(df, ["b"]).columns[-1] == "third_party_details.b"
    mapped = {r.id: r["third_party_details.map"] for r in op.inflate_third_party_details(df).collect()}
    assert mapped == {1: {"a": "3", "b": "2"}, 2: {"c": "4"}, 3: {}}
    assert rows(op.third_party_keys(df)) == [("a", 1), ("b", 1), ("c", 1)]


def test_third_party_details_of_any_number_of_keys(spark):
    df = spark.sql(
        """select array(named_struct('generic', named_struct('generic', named_struct('record',
          transform(sequence(1, 12000), k -> named_struct('key', 'k'||(k % 6000), 'value', k||'')))))) as third_party_details"""
    )
    found = op.inflate_third_party_details(df).first()["third_party_details.map"]
    assert len(found) == 6000 and found["k7"] == "6007" and found["k0"] == "12000"


def test_third_party_missing(spark):
    df = spark.range(1)
    assert op.inflate_third_party_details(df.select("id")).columns == ["id"]


def test_original_data(spark):
    df = spark.createDataFrame(
        [(1, '{"a": {"b": 1}, "c": "x"}', None), (2, "{bad", None), (3, None, '{"c": "y"}')],
        "id int, original_data string, `event_data.original_data` string",
    )
    out = op.inflate_original_data(df)
    assert rows(out, "id", "original_data.a.b", "original_data.c") == [(1, 1, "x"), (2, None, None), (3, None, "y")]
    assert op.inflate_original_data(out).columns == out.columns
    given = op.inflate_original_data(df, "c string")
    assert rows(given, "id", "original_data.c") == [(1, "x"), (2, None), (3, "y")]
    named = op.inflate_original_data(df, paths={"a.b": "bigint", "c": "string", "no.such": "int"})
    assert rows(named, "id", "original_data.a.b", "original_data.no.such") == [(1, 1, None), (2, None, None), (3, None, None)]
    assert named._jdf.queryExecution().optimizedPlan().toString().count("AS __json#") == 1  # texts are parsed once
    assert rows(op.json_inventory(df)) == [("a.b", "BIGINT", 1), ("c", "STRING", 2)]
    mixed = spark.createDataFrame([('{"k": 1, "it\'s": [1, 2], "e": {}}',), ('{"k": "x", "n": null}',), ("[1]",), ("7",), (None,)], "original_data string")
    assert rows(op.json_inventory(mixed)) == [("it's", "ARRAY<BIGINT>", 1), ("k", "BIGINT", 1), ("k", "STRING", 1)]
    out = op.inflate_original_data(mixed)
    assert rows(out, "original_data.it's", "original_data.k") == sorted([([1, 2], "1"), (None, "x")] + 3 * [(None, None)], key=repr)
    assert op.inflate_original_data(mixed.where("false")).columns == mixed.columns
    quotes = spark.createDataFrame([('{"a\'\\"b": {"c": 5}}',)], "original_data string")
    assert op.inflate_original_data(quotes).first()[1] == 5
    with pytest.raises(ValueError):
        op.inflate_original_data(df.select("id"))


def test_schema_keys(spark):
    df = spark.createDataFrame([("x.auth.field.sub",), ("x.auth",), ("short",), (None,)], "key string")
    got = rows(op.inflate_schema_keys(df), "key", "x_schema", "x_key")
    assert got == sorted(
        [("x.auth.field.sub", "auth", "field.sub"), ("x.auth", "auth", "Error"), ("short", "Error", "Error"), (None, "Error", "Error")],
        key=repr,
    )


def test_evidence(spark):
    df = spark.sql(
        """select array(named_struct('alert_id', 'a1')) as alerts_evidence, array(named_struct('event_id', 'e1'), null) as events_evidence,
        cast(null as array<struct<search_query: string>>) as search_queries_evidence"""
    )
    assert rows(op.inflate_evidence(df), "x_evidence_type", "x_evidence_id") == [("alerts", "a1"), ("events", "e1")]
    with pytest.raises(ValueError):
        op.inflate_evidence(df.drop("events_evidence"))


def test_environments(spark):
    entry = "named_struct('name', '{}', 'enabled', {}, 'created_at', '{}', 'updated_at', 'u')".format
    df = spark.sql(
        f"""select 1 as id, array({entry('x', 'false', 'c0')}, {entry('y', 'true', 'c1')}, {entry('x', 'true', 'c2')}) as environments
        union all select 2, array() union all select 3, null"""
    )
    out = op.inflate_environments(df, ["x", "y", "z"])
    got = rows(out, "id", "environments.x", "environments.x.created_at", "environments.y", "environments.z")
    assert got == [(1, True, "c2", True, False), (2, False, None, False, False), (3, False, None, False, False)]
    assert rows(df.select("id", op.lookup_first_environment(df).alias("e"))) == [(1, "y"), (2, None), (3, None)]
    with pytest.raises(ValueError):
        op.inflate_environments(df.select("id"), ["x"])


def test_publication_reference_is_percent_encoded(spark):
    from urllib.parse import quote

    ids = ["a b", "x/y~z", "p*q+r", "ü&%", ""]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id string")
    got = {r.id: r.x_reference for r in op.publication_reference(df, "base?").collect()}
    assert got == {**{i: "base?" + quote(i) for i in ids}, None: "base?"}
