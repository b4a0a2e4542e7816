from __future__ import annotations

import itertools
import random
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from huntspark.operators import lineage, process


def test_correlate_netflow(spark):
    df = spark.createDataFrame([(1, "h:12:56"), (2, "1"), (3, "h:12:56"), (4, None)], "id int, process_correlation_id string")
    flows = spark.createDataFrame(
        [("h", "12:56", None, 7), ("h", "12", "56", 8), ("h", "12", "57", 9), ("g", "12", None, 10)],
        "host_id string, `processcorrelationid.pid` string, `processcorrelationid.timewindow` string, id int",
    )
    out = process.process_correlate_netflow(df, flows)
    assert rows(out, "id", "netflow.id") == sorted([(1, 7), (1, 8), (2, None), (3, 7), (3, 8), (4, None)], key=repr)
    timed = flows.withColumn("event_time_usec", F.when(F.col("id") == 7, 0).otherwise(1704153600000000))
    recent = process.process_correlate_netflow(df, timed, earliest="1d", now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert rows(recent, "id", "netflow.id") == sorted([(1, 8), (2, None), (3, 8), (4, None)], key=repr)
    assert process.process_correlate_netflow(out, flows) is out
    assert process.process_correlate_netflow(df.select("id"), flows).columns == ["id"]
    empty = process.process_correlate_netflow(df, flows.limit(0))
    assert "netflow.host_id" in empty.columns and empty.count() == 4


def test_split_correlation_id(spark):
    df = spark.createDataFrame([("h:1:2",), ("h:1",), (None,)], "c string")
    got = [r[0] and tuple(r[0]) for r in df.select(process.split_correlation_id(F.col("c"))).collect()]
    assert got == [("h", "1", "2"), None, None]


COLUMNS = ["host_id", "sensor_id", "sensor_tenant", "sensor_type", "tenant_id"]


def test_pivot_with_every_kind_of_null(spark):
    """All 31 combinations of present columns, against the plain definition."""
    rng = random.Random(5)
    events = [tuple(rng.choice("abc") if rng.random() < 0.9 else None for _ in COLUMNS) + (n,) for n in range(300)]
    events += events[:5]  # equal rows stay equal rows
    filters = [tuple(rng.choice("abc") if mask & (1 << i) else None for i in range(5)) for mask in range(32)]

    def matches(e):
        return any(any(f) and all(v is None or v == e[i] for i, v in enumerate(f)) for f in filters if f.count(None) < 3)

    few = [f for f in filters if f.count(None) < 3]
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    netflow = spark.createDataFrame(events, schema + ", n int")
    got = process.process_pivot_netflow(spark.createDataFrame(few + few + [(None,) * 5], schema), netflow)
    assert rows(got) == sorted((e for e in events if matches(e)), key=repr)
    everything = process.process_pivot_netflow(spark.createDataFrame(filters, schema), netflow)
    want = [e for e in events if any(any(f) and all(v is None or v == e[i] for i, v in enumerate(f)) for f in filters)]
    assert rows(everything) == sorted(want, key=repr)


def test_pivot_plan_has_no_nested_loop(spark):
    df = spark.createDataFrame([("a", None), (None, "t"), ("b", "t")], "host_id string, tenant_id string")
    plan = process.process_pivot_http(df, df.withColumn("x", F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.split("== Initial Plan ==")[-1].count("Join ") == 1  # the events, whatever kinds of null occur


def test_pivot_errors_and_map(spark):
    df = spark.createDataFrame([(None, "it's")], "host_id string, env string")
    events = spark.createDataFrame([("x", "it's"), ("y", "no")], "host_id string, region string")
    assert process.process_pivot_auth(df, events).collect() == []  # no row has a value: no event matches
    assert process.process_pivot_auth(df.limit(0), events).collect() == []
    with pytest.raises(ValueError):
        process.process_pivot_auth(df.select("env"), events)
    for bad in ({}, {"nope": "region"}):
        with pytest.raises(ValueError):
            process.process_pivot_auth(df, events, bad)
    assert rows(process.process_pivot_auth(df, events, {"env": "region"})) == [("x", "it's")]


SCHEMA = "host_id string, process_correlation_id string, parent_correlation_id string"


def chain_of(parents, host, key):
    out = []
    while (host, key) in parents:
        out.insert(0, key)
        key = parents[(host, key)]
    return out


@pytest.fixture(scope="module")
def forest():
    rng = random.Random(3)
    parents = {("h1", "c0"): "none"}
    for n in range(1, 40):  # a long chain
        parents[("h1", f"c{n}")] = f"c{n - 1}"
    for n in range(60):  # one parent with most children
        parents[("h2", f"s{n}")] = "root" if n else "gone"
    parents[("h2", "root")] = None
    for n in range(80):  # random trees, same names on another host
        parents[("h3", f"c{n}")] = f"c{rng.randrange(n)}" if n else "none"
    return parents


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_lineage_against_brute_force(spark, forest, hot_rows, monkeypatch):
    import huntspark.plans.joins as joins

    original = joins.split_hot_join

    def split(many, few, pairs, how="inner", at_most=None, **kw):
        return original(many, few, pairs, how, at_most, hot_rows=hot_rows, salts=4)

    monkeypatch.setattr(lineage, "split_hot_join", split)
    table = spark.createDataFrame([(h, k, p) for (h, k), p in forest.items()], SCHEMA)
    asked = [("h1", "c39"), ("h1", "c0"), ("h2", "s3"), ("h3", "c79"), ("h3", "c79"), ("h9", "c1"), (None, "c1"), ("h1", None)]
    df = spark.createDataFrame([(n, *a) for n, a in enumerate(asked)], "n int, host_id string, process_correlation_id string")
    want = []
    for n, (h, k) in enumerate(asked):
        chain = chain_of(forest, h, k)
        want += [(n, step, i) for i, step in enumerate(chain)] or [(n, None, None)]
    found = lineage.lookup_lineage(df, table)
    assert found.schema[lineage.LINEAGE].dataType.names == table.columns
    step = found["`" + lineage.LINEAGE + "`"][lineage.KEY].alias("step")
    assert rows(found.select("n", step, "`" + lineage.LINEAGE + ".index`")) == sorted(want, key=repr)


def test_lineage_of_one_record_of_a_process(spark):
    """A process that is listed with two resources and two parents: each resource has its own chain; without one the least parent counts."""
    table = spark.createDataFrame(
        [("h", "a", None, "r0", "init"), ("h", "b", "a", "r1", "sh"), ("h", "c", "b", "r2", "one"), ("h", "c", "a", "r3", "two"), ("h", "d", "c", "r4", "leaf"),
         ("g", "a", None, "r0", "other")],
        SCHEMA + ", resource_id string, image string",
    )
    asked = spark.createDataFrame([(0, "h", "c", "r2"), (1, "h", "c", "r3"), (2, "h", "c", None), (3, "h", "c", "r9"), (4, "h", "d", "r4"), (5, None, "c", "r2")],
                                  "n int, host_id string, process_correlation_id string, resource_id string")
    found = lineage.lookup_lineage(asked, table)
    step = found["`" + lineage.LINEAGE + "`"]["image"].alias("image")
    got = rows(found.select("n", "`" + lineage.LINEAGE + ".index`", step))
    want = [(0, 0, "init"), (0, 1, "sh"), (0, 2, "one"), (1, 0, "init"), (1, 1, "two"), (2, 0, "init"), (2, 1, "two"), (3, None, None), (4, 0, "init"), (4, 1, "two"), (4, 2, "leaf"), (5, None, None)]
    assert got == sorted(want, key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_circles_end_chains_and_leave_others(spark):
    """Circles of one, two and three processes, one with a tail, beside a chain on the same and another host."""
    links = [("h", "a", "b"), ("h", "b", "a"), ("h", "t1", "t2"), ("h", "t2", "a"), ("h", "c1", "c2"), ("h", "c2", "c3"), ("h", "c3", None),
             ("h", "s", "s"), ("g", "x", "y"), ("g", "y", "z"), ("g", "z", "x"), ("k", "c1", "c2"), ("k", "c2", None), ("o", "s", "s")]
    table = spark.createDataFrame(links, SCHEMA)
    found = lineage.ancestors(table, table)
    got = rows(found.select("host_id", "process_correlation_id", "steps", found["record"][lineage.KEY].alias("ancestor")))
    want = [(h, k, 0, k) for h, k, _ in links]
    want += [("h", "t1", 1, "t2"), ("h", "t1", 2, "a"), ("h", "t2", 1, "a"), ("h", "c1", 1, "c2"), ("h", "c1", 2, "c3"), ("h", "c2", 1, "c3"), ("k", "c1", 1, "c2")]
    assert got == sorted(want, key=repr)


def test_lineage_guards(spark):
    circle = spark.createDataFrame([("h", "a", "b"), ("h", "b", "a")], SCHEMA)
    with pytest.raises(ValueError):
        lineage.lookup_lineage(circle.drop("host_id"), circle)
    one = spark.createDataFrame([("h", "a", None)], SCHEMA)
    asked = spark.createDataFrame([("h", "a"), ("h", "zz")], "host_id string, process_correlation_id string")
    assert lineage.lookup_lineage(asked, one).count() == 2
    with pytest.raises(RuntimeError):
        lineage.lookup_lineage(asked, one, max_unmatched=0.05)


def test_children_and_parent(spark, forest):
    table = spark.createDataFrame([(h, k, p) for (h, k), p in forest.items()], SCHEMA)
    asked = spark.createDataFrame([("h2", "root"), ("h2", "s1"), ("h1", "c3"), (None, "x")], "host_id string, process_correlation_id string")
    found = lineage.lookup_children(asked, table)
    got = rows(found.select("host_id", "process_correlation_id", found["`" + lineage.CHILDREN + "`"][lineage.KEY].alias("child")))
    want = [("h2", "root", f"s{n}") for n in range(1, 60)] + [("h2", "s1", None), ("h1", "c3", "c4"), (None, "x", None)]
    assert got == sorted(want, key=repr)
    found = lineage.lookup_parent(table, table)
    parents = rows(found.select(*SCHEMA.replace(" string", "").split(", "), found["`" + lineage.PARENT_INFO + "`"][lineage.KEY].alias("parent")))
    want = [(h, k, p, p if (h, p) in forest else None) for (h, k), p in forest.items()]
    assert parents == sorted(want, key=repr)


def test_lineage_keys(spark):
    df = spark.createDataFrame([("h", "a", "r"), ("h", "a", "r"), ("h", "a", None), (None, "a", "r")], "host_id string, process_correlation_id string, resource_id string")
    assert lineage.lineage_keys(df).count() == 2
    assert lineage.lineage_keys(df.drop("resource_id")).count() == 1
    assert list(itertools.chain(*lineage.unmatched_rate(df, "resource_id", ["process_correlation_id"]).collect())) == ["a", 4, 1]
