from __future__ import annotations

from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from huntspark.catalog import QUERIES
from huntspark.catalog import streams as catalog_streams
from huntspark.plans import joins
from huntspark.streaming import streams


def run(df, folder, name, mode="append"):
    query = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{folder}/{name}-state")
    query.trigger(availableNow=True).start(f"{folder}/{name}").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def stream(spark, folder, frames):
    """A file stream whose batches are the given frames, in order."""
    for n, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in-{n}")
    reader = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{folder}/in-*")


def test_daily_counts_close_with_the_watermark(spark, tmp_path):
    day = "timestamp'2024-01-0{} 10:00:00' as ts, 'dns' as event_type, 't' as tenant_id, array('a', 'a', 'b') as values".format
    frames = [spark.sql(f"select {day(n)} union all select {day(n)}") for n in (1, 2, 3)]
    iocs = spark.createDataFrame([("a",), ("a",), ("zz",)], "value string")
    out = run(streams.daily_ioc_counts(stream(spark, tmp_path, frames), iocs), tmp_path, "daily")
    got = rows(out.select(F.date_format("day.start", "yyyy-MM-dd"), "matching_value", "count"))
    assert got == [("2024-01-01", "a", 2), ("2024-01-02", "a", 2)]


def test_staged_once(spark, tmp_path):
    row = "select 'alerts' as evidence_type, '{}' as id, 't' as tenant_id, 'i' as investigation_id, timestamp'2024-01-01 00:00:00' as ts".format
    frames = [spark.sql(row("x") + " union all " + row("x")), spark.sql(row("x") + " union all " + row("y"))]
    out = run(streams.staged_once(stream(spark, tmp_path, frames), "ts"), tmp_path, "once")
    assert rows(out, "id") == [("x",), ("y",)]


def test_append_evidence_is_idempotent(spark, tmp_path):
    write = streams.append_evidence(str(tmp_path / "table"))
    first = spark.createDataFrame([("events", "x", "t", "i"), ("alerts", "x", "u", "i")], "evidence_type string, id string, tenant_id string, investigation_id string")
    second = spark.createDataFrame([("events", "x", "t", "i"), ("events", "x", "t", "j")], first.schema)
    write(first, 0)
    write(second, 1)
    write(second, 1)
    table = spark.read.parquet(str(tmp_path / "table")).drop("batch")
    assert rows(table) == [("alerts", "x", "u", "i"), ("events", "x", "t", "j")]


def test_correlate_stream(spark, tmp_path):
    processes = spark.sql(
        """select 'h:1:2' as process_correlation_id, timestamp'2024-01-01 00:00:00' as ts
        union all select 'h:9:9', timestamp'2024-01-01 00:00:00' union all select 'late', timestamp'2024-01-09 00:00:00'"""
    )
    flows = spark.sql(
        """select 'h' as host_id, '1:2' as pid, '' as timewindow, timestamp'2024-01-01 05:00:00' as ts
        union all select 'h', '1', '2', timestamp'2024-01-01 06:00:00'
        union all select 'h', '1', '2', timestamp'2024-01-03 06:00:00'
        union all select 'z', '1', '2', timestamp'2024-01-09 00:00:00'"""
    )
    joined = streams.correlate_netflow_stream(stream(spark, tmp_path / "p", [processes]), stream(spark, tmp_path / "f", [flows]))
    out = run(joined, tmp_path, "joined")
    got = rows(out.select("process_correlation_id", F.hour("netflow_ts").alias("h")))
    assert got == sorted([("h:1:2", 5), ("h:1:2", 6), ("h:9:9", None)], key=repr)


def test_open_days_come_from_the_state(spark, tmp_path):
    """Closed days and the closing pass together are the batch answer, and no day comes twice."""
    day = "timestamp'2024-01-0{} 10:00:00' as ts, 'dns' as event_type, 't' as tenant_id, array('a', 'a', 'b') as values".format
    frames = [spark.sql(f"select {day(n)} union all select {day(n)}") for n in (1, 2, 3)]
    iocs = spark.createDataFrame([("a",), ("zz",)], "value string")
    out = run(streams.daily_ioc_counts(stream(spark, tmp_path, frames), iocs), tmp_path, "days")
    both = out.unionByName(streams.open_daily_counts(spark, f"{tmp_path}/days-state"))
    got = rows(both.select(F.date_format("day.start", "yyyy-MM-dd"), "matching_value", "count"))
    assert got == [(f"2024-01-0{n}", "a", 2) for n in (1, 2, 3)]


def test_staged_first_over_many_batches(spark, tmp_path):
    """Every key once, from the batch that brings it first; later batches read neither the table nor earlier batches."""
    schema = "evidence_type string, id string, tenant_id string, investigation_id string"
    batches = [
        [("events", "x", "t", "i"), ("alerts", "x", "u", "i"), ("alerts", "x", "u", "i"), (None, "y", "t", None)],
        [("alerts", "x", "a", "i"), ("events", "x", "t", "j"), ("events", "y", None, None)],
        [("events", "z", None, "i"), ("events", "x", "t", "j")],
        [("events", "x", "t", "i")],
    ]
    source = stream(spark, tmp_path, [spark.createDataFrame(b, schema) for b in batches])
    out = streams.staged_first(source)
    query = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/s").trigger(availableNow=True).start(f"{tmp_path}/rows")
    query.awaitTermination()
    assert [p["sources"][0]["numInputRows"] for p in query.recentProgress if p["sources"][0]["numInputRows"]] == [4, 3, 2, 1]
    assert "Relation [" not in query.lastProgress["sources"][0]["description"]
    got = rows(spark.read.schema(out.schema).parquet(f"{tmp_path}/rows").select("evidence_type", "id", "tenant_id", "investigation_id"))
    assert got == sorted([("alerts", "x", "u", "i"), (None, "y", "t", None), ("events", "x", "t", "j"), ("events", "z", None, "i")], key=repr)


def test_salted_matches_and_the_rest(spark, tmp_path):
    """One process with most flows: the pairs of the batch join, each once, and the processes without a flow."""
    processes = spark.range(6).selectExpr("id", "if(id < 4, 'h:1:2', 'h:9:'||id) as process_correlation_id", "timestamp'2024-01-01 00:00:00' + id * interval '1' hour as ts")
    flows = spark.range(200).selectExpr("id", "'h' as host_id", "if(id % 9 = 8, '7:7', '1:2') as pid", "'' as timewindow", "timestamp'2024-01-01 00:00:00' + id * interval '20' minute as ts")
    met = run(streams.correlate_matches(stream(spark, tmp_path / "p", [processes]), stream(spark, tmp_path / "f", [flows]), salts=5), tmp_path, "met")
    whole = streams.with_unmatched(met, processes, "id")
    want = [
        (p.id, f.id)
        for p in processes.collect()
        for f in flows.collect()
        if f"{f.host_id}:{f.pid}" == p.process_correlation_id and p.ts <= f.ts <= p.ts + timedelta(days=1)
    ]
    assert len(want) > 200
    assert rows(whole, "id", "netflow_id") == sorted([*want, (4, None), (5, None)], key=repr)


def state_rows(spark, folder, side):
    """The rows one side of a join has in the state of a stopped run."""
    return spark.read.format("statestore").option("joinSide", side).load(str(folder))


def test_only_hot_processes_are_copied(spark, tmp_path):
    """Events of the hot process stand once for each salt in the state, all others once; the pairs are those without a list."""
    processes = spark.range(6).selectExpr("id", "if(id = 5, null, if(id < 2, 'h:1:2', 'h:9:'||id)) as process_correlation_id", "timestamp'2024-01-01 00:00:00' as ts")
    flows = spark.range(120).selectExpr("id", "'h' as host_id", "if(id % 4 = 0, '9', '1') as pid", "if(id % 4 = 0, '3', '2') as timewindow", "timestamp'2024-01-01 00:00:00' + id * interval '20' minute as ts")
    hot = joins.hot_keys(flows.select(streams.netflow_key().alias("key")), ["key"], 50)
    assert len(hot) == 1
    got = {}
    for name, known in (("hot", hot), ("none", []), ("all", None)):
        frames = [stream(spark, tmp_path / name / side, [frame]) for side, frame in (("p", processes), ("f", flows))]
        met = streams.correlate_matches(*frames, salts=5, hot=known).select("id", "netflow_id")
        with streams.state_on_disk(spark):
            got[name] = rows(run(met, tmp_path, name + "-out"))
    assert got["hot"] == got["none"] == got["all"]
    assert len(got["hot"]) == 2 * sum(1 for k in range(73) if k % 4) + sum(1 for k in range(73) if k % 4 == 0)
    assert [state_rows(spark, tmp_path / f"{n}-out-state", "left").count() for n in ("hot", "none", "all")] == [2 * 5 + 3, 5, 5 * 5]
    assert state_rows(spark, tmp_path / "hot-out-state", "right").count() == 120


def test_stream_correlate_keeps_each_event_once_and_off_the_heap(spark, tmp_path, monkeypatch):
    """The whole query on tables of its own: pairs and lonely events, each event once in a state that RocksDB holds."""
    start = "timestamp'2024-01-01 00:00:00'"
    events = spark.range(600).selectExpr("if(id = 597, 3, id) as event_id", f"{start} + (id % 9) * interval '5' hour as ts", "id % 7 as user_id", "'dns' as event_type", "1.0D as value", "'x1' as props")
    flows = spark.range(900).selectExpr("id * 7 as l_orderkey", "id % 4 + 1 as l_partkey", "if(id % 10 = 0, id, id % 4 + 1) % 3 as l_suppkey", "cast(id % 4 + 1 as int) as l_linenumber", "1.0D as l_quantity", f"{start} as l_shipdate")
    events.write.parquet(f"{tmp_path}/events.parquet")
    flows.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(catalog_streams, "fresh_folder", lambda i: str(tmp_path / "run"))
    settings = {k: spark.conf.get(k, None) for k in streams.STATE_ON_DISK}
    got = rows(QUERIES["stream_correlate"](spark, str(tmp_path)))
    assert {k: spark.conf.get(k, None) for k in streams.STATE_ON_DISK} == settings
    named = {}
    for f in flows.collect():
        key = f"h{f.l_orderkey % 150}:{f.l_partkey % 60}:{f.l_suppkey % 3}"
        name = "-".join(str(x) for x in (f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey))
        named.setdefault(key, []).append((name, datetime(2024, 1, 1) + timedelta(minutes=f.l_orderkey % 43200)))
    want, met = [], set()
    for e in events.collect():
        pid = e.event_id // 150 + 1
        for name, at in named.get(f"h{e.event_id % 150}:{pid}:{pid % 3}", []) if e.event_id % 101 != 100 else []:
            if e.ts <= at <= e.ts + timedelta(days=2):
                want.append((e.event_id, name))
                met.add(e.event_id)
    assert len(want) > 200
    want += [(e.event_id, "") for e in events.collect() if e.event_id not in met]
    assert got == sorted(want, key=repr)
    keyed = events.where("event_id % 101 <> 100").count()
    assert state_rows(spark, tmp_path / "run/state", "left").count() == keyed
    assert state_rows(spark, tmp_path / "run/state", "right").count() == 900
    assert "RocksDB" in (tmp_path / "run/state/offsets/0").read_text()
