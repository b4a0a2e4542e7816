from __future__ import annotations

import json
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from huntspark.operators import evidence, ioc, lookups, networks, tenants
from huntspark.sources import scans, sinks


def test_lookup_tenants(spark):
    df = spark.createDataFrame([(1, "t1", "mine"), (2, None, "mine")], "n int, tenant_id string, `tenant.id` string")
    table = spark.createDataFrame([("t1", "One")], "id string, name string")
    out = lookups.lookup_tenants(df, table)
    assert rows(out, "n", "tenant.id", "tenant.id.lookup_tenants", "tenant.name") == sorted(
        [(1, "mine", "t1", "One"), (2, "mine", None, None)], key=repr
    )
    assert lookups.lookup_tenants(out, table) is out
    with pytest.raises(ValueError):
        lookups.lookup_tenants(df, table, "nope")


def test_lookup_users_priority(spark):
    users = spark.createDataFrame(
        [("1", "x", "u1", "a@"), ("2", "1", "u2", "b@"), ("3", "y", "x", "c@"), ("3", "z", None, "d@")],
        "id string, idp_user_id string, user_id string, email string",
    )
    df = spark.createDataFrame([(1, "1", "3"), (2, "x", None), (3, "u2", "nobody")], "n int, created_by string, updated_by string")
    out = lookups.lookup_users(df, users)
    got = rows(out, "n", "created_by.user.email", "updated_by.user.email")
    # "1" is user 1's id before it is user 2's other id; id 3 is shared by two users
    assert got == sorted([(1, "a@", "c@"), (1, "a@", "d@"), (2, "a@", None), (3, "b@", None)], key=repr)
    assert lookups.lookup_users(df.select("n"), users).columns == ["n"]
    assert lookups.lookup_users(out, users).columns == out.columns


def test_lookup_assets(spark):
    df = spark.createDataFrame([(1, "h", "['t1']"), (2, "h", "t2"), (3, None, "t1")], "n int, host_id string, tenant_id string")
    assets = spark.sql(
        """select 'h' as host_id, 't1' as tenant_id, array(named_struct('hostname', 'first'), named_struct('hostname', 'second')) as hostnames
        union all select 'h', 't3', cast(array() as array<struct<hostname: string>>)"""
    )
    assert rows(lookups.lookup_assets(df, assets), "n", "asset_info.hostname") == sorted([(1, "first"), (2, None), (3, None)], key=repr)
    by_host = lookups.lookup_assets(df, assets, by_host_only=True)
    assert by_host.where("n = 2").count() == 2
    with pytest.raises(ValueError):
        lookups.lookup_assets(df.drop("host_id"), assets)


def test_lookup_evidence(spark):
    df = spark.createDataFrame([("alerts", "1"), ("events", "1"), ("search_queries", "1"), ("events", "9")], "x_evidence_type string, x_evidence_id string")
    table = spark.createDataFrame([("1", "v")], "id string, v string")
    out = lookups.lookup_evidence(df, table, table, table)
    assert rows(out, "x_evidence_type", "x_evidence_id", "alert.v", "event.v", "query.v") == sorted(
        [("alerts", "1", "v", None, None), ("events", "1", None, "v", None), ("search_queries", "1", None, None, "v"), ("events", "9", None, None, None)],
        key=repr,
    )
    with pytest.raises(ValueError):
        lookups.lookup_evidence(df.drop("x_evidence_id"), table, table, table)


EVIDENCE = "evidence_type string, id string, tenant_id string, investigation_id string"


def test_stage_unstage_clear(spark):
    store = spark.createDataFrame([("alerts", "a", "t", "i1")], EVIDENCE)
    new = spark.createDataFrame([("events", "a", "t", "i1"), ("events", "b", "t2", "i1"), ("alerts", "b", "t3", "i1"), ("alerts", "a", "t", "i2")], EVIDENCE)
    after = evidence.stage(store, new)
    want = [("alerts", "a", "t", "i1"), ("alerts", "a", "t", "i2"), ("alerts", "b", "t3", "i1")]
    assert rows(after) == want
    assert rows(evidence.stage(after, new)) == want
    change = {(r.evidence_type, r.investigation_id): (r.before, r.after, r.difference) for r in evidence.changes(store, after, "stage").collect()}
    assert change == {("alerts", "i1"): (1, 2, 1), ("alerts", "i2"): (0, 1, 1)}
    assert rows(evidence.unstage(after, new)) == [("alerts", "a", "t", "i1")]
    assert rows(evidence.clear(after, investigation_id="i1")) == [("alerts", "a", "t", "i2")]
    assert evidence.clear(after).count() == 0
    assert rows(evidence.read_evidence(after, "alerts", "t3")) == [("alerts", "b", "t3", "i1")]
    assert evidence.investigation_evidence(after, "t", "i1").count() == 1


def test_incoming_evidence(spark):
    df = spark.createDataFrame([("r", "i", 5)], "resource_id string, id string, `tenant.id` int")
    assert rows(evidence.incoming(df, "events")) == [("events", "r", "5", "NEW")]


def test_merge_investigations(spark):
    invs = spark.createDataFrame(
        [("s", "OPEN", "S", False), ("t", "DRAFT", "T", False), ("c", "CLOSED", "C", False), ("m", "OPEN", "Merged Investigation: x", False), ("r", "OPEN", "R", True)],
        "id string, status string, title string, archived boolean",
    )
    store = spark.createDataFrame(
        [("alerts", "a", "1", "s"), ("events", "b", "1", "s"), ("events", "b", "2", "t"), ("alerts", "z", "1", "c")], EVIDENCE
    )
    merges = spark.createDataFrame([("s", "t"), ("c", "t"), ("m", "t"), ("r", "t"), ("t", "c"), ("t", "t")], "source string, target string")
    new_invs, new_store = evidence.merge_investigations(invs, store, merges)
    assert rows(new_store) == [("alerts", "a", "1", "t"), ("alerts", "z", "1", "c"), ("events", "b", "2", "t")]
    done = {r.id: (r.status, r.title, r.archived) for r in new_invs.collect()}
    assert done["s"] == ("CLOSED_INFORMATIONAL", "Merged Investigation: S", True)
    assert done["t"] == ("DRAFT", "T", False) and done["m"][0] == "OPEN"


def test_query_log(spark):
    log = spark.createDataFrame([("q1", "t", "x", 1), ("q2", "t", "y", 2)], "id string, tenant_id string, query string, inserted_time int")
    more = evidence.track_queries(log, spark.createDataFrame([("q2", "t", "new", 9), ("q3", "u", "z", 2)], log.schema))
    assert rows(more, "id", "query") == [("q1", "x"), ("q2", "y"), ("q3", "z")]
    assert rows(evidence.last_query(more)) == [("q3",)]
    assert rows(evidence.untrack_queries(more, more.where("id = 'q1'")), "id") == [("q2",), ("q3",)]
    staged, left = evidence.stage_queries(spark.createDataFrame([], EVIDENCE), more, "i")
    assert staged.count() == 3 and left.count() == 0


def test_tenant_search_and_macros(spark, tmp_path):
    df = spark.sql(
        """select 1 as id, 'Acme%' as name, array('MDR Plus') as services, array(named_struct('name', 'l', 'value', 'v')) as labels,
          array(named_struct('name', 'us', 'enabled', true)) as environments, true as enabled, timestamp'2024-01-05 00:00:00' as created_at
        union all select 2, 'Beta', array('x_y', 'MDR'), array(), array(named_struct('name', 'us', 'enabled', false)), false, timestamp'2024-02-05 00:00:00'"""
    )

    def ids(**kw):
        return [r.id for r in tenants.tenant_search(df, **kw).collect()]

    assert ids() == [1, 2] and ids(ascending=False) == [2, 1]
    assert ids(name="Be%") == [2] and ids(name="1") == [1] and ids(ids=["2"]) == [2]
    assert ids(region="us") == [1] and ids(services=["MDR"]) == [2] and ids(enabled=False) == [2]
    assert ids(label_name="l") == [1] and ids(label_name="l", label_value="w") == []
    assert ids(created=("2024-02-01T00:00:00Z", None)) == [2]
    with pytest.raises(ValueError):
        ids(label_value="v")

    path = tmp_path / "macros.json"
    path.write_text(json.dumps({"macros": {"a": {"services": ["*MDR*", "x?y"]}, "b": {"services": ["x_y"]}, "c": {"services": ["no*"]}, "all": {}}}))
    macros = tenants.load_macros(str(path))
    resolve = lambda t: rows(tenants.resolve_tenants(df, t, macros))
    assert resolve("@a") == [("1",), ("2",)] and resolve("@b") == [("2",)] and resolve("@c") == [] and resolve("@all") == [("1",), ("2",)]
    assert resolve("77") == [("77",)] and resolve(None) == [("1",), ("2",)]
    with pytest.raises(ValueError, match="unknown"):
        resolve("@nope")
    assert tenants.load_macros(str(tmp_path / "missing.json")) == {}


def test_merge_results(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, 5), (3, 6)], "id int, other int")
    assert tenants.merge_results({}) is None and tenants.merge_results({"t": a}) is a
    assert rows(tenants.merge_results({"t": a, "u": b}), "id", "_macro_tenant_id") == [(1, "t"), (2, "u"), (3, "u")]


def test_networks(spark):
    old = spark.createDataFrame([("10.0/16", 1, "old", "Internal"), ("10.1/16", 2, "keep", "DMZ")], "cidr string, id int, description string, network_type string")
    new = spark.createDataFrame([("10.0/16", "new", "DMZ"), ("10.2/16", "add", "DMZ"), ("10.1/16", "bad", "Bogus")], "cidr string, description string, network_type string")
    got = rows(networks.upsert_classify(old, new, ["Internal", "DMZ"]), "cidr", "id", "action")
    assert got == sorted([("10.0/16", 1, "update"), ("10.2/16", None, "create")], key=repr)
    merged = rows(networks.upsert_merge(old, new, ["Internal", "DMZ"]))
    assert merged == sorted([("10.0/16", 1, "new", "DMZ"), ("10.1/16", 2, "keep", "DMZ"), ("10.2/16", None, "add", "DMZ")], key=repr)


def test_ioc_sweep_window_and_counts(spark, tmp_path):
    events = spark.createDataFrame(
        [
            ("dns", "t1", date(2024, 1, 30), ["1.1.1.1", "1.1.1.1"], ["a.com"]),
            ("dns", "t1", date(2024, 1, 31), ["1.1.1.1"], []),
            ("dns", "t1", date(2023, 12, 31), ["1.1.1.1"], []),
            ("dns", "t1", date(2023, 12, 30), ["1.1.1.1"], []),
            ("dns", "t2", date(2024, 1, 30), ["2.2.2.2"], ["1.1.1.1"]),
        ],
        "event_type string, tenant_id string, date date, `logicals.ip` array<string>, `logicals.domain` array<string>",
    )
    path = tmp_path / "iocs.txt"
    path.write_text("1.1.1.1\n\n a.com \nnot an indicator\n")
    iocs = ioc.indicator_table(ioc.read_indicators(spark, str(path)))
    assert rows(iocs) == [("1.1.1.1", "ip"), ("a.com", "domain")]
    got = rows(ioc.ioc_sweep(events, iocs, date(2024, 1, 31)))
    assert got == [
        ("dns", date(2023, 12, 31), "1.1.1.1", "ip", "t1", 1),
        ("dns", date(2024, 1, 30), "1.1.1.1", "ip", "t1", 1),
        ("dns", date(2024, 1, 30), "a.com", "domain", "t1", 1),
    ]
    sweep = lambda kinds: (lambda e: ioc.ioc_sweep(e, iocs, date(2024, 1, 31), logical_types=kinds))
    assert rows(ioc.multi_search(events, [sweep(["ip"]), sweep(["domain"])])) == got
    everyone = spark.createDataFrame([("t1",), ("t2",)], "id string")
    assert rows(ioc.null_findings(everyone, ioc.ioc_sweep(events, iocs, date(2024, 1, 31)))) == [("t2",)]
    blank = tmp_path / "blank.txt"
    blank.write_text("\n \n")
    with pytest.raises(ValueError):
        ioc.read_indicators(spark, str(blank))


def test_threat_intel(spark):
    df = spark.createDataFrame(
        [(1, "x:y:s.auth:1", "9.9.9.9", None, "m"), (2, "x:y:s.filemod:1", "9.9.9.9", "f", "m"), (3, "x:y:s.unknown:1", "9.9.9.9", None, None), (4, "x:y:s.filemod:2", None, None, "m")],
        "n int, resource_id string, source_address string, file_hash string, `parent_process_file_hash.md5` string",
    )
    seen = []

    def correlate(frame, indicators):
        seen.append(rows(indicators))
        return ioc.get_ti_pubs(frame, pubs, "n")

    pubs = spark.createDataFrame([("9.9.9.9", "p1"), ("9.9.9.9", "p2"), ("9.9.9.9", "p2"), ("f", "p3"), ("other", "p4")], "indicator string, publication_id string")
    out = ioc.add_threat_intel(df, [correlate])
    assert seen == [[("9.9.9.9",), ("f",), ("m",)]]
    assert rows(out, "n", "logicals.ip", "logicals.hash", "tips.found", "tips.indicators", "tips.publications") == [
        (1, ["9.9.9.9"], [], True, 1, 2), (2, [], ["f", "m"], True, 1, 1), (3, [], [], False, 0, 0), (4, [], ["m"], False, 0, 0),
    ]
    assert ioc.add_threat_intel(df.select("n"), [correlate]).columns == ["n"]
    both = spark.createDataFrame([("f", "p3"), ("m", "p3"), ("m", "p5")], "indicator string, publication_id string")
    assert ("2", 2, 2) in [(str(r[0]), r[1], r[2]) for r in ioc.get_ti_pubs(ioc.add_logicals(df), both, "n").select("n", "`tips.indicators`", "`tips.publications`").collect()]
    nested = spark.sql("select 1 as n, array(named_struct('resource_id', 'a:b:s.nids:1', 'source_address', '1.1.1.1')) as event_ids")
    assert ioc.add_logicals(nested).select("`logicals.ip`").first()[0] == ["1.1.1.1"]


def test_scans(spark, tmp_path):
    df = spark.createDataFrame([(3, "b", "x", ["r1"]), (1, "a", "xy", ["r2"]), (2, "b", None, None)], "event_time_usec long, schema string, name string, role_ids array<string>")
    assert [r.event_time_usec for r in scans.search_events(df, "b").collect()] == [2, 3]
    assert scans.search_events(df, limit=1).first().event_time_usec == 1
    assert scans.search_alerts(df, limit=2).count() == 2
    assert rows(scans.rows_by_id(df, ["b"], "schema"), "event_time_usec") == [(2,), (3,)]
    assert rows(scans.search_audits(df, search_by_all="y", schema="a"), "event_time_usec") == [(1,)]
    with pytest.raises(ValueError):
        scans.search_audits(df, nope="a")
    assert rows(scans.rule_search(df, "x"), "event_time_usec") == [(1,), (3,)]
    assert rows(scans.search_users(df, roles=["r1"]), "event_time_usec") == [(3,)]
    assert scans.watchlist(df.withColumn("type", F.col("schema")), "a").count() == 1
    assert scans.network_ranges(df.withColumn("tenant_id", F.lit(5)), "5").count() == 3
    assert [r.event_time_usec for r in scans.latest_publications(df.withColumnRenamed("event_time_usec", "published").withColumn("id", F.col("schema")).withColumn("event_time_usec", F.col("published")), 2).collect()] == [3, 2]
    a = scans.repeatable_sample(df, 2, "event_time_usec", 1)
    assert rows(a) == rows(scans.repeatable_sample(df.repartition(3), 2, "event_time_usec", 1))
    (tmp_path / "one.json").write_text('[{"id": 1, "t": {"x": 2}},\n {"id": 2}]')
    assert scans.find_dataframe(spark, str(tmp_path / "one.json")).count() == 2
    (tmp_path / "net.csv").write_text("cidr,description,is_critical,network_type\n10/8,a,true,Internal\n")
    assert rows(scans.read_network_ranges(spark, str(tmp_path / "net.csv"))) == [("10/8", "a", True, "Internal")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, True)], "id int, empty string, flag boolean")
    assert sinks.assign(df, "bound", drop_empty=True).columns == ["id", "flag"]
    assert spark.table("bound").count() == 1
    assert sinks.append(None, df) is df
    assert sinks.append(df, spark.createDataFrame([(2,)], "id int")).count() == 2
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().id == 1
    sinks.write_network_ranges(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().flag == "true"
    sinks.write_state(df, str(tmp_path / "s"), ["id"])
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_state(df, str(tmp_path / "s"))
