from __future__ import annotations

import itertools

import pytest
from conftest import rows
from pyspark.sql import functions as F

from huntspark.operators import alerts, audits, context, entities, facets, lookups, rules
from huntspark.sources import scans


@pytest.fixture(scope="module")
def flat(spark):
    data = [
        ("a1", "T1", "OPEN", None, None, ["userName:u1", "sourceIpAddress:1.1.1.1", "fileName:f", "userName:u1"]),
        ("a2", "T2", "OPEN", None, None, ["userName:u1", "hostName:h1"]),
        ("a3", "T2", "CLOSED", "ok", None, ["sourceIpAddress:1.1.1.1", "md5:abc"]),
        ("a4", "T3", "CLOSED", "ok", "i1", ["userName:u2", "domain:ex.org:8080"]),
        ("a5", "T1", "OPEN", None, "i1", ["userName:u1"]),
        ("a6", "T1", "OPEN", None, None, None),
        ("a7", "T2", "CLOSED", "ok", None, ["md5:abc", "sourceIpAddress:1.1.1.1"]),
        ("a9", "T9", "OPEN", None, None, ["hostName:abc", "domain:other.org"]),
        ("a8", "T2", "OPEN", None, None, ["odd", "unknownType:x"]),
    ]
    return spark.createDataFrame(
        data,
        "id string, `metadata.title` string, status string, resolution_reason string, investigation_id string, "
        "`entities.entities` array<string>",
    )


def python_entities(flat):
    kinds = {"userName": "@user", "sourceIpAddress": "@ip", "hostName": "@host", "md5": "@hash", "domain": "@domain"}
    out = {}
    for r in flat.collect():
        pairs = [e.split(":", 1) for e in r["entities.entities"] or []]
        out[r.id] = sorted({(kinds[p[0]], p[1]) for p in pairs if len(p) == 2 and p[0] in kinds})
    return out


def test_normalize_entities(flat):
    want = sorted((i, *e) for i, es in python_entities(flat).items() for e in es)
    got = rows(entities.normalize_entities(flat), "id", entities.FIELD, entities.VALUE)
    assert got == want
    assert ("a4", "@domain", "ex.org:8080") in got
    assert entities.keep_logical_type(entities.normalize_entities(flat), "@host").count() == 2


def test_relate_entities_against_brute_force(flat):
    want = set()
    for es in python_entities(flat).values():
        want |= {(a[1], *b) for a, b in itertools.permutations(es, 2) if a[1] != b[1]}
    relations = entities.relate_entities(flat)
    assert rows(relations) == sorted(want)
    counts = {r.value: r.asDict() for r in entities.relation_counts(relations).collect()}
    assert counts["u1"]["related_ip"] == 1 and counts["u1"]["related_host"] == 1 and counts["u1"]["related_user"] == 0


def test_relations_of_a_hub_alert_come_in_blocks(spark):
    """An alert with many entities: the relations are the same, and its pairs come from several tasks."""
    listed = [f"userName:u{k}" for k in range(130)] + [f"sourceIpAddress:10.0.0.{k}" for k in range(120)] + ["hostName:u7"]
    df = spark.createDataFrame([("a", listed), ("b", ["userName:u1", "md5:x"]), ("c", listed), ("d", None)], "id string, `entities.entities` array<string>")
    whole = rows(entities.relate_entities(df, block=1000))
    assert rows(entities.relate_entities(df, block=16)) == whole and len(whole) > 250 * 248
    dealt = entities.relate_entities(df.where("id = 'a'"), block=16)
    assert "REPARTITION" in dealt._jdf.queryExecution().executedPlan().toString()


def test_entity_alert_counts(flat):
    assert ("@user", "u1", 3) in rows(entities.entity_alert_counts(flat))


def brute_context(flat, terms, keep, key):
    """entity -> {(key, entities): number of alerts that hold any term of the entity}"""
    held = python_entities(flat)
    out = {}
    for entity, wanted in terms.items():
        for r in flat.collect():
            if keep(r) and set(held[r.id]) & wanted:
                k = (*entity, ",".join(sorted(r["entities.entities"])), *key(r))
                out[k] = out.get(k, 0) + 1
    return sorted(((*k, n) for k, n in out.items()), key=repr)


@pytest.mark.parametrize("two_hop", [False, True])
def test_contexts_against_brute_force(flat, two_hop):
    seed = context.seeds(entities.normalize_entities(flat))
    relations = entities.relate_entities(flat)
    terms = context.related_terms(seed, relations) if two_hop else context.own_terms(seed)
    wanted, firsts = {}, {}
    for _, es in sorted(python_entities(flat).items()):
        for e in es:
            firsts.setdefault(e[1], e)
    for es in python_entities(flat).values():
        for e in es:
            first = firsts[e[1]]
            wanted.setdefault(first, {first})
            if two_hop:
                wanted[first] |= {o for o in es if o[1] != e[1]}
    got = rows(context.context_resolved(flat, terms))
    assert got == brute_context(flat, wanted, lambda r: r.status != "OPEN", lambda r: (r["metadata.title"], r.status, r.resolution_reason))
    got = rows(context.context_investigations(flat, terms))
    assert got == brute_context(
        flat, wanted, lambda r: r.investigation_id, lambda r: (r["metadata.title"], r.investigation_id, r.status)
    )
    titles = {(r.entity_field, r.entity_value): r.title for r in seed.collect()}
    got = rows(context.context_open_alerts(flat, seed, terms))
    found = brute_context(
        flat, wanted, lambda r: r.status == "OPEN" and not r.investigation_id, lambda r: (r["metadata.title"],)
    )
    assert got == [k for k in found if k[3] != titles[k[:2]]]


def test_context_events_counts_an_event_once_per_entity(spark, flat):
    events = spark.createDataFrame([("u1", "1.1.1.1", "x"), ("u1", None, "x"), (None, "1.1.1.1", "y")], "u string, ip string, kind string")
    seed = context.seeds(entities.normalize_entities(flat))
    columns = {"@user": ["u"], "@ip": ["ip", "missing"]}
    own = context.context_events(events, context.own_terms(seed), columns, ["kind"])
    assert rows(own) == [("@ip", "1.1.1.1", "x", 1), ("@ip", "1.1.1.1", "y", 1), ("@user", "u1", "x", 2)]
    wide = context.context_events(events, context.related_terms(seed, entities.relate_entities(flat)), columns, ["kind"])
    assert ("@user", "u1", "x", 2) in rows(wide) and ("@user", "u1", "y", 1) in rows(wide)


def test_context_query_text(spark):
    df = spark.createDataFrame(
        [("@user", "u", "T", ["1.1.1.1", "2.2.2.2"])], "x_entities_field string, x_entities_value string, `metadata.title` string, `@ip` array<string>"
    )
    row = context.generate_context_queries(df).first()
    assert row.x_events_query == "WHERE (@user = 'u' OR @ip = '1.1.1.1' OR @ip = '2.2.2.2') EARLIEST=-1d"
    assert "metadata.title != 'T' AND status = 'OPEN'" in row.x_open_alerts_query
    assert row.x_resolved_alerts_query.endswith("| aggregate count by metadata.title, entities, status, resolution_reason")


def test_creator_names(spark):
    df = spark.createDataFrame([("c1",), ("c2",), (None,)], "creator string")
    detectors = spark.createDataFrame([("c1", "Second", 2), ("c1", "First", 1)], "creator_name string, display_name string, ord int")
    got = rows(alerts.normalize_creator_name(df, detectors), "creator", "x_creator_display_name")
    assert got == sorted([("c1", "First"), ("c2", "c2"), (None, None)], key=repr)
    with pytest.raises(ValueError):
        alerts.normalize_creator_name(df.select(F.lit(1).alias("x")), detectors)


def test_groups_keep_nulls_and_facets_drop_them(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, n int")
    wanted = ["k", "nope"]
    assert rows(alerts.groupby(df, wanted)) == sorted([("a", 2), (None, 1)], key=repr) and wanted == ["k", "nope"]
    assert [tuple(r) for r in alerts.get_facet(df, ["k", "n", "nope"]).collect()] == [("a", 1, 2)]


def test_alerts_from_aggregation(spark):
    alerts_df = spark.createDataFrame([(1, "x", 5), (2, "y", 5), (3, None, 5), (4, "it's", 7)], "id int, t string, n int")
    groups = spark.createDataFrame([("x", 5, 9, "z"), (None, 5, 9, "z"), ("it's", 7, 9, "z")], "t string, n int, count int, `1st` string")
    assert rows(alerts.get_alerts_from_aggregation(groups, alerts_df), "id") == [(1,), (4,)]
    assert rows(alerts.get_alerts_from_aggregation(groups, alerts_df, [F.col("n") > 5]), "id") == [(4,)]
    assert alerts.get_alerts_from_aggregation(groups, alerts_df, limit=1).count() == 1
    timed = alerts_df.withColumn("metadata.created_at.seconds", F.col("id"))
    late = alerts.get_alerts_from_aggregation(groups, timed, earliest="1970-01-01T00:00:02Z", latest="1970-01-01T00:01:00Z")
    assert rows(late, "id") == [(4,)]
    with pytest.raises(ValueError):
        alerts.get_alerts_from_aggregation(groups.select("count"), alerts_df)


def test_resolution(spark):
    df = spark.range(1000).selectExpr("'a'||(id % 700) as id", "if(id % 700 < 600, 't1', 't2') as tenant_id", "'OPEN' as status")
    batches = alerts.resolution_batches(df, "DONE", "why")
    sizes = {(r.tenant_id, r.batch): r["count"] for r in batches.groupBy("tenant_id", "batch").count().collect()}
    assert sizes == {("t1", 0): 250, ("t1", 1): 250, ("t1", 2): 100, ("t2", 0): 100}
    assert batches.select("alert_id").distinct().count() == 700
    done = alerts.apply_resolution(df, df.where("tenant_id = 't2'"), "DONE", "why")
    assert done.where("status = 'DONE' and resolution_reason = 'why'").count() == df.where("tenant_id = 't2'").count()


def test_suppression_against_brute_force(spark, flat):
    import re

    sets = [
        [("alert_title", "^T1$", False)],
        [("alert_title", "T", False), ("entity", "^userName:u2$", False)],
        [("entity", "1[.]1[.]1", False), ("alert_title", "^(T2|T9)$", False), ("entity", "md5", True)],
        [("detector", "^d[12]$", False), ("entity", "user", True), ("alert_title", "^T2$", False)],
        [("alert_title", "^T[12]$", True), ("entity", "ex.org", True)],
        [("entity", "never", False)],
    ]
    alerts_df = flat.withColumn("d", F.when(F.col("id") > "a4", "d1").otherwise("d9"))
    held = {
        r.id: {"alert_title": [r["metadata.title"]], "detector": [r.d], "entity": r["entities.entities"] or []} for r in alerts_df.collect()
    }

    def holds(filters, values):
        return all(any(re.search(p, v) for v in values[k]) != inv for k, p, inv in filters)

    for chosen in [sets[:1], sets[1:2], sets[2:3], sets[3:4], sets[4:5], sets[5:], sets[:4], sets, sets + sets[:2]]:
        table = spark.createDataFrame(
            [(n, f) for n, f in enumerate(chosen)], "rule_id int, filters array<struct<key: string, pattern: string, inverted: boolean>>"
        )
        left = rules.apply_suppression(alerts_df, table, detector="d")
        want = sorted((i,) for i, v in held.items() if not any(holds(f, v) for f in chosen))
        assert rows(left, "id") == want


PATTERNS = [
    "abc", "^abc", "a.cde", "abcd?ef", "ab+cde", "(abc)?def", "(abc|xyz)qrs", "abc|def", "[abc]def", "a[]]bcd", r"10\.0\.0\.1$", r"10[.]0[.]", r"\babc\b", r"abc\d+def",
    r"a\\.bcd", "abc{2}def", "(?i)ABC", "abc*?def", "x(a(b)c)yz1", "x(a(b)?)*yz1", "..", "a", "", "abc$|^$", "[^a]bcd", "abcx*", r"\x41bcd", r"(ab)(cd)\1", "a.{0,2}bcd", "abc??def", "été.", "[a-c]{3}xyz",
]


def test_required_text_stands_in_every_match(spark):
    import re

    rng = __import__("random").Random(4)
    words = ["abc", "def", "xyz", "qrs", "bcd", "10.0.0.1", "a", "b", "c", "1", "Abcd", "abab", "xabcyz1", "xyz1", "cde", "été", "ef", "\\", "]bcd", "2", "x", "ABC", "\n"]
    values = ["".join(rng.choice(words) for _ in range(rng.randint(0, 5))) for _ in range(1500)]
    texts = dict(spark.createDataFrame([(p,) for p in PATTERNS], "pattern string").select("pattern", rules.required_text(F.col("pattern"))).collect())
    for pattern, text in texts.items():
        if text is not None:
            assert all(text in v for v in values if re.search(pattern, v)), pattern
    assert texts[r"10\.0\.0\.1$"] == "10.0.0.1" and texts["abcd?ef"] == "abc" and texts["abc|def"] is None and texts["(abc)?def"] == "def"
    got = rows(rules.pattern_matches(
        spark.createDataFrame([("entity", v) for v in values], "key string, value string"),
        spark.createDataFrame([("entity", p) for p in PATTERNS], "key string, pattern string"), chunk=4, salts=3))
    assert got == sorted({("entity", v, p) for v in values for p in PATTERNS if re.search(p, v)}, key=repr)


def test_pattern_matches_with_many_chunks(spark):
    import re

    values = spark.range(60).selectExpr("'entity' as key", "'v'||id as value")
    patterns = spark.range(40).selectExpr("if(id % 2 = 0, 'entity', 'detector') as key", "if(id % 4 = 0, 'v'||id||'$', '^v'||id||'$') as pattern")
    got = rows(rules.pattern_matches(values, patterns, chunk=3, salts=4))
    want = sorted(
        (v.key, v.value, p.pattern)
        for v in values.collect()
        for p in patterns.collect()
        if v.key == p.key and re.search(p.pattern, v.value)
    )
    assert got == want


def test_diffs(spark):
    df = spark.createDataFrame(
        [("x\ny", "x\nz", ["a"], ["a", "b"], 1), (None, "n", None, [], 2), ("s", "s", ["q"], None, 3)],
        "`before_state.t` string, `after_state.t` string, `before_state.l` array<string>, `after_state.l` array<string>, `before_state.only` int",
    )
    out = audits.get_diffs(df)
    assert rows(out, "x_diff_t", "x_diff_l") == sorted([(["- y", "+ z"], ["+ b"]), (["+ n"], []), ([], ["- q"])], key=repr)
    assert rows(audits.changed_fields(df), "x_changed_fields") == [(["l", "t"],), (["l", "t"],), (["l"],)]
    for bad in (df.select("`before_state.t`"), df.select("`after_state.t`"), df.select("`before_state.t`", "`after_state.l`")):
        with pytest.raises(ValueError):
            audits.get_diffs(bad)


def test_facets_by_schema_extra_and_preview(spark):
    df = spark.createDataFrame(
        [("scriptblock", "bash", "x" * 300, "e"), ("nids", None, None, "e"), ("other", "z", None, None)],
        "schema string, interpreter_name string, decoded_block_text string, tag string",
    )
    got = rows(facets.facets_by_schema(df, F.col("schema"), ["scriptblock", "nids"], ["tag"]))
    assert got == [("nids", "tag=e", 1), ("scriptblock", "interpreter_name=bash|decoded_block_text=" + "x" * 200 + "|tag=e", 1)]
    top = rows(facets.top_by_schema(df, F.col("schema"), ["scriptblock", "nids"], 1))
    assert [t[0] for t in top] == ["nids", "scriptblock"]


def test_facets_count_whole_values(spark):
    df = spark.createDataFrame(
        [("nids", None, None), ("nids", None, "null"), *[("scriptblock", "b", "x" * 300 + k) for k in "aab"]],
        "schema string, interpreter_name string, decoded_block_text string",
    )
    got = rows(facets.facets_by_schema(df, F.col("schema"), ["scriptblock"]))
    assert [r[2] for r in got] == [1, 2] and got[0][1] == got[1][1]
    missing = df.where("schema = 'nids'").withColumn("schema", F.lit("scriptblock"))
    assert [r[2] for r in rows(facets.top_by_schema(missing, F.col("schema"), ["scriptblock"]))] == [1, 1]


def test_searches_list_every_row_unless_a_limit_is_given(spark):
    many = spark.range(120_000).select(F.col("id").alias("event_time_usec"), F.lit("s").alias("application"))
    assert scans.search_alerts(many).count() == scans.search_audits(many).count() == scans.search_events(many).count() == 120_000
    assert rows(scans.search_alerts(many, time_column="event_time_usec", limit=2), "event_time_usec") == [(0,), (1,)]


def test_lookups_read_only_what_is_used(spark, tmp_path):
    wide = spark.range(50).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("tenant_id"), F.lit("wide").alias("props"), F.col("id").alias("event_id")
    )
    wide.write.parquet(str(tmp_path / "wide"))
    tenants = spark.createDataFrame([("1", "one"), ("x-2", "two")], "id string, name string")
    found = lookups.lookup_tenants(spark.read.parquet(str(tmp_path / "wide")), tenants).select("event_id", "`tenant.name`")
    assert "props" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 50 and found.where("`tenant.name` = 'one'").count() == wide.where("tenant_id = 1").count()


def test_differences_count_repeated_and_blank_lines(spark):
    df = spark.createDataFrame([("a\na", "a"), ("a\n\nb", "a\nb"), ("a\nb", "b\na"), (None, "")], "`before_state.t` string, `after_state.t` string")
    assert [r.x_diff_t for r in audits.get_diffs(df).collect()] == [["- a"], ["- "], [], []]
