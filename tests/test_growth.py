"""Shapes of plans and intermediate rows that decide what a job takes on large tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from huntspark.operators import context, entities, facets, ioc, rules
from huntspark.plans import joins

from conftest import rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_suppression_never_broadcasts_the_values_of_alerts(spark, tmp_path):
    """A small file of alerts: their exploded values are far more than its size says."""
    listed = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.concat(F.lit("userName:u"), (F.col("id") % 50 + k).cast("string")))
    spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("title"), F.lit("d").alias("creator"), listed.alias("entities")).coalesce(1).write.parquet(str(tmp_path / "alerts"))
    alerts = spark.read.parquet(str(tmp_path / "alerts"))
    table = spark.createDataFrame([([("alert_title", "t", False), ("entity", "^userName:u7$", False)],)], "filters array<struct<key: string, pattern: string, inverted: boolean>>")
    hit = rules.matching_alerts(alerts, table, title="title", detector="creator", entities="entities")
    assert "BuildLeft" not in plan_of(hit) and "BuildRight" in plan_of(hit)
    assert hit.count() == sum(1 for k in range(5000) if k % 50 <= 7 <= k % 50 + 4)


def test_measured_join_broadcasts_a_small_side_only(spark, monkeypatch):
    many = spark.range(300).select((F.col("id") % 7).alias("k"), F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))
    few = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "fk long, v string")
    want = rows(many.join(few, F.col("k") == F.col("fk")))
    small = joins.measured_join(many, few, [("k", "fk")], [])
    assert rows(small) == want and "BuildRight" in plan_of(small) and "BuildLeft" not in plan_of(small)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1)
    large = joins.measured_join(many, few, [("k", "fk")], joins.hot_keys(many, ["k"], 10))
    assert rows(large) == want and "Broadcast" not in plan_of(large)


def test_related_events_of_sets_of_three(spark):
    """Events with up to three terms, entities with many terms of one field and few of others: each event once per entity."""
    rng = __import__("random").Random(3)
    some = lambda kind, n: rng.choice([None, *[f"{kind}{k}" for k in range(n)]])
    seen = [(some("u", 9), some("i", 3), some("u", 9), rng.choice(["x", "y", None])) for _ in range(400)]
    events = spark.createDataFrame(seen, "u string, ip string, other string, kind string")
    wide = [("@ip", "i0", "@user", f"u{k}") for k in range(9)] + [("@ip", "i0", "@ip", "i0")]
    more = [("@user", f"u{e}", "@user" if t[0] == "u" else "@ip", t) for e in range(6) for t in {f"u{e}", f"u{rng.randrange(9)}", f"i{rng.randrange(3)}"}]
    terms = spark.createDataFrame(wide + more + wide[:2] + [("@user", "gone", "@user", "nobody"), ("@user", "u1", None, "i1")], "entity_field string, entity_value string, field string, value string")
    want = {}
    for entity in {t[:2] for t in wide + more}:
        held = {t[2:] for t in wide + more if t[:2] == entity}
        for u, ip, other, kind in seen:
            if held & {("@user", u), ("@user", other), ("@ip", ip)}:
                want[*entity, kind] = want.get((*entity, kind), 0) + 1
    got = context.context_related_events(events, terms, {"@user": ["u", "other"], "@ip": ["ip"]}, ["kind"])
    assert rows(got) == sorted(((*k, n) for k, n in want.items()), key=repr)


def test_shared_pairs_come_from_the_side_with_fewer(spark):
    """An address with 200 users: its pairs are those of the address, not the 50 of each of the users."""
    pairs = spark.range(200 * 50).selectExpr("struct('@ip' as field, 'i'||(id % 50) as value) as one", "struct('@user' as field, 'u'||(id div 50) as value) as two")
    users = spark.range(200).selectExpr("struct('@ip' as entity_field, 'i7' as entity_value) as entity", "struct('@user' as field, 'u'||id as value) as term")
    own = spark.range(1).selectExpr("struct('@ip' as entity_field, 'i7' as entity_value) as entity", "struct('@ip' as field, 'i7' as value) as term")
    assert context.shared_pairs(users.unionByName(own), pairs).count() == 200


def test_contexts_give_rows_without_a_shuffle_of_them(spark):
    alerts = spark.range(60).selectExpr(
        "'a'||id as id", "'CLOSED' as status", "cast(null as string) as resolution_reason", "'t'||(id % 3) as `metadata.title`",
        "array('userName:u'||(id % 5), 'sourceIpAddress:i'||(id % 4)) as `entities.entities`")
    terms = context.related_terms(context.seeds(entities.normalize_entities(alerts)), entities.relate_entities(alerts))
    found = context.context_resolved(alerts, terms)
    top = plan_of(found).split("Join")[0]
    assert "Exchange" not in top and "Aggregate" not in top
    assert found.count() == found.distinct().count() > 0


def test_row_publications_of_copies_are_not_aggregated(spark):
    """Copies of few texts: each pair once, out of the last join; ids that repeat or are null are one row each."""
    held = [(k % 90 if k else None, ["a", "b"] if k % 3 else ["b", "zz", None]) for k in range(100)]
    named = [("a" if k % 2 else "b", k % 40 if k else None) for k in range(60)] + [("b", 1), (None, 2)]
    df = spark.createDataFrame(held, "id int, `logicals.domain` array<string>")
    pubs = spark.createDataFrame(named, "indicator string, publication_id int")
    of_row, of_pub, want = {}, {}, []
    for k, values in held:
        of_row.setdefault(k, set()).update(v for v in values if v)
    for v, p in named:
        of_pub.setdefault(p, set()).update([v] if v else [])
    want = [(k, p, len(a & b)) for k, a in of_row.items() for p, b in of_pub.items() if a & b]
    got = ioc.row_publications(df, pubs, "id")
    assert "Aggregate" not in plan_of(got).split("Join")[0]
    assert rows(got) == sorted(want, key=repr)


def test_facets_are_counted_by_values_without_names(spark, monkeypatch):
    written = []
    monkeypatch.setattr(facets, "cut", lambda df: written.append(df.schema) or df)
    df = spark.createDataFrame([("zzz", "r1", None), ("zzz", "r2", None), ("http", "r3", "1.1.1.1"), ("zzz", "r1", None)], "schema string, resource_id string, source_address string")
    got = facets.facets_by_schema(df, F.col("schema"))
    assert rows(got) == [("http", "source_address=1.1.1.1", 1), ("zzz", "schema=zzz|resource_id=r1", 2), ("zzz", "schema=zzz|resource_id=r2", 1)]
    assert written[0]["held"].dataType.simpleString() == "array<string>"


def shuffled(plan) -> int:
    """Rows that the exchanges of a plan that has run wrote."""
    name = plan.getClass().getSimpleName()
    inside = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else [plan.children().apply(k) for k in range(plan.children().size())]
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
    return own + sum(map(shuffled, inside))


def hubs(spark, status: str):
    """60 users of 4 addresses, each user with each address in an alert of its own."""
    return spark.range(240).selectExpr(
        "'a'||id as id", f"'{status}' as status", "cast(null as string) as resolution_reason", "'t'||(id % 3) as `metadata.title`",
        "cast(null as string) as investigation_id" if status == "OPEN" else "'i'||(id % 5) as investigation_id",
        "array('userName:u'||(id div 4), 'sourceIpAddress:i'||(id % 4)) as `entities.entities`")


@pytest.mark.parametrize("kind", ["investigations", "resolved", "open"])
def test_contexts_shuffle_fewer_rows_than_they_give(spark, kind):
    """Each address is a term of 61 entities: neither their rows nor the numbers of their sets are dealt out one by one."""
    alerts = hubs(spark, "OPEN" if kind == "open" else "CLOSED")
    seed = context.seeds(entities.normalize_entities(alerts))
    terms = context.related_terms(seed, entities.relate_entities(alerts))
    found = {
        "investigations": lambda: context.context_investigations(alerts, terms),
        "resolved": lambda: context.context_resolved(alerts, terms),
        "open": lambda: context.context_open_alerts(alerts, seed, terms),
    }[kind]()
    got = rows(found)
    assert len(got) == len(set(got)) > 9000
    assert shuffled(found._jdf.queryExecution().executedPlan()) < len(got)


@pytest.mark.parametrize("block", [2, 4096])
def test_contexts_by_blocks_against_brute_force(spark, monkeypatch, block):
    """Sets of up to four terms that entities have several of, terms that come twice, entities without a field, titles and seeds that
    come twice or are null: with lists and groups cut into blocks, and in one."""
    monkeypatch.setattr(context, "BLOCK", block)
    monkeypatch.setattr(context, "TASK_ROWS", 50 if block == 2 else 4_000_000)
    rng = __import__("random").Random(5)
    kinds = {"userName": "@user", "sourceIpAddress": "@ip", "hostName": "@host"}
    listed = [[f"{k}:{k[0]}{rng.randrange(n)}" for k, n in [("userName", 9), ("sourceIpAddress", 3), ("sourceIpAddress", 3), ("hostName", 4)] if rng.random() < 0.8] for _ in range(150)]
    data = [(f"a{k}", rng.choice(["OPEN", "CLOSED", None]), "r", rng.choice(["x", "y", None]), rng.choice([None, "i1"]), e) for k, e in enumerate(listed)]
    alerts = spark.createDataFrame(data, "id string, status string, resolution_reason string, `metadata.title` string, investigation_id string, `entities.entities` array<string>")
    pool = sorted({(kinds[t.split(":")[0]], t.split(":")[1]) for e in listed for t in e})
    asked = {(rng.choice(["@user", None]), f"e{k}"): rng.sample(pool, rng.randrange(1, 9)) for k in range(12)} | {("@ip", "every"): pool, ("@ip", None): pool[:3]}
    flat = [(*e, *t) for e, ts in asked.items() for t in [*ts, *ts[:1]]] + [("@ip", "every", None, "s0"), ("@ip", "gone", "@ip", "nothing")]
    terms = spark.createDataFrame(flat, "entity_field string, entity_value string, field string, value string")
    own = [("@ip", "every", "x"), ("@ip", "every", "x"), ("@ip", "every", "z"), *[(f, v, rng.choice(["x", "y", None])) for f, v in asked if v not in ("every", "e3")]]
    seed = spark.createDataFrame(own, "entity_field string, entity_value string, title string")

    def brute(keep, key):
        counts = {}
        for entity, ts in asked.items():
            for a in data:
                if keep(a) and {(kinds[t.split(":")[0]], t.split(":")[1]) for t in a[5]} & set(ts):
                    k = (*entity, ",".join(sorted(a[5])), *key(a))
                    counts[k] = counts.get(k, 0) + 1
        return [(*k, n) for k, n in counts.items()]

    want = brute(lambda a: a[1] == "CLOSED", lambda a: (a[3], a[1], a[2]))
    assert rows(context.context_resolved(alerts, terms)) == sorted(want, key=repr)
    want = brute(lambda a: a[4], lambda a: (a[3], a[4], a[1]))
    assert rows(context.context_investigations(alerts, terms)) == sorted(want, key=repr)
    free = brute(lambda a: a[1] == "OPEN" and not a[4], lambda a: (a[3],))
    want = [r for r in free for s in own if r[1] is not None and s[1] == r[1] and None not in (s[2], r[3]) and s[2] != r[3]]
    assert rows(context.context_open_alerts(alerts, seed, terms)) == sorted(want, key=repr)
