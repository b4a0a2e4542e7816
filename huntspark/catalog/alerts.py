"""Alert queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.registry import Inputs, query
from huntspark.functions import indicators as ind
from huntspark.functions.names import (
    coalesce_columns,
    drop_duplicates_by_hashables,
    flatten_struct,
    get_tenant_id,
    json_columns,
    q,
)
from huntspark.functions.severity import severity_rounded_and_category
from huntspark.functions.times import convert_alert_timestamps, day_bounds, time_range
from huntspark.operators import alerts as op
from huntspark.operators.inflate import inflate_raw_events, inflate_third_party_details, publication_reference, third_party_keys as count_keys
from huntspark.operators.rules import apply_suppression as suppress
from huntspark.operators.tenants import merge_tenants as merge_tenant_rows
from huntspark.plans.numbering import first_per_key as first_rows
from huntspark.sources import scans
from huntspark.sources.sinks import append


def nested_alerts(i: Inputs) -> DataFrame:
    """Alerts as the search returns them: nested metadata, entity list, attached events."""
    event = (
        "struct('event://priv:scope.process:'||cast(event_id as string)||'{n}' as resource_id, "
        "'h'||cast(event_id % 150 as string) as host_id)"
    )
    return i("f_alerts").selectExpr(
        "id", "tenant_id", "status", "resolution_reason", "investigation_id",
        """struct(title, severity, struct(created_at_seconds as seconds) as created_at,
             struct(case when status <> 'OPEN' then created_at_seconds + 60 end as seconds) as resolved_at,
             struct(struct(creator as detector_id) as detector) as creator) as metadata""",
        "struct(array(entity1, entity2, entity3) as entities) as entities",
        f"""case event_id % 3 when 0 then cast(array() as array<struct<resource_id string, host_id string>>)
             when 1 then array({event.format(n='')}) else array({event.format(n='')}, {event.format(n='b')}) end
             as event_ids""",
    )


ATTACHED = """
attached as (
  select id, 'event://priv:scope.process:'||event_id as resource_id, 'h'||(event_id % 150) as host_id
  from f_alerts where event_id % 3 > 0
  union all
  select id, 'event://priv:scope.process:'||event_id||'b', 'h'||(event_id % 150) from f_alerts where event_id % 3 = 2
  union all
  select id, null, null from f_alerts where event_id % 3 = 0)"""

CATEGORY = """case when s >= 0.8 then 'Critical' when s >= 0.6 then 'High' when s >= 0.4 then 'Medium'
  when s >= 0.2 then 'Low' else 'Informational' end"""

NAMED = "(select creator_name, arg_min(display_name, ord) as display_name from f_detectors group by 1)"


@query(
    "f_alerts f_detectors",
    f"""with {ATTACHED.strip()}, rounded as (select *, round_even(severity*100, 0)/100 as s from f_alerts)
    select strftime(make_timestamp(created_at_seconds*1000000), '%Y-%m-%dT%H:%M:%SZ') as created_at,
      coalesce(d.display_name, creator) as creator, title, status, {CATEGORY} as severity_category,
      t.resource_id, count(*) as count
    from rounded r join attached t on r.id = t.id left join {NAMED} d on d.creator_name = r.creator
    where t.resource_id is not null group by all""",
)
def triage_value_counts(i: Inputs) -> DataFrame:
    return op.triage(nested_alerts(i), i("f_detectors")).select(
        q("x_metadata_created_at_seconds").alias("created_at"),
        q("x_creator_display_name").alias("creator"),
        q("metadata.title").alias("title"),
        "status",
        q("x_severity_category").alias("severity_category"),
        q("event_data.resource_id").alias("resource_id"),
        "count",
    )


@query(
    "f_alerts",
    """select id, tenant_id, title, status from f_alerts
    where status = 'OPEN' and severity >= 0.02 and created_at_seconds between 1704412800 and 1706140800""",
)
def search_alerts(i: Inputs) -> DataFrame:
    found = scans.search_alerts(
        flatten_struct(nested_alerts(i)),
        where=[q("status") == "OPEN", q("metadata.severity") >= 0.02],
        earliest="2024-01-05T00:00:00Z",
        latest="2024-01-25T00:00:00Z",
        limit=None,
    )
    return found.select("id", "tenant_id", q("metadata.title").alias("title"), "status")


@query(
    "f_alerts",
    """select title, status, count(*) as count from f_alerts
    where created_at_seconds >= 1704412800 and tenant_id in ('1', '2', '3') group by all""",
)
def search_alerts_aggregate(i: Inputs) -> DataFrame:
    return scans.search_alerts(
        i("f_alerts"),
        earliest="2024-01-05T00:00:00Z",
        time_column="created_at_seconds",
        tenants=["1", "2", "3"],
        aggregate=["title", "status"],
    )


@query(
    sql="""select event_id, event_type from events
    where ts >= timestamp '2024-01-13 00:00:00' and ts <= timestamp '2024-01-19 12:00:00'""",
    name="time_range",
)
def time_range_relative(i: Inputs) -> DataFrame:
    now = datetime(2024, 1, 20, tzinfo=timezone.utc)
    return time_range(i.table("events"), "ts", "-7d", "-12h", now).select("event_id", "event_type")


@query(
    "f_alerts",
    """select id from f_alerts where title in ('click', 'view') and status <> 'OPEN'
    and (contains(entity2, '10.0.0.1') or contains(entity2, '10.0.0.2')) and not contains(creator, 'app:d1')
    and (severity >= 0.5 or severity >= 0.01) and severity > 0.001 and severity > 0.002""",
)
def list_predicates(i: Inputs) -> DataFrame:
    df = i("f_alerts")
    return df.where(
        ind.one_of(q("title"), ["click", "view"])
        & ind.none_of(q("status"), ["OPEN"])
        & ind.matches_regex(q("entity2"), ["10.0.0.1", "10.0.0.2"])
        & ind.not_matches_regex(q("creator"), ["app:d1"])
        & ind.any_compare(q("severity"), [0.5, 0.01], ">=")
        & ind.all_compare(q("severity"), [0.001, 0.002], ">")
    ).select("id")


@query("f_alerts", "select title, status, tenant_id, count(*) as count from f_alerts group by all")
def aggregate_count(i: Inputs) -> DataFrame:
    return op.aggregate_count(i("f_alerts"), ["title", "status", "tenant_id"])


@query("f_alerts", "select title, investigation_id, count(*) as count from f_alerts group by all")
def groupby_counts(i: Inputs) -> DataFrame:
    return op.groupby(i("f_alerts"), ["title", "investigation_id", "not_there"])


@query(
    "f_alerts",
    "select title, investigation_id, count(*) as count from f_alerts where investigation_id is not null group by all",
)
def facet(i: Inputs) -> DataFrame:
    return op.get_facet(i("f_alerts"), ["title", "investigation_id", "not_there"])


@query(
    "f_alerts",
    f"""select id, s as x_severity, {CATEGORY} as x_severity_category
    from (select id, round_even(severity*100, 0)/100 as s from f_alerts)""",
)
def severity_category(i: Inputs) -> DataFrame:
    return severity_rounded_and_category(i("f_alerts")).select("id", "x_severity", "x_severity_category")


@query(
    "f_alerts",
    """select id, strftime(make_timestamp(created_at_seconds*1000000), '%Y-%m-%dT%H:%M:%SZ') as created,
      case when status = 'OPEN' then 'N/A'
        else strftime(make_timestamp((created_at_seconds+60)*1000000), '%Y-%m-%dT%H:%M:%SZ') end as resolved
    from f_alerts""",
)
def alert_timestamps(i: Inputs) -> DataFrame:
    return convert_alert_timestamps(flatten_struct(nested_alerts(i))).select(
        "id",
        q("x_metadata_created_at_seconds").alias("created"),
        q("x_metadata_resolved_at_seconds").alias("resolved"),
    )


@query(
    "f_alerts f_detectors",
    f"""select id, coalesce(d.display_name, creator) as x_creator_display_name
    from f_alerts left join {NAMED} d on d.creator_name = creator""",
)
def creator_name(i: Inputs) -> DataFrame:
    return op.normalize_creator_name(i("f_alerts"), i("f_detectors")).select("id", "x_creator_display_name")


@query(
    "f_alerts",
    """with groups as (select title, tenant_id, investigation_id from f_alerts
      where status = 'OPEN' group by all having count(*) >= 2)
    select id from f_alerts a where severity >= 0.01 and exists (select 1 from groups g
      where g.title = a.title and g.tenant_id = a.tenant_id and g.investigation_id = a.investigation_id)""",
)
def alerts_from_aggregation(i: Inputs) -> DataFrame:
    alerts = i("f_alerts")
    groups = op.aggregate_count(alerts.where("status = 'OPEN'"), ["title", "tenant_id", "investigation_id"])
    return op.get_alerts_from_aggregation(groups.where("count >= 2"), alerts, [q("severity") >= 0.01]).select("id")


@query(
    "f_alerts",
    """select tenant_id, id as alert_id,
      cast((row_number() over (partition by tenant_id order by md5(id), id) - 1) // 250 as bigint) as batch,
      'FALSE_POSITIVE' as resolution_status, 'noise' as reason
    from f_alerts where status = 'OPEN'""",
)
def resolution_batches(i: Inputs) -> DataFrame:
    return op.resolution_batches(i("f_alerts").where("status = 'OPEN'"), "FALSE_POSITIVE", "noise")


@query(
    "f_alerts",
    """select id, case when title = 'error' then 'TRUE_POSITIVE' else status end as status,
      case when title = 'error' then 'outage' else resolution_reason end as resolution_reason from f_alerts""",
)
def apply_resolution(i: Inputs) -> DataFrame:
    alerts = i("f_alerts")
    done = op.apply_resolution(alerts, alerts.where("title = 'error'"), "TRUE_POSITIVE", "outage")
    return done.select("id", "status", "resolution_reason")


@query("f_alerts", "select id, coalesce(investigation_id, resolution_reason, title) as value from f_alerts", name="coalesce_columns")
def coalesce_first(i: Inputs) -> DataFrame:
    df = i("f_alerts")
    return df.select("id", coalesce_columns(df, ["nope", "investigation_id", "resolution_reason", "title"]).alias("value"))


@query("f_alerts", "select id, tenant_id as from_text, tenant_id as from_list, cast(user_id as string) as from_number from f_alerts")
def tenant_id_clean(i: Inputs) -> DataFrame:
    df = i("f_alerts").selectExpr(
        "id", """'["'||tenant_id||"']" as text""", "array(tenant_id, 'other') as list", "user_id as number"
    )
    return df.select(
        "id",
        get_tenant_id(df, "text").alias("from_text"),
        get_tenant_id(df, "list").alias("from_list"),
        get_tenant_id(df, "number").alias("from_number"),
    )


@query(
    sql="""select doc_id, 'https://portal.example/publications?id='||source||'/%20~%2A%2B'||doc_id as x_reference
    from documents""",
)
def publication_link(i: Inputs) -> DataFrame:
    pubs = i.table("documents").selectExpr("doc_id", "source||'/ ~*+'||doc_id as id")
    return publication_reference(pubs, "https://portal.example/publications?id=").select("doc_id", "x_reference")


@query(
    "f_alerts",
    """select id, title, null as priority from f_alerts union all
    select 'o'||o_orderkey, null, o_orderpriority from orders""",
)
def append_results(i: Inputs) -> DataFrame:
    orders = i.table("orders").selectExpr("'o'||o_orderkey as id", "o_orderpriority as priority")
    return append(i("f_alerts").select("id", "title"), orders)


@query(
    "f_alerts f_tenants",
    """select id, tenant_id as _macro_tenant_id from f_alerts
    where tenant_id in (select id from f_tenants where service = 'BUILDING')""",
)
def merge_tenants(i: Inputs) -> DataFrame:
    tenants = i("f_tenants").where("service = 'BUILDING'")
    return merge_tenant_rows(i("f_alerts"), tenants).select("id", "_macro_tenant_id")


@query(
    "f_alerts",
    """select tenant_id, title, id, status from f_alerts
    qualify row_number() over (partition by tenant_id, title order by created_at_seconds, id) = 1""",
)
def first_per_key(i: Inputs) -> DataFrame:
    rows = i("f_alerts").select("tenant_id", "title", "id", "status", "created_at_seconds")
    return first_rows(rows, ["tenant_id", "title"], ["created_at_seconds", "id"]).drop("created_at_seconds")


@query("f_alerts", "select distinct tenant_id, title, status from f_alerts")
def dedup_scalars(i: Inputs) -> DataFrame:
    rows = i("f_alerts").selectExpr("tenant_id", "title", "status", "array(entity1, entity2) as entities")
    return drop_duplicates_by_hashables(rows).drop("entities")


@query(
    "f_alerts",
    f"with {ATTACHED.strip()} select id, resource_id as event_resource_id, host_id as event_host_id from attached",
    name="inflate_raw_events",
)
def inflate_events(i: Inputs) -> DataFrame:
    return inflate_raw_events(nested_alerts(i)).select(
        "id", q("event_data.resource_id").alias("event_resource_id"), q("event_data.host_id").alias("event_host_id")
    )


@query(
    "f_alerts",
    """select id, title as kind, case when event_id % 2 = 0 then tenant_id else creator end as owner,
      case when event_id % 2 = 0 then status end as state from f_alerts""",
)
def third_party_details(i: Inputs) -> DataFrame:
    pair = "struct('{}' as key, {} as value)".format
    record = "struct(struct(array({}) as record) as generic) as generic".format
    some = record(", ".join([pair("kind", "title"), pair("owner", "creator")]))
    more = record(", ".join([pair("owner", "tenant_id"), pair("state", "status")]))
    df = i("f_alerts").selectExpr(
        "id", f"if(event_id % 2 = 0, array(struct({some}), struct({more})), array(struct({some}))) as third_party_details"
    )
    held = q("third_party_details.map")
    return inflate_third_party_details(df).select("id", *[held[k].alias(k) for k in ("kind", "owner", "state")])


@query(
    "f_alerts",
    """select 'kind' as key, count(*) as rows from f_alerts union all select 'owner', count(*) from f_alerts
    union all select 'state', count(*) from f_alerts where event_id % 2 = 0 union all select 'u'||user_id, count(*) from f_alerts group by user_id""",
)
def third_party_keys(i: Inputs) -> DataFrame:
    """As many keys as there are users, and some that all or half of the alerts have."""
    record = "struct(struct(array({}) as record) as generic) as generic".format
    pair = "struct({} as key, title as value)".format
    some, more = record(", ".join(map(pair, ["'kind'", "'owner'", "'u'||user_id"]))), record(", ".join(map(pair, ["'owner'", "'state'"])))
    df = i("f_alerts").selectExpr(f"if(event_id % 2 = 0, array(struct({some}), struct({more})), array(struct({some}))) as third_party_details")
    return count_keys(df)


@query("f_alerts", "select id, title, severity, creator as detector_id from f_alerts")
def flatten_alerts(i: Inputs) -> DataFrame:
    return flatten_struct(nested_alerts(i)).select(
        "id",
        q("metadata.title").alias("title"),
        q("metadata.severity").alias("severity"),
        q("metadata.creator.detector.detector_id").alias("detector_id"),
    )


@query("f_alerts", """select id, '["'||entity1||'","'||entity2||'"]' as entities from f_alerts""")
def json_display(i: Inputs) -> DataFrame:
    return json_columns(i("f_alerts").selectExpr("id", "array(entity1, entity2) as entities"))


@query(
    "f_alerts f_rules",
    r"""with matched as (
      select distinct a.id, r.rule_id from f_alerts a join f_rules r on (a.entity1 = replace(replace(r.entity_pattern, '^', ''), '$', '')
        or a.entity2 = replace(replace(replace(r.entity_pattern, '^', ''), '$', ''), '[.]', '.'))
      where (case r.title_pattern when '^(click|view)$' then a.title in ('click', 'view') when '^error$' then a.title = 'error'
        when 'sign.p' then a.title = 'signup' when '^purchase$' then a.title = 'purchase' else contains(a.title, 'a') end)
        <> r.title_inverted)
    select id from f_alerts where id not in (select id from matched)""",
)
def apply_suppression(i: Inputs) -> DataFrame:
    rules = i("f_rules").selectExpr(
        """array(struct('alert_title' as key, title_pattern as pattern, title_inverted as inverted),
             struct('entity' as key, entity_pattern as pattern, false as inverted)) as filters"""
    )
    alerts = i("f_alerts").selectExpr("id", "title", "creator", "array(entity1, entity2, entity3) as entities")
    return suppress(alerts, rules, title="title", detector="creator", entities="entities").select("id")


@query(
    "f_alerts f_rules",
    """select id from f_alerts a where (contains(title, 'i') or contains(creator, 'd1')) and (contains(title, 'r') or contains(creator, 'd2'))
      and not exists (select 1 from f_rules r where a.creator = 'app:d'||(r.rule_id % 7) and starts_with(a.entity3, 'fileName:f'||(r.rule_id % 5)))""",
)
def apply_suppression_by_detector(i: Inputs) -> DataFrame:
    """Rules that name detectors, and rules all of whose filters are inverted."""
    rules = i("f_rules").selectExpr(
        """explode(array(
             array(struct('alert_title' as key, if(rule_id % 2 = 0, '[i]', 'r[^z]?') as pattern, true as inverted),
               struct('detector' as key, if(rule_id % 2 = 0, 'd1', 'd2') as pattern, true as inverted)),
             array(struct('detector' as key, '^app:d'||(rule_id % 7)||'$' as pattern, false as inverted),
               struct('entity' as key, '^fileName:f'||(rule_id % 5) as pattern, false as inverted)))) as filters"""
    )
    alerts = i("f_alerts").selectExpr("id", "title", "creator", "array(entity1, entity2, entity3) as entities")
    return suppress(alerts, rules, title="title", detector="creator", entities="entities").select("id")


@query(
    "f_alerts",
    """select id, epoch_us(d)//1000000 as first_second, epoch_us(d)//1000000 + 86399 as last_second
    from (select id, date_trunc('day', make_timestamp(created_at_seconds*1000000)) as d from f_alerts)""",
    name="day_bounds",
)
def day_window(i: Inputs) -> DataFrame:
    day = F.date_format(F.timestamp_seconds("created_at_seconds"), "yyyyMMdd")
    first, last = day_bounds(day)
    return i("f_alerts").select(
        "id", F.unix_seconds(first).alias("first_second"), F.unix_seconds(last).alias("last_second")
    )


@query(
    "f_alerts",
    "select tenant_id, status, count(*) as results_returned, cast(-1 as bigint) as total_results from f_alerts group by all",
)
def result_totals(i: Inputs) -> DataFrame:
    return scans.result_totals(i("f_alerts"), ["tenant_id", "status"])


@query("f_alerts", "select id, status, created_at_seconds from f_alerts where id = 'a77'")
def alert_history(i: Inputs) -> DataFrame:
    history = i("f_alerts").withColumn("alert_id", q("id"))
    return scans.alert_history(history, "a77").select("id", "status", "created_at_seconds")



@query("f_alerts", "select id, title from f_alerts order by md5(id||':7'), id limit 200")
def row_sample(i: Inputs) -> DataFrame:
    return scans.repeatable_sample(i("f_alerts"), 200, "id", seed=7).select("id", "title")


@query("f_alerts", "select id, title from f_alerts where regexp_matches(title, '^(cl|vi)')")
def regex_filter(i: Inputs) -> DataFrame:
    return ind.regex_filter(i("f_alerts"), "title", "^(cl|vi)").select("id", "title")
