"""Audit, rule, publication, investigation and network queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.registry import Inputs, query
from huntspark.functions.names import q
from huntspark.functions.severity import investigation_priority, rule_severity
from huntspark.operators import audits as audit
from huntspark.operators import inflate, networks
from huntspark.sources import scans


def audits(i: Inputs) -> DataFrame:
    return i("f_audits").withColumnsRenamed(
        {
            "before_status": "before_state.status", "after_status": "after_state.status",
            "before_priority": "before_state.priority", "after_priority": "after_state.priority",
        }
    )


@query(
    "f_audits",
    """select audit_id from f_audits where application = 'billing' and event_time >= timestamp '1996-01-01 00:00:00'
    and event_time <= timestamp '1999-01-01 00:00:00' and (contains(after_priority, 'HIGH') or contains(before_priority, 'HIGH'))""",
)
def audit_search(i: Inputs) -> DataFrame:
    found = scans.search_audits(
        i("f_audits"), search_by_all="HIGH", application="billing", after="1996-01-01T00:00:00Z",
        before="1999-01-01T00:00:00Z", sort_by="event_time", limit=None,
    )
    return found.select("audit_id")


@query("f_audits", "select distinct event_name from f_audits where application = 'billing'")
def audit_event_names(i: Inputs) -> DataFrame:
    return scans.audit_event_names(i("f_audits"), "billing")


@query(
    "f_audits",
    """select audit_id, case when coalesce(before_status, '') = after_status then ''
        else concat_ws(',', case when before_status is not null then '- '||before_status end, '+ '||after_status) end as status_diff,
      case when before_priority = after_priority then '' else '- '||before_priority||',+ '||after_priority end as priority_diff
    from f_audits""",
)
def audit_diffs(i: Inputs) -> DataFrame:
    return audit.get_diffs(audits(i)).select(
        "audit_id",
        F.array_join("x_diff_status", ",").alias("status_diff"),
        F.array_join("x_diff_priority", ",").alias("priority_diff"),
    )


@query(
    "f_audits",
    """select audit_id, concat_ws(',', case when before_priority is distinct from after_priority then 'priority' end,
      case when before_status is distinct from after_status then 'status' end) as changed from f_audits""",
)
def audit_changed_fields(i: Inputs) -> DataFrame:
    return audit.changed_fields(audits(i)).select("audit_id", F.array_join("x_changed_fields", ",").alias("changed"))


@query("f_rules", "select rule_id from f_rules where kind = 'Brand#7' and event_type = 'PROMO' and not deleted")
def rules_filter(i: Inputs) -> DataFrame:
    return scans.rules_filter(i("f_rules"), kind="Brand#7", event_type="PROMO").select("rule_id")


@query("f_rules", "select rule_id from f_rules where deleted")
def rules_deleted(i: Inputs) -> DataFrame:
    return scans.rules_filter(i("f_rules"), deleted=True).select("rule_id")


@query("f_rules", "select rule_id from f_rules where updated_at >= timestamp '2024-02-01 00:00:00' and event_type = 'PROMO'")
def rules_changes_since(i: Inputs) -> DataFrame:
    return scans.rules_changes_since(i("f_rules"), "2024-02-01T00:00:00Z", "PROMO").select("rule_id")


@query("f_rules", "select rule_id, name from f_rules where contains(name, 'ring')")
def rule_search(i: Inputs) -> DataFrame:
    return scans.rule_search(i("f_rules"), "ring").select("rule_id", "name")


@query(
    "f_rules",
    """select rule_id, 'alert_title' as key, title_pattern as pattern, if(title_inverted, 'true', 'false') as inverted
    from f_rules where rule_id % 4 > 0
    union all select rule_id, 'entity', entity_pattern, 'false' from f_rules where rule_id % 4 > 0
    union all select rule_id, null, null, '' from f_rules where rule_id % 4 = 0""",
)
def inflate_filters(i: Inputs) -> DataFrame:
    nested = i("f_rules").selectExpr(
        "rule_id",
        """if(rule_id % 4 > 0, array(struct('alert_title' as key, title_pattern as pattern, title_inverted as inverted),
             struct('entity' as key, entity_pattern as pattern, false as inverted)), null) as filters""",
    )
    return inflate.inflate_filters(nested).select(
        "rule_id",
        q("filters.key").alias("key"),
        q("filters.pattern").alias("pattern"),
        F.coalesce(q("filters.inverted").cast("string"), F.lit("")).alias("inverted"),
    )


@query(
    "f_rules",
    """select rule_id, case rule_id % 4 when 0 then 0.2 when 1 then 0.4 when 2 then 0.6 else 0.8 end::double as score,
      case rule_id % 4 when 0 then 1 when 1 then 2 when 2 then 3 else 4 end as rank from f_rules""",
)
def severity_maps(i: Inputs) -> DataFrame:
    names = i("f_rules").selectExpr(
        "rule_id", "case rule_id % 4 when 0 then 'low' when 1 then 'medium' when 2 then 'high' else 'critical' end as level"
    )
    return names.select("rule_id", rule_severity(q("level")).alias("score"), investigation_priority(q("level")).alias("rank"))


@query(sql="select doc_id as id, n_chars as published from documents order by n_chars desc, doc_id limit 25")
def latest_publications(i: Inputs) -> DataFrame:
    pubs = i.table("documents").selectExpr("doc_id as id", "n_chars as published")
    return scans.latest_publications(pubs, 25)


@query(sql="select doc_id from documents where contains(lower(text), 'license')")
def publications_by_term(i: Inputs) -> DataFrame:
    pubs = i.table("documents").selectExpr("doc_id", "text as content")
    return scans.publications_by_term(pubs, "License").select("doc_id")


@query("f_investigations", "select id, title from f_investigations where status = 'OPEN' and not archived")
def investigation_search(i: Inputs) -> DataFrame:
    return scans.search_investigations(i("f_investigations"), [q("status") == "OPEN", ~q("archived")]).select("id", "title")


@query(
    sql="""select conv_id, turn as example_turn, text as example_text, role as name from conversations
    union all select conv_id, -1, '', role from conversations where turn = 0""",
)
def inflate_prompts(i: Inputs) -> DataFrame:
    nested = i.table("conversations").selectExpr(
        "conv_id",
        "role as name",
        """if(turn = 0, array(struct(turn, text), struct(-1L as turn, '' as text)), array(struct(turn, text))) as prompts""",
    )
    return inflate.inflate_prompt_examples(nested).select(
        "conv_id", q("example.turn").alias("example_turn"), q("example.text").alias("example_text"), "name"
    )


@query(
    "f_networks f_network_upload",
    """select u.cidr, description, network_type, coalesce(k.id, -1) as id, case when k.id is null then 'create' else 'update' end as action
    from f_network_upload u left join (select cidr, min(id) as id from f_networks group by 1) k using (cidr)
    where network_type = 'Internal'""",
)
def upsert_classify(i: Inputs) -> DataFrame:
    out = networks.upsert_classify(i("f_networks"), i("f_network_upload"), ["Internal"])
    return out.withColumn("id", F.coalesce("id", F.lit(-1)))


@query(
    "f_networks f_network_upload",
    """with up as (select u.cidr, u.description, u.network_type, k.id from f_network_upload u left join f_networks k using (cidr)
      where u.network_type = 'Internal')
    select cidr, coalesce(id, -1) as id, description, network_type from up
    union all select cidr, id, description, network_type from f_networks where id not in (select id from up where id is not null)""",
)
def upsert_merge(i: Inputs) -> DataFrame:
    merged = networks.upsert_merge(i("f_networks"), i("f_network_upload"), ["Internal"])
    return merged.withColumn("id", F.coalesce("id", F.lit(-1)))
