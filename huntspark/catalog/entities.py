"""Entity and context queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.alerts import nested_alerts
from huntspark.catalog.registry import Inputs, query
from huntspark.functions.names import flatten_struct, q
from huntspark.operators import context, entities

ENTITY = """
entity as (select id, '@user' as field, substr(entity1, 10) as value, title, status, investigation_id, resolution_reason,
    entity3||','||entity2||','||entity1 as entities from f_alerts
  union all select id, '@ip', substr(entity2, 17), title, status, investigation_id, resolution_reason,
    entity3||','||entity2||','||entity1 from f_alerts)"""
SEED = """seed as (select value, field, title from entity
  qualify row_number() over (partition by value order by id, field, title) = 1)"""


def flat(i: Inputs) -> DataFrame:
    return flatten_struct(nested_alerts(i))


def seeds(i: Inputs) -> DataFrame:
    return context.seeds(entities.normalize_entities(flat(i), unique_ids=True))


@query("f_alerts", f"with {ENTITY.strip()} select id, field, value from entity")
def normalize_entities(i: Inputs) -> DataFrame:
    return entities.normalize_entities(flat(i), unique_ids=True).select(
        "id", q(entities.FIELD).alias("field"), q(entities.VALUE).alias("value")
    )


@query(
    "f_alerts",
    f"""with {ENTITY.strip()} select distinct a.value, b.field as related_field, b.value as related_value
    from entity a join entity b on a.id = b.id and a.value <> b.value""",
)
def relate_entities(i: Inputs) -> DataFrame:
    return entities.relate_entities(flat(i))


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}, rel as (select distinct a.value, b.field as rf, b.value as rv
      from entity a join entity b on a.id = b.id and a.value <> b.value)
    select value, count(*) filter (rf = '@ip') as related_ip, count(*) filter (rf = '@user') as related_user
    from rel group by all""",
)
def relation_counts(i: Inputs) -> DataFrame:
    counts = entities.relation_counts(entities.relate_entities(flat(i)))
    return counts.select("value", "related_ip", "related_user")


@query("f_alerts", f"with {ENTITY.strip()} select field, value, count(distinct id) as alerts from entity group by all")
def entity_alert_ids(i: Inputs) -> DataFrame:
    return entities.entity_alert_counts(flat(i))


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}, {SEED}
    select e.field as entity_field, e.value as entity_value, e.entities, e.title, count(*) as count
    from entity e join seed s on s.field = e.field and s.value = e.value
    where e.status = 'OPEN' and e.investigation_id is null and e.title <> s.title group by all""",
)
def context_open_alerts(i: Inputs) -> DataFrame:
    seed = seeds(i)
    return context.context_open_alerts(flat(i), seed, context.own_terms(seed))


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}
    select field as entity_field, value as entity_value, entities, title, status, resolution_reason, count(*) as count
    from entity where status <> 'OPEN' group by all""",
)
def context_resolved(i: Inputs) -> DataFrame:
    return context.context_resolved(flat(i), context.own_terms(seeds(i)))


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}
    select field as entity_field, value as entity_value, entities, title, investigation_id, status, count(*) as count
    from entity where investigation_id is not null group by all""",
)
def context_investigations(i: Inputs) -> DataFrame:
    return context.context_investigations(flat(i), context.own_terms(seeds(i)))


@query(
    "f_alerts f_processes",
    f"""with {ENTITY.strip()}, ent as (select distinct field, value from entity)
    select field as entity_field, ent.value as entity_value, image_path, count(*) as count from ent join f_processes p
      on (field = '@user' and ent.value = p.username) or (field = '@ip' and ent.value = p.source_address) group by all""",
)
def context_events(i: Inputs) -> DataFrame:
    columns = {"@user": ["username"], "@ip": ["source_address"]}
    return context.context_events(i("f_processes"), context.own_terms(seeds(i)), columns, ["image_path"])


# entities whose first alert is an error, each with everything that occurs beside it in an alert
RELATED = """chosen as (select field, value from seed where title = 'error'),
term as (select distinct s.field as entity_field, s.value as entity_value, b.field, b.value
    from chosen s join entity a on a.value = s.value join entity b on a.id = b.id and a.value <> b.value
  union select field, value, field, value from chosen)"""


def chosen(i: Inputs) -> DataFrame:
    return seeds(i).where("title = 'error'")


def related(i: Inputs) -> DataFrame:
    return context.related_terms(chosen(i), entities.relate_entities(flat(i)))


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}, {SEED}, {RELATED}
    select entity_field, entity_value, entities, e.title, count(distinct id) as count
    from term t join entity e on e.field = t.field and e.value = t.value join seed s on s.value = entity_value
    where status = 'OPEN' and investigation_id is null and e.title <> s.title group by all""",
)
def context_open_alerts_related(i: Inputs) -> DataFrame:
    return context.context_open_alerts(flat(i), chosen(i), related(i))


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}, {SEED}, {RELATED}
    select entity_field, entity_value, entities, e.title, status, resolution_reason, count(distinct id) as count
    from term t join entity e on e.field = t.field and e.value = t.value where status <> 'OPEN' group by all""",
)
def context_resolved_related(i: Inputs) -> DataFrame:
    return context.context_resolved(flat(i), related(i))


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}, {SEED}, {RELATED}
    select entity_field, entity_value, entities, e.title, investigation_id, status, count(distinct id) as count
    from term t join entity e on e.field = t.field and e.value = t.value where investigation_id is not null group by all""",
)
def context_investigations_related(i: Inputs) -> DataFrame:
    return context.context_investigations(flat(i), related(i))


@query(
    "f_alerts f_processes",
    f"""with {ENTITY.strip()}, {SEED}, {RELATED}
    select entity_field, entity_value, image_path, count(distinct event_id) as count from term t join f_processes p
      on (t.field = '@user' and t.value = p.username) or (t.field = '@ip' and t.value = p.source_address) group by all""",
)
def context_events_related(i: Inputs) -> DataFrame:
    columns = {"@user": ["username"], "@ip": ["source_address"]}
    return context.context_related_events(i("f_processes"), related(i), columns, ["image_path"])


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}, other as (
      select a.id, a.field, a.value, a.title, '('||a.field||' = '''||a.value||''' OR '||b.field||' = '''||b.value||''')' as terms
      from entity a join entity b on a.id = b.id and a.field <> b.field)
    select id, field, value,
      'FROM alert WHERE '||terms||' AND metadata.title != '''||title||''' AND status = ''OPEN'' AND investigation_ids IS NULL EARLIEST=-1d' as open_alerts,
      'FROM alert WHERE '||terms||' AND status != ''OPEN'' EARLIEST=-30d | aggregate count by metadata.title, entities, status, resolution_reason' as resolved,
      'FROM alert WHERE '||terms||' AND investigation_ids IS NOT NULL EARLIEST=-7d | aggregate count by metadata.title, entities, investigation_ids, status'
        as investigations,
      'WHERE '||terms||' EARLIEST=-1d' as events from other""",
)
def context_query_texts(i: Inputs) -> DataFrame:
    """All four texts, each widened by the other values of the alert."""
    rows = entities.normalize_entities(flat(i))
    held = q(entities.VALUE)
    listed = {n: F.substring(F.element_at(q("entities.entities"), k), len(kind) + 2, 100) for n, k, kind in [("@user", 1, "userName"), ("@ip", 2, "sourceIpAddress")]}
    wide = rows.withColumns({n: F.filter(F.array(v), lambda v: v != held) for n, v in listed.items()})
    texts = {"open_alerts": "x_open_alerts_query", "resolved": "x_resolved_alerts_query", "investigations": "x_investigations_query", "events": "x_events_query"}
    return context.generate_context_queries(wide, investigations="EARLIEST=-7d").select(
        "id", q(entities.FIELD).alias("field"), held.alias("value"), *[q(c).alias(n) for n, c in texts.items()]
    )


@query("f_alerts", f"with {ENTITY.strip()} select distinct field, value, id from entity")
def entity_alerts(i: Inputs) -> DataFrame:
    return entities.entity_alerts(flat(i), unique_ids=True)


@query("f_alerts", f"with {ENTITY.strip()} select id, value from entity where field = '@ip'")
def keep_logical_type(i: Inputs) -> DataFrame:
    kept = entities.keep_logical_type(entities.normalize_entities(flat(i)), "@ip")
    return kept.select("id", q(entities.VALUE).alias("value"))


@query(
    "f_alerts",
    f"""with {ENTITY.strip()}, {SEED}
    select field, value,
      'FROM alert WHERE ('||field||' = '''||value||''') AND metadata.title != '''||title||''' AND status = ''OPEN'''
        ||' AND investigation_ids IS NULL EARLIEST=-1d' as open_alerts,
      'WHERE ('||field||' = '''||value||''') EARLIEST=-1d' as events from seed""",
)
def context_query_text(i: Inputs) -> DataFrame:
    rows = seeds(i).withColumnsRenamed(
        {"entity_field": entities.FIELD, "entity_value": entities.VALUE, "title": "metadata.title"}
    )
    return context.generate_context_queries(rows).select(
        q(entities.FIELD).alias("field"),
        q(entities.VALUE).alias("value"),
        q("x_open_alerts_query").alias("open_alerts"),
        q("x_events_query").alias("events"),
    )
