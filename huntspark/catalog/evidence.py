"""Evidence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.registry import Inputs, query
from huntspark.functions.fixed import ALERTS
from huntspark.functions.names import q
from huntspark.operators import evidence as op
from huntspark.operators import inflate, lookups

STORE = """
firsts as (select evidence_type, id, tenant_id, investigation_id, flag from f_evidence
  qualify row_number() over (partition by id, investigation_id, flag = 'A' order by evidence_type, tenant_id) = 1),
store as (select evidence_type, id, tenant_id, investigation_id from firsts where flag = 'A'),
fresh as (select evidence_type, id, tenant_id, investigation_id from firsts where flag <> 'A'),
staged as (select * from store union all select * from fresh f
  where not exists (select 1 from store s where s.id = f.id and s.investigation_id = f.investigation_id))"""


def rows(i: Inputs, condition: str) -> DataFrame:
    return i("f_evidence").where(condition).drop("flag")


def store(i: Inputs) -> DataFrame:
    """The evidence table as a first staging left it."""
    source = rows(i, "flag = 'A'")
    return op.stage(source.where(F.lit(False)), source)


def staged(i: Inputs) -> DataFrame:
    return op.stage(store(i), rows(i, "flag <> 'A'"))


@query("f_evidence", f"with {STORE.strip()} select * from staged")
def stage_evidence(i: Inputs) -> DataFrame:
    return staged(i)


@query(
    "f_evidence",
    f"""with {STORE.strip()} select * from store s where not exists (select 1 from f_evidence f where f.flag = 'R'
      and f.id = s.id and f.evidence_type = s.evidence_type and f.investigation_id = s.investigation_id)""",
)
def unstage_evidence(i: Inputs) -> DataFrame:
    return op.unstage(store(i), rows(i, "flag = 'R'"))


@query(
    "f_evidence",
    f"with {STORE.strip()} select * from store where evidence_type = 'alerts' and tenant_id = '3' and investigation_id = 'i7'",
)
def read_evidence(i: Inputs) -> DataFrame:
    return op.read_evidence(store(i), ALERTS, "3", "i7")


@query(
    "f_evidence",
    f"with {STORE.strip()} select * from store where not (evidence_type = 'alerts' and tenant_id = '3')",
)
def clear_evidence(i: Inputs) -> DataFrame:
    return op.clear(store(i), ALERTS, "3")


@query(
    "f_evidence",
    f"""with {STORE.strip()}, b as (select evidence_type, investigation_id, count(*) as n from store group by all),
      a as (select evidence_type, investigation_id, count(*) as n from staged group by all)
    select 'stage' as action, evidence_type, investigation_id, coalesce(b.n, 0) as before, coalesce(a.n, 0) as after,
      coalesce(a.n, 0) - coalesce(b.n, 0) as difference from a full join b using (evidence_type, investigation_id)""",
)
def evidence_changes(i: Inputs) -> DataFrame:
    return op.changes(store(i), staged(i), "stage")


@query(
    "f_evidence",
    f"with {STORE.strip()} select distinct tenant_id, investigation_id, evidence_type, id from staged",
)
def investigation_evidence(i: Inputs) -> DataFrame:
    return op.investigation_evidence(staged(i))


MERGES = """
usable as (select *, not contains(title, 'Merged Investigation') as source_ok from f_investigations
  where status in ('OPEN', 'DRAFT') and not archived),
wish as (select 'i'||o_orderkey as source, 'i'||(o_custkey % 50) as target from orders),
pair0 as (select source, min(target) as target from wish group by 1),
pair1 as (select * from pair0 where source <> target and source in (select id from usable where source_ok)
  and target in (select id from usable)),
pair as (select * from pair1 where target not in (select source from pair1))"""


def merged(i: Inputs) -> tuple[DataFrame, DataFrame]:
    wish = i.table("orders").selectExpr("'i'||o_orderkey as source", "'i'||(o_custkey % 50) as target")
    return op.merge_investigations(i("f_investigations"), store(i), wish)


@query(
    "f_evidence f_investigations",
    f"""with {STORE.strip()}, {MERGES.strip()}, moved as (select evidence_type, id, tenant_id,
        coalesce(target, investigation_id) as investigation_id, target is not null as moved
      from store left join pair on source = investigation_id)
    select evidence_type, id, tenant_id, investigation_id from moved
    qualify row_number() over (partition by id, investigation_id order by moved, evidence_type, tenant_id) = 1""",
)
def merge_evidence(i: Inputs) -> DataFrame:
    return merged(i)[1]


@query(
    "f_investigations",
    f"""with {MERGES.strip()} select id, case when target is null then status else 'CLOSED_INFORMATIONAL' end as status,
      case when target is null then title else 'Merged Investigation: '||title end as title,
      archived or target is not null as archived from f_investigations left join pair on source = id""",
)
def merge_closes_sources(i: Inputs) -> DataFrame:
    return merged(i)[0]


@query("f_search_log", "select 'search_queries' as evidence_type, id, tenant_id, 'NEW' as investigation_id from f_search_log")
def stage_queries(i: Inputs) -> DataFrame:
    empty = i("f_evidence").drop("flag").where(F.lit(False))
    return op.stage_queries(empty, i("f_search_log"))[0]


@query(
    "f_search_log",
    """select id, query from f_search_log where query <> 'view' union all
    select id, 'again' from f_search_log where query = 'view'""",
)
def track_queries(i: Inputs) -> DataFrame:
    """New queries join the log; those it has already stay as they are."""
    log = i("f_search_log")
    return op.track_queries(log.where("query <> 'view'"), log.withColumn("query", F.lit("again"))).select("id", "query")


@query("f_search_log", "select id from f_search_log where query <> 'view'")
def untrack_queries(i: Inputs) -> DataFrame:
    log = i("f_search_log")
    return op.untrack_queries(log, log.where("query = 'view'")).select("id")


@query(
    "f_search_log",
    "select tenant_id, id from f_search_log qualify row_number() over (partition by tenant_id order by inserted_time desc, id desc) = 1",
)
def last_query(i: Inputs) -> DataFrame:
    return op.last_query(i("f_search_log"), ["tenant_id"])


@query(
    sql="""select 'alerts' as evidence_type, 'a'||o_orderkey as evidence_id, o_orderpriority as note from orders where o_orderkey % 2 = 0
    union all select 'events', 'e'||o_orderkey, null from orders
    union all select 'events', 'f'||o_orderkey, null from orders
    union all select 'search_queries', 'q'||o_orderkey, null from orders where o_orderkey % 3 = 0""",
)
def inflate_evidence(i: Inputs) -> DataFrame:
    nested = i.table("orders").selectExpr(
        """if(o_orderkey % 2 = 0, array(struct('a'||o_orderkey as alert_id, o_orderpriority as note)), null) as alerts_evidence""",
        """array(struct('e'||o_orderkey as event_id), struct('f'||o_orderkey as event_id)) as events_evidence""",
        """if(o_orderkey % 3 = 0, array(struct('q'||o_orderkey as search_query)),
             cast(array() as array<struct<search_query string>>)) as search_queries_evidence""",
    )
    return inflate.inflate_evidence(nested).select(
        q("x_evidence_type").alias("evidence_type"), q("x_evidence_id").alias("evidence_id"), "note"
    )


@query(
    "f_evidence f_search_log",
    """select evidence_type, f.id, f.tenant_id, case evidence_type when 'alerts' then coalesce(p_brand, '') when 'events' then
        coalesce(c_name, '') else coalesce(query, '') end as detail
    from (select distinct evidence_type, id, tenant_id from f_evidence) f
      left join part on evidence_type = 'alerts' and f.id = 'e'||p_partkey
      left join customer on evidence_type = 'events' and f.id = 'e'||c_custkey
      left join f_search_log s on evidence_type = 'search_queries' and f.id = 'e'||s.id""",
)
def lookup_evidence(i: Inputs) -> DataFrame:
    frame = i("f_evidence").select("evidence_type", "id", "tenant_id").distinct().withColumnsRenamed(
        {"evidence_type": "x_evidence_type", "id": "x_evidence_id"}
    )
    out = lookups.lookup_evidence(
        frame,
        i.table("part").selectExpr("'e'||p_partkey as id", "p_brand"),
        i.table("customer").selectExpr("'e'||c_custkey as id", "c_name"),
        i("f_search_log").selectExpr("'e'||id as id", "query"),
    )
    detail = F.coalesce(q("alert.p_brand"), q("event.c_name"), q("query.query"), F.lit(""))
    return out.select(
        q("x_evidence_type").alias("evidence_type"), q("x_evidence_id").alias("id"), "tenant_id", detail.alias("detail")
    )
