"""Event, process and process-tree queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.registry import Inputs, query
from huntspark.functions.indicators import event_schema as schema_of
from huntspark.functions.indicators import logical
from huntspark.functions.names import default_schema_columns, q, select_schema_columns
from huntspark.functions.times import convert_event_timestamps
from huntspark.operators import facets, inflate, ioc, lineage, process
from huntspark.sources import scans


def events(i: Inputs) -> DataFrame:
    return i("f_events").withColumnRenamed("program_hash_md5", "program_hash.md5")


@query(
    "f_events",
    """select resource_id, event_time_usec from f_events
    where schema = 'netflow' and source_address = '10.0.0.7' and event_time_usec >= 100000000""",
)
def search_events(i: Inputs) -> DataFrame:
    found = scans.search_events(
        events(i), "netflow", [q("source_address") == "10.0.0.7"], earliest="1970-01-01T00:01:40Z", limit=None
    )
    return found.select("resource_id", "event_time_usec")


@query(
    "f_events f_alerts",
    """select resource_id, image_path from f_events where resource_id in
      (select 'event://priv:scope.process:'||event_id from f_alerts where title = 'error')""",
)
def events_by_id(i: Inputs) -> DataFrame:
    ids = i("f_alerts").where("title = 'error'").selectExpr("'event://priv:scope.process:'||event_id as resource_id")
    return scans.rows_by_id(events(i), ids).select("resource_id", "image_path")


@query(
    "f_processes",
    """select event_id, strftime(make_timestamp(event_time_usec), '%Y-%m-%dT%H:%M:%SZ') as event_time,
      case when pid % 2 = 0 then strftime(make_timestamp(event_time_usec + 1000000), '%Y-%m-%dT%H:%M:%SZ') else 'N/A' end
        as mod_time from f_processes""",
)
def event_timestamps(i: Inputs) -> DataFrame:
    df = i("f_processes").withColumn("mod_time_us", F.when(F.col("pid") % 2 == 0, F.col("event_time_usec") + 1000000))
    return convert_event_timestamps(df).select(
        "event_id", q("x_event_time_usec").alias("event_time"), q("x_mod_time_us").alias("mod_time")
    )


@query("f_events", "select schema, count(*) as count from f_events group by all")
def event_schema(i: Inputs) -> DataFrame:
    return events(i).groupBy(schema_of(q("resource_id")).alias("schema")).agg(F.count("*").alias("count"))


FACET = """
facet as (select 'process' as schema, 'sensor_type='||sensor_type||'|username='||username||'|image_path='||image_path as facet from f_events
    where schema = 'process'
  union all select 'netflow', 'sensor_type='||coalesce(sensor_type, {null})||'|source_address='||coalesce(source_address, {null})
    ||'|destination_address='||coalesce(destination_address, {null}) from f_events where schema = 'netflow'
  union all select 'http', 'source_address='||source_address||'|destination_address='||destination_address
    ||'|uri_path='||uri_path from f_events where schema = 'http'
  union all select 'auth', 'source_address='||source_address||'|action='||action from f_events where schema = 'auth')"""


@query(
    "f_events",
    f"with {FACET.strip().format(null='null')} select schema, facet, count(*) as count from facet where facet is not null group by all",
)
def facets_by_schema(i: Inputs) -> DataFrame:
    return facets.facets_by_schema(events(i), q("schema"), ["process", "netflow", "http", "auth"])


@query(
    "f_events",
    f"""with {FACET.strip().format(null='null')},
    more as (select schema, facet from facet
      union all select schema, 'schema='||schema||'|resource_id='||resource_id||'|event_time_usec='||event_time_usec||'|sensor_type='||sensor_type
        ||'|image_path='||image_path from f_events where schema = 'detectionfinding'
      union all select 'thirdpartyalert', 'source_address=10.0.3.'||(s_suppkey % 9)||'|user_principal_name='||s_nationkey||'@corp|title='||substr(s_name, 1, 8) from supplier)
    select schema, facet, count(*) as count from more where facet is not null group by all""",
)
def facets_all_schemas(i: Inputs) -> DataFrame:
    """Every schema that occurs: a listed one of another table, and one without columns of its own."""
    third = i.table("supplier").selectExpr(
        "'thirdpartyalert' as schema", "'10.0.3.'||(s_suppkey % 9) as source_address", "s_nationkey||'@corp' as user_principal_name", "substr(s_name, 1, 8) as title",
        "cast(null as string) as ontology",
    )
    return facets.facets_by_schema(events(i).unionByName(third, allowMissingColumns=True), q("schema"))


@query(
    sql="""select 'decoded_block_text='||substr(text, 1, 200) as facet, count(*) as count from documents where text is not null group by text""",
)
def script_preview(i: Inputs) -> DataFrame:
    """Whole texts are counted; only what is shown is shortened."""
    scripts = i.table("documents").selectExpr("'scriptblock' as schema", "text as decoded_block_text")
    return facets.facets_by_schema(scripts, q("schema"), ["scriptblock"]).select("facet", "count")


@query(
    "f_events",
    f"""with {FACET.strip().format(null="'null'")} select schema, facet, count from (select schema, facet, count(*) as count from facet group by all)
    qualify row_number() over (partition by schema order by count desc, facet) <= 20""",
)
def top20_by_schema(i: Inputs) -> DataFrame:
    return facets.top_by_schema(events(i), q("schema"), ["process", "netflow", "http", "auth"], 20)


@query(
    "f_events",
    """select resource_id from f_events where source_address in ('10.0.0.5', '10.0.1.9')
    or destination_address in ('10.0.0.5', '10.0.1.9')""",
)
def logical_match(i: Inputs) -> DataFrame:
    df = events(i)
    ips = logical(df, ["source_address", "destination_address", "source_nat_address"])
    return df.where(F.arrays_overlap(ips, F.array(F.lit("10.0.0.5"), F.lit("10.0.1.9")))).select("resource_id")


@query(
    "f_events",
    """select resource_id,
      case when schema in ('netflow', 'http') then case when source_address = destination_address then source_address
        else concat_ws(',', source_address, destination_address) end
        when schema = 'auth' then source_address else '' end as ips,
      case when schema = 'auth' then target_domain_name else '' end as domains,
      case when schema = 'process' then program_hash_md5 else '' end as hashes
    from f_events""",
)
def logical_arrays(i: Inputs) -> DataFrame:
    return ioc.add_logicals(events(i)).select(
        "resource_id",
        *[F.array_join(q(f"logicals.{k}"), ",").alias(n) for k, n in [("ip", "ips"), ("domain", "domains"), ("hash", "hashes")]],
    )


@query(
    "f_events",
    """select distinct indicator from (select unnest([source_address, destination_address, target_domain_name, program_hash_md5]) as indicator
    from f_events where schema <> 'detectionfinding') where indicator is not null""",
)
def indicator_set(i: Inputs) -> DataFrame:
    return ioc.indicator_set(ioc.add_logicals(events(i)))


@query("f_schema_keys", """select n, case when key like '%.%' then split_part(key, '.', 2) else 'Error' end as x_schema,
      case when key like '%.%.%' then substr(key, length(split_part(key, '.', 1)) + length(split_part(key, '.', 2)) + 3)
        else 'Error' end as x_key from f_schema_keys""")
def schema_keys(i: Inputs) -> DataFrame:
    return inflate.inflate_schema_keys(i("f_schema_keys")).select("n", "x_schema", "x_key")


@query(
    sql="select event_id, case when event_id % 10 = 0 then -1 else cast(json_extract(props, '$.k') as bigint) end as k from events"
)
def inflate_original_data(i: Inputs) -> DataFrame:
    df = i.table("events").selectExpr("event_id", "if(event_id % 10 = 0, substr(props, 1, 4), props) as original_data")
    named = inflate.inflate_original_data(df, paths={"k": "bigint"})
    return named.select("event_id", F.coalesce(q("original_data.k"), F.lit(-1)).alias("k"))


@query(
    "f_alerts",
    """select path, type, count(*) as rows from (
      select unnest(['title', 'at.seconds', 'at.note', 'tags', 'odd']) as path,
        unnest(['STRING', 'BIGINT', case when event_id % 3 = 0 then 'STRING' end, 'ARRAY<STRING>', case when event_id % 2 = 0 then 'BIGINT' else 'BOOLEAN' end]) as type
      from f_alerts) where type is not null group by all""",
)
def json_inventory(i: Inputs) -> DataFrame:
    """Paths and types of JSON texts: nested ones, some that few texts have, one of two types."""
    texts = i("f_alerts").selectExpr(
        """to_json(struct(title, struct(created_at_seconds as seconds, if(event_id % 3 = 0, status, null) as note) as at, array(entity1, entity2) as tags)) as text""", "event_id"
    ).selectExpr("""concat(left(text, length(text) - 1), ',"odd":', if(event_id % 2 = 0, '7', 'true'), '}') as original_data""")
    return inflate.json_inventory(texts)


@query(
    "f_netflow",
    """select event_id, case when contains(pid, ':') then host_id||':'||pid else host_id||':'||pid||':'||timewindow end as key
    from f_netflow""",
)
def correlation_key(i: Inputs) -> DataFrame:
    return i("f_netflow").select("event_id", process.correlation_key(q("host_id"), q("pid"), q("timewindow")).alias("key"))


@query(
    "f_processes",
    "select event_id, host_id, pid, pid % 3 as timewindow from f_processes where process_correlation_id is not null",
)
def correlation_parts(i: Inputs) -> DataFrame:
    parts = i("f_processes").select("event_id", process.split_correlation_id(q("process_correlation_id")).alias("p"))
    return parts.where("p is not null").select(
        "event_id", "p.host_id", q("p").getField("pid").cast("bigint").alias("pid"),
        q("p").getField("timewindow").cast("bigint").alias("timewindow"),
    )


@query(
    "f_processes f_netflow",
    """select p.event_id, coalesce(n.event_id, '') as flow from f_processes p left join f_netflow n on p.process_correlation_id =
      case when contains(n.pid, ':') then n.host_id||':'||n.pid else n.host_id||':'||n.pid||':'||n.timewindow end
      and n.event_ts >= timestamp '1996-01-01 00:00:00'""",
)
def correlate_netflow(i: Inputs) -> DataFrame:
    flows = i("f_netflow").withColumnsRenamed({"pid": "processcorrelationid.pid", "timewindow": "processcorrelationid.timewindow"})
    joined = process.process_correlate_netflow(i("f_processes"), flows, earliest="1996-01-01T00:00:00Z", time_column="event_ts")
    return joined.select("event_id", F.coalesce(q("netflow.event_id"), F.lit("")).alias("flow"))


SEEN = """
seen as (select host_id, sensor_type, tenant_id, count(*) as count from f_processes
  where image_path = 'error' and value > 10 group by all)"""
MATCH = """exists (select 1 from seen s where (s.host_id = e.host_id) and (s.tenant_id = e.tenant_id)
  and (s.sensor_type is null or s.sensor_type = e.sensor_type))"""


def seen(i: Inputs) -> DataFrame:
    rows = i("f_processes").where("image_path = 'error' and value > 10")
    return rows.groupBy("host_id", "sensor_type", "tenant_id").agg(F.count("*").alias("count"))


@query("f_processes f_netflow", f"with {SEEN.strip()} select event_id, tx_byte_count from f_netflow e where {MATCH}")
def pivot_netflow(i: Inputs) -> DataFrame:
    return process.process_pivot_netflow(seen(i), i("f_netflow")).select("event_id", "tx_byte_count")


@query("f_processes f_http", f"with {SEEN.strip()} select event_id, uri_path from f_http e where {MATCH}")
def pivot_http(i: Inputs) -> DataFrame:
    return process.process_pivot_http(seen(i), i("f_http")).select("event_id", "uri_path")


@query("f_processes f_auth", f"with {SEEN.strip()} select event_id, action from f_auth e where {MATCH}")
def pivot_auth(i: Inputs) -> DataFrame:
    return process.process_pivot_auth(seen(i), i("f_auth")).select("event_id", "action")


@query("f_processes f_detectionfinding", f"with {SEEN.strip()} select event_id, title from f_detectionfinding e where {MATCH}")
def pivot_detectionfinding(i: Inputs) -> DataFrame:
    return process.process_pivot_detectionfinding(seen(i), i("f_detectionfinding")).select("event_id", "title")


@query(
    "f_processes f_http",
    """with busy as (select distinct tenant_id, sensor_type from f_processes where value > 200)
    select event_id from f_http e where exists (select 1 from busy s
      where s.tenant_id = e.tenant_id and (s.sensor_type is null or s.sensor_type = e.sensor_type))""",
)
def pivot_with_map(i: Inputs) -> DataFrame:
    rows = i("f_processes").where("value > 200").selectExpr("tenant_id as customer", "sensor_type as sensor")
    return process.process_pivot_http(rows, i("f_http"), {"customer": "tenant_id", "sensor": "sensor_type"}).select("event_id")


@query(
    "f_processes",
    """with p as (select distinct host_id as h, process_correlation_id as k, parent_correlation_id as par
        from f_processes where process_correlation_id is not null),
      walk as (select h, k, 0 as steps, k as anc from p union all
        select w.h, w.k, steps + 1, b.k from walk w join p a on a.h = w.h and a.k = w.anc join p b on b.h = a.h and b.k = a.par),
      deep as (select h, k, max(steps) as depth from walk group by all)
    select event_id, coalesce(anc, '') as step, cast(coalesce(depth - steps, -1) as bigint) as lineage_index
    from f_processes f left join (select w.*, depth from walk w join deep d on d.h = w.h and d.k = w.k) t
      on t.h = f.host_id and t.k = f.process_correlation_id""",
    recursive=True,
)
def process_lineage(i: Inputs) -> DataFrame:
    rows = i("f_processes").select("event_id", "host_id", "process_correlation_id", "parent_correlation_id")
    found = lineage.lookup_lineage(rows, rows)
    return found.select(
        "event_id",
        F.coalesce(q(lineage.LINEAGE)["process_correlation_id"], F.lit("")).alias("step"),
        F.coalesce(q(lineage.LINEAGE + ".index"), F.lit(-1)).alias("lineage_index"),
    )


@query(
    "f_processes",
    """with p as (select host_id as h, process_correlation_id as k, min(parent_correlation_id) as par, min(image_path) as image,
        min(username) as username from f_processes where process_correlation_id is not null group by all),
      asked as (select distinct h, k, image from p where ends_with(username, '7')),
      walk as (select h, k, 0 as steps, k as anc from asked union all
        select w.h, w.k, steps + 1, b.k from walk w join p a on a.h = w.h and a.k = w.anc join p b on b.h = a.h and b.k = a.par),
      deep as (select h, k, max(steps) as depth from walk group by all)
    select w.h as host_id, w.k as process_correlation_id, p.image as image_path, p.username, cast(depth - steps as bigint) as lineage_index
    from walk w join deep d on d.h = w.h and d.k = w.k join p on p.h = w.h and p.k = w.anc""",
    recursive=True,
)
def process_lineage_records(i: Inputs) -> DataFrame:
    """Steps with the attributes of their processes, asked by the resource of each record."""
    table = i("f_processes").selectExpr("host_id", "process_correlation_id", "parent_correlation_id", "image_path", "username", "'r'||username as resource_id")
    asked = table.where("endswith(username, '7')").select("host_id", "process_correlation_id", "resource_id")
    found = lineage.lookup_lineage(asked.dropna(), table)
    step = q(lineage.LINEAGE)
    return found.select(
        "host_id", "process_correlation_id", step["image_path"].alias("image_path"), step["username"].alias("username"), q(lineage.LINEAGE + ".index").alias("lineage_index")
    )


@query(
    "f_processes",
    """select p.event_id, coalesce(c.k, '') as child from f_processes p left join
      (select host_id as h, parent_correlation_id as par, coalesce(process_correlation_id, '?') as k from f_processes) c
      on c.h = p.host_id and c.par = p.process_correlation_id""",
)
def process_children(i: Inputs) -> DataFrame:
    rows = i("f_processes").select("event_id", "host_id", "process_correlation_id", "parent_correlation_id")
    listed = rows.withColumn("process_correlation_id", F.coalesce("process_correlation_id", F.lit("?")))
    return lineage.lookup_children(rows, listed).select("event_id", F.coalesce(q(lineage.CHILDREN)["process_correlation_id"], F.lit("")).alias("child"))


@query(
    "f_processes",
    """select event_id, coalesce(k, '') as parent from f_processes p left join
      (select distinct host_id as h, process_correlation_id as k from f_processes) a on a.h = p.host_id and a.k = p.parent_correlation_id""",
)
def process_parent(i: Inputs) -> DataFrame:
    rows = i("f_processes").select("event_id", "host_id", "process_correlation_id", "parent_correlation_id")
    return lineage.lookup_parent(rows, rows).select("event_id", F.coalesce(q(lineage.PARENT_INFO)["process_correlation_id"], F.lit("")).alias("parent"))


@query(
    "f_processes",
    "select distinct host_id, process_correlation_id from f_processes where process_correlation_id is not null",
)
def lineage_keys(i: Inputs) -> DataFrame:
    return lineage.lineage_keys(i("f_processes").select("host_id", "process_correlation_id"))


@query(
    "f_processes",
    """select host_id, count(*) as rows, count(*) filter (process_correlation_id is null) as unmatched
    from f_processes group by all""",
)
def unmatched_rate(i: Inputs) -> DataFrame:
    return lineage.unmatched_rate(i("f_processes"), "process_correlation_id", ["host_id"])


@query("f_events", "select source_address, action from f_events where schema = 'auth'")
def default_columns(i: Inputs) -> DataFrame:
    assert default_schema_columns("AUTH")
    return select_schema_columns(events(i).where("schema = 'auth'"), "auth")
