"""The stream operators, run over a whole table as a stream that ends."""

from __future__ import annotations

import uuid
from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.alerts import CATEGORY, NAMED
from huntspark.catalog.registry import Inputs, query
from huntspark.functions.names import q
from huntspark.functions.severity import severity_rounded_and_category
from huntspark.functions.times import convert_alert_timestamps, convert_event_timestamps
from huntspark.operators.alerts import normalize_creator_name
from huntspark.operators.entities import FIELD, VALUE, entity_rows
from huntspark.operators.lookups import lookup_tenants
from huntspark.plans.joins import hot_keys
from huntspark.plans.lineage_cut import shared_folder
from huntspark.streaming import streams as op


def source(i: Inputs, table: str) -> DataFrame:
    return i.spark.readStream.schema(i.table(table).schema).parquet(f"{i.sf_dir}/{table}.parque[t]")  # a file or a folder


def event_stream(i: Inputs) -> DataFrame:
    return source(i, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def fresh_folder(i: Inputs) -> str:
    return f"{shared_folder(i.spark)}/stream-{uuid.uuid4().hex}"


def drain(df: DataFrame, i: Inputs, folder: str | None = None, on_disk: bool = False) -> DataFrame:
    """All rows the stream gives, written as parquet to the shared folder; ``on_disk`` is for state that grows with the rows."""
    folder = folder or fresh_folder(i)
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state")
    with op.state_on_disk(i.spark) if on_disk else nullcontext():
        run = writer.trigger(availableNow=True).start(f"{folder}/rows")
    run.awaitTermination()
    return i.spark.read.schema(df.schema).parquet(f"{folder}/rows")


@query(
    sql="""select event_type, 'u'||user_id as matching_value, cast(user_id % 20 as string) as tenant_id,
      strftime(date_trunc('day', ts), '%Y-%m-%d') as day, count(*) as count
    from events where user_id in (select user_id from events where value > 300) group by all""",
)
def stream_ioc_daily(i: Inputs) -> DataFrame:
    """Daily counts of the events that name a listed user; the days that are open when the stream ends come from its state."""
    rows = event_stream(i).select(
        "ts",
        "event_type",
        (F.col("user_id") % 20).cast("string").alias("tenant_id"),
        F.array(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("values"),
    )
    listed = i.table("events").where("value > 300").selectExpr("'u'||user_id as value")
    folder = fresh_folder(i)
    counts = drain(op.daily_ioc_counts(rows, listed), i, folder)
    counts = counts.unionByName(op.open_daily_counts(i.spark, f"{folder}/state"))
    return counts.select(
        "event_type", "matching_value", "tenant_id", F.date_format("day.start", "yyyy-MM-dd").alias("day"), "count"
    )


CLOSE = """p as (select event_id, process_correlation_id, event_time_usec as us from f_processes),
  n as (select event_id, 1704067200000000 + cast(split_part(event_id, '-', 1) as bigint) % 43200 * 60000000 as us,
    case when contains(pid, ':') then host_id||':'||pid else host_id||':'||pid||':'||timewindow end as k from f_netflow)"""


@query(
    "f_processes f_netflow",
    f"""with {CLOSE} select p.event_id, coalesce(n.event_id, '') as flow
    from p left join n on p.process_correlation_id = n.k and n.us between p.us and p.us + 172800000000""",
)
def stream_correlate(i: Inputs) -> DataFrame:
    """Process events and flows as two streams, joined within two days; the rest comes when both have ended."""
    timed = "timestamp_micros(event_time_usec) as ts"
    processes = i("f_processes", events=source(i, "events")).selectExpr("event_id", "process_correlation_id", timed)
    flows = i("f_netflow", lineitem=source(i, "lineitem")).selectExpr(
        "event_id", "host_id", "pid", "timewindow",
        "timestamp_micros(1704067200000000 + cast(split_part(event_id, '-', 1) as bigint) % 43200 * 60000000) as ts",
    )
    hot = hot_keys(i("f_netflow").select(op.netflow_key().alias("key")), ["key"])
    pairs = op.correlate_matches(processes, flows, "2 days", hot=hot).select("event_id", "netflow_event_id")
    whole = op.with_unmatched(drain(pairs, i, on_disk=True), i("f_processes").select("event_id"), "event_id")
    return whole.select("event_id", F.coalesce("netflow_event_id", F.lit("")).alias("flow"))


@query(
    "f_detectors",
    f"""select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as event_time, {CATEGORY} as category,
      coalesce(d.display_name, creator) as creator
    from (select *, round_even(value/500*100, 0)/100 as s, 'app:d'||(event_id % 40) as creator from events)
      left join {NAMED} d on d.creator_name = creator""",
)
def stream_lookup(i: Inputs) -> DataFrame:
    """Row-wise operators and a lookup in a static table, on a stream."""
    rows = event_stream(i).select(
        "event_id",
        F.unix_micros("ts").alias("event_time_usec"),
        (F.col("value") / 500).alias("severity"),
        F.concat(F.lit("app:d"), (F.col("event_id") % 40).cast("string")).alias("creator"),
    )
    chain = rows.transform(convert_event_timestamps).transform(severity_rounded_and_category)
    named = normalize_creator_name(chain, i("f_detectors"))
    return drain(
        named.select(
            "event_id",
            q("x_event_time_usec").alias("event_time"),
            q("x_severity_category").alias("category"),
            q("x_creator_display_name").alias("creator"),
        ),
        i,
    )


@query(
    sql="""select 'events' as evidence_type, event_type||(user_id % 50) as id, min(cast(user_id % 20 as string)) as tenant_id,
      'i'||(event_id % 5) as investigation_id from events group by all""",
)
def stream_stage(i: Inputs) -> DataFrame:
    """Evidence of a stream, every (id, investigation) once."""
    rows = event_stream(i).selectExpr(
        "'events' as evidence_type",
        "event_type||(user_id % 50) as id",
        "cast(user_id % 20 as string) as tenant_id",
        "'i'||(event_id % 5) as investigation_id",
    )
    return drain(op.staged_first(rows), i)


@query(
    "f_alerts f_tenants",
    """select a.id, t.name as tenant, strftime(make_timestamp(created_at_seconds*1000000), '%Y-%m-%dT%H:%M:%SZ') as created_at, 'userName:u'||user_id as entity
    from f_alerts a left join f_tenants t on t.id = a.tenant_id""",
)
def stream_alerts(i: Inputs) -> DataFrame:
    """Alert times, entities and a tenant lookup on a stream."""
    alerts = i("f_alerts", events=source(i, "events")).selectExpr(
        "id", "tenant_id", "created_at_seconds as `created_at.seconds`", "array(entity1, entity2, entity3) as `entities.entities`"
    )
    rows = entity_rows(convert_alert_timestamps(alerts)).where(q(FIELD) == "@user")
    named = lookup_tenants(rows, i("f_tenants").select("id", "name"))
    return drain(
        named.select("id", q("tenant.name").alias("tenant"), q("x_created_at_seconds").alias("created_at"), F.concat(F.lit("userName:"), q(VALUE)).alias("entity")), i
    )
