"""Sources and sinks: what is written to the shared folder is what is read from it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.alerts import nested_alerts
from huntspark.catalog.hunting import FOUND, raw_events
from huntspark.catalog.registry import Inputs, query
from huntspark.functions import names
from huntspark.functions.names import q
from huntspark.operators import ioc, lineage
from huntspark.plans.lineage_cut import shared_folder
from huntspark.sources import scans, sinks


def fresh(i: Inputs, kind: str) -> str:
    return f"{shared_folder(i.spark)}/{kind}-{uuid.uuid4().hex}"


@query("f_audits", "select audit_id, target, application, event_name, before_status, after_status from f_audits")
def json_round_trip(i: Inputs) -> DataFrame:
    """JSON rows written to a folder and read from there as a table."""
    path, kept = fresh(i, "json"), ["audit_id", "target", "application", "event_name", "before_status", "after_status"]
    sinks.write_json(i("f_audits").select(*kept), path)
    return scans.find_dataframe(i.spark, path).select(*kept)


@query("f_networks", "select cidr, id % 2 = 0 as is_critical, description, network_type from f_networks")
def network_range_round_trip(i: Inputs) -> DataFrame:
    """Network ranges written as a sheet of text and read with their types."""
    path = fresh(i, "ranges")
    rows = i("f_networks").selectExpr("cidr", "description", "id % 2 = 0 as is_critical", "network_type")
    sinks.write_network_ranges(rows, path)
    return scans.read_network_ranges(i.spark, path)


@query("f_networks", "select cidr, description from f_networks where id % 3 = 1")
def network_ranges(i: Inputs) -> DataFrame:
    held = i("f_networks").withColumn("tenant_id", F.col("id") % 3)
    return scans.network_ranges(held, "1").select("cidr", "description")


@query(sql=f"with {FOUND.strip()} select distinct value from found")
def read_indicators(i: Inputs) -> DataFrame:
    """A list of indicators, one on a line, with blank lines between them."""
    path = fresh(i, "list")
    listed = ioc.indicator_set(raw_events(i)).select(F.explode(F.array(F.concat(F.lit("  "), "indicator"), F.lit(""))).alias("value"))
    listed.write.text(path)
    return ioc.read_indicators(i.spark, path).select("value").distinct()


@query(sql=f"with {FOUND.strip()} select distinct value from found where kind = 'ip'")
def watchlist(i: Inputs) -> DataFrame:
    listed = ioc.indicator_table(ioc.indicator_set(raw_events(i)).withColumnRenamed("indicator", "value"), fqdn=True)
    return scans.watchlist(listed.withColumnRenamed("logical_type", "type"), "ip").select("value")


@query(
    "f_alerts",
    """select unnest(['id', 'tenant_id', 'status', 'resolution_reason', 'investigation_id', 'metadata.title', 'metadata.severity', 'metadata.created_at.seconds',
        'metadata.resolved_at.seconds', 'metadata.creator.detector.detector_id', 'entities.entities', 'event_ids.resource_id', 'event_ids.host_id']) as key,
      unnest([count(id), count(tenant_id), count(status), count(resolution_reason), count(investigation_id), count(title), count(severity),
        count(created_at_seconds), count(*) filter (status <> 'OPEN'), count(creator), count(*), count(*), count(*)]) as rows from f_alerts""",
)
def schema_catalogue(i: Inputs) -> DataFrame:
    """The keys of nested alerts, and how many alerts have a value under each (a list counts as one)."""
    alerts = nested_alerts(i)
    keys = [r.key for r in names.schema_catalogue(alerts).collect()]  # as many as the schema has leaves
    flat = names.flatten_struct(alerts, None)
    held = {k: next(c for c in flat.columns if k == c or k.startswith(c + ".")) for k in keys}
    counted = flat.agg(*[F.count(q(held[k])).alias(f"k{n}") for n, k in enumerate(keys)])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"k{n}").alias("rows")) for n, k in enumerate(keys)]))
    return counted.select(rows.alias("r")).select("r.*")


@query("f_alerts", "select status, count(*) as count from f_alerts group by all")
def assign(i: Inputs) -> DataFrame:
    """A result bound to a name for SQL, without its empty columns."""
    name = f"found_{uuid.uuid4().hex}"
    bound = sinks.assign(i("f_alerts").withColumn("never", F.lit(None).cast("string")), name, drop_empty=True)
    if "never" in bound.columns:
        raise ValueError("an empty column was bound")
    return i.spark.sql(f"select status, count(*) as count from {name} group by status")


@query("f_alerts", "select id, coalesce(resolution_reason, investigation_id, '') as reason from f_alerts")
def return_valid_column(i: Inputs) -> DataFrame:
    found = names.return_valid_column(i("f_alerts"), ["no_such_column", "resolution_reason", "investigation_id"])
    return i("f_alerts").select("id", F.coalesce(found, F.lit("")).alias("reason"))


@query("f_processes", "select event_id, process_correlation_id from f_processes where process_correlation_id is not null")
def assert_max_unmatched(i: Inputs) -> DataFrame:
    """One row in 101 has no process; that is fewer than one in twenty."""
    checked = lineage.assert_max_unmatched(i("f_processes"), "process_correlation_id", 0.05)
    return checked.select("event_id", "process_correlation_id").where("process_correlation_id is not null")
