"""Processes and the other event tables: correlation by process key, pivots by shared columns."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.fixed import PIVOT_COLUMNS
from huntspark.functions.names import prefix_columns, q
from huntspark.functions.times import time_range
from huntspark.plans.joins import broadcast_if_small, expand_left_join
from huntspark.plans.lineage_cut import cut

NETFLOW = "netflow."


def correlation_key(host: Column, pid: Column, timewindow: Column) -> Column:
    """``host:pid:timewindow``; a pid that holds a colon already carries its time window."""
    return F.when(F.contains(pid, F.lit(":")), F.concat(host, F.lit(":"), pid)).otherwise(
        F.concat(host, F.lit(":"), pid, F.lit(":"), timewindow)
    )


def split_correlation_id(column: Column) -> Column:
    """(host_id, pid, timewindow) of a correlation id, null if it has not three parts."""
    parts = F.split(column.cast("string"), ":")
    names = ["host_id", "pid", "timewindow"]
    fields = [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]
    return F.when(F.size(parts) == 3, F.struct(*fields))


def process_correlate_netflow(
    df: DataFrame,
    netflow: DataFrame,
    process_column: str = "process_correlation_id",
    earliest: str | None = None,
    time_column: str = "event_time_usec",
    now: datetime | None = None,
) -> DataFrame:
    """Left join to the network flows of the same process; their columns get the prefix ``netflow.``.

    ``netflow`` has ``host_id``, ``processcorrelationid.pid`` and ``processcorrelationid.timewindow`` (dotted);
    ``earliest`` (``1d``) looks at recent flows only. A process may own very many flows, so hot processes are split.
    """
    if process_column not in df.columns or NETFLOW + "process_correlation_id" in df.columns:
        return df
    netflow = time_range(netflow, time_column, earliest, now=now) if earliest else netflow
    key = correlation_key(
        q("host_id"), q("processcorrelationid.pid"), q("processcorrelationid.timewindow").cast("string")
    )
    flows = prefix_columns(netflow.withColumn("process_correlation_id", key), NETFLOW)
    taken = {c: c + ".correlate_netflow" for c in flows.columns if c in df.columns}
    flows = flows.withColumnsRenamed(taken)
    return expand_left_join(df, flows, [(process_column, NETFLOW + "process_correlation_id")])


def pivot(df: DataFrame, events: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The events that match any row of ``df`` on all columns this row has a value for.

    ``columns`` maps columns of ``df`` to columns of ``events``. A null is a wildcard, which as one join condition would need a
    nested loop, and as one join for each kind of null up to 2**n - 1 joins. Instead the rows become one index of (which
    columns they have, their values). Of the events only the distinct values of these columns look into it, once for
    each kind of null that occurs (a small job finds these), in one join; a second one keeps the events with values that
    matched. Both are equi joins, so neither nulls nor hot values meet in a loop.
    """
    sources = list(columns)
    keys = df.select(*[q(c).cast("string").alias(f"k{i}") for i, c in enumerate(sources)])
    mask = reduce(
        lambda a, b: a + b, [F.when(F.col(f"k{i}").isNotNull(), 1 << i).otherwise(0) for i in range(len(sources))]
    )
    index = cut(keys.withColumn("mask", mask).where("mask > 0").select("mask", F.array(*keys.columns).alias("key")).distinct())
    masks = sorted(r["mask"] for r in index.select("mask").distinct().collect())  # at most 2**n - 1
    if not masks:
        return events.where(F.lit(False))
    values = [q(columns[c]).cast("string").alias(f"__e{i}") for i, c in enumerate(sources)]
    met = events.select(*values).distinct()
    nothing = F.lit(None).cast("string")

    def probe(m: int) -> Column:
        used = [i for i in range(len(sources)) if m & (1 << i)]
        whole = reduce(lambda a, b: a & b, [F.col(f"__e{i}").isNotNull() for i in used])
        key = F.array(*[F.col(f"__e{i}") if i in used else nothing for i in range(len(sources))])
        return F.when(whole, F.struct(F.lit(m).alias("mask"), key.alias("key")))

    probes = met.withColumn("__p", F.explode(F.array_compact(F.array(*[probe(m) for m in masks]))))
    hit = probes.select(*met.columns, "__p.mask", "__p.key").join(index, ["mask", "key"], "left_semi")
    hit = broadcast_if_small(hit.select(*met.columns).distinct())
    same = [q(columns[c]).cast("string").eqNullSafe(F.col(f"__e{i}")) for i, c in enumerate(sources)]
    return events.join(hit, reduce(lambda a, b: a & b, same), "left_semi")


def _pivot_to(
    df: DataFrame,
    events: DataFrame,
    table: str,
    pivot_map: dict[str, str] | None,
    earliest: str | None = None,
    time_column: str = "event_time_usec",
    now: datetime | None = None,
) -> DataFrame:
    events = time_range(events, time_column, earliest, now=now) if earliest else events
    if pivot_map is not None:
        missing = [c for c in pivot_map if c not in df.columns]
        if missing or not pivot_map:
            raise ValueError(f"pivot_map is empty or names missing columns: {missing}")
        return pivot(df, events, pivot_map)
    shared = [c for c in PIVOT_COLUMNS[table] if c in df.columns and c in events.columns]
    if not shared:
        raise ValueError(f"none of the pivot columns {PIVOT_COLUMNS[table]} exists")
    return pivot(df, events, {c: c for c in shared})


def process_pivot_netflow(
    df: DataFrame, netflow: DataFrame, pivot_map: dict[str, str] | None = None, **recent
) -> DataFrame:
    """Flows that match any row of ``df`` on the shared columns, or on those of ``pivot_map``.

    ``recent``: ``earliest`` (``1d``), ``time_column`` and ``now`` restrict the events in time, here and below.
    """
    return _pivot_to(df, netflow, "netflow", pivot_map, **recent)


def process_pivot_http(df: DataFrame, http: DataFrame, pivot_map: dict[str, str] | None = None, **recent) -> DataFrame:
    return _pivot_to(df, http, "http", pivot_map, **recent)


def process_pivot_auth(df: DataFrame, auth: DataFrame, pivot_map: dict[str, str] | None = None, **recent) -> DataFrame:
    return _pivot_to(df, auth, "auth", pivot_map, **recent)


def process_pivot_detectionfinding(
    df: DataFrame, findings: DataFrame, pivot_map: dict[str, str] | None = None, **recent
) -> DataFrame:
    return _pivot_to(df, findings, "detectionfinding", pivot_map, **recent)
