"""Searches over stored tables. Conditions, time bounds and column lists reach the parquet scan."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from huntspark.functions.names import q, require
from huntspark.functions.times import time_range
from huntspark.operators.alerts import aggregate_count
from huntspark.plans.joins import broadcast_if_small


def _where(df: DataFrame, conditions: list[Column]) -> DataFrame:
    return reduce(lambda d, c: d.where(c), conditions, df)


def _equal(df: DataFrame, wanted: dict[str, object]) -> DataFrame:
    given = {k: v for k, v in wanted.items() if v is not None}
    require(df, *given)
    return _where(df, [q(k) == v for k, v in given.items()])


# Columns that tell rows apart where a limit cuts among rows of one time.
_IDS = ["id", "resource_id", "event_id", "audit_id", "alert_id"]


def _first(df: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The first rows in this order, then by what ids there are, so that a search gives the same rows again."""
    keys = [*order, *[q(c) for c in _IDS if c in df.columns]]
    return (df.orderBy(*keys) if keys else df).limit(limit)


def search_alerts(
    alerts: DataFrame,
    where: list[Column] | None = None,
    earliest: str | None = None,
    latest: str | None = None,
    time_column: str = "metadata.created_at.seconds",
    tenants: list[str] | None = None,
    aggregate: list[str] | None = None,
    limit: int | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Alert search: conditions, time range, tenants as one ``IN``; ``aggregate`` counts instead of listing rows.

    ``limit`` is a page size, of the earliest rows, and never cuts an aggregate; without one every row is listed.
    """
    out = _where(alerts, where or [])
    if earliest or latest:
        out = time_range(out, time_column, earliest, latest, now)
    if tenants:
        out = out.where(q("tenant_id").isin(tenants))
    if aggregate:
        return aggregate_count(out, aggregate)
    if limit is None:
        return out
    return _first(out, limit, *[q(c) for c in [time_column] if c in out.columns])


def search_events(
    events: DataFrame,
    schema: str | None = None,
    where: list[Column] | None = None,
    earliest: str | None = None,
    latest: str | None = None,
    time_column: str = "event_time_usec",
    limit: int | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Event search in ascending time. With a limit Spark keeps the first rows per task instead of sorting everything."""
    out = events if schema is None else events.where(q("schema") == schema)
    out = _where(out, where or [])
    if earliest or latest:
        out = time_range(out, time_column, earliest, latest, now)
    return out.orderBy(q(time_column)) if limit is None else _first(out, limit, q(time_column))


def rows_by_id(df: DataFrame, ids: list[str] | DataFrame, column: str = "resource_id") -> DataFrame:
    """Rows with one of the ids: a short list becomes ``IN``, a frame of ids (its first column) a semi join."""
    if isinstance(ids, DataFrame):
        wanted = broadcast_if_small(ids.select(q(ids.columns[0]).alias("__id")).distinct())
        return df.join(wanted, df["`" + column + "`"] == wanted["__id"], "left_semi")
    return df.where(q(column).isin(list(ids)))


def assets_by_host(assets: DataFrame, hosts: list[str] | DataFrame) -> DataFrame:
    return rows_by_id(assets, hosts, "host_id")


def alert_history(history: DataFrame, alert_id: str) -> DataFrame:
    return history.where(q("alert_id") == alert_id)


def search_audits(
    audits: DataFrame,
    search_by_all: str | None = None,
    before: str | None = None,
    after: str | None = None,
    sort_by: str | None = None,
    ascending: bool = True,
    limit: int | None = None,
    time_column: str = "event_time",
    **equal: object,
) -> DataFrame:
    """Audits equal in every given field; ``search_by_all`` must occur in some text column."""
    out = _equal(audits, equal)
    if search_by_all:
        texts = [name for name, kind in out.dtypes if kind == "string"]
        out = out.where(reduce(lambda a, b: a | b, [F.coalesce(F.contains(q(t), F.lit(search_by_all)), F.lit(False)) for t in texts]))
    if before or after:
        out = time_range(out, time_column, after, before)
    order = [q(sort_by).asc() if ascending else q(sort_by).desc()] if sort_by else []
    if limit is not None:
        return _first(out, limit, *order)
    return out.orderBy(*order) if order else out


def audit_event_names(audits: DataFrame, application: str) -> DataFrame:
    return audits.where(q("application") == application).select("event_name").distinct()


def rules_filter(
    rules: DataFrame,
    rule_type: str | None = None,
    kind: str | None = None,
    event_type: str | None = None,
    rule_id: object = None,
    deleted: bool | None = False,
) -> DataFrame:
    """Rules by type, suppression kind, event type, id; deleted ones only if asked for (``None``: all)."""
    wanted = {"rule_type": rule_type, "kind": kind, "event_type": event_type, "rule_id": rule_id}
    out = _equal(rules, wanted)
    return out if deleted is None else out.where(q("deleted") == deleted)


def rules_changes_since(rules: DataFrame, since: str, event_type: str | None = None) -> DataFrame:
    return time_range(_equal(rules, {"event_type": event_type}), "updated_at", since)


def rule_search(rules: DataFrame, text: str, column: str = "name") -> DataFrame:
    return rules.where(F.contains(q(column), F.lit(text)))


def latest_publications(publications: DataFrame, n: int, order: str = "published") -> DataFrame:
    """The ``n`` newest publications, ties by id."""
    return publications.orderBy(q(order).desc(), q("id")).limit(n)


def publications_by_term(publications: DataFrame, term: str, columns: tuple[str, ...] = ("name", "content")) -> DataFrame:
    present = [c for c in columns if c in publications.columns]
    return publications.where(reduce(lambda a, b: a | b, [F.contains(F.lower(q(c)), F.lit(term.lower())) for c in present]))


def watchlist(indicators: DataFrame, kind: str) -> DataFrame:
    return indicators.where(q("type") == kind)


def search_users(
    users: DataFrame,
    emails: list[str] | None = None,
    roles: list[str] | None = None,
    status: str | None = None,
    tenant_status: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """Users; of the email terms the first with ``%`` is a pattern and makes all others void."""
    out = _equal(users, {"status": status, "tenant_status": tenant_status})
    if emails:
        patterns = [e for e in emails if "%" in e]
        out = out.where(q("email").like(patterns[0]) if patterns else q("email").isin(emails))
    if roles:
        out = out.where(F.arrays_overlap(q("role_ids"), F.array(*[F.lit(r) for r in roles])))
    if name:
        out = out.where(F.contains(F.concat_ws(" ", "given_name", "family_name"), F.lit(name)))
    return out


def search_clients(
    clients: DataFrame, name: str | None = None, ids: list[str] | None = None, roles: list[str] | None = None
) -> DataFrame:
    out = _equal(clients, {"name": name})
    if ids:
        out = out.where(q("client_id").isin(ids))
    if roles:
        out = out.where(F.arrays_overlap(q("roles"), F.array(*[F.lit(r) for r in roles])))
    return out


def search_investigations(
    investigations: DataFrame, where: list[Column] | None = None, limit: int | None = None
) -> DataFrame:
    out = _where(investigations, where or [])
    return out if limit is None else _first(out, limit)


def result_totals(df: DataFrame, by: list[str], total: str | None = None) -> DataFrame:
    """Rows returned per group and the reported total, -1 where unknown."""
    known = F.coalesce(F.max(q(total)), F.lit(-1)).cast("bigint") if total else F.lit(-1).cast("bigint")
    return df.groupBy(*[q(c) for c in by]).agg(F.count("*").alias("results_returned"), known.alias("total_results"))


def find_dataframe(spark: SparkSession, reference: str) -> DataFrame:
    """A JSON file as a frame: JSON lines, or one document where the file ends in ``.json``."""
    return spark.read.option("multiLine", reference.endswith(".json")).json(reference)


def read_network_ranges(spark: SparkSession, path: str) -> DataFrame:
    schema = "cidr string, description string, is_critical boolean, network_type string"
    return spark.read.option("header", True).schema(schema).csv(path)


def network_ranges(networks: DataFrame, tenant: str) -> DataFrame:
    return networks.where(q("tenant_id").cast("string") == tenant)


def repeatable_sample(df: DataFrame, n: int, id_column: str, seed: int = 0) -> DataFrame:
    """``n`` rows in an order fixed by the id and the seed."""
    shuffled = F.md5(F.concat(q(id_column).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return df.orderBy(shuffled, q(id_column)).limit(n)
