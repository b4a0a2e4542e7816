"""Tenant search, tenant macros, results of many tenants."""

from __future__ import annotations

import json
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.names import q
from huntspark.functions.times import time_range


def tenant_search(
    tenants: DataFrame,
    *,
    name: str | None = None,
    ids: list[str] | None = None,
    region: str | None = None,
    services: list[str] | None = None,
    label_name: str | None = None,
    label_value: str | None = None,
    partner_subscriptions: list[str] | None = None,
    requested_services: list[str] | None = None,
    hierarchies: list[str] | None = None,
    created: tuple[str | None, str | None] = (None, None),
    modified: tuple[str | None, str | None] = (None, None),
    enabled: bool | None = None,
    sort_by: str | None = "id",
    ascending: bool = True,
) -> DataFrame:
    """Tenants that meet every given condition. ``name`` takes ``%`` wildcards or is a tenant id."""
    if label_value and not label_name:
        raise ValueError("label_value needs label_name")
    conditions: list[Column] = []
    if name:
        conditions.append(F.col("name").like(name) | (F.col("id").cast("string") == name))
    if ids:
        conditions.append(F.col("id").cast("string").isin(ids))
    if region:
        conditions.append(F.exists("environments", lambda e: (e["name"] == region) & e["enabled"]))
    for column, wanted in [
        ("services", services),
        ("partner_subscriptions", partner_subscriptions),
        ("requested_services", requested_services),
        ("hierarchies", hierarchies),
    ]:
        if wanted:
            conditions.append(F.arrays_overlap(F.col(column), F.array(*[F.lit(w) for w in wanted])))
    if label_name:
        conditions.append(
            F.exists(
                "labels",
                lambda e: (e["name"] == label_name) & ((e["value"] == label_value) if label_value else F.lit(True)),
            )
        )
    if enabled is not None:
        conditions.append(F.col("enabled") == enabled)
    out = reduce(lambda d, c: d.where(c), conditions, tenants)
    for column, (start, end) in [("created_at", created), ("modified_at", modified)]:
        if start or end:
            out = time_range(out, column, start, end)
    if sort_by:
        out = out.orderBy(q(sort_by).asc() if ascending else q(sort_by).desc())
    return out


def load_macros(path: str) -> dict[str, dict]:
    """Macro definitions ``{"macros": {name: {"services": [pattern, …]}}}`` from JSON (YAML where PyYAML is there)."""
    file = Path(path)
    if not file.exists():
        return {}
    text = file.read_text()
    if file.suffix == ".json":
        data = json.loads(text or "{}")
    else:
        try:
            import yaml
        except ImportError as exc:
            raise ValueError("YAML macros need PyYAML; use a .json file") from exc
        data = yaml.safe_load(text)
    return (data or {}).get("macros", {})


def _pattern(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return escaped.replace("*", "%")


def resolve_tenants(tenants: DataFrame, tenant: str | None, macros: dict[str, dict]) -> DataFrame:
    """Distinct ids (column ``id``) of a macro ``@name``: tenants with any service that fits any pattern.

    A plain id stands for itself; no tenant means all; a macro without services takes every tenant.
    """
    ids = tenants.select(F.col("id").cast("string").alias("id"))
    if tenant is None:
        return ids.distinct()
    if not tenant.startswith("@"):
        return tenants.sparkSession.createDataFrame([(tenant,)], "id string")
    if tenant[1:] not in macros:
        raise ValueError(f"unknown tenant macro {tenant}; there are {sorted(macros)}")
    patterns = [_pattern(s) for s in macros[tenant[1:]].get("services") or []]
    if not patterns:
        return ids.distinct()
    fits = F.exists("services", lambda s: reduce(lambda a, b: a | b, [s.like(p) for p in patterns]))
    return tenants.where(fits).select(F.col("id").cast("string").alias("id")).distinct()


def merge_results(results: dict[str, DataFrame]) -> DataFrame | None:
    """Results of several tenants as one frame, each row tagged ``_macro_tenant_id``; a single one stays untouched."""
    if not results:
        return None
    if len(results) == 1:
        return next(iter(results.values()))
    tagged = [df.withColumn("_macro_tenant_id", F.lit(t)) for t, df in results.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def merge_tenants(df: DataFrame, tenants: DataFrame) -> DataFrame:
    """The same for any number of tenants in one scan: rows of these tenants, tagged."""
    wanted = tenants.select(F.col("id").cast("string").alias("__t")).distinct()
    rows = df.join(wanted, df["tenant_id"].cast("string") == wanted["__t"], "left_semi")
    return rows.withColumn("_macro_tenant_id", F.col("tenant_id").cast("string"))
