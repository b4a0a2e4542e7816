"""Enrichment from tenant, user, asset and evidence tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.functions.fixed import ALERTS, EVENTS, SEARCH_QUERIES
from huntspark.functions.names import (
    DERIVED,
    first_present,
    get_tenant_id,
    host_id_column,
    prefix_columns,
    q,
    require,
    suffix_clashes,
    tenant_id_column,
)
from huntspark.plans.joins import lookup_join


def lookup_tenants(df: DataFrame, tenants: DataFrame, column: str | None = None) -> DataFrame:
    """Tenant columns with the prefix ``tenant.``; clashing ones get the suffix ``.lookup_tenants``."""
    column = column or tenant_id_column(df)
    require(df, column)
    if any(c.startswith("tenant.") and c != "tenant.id" for c in df.columns):
        return df
    keyed = prefix_columns(tenants.withColumn("id", q("id").cast("string")), "tenant.").withColumn("__id", q("tenant.id"))
    right = suffix_clashes(keyed, df, ".lookup_tenants")
    left = df.withColumn("__tenant_key", q(column).cast("string"))  # ids may be numbers in one table and text in the other
    return lookup_join(left, right, [("__tenant_key", "__id")]).drop("__id", "__tenant_key")


def lookup_users(
    df: DataFrame,
    users: DataFrame,
    user_id_columns: list[str] | None = None,
    merge_ons: list[str] | None = None,
) -> DataFrame:
    """User columns for each id column, prefixed ``<column>.user.``, matched on the first key that fits.

    A value is looked up under ``id``; only if no user has it there, under ``idp_user_id``, then ``user_id``. All keys
    become one lookup table with a priority, of which the best priority of a value is kept, so each id column costs
    one join. Users that share a key all match, as in a merge.
    """
    columns = [c for c in (user_id_columns or ["created_by", "updated_by"]) if c in df.columns]
    keys = merge_ons or ["id", "idp_user_id", "user_id"]
    keyed = users.withColumn(
        "__k",
        F.explode(F.array(*[F.struct(q(k).cast("string").alias("value"), F.lit(i).alias("rank")) for i, k in enumerate(keys)])),
    ).withColumns({"__value": F.col("__k.value"), "__rank": F.col("__k.rank")})
    keyed = keyed.where("__value is not null").drop("__k")
    best = keyed.groupBy(F.col("__value").alias("__v")).agg(F.min("__rank").alias("__r"))
    table = keyed.join(best, (keyed["__value"] == best["__v"]) & (keyed["__rank"] == best["__r"])).drop(
        "__v", "__r", "__rank"
    )
    for column in columns:
        prefix = f"{column}.user."
        if any(c.startswith(prefix) and c != prefix + "id" for c in df.columns):
            continue
        right = table.select(
            F.col("__value").alias("__lookup"), *[q(c).alias(prefix + c) for c in users.columns]
        )
        df = lookup_join(df, suffix_clashes(right, df, ".lookup_users"), [(column, "__lookup")]).drop("__lookup")
    return df


def lookup_assets(df: DataFrame, assets: DataFrame, by_host_only: bool = False) -> DataFrame:
    """Asset columns with the prefix ``asset_info.`` for (tenant, host); ``hostname`` is the first known one or N/A.

    ``by_host_only`` leaves the tenant out of the match.
    """
    host = host_id_column(df)
    tenant = first_present(df, ["tenant_id", "tenant.id"], "tenant id")
    if "hostnames" in assets.columns:
        first = F.get(q("hostnames"), F.lit(0))["hostname"]
        assets = assets.withColumn("hostname", F.coalesce(first, F.lit("N/A")))
    right = prefix_columns(assets.withColumn("__tenant", get_tenant_id(assets, "tenant_id")), "asset_info.")
    right = right.withColumnRenamed("asset_info.__tenant", "__tenant").withColumn("__host", q("asset_info.host_id"))
    keyed = df.withColumn("__df_tenant", get_tenant_id(df, tenant))
    pairs = [(host, "__host")] + ([] if by_host_only else [("__df_tenant", "__tenant")])
    return lookup_join(keyed, right, pairs).drop("__tenant", "__host", "__df_tenant")


def lookup_evidence(df: DataFrame, alerts: DataFrame, events: DataFrame, queries: DataFrame) -> DataFrame:
    """Details of each piece of evidence from the table of its type, prefixed ``alert.``, ``event.``, ``query.``.

    The lookup tables are keyed by ``id``. Type and id form one key, so evidence of another type never matches.
    """
    kind, id_ = DERIVED + "evidence_type", DERIVED + "evidence_id"
    require(df, kind, id_)

    def attach(out: DataFrame, spec: tuple[str, DataFrame, str]) -> DataFrame:
        name, table, prefix = spec
        right = prefix_columns(table, prefix).withColumn("__id", q(prefix + "id").cast("string"))
        keyed = out.withColumn("__key", F.when(q(kind) == name, q(id_)))
        return lookup_join(keyed, right, [("__key", "__id")]).drop("__key", "__id")

    return reduce(
        attach, [(ALERTS, alerts, "alert."), (EVENTS, events, "event."), (SEARCH_QUERIES, queries, "query.")], df
    )
