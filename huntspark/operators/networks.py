"""Network ranges of a tenant: uploads and their effect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_classify(existing: DataFrame, incoming: DataFrame, network_types: list[str]) -> DataFrame:
    """Incoming ranges with ``action`` update (``id`` of the known range) or create; unknown network types are dropped.

    A CIDR that is known under several ids updates the smallest one.
    """
    known = existing.groupBy(F.col("cidr").alias("__cidr")).agg(F.min("id").alias("id"))
    rows = incoming.where(F.col("network_type").isin(network_types))
    joined = rows.join(known, F.col("cidr") == F.col("__cidr"), "left").drop("__cidr")
    return joined.withColumn("action", F.when(F.col("id").isNull(), "create").otherwise("update"))


def upsert_merge(existing: DataFrame, incoming: DataFrame, network_types: list[str]) -> DataFrame:
    """The table after the upload: updated ranges by id, untouched ones, created ones (their ``id`` is null)."""
    classified = upsert_classify(existing, incoming, network_types)
    columns = existing.columns
    last = F.max(F.struct(*[c for c in columns if c != "id"])).alias("__row")
    updates = classified.where("action = 'update'").groupBy("id").agg(last).select("id", "__row.*")
    touched = updates.select(F.col("id").alias("__id"))
    kept = existing.join(touched, F.col("id") == F.col("__id"), "left_anti")
    created = classified.where("action = 'create'")
    return kept.select(*columns).unionByName(updates.select(*columns)).unionByName(created.select(*columns))
