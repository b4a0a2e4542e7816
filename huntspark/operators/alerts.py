"""Alert operators: creators, facets, rows behind an aggregate, resolution."""

from __future__ import annotations

import re
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.names import DERIVED, first_present, flatten_struct, q, tenant_id_column
from huntspark.functions.severity import severity_rounded_and_category
from huntspark.functions.times import convert_alert_timestamps, time_range
from huntspark.operators.inflate import inflate_raw_events
from huntspark.plans.joins import broadcast_if_small, lookup_join
from huntspark.plans.numbering import number_within


def normalize_creator_name(df: DataFrame, detectors: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``x_creator_display_name``: name of the first detector (by ``ord``) of this creator, else the creator itself.

    ``detectors`` has ``creator_name``, ``display_name`` and ``ord``.
    """
    column = first_present(df, columns or ["creator", "metadata.creator.detector.detector_id"], "creator")
    names = detectors.groupBy(F.col("creator_name").alias("__creator")).agg(
        F.min_by("display_name", "ord").alias("__display")
    )
    joined = lookup_join(df, names, [(column, "__creator")])
    return joined.withColumn(DERIVED + "creator_display_name", F.coalesce("__display", q(column))).drop(
        "__creator", "__display"
    )


def aggregate_count(df: DataFrame, by: list[str]) -> DataFrame:
    """``aggregate count by …``: one row per combination, largest first where a limit follows."""
    return df.groupBy(*[q(c) for c in by]).agg(F.count("*").alias("count"))


def groupby(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts by the text form of those columns that exist; missing values are a group of their own."""
    present = [c for c in columns if c in df.columns]
    return df.groupBy(*[q(c).cast("string").alias(c) for c in present]).agg(F.count("*").alias("count"))


def get_facet(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts by those columns that exist, without rows that miss any of them; largest first."""
    present = [c for c in columns if c in df.columns]
    kept = df.dropna(subset=["`" + c + "`" for c in present])
    return aggregate_count(kept, present).orderBy(F.desc("count"), *[q(c) for c in present])


def get_alerts_from_aggregation(
    df: DataFrame,
    alerts: DataFrame,
    additional: list[Column] | None = None,
    limit: int | None = None,
    earliest: str | None = None,
    latest: str | None = None,
    time_column: str = "metadata.created_at.seconds",
    now: datetime | None = None,
) -> DataFrame:
    """The alerts behind aggregate rows: equal in every column but ``count`` and those that start with a digit.

    Values are compared as text and a missing value equals nothing; ``additional`` holds further conditions.
    """
    keys = [c for c in df.columns if c != "count" and re.match("[^0-9]", c)]
    if not keys:
        raise ValueError("the frame has no aggregate columns")
    wanted = df.select(*[q(c).cast("string").alias(f"__{i}") for i, c in enumerate(keys)]).distinct()
    wanted = broadcast_if_small(wanted)
    rows = time_range(alerts, time_column, earliest, latest, now) if earliest or latest else alerts
    rows = reduce(lambda d, condition: d.where(condition), additional or [], rows)
    match = reduce(
        lambda a, b: a & b,
        [rows["`" + c + "`"].cast("string") == wanted[f"__{i}"] for i, c in enumerate(keys)],
    )
    found = rows.join(wanted, match, "left_semi")
    return found.limit(limit) if limit is not None else found


def resolution_batches(df: DataFrame, status: str, reason: str, size: int = 250) -> DataFrame:
    """Distinct alert ids per tenant in numbered batches of ``size``, with the resolution to write."""
    tenant = first_present(df, ["tenant_id", "tenant.id"], "tenant id")
    ids = df.select(q(tenant).cast("string").alias("tenant_id"), q("id").alias("alert_id")).distinct()
    numbered = number_within(ids, "tenant_id", "alert_id", "__rn")
    return numbered.select(
        "tenant_id",
        "alert_id",
        F.floor((F.col("__rn") - 1) / size).cast("bigint").alias("batch"),
        F.lit(status).alias("resolution_status"),
        F.lit(reason).alias("reason"),
    )


def apply_resolution(alerts: DataFrame, resolved: DataFrame, status: str, reason: str) -> DataFrame:
    """``alerts`` with status and reason set where (tenant, id) is in ``resolved``."""
    tenant = tenant_id_column(alerts)
    done = resolved.select(
        q(tenant_id_column(resolved)).cast("string").alias("__tenant"), q("id").alias("__id"), F.lit(True).alias("__hit")
    ).distinct()
    joined = alerts.join(
        done, (alerts["`" + tenant + "`"].cast("string") == done["__tenant"]) & (alerts["id"] == done["__id"]), "left"
    )
    old_reason = q("resolution_reason") if "resolution_reason" in alerts.columns else F.lit(None).cast("string")
    return joined.withColumns(
        {
            "status": F.when(F.col("__hit"), status).otherwise(q("status")),
            "resolution_reason": F.when(F.col("__hit"), reason).otherwise(old_reason),
        }
    ).drop("__tenant", "__id", "__hit")


def triage(alerts: DataFrame, detectors: DataFrame) -> DataFrame:
    """The analyst's first look: nested alerts -> events, readable times, severity categories, creator names, counts.

    One lazy chain; the only shuffles are the small detector lookup and the final count.
    """
    chain = (
        flatten_struct(alerts, max_level=3)
        .transform(inflate_raw_events)
        .transform(convert_alert_timestamps)
        .transform(severity_rounded_and_category)
        .transform(normalize_creator_name, detectors)
    )
    return get_facet(
        chain,
        [
            "x_metadata_created_at_seconds",
            "x_creator_display_name",
            "metadata.title",
            "status",
            "x_severity_category",
            "event_data.resource_id",
        ],
    )
