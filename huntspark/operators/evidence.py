"""The evidence table: (evidence_type, id, tenant_id, investigation_id), unique by (id, investigation_id).

Each operator returns the new state of the table; the caller writes it to a new path
(``huntspark.sources.sinks.write_state``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.fixed import SEARCH_QUERIES
from huntspark.functions.names import evidence_id_column, q, tenant_id_column

COLUMNS = ["evidence_type", "id", "tenant_id", "investigation_id"]
KEY = ["id", "investigation_id"]


def incoming(df: DataFrame, evidence_type: str | Column | None = None, investigation: str | Column = "NEW") -> DataFrame:
    """Any frame with an id and a tenant as evidence rows; type and investigation are values or columns."""
    kind = evidence_type if evidence_type is not None else F.col("evidence_type")
    return df.select(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("evidence_type"),
        q(evidence_id_column(df)).cast("string").alias("id"),
        q(tenant_id_column(df)).cast("string").alias("tenant_id"),
        (F.lit(investigation) if isinstance(investigation, str) else investigation).alias("investigation_id"),
    )


def _one_per_key(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct("evidence_type", "tenant_id")).alias("__first")
    return rows.groupBy(*KEY).agg(first).select("__first.evidence_type", "id", "__first.tenant_id", "investigation_id")


def _matches(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    condition = a[names[0]] == b["__" + names[0]]
    for n in names[1:]:
        condition = condition & (a[n] == b["__" + n])
    return condition


def _keys(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[q(n).alias("__" + n) for n in names]).distinct()


def stage(evidence: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows whose key is not there yet. Of new rows with one key the smallest (type, tenant) stands."""
    known = _keys(evidence, KEY)
    new = _one_per_key(rows)
    fresh = new.join(known, _matches(new, known, KEY), "left_anti")
    return evidence.select(*COLUMNS).unionByName(fresh.select(*COLUMNS))


def unstage(evidence: DataFrame, rows: DataFrame) -> DataFrame:
    """Remove the rows that agree in id, type and investigation."""
    names = ["id", "evidence_type", "investigation_id"]
    gone = _keys(rows, names)
    return evidence.join(gone, _matches(evidence, gone, names), "left_anti").select(*COLUMNS)


def read_evidence(
    evidence: DataFrame,
    evidence_type: str | None = None,
    tenant_id: str | None = None,
    investigation_id: str | None = None,
) -> DataFrame:
    """Evidence that agrees with every given value."""
    wanted = {"evidence_type": evidence_type, "tenant_id": tenant_id, "investigation_id": investigation_id}
    for name, value in wanted.items():
        if value:
            evidence = evidence.where(F.col(name) == value)
    return evidence


def clear(
    evidence: DataFrame,
    evidence_type: str | None = None,
    tenant_id: str | None = None,
    investigation_id: str | None = None,
) -> DataFrame:
    """Evidence without the rows that agree with every given value; without any value, an empty table."""
    hit = F.lit(True)
    for name, value in [("evidence_type", evidence_type), ("tenant_id", tenant_id), ("investigation_id", investigation_id)]:
        if value:
            hit = hit & (F.col(name) == value)
    return evidence.where(~F.coalesce(hit, F.lit(False)))


def changes(before: DataFrame, after: DataFrame, action: str) -> DataFrame:
    """Rows before, after and the difference per type and investigation; one partial aggregation over both states."""
    both = before.select(*COLUMNS, F.lit(0).alias("__after")).unionByName(
        after.select(*COLUMNS, F.lit(1).alias("__after"))
    )
    counted = both.groupBy("evidence_type", "investigation_id").agg(
        F.count_if(F.col("__after") == 0).alias("before"), F.count_if(F.col("__after") == 1).alias("after")
    )
    return counted.select(
        F.lit(action).alias("action"),
        "evidence_type",
        "investigation_id",
        "before",
        "after",
        (F.col("after") - F.col("before")).alias("difference"),
    )


def investigation_evidence(
    evidence: DataFrame, tenant_id: str | None = None, investigation_id: str | None = None
) -> DataFrame:
    """Distinct (tenant_id, investigation_id, evidence_type, id), ready to attach.

    A type without evidence has no rows. Rows and not one list per type: a list of one investigation may not fit a row.
    """
    rows = read_evidence(evidence, tenant_id=tenant_id, investigation_id=investigation_id)
    return rows.select("tenant_id", "investigation_id", "evidence_type", "id").distinct()


def merge_investigations(
    investigations: DataFrame,
    evidence: DataFrame,
    merges: DataFrame,
    close_status: str = "CLOSED_INFORMATIONAL",
) -> tuple[DataFrame, DataFrame]:
    """New (investigations, evidence) after moving evidence along ``merges`` (source, target).

    Source and target must be OPEN or DRAFT and not archived, and the source not merged before; other pairs do nothing.
    A source goes to its smallest target, and a target that is itself a source is not used, so no chain arises.
    Evidence the target already has is not doubled; the source is renamed, closed and archived.
    """
    usable = F.col("status").isin("OPEN", "DRAFT") & ~F.col("archived")
    sources = investigations.where(usable & ~F.contains("title", F.lit("Merged Investigation"))).select(
        F.col("id").alias("__source")
    )
    targets = investigations.where(usable).select(F.col("id").alias("__target"))
    listed = merges.groupBy("source").agg(F.min("target").alias("target")).where("source <> target")
    pairs = listed.join(sources, F.col("source") == F.col("__source"), "left_semi").join(
        targets, F.col("target") == F.col("__target"), "left_semi"
    )
    busy = pairs.select(F.col("source").alias("__busy"))
    pairs = pairs.join(busy, F.col("target") == F.col("__busy"), "left_anti")

    moved = evidence.join(pairs, F.col("investigation_id") == F.col("source"), "left").withColumn(
        "__moved", F.col("target").isNotNull().cast("int")
    )
    moved = moved.withColumn("investigation_id", F.coalesce("target", "investigation_id"))
    first = F.min(F.struct("__moved", "evidence_type", "tenant_id")).alias("__first")
    new_evidence = moved.groupBy(*KEY).agg(first).select(
        "__first.evidence_type", "id", "__first.tenant_id", "investigation_id"
    )

    done = F.col("target").isNotNull()
    closed = investigations.join(pairs, F.col("id") == F.col("source"), "left").withColumns(
        {
            "status": F.when(done, close_status).otherwise(F.col("status")),
            "title": F.when(done, F.concat(F.lit("Merged Investigation: "), "title")).otherwise(F.col("title")),
            "archived": F.when(done, F.lit(True)).otherwise(F.col("archived")),
        }
    )
    return closed.select(*investigations.columns), new_evidence


# Tracked search queries ------------------------------------------------------------------------------------------


def track_queries(log: DataFrame, new: DataFrame) -> DataFrame:
    """The query log with ``new`` added; ids that are there already stay as they are."""
    known = _keys(log, ["id"])
    return log.unionByName(new.join(known, new["id"] == known["__id"], "left_anti"))


def untrack_queries(log: DataFrame, ids: DataFrame) -> DataFrame:
    gone = _keys(ids, ["id"])
    return log.join(gone, log["id"] == gone["__id"], "left_anti")


def stage_queries(evidence: DataFrame, log: DataFrame, investigation: str = "NEW") -> tuple[DataFrame, DataFrame]:
    """New (evidence, log): every tracked query as evidence, the log empty."""
    return stage(evidence, incoming(log, SEARCH_QUERIES, investigation)), log.where(F.lit(False))


def last_query(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The most recent query (largest id among equal times), per group if asked for."""
    newest = F.max_by("id", F.struct("inserted_time", "id")).alias("id")
    return log.groupBy(*(by or [])).agg(newest)
