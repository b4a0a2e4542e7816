"""Indicator sweeps over many tenants, threat publications, logical columns of events."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.fixed import DOMAIN_COLUMNS, HASH_COLUMNS, IP_COLUMNS
from huntspark.functions.indicators import event_schema, is_domain, is_hash, is_ip_address, logical
from huntspark.functions.names import q, require
from huntspark.operators.inflate import inflate_raw_events, lookup_first_environment
from huntspark.plans.joins import broadcast_if_small
from huntspark.plans.lineage_cut import cut

LOGICALS = {"ip": IP_COLUMNS, "domain": DOMAIN_COLUMNS, "hash": HASH_COLUMNS}
SEARCHES: dict[str, Callable[[Column], Column]] = {"domain": is_domain, "hash": is_hash, "ip": is_ip_address}


def indicator_table(values: DataFrame, column: str = "value", fqdn: bool = False) -> DataFrame:
    """(value, logical_type) of the valid indicators of a list, each once; anything else is left out. ``fqdn`` takes host names of
    more than two labels."""
    checks = SEARCHES | ({"domain": lambda v: is_domain(v, fqdn=True)} if fqdn else {})
    typed = [
        values.where(check(q(column))).select(q(column).alias("value"), F.lit(kind).alias("logical_type"))
        for kind, check in checks.items()
    ]
    return reduce(DataFrame.unionByName, typed).distinct()


def _tag(kind: str) -> Callable[[Column], Column]:
    return lambda value: F.struct(value.alias("value"), F.lit(kind).alias("kind"))


def ioc_sweep(
    events: DataFrame,
    iocs: DataFrame,
    as_of: date,
    days: int = 30,
    logical_types: list[str] | None = None,
    tenants: DataFrame | None = None,
) -> DataFrame:
    """Events per (event_type, date, matching_value, logical_type, tenant_id) that hold an indicator.

    ``events`` has ``event_type``, ``tenant_id``, ``date`` and one array ``logicals.<type>`` per logical type. The
    window is the ``days`` + 1 days that end the day before ``as_of``. ``tenants`` (``id``) restricts the sweep.
    An event counts once per value. The indicators are measured and, if they are few enough, sent to the events, which
    then are not shuffled at all; counting is partial in every task, so an indicator found in a third of all events is
    not a hot spot.
    """
    first, last = as_of - timedelta(days=days + 1), as_of - timedelta(days=1)
    window = events.where(q("date").between(F.lit(first), F.lit(last)))
    if tenants is not None:
        window = window.join(
            tenants.select(q("id").cast("string").alias("__tenant")).distinct(),
            F.col("tenant_id") == F.col("__tenant"),
            "left_semi",
        )
    kinds = [k for k in (logical_types or list(SEARCHES)) if f"logicals.{k}" in events.columns]
    held = F.flatten(
        F.array(
            *[
                F.transform(F.array_distinct(q(f"logicals.{k}")), _tag(k))
                for k in kinds
            ]
        )
    )
    found = window.select("event_type", "date", "tenant_id", F.explode(held).alias("h")).select(
        "event_type", "date", "tenant_id", F.col("h.value").alias("matching_value"), F.col("h.kind").alias("logical_type")
    )
    wanted = broadcast_if_small(
        iocs.select(F.col("value").alias("__value"), F.col("logical_type").alias("__kind")).distinct()
    )
    hits = found.join(
        wanted, (F.col("matching_value") == F.col("__value")) & (F.col("logical_type") == F.col("__kind")), "left_semi"
    )
    return hits.groupBy("event_type", "date", "matching_value", "logical_type", "tenant_id").agg(
        F.count("*").alias("count")
    )


def ioc_sweep_regions(
    events: DataFrame, iocs: DataFrame, tenants: DataFrame, as_of: date, days: int = 30
) -> DataFrame:
    """The sweep over all tenants at once, with the ``region`` (first enabled environment) of each tenant."""
    if "first_environment" not in tenants.columns:
        tenants = tenants.withColumn("first_environment", lookup_first_environment(tenants))
    regions = tenants.where("first_environment is not null").select(
        q("id").cast("string").alias("__tenant"), F.col("first_environment").alias("region")
    ).distinct()
    counts = ioc_sweep(events, iocs, as_of, days, tenants=regions.select(F.col("__tenant").alias("id")))
    return counts.join(regions, F.col("tenant_id") == F.col("__tenant")).drop("__tenant")


def multi_search(events: DataFrame, searches: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Union of several searches over the same events; columns may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s(events) for s in searches])


def with_findings(tenants: DataFrame, findings: DataFrame) -> DataFrame:
    hit = findings.select(q("tenant_id").cast("string").alias("__t")).distinct()
    return tenants.join(hit, tenants["id"].cast("string") == hit["__t"], "left_semi")


def null_findings(tenants: DataFrame, findings: DataFrame) -> DataFrame:
    hit = findings.select(q("tenant_id").cast("string").alias("__t")).distinct()
    return tenants.join(hit, tenants["id"].cast("string") == hit["__t"], "left_anti")


def read_indicators(spark, path: str) -> DataFrame:
    """One indicator per line, blank lines ignored; an empty list is an error."""
    lines = spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''")
    if lines.isEmpty():
        raise ValueError(f"no indicators in {path}")
    return lines


def add_logicals(df: DataFrame) -> DataFrame:
    """Arrays ``logicals.ip``, ``logicals.domain`` and ``logicals.hash`` per event, by the schema named in its resource id.

    Alerts with attached events are inflated first. Values are distinct and without nulls, in column order.
    """
    prefix = ""
    if "event_ids" in df.columns:
        df, prefix = inflate_raw_events(df), "event_data."
    if prefix + "resource_id" not in df.columns:
        return df
    resource = q(prefix + "resource_id")
    empty = F.array().cast("array<string>")
    new = {}
    for kind, mapping in LOGICALS.items():
        chain = None
        for name, columns in mapping.items():
            values = logical(df, [prefix + c for c in columns])
            here = event_schema(resource) == name
            chain = F.when(here, values) if chain is None else chain.when(here, values)
        new[f"logicals.{kind}"] = chain.otherwise(empty)
    return df.withColumns(new)


def indicator_set(df: DataFrame) -> DataFrame:
    """Every distinct value in the ``logicals.*`` arrays (column ``indicator``)."""
    arrays = [q(c) for c in df.columns if c.startswith("logicals.")]
    return df.select(F.explode(F.array_distinct(F.flatten(F.array(*arrays)))).alias("indicator")).distinct()


def add_threat_intel(df: DataFrame, correlations: list[Callable[[DataFrame, DataFrame], DataFrame]]) -> DataFrame:
    """Logical arrays, then each correlation ``f(df, indicators) -> df`` in turn."""
    df = add_logicals(df)
    if not any(c.startswith("logicals.") for c in df.columns):
        return df
    indicators = indicator_set(df)
    return reduce(lambda d, f: f(d, indicators), correlations, df)


def publication_matches(df: DataFrame, publications: DataFrame, id_column: str) -> DataFrame:
    """(row id, indicator) for every indicator of a row that some publication (``indicator``, ``publication_id``) names.

    The publications of an indicator stay in their own table: a popular indicator's list is not repeated per row.
    """
    arrays = [q(c) for c in df.columns if c.startswith("logicals.")]
    require(df, id_column)
    held = df.select(q(id_column), F.explode(F.array_distinct(F.flatten(F.array(*arrays)))).alias("indicator"))
    named = publications.select(F.col("indicator").alias("__i")).distinct()
    return held.join(named, F.col("indicator") == F.col("__i"), "left_semi").distinct()


def get_ti_pubs(df: DataFrame, publications: DataFrame, id_column: str) -> DataFrame:
    """``tips.found``, ``tips.indicators`` (matching indicators) and ``tips.publications`` (distinct publications that name one
    of them) per row.

    Publications are counted per indicator before the join, so an indicator has one row on that side; where it fills
    the other side, adaptive execution splits it. Only the distinct sets of several indicators meet the publications
    themselves, for these may name more than one of a set.
    """
    per_indicator = publications.groupBy(F.col("indicator").alias("__i")).agg(
        F.count_distinct("publication_id").alias("__pubs")
    )
    arrays = [q(c) for c in df.columns if c.startswith("logicals.")]
    held = df.select(q(id_column), F.explode(F.array_distinct(F.flatten(F.array(*arrays)))).alias("indicator"))
    joined = held.distinct().join(per_indicator, F.col("indicator") == F.col("__i"))
    per_row = joined.groupBy(q(id_column).alias("__row")).agg(
        F.count("*").alias("__indicators"), F.max("__pubs").alias("__most"), F.sort_array(F.collect_list("indicator")).alias("__set")
    )
    named = publications.select(F.col("indicator").alias("__i"), "publication_id").distinct()
    per_set = (
        per_row.where("__indicators > 1").select("__set").distinct().select("__set", F.explode("__set").alias("__x"))
        .join(named, F.col("__x") == F.col("__i")).groupBy("__set").agg(F.count_distinct("publication_id").alias("__several"))
    )
    per_row = per_row.join(per_set, "__set", "left").select("__row", "__indicators", F.coalesce("__several", "__most").alias("__publications"))
    out = df.join(per_row, df["`" + id_column + "`"] == per_row["__row"], "left")
    return out.withColumns(
        {
            "tips.found": F.col("__indicators").isNotNull(),
            "tips.indicators": F.coalesce("__indicators", F.lit(0)),
            "tips.publications": F.coalesce("__publications", F.lit(0)),
        }
    ).drop("__row", "__indicators", "__publications")


def row_publications(df: DataFrame, publications: DataFrame, id_column: str) -> DataFrame:
    """(row id, publication_id, indicators) for every publication that names an indicator of a row, and how many of them.

    One row per pair, never a list: a popular indicator may have any number of publications and rows. Rows with the same indicators,
    and publications with the same ones, are compared once: only different sets are joined by indicator and counted. The pairs
    themselves come out of the last join, which adaptive execution splits on either side, and are not aggregated.
    """
    arrays = [q(c) for c in df.columns if c.startswith("logicals.")]
    require(df, id_column)
    held = df.select(q(id_column).alias("__id"), F.explode(F.array_distinct(F.flatten(F.array(*arrays)))).alias("indicator")).distinct()
    named = publications.select("indicator", "publication_id").distinct()
    known = held.join(named.select("indicator").distinct(), "indicator", "left_semi")
    rows, row_sets = _by_set(known, "__id", "__a")
    texts, text_sets = _by_set(named, "publication_id", "__b")
    met = row_sets.join(text_sets.hint("merge"), "indicator").groupBy("__a", "__b").agg(F.count("*").alias("indicators"))
    pairs = rows.join(met.hint("merge"), "__a").join(texts.hint("merge"), "__b")
    return pairs.select(F.col("__id").alias(id_column), "publication_id", "indicators")


def _by_set(held: DataFrame, key: str, number: str) -> tuple[DataFrame, DataFrame]:
    """Of distinct (key, indicator): each key with the number of its set of indicators, and the indicators of every numbered set."""
    sets = cut(held.groupBy(key).agg(F.sort_array(F.collect_list("indicator")).alias("__set")).where(F.size("__set") > 0))
    numbered = cut(sets.select("__set").distinct().withColumn(number, F.monotonically_increasing_id()))
    keyed = sets.join(numbered.hint("merge"), "__set").select(key, number)
    return keyed, numbered.select(number, F.explode("__set").alias("indicator"))
