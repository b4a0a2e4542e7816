"""Nested records to rows and columns. All but ``json_inventory`` are plain projections and explodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huntspark.functions.fixed import ALERTS, EVENTS, SEARCH_QUERIES
from huntspark.functions.names import DERIVED, coalesce_columns, first_present, flatten_struct, q, require
from huntspark.plans.lineage_cut import cut


def inflate(df: DataFrame, column: str, prefix: str, max_level: int | None = None, explode: bool = True) -> DataFrame:
    """One row per element of ``column`` with its fields as ``prefix``-ed columns next to the input columns.

    An empty or missing array keeps its row. Nothing happens where such columns exist already.
    """
    if any(c.startswith(prefix) for c in df.columns):
        return df
    require(df, column)
    if explode and isinstance(df.schema[column].dataType, T.ArrayType):
        df = df.withColumn(column, F.explode_outer(q(column)))
    fields = flatten_struct(df.select(q(column).alias("r")), max_level)
    new = []
    for name in fields.columns:
        path = name.split(".")[1:]
        value = reduce(lambda c, part: c.getField(part), path, q(column))
        bare = ".".join(path)
        new.append(value.alias(bare if bare.startswith(prefix) else prefix + bare))
    return df.select(*[q(c) for c in df.columns], *new)


def inflate_raw_events(df: DataFrame) -> DataFrame:
    """One row per event attached to an alert (``event_ids``), fields as ``event_data.*``."""
    return inflate(df, "event_ids", "event_data.")


def inflate_prompt_examples(df: DataFrame) -> DataFrame:
    """One row per prompt (``prompts``), fields as ``example.*``."""
    return inflate(df, "prompts", "example.")


def inflate_filters(df: DataFrame) -> DataFrame:
    """One row per filter of a rule (``filters``), fields as ``filters.*``, three levels deep."""
    if "filters.id" in df.columns:
        return df
    return inflate(df, "filters", "filters.", max_level=4)


def third_party_map(column: Column) -> Column:
    """``[{generic: {generic: {record: [{key, value}]}}}]`` as one map; of equal keys the last one stands.

    The pairs are sorted by key and place, and each is kept whose neighbour has another key."""
    pairs = F.flatten(F.transform(F.coalesce(column, F.array()), lambda d: d["generic"]["generic"]["record"]))
    placed = F.filter(F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), i.alias("place"), p["value"].alias("value"))), lambda p: p["key"].isNotNull())
    ordered = F.array_sort(placed)
    beside = F.arrays_zip(ordered.alias("own"), F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1))).alias("next"))
    last = F.filter(beside, lambda z: z["next"].isNull() | (z["next"]["key"] != z["own"]["key"]))
    return F.map_from_entries(F.transform(last, lambda z: F.struct(z["own"]["key"], z["own"]["value"])))


def third_party_keys(df: DataFrame) -> DataFrame:
    """(key, rows): every key of ``third_party_details`` and the rows that have it."""
    keys = df.select(F.explode(F.map_keys(third_party_map(q("third_party_details")))).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("rows"))


def inflate_third_party_details(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``third_party_details`` as columns ``third_party_details.<key>`` for the named keys; without names as one map column
    ``third_party_details.map``, however many keys there are. No job runs; ``third_party_keys`` counts the keys. Frames without the
    column come back unchanged.
    """
    if "third_party_details" not in df.columns:
        return df
    if keys is None:
        return df.withColumn("third_party_details.map", third_party_map(q("third_party_details")))
    mapped = df.withColumn("__map", third_party_map(q("third_party_details")))
    new = [F.element_at("__map", F.lit(k)).alias(f"third_party_details.{k}") for k in keys]
    return mapped.select(*[q(c) for c in df.columns], *new)


def _parsed(df: DataFrame, columns: list[str] | None) -> Column:
    return F.try_parse_json(coalesce_columns(df, columns or ["original_data", "event_data.original_data"]))


def json_inventory(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(path, type, rows): the paths of the JSON texts of a frame that lead to something else than an object, dotted, their types, and the
    texts that have them. Texts are parsed once; every level of nesting is one more explode, and the paths are counted where
    they are, so no schema of all texts is ever built. Paths under a null or an empty object are not listed."""
    level = cut(df.select(_parsed(df, columns).alias("v")).where("v is not null")).select(F.lit("").alias("path"), "v")
    spark, found = df.sparkSession, None
    while True:
        parts = spark.sql("select if(path = '', key, path || '.' || key) as path, value as v, schema_of_variant(value) as type from {level}, lateral variant_explode(v)", level=level)
        # an array is a value: what it holds has no path of its own
        parts = cut(parts.where("path is not null"))
        leaves = parts.where("type not like 'OBJECT<%'").groupBy("path", "type").agg(F.count("*").alias("rows"))
        found = leaves if found is None else found.unionByName(leaves)
        level = parts.where("type like 'OBJECT<%'").select("path", "v")
        if level.isEmpty():
            return found.where("type <> 'VOID'").groupBy("path", "type").agg(F.sum("rows").alias("rows"))


def inflate_original_data(
    df: DataFrame, schema: T.StructType | str | None = None, columns: list[str] | None = None, paths: dict[str, str] | None = None
) -> DataFrame:
    """JSON text of ``original_data`` as columns ``original_data.*``; unreadable text counts as empty.

    With ``paths`` (dotted path: type) or ``schema`` this is a projection of the named values out of texts that are parsed once.
    Without either, the paths are looked up first (``json_inventory``) and each becomes a column, a path with several types as
    text: name the paths where texts may have any number of them. A dot in a path always leads one level down.
    """
    if any(c.startswith("original_data.") for c in df.columns):
        return df
    parsed = _parsed(df, columns)
    if paths is None and schema is None:
        types = json_inventory(df, columns).groupBy("path").agg(F.min("type").alias("type"), F.count("*").alias("n")).collect()
        paths = {r.path: r.type if r.n == 1 and not r.type.startswith("ARRAY<OBJECT") else "STRING" for r in sorted(types)}
        if not paths:
            return df
    if paths is None:
        named = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        flat = flatten_struct(df.sparkSession.createDataFrame([], named), None)
        paths = {f.name: f.dataType.simpleString() for f in flat.schema.fields}
    root = df.withColumn("__json", parsed)

    def value(path: str, kind: str) -> Column:
        held, steps = F.col("__json"), "$"
        for part in path.split("."):
            if "'" in part and '"' in part:  # no path can name it
                inner = F.try_variant_get(held, steps, "map<string,variant>")
                held, steps = F.element_at(inner, F.lit(part)), "$"
            else:
                steps += f'["{part}"]' if "'" in part else f"['{part}']"
        return F.try_variant_get(held, steps, kind).alias("original_data." + path)

    return root.select(*[q(c) for c in df.columns], *[value(p, k) for p, k in paths.items()])


def inflate_schema_keys(df: DataFrame) -> DataFrame:
    """``scope.schema.key.more`` as ``x_schema`` and ``x_key``; text with too few parts reads ``Error``."""
    require(df, "key")
    parts = F.split(q("key").cast("string"), r"\.", 3)
    return df.withColumns(
        {
            DERIVED + "schema": F.coalesce(F.get(parts, F.lit(1)), F.lit("Error")),
            DERIVED + "key": F.coalesce(F.get(parts, F.lit(2)), F.lit("Error")),
        }
    )


def inflate_evidence(df: DataFrame) -> DataFrame:
    """Three evidence arrays as one long table with ``x_evidence_type`` and ``x_evidence_id``."""
    sources = [
        ("alerts_evidence", ALERTS, "alert_id"),
        ("events_evidence", EVENTS, "event_id"),
        ("search_queries_evidence", SEARCH_QUERIES, "search_query"),
    ]
    require(df, *[s[0] for s in sources])
    parts = []
    for column, kind, id_field in sources:
        rows = df.select(F.explode(q(column)).alias("r")).where("r is not null").select("r.*")
        parts.append(
            rows.withColumns({DERIVED + "evidence_type": F.lit(kind), DERIVED + "evidence_id": q(id_field).cast("string")})
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def environment_column(df: DataFrame, columns: list[str] | None) -> str:
    return first_present(df, columns or ["tenant.environments", "environments"], "environments")


def _named(name: str):
    return lambda element: element["name"] == name


def inflate_environments(df: DataFrame, names: list[str], columns: list[str] | None = None) -> DataFrame:
    """Per environment name: enabled (missing counts as false), created and updated time (missing stays null)."""
    source = environment_column(df, columns)
    new = []
    for name in names:
        entry = F.get(F.reverse(F.filter(q(source), _named(name))), F.lit(0))
        new += [
            F.coalesce(entry["enabled"], F.lit(False)).alias(f"{source}.{name}"),
            entry["created_at"].alias(f"{source}.{name}.created_at"),
            entry["updated_at"].alias(f"{source}.{name}.updated_at"),
        ]
    return df.select(*[q(c) for c in df.columns], *new)


def lookup_first_environment(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Name of the first enabled environment in list order, null if none."""
    return F.get(F.filter(q(environment_column(df, columns)), lambda e: e["enabled"]), F.lit(0))["name"]


def normalize_event_count_results(df: DataFrame) -> DataFrame:
    """Indicator counts with a list per tenant as one row per tenant."""
    if "counts_by_tenant" not in df.columns:
        return df
    flat = df.withColumn("counts_by_tenant", F.explode_outer("counts_by_tenant"))
    return flat.withColumns(
        {
            "counts_by_tenant.tenant_id": F.col("counts_by_tenant.tenant_id"),
            "counts_by_tenant.count": F.col("counts_by_tenant.count"),
        }
    )


def publication_reference(df: DataFrame, base: str, id_column: str = "id") -> DataFrame:
    """``x_reference``: the base address and the percent-encoded id (blank for a missing one)."""
    encoded = F.url_encode(F.coalesce(q(id_column).cast("string"), F.lit("")))
    for plain, wanted in [(r"\+", "%20"), ("%2F", "/"), ("%7E", "~"), (r"\*", "%2A")]:
        encoded = F.regexp_replace(encoded, plain, wanted)
    return df.withColumn(DERIVED + "reference", F.concat(F.lit(base), encoded))

