"""Process trees. A process is (host_id, process_correlation_id); a row may also name its parent's correlation id. Where both sides
have ``resource_id``, an asked row that has one means the record of the process with this resource. A step of a tree is a record:
a struct of all columns of the process table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from huntspark.functions.names import q, require
from huntspark.plans.joins import expand_left_join, lookup_join, split_hot_join
from huntspark.plans.lineage_cut import cut

HOST, KEY, PARENT, OPTIONAL = "host_id", "process_correlation_id", "parent_correlation_id", "resource_id"
KEYS = [HOST, KEY]
LINEAGE, CHILDREN, PARENT_INFO = "process_info.process_lineage", "process_info.process_children", "process_info.parent"


def lineage_keys(df: DataFrame) -> DataFrame:
    """The distinct processes a frame asks for: required keys present, ``resource_id`` kept where it exists."""
    require(df, *KEYS)
    names = KEYS + [c for c in [OPTIONAL] if c in df.columns]
    return df.select(*[q(c) for c in names]).dropna(subset=KEYS).distinct()


def assert_max_unmatched(df: DataFrame, column: str, rate: float | None = 0.05) -> DataFrame:
    """``df`` if at most ``rate`` of its rows lack ``column``; one aggregation job."""
    if rate is not None:
        share = df.agg(F.avg(q(column).isNull().cast("int")).alias("r")).first().r or 0.0
        if share > rate:
            raise RuntimeError(f"{share:.1%} of the rows have no {column}, more than {rate:.1%}")
    return df


def unmatched_rate(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    return df.groupBy(*[q(c) for c in by]).agg(
        F.count("*").alias("rows"), F.count_if(q(column).isNull()).alias("unmatched")
    )


def _record(processes: DataFrame) -> Column:
    return F.struct(*[q(c) for c in processes.columns])


def _resource(df: DataFrame, known: DataFrame) -> Column:
    """A key part that is never null: the resource a row names, or nothing."""
    if OPTIONAL in df.columns and OPTIONAL in known.columns:
        return F.coalesce(F.concat(F.lit("="), q(OPTIONAL).cast("string")), F.lit(""))
    return F.lit("")


def process_records(processes: DataFrame) -> DataFrame:
    """(host, node, anc, record): one record for each process, the one with the smallest parent (null last)."""
    sortable = [f.name for f in processes.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = F.struct(q(PARENT).isNull(), q(PARENT), F.xxhash64(*[q(c) for c in sortable]))
    best = processes.groupBy(q(HOST).alias("host"), q(KEY).alias("node")).agg(F.min_by(_record(processes), order).alias("record"))
    return best.select("host", "node", F.col("record")[PARENT].alias("anc"), "record")


def ancestor_tables(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame, int]:
    """Of ``nodes`` (host, node, anc): tables (host, node, anc) that lead 1, 2, 4, … steps up, and (host, node, anc, depth).

    Pointer jumping: table k is made from table k - 1 joined to itself, so a chain of depth d costs log2(d) joins and not d. A
    node that a table can't lead up has its depth settled by the same join: 2**k and what the node it was led to has. Every
    table is written to the checkpoint folder. A parent with very many children is split.

    Ids are used again, so parents may run in a circle. Depths are met without a gap; once a round settles none, all
    that is left leads into circles. After as many steps as such nodes exist exactly the processes of circles are reached;
    these count as processes without a parent, so chains end at the first of them, and all other chains stay whole.
    """
    size = nodes.count()
    known = nodes.select(F.col("host").alias("__h"), F.col("node").alias("__n"))
    first = cut(split_hot_join(nodes.select("host", "node", "anc"), known, [("host", "__h"), ("anc", "__n")], at_most=size).select("host", "node", "anc"))
    while True:
        jumps, table, ended = [], first, None
        left = first.count()
        depths = nodes.select("host", "node").join(first.select("host", "node"), ["host", "node"], "left_anti").withColumn("depth", F.lit(0).cast("long"))
        while left:
            jumps.append(table)
            up = cut(_up(table, table, size, "left"))
            settled = up.where("__a is null").select("host", "node", F.col("anc").alias("__at"))
            before = depths.select(F.col("host").alias("__h"), F.col("node").alias("__n"), F.col("depth").alias("__d"))
            more = split_hot_join(settled, before, [("host", "__h"), ("__at", "__n")], at_most=size)
            table = up.where("__a is not null").select("host", "node", F.col("__a").alias("anc"))
            now = table.count()
            if now == left and 1 << len(jumps) > left:
                ended = table.select(F.col("host").alias("__h"), F.col("anc").alias("__n")).distinct()
                break
            depths = cut(depths.unionByName(more.select("host", "node", (F.col("__d") + (1 << len(jumps) - 1)).alias("depth")))) if now < left else depths
            left = now
        if ended is None:
            linked = nodes.select("host", "node").join(first, ["host", "node"], "left")
            return jumps, cut(linked.join(depths, ["host", "node"])), size
        in_circle = (F.col("host") == F.col("__h")) & (F.col("node") == F.col("__n"))
        first = cut(first.join(ended, in_circle, "left_anti"))


def _up(rows: DataFrame, jump: DataFrame, at_most: int, how: str = "inner") -> DataFrame:
    """``rows`` whose ancestor can be left by ``jump``, with the ancestor it leads to as ``__a``."""
    target = jump.select(F.col("host").alias("__h"), F.col("node").alias("__n"), F.col("anc").alias("__a"))
    return split_hot_join(rows, target, [("host", "__h"), ("anc", "__n")], how, at_most=at_most).drop("__h", "__n")


def ancestors(processes: DataFrame, keys: DataFrame) -> DataFrame:
    """(host_id, process_correlation_id, __resource, steps, index, record) for every asked process and each of its ancestors, itself being
    0 steps away and the farthest ancestor having index 0.

    Only hosts that are asked for are read. A distance is a sum of powers of two in exactly one way, hence applying the jump
    tables from long to short adds every ancestor once. The index of a step is the depth of its process, which it has whoever
    asks, so no chain is sorted or counted.
    """
    start = cut(keys.select(q(HOST).alias("host"), q(KEY).alias("key"), _resource(keys, processes).alias("res")).distinct())
    hosts = start.select(F.col("host").alias("__asked")).distinct()
    held = processes.where(q(HOST).isNotNull() & q(KEY).isNotNull()).join(hosts, q(HOST) == F.col("__asked"), "left_semi")
    nodes = cut(process_records(held))
    jumps, known, size = ancestor_tables(nodes)

    # the records that are asked for, and the process each leads up to
    plain = start.where("res = ''").join(known, (start["host"] == known["host"]) & (start["key"] == known["node"]))
    plain = plain.select(start["host"], "key", "res", F.lit(0).cast("long").alias("steps"), F.col("node").alias("anc"))
    if OPTIONAL in held.columns:
        sortable = F.xxhash64(*[q(f.name) for f in held.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
        named = held.groupBy(q(HOST).alias("__h"), q(KEY).alias("__n"), _resource(held, held).alias("__r")).agg(F.min_by(_record(held), sortable).alias("record"))
        exact = (F.col("host") == F.col("__h")) & (F.col("key") == F.col("__n")) & (F.col("res") == F.col("__r"))
        own = start.where("res <> ''").join(named, exact).select("host", "key", "res", "record")
        kept = nodes.join(known, ["host", "node"]).select(F.col("host").alias("__h"), F.col("node").alias("__n"), F.col("record")[PARENT].alias("__p"), known["anc"].alias("__l"))
        own = own.join(kept, (F.col("host") == F.col("__h")) & (F.col("key") == F.col("__n")))
        own = own.withColumn("anc", F.when(F.col("record")[PARENT].eqNullSafe(F.col("__p")), F.col("__l")).otherwise(F.col("record")[PARENT]))
        own = cut(own.select("host", "key", "res", "record", "anc"))
        above = own.join(known.select(F.col("host").alias("__h"), F.col("node").alias("__n"), "depth"), (F.col("host") == F.col("__h")) & (F.col("anc") == F.col("__n")), "left")
        own_steps = above.select("host", "key", "res", F.lit(0).cast("long").alias("steps"), F.coalesce(F.col("depth") + 1, F.lit(0).cast("long")).alias("index"), "record")
        plain = plain.unionByName(above.where("depth is not null").select("host", "key", "res", F.lit(1).cast("long").alias("steps"), "anc"))

    reached = plain
    at_most = size + (0 if OPTIONAL not in held.columns else start.count())
    for level in reversed(range(len(jumps))):
        more = _up(reached, jumps[level], at_most).select(
            "host", "key", "res", (F.col("steps") + (1 << level)).alias("steps"), F.col("__a").alias("anc")
        )
        reached = reached.unionByName(more)
        reached = cut(reached) if level else reached  # the last one is read once
        at_most *= 2
    told = nodes.select("host", "node", "record").join(known.select("host", "node", "depth"), ["host", "node"])
    told = told.select(F.col("host").alias("__h"), F.col("node").alias("__n"), F.col("depth").alias("index"), "record")
    out = split_hot_join(reached, told, [("host", "__h"), ("anc", "__n")], at_most=at_most).select("host", "key", "res", "steps", "index", "record")
    if OPTIONAL in held.columns:
        out = out.unionByName(own_steps)
    return out.select(F.col("host").alias(HOST), F.col("key").alias(KEY), F.col("res").alias("__resource"), "steps", "index", "record")


def lookup_lineage(
    df: DataFrame, processes: DataFrame, max_unmatched: float | None = None
) -> DataFrame:
    """One row per step of each process's ancestor chain, farthest ancestor first, ending with the process.

    Adds ``process_info.process_lineage`` (the record of the step) and ``….index`` (0, 1, …). Rows without a required key or with an
    unknown process keep one row without lineage.
    """
    chain = ancestors(processes, lineage_keys(df))
    steps = chain.select(
        F.col(HOST).alias("__host"), F.col(KEY).alias("__key"), F.col("__resource").alias("__of"), F.col("record").alias(LINEAGE), F.col("index").alias(LINEAGE + ".index")
    )
    asked = df.withColumn("__resource", _resource(df, processes))
    pairs = [(HOST, "__host"), (KEY, "__key"), ("__resource", "__of")]
    out = split_hot_join(asked, steps, pairs, "left").drop("__host", "__key", "__of", "__resource")
    return out if max_unmatched is None else assert_max_unmatched(out, LINEAGE, max_unmatched)


def lookup_children(df: DataFrame, processes: DataFrame) -> DataFrame:
    """One row per direct child (``process_info.process_children``, its record); no child leaves one empty row."""
    require(df, *KEYS)
    children = processes.select(q(HOST).alias("__host"), q(PARENT).alias("__parent"), _record(processes).alias(CHILDREN))
    return expand_left_join(df, children, [(HOST, "__host"), (KEY, "__parent")]).drop("__host", "__parent")


def lookup_parent(df: DataFrame, processes: DataFrame) -> DataFrame:
    """The parent of each process (``process_info.parent``, its record), null if it is unknown."""
    require(df, HOST, PARENT)
    known = process_records(processes.where(q(HOST).isNotNull() & q(KEY).isNotNull()))
    known = known.select(F.col("host").alias("__host"), F.col("node").alias("__node"), F.col("record").alias(PARENT_INFO))
    return lookup_join(df, known, [(PARENT, "__node"), (HOST, "__host")]).drop("__host", "__node")
