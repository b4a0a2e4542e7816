"""Suppression rules applied to alerts.

A rule has a list ``filters`` of (``key`` of alert_title / detector / entity, ``pattern``, ``inverted``); it holds for an
alert if every filter does. An entity filter is met by any entity of the alert; an inverted filter is met if the plain
one is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.names import q
from huntspark.plans.joins import hot_of_counts, measured_join
from huntspark.plans.lineage_cut import cut

# Keys of a suppression filter.
KEYS = ("alert_title", "detector", "entity")
_LITERAL = r"^\^[A-Za-z0-9 _:@/,;=%&-]*\$$"
_ALTERNATIVES = r"^\^\([A-Za-z0-9 _:@/,;=%&-]+(\|[A-Za-z0-9 _:@/,;=%&-]+)*\)\$$"
GRAM = 3  # characters of the text pieces that values are looked up by
_BREAK, _DOT = "\u0001", "\u0002"  # where a pattern stops to be plain text; a dot that stands for itself


def _values(alerts: DataFrame, title: str, detector: str, entities: str) -> Column:
    def tagged(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    listed = F.transform(F.coalesce(q(entities), F.array().cast("array<string>")), lambda e: tagged("entity", e))
    single = F.array(tagged("alert_title", q(title)), tagged("detector", q(detector)))
    return F.array_distinct(F.filter(F.concat(single, listed), lambda v: v["value"].isNotNull()))


def required_text(pattern: Column) -> Column:
    """The longest text of at least ``GRAM`` characters that every value matching ``pattern`` contains, else null.

    Careful, not complete: only text outside groups and classes counts, nothing that a quantifier makes optional, and a pattern with
    an alternative outside groups, a flag, a look-around, a quotation or a character number has none.
    """
    def cut_out(text: Column, what: str, by: str = _BREAK) -> Column:
        return F.regexp_replace(text, what, by)

    opaque = pattern.rlike(r"\(\?|\\\\|\\[xu0cpPQENkG1-9]|\[\^?\]|\[[^\]]*[\[&]|[" + _BREAK + _DOT + "]")
    text = cut_out(cut_out(pattern, r"\\\.|\[\.\]", _DOT), r"\\.")
    text = cut_out(text, r"\[[^\]]*\]")
    for _ in range(4):  # groups within groups
        text = cut_out(text, r"\([^()]*\)")
    text = cut_out(text, r"(?s).(\?|\*|\{[^}]*\})[?+]?")
    opaque = opaque | text.rlike(r"[()\[\]|\\?*{}]")
    text = cut_out(text, r"[+.^$]")
    pieces = F.transform(F.split(text, _BREAK), lambda t: F.replace(t, F.lit(_DOT), F.lit(".")))
    longest = F.array_max(F.transform(pieces, lambda t: F.struct(F.length(t).alias("n"), t.alias("text"))))
    return F.when(~opaque & (longest["n"] >= GRAM), longest["text"])


def grams(text: Column) -> Column:
    """The different pieces of ``GRAM`` characters of ``text``."""
    last = F.length(text) - (GRAM - 1)
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda k: F.substr(text, k, F.lit(GRAM))))


def pattern_matches(values: DataFrame, patterns: DataFrame, chunk: int = 512, salts: int = 64) -> DataFrame:
    """(key, value, pattern) for every value in which a pattern of its key is found.

    Patterns that spell out whole values (``^text$``, ``^(a|b)$``) are joined by equality. Of the others most require some text: an
    index leads from one piece of that text (the one that the fewest values have) to the pattern, so a value is only tried
    against patterns one of whose pieces it has. What is left requires no text and has to be tried on every value of its key; such
    patterns stand in lists of about ``chunk``, spread over ``salts`` tasks a list, and a row is a value and a list, never a value and
    a pattern. Distinct values and distinct patterns only, and none is left out.
    """
    values = values.select("key", "value").distinct()
    patterns = patterns.select("key", "pattern").distinct()
    exact = F.col("pattern").rlike(_LITERAL) | F.col("pattern").rlike(_ALTERNATIVES)
    spelled = patterns.where(exact).select(
        F.col("key").alias("__key"),
        "pattern",
        F.explode(F.split(F.regexp_replace("pattern", r"^\^\(?|\)?\$$", ""), r"\|")).alias("__text"),
    )
    by_equality = values.join(
        spelled, (F.col("key") == F.col("__key")) & (F.col("value") == F.col("__text"))
    ).select("key", "value", "pattern")

    tried = cut(patterns.where(~exact).withColumn("text", required_text(F.col("pattern"))))
    indexed = tried.where("text is not null")
    wanted = indexed.select("key", "pattern", "text", F.explode(grams(F.col("text"))).alias("gram"))
    pieces = values.select("key", "value", F.explode(grams(F.col("value"))).alias("gram"))
    pieces = pieces.join(wanted.select("key", "gram").distinct(), ["key", "gram"], "left_semi")
    counted = pieces.groupBy("key", "gram").agg(F.count("*").alias("n"))
    rarest = (
        wanted.join(counted, ["key", "gram"], "left")
        .groupBy("key", "pattern", "text")
        .agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    )
    # expr: the pattern of rlike may be a column there
    by_text = pieces.join(rarest, ["key", "gram"]).where(F.contains("value", "text") & F.expr("value rlike pattern"))
    found = by_equality.unionByName(by_text.select("key", "value", "pattern"))

    rest = tried.where("text is null").select("key", "pattern")
    most = rest.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    if not most:
        return found.distinct()
    n_lists = -(-most // chunk)
    lists = (
        rest.groupBy("key", F.pmod(F.xxhash64("pattern"), F.lit(n_lists)).alias("list"))
        .agg(F.collect_list("pattern").alias("patterns"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = values.withColumn("salt", F.pmod(F.xxhash64("key", "value"), F.lit(salts)).cast("int"))
    held = salted.join(lists, ["key", "salt"]).withColumn("patterns", F.expr("filter(patterns, p -> value rlike p)"))
    by_trying = held.select("key", "value", F.explode("patterns").alias("pattern"))
    return found.unionByName(by_trying).distinct()


def matching_alerts(
    alerts: DataFrame,
    rules: DataFrame,
    title: str = "metadata.title",
    detector: str = "metadata.creator.detector.detector_id",
    entities: str = "entities.entities",
    id_column: str = "id",
) -> DataFrame:
    """Ids of the alerts for which some rule holds.

    Rules with the same filters are one rule. A rule with plain filters is looked up by the one that matches the fewest
    alerts; its other filters are then checked in the row. A rule with inverted filters only holds for an alert unless
    a pattern of it matches, so such rules are counted against their matches.
    """
    def entry(f: Column) -> Column:
        return F.struct(f["key"].alias("key"), f["pattern"].alias("pattern"), f["inverted"].alias("inverted"))

    rules = (
        rules.select(F.array_sort(F.array_distinct(F.transform("filters", entry))).alias("filters"))
        .where(F.size("filters") > 0)
        .distinct()
        .withColumn("rule", F.to_json("filters"))
    )
    rules = cut(rules)
    plain = rules.where(F.exists("filters", lambda f: ~f["inverted"]))
    inverted = rules.where(~F.exists("filters", lambda f: ~f["inverted"]))

    held = alerts.select(q(id_column).alias("__id"), _values(alerts, title, detector, entities).alias("__values"))
    tagged = held.select("__id", F.explode("__values").alias("v")).select("__id", "v.key", "v.value")
    each = rules.select("rule", F.explode("filters").alias("f")).select("rule", "f.key", "f.pattern", "f.inverted")
    per_value = cut(tagged.groupBy("key", "value").agg(F.count("*").alias("__alerts")))
    hot = hot_of_counts(per_value, ["key", "value"], "__alerts")
    matches = cut(pattern_matches(per_value, each)).withColumnsRenamed({"key": "__k", "value": "__v"})
    frequency = (
        per_value.join(matches, (F.col("key") == F.col("__k")) & (F.col("value") == F.col("__v")))
        .groupBy(F.col("key").alias("__fk"), F.col("pattern").alias("__fp"))
        .agg(F.sum("__alerts").alias("__n"))
    )

    rarest = (
        each.where("not inverted")
        .join(frequency, (F.col("key") == F.col("__fk")) & (F.col("pattern") == F.col("__fp")), "left")
        .groupBy(F.col("rule").alias("__rule"))
        .agg(F.min_by(F.struct("key", "pattern"), F.struct(F.coalesce("__n", F.lit(0)), "key", "pattern")).alias("__lead"))
    )
    lead = plain.join(rarest, F.col("rule") == F.col("__rule")).select(
        "filters", F.col("__lead.key").alias("__lk"), F.col("__lead.pattern").alias("__lp")
    )
    candidates = matches.join(lead, (F.col("__k") == F.col("__lk")) & (F.col("pattern") == F.col("__lp"))).select(
        "__k", "__v", "filters"
    )
    in_row = held.withColumn("__value", F.explode("__values")).withColumns(
        {"__vk": F.col("__value.key"), "__vv": F.col("__value.value")}
    )
    # expr: the pattern of rlike may be a column there
    holds = F.expr(
        "forall(filters, f -> exists(__values, v -> v.key = f.key and v.value rlike f.pattern) <> f.inverted)"
    )
    by_plain = measured_join(in_row.drop("__value"), candidates, [("__vk", "__k"), ("__vv", "__v")], hot).where(holds)

    out = by_plain.select(F.col("__id").alias(id_column))
    total = inverted.count()
    if total:
        blocked = inverted.select("rule", F.explode("filters").alias("f")).select("rule", "f.key", "f.pattern")
        hit_values = matches.join(
            blocked.withColumnsRenamed({"key": "__bk", "pattern": "__bp"}),
            (F.col("__k") == F.col("__bk")) & (F.col("pattern") == F.col("__bp")),
        ).select("__k", "__v", "rule").distinct()
        free = (
            measured_join(tagged, hit_values, [("key", "__k"), ("value", "__v")], hot)
            .groupBy("__id")
            .agg(F.count_distinct("rule").alias("__blocked"))
            .where(F.col("__blocked") == total)
            .select(F.col("__id").alias("__free"))
        )
        unblocked = held.join(free, F.col("__id") == F.col("__free"), "left_anti")
        out = out.unionByName(unblocked.select(F.col("__id").alias(id_column)))
    return out.distinct()


def apply_suppression(alerts: DataFrame, rules: DataFrame, **columns: str) -> DataFrame:
    """The alerts for which no rule holds."""
    id_column = columns.get("id_column", "id")
    hit = matching_alerts(alerts, rules, **columns).withColumnRenamed(id_column, "__hit")
    return alerts.join(hit, alerts[id_column] == hit["__hit"], "left_anti")
