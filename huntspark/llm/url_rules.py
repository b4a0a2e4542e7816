"""URL filter: explicit host and path rules, else association rules that FP-growth mined from labelled URLs."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.llm.common import ascii_lower
from huntspark.plans.lineage_cut import cut

#: verdict, host, path prefix
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
MIN_COUNT = 5  # blocked URLs a rule rests on, whatever the table
MIN_CONFIDENCE = 0.5  # of the lower bound of a rule's rate of blocked URLs
Z = 2.576  # the bound holds for 99 of 100 such rates


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: then up to ``? #`` or the end.
    Both are empty without ``://`` and for null."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return (
        F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit("")),
        F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
    )


def url_tokens(url: Column) -> Column:
    """Distinct tokens: the host, its words, the path's words and the query's parts; a run of digits is one ``#``."""
    host, path = host_and_path(url)
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    parts = [(host, "[^a-z0-9]+", "h:"), (path, "[/._-]+", "p:"), (query, "&", "q:")]

    def words(text: Column, cut_at: str, prefix: str) -> Column:
        return F.transform(F.split(F.regexp_replace(text, "[0-9]+", "#"), cut_at), lambda t: F.concat(F.lit(prefix), t))

    lists = [F.array(F.concat(F.lit("d:"), host)), *(words(*p) for p in parts)]
    return F.array_sort(F.array_distinct(F.filter(F.concat(*lists), lambda t: F.length(t) > 2)))


def explicit_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (as host + path) that fits, as struct(rule, verdict), else null. A rule fits its host and every
    subdomain if the path starts with its path."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    return F.coalesce(*fits)


def wilson(hits: Column, of: Column, z: float) -> Column:
    """Lower bound of a rate seen ``hits`` times of ``of``."""
    rate, odd = hits / of, F.lit(z * z)
    spread = F.lit(z) * F.sqrt(rate * (1 - rate) / of + odd / (4 * of * of))
    return (rate + odd / (2 * of) - spread) / (1 + odd / of)


def contained(sets: DataFrame, parts: DataFrame) -> DataFrame:
    """(*sets*, antecedent) for every row of ``sets`` (tokens array) that holds all of a ``parts`` row (antecedent array).

    An inverted index: a part stands under its rarest token only (of the tokens of ``sets``), a set looks up its tokens, and
    what it finds is checked whole. Both sides distinct; a frequent token has few parts, for most have a rarer one."""
    uses = sets.select(F.explode("tokens").alias("token")).groupBy("token").count()
    rarest = (
        parts.select("antecedent", F.explode("antecedent").alias("token"))
        .join(uses, "token")
        .groupBy("antecedent")
        .agg(F.count("*").alias("known"), F.min(F.struct("count", "token")).alias("least"))
        .where(F.col("known") == F.size("antecedent"))
        .select("antecedent", F.col("least.token").alias("token"))
    )
    found = sets.withColumn("token", F.explode("tokens")).join(rarest, "token").drop("token")
    return found.where(F.forall("antecedent", lambda t: F.array_contains("tokens", t)))


def mine_block_rules(labelled: DataFrame, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE, z: float = Z) -> DataFrame:
    """Rules (antecedent array) that lead to a blocked label, mined from ``labelled`` (tokens array, blocked boolean).

    FP-growth finds the token sets, of any length, that at least ``min_count`` blocked URLs have: a number that does not grow with
    the table, so a host with few URLs can be a rule at any size. Their URLs are counted over all labels, and a set is a rule if
    the lower bound (Wilson, ``z``) of its rate of blocked ones is at least ``min_confidence`` and above the rate of all labels.
    A rule that holds a smaller rule is pruned: it would match nothing new. Without enough blocked labels there are no rules.
    """
    known = labelled.where(F.col("blocked").isNotNull() & F.col("tokens").isNotNull())
    sets = cut(known.groupBy("tokens").agg(F.count("*").alias("n"), F.count_if("blocked").alias("n_block")))
    total, bad = sets.agg(F.sum("n"), F.sum("n_block")).first()
    if (bad or 0) < min_count:
        return sets.select(F.col("tokens").alias("antecedent")).limit(0)
    blocked = cut(known.where("blocked").select("tokens"))
    model = FPGrowth(itemsCol="tokens", minSupport=(min_count - 0.5) / bad, minConfidence=0.0).fit(blocked)
    found = cut(model.freqItemsets.select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("n_block")))
    counted = contained(sets.select("tokens", "n"), found.select("antecedent")).groupBy("antecedent").agg(F.sum("n").alias("n"))
    bound = wilson(F.col("n_block"), F.col("n"), z)
    rules = counted.join(found, "antecedent").where((bound >= min_confidence) & (bound > bad / total))
    rules = cut(rules.select("antecedent"))
    larger = contained(rules.select(F.col("antecedent").alias("tokens")), rules).where(F.size("tokens") > F.size("antecedent"))
    return rules.join(larger.select(F.col("tokens").alias("antecedent")).distinct(), "antecedent", "left_anti")


def filter_urls(pages: DataFrame, block_rules: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict.

    The verdict is that of the longest explicit rule, else ``block`` if a mined rule fits, else ``allow``. URLs are reduced to
    distinct token sets, which look up the mined rules by an inverted index (``contained``). A null or broken url has an empty
    host and path and no tokens: ``allow``. Repeated rows stay, other columns are not read, an empty table has no rows.
    """
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path")).select(
        "page_id", "host", "path", explicit_rule(F.col("host"), F.col("path"), rules).alias("own"), "url"
    )
    ruled = judged.where(F.col("own").isNotNull())
    open_ = judged.where(F.col("own").isNull()).withColumn("tokens", F.coalesce(url_tokens(F.col("url")), F.array()))
    sets = open_.select("tokens").distinct()
    blocked = contained(sets, block_rules.select("antecedent")).select("tokens").distinct().withColumn("mined", F.lit("block"))
    mined = open_.join(blocked, "tokens", "left").withColumn("verdict", F.coalesce("mined", F.lit("allow")))
    ruled = ruled.select("page_id", "host", "path", "own.rule", "own.verdict")
    return ruled.unionByName(mined.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), "verdict"))


def label_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, blocked) of the pages whose document has a label; low quality or toxic text is blocked.

    A page's document is the first number after a slash in its url. A document with several labels counts once for each.
    """
    doc = F.expr("try_cast(nullif(regexp_extract(url, '/([0-9]+)', 1), '') as bigint)")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).select("doc_id", bad.alias("blocked"))
    return pages.select("url", doc.alias("doc_id")).join(known, "doc_id").select(url_tokens(F.col("url")).alias("tokens"), "blocked")
