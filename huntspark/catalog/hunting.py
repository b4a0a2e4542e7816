"""Indicator queries over whole texts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.registry import Inputs, query
from huntspark.catalog.tenants import tenants
from huntspark.functions import indicators as ind
from huntspark.functions.names import q
from huntspark.operators import ioc
from huntspark.operators.inflate import normalize_event_count_results

AS_OF = date(2024, 2, 10)

TOKENS = """
token as (select distinct unnest(string_split_regex(text, '[^0-9A-Za-z.:-]+')) as value from documents
  union select regexp_extract(url, '^https?://([^/:?#]+)', 1) from pages
  union select regexp_extract(url, '^https?://[^/:?#]*?([0-9A-Za-z-]+[.][a-z]+)[/:?#]', 1) from pages)"""
OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
HEX = "[0-9A-Fa-f]{1,4}"
DOMAIN_SQL = """(regexp_full_match(value, '[A-Za-z0-9-]{1,63}[.][A-Za-z]{2,}') and not starts_with(value, '-')
  and not contains(value, '-.'))"""
HASH_SQL = "(regexp_full_match(value, '[A-Fa-f0-9]+') and length(value) in (32, 40, 64))"
IP_SQL = f"""(regexp_full_match(value, '{OCTET}([.]{OCTET}){{3}}')
  or regexp_full_match(value, '{HEX}(:{HEX}){{7}}')
  or (regexp_full_match(value, '({HEX}(:{HEX})*)?::({HEX}(:{HEX})*)?')
      and len(list_filter(string_split(value, ':'), lambda g: g <> '')) <= 7))"""

HOST_SQL = """(regexp_full_match(value, '([A-Za-z0-9-]{1,63}[.])+[A-Za-z]{2,}') and not starts_with(value, '-') and not contains(value, '-.')
  and not contains(value, '.-') and regexp_matches(value, '[.]([a-z]+|[A-Z]+)$') and length(value) <= 253)"""
FOUND = f"""
word as (select distinct doc_id, unnest(string_split_regex(text, '[^\\p{{L}}\\p{{N}}.:_%-]+')) as word from documents),
piece as (
  select doc_id, 'domain' as kind, trim(unnest(string_split(word, ':')), '.-') as value from word
  union select doc_id, 'hash', unnest(string_split_regex(word, '[.:_%-]+')) from word
  union select doc_id, 'ip', rtrim(word, '.') from word
  union select doc_id, 'ip', trim(word, '.:-') from word
  union select doc_id, 'ip', regexp_extract(trim(word, '.:-'), '^([^:]+):[0-9]+$', 1) from word),
found as (select doc_id, kind, value from piece where case kind when 'ip' then {IP_SQL} and regexp_matches(value, '[0-9A-Fa-f]')
  when 'domain' then {HOST_SQL} else {HASH_SQL} end)"""
SWEEP = f"""{FOUND.strip()},
wanted as (select distinct kind, value from found join documents using (doc_id) where lang = 'en'),
hits as (select f.source as event_type, date '2024-02-10' - cast(doc_id % 40 as int) as date, value as matching_value,
    kind as logical_type, cast(doc_id % 20 as string) as tenant_id
  from found join wanted using (kind, value) join documents f using (doc_id)
  where doc_id % 40 between 1 and 31)"""
COUNTED = "select event_type, strftime(date, '%Y-%m-%d') as date, matching_value, logical_type, tenant_id, count(*) as count from hits"


def tokens(i: Inputs) -> DataFrame:
    words = i.table("documents").select(F.explode(F.split("text", "[^0-9A-Za-z.:-]+")).alias("value"))
    hosts = i.table("pages").select(
        F.explode(
            F.array(
                F.regexp_extract("url", "^https?://([^/:?#]+)", 1),
                F.regexp_extract("url", "^https?://[^/:?#]*?([0-9A-Za-z-]+[.][a-z]+)[/:?#]", 1),
            )
        ).alias("value")
    )
    return words.unionByName(hosts).distinct()


def raw_events(i: Inputs) -> DataFrame:
    """Documents as events: type, tenant, day, and the indicators of the whole text per logical type."""
    rows = i("f_raw_text").withColumn("found", ind.extract_all_indicators(F.col("text")))
    return rows.select(
        "doc_id",
        "event_type",
        "tenant_id",
        "lang",
        F.date_sub(F.lit(AS_OF), F.col("day_offset")).alias("date"),
        *[F.col("found")[k].alias(f"logicals.{k}") for k in ind.KINDS],
    )


def wanted(i: Inputs, rows: DataFrame) -> DataFrame:
    listed = ioc.indicator_set(rows.where("lang = 'en'")).withColumnRenamed("indicator", "value")
    return ioc.indicator_table(listed, fqdn=True)


def as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def sweep(i: Inputs, kinds: list[str] | None = None) -> DataFrame:
    rows = raw_events(i)
    return as_text(ioc.ioc_sweep(rows, wanted(i, rows), AS_OF, 30, kinds))


@query(sql=f"with {TOKENS.strip()} select value from token where {DOMAIN_SQL}")
def is_domain(i: Inputs) -> DataFrame:
    return tokens(i).where(ind.is_domain(q("value")))


@query(
    sql=f"""with {TOKENS.strip()} select value from token where regexp_full_match(value, '([A-Za-z0-9-]{{1,63}}[.])+[A-Za-z]{{2,}}')
      and not starts_with(value, '-') and not contains(value, '-.') and not contains(value, '.-')"""
)
def is_domain_fqdn(i: Inputs) -> DataFrame:
    return tokens(i).where(ind.is_domain(q("value"), fqdn=True))


@query(sql=f"with {TOKENS.strip()} select value from token where {HASH_SQL}")
def is_hash(i: Inputs) -> DataFrame:
    return tokens(i).where(ind.is_hash(q("value")))


@query(sql=f"with {TOKENS.strip()} select value from token where {IP_SQL}")
def is_ip(i: Inputs) -> DataFrame:
    return tokens(i).where(ind.is_ip_address(q("value")))


@query(
    sql=f"""with {TOKENS.strip()} select value, case when {HASH_SQL} then 'hash' when {DOMAIN_SQL} then 'domain'
      when {IP_SQL} then 'ip' else 'Error' end as kind from token"""
)
def classify_indicator(i: Inputs) -> DataFrame:
    return tokens(i).select("value", ind.classify_indicator(q("value")).alias("kind"))


def tag(kind: str):
    return lambda value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))


@query(sql=f"with {FOUND.strip()} select doc_id, kind, value from found")
def extract_indicators(i: Inputs) -> DataFrame:
    found = i.table("documents").select("doc_id", ind.extract_all_indicators(F.col("text")).alias("found"))
    held = F.flatten(F.array(*[F.transform(F.col("found")[k], tag(k)) for k in ind.KINDS]))
    return found.select("doc_id", F.explode(held).alias("h")).select("doc_id", "h.kind", "h.value")


@query(sql=f"with {SWEEP} {COUNTED} group by all")
def ioc_sweep(i: Inputs) -> DataFrame:
    return sweep(i)


@query(sql=f"with {SWEEP} {COUNTED} where logical_type = 'domain' group by all")
def ioc_domains(i: Inputs) -> DataFrame:
    return sweep(i, ["domain"])


@query(sql=f"with {SWEEP} {COUNTED} where logical_type = 'hash' group by all")
def ioc_hashes(i: Inputs) -> DataFrame:
    return sweep(i, ["hash"])


@query(sql=f"with {SWEEP} {COUNTED} where logical_type = 'ip' group by all")
def ioc_ips(i: Inputs) -> DataFrame:
    return sweep(i, ["ip"])


@query(
    "f_tenants",
    f"""with {SWEEP}, region as (select id, case when env1_enabled then env1 when env2_enabled then env2 end as region from f_tenants)
    select event_type, strftime(date, '%Y-%m-%d') as date, matching_value, logical_type, tenant_id, region, count(*) as count
    from hits join region on id = tenant_id where region is not null group by all""",
)
def ioc_sweep_regions(i: Inputs) -> DataFrame:
    rows = raw_events(i)
    return as_text(ioc.ioc_sweep_regions(rows, wanted(i, rows), tenants(i), AS_OF))


@query("f_tenants", f"with {SWEEP} select id from f_tenants where id not in (select tenant_id from hits)")
def null_findings(i: Inputs) -> DataFrame:
    return ioc.null_findings(tenants(i), sweep(i)).select("id")


@query("f_tenants", f"with {SWEEP} select id from f_tenants where id in (select tenant_id from hits)")
def with_findings(i: Inputs) -> DataFrame:
    return ioc.with_findings(tenants(i), sweep(i)).select("id")


@query(
    sql=f"""with {FOUND.strip()}, pub as (
        select distinct value, doc_id as pub from found join documents using (doc_id) where lang = 'en'),
      v as (select distinct doc_id, value from found)
    select doc_id, count(p.value) > 0 as found, count(distinct p.value) as indicators, count(distinct p.pub) as publications
    from documents left join v using (doc_id) left join pub p using (value) group by doc_id""",
)
def ti_pubs(i: Inputs) -> DataFrame:
    rows = raw_events(i)
    arrays = F.flatten(F.array(*[q(f"logicals.{k}") for k in ind.KINDS]))
    pubs = rows.where("lang = 'en'").select(F.explode(arrays).alias("indicator"), q("doc_id").alias("publication_id"))
    return ioc.get_ti_pubs(rows, pubs, "doc_id").select(
        "doc_id",
        q("tips.found").alias("found"),
        q("tips.indicators").alias("indicators"),
        q("tips.publications").alias("publications"),
    )


@query(
    sql=f"""with {FOUND.strip()}, named as (select distinct value from found join documents using (doc_id) where lang = 'en')
    select distinct doc_id, value as indicator from found join named using (value)""",
)
def ti_matches(i: Inputs) -> DataFrame:
    rows = raw_events(i)
    arrays = F.flatten(F.array(*[q(f"logicals.{k}") for k in ind.KINDS]))
    pubs = rows.where("lang = 'en'").select(F.explode(arrays).alias("indicator"), q("doc_id").alias("publication_id"))
    return ioc.publication_matches(rows, pubs, "doc_id")


@query(
    sql=f"""with {FOUND.strip()}, pub as (select distinct value, doc_id as publication_id from found join documents using (doc_id) where lang = 'en')
    select f.doc_id, p.publication_id, count(distinct f.value) as indicators from found f join pub p using (value) group by all""",
)
def ti_publications(i: Inputs) -> DataFrame:
    rows = raw_events(i)
    arrays = F.flatten(F.array(*[q(f"logicals.{k}") for k in ind.KINDS]))
    pubs = rows.where("lang = 'en'").select(F.explode(arrays).alias("indicator"), q("doc_id").alias("publication_id"))
    return ioc.row_publications(rows, pubs, "doc_id")


@query(
    sql=f"""with {FOUND.strip()} select distinct l.doc_id, l.kind, l.value from found l where exists (
      select 1 from found r join documents d using (doc_id) where r.value = l.value and d.lang = 'en')""",
)
def add_threat_intel(i: Inputs) -> DataFrame:
    """Indicators found in texts, kept where a correlation knows them."""
    found = i.table("documents").select("doc_id", ind.extract_all_indicators(F.col("text")).alias("found"))
    rows = found.select("doc_id", *[F.col("found")[k].alias(f"logicals.{k}") for k in ind.KINDS])
    listed = raw_events(i).where("lang = 'en'")

    def known(df: DataFrame, indicators: DataFrame) -> DataFrame:
        named = indicators.join(ioc.indicator_set(listed), "indicator")
        held = F.flatten(F.array(*[F.transform(q(f"logicals.{k}"), tag(k)) for k in ind.KINDS]))
        each = df.select("doc_id", F.explode(held).alias("h")).select("doc_id", "h.kind", "h.value")
        return each.join(named, each["value"] == named["indicator"], "left_semi")

    return ioc.add_threat_intel(rows, [known])


@query(
    "f_events",
    """select resource_id, 'address' as search from f_events where source_address = '10.0.0.5'
    union all select resource_id, 'url' from f_events where uri_path = '1-URGENT'
    union all select resource_id, 'action' from f_events where action = 'F'""",
)
def multi_search(i: Inputs) -> DataFrame:
    def search(name, column, value):
        return lambda df: df.where(q(column) == value).select("resource_id", F.lit(name).alias("search"), q(column))

    found = ioc.multi_search(i("f_events"), [search("address", "source_address", "10.0.0.5"), search("url", "uri_path", "1-URGENT"), search("action", "action", "F")])
    return found.select("resource_id", "search")


@query(
    sql="""select p_partkey, p_brand as matching_value, 't'||(p_partkey % 20) as tenant_id, cast(p_size as bigint) as count from part
    union all select p_partkey, p_brand, 'x', cast(1 as bigint) from part where p_size % 2 = 0""",
)
def ioc_counts_flat(i: Inputs) -> DataFrame:
    nested = i.table("part").selectExpr(
        "p_partkey",
        "p_brand as matching_value",
        """concat(array(struct('t'||(p_partkey % 20) as tenant_id, cast(p_size as bigint) as count)),
             if(p_size % 2 = 0, array(struct('x' as tenant_id, 1L as count)),
                cast(array() as array<struct<tenant_id string, count bigint>>))) as counts_by_tenant""",
    )
    return normalize_event_count_results(nested).select(
        "p_partkey",
        "matching_value",
        q("counts_by_tenant.tenant_id").alias("tenant_id"),
        q("counts_by_tenant.count").alias("count"),
    )
