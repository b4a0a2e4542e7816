"""Tenant, user, asset and client queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.catalog.registry import Inputs, query
from huntspark.functions.names import q
from huntspark.operators import inflate, lookups
from huntspark.operators import tenants as op
from huntspark.sources import scans


def tenants(i: Inputs) -> DataFrame:
    return i("f_tenants").selectExpr(
        "id", "name", "score", "array(service) as services",
        "array(struct('segment' as name, service as value)) as labels",
        """array(struct(env1 as name, env1_enabled as enabled, id as created_at, name as updated_at),
             struct(env2 as name, env2_enabled as enabled, id as created_at, name as updated_at)) as environments""",
    )


@query(
    "f_tenants",
    """select id, name from f_tenants where name like 'Customer#00000__2%' and env1 = 'ASIA' and env1_enabled
    and service in ('BUILDING', 'HOUSEHOLD', 'FURNITURE')""",
)
def tenant_search(i: Inputs) -> DataFrame:
    found = op.tenant_search(
        tenants(i), name="Customer#00000__2%", region="ASIA", services=["BUILDING", "HOUSEHOLD", "FURNITURE"]
    )
    return found.select("id", "name")


CLIENTS = """client as (select c_custkey as id, c_name as name, c_mktsegment as partner, 's'||(c_custkey % 7) as requested, 'h'||(c_nationkey % 5) as hierarchy,
    c_custkey % 4 <> 0 as enabled, c_custkey % 300 as created_day, c_custkey % 90 as modified_day from customer)"""


@query(
    sql=f"""with {CLIENTS} select cast(id as string) as id from client where partner in ('BUILDING', 'MACHINERY') and requested in ('s1', 's2', 's3')
      and hierarchy in ('h0', 'h4') and enabled and created_day between 20 and 200 and modified_day >= 10"""
)
def tenant_search_more(i: Inputs) -> DataFrame:
    """The other conditions: partner, requested services, hierarchy, state, days of creation and change."""
    held = i.table("customer").selectExpr(
        "cast(c_custkey as string) as id", "c_name as name", "array(c_mktsegment) as partner_subscriptions", "array('s'||(c_custkey % 7)) as requested_services",
        "array('root', 'h'||(c_nationkey % 5)) as hierarchies", "c_custkey % 4 <> 0 as enabled",
        "timestamp_seconds(1704067200 + 86400 * (c_custkey % 300)) as created_at", "timestamp_seconds(1704067200 + 86400 * (c_custkey % 90)) as modified_at",
    )
    return op.tenant_search(
        held, partner_subscriptions=["BUILDING", "MACHINERY"], requested_services=["s1", "s2", "s3"], hierarchies=["h0", "h4"], enabled=True,
        created=("2024-01-21T00:00:00Z", "2024-07-19T00:00:00Z"), modified=("2024-01-11T00:00:00Z", None),
    ).select("id")


@query("f_alerts f_tenants", "select name, count(*) as alerts from f_alerts a join f_tenants t on t.id = a.tenant_id where t.id in ('1', '3', '7', '19') group by all")
def tenant_search_ids(i: Inputs) -> DataFrame:
    found = op.tenant_search(tenants(i), ids=["1", "3", "7", "19", "none"]).select(F.col("id").alias("t"), "name")
    return i("f_alerts").join(found, F.col("tenant_id") == F.col("t")).groupBy("name").agg(F.count("*").alias("alerts"))


@query(
    "f_alerts",
    """select tenant_id as _macro_tenant_id, status, count(*) as count, null as title from f_alerts where tenant_id in ('2', '5') group by all
    union all select tenant_id, null, count(*), title from f_alerts where tenant_id = '9' group by all""",
)
def merge_results(i: Inputs) -> DataFrame:
    """Results of several tenants, not all with the same columns."""
    def of(tenant: str, column: str) -> DataFrame:
        return i("f_alerts").where(F.col("tenant_id") == tenant).groupBy(column).agg(F.count("*").alias("count"))

    return op.merge_results({"2": of("2", "status"), "5": of("5", "status"), "9": of("9", "title")})


@query("f_tenants", "select id from f_tenants where service = 'MACHINERY'")
def tenant_search_label(i: Inputs) -> DataFrame:
    return op.tenant_search(tenants(i), label_name="segment", label_value="MACHINERY", sort_by="name", ascending=False).select("id")


@query(
    "f_tenants",
    """select id, env1 = 'ASIA' and env1_enabled as asia, env1 = 'EUROPE' and env1_enabled as europe,
      case when env1 = 'ASIA' then name else '' end as asia_updated from f_tenants""",
)
def inflate_environments(i: Inputs) -> DataFrame:
    return inflate.inflate_environments(tenants(i), ["ASIA", "EUROPE"]).select(
        "id",
        q("environments.ASIA").alias("asia"),
        q("environments.EUROPE").alias("europe"),
        F.coalesce(q("environments.ASIA.updated_at"), F.lit("")).alias("asia_updated"),
    )


@query("f_tenants", "select id, case when env1_enabled then env1 when env2_enabled then env2 end as region from f_tenants")
def first_environment(i: Inputs) -> DataFrame:
    df = tenants(i)
    return df.select("id", inflate.lookup_first_environment(df).alias("region"))


@query(
    "f_alerts f_tenants",
    "select a.id, t.id as tenant_id, t.name as tenant_name, t.score as tenant_score from f_alerts a left join f_tenants t on t.id = a.tenant_id",
)
def lookup_tenants(i: Inputs) -> DataFrame:
    return lookups.lookup_tenants(i("f_alerts"), i("f_tenants")).select(
        "id", q("tenant.id").alias("tenant_id"), q("tenant.name").alias("tenant_name"), q("tenant.score").alias("tenant_score")
    )


@query("f_tenants", "select id from f_tenants where service like '%BUILD%' or service like 'HOUSE%'")
def resolve_macro(i: Inputs) -> DataFrame:
    return op.resolve_tenants(tenants(i), "@homes", {"homes": {"services": ["*BUILD*", "HOUSE*"]}})


@query(
    "f_tickets f_users",
    """select t.id, t.created_by, coalesce(u.email, '') as email from f_tickets t left join f_users u
    on t.created_by in (u.id, u.idp_user_id, u.user_id)""",
)
def lookup_users(i: Inputs) -> DataFrame:
    return lookups.lookup_users(i("f_tickets"), i("f_users")).select(
        "id", "created_by", F.coalesce(q("created_by.user.email"), F.lit("")).alias("email")
    )


@query("f_users", "select id from f_users where email like 'Supplier#%7'")
def user_search(i: Inputs) -> DataFrame:
    return scans.search_users(i("f_users"), emails=["Supplier#000000001", "Supplier#%7", "Supplier#%8"]).select("id")


@query("f_users", "select id from f_users where email in ('Supplier#000000001', 'Supplier#000000003')")
def user_search_exact(i: Inputs) -> DataFrame:
    return scans.search_users(i("f_users"), emails=["Supplier#000000001", "Supplier#000000003"]).select("id")


@query(
    "f_tenants",
    "select id as client_id from f_tenants where service in ('BUILDING', 'MACHINERY')",
)
def client_search(i: Inputs) -> DataFrame:
    clients = tenants(i).selectExpr("id as client_id", "name", "services as roles")
    return scans.search_clients(clients, roles=["BUILDING", "MACHINERY"]).select("client_id")


@query(
    "f_processes f_assets",
    """select event_id, coalesce(a.hostname, '') as hostname from f_processes p left join f_assets a
    on a.host_id = p.host_id and a.tenant_id = p.tenant_id""",
)
def lookup_assets(i: Inputs) -> DataFrame:
    assets = i("f_assets").withColumn("hostnames", F.array(F.struct("hostname"))).drop("hostname")
    return lookups.lookup_assets(i("f_processes"), assets).select(
        "event_id", F.coalesce(q("asset_info.hostname"), F.lit("")).alias("hostname")
    )


@query(
    "f_processes f_assets",
    "select host_id, hostname from f_assets where host_id in (select host_id from f_processes where image_path = 'error')",
)
def assets_by_host(i: Inputs) -> DataFrame:
    hosts = i("f_processes").where("image_path = 'error'").select("host_id")
    return scans.assets_by_host(i("f_assets"), hosts).select("host_id", "hostname")
