"""Security tables seen in the given tables. The texts run in Spark and as plain SQL; each one reads whole tables."""

VIEWS: dict[str, str] = {
    "f_alerts": """
select 'a'||cast(event_id as string) as id, cast(user_id % 20 as string) as tenant_id, event_type as title,
  value/500 as severity, cast(floor({usec}/1000000) as bigint) as created_at_seconds,
  case when event_id % 4 < 2 then 'OPEN' when event_id % 4 = 2 then 'FALSE_POSITIVE' else 'TRUE_POSITIVE' end as status,
  case when event_id % 4 = 2 then 'benign' when event_id % 4 = 3 then 'confirmed' end as resolution_reason,
  'app:d'||cast(event_id % 40 as string) as creator,
  case when event_id % 5 = 0 then 'i'||cast(event_id % 50 as string) end as investigation_id,
  'userName:u'||cast(user_id as string) as entity1,
  'sourceIpAddress:10.0.0.'||regexp_extract(props,'([0-9]+)',1) as entity2,
  'fileName:f'||cast(event_id % 7 as string) as entity3, event_id, user_id
from {events}""",
    "f_processes": """
select event_id, host_id, pid, parent_pid, image_path, value, event_time_usec, tenant_id, sensor_type, username,
  source_address,
  case when event_id % 101 <> 100 then host_id||':'||cast(pid as string)||':'||cast(pid % 3 as string) end
    as process_correlation_id,
  host_id||':'||cast(parent_pid as string)||':'||cast(parent_pid % 3 as string) as parent_correlation_id
from (select event_id, 'h'||cast(event_id % 150 as string) as host_id,
    cast(floor(event_id/150) as bigint) + 1 as pid,
    cast(floor((floor(event_id/150) + 1)/2) as bigint) as parent_pid, event_type as image_path, value,
    {usec} as event_time_usec, cast(event_id % 150 % 20 as string) as tenant_id,
    case when event_id % 10 = 0 then null when event_id % 4 < 2 then 'ENDPOINT_A' else 'ENDPOINT_B' end as sensor_type,
    'u'||cast(user_id as string) as username,
    '10.0.0.'||regexp_extract(props,'([0-9]+)',1) as source_address
  from {events}) t""",
    "f_netflow": """
select cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string)
    as event_id,
  'h'||cast(l_orderkey % 150 as string) as host_id,
  case when l_linenumber % 2 = 0 then cast(l_partkey % 60 as string)||':'||cast(l_suppkey % 3 as string)
    else cast(l_partkey % 60 as string) end as pid,
  case when l_linenumber % 2 = 0 then '' else cast(l_suppkey % 3 as string) end as timewindow,
  case when l_linenumber % 3 = 0 then 'ENDPOINT_A' else 'ENDPOINT_B' end as sensor_type,
  cast((l_orderkey % 150) % 20 as string) as tenant_id, cast(l_quantity as bigint) as tx_byte_count,
  l_shipdate as event_ts
from {lineitem}""",
    "f_http": """
select o_orderkey as event_id, 'h'||cast(o_custkey % 150 as string) as host_id,
  cast(o_custkey % 150 % 20 as string) as tenant_id,
  case when o_orderkey % 2 = 0 then 'ENDPOINT_A' else 'ENDPOINT_B' end as sensor_type, o_orderpriority as uri_path,
  o_orderdate as event_ts
from {orders}""",
    "f_auth": """
select o_orderkey as event_id, 'h'||cast(o_custkey % 150 as string) as host_id,
  cast(o_custkey % 150 % 20 as string) as tenant_id,
  case when o_orderkey % 3 = 0 then 'ENDPOINT_A' else 'ENDPOINT_B' end as sensor_type, o_orderstatus as action,
  o_orderdate as event_ts
from {orders}""",
    "f_detectionfinding": """
select p_partkey as event_id, 'h'||cast(p_partkey % 150 as string) as host_id,
  cast(p_partkey % 150 % 20 as string) as tenant_id,
  case when p_size % 2 = 0 then 'ENDPOINT_A' else 'ENDPOINT_B' end as sensor_type, p_type as title
from {part}""",
    "f_events": """
select 'process' as schema, 'event://priv:scope.process:'||cast(event_id as string) as resource_id,
  {usec} as event_time_usec, 'ENDPOINT_A' as sensor_type, 'u'||cast(user_id as string) as username,
  event_type as image_path, cast(null as string) as source_address, cast(null as string) as destination_address,
  cast(null as string) as action, cast(null as string) as target_domain_name, cast(null as string) as uri_path,
  md5(event_type) as program_hash_md5
from {events}
union all
select 'netflow', 'event://priv:scope.netflow:'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string),
  cast(l_orderkey as bigint) * 1000000,
  case when l_linenumber % 3 = 0 then 'ENDPOINT_A' else 'ENDPOINT_B' end, null, null,
  '10.0.0.'||cast(l_partkey % 100 as string), case when l_linenumber = 1 then null else '10.0.1.'||cast(l_suppkey % 50 as string) end,
  null, null, null, null
from {lineitem}
union all
select 'http', 'event://priv:scope.http:'||cast(o_orderkey as string), cast(o_orderkey as bigint) * 1000000 + 1, 'ENDPOINT_B', null, null,
  '10.0.0.'||cast(o_custkey % 100 as string), '10.0.0.'||cast(o_custkey % 50 as string), null, null, o_orderpriority, null
from {orders}
union all
select 'auth', 'event://priv:scope.auth:'||cast(o_orderkey as string), cast(o_orderkey as bigint) * 1000000 + 2, 'ENDPOINT_B', null, null,
  '10.0.2.'||cast(o_custkey % 100 as string), null, o_orderstatus, lower(substr(o_orderpriority, 3, 3))||'.example', null, null
from {orders}
union all
select 'detectionfinding', 'event://priv:scope.detectionfinding:'||cast(p_partkey as string), cast(p_partkey as bigint) * 1000000 + 3,
  'ENDPOINT_A', null, p_type, null, null, null, null, null, null
from {part}""",
    "f_tenants": """
select cast(c_custkey as string) as id, c_name as name, c_mktsegment as service, r_name as env1,
  r_regionkey % 2 = 0 as env1_enabled, n_name as env2, c_custkey % 3 <> 0 as env2_enabled, c_acctbal as score
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "f_assets": """
select 'h'||cast(c_custkey as string) as host_id, cast(c_custkey % 20 as string) as tenant_id, c_name as hostname,
  c_mktsegment as os
from {customer}""",
    "f_users": """
select cast(s_suppkey as string) as id, 'idp'||cast(s_suppkey as string) as idp_user_id,
  'usr'||cast(s_suppkey as string) as user_id, s_name as email from {supplier}""",
    "f_tickets": """
select o_orderkey as id, case o_orderkey % 4 when 0 then cast(o_custkey % 100 as string)
    when 1 then 'idp'||cast(o_custkey % 100 as string) when 2 then 'usr'||cast(o_custkey % 200 as string) end as created_by
from {orders}""",
    "f_detectors": """
select 'app:d'||cast(n_nationkey % 20 as string) as creator_name, n_name as display_name, n_nationkey as ord
from {nation}""",
    "f_audits": """
select o_orderkey as audit_id, o_custkey as target, o_orderdate as event_time,
  case when o_custkey % 3 = 0 then 'billing' else 'search' end as application, 'evt_'||o_orderstatus as event_name,
  case o_orderkey % 4 when 1 then 'O' when 2 then 'F' when 3 then 'P' end as before_status, o_orderstatus as after_status,
  case when o_orderkey % 3 = 0 then o_orderpriority else '1-URGENT' end as before_priority,
  o_orderpriority as after_priority
from {orders}""",
    "f_evidence": """
select case l_linenumber % 3 when 0 then 'alerts' when 1 then 'events' else 'search_queries' end as evidence_type,
  'e'||cast(l_partkey as string) as id, cast(l_suppkey % 20 as string) as tenant_id,
  'i'||cast(l_orderkey % 50 as string) as investigation_id, l_returnflag as flag
from {lineitem}""",
    "f_networks": """
select '10.'||cast(s_suppkey as string)||'.0.0/16' as cidr, s_suppkey as id, s_name as description,
  case when s_nationkey % 5 = 0 then 'Bogus' else 'Internal' end as network_type
from {supplier}""",
    "f_network_upload": """
select '10.'||cast(p_partkey as string)||'.0.0/16' as cidr, p_name as description,
  case when p_size % 5 = 0 then 'Bogus' else 'Internal' end as network_type
from {part}""",
    "f_rules": """
select p_partkey as rule_id, p_name as name, p_brand as kind, p_type as event_type,
  timestamp '2024-01-01 00:00:00' + p_size * interval '1' day as updated_at, p_size % 7 = 0 as deleted,
  case p_size % 5 when 0 then '^(click|view)$' when 1 then '^error$' when 2 then 'sign.p' when 3 then '^purchase$' else 'a' end
    as title_pattern,
  p_partkey % 5 = 0 as title_inverted,
  case when p_size % 3 = 0 then '^sourceIpAddress:10[.]0[.]0[.]'||cast(p_size as string)||'$'
    else '^userName:u'||cast(p_size as string)||'$' end as entity_pattern
from {part}""",
    "f_raw_text": """
select doc_id, source as event_type, cast(doc_id % 20 as string) as tenant_id, lang,
  cast(doc_id % 40 as int) as day_offset, text from {documents}""",
    "f_schema_keys": """
select case when o_orderkey % 5 = 0 then 'short' when o_orderkey % 5 = 1 then null
    else 'x.'||lower(o_orderstatus)||'.field'||cast(o_orderkey as string)||'.sub' end as key, o_orderkey as n
from {orders}""",
    "f_investigations": """
select 'i'||cast(o_orderkey as string) as id,
  case o_orderstatus when 'O' then 'OPEN' when 'P' then 'DRAFT' else 'CLOSED' end as status,
  case when o_custkey % 7 = 6 then 'Merged Investigation: '||o_orderpriority else o_orderpriority end as title,
  o_custkey % 6 = 5 as archived
from {orders}""",
    "f_search_log": """
select cast(event_id as string) as id, cast(user_id % 20 as string) as tenant_id, event_type as query,
  cast(floor(value) as bigint) as results_returned, {usec} as inserted_time
from {events}""",
}
