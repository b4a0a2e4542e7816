"""Names and lists that results depend on."""

# Columns an analyst sees first, per event schema.
DEFAULT_COLUMNS: dict[str, list[str]] = {
    "agentdetection": ["host_id", "hostname", "detection_category", "detection_type", "image_path", "summary"],
    "antivirus": ["host_id", "action_taken", "threat_category", "threat_name", "user_name", "file_path"],
    "apicall": [
        "host_id", "hostname", "function_called", "was_modification_allowed", "was_operation_successful", "action",
        "commandline",
    ],
    "auth": ["source_address", "target_user_name", "action", "auth_system", "user_agent", "application_name"],
    "cloudaudit": ["source_address", "user_name", "event_type", "event_name", "mfa_used", "user_agent"],
    "detectionfinding": [],
    "dhcp": ["host_id", "hostname", "server_address", "client_address", "action"],
    "dnsquery": ["hostname", "os.os", "os.arch", "processcorrelationid.pid", "query_name", "query_type"],
    "email": ["host_id", "direction", "status", "event_type", "from_email_address", "subject"],
    "encrypt": ["host_id", "hostname", "source_address", "destination_address", "tls_version"],
    "filemod": [
        "host_id", "hostname", "parent_path", "process_image_path", "action", "file_name", "process_username",
    ],
    "generic": ["host_id", "hostname", "summary"],
    "http": [
        "source_username", "source_address", "destination_address", "destination_port", "user_agent", "http_method",
        "response_code", "uri_host", "uri_path", "tx_byte_count", "rx_byte_count",
    ],
    "managementevent": ["host_id", "hostname", "type", "channel", "operation", "username"],
    "netflow": [
        "hostname", "sensor_type", "protocol", "source_address", "destination_address", "destination_port",
        "dns_name",
    ],
    "nids": ["source_address", "destination_address", "action", "blocked", "enrichSummary"],
    "persistence": ["host_id", "hostname", "category", "command.program.path", "command.args"],
    "process": [
        "hostname", "os.os", "os.arch", "sensor_type", "username", "user_is_admin", "process_is_admin",
        "image_path", "commandline", "was_blocked",
    ],
    "processmodule": ["host_id", "hostname", "sensor_action", "file.path", "module_action"],
    "registry": [
        "host_id", "hostname", "event_type", "path", "process_image_path", "process_username", "value.name",
        "value.data32", "value.data64",
    ],
    "scriptblock": [
        "os.os", "os.arch", "interpreter_name", "interpreter_path", "script_name", "decoded_block_text",
    ],
    "thirdparty": ["source_address", "user_principal_name", "title", "ontology"],
    "threadinjection": ["host_id", "hostname", "source_process_name", "target_process_name", "thread_id"],
}

# Entity types of each logical type.
ENTITY_TYPES: dict[str, list[str]] = {
    "@ip": [
        "ipaddress", "sourceIpAddress", "ipAddress", "destIpAddress", "sourceIpGeo", "destIpGeo", "receiverIp",
        "senderIp", "sourceAddress", "targetIp", "targetIpAddress", "destAddress", "destinationAddress",
    ],
    "@domain": [
        "dnsName", "domainname", "ipDomain", "topPrivateIpDomain", "domainName", "queryName", "sourceHostnameFqdn",
        "targetHostnameFqdn", "uriHost", "domain",
    ],
    "@hash": ["md5", "sha1", "sha256", "sha512"],
    "@host": ["sourceHostName", "destHostName", "workstationName", "targetHostName", "hostName", "computerName"],
    "@user": ["userName", "username", "sourceUserName", "targetUserName"],
}

# Event columns that hold addresses, domains and hashes, per event schema.
IP_COLUMNS: dict[str, list[str]] = {
    "auth": ["target_address", "source_address"],
    "cloudaudit": ["source_address"],
    "dnsquery": ["source_address", "destination_address"],
    "http": ["source_address", "destination_address", "true_source_address"],
    "netflow": ["source_address", "destination_address", "source_nat_address", "destination_nat_address"],
    "nids": ["source_address", "destination_address"],
}
DOMAIN_COLUMNS: dict[str, list[str]] = {
    "auth": ["target_domain_name", "source_domain_name", "extra_targetoutbounddomainname"],
    "dnsquery": ["query_name"],
}
HASH_COLUMNS: dict[str, list[str]] = {
    "auth": [
        "process_file_hash", "process_file_hash.md5", "process_file_hash.sha1", "process_file_hash.sha256",
        "process_file_hash.sha512",
    ],
    "filemod": [
        "file_hash", "parent_process_file_hash.md5", "parent_process_file_hash.sha1",
        "parent_process_file_hash.sha256", "parent_process_file_hash.sha512", "process_file_hash.md5",
        "process_file_hash.sha1", "process_file_hash.sha256", "process_file_hash.sha512", "file_hash.md5",
        "file_hash.sha1", "file_hash.sha256", "file_hash.sha512",
    ],
    "process": [
        "program_hash.md5", "program_hash.sha1", "program_hash.sha256", "program_hash.sha512",
        "target_program.sha1_hash", "host_program.sha1_hash",
    ],
}

# Columns a process row may share with the table it pivots to.
PIVOT_COLUMNS: dict[str, list[str]] = {
    "netflow": ["host_id", "sensor_id", "sensor_tenant", "sensor_type", "tenant_id"],
    "http": ["host_id", "process_correlation_id", "sensor_id", "sensor_type", "tenant_id"],
    "auth": ["host_id", "process_correlation_id", "sensor_id", "sensor_type", "tenant_id"],
    "detectionfinding": ["host_id", "sensor_id", "sensor_tenant", "sensor_type", "tenant_id"],
}

# Evidence types.
ALERTS, EVENTS, SEARCH_QUERIES = "alerts", "events", "search_queries"

# Score of each rule severity and rank of each investigation priority.
RULE_SEVERITY: dict[str, float] = {"low": 0.2, "medium": 0.4, "high": 0.6, "critical": 0.8}
INVESTIGATION_PRIORITY: dict[str, int] = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}

# Lowest rounded severity of each category.
SEVERITY_FLOORS: list[tuple[str, float]] = [("Critical", 0.8), ("High", 0.6), ("Medium", 0.4), ("Low", 0.2)]
