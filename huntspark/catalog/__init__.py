"""Every operator as a runnable query over the given tables, each with the SQL that must give the same rows."""

from huntspark.catalog.registry import ORACLES, QUERIES  # noqa: F401
from huntspark.catalog import alerts, entities, events, evidence, files, hunting, streams, tables, tenants  # noqa: F401,E402
