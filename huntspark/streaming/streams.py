"""Streams of events and alerts.

Row-wise operators (timestamps, severity, inflate, entities, logical arrays) and the lookups that need no aggregation on
the stream side take a streaming frame as it is. What needs state is here.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from huntspark.functions.names import q
from huntspark.operators.evidence import COLUMNS, KEY
from huntspark.operators.process import correlation_key

#: Settings of a run whose state outgrows the memory of the executors. A stream that ends needs no batch that only drops state.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "64",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query that is started inside keeps its state in RocksDB, by memory of a fixed size; the session's settings come back after."""
    before = {k: spark.conf.get(k, None) for k in STATE_ON_DISK}
    try:
        for k, v in STATE_ON_DISK.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def daily_ioc_counts(events: DataFrame, iocs: DataFrame, time_column: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Events per (event_type, day, matching_value, tenant_id) that hold an indicator; a day is final once the watermark
    has passed it.

    ``events`` has one array column ``values`` of the values to look for; ``iocs`` is a static list.
    """
    wanted = iocs.select(F.col("value").alias("__value")).distinct()
    found = (
        events.withWatermark(time_column, delay)
        .withColumn("matching_value", F.explode(F.array_distinct("values")))
        .join(wanted, F.col("matching_value") == F.col("__value"), "left_semi")
    )
    return found.groupBy(
        F.window(q(time_column), "1 day").alias("day"), "event_type", "matching_value", "tenant_id"
    ).agg(F.count("*").alias("count"))


def open_daily_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The days of ``daily_ioc_counts`` that a stopped run has not given out yet, as they stand in its state: the closing pass of a
    stream that ended. Nothing of the source is read again."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.window").alias("day"), "key.event_type", "key.matching_value", "key.tenant_id", "value.count")


def staged_once(rows: DataFrame, time_column: str, delay: str = "1 day") -> DataFrame:
    """Evidence rows of a stream, each (id, investigation) once within the watermark."""
    return rows.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(KEY)


def staged_first(rows: DataFrame) -> DataFrame:
    """Evidence rows of a stream, each (id, investigation) once, ever: the smallest (type, tenant) of the micro-batch that brings it.

    The keys met so far are the operator's state, dealt over tasks by key and kept between batches, so a batch reads only the keys
    it holds, however many batches there were; the table that is written is never read. Equal rows of an Arrow batch are one
    row before they are shuffled. Nulls sort last.
    """

    def different(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop_duplicates()

    def first(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for frame in frames:
            for kind, tenant in zip(frame["evidence_type"], frame["tenant_id"]):
                row = (kind is None, kind or "", tenant is None, tenant or "")
                best = row if best is None else min(best, row)
        if state.exists or best is None:
            return
        state.update((True,))
        kind, tenant = None if best[0] else best[1], None if best[2] else best[3]
        yield pd.DataFrame({"evidence_type": [kind], "id": [key[0]], "tenant_id": [tenant], "investigation_id": [key[1]]}, dtype=object)

    texts = rows.select(*[q(c).cast("string").alias(c) for c in COLUMNS])
    schema = ", ".join(f"{c} string" for c in ["evidence_type", "id", "tenant_id", "investigation_id"])
    return texts.mapInPandas(different, texts.schema).groupBy("id", "investigation_id").applyInPandasWithState(
        first, schema, "seen boolean", "append", GroupStateTimeout.NoTimeout
    ).select(*COLUMNS)


def append_evidence(path: str):
    """``foreachBatch`` function: adds to the parquet table at ``path`` the keys it does not hold yet.

    Batches are partitions of the table, so a batch that is run again replaces what it wrote before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = F.min(F.struct("evidence_type", "tenant_id")).alias("__first")
        rows = batch.groupBy(*KEY).agg(first).select("__first.evidence_type", "id", "__first.tenant_id", "investigation_id")
        try:
            table = spark.read.parquet(path)
        except Exception as exc:  # no table yet
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            table = None
        if table is not None:
            old = table.where(F.col("batch") != batch_id).select(*[F.col(k).alias("__" + k) for k in KEY]).distinct()
            same = (rows["id"] == old["__id"]) & (rows["investigation_id"] == old["__investigation_id"])
            rows = rows.join(old, same, "left_anti")
        rows.select(*COLUMNS).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def netflow_key() -> Column:
    """The correlation id of the process that a flow belongs to."""
    return correlation_key(q("host_id"), q("pid"), q("timewindow"))


def correlate_netflow_stream(
    processes: DataFrame, netflow: DataFrame, within: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Left outer join of process events to the flows of the same process that start within ``within`` after them.

    Both sides have ``ts``; state is dropped once the watermarks make a match impossible.
    """
    left = processes.withWatermark("ts", delay)
    right = netflow.select(
        netflow_key().alias("netflow_process_correlation_id"),
        F.col("ts").alias("netflow_ts"),
        *[q(c).alias("netflow_" + c) for c in netflow.columns if c != "ts"],
    ).withWatermark("netflow_ts", delay)
    return left.join(
        right,
        (F.col("process_correlation_id") == F.col("netflow_process_correlation_id"))
        & (F.col("netflow_ts") >= F.col("ts"))
        & (F.col("netflow_ts") <= F.col("ts") + F.expr(f"interval {within}")),
        "leftOuter",
    )


def correlate_matches(
    processes: DataFrame, netflow: DataFrame, within: str = "1 day", delay: str = "1 hour", salts: int = 8, hot: list[int] | None = None
) -> DataFrame:
    """The matched rows of ``correlate_netflow_stream``, with every process spread over ``salts`` tasks.

    Both sides keep state, and a process with a third of all flows would keep its state in one task. Here a flow gets a salt from
    its content and a process event, of which there are few, stands once for each salt, so every pair still meets once. ``hot``, the
    ``hot_keys`` of flows seen before, says which processes are worth it: the events and flows of all others have one salt, or none. State
    follows the list, so a run that goes on from a checkpoint needs the list it began with.
    Processes without a flow are for the closing pass, ``with_unmatched``.
    """
    left = processes.withWatermark("ts", delay)
    columns = [
        netflow_key().alias("netflow_process_correlation_id"),
        F.col("ts").alias("netflow_ts"),
        *[q(c).alias("netflow_" + c) for c in netflow.columns if c != "ts"],
    ]
    pair = (
        (F.col("process_correlation_id") == F.col("netflow_process_correlation_id"))
        & (F.col("netflow_ts") >= F.col("ts"))
        & (F.col("netflow_ts") <= F.col("ts") + F.expr(f"interval {within}"))
    )
    if hot is None or hot:
        copies, salt = F.sequence(F.lit(0), F.lit(salts - 1)), F.pmod(F.xxhash64(*[q(c) for c in netflow.columns]), F.lit(salts))
        if hot:
            copies = F.when(F.xxhash64(q("process_correlation_id")).isin(hot), copies).otherwise(F.array(F.lit(0)))
            salt = F.when(F.xxhash64(netflow_key()).isin(hot), salt).otherwise(F.lit(0))
        left = left.withColumn("__salt", F.explode(copies))
        columns.append(salt.cast("int").alias("__part"))
        pair &= F.col("__salt") == F.col("__part")
    right = netflow.select(*columns).withWatermark("netflow_ts", delay)
    return left.join(right, pair).drop("__salt", "__part")


def with_unmatched(matches: DataFrame, processes: DataFrame, id_column: str) -> DataFrame:
    """The closing pass of a stream that ended: ``matches`` and the processes (a batch table) that no flow matched."""
    met = matches.select(q(id_column).alias("__met")).distinct()
    alone = processes.join(met, processes["`" + id_column + "`"] == met["__met"], "left_anti")
    return matches.unionByName(alone, allowMissingColumns=True)
