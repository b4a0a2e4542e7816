"""The corpus pipeline: rejects toxic documents and near copies, drops documents with benchmark passages, mixes the sources
and writes token shards. Each stage works on all its predecessor kept and is written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huntspark.llm.common import table
from huntspark.llm.leaks import without_leaks
from huntspark.llm.mixing import mixed
from huntspark.llm.queries import written_documents
from huntspark.llm.simhash import near_copies
from huntspark.llm.toxicity import THRESHOLD, fit, scored
from huntspark.plans.lineage_cut import cut, shared_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; the model learns from the labelled rows of the training fold. All columns
    stay as they are, one named ``score`` too."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, "__score").where(F.col("__score") < THRESHOLD).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts whose fingerprints are linked, by the shingle length and the bits of ``near_copies``: that
    with the smallest doc_id (null last), then by the hash of its columns. Rows are told apart by a number that is written
    before it is used, so repeated rows, rows without an id and several texts of one id are rows like any other. Null and empty
    texts have one fingerprint and are one group."""
    usable = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = cut(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = near_copies(rows.select(F.col("__row").alias("doc_id"), "text"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*usable), "__row")
    grouped = rows.select("__row", place.alias("place")).join(found.select(F.col("doc_id").alias("__row"), "component_id"), "__row")
    kept = grouped.groupBy("component_id").agg(F.min("place").alias("place")).select(F.col("place.__row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed(docs).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the shard files written of the mix: doc_id, start, n_tokens, ids_crc32."""
    return written_documents(docs).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# Label models, fingerprints and alignment are not SQL: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
