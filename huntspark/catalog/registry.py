"""The query registry and the input views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from huntspark.catalog.views import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


class Inputs:
    """Tables and views of one data folder. All scans are lazy; Spark prunes what a query does not use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __call__(self, view: str, **given: DataFrame) -> DataFrame:
        """A view over the tables, or over the frames given in their place, such as streams."""
        text = VIEWS[view].replace("{usec}", "unix_micros(cast(ts as timestamp))")
        used = {t: given.get(t) or self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def query(views: str = "", sql: str | None = None, recursive: bool = False, name: str | None = None):
    """Register ``fn(inputs)`` under its own or the given name; ``sql`` is the check, with the named views in front of it."""

    def register(fn: Callable[[Inputs], DataFrame]):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ctes = []
            for view in views.split():
                text = VIEWS[view].replace("{usec}", "epoch_us(ts)")
                for t in TABLES:
                    text = text.replace("{" + t + "}", t)
                ctes.append(f"{view} as ({text})")
            body = sql.strip()
            if ctes:
                joiner = ", " if body.lower().startswith("with ") else " "
                body = body[5:] if joiner == ", " else body
                body = f"with {'recursive ' if recursive else ''}{', '.join(ctes)}{joiner}{body}"
            ORACLES[key] = body
        return fn

    return register
