"""Resumable incremental processing: only new rows are realised, once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.session import scratch


def pending(plans: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return plans.join(done.select(key).distinct(), key, "left_anti")


def available_now(spark: SparkSession, source: str, schema, realise: Callable[[DataFrame], DataFrame], sink: str, state: str, files: int = 1) -> None:
    """Process the files that arrived since the last run, and stop. The checkpoint in
    state and the file sink's log make a restart continue where it ended."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    realise(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def resumed(spark: SparkSession, source: str, schema, realise: Callable[[DataFrame], DataFrame], runs: int = 2) -> DataFrame:
    """The sink after that many runs; more than one changes nothing."""
    sink, state = scratch(spark, "sink"), scratch(spark, "state")
    for _ in range(runs):
        available_now(spark, source, schema, realise, sink, state)
    return spark.read.parquet(sink)
