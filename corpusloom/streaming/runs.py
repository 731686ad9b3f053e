"""Runs over cohorts: realizers with retries, checkpoints by key, states, gates, events."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import scratch, written

#: A realizer turns the fields of a request (a dict) into text, or raises.
Realizer = Callable[[dict], str]
REALIZERS: dict[str, Realizer] = {}


def realizer(name: str) -> Callable[[Realizer], Realizer]:
    """Registers a realizer; one that calls a service is registered by who has it."""

    def register(f: Realizer) -> Realizer:
        REALIZERS[name] = f
        return f

    return register


@realizer("template")
def _template(request: dict) -> str:
    """The deterministic writer: the draft, rephrased by a frame."""
    return f"Please say: {request['question']}"


def realized(requests: DataFrame, key: str, write: Realizer, retries: int = 2) -> DataFrame:
    """(key, status, attempts, text, errors): each request tried up to retries + 1 times."""
    kind = requests.schema[key].dataType.simpleString()

    def tried(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for request in batch.to_dict("records"):
                errors: list[str] = []
                text = None
                while text is None and len(errors) <= retries:
                    try:
                        text = write({**request, "attempt": len(errors)})
                    except Exception as e:  # noqa: BLE001  (whatever a service raises)
                        errors.append(f"{type(e).__name__}: {e}")
                rows.append((request[key], "failed" if text is None else "accepted", min(len(errors) + 1, retries + 1), text, errors))
            yield pd.DataFrame(rows, columns=[key, "status", "attempts", "text", "errors"])

    return requests.mapInPandas(tried, f"{key} {kind}, status string, attempts int, text string, errors array<string>")


class Checkpoints:
    """Results by key in one folder, a batch at a time: each is a set of whole files, told
    by its number, so a run that is cut leaves no half of one. The last batch wins."""

    def __init__(self, spark: SparkSession, key: str, path: str | None = None):
        self.spark, self.key, self.path = spark, key, path or scratch(spark, "checkpoints")
        self.batches = 0

    def add(self, results: DataFrame) -> None:
        results.write.mode("overwrite").parquet(f"{self.path}/batch={self.batches}")
        self.batches += 1

    def results(self) -> DataFrame | None:
        if not self.batches:
            return None
        rows = self.spark.read.parquet(self.path)
        last = rows.groupBy(self.key).agg(F.max("batch").alias("batch"))
        return rows.join(last, [self.key, "batch"], "left_semi").drop("batch")

    def pending(self, requests: DataFrame) -> DataFrame:
        done = self.results()
        return requests if done is None else requests.join(done.select(self.key).distinct(), self.key, "left_anti")


def progress(requests: DataFrame, results: DataFrame, key: str, group: str) -> DataFrame:
    """(group, n, done, pending) of each cohort."""
    done = results.select(key).distinct().withColumn("__d", F.lit(True))
    j = requests.select(group, key).distinct().join(done, key, "left")
    return j.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count("__d").alias("done")).withColumn("pending", F.col("n") - F.col("done"))


def failure_checkpoints(requests: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """What stands for the requests without a result: an item for review, with the reason."""
    left = requests.join(results.select(key).distinct(), key, "left_anti")
    return left.select(key, F.lit("review_required").alias("status"), F.array(F.lit("generation_failure_after_retries")).alias("reasons"))


#: What of an error's text tells that the service is at fault.
INFRASTRUCTURE = ("http error 429", "http error 500", "http error 502", "http error 503", "http error 504", "timed out", "timeout", "connection refused", "connection reset", "remote end closed", "temporary failure", "name or service not known")


def infrastructure(errors: Column, last: int = 9) -> Column:
    """Whether all of the last errors are a service's; false without any."""
    recent = F.slice(errors, F.greatest(F.size(errors) - last + 1, F.lit(1)), last)
    known = lambda e: F.exists(F.array(*map(F.lit, INFRASTRUCTURE)), lambda m: F.lower(e).contains(m))
    return (F.size(errors) > 0) & F.forall(recent, known)


def gate(failures: DataFrame, reviews: DataFrame, hard: list[str]) -> DataFrame:
    """One row (passed, reason): a cohort's audit passes without failures (column n) and
    without a review's reason (column reasons) that stops the run."""
    n = failures.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    found = reviews.select(F.explode("reasons").alias("r")).where(F.col("r").isin(*hard)).agg(F.array_sort(F.collect_set("r")).alias("r"))
    reason = F.when(F.col("n") > 0, "automatic_audit_failed").when(F.size("r") > 0, F.concat(F.lit("hard_review_reason:"), F.array_join("r", ",")))
    return n.crossJoin(found).select(reason.isNull().alias("passed"), reason.alias("reason"))  # one row each


#: The states of a run, and what may follow each.
TRANSITIONS = {
    "INITIALIZED": {"RUNNING"},
    "RUNNING": {"PAUSED_BY_REQUEST", "PAUSED_MANUAL_REVIEW", "WAITING_FOR_API", "BLOCKED_AUDIT", "BLOCKED_DISK", "COMPLETE"},
    "PAUSED_BY_REQUEST": {"READY_TO_RESUME"},
    "PAUSED_MANUAL_REVIEW": {"READY_TO_RESUME"},
    "WAITING_FOR_API": {"RUNNING", "PAUSED_BY_REQUEST"},
    "BLOCKED_AUDIT": {"READY_TO_RESUME"},
    "BLOCKED_DISK": {"READY_TO_RESUME"},
    "READY_TO_RESUME": {"RUNNING"},
    "COMPLETE": set(),
}


class Run:
    """A run's state and its events, in order; the driver keeps one."""

    def __init__(self) -> None:
        self.state, self.events = "INITIALIZED", [{"seq": 1, "event": "INITIALIZED", "detail": "{}"}]

    def to(self, state: str, **detail: object) -> Run:
        if state not in TRANSITIONS[self.state]:
            raise ValueError(f"{state} cannot follow {self.state}")
        self.state = state
        self.events.append({"seq": len(self.events) + 1, "event": state, "detail": json.dumps(detail, sort_keys=True)})
        return self

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(e["seq"], e["event"], e["detail"]) for e in self.events], "seq long, event string, detail string")


def events_appended(log: DataFrame, new: DataFrame) -> DataFrame:
    """An event log with new rows (event, detail) behind, numbered on; written anew."""
    last = log.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    from corpusloom.functions.ids import ordinals

    numbered = ordinals(new, new.columns, "seq").withColumn("seq", F.col("seq") + last)
    return written(log.unionByName(numbered.select(*log.columns)), "events")


def changed_inputs(before: DataFrame, after: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, change): inputs that were added, removed or changed since they were hashed."""
    j = before.select(key, F.col(digest).alias("b")).join(after.select(key, F.col(digest).alias("a")), key, "full")
    change = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return j.select(key, change.alias("change")).where("change is not null")
