"""Calls to a service that may fail: attempts as data, with backoff, a bound on the rate, and a table of what never worked.

A round calls each item that is due once, in tasks, and writes what came of it; what failed is due again later. Rounds are
tables below one folder, so a run that is interrupted goes on where it was, and no item is called once more than its policy
allows, but for those of a round that was lost before it was written.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.sources.shared import delete, names_in

STATE = "attempt int, due double, status string, result string, error string"


@dataclass(frozen=True)
class Policy:
    """`attempts` calls at most; before the one after the n-th, first * factor^(n-1) seconds, `longest` at most (`step` more each time with factor 1).

    With `per_second`, all tasks together make no more calls a second: each of `tasks` tasks keeps its share of the rate.
    """

    attempts: int = 3
    first: float = 2.0
    factor: float = 2.0
    step: float = 0.0
    longest: float = 60.0
    per_second: float | None = None
    tasks: int = 1

    def wait(self, attempt: int) -> float:
        return min(self.longest, self.first * self.factor ** (attempt - 1) + self.step * (attempt - 1))


class Final(Exception):
    """What a call raises that no further attempt will mend."""


def _round(due: DataFrame, call: Callable[[dict], str], policy: Policy, now: float, pause: Callable[[float], None]) -> DataFrame:
    names = [f.name for f in due.schema if f.name not in ("attempt", "due", "status", "result", "error")]
    gap = policy.tasks / policy.per_second if policy.per_second else 0.0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                if gap and last is not None:
                    pause(max(0.0, gap - (time.monotonic() - last)))
                last, n = time.monotonic(), int(row["attempt"]) + 1
                try:
                    result, error, status = call({k: row[k] for k in names}), None, "done"
                except Final as e:
                    result, error, status = None, str(e), "dead"
                except Exception as e:
                    result, error, status = None, str(e), "retry" if n < policy.attempts else "dead"
                out.append({k: row[k] for k in names} | {"attempt": n, "due": now + policy.wait(n) if status == "retry" else row["due"], "status": status, "result": result, "error": error})
            yield pd.DataFrame(out, columns=[*names, "attempt", "due", "status", "result", "error"])

    tasks = due.repartition(policy.tasks) if policy.per_second else due
    return tasks.mapInPandas(run, due.schema)


def call_all(items: DataFrame, call: Callable[[dict], str], folder: str, policy: Policy = Policy(), now: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep, pause: Callable[[float], None] = time.sleep) -> tuple[DataFrame, DataFrame]:
    """Calls `call` (a row's fields to a text) on each of items; returns those that worked and those that never did, with their attempts and last errors.

    `now` and `sleep` are the driver's clock, `pause` the tasks'. A folder that holds rounds already goes on from the last whole one.
    """
    spark, folder = items.sparkSession, folder.rstrip("/")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in items.schema)}, {STATE}"
    whole = lambda n: "_SUCCESS" in names_in(spark, f"{folder}/round={n}")
    read = lambda n: spark.read.schema(schema).parquet(f"{folder}/round={n}")
    last = 0
    if not whole(0):
        start = items.withColumns({"attempt": F.lit(0), "due": F.lit(float(now())), "status": F.lit("retry"), "result": F.lit(None).cast("string"), "error": F.lit(None).cast("string")})
        start.write.mode("overwrite").parquet(f"{folder}/round=0")
    while whole(last + 1):
        last += 1
    while True:
        open_ = read(last).where("status = 'retry'")
        soonest = open_.agg(F.min("due")).first()[0]
        if soonest is None:
            break
        if soonest > now():
            sleep(soonest - now())
        at = now()
        due = F.col("due") <= at
        # what isn't due yet goes on as it is
        out = _round(open_.where(due), call, policy, at, pause).unionByName(open_.where(~due))
        out.write.mode("overwrite").parquet(f"{folder}/round={last + 1}")
        last += 1
    ends = spark.read.schema(f"{schema}, round int").parquet(*(f"{folder}/round={n}" for n in range(last + 1))).drop("round") if last else read(0)
    return ends.where("status = 'done'").drop("status", "due", "error"), ends.where("status = 'dead'").drop("status", "due", "result")


class PageCache:
    """Results by page, kept in runs: a page of a run that was committed isn't computed again, one of a run that broke off is.

    A run's records and the pages that it did are written first and count once its mark is there; no file is looked up for
    each page, so it holds for any number of pages. Pages whose records have an `error` are not done.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder.rstrip("/")

    def runs(self, spark) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in names_in(spark, f"{self.folder}/marks") if n.endswith(".json"))

    def done(self, spark, kind: str = "bigint") -> DataFrame:
        paths = [f"{self.folder}/run={n}/pages" for n in self.runs(spark)]
        return spark.read.schema(f"page {kind}").parquet(*paths) if paths else spark.createDataFrame([], f"page {kind}")

    def missing(self, pages: DataFrame) -> DataFrame:
        return pages.join(self.done(pages.sparkSession, pages.schema["page"].dataType.simpleString()).distinct(), "page", "left_anti")

    def update(self, pages: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The records of all runs (columns of compute's result), after the pages (page, ...) that are missing have been computed and kept."""
        from rosterloom.sources.shared import put_json, scratch, written

        spark = pages.sparkSession
        there = self.runs(spark)
        with scratch(spark):
            todo = written(self.missing(pages))
            shape = compute(todo).schema
            if todo.limit(1).count():
                n = (there[-1] if there else 0) + 1
                delete(spark, f"{self.folder}/run={n}")  # of a run that broke off
                records = written(compute(todo), path=f"{self.folder}/run={n}/records")
                fine = todo.select("page").distinct()
                if "error" in records.columns:
                    fine = fine.join(records.where("error IS NOT NULL").select("page").distinct(), "page", "left_anti")
                written(fine, path=f"{self.folder}/run={n}/pages")
                put_json(spark, f"{self.folder}/marks/{n}.json", {"run": n})
                there.append(n)
        paths = [f"{self.folder}/run={n}/records" for n in there]
        return spark.read.schema(shape).parquet(*paths) if paths else spark.createDataFrame([], shape)
