"""A feed of task changes: latest states, the dashboard over them, and the same as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rosterloom.functions.numbers import half_even, half_up
from rosterloom.operators.dedup import places
from rosterloom.sources.shared import delete, get_json, names_in, put_json, scratch, written

MINUTES_PER_PAGE = 3


def latest_states(feed: DataFrame) -> DataFrame:
    """The last change (by ord) of each task of feed (task_id, ord, status, volunteer_id, total_records); removed tasks go."""
    last = feed.groupBy("task_id").agg(F.max_by(F.struct(*(c for c in feed.columns if c not in ("task_id", "ord"))), "ord").alias("_s"), F.max("ord").alias("ord"))
    return last.select("task_id", "ord", "_s.*").where(F.col("status") != "removed")


def dashboard(states: DataFrame, total: int) -> DataFrame:
    """One row: tasks by state, per cent done, records done, volunteers, minutes to go."""
    done, assigned = F.col("status") == "done", F.col("status") == "assigned"
    x = states.agg(
        F.count_if(done).alias("done"), F.count_if(assigned).alias("assigned"),
        F.coalesce(F.sum(F.when(done, F.col("total_records"))), F.lit(0)).alias("records_done"), F.count_distinct(F.when(done, F.col("volunteer_id"))).alias("volunteers"),
    )
    return _dashboard(x, total)


def _dashboard(x: DataFrame, total: int) -> DataFrame:
    left = F.lit(total) - F.col("done")
    return x.select(
        F.lit(total).cast("bigint").alias("total"), "done", "assigned", (left - F.col("assigned")).alias("pending"),
        F.when(F.lit(total) > 0, half_up(F.col("done") / F.lit(total) * 100)).otherwise(F.lit(0)).cast("bigint").alias("pct"),
        F.when(F.lit(total) > 0, half_even(F.col("done") / F.lit(total) * 100, 2)).otherwise(0.0).alias("completion_rate"),
        "records_done", "volunteers", half_up(left * MINUTES_PER_PAGE / F.greatest("volunteers", F.lit(1))).cast("bigint").alias("eta_minutes"),
    )


def leaderboard(states: DataFrame) -> DataFrame:
    """Volunteers by tasks done, under the name seen last, with their share of the most."""
    done = states.where("status = 'done' AND volunteer_id IS NOT NULL")
    x = done.groupBy("volunteer_id").agg(F.max_by("volunteer_name", "ord").alias("name"), F.count("*").alias("n"), F.sum("total_records").alias("records"))
    most = x.agg(F.max("n").alias("_most"))  # one row
    ranked = places(x.join(F.broadcast(most)).withColumn("_less", -F.col("n")), "_less", "volunteer_id")
    return ranked.select("volunteer_id", "name", "n", "records", F.round(F.col("n") / F.col("_most"), 6).alias("share"), (F.col("place") + 1).alias("rank"))


class StateTable:
    """The last change of each task, in shards by task, each at a version of its own; a manifest says which versions count.

    A micro-batch rewrites the shards that it touches and no others. It counts once its manifest is in place: a run that
    ends before that leaves files that nothing refers to, and the batch that runs again writes them anew; a batch whose
    manifest is there isn't merged again. Manifests hold each shard's share of the dashboard, too. The two newest
    manifests and what they refer to stay, so a reader that has begun can end; what is older goes.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, shards: int = 16) -> None:
        self.spark, self.folder, self.shards = spark, folder.rstrip("/"), shards
        self.rest = [f for f in schema.fields if f.name not in ("task_id", "ord")]
        self.schema = StructType([schema["task_id"], schema["ord"], *self.rest])

    def batches(self) -> list[int]:
        """The numbers of the batches that count, in order."""
        names = names_in(self.spark, f"{self.folder}/manifest")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, batch: int | None = None) -> dict:
        there = self.batches() if batch is None else [batch]
        return get_json(self.spark, f"{self.folder}/manifest/{there[-1]}.json") if there else {"shards": self.shards, "at": {}, "sums": {}}

    def _paths(self, manifest: dict, kind: str, only: list[int] | None = None) -> list[str]:
        return [f"{self.folder}/{kind}/v={v}/shard={k}" for k, v in manifest["at"].items() if only is None or int(k) in only]

    def _read(self, paths: list[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _last(self, df: DataFrame) -> DataFrame:
        latest = F.max_by(F.struct("ord", *(f.name for f in self.rest)), "ord").alias("_s")
        return df.groupBy("task_id").agg(latest).select("task_id", "_s.*")

    def merge(self, changes: DataFrame, batch: int) -> None:
        """Takes in a micro-batch of changes (task_id, ord, status, ...)."""
        there = self.batches()
        if batch in there:
            return
        old = self.manifest()
        shard = F.pmod(F.xxhash64("task_id"), F.lit(old["shards"])).cast("int").alias("shard")
        news = written(self._last(changes.select(self.schema.fieldNames())).select(shard, "*"), "shard")
        touched = sorted(r[0] for r in news.select("shard").distinct().collect())  # as many as there are shards
        states = f"{self.folder}/states/v={batch}"
        # removed tasks stay as marks, so that late changes don't revive them
        now = self._last(news.drop("shard").unionByName(self._read(self._paths(old, "states", touched), self.schema))).select("*", shard)
        now.repartition(max(1, len(touched)), "shard").write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(states)
        sums = self._sum_up(self.spark.read.schema(f"{_ddl(self.schema)}, shard int").parquet(states), batch) if touched else {}
        at = old["at"] | {str(k): batch for k in touched}
        self.commit(batch, {"shards": old["shards"], "at": at, "sums": old["sums"] | sums})
        self._clear(old, there, touched)

    def _sum_up(self, states: DataFrame, batch: int) -> dict:
        """Each shard's counts, and, beside the states, its volunteers with their tasks done."""
        done = F.col("status") == "done"
        who = states.where(done & F.col("volunteer_id").isNotNull()).groupBy("shard", "volunteer_id").agg(F.count("*").alias("n")) if "volunteer_id" in self.schema.fieldNames() else states.select("shard", F.lit(None).cast("long").alias("volunteer_id"), F.lit(0).cast("long").alias("n")).limit(0)
        who.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{self.folder}/volunteers/v={batch}")
        records = F.coalesce(F.sum(F.when(done, F.col("total_records"))), F.lit(0)) if "total_records" in self.schema.fieldNames() else F.lit(0)
        rows = states.groupBy("shard").agg(F.count_if(done), F.count_if(F.col("status") == "assigned"), records).collect()  # a row for each shard
        return {str(r[0]): [int(x) for x in r[1:]] for r in rows}

    def commit(self, batch: int, manifest: dict) -> None:
        put_json(self.spark, f"{self.folder}/manifest/{batch}.json", manifest)

    def _clear(self, old: dict, there: list[int], touched: list[int]) -> None:
        """What the manifest before the last one alone refers to."""
        for gone in there[:-1]:
            keep = old["at"].items()
            for k, v in self.manifest(gone)["at"].items():
                if (k, v) not in keep:
                    for kind in ("states", "volunteers"):
                        delete(self.spark, f"{self.folder}/{kind}/v={v}/shard={k}")
            delete(self.spark, f"{self.folder}/manifest/{gone}.json")

    def read(self) -> DataFrame:
        """The latest states, without those of removed tasks; empty before any batch."""
        return self._read(self._paths(self.manifest(), "states"), self.schema).where(F.col("status") != "removed")

    def dashboard(self, total: int) -> DataFrame:
        """What `dashboard` says of the latest states, from the shards' sums and their volunteers: no task is read."""
        m = self.manifest()
        done, assigned, records = (sum(x[i] for x in m["sums"].values()) for i in range(3))
        kind = next((f.dataType for f in self.rest if f.name == "volunteer_id"), LongType())
        paths = [p for p in self._paths(m, "volunteers") if names_in(self.spark, p)]  # a shard may have none
        who = self._read(paths, StructType([StructField("volunteer_id", kind), StructField("n", LongType())]))
        row = who.agg(F.count_distinct("volunteer_id").alias("volunteers"))
        return _dashboard(row.select(F.lit(done).cast("long").alias("done"), F.lit(assigned).cast("long").alias("assigned"), F.lit(records).cast("long").alias("records_done"), "volunteers"), total)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def upsert_states(feed_stream: DataFrame, folder: str, checkpoint: str, shards: int = 16, after: Callable[[StateTable, int], None] | None = None) -> Callable[[], DataFrame]:
    """Runs the stream of changes to its present end; returns a reader of the latest states, which are there after a restart without news, too.

    `after` is called with the state table once each batch counts (a live dashboard, say)."""
    table = StateTable(feed_stream.sparkSession, folder, feed_stream.schema, shards)

    def merge(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            table.merge(batch, number)
        if after:
            after(table, number)

    query = feed_stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return table.read


def live_dashboard(feed_stream: DataFrame, folder: str, checkpoint: str, total: int, shards: int = 16) -> DataFrame:
    """The dashboard as a stream: a row for each micro-batch (batch), as `dashboard` would have it of all changes up to then."""
    spark, out = feed_stream.sparkSession, f"{folder.rstrip('/')}/dashboard"

    def show(table: StateTable, number: int) -> None:
        table.dashboard(total).write.mode("overwrite").parquet(f"{out}/batch={number}")

    upsert_states(feed_stream, folder, checkpoint, shards, show)
    schema = dashboard(spark.createDataFrame([], feed_stream.schema), total).schema
    if not names_in(spark, out):
        return spark.createDataFrame([], StructType([StructField("batch", LongType()), *schema.fields]))
    return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(out).select("batch", *schema.fieldNames())


#: The moves of a task that count, from its state before any change on.
MOVES = (("", "pending"), ("pending", "assigned"), ("assigned", "done"), ("assigned", "pending"), ("done", "assigned"), *((x, "removed") for x in ("pending", "assigned", "done")))


def lifecycle(feed: DataFrame, moves: tuple[tuple[str, str], ...] = MOVES) -> DataFrame:
    """feed (task_id, ord, status, ...) with `before`, the task's state when the change came, and `legal`: a change that isn't leaves the state as it was.

    Whether a change is legal depends on those before it, so a task's changes are a fold in their order; a task has few. Repeats
    of the state that a task has are legal and change nothing.
    """
    ok = F.array(*(F.lit(f"{a}>{b}") for a, b in moves))
    rows = feed.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("ord", *(c for c in feed.columns if c not in ("task_id", "ord"))))).alias("_all"))
    start = F.struct(F.lit("").alias("now"), F.array().cast("array<struct<before:string,legal:boolean>>").alias("out"))

    def step(acc, c):
        fine = (c["status"] == acc["now"]) | F.array_contains(ok, F.concat(acc["now"], F.lit(">"), c["status"]))
        fine = F.coalesce(fine, F.lit(False))
        return F.struct(F.when(fine, c["status"]).otherwise(acc["now"]).alias("now"), F.concat(acc["out"], F.array(F.struct(acc["now"].alias("before"), fine.alias("legal")))).alias("out"))

    folded = rows.select("task_id", F.explode(F.arrays_zip("_all", F.aggregate("_all", start, step)["out"].alias("_out"))).alias("_x"))
    return folded.select("task_id", "_x._all.*", "_x._out.before", "_x._out.legal").select(*feed.columns, "before", "legal")


def unseen(items: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """What a resumable run has still to do: all but the items whose state is done."""
    return items.join(state.where("status = 'done'").select(key).distinct(), key, "left_anti")


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts by event-time window; ts without a zone is taken as UTC, as the session should be."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
