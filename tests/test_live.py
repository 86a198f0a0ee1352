"""The feed as a stream: restarts, news, broken batches, corrections, and the dashboard after each micro-batch."""

import random

import pytest

from rosterloom.sources import shared
from rosterloom.streaming import live

SCHEMA = "task_id long, ord long, status string, volunteer_id long, total_records long, volunteer_name string"


def changes(n, seed=1, tasks=40):
    rng = random.Random(seed)
    return [(rng.randrange(tasks), i, rng.choice(["pending", "assigned", "done", "done", "removed"]), rng.randrange(6), rng.randrange(50), f"v{rng.randrange(3)}") for i in range(n)]


class Feed:
    """A folder of parquet files, one for each set of changes."""

    def __init__(self, spark, path):
        self.spark, self.path, self.all, self.n = spark, str(path), [], 0

    def add(self, rows):
        self.all += rows
        self.n += 1
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{self.path}/in/f={self.n}")

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{self.path}/in")

    def states(self, **more):
        return live.upsert_states(self.stream(), f"file://{self.path}/states", f"{self.path}/ck", 4, **more)

    def batch(self):
        return live.latest_states(self.spark.createDataFrame(self.all, SCHEMA))


def same(a, b):
    key = lambda d: sorted(tuple(r) for r in d.select("task_id", "ord", "status", "volunteer_id").collect())
    return key(a) == key(b)


def test_restarts_and_news(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(changes(60))
    assert same(feed.states()(), feed.batch())
    assert same(feed.states()(), feed.batch())  # an idle restart
    feed.add([(3, 100, "done", 1, 5, "v"), (77, 50, "assigned", 2, 5, "v"), (4, -1, "pending", 1, 1, "late")])
    feed.add([(3, 101, "removed", 1, 5, "v")])
    assert same(feed.states()(), feed.batch())
    assert same(feed.states()(), feed.batch())


def test_a_batch_that_broke_off(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    feed.add(changes(30, 2))
    feed.states()
    before = feed.batch()
    feed.add(changes(30, 3))
    whole = live.StateTable.commit

    def killed(self, batch, manifest):
        raise RuntimeError("killed before the commit")

    monkeypatch.setattr(live.StateTable, "commit", killed)
    with pytest.raises(Exception, match="killed"):
        feed.states()
    table = live.StateTable(spark, f"file://{feed.path}/states", before.sparkSession.createDataFrame([], SCHEMA).schema)
    assert same(table.read(), live.latest_states(spark.createDataFrame(feed.all[:30], SCHEMA)))  # nothing of the broken batch is seen
    monkeypatch.setattr(live.StateTable, "commit", whole)
    assert same(feed.states()(), feed.batch())


def test_an_empty_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([])
    assert feed.states()().count() == 0


def test_only_touched_shards_are_written_and_old_ones_go(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(changes(200, 4))
    for i in range(5):
        feed.add([(7, 1000 + i, "assigned", 1, 1, "v")])
    read = feed.states()
    table = live.StateTable(spark, f"file://{feed.path}/states", spark.createDataFrame([], SCHEMA).schema)
    at = table.manifest()["at"]
    assert sorted(at.values()) == [0, 0, 0, 5] and len(table.batches()) == 2 and same(read(), feed.batch())
    kept = {v: [n for n in shared.names_in(spark, f"{feed.path}/states/states/v={v}") if n.startswith("shard=")] for v in range(6)}
    assert [len(kept[v]) for v in range(6)] == [3, 0, 0, 0, 1, 1]


def test_the_dashboard_after_each_batch(spark, tmp_path):
    """With late, removed and corrected rows: as the batch dashboard has it each time."""
    feed = Feed(spark, tmp_path)
    parts = [changes(25, 5), [(1, 90, "done", 2, 7, "a"), (2, 91, "done", 2, 9, "a")], [(1, 95, "assigned", 2, 7, "a"), (2, 96, "removed", 2, 9, "a")], [(1, 93, "done", 3, 7, "late")]]
    for p in parts:
        feed.add(p)
    shown = live.live_dashboard(feed.stream(), f"file://{feed.path}/states", f"{feed.path}/ck", 50, 4).orderBy("batch").collect()
    assert [r["batch"] for r in shown] == list(range(len(parts)))
    done = []
    for p, r in zip(parts, shown, strict=True):
        done += p
        want = live.dashboard(live.latest_states(spark.createDataFrame(done, SCHEMA)), 50).first()
        assert r.asDict() == {"batch": r["batch"]} | want.asDict()
    again = live.live_dashboard(feed.stream(), f"file://{feed.path}/states", f"{feed.path}/ck", 50, 4)
    assert again.count() == len(parts)


def test_lifecycle(spark):
    rows = [(1, 1, "pending"), (1, 2, "done"), (1, 3, "assigned"), (1, 4, "done"), (1, 5, "done"), (1, 6, None), (2, 1, "assigned"), (2, 2, "pending"), (2, 3, "removed"), (2, 4, "pending")]
    got = live.lifecycle(spark.createDataFrame(rows, "task_id long, ord long, status string")).orderBy("task_id", "ord").collect()
    assert [(r["before"], r["legal"]) for r in got] == [("", True), ("pending", False), ("pending", True), ("assigned", True), ("done", True), ("done", False), ("", False), ("", True), ("pending", True), ("removed", False)]
