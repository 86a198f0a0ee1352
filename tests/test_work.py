"""Calls that fail, cached pages and the cascade of engines, with services that count."""

import os

import pytest
from pyspark.sql import functions as F

from rosterloom.operators import cascade
from rosterloom.streaming import retry


class Clock:
    def __init__(self):
        self.t, self.slept = 1000.0, []

    def now(self):
        return self.t

    def sleep(self, s):
        self.slept.append(round(s, 6))
        self.t += s


def service(folder, fails):
    """A call that fails so many times for each key, and leaves a line for each call."""

    def call(row):
        with open(f"{folder}/{row['key']}", "a") as f:
            f.write("x")
        with open(f"{folder}/{row['key']}") as f:
            n = len(f.read())
        if row["key"] == "never":
            raise retry.Final("no such page")
        if n <= fails.get(row["key"], 0):
            raise RuntimeError(f"try {n}")
        return f"{row['key']}:{n}"

    return call


def calls(folder):
    return {n: len((folder / n).read_text()) for n in os.listdir(folder)}


def test_attempts_and_waits(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    clock = Clock()
    items = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("never", 4)], "key string, payload int")
    call = service(tmp_path / "calls", {"b": 1, "c": 9})
    fine, dead = retry.call_all(items, call, f"{tmp_path}/r", retry.Policy(attempts=3, first=2), clock.now, clock.sleep)
    assert {(r["key"], r["payload"], r["attempt"], r["result"]) for r in fine.collect()} == {("a", 1, 1, "a:1"), ("b", 2, 2, "b:2")}
    assert {(r["key"], r["attempt"], r["error"]) for r in dead.collect()} == {("c", 3, "try 3"), ("never", 1, "no such page")}
    assert calls(tmp_path / "calls") == {"a": 1, "b": 2, "c": 3, "never": 1} and clock.slept == [2, 4]
    # nothing is called again
    retry.call_all(items, call, f"{tmp_path}/r", retry.Policy(attempts=3), clock.now, clock.sleep)
    assert calls(tmp_path / "calls") == {"a": 1, "b": 2, "c": 3, "never": 1}


def test_goes_on_where_it_was(spark, tmp_path):
    """The driver dies while it waits: another one does the rest."""
    (tmp_path / "calls").mkdir()
    clock = Clock()
    items = spark.createDataFrame([("a",), ("b",)], "key string")
    call = service(tmp_path / "calls", {"b": 2})

    def dies(s):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        retry.call_all(items, call, f"{tmp_path}/r", retry.Policy(attempts=4), clock.now, dies)
    fine, dead = retry.call_all(items, call, f"{tmp_path}/r", retry.Policy(attempts=4), clock.now, clock.sleep)
    assert {(r["key"], r["attempt"]) for r in fine.collect()} == {("a", 1), ("b", 3)} and not dead.count()
    assert calls(tmp_path / "calls") == {"a": 1, "b": 3}


def test_the_rate_is_shared(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    items = spark.createDataFrame([(f"k{i}",) for i in range(12)], "key string").repartition(6)

    def call(row):
        import time

        with open(f"{tmp_path}/calls/{row['key']}", "w") as f:
            f.write(str(time.time()))
        return ""

    fine, _ = retry.call_all(items, call, f"{tmp_path}/r", retry.Policy(per_second=20, tasks=2))
    at = sorted(float((tmp_path / "calls" / n).read_text()) for n in os.listdir(tmp_path / "calls"))
    assert fine.count() == 12 and at[-1] - at[0] >= 0.4


def test_waits():
    p = retry.Policy(first=15, factor=1, step=15)
    assert [p.wait(i) for i in (1, 2, 3)] == [15, 30, 45] and retry.Policy(longest=5).wait(9) == 5


def test_pages_are_computed_once(spark, tmp_path, monkeypatch):
    sent = []

    def compute(pages):
        def run(batches):
            for pdf in batches:
                pdf["v"] = pdf["page"] * 10
                pdf["error"] = [f"bad {p}" if p == 4 else None for p in pdf["page"]]
                yield pdf[pdf["page"] != 2]  # page 2 has no record

        sent.append(sorted(r["page"] for r in pages.collect()))
        return pages.mapInPandas(run, "page long, v long, error string")

    cache = retry.PageCache(f"file://{tmp_path}/cache")
    pages = lambda *n: spark.createDataFrame([(i,) for i in n], "page long")
    got = cache.update(pages(1, 2, 3), compute)
    assert sorted(r["v"] for r in got.collect()) == [10, 30] and sent[-1] == [1, 2, 3]
    sent.clear()
    assert cache.update(pages(1, 2, 3), compute).count() == 2 and all(x == [] for x in sent)
    sent.clear()
    cache.update(pages(1, 4, 5), compute)
    assert [4, 5] in sent
    assert [r["page"] for r in cache.missing(pages(1, 2, 3, 4, 5)).collect()] == [4]  # it failed
    # a run that breaks off before its mark
    from rosterloom.sources import shared

    with monkeypatch.context() as m:
        m.setattr(shared, "put_json", lambda *a: (_ for _ in ()).throw(RuntimeError("torn")))
        with pytest.raises(RuntimeError, match="torn"):
            cache.update(pages(6), compute)
    assert [r["page"] for r in cache.missing(pages(5, 6)).collect()] == [6]
    assert 60 in {r["v"] for r in cache.update(pages(6), compute).collect()}


class Double:
    """An engine that answers from a table and remembers what it was sent."""

    def __init__(self, name, answers, available=True):
        self.name, self.answers, self.available, self.sent = name, answers, available, []

    def is_available(self):
        return self.available

    def recognise(self, pages):
        self.sent.append(sorted(r["page"] for r in pages.select("page").collect()))
        rows = [(p, c, t) for p, c, t in self.answers]
        known = pages.sparkSession.createDataFrame(rows, "page long, confianza double, text string")
        return known.join(pages.select("page"), "page", "left_semi")


TEXT = {p: f"MESA: 2\nDNI 9000000{p} ALFA UNO  0-069-MS-0042 5" for p in range(1, 5)}


def engines(available=True):
    one = Double("one", [(1, 0.9, TEXT[1]), (2, 0.5, TEXT[2]), (3, 0.3, TEXT[3]), (4, 0.6, TEXT[4])])
    two = Double("two", [(p, 0.8, TEXT[p].replace("ALFA UNO", "ALFA DOS") + "\nDNI 90000009 BETA  0-069-MS-0042 6") for p in (2, 3)])
    three = Double("three", [(3, 0.8, TEXT[3].replace("5", "7"))], available)
    return one, two, three


def test_cascade_sends_gated_pages_alone(spark):
    pages = spark.createDataFrame([(p,) for p in range(1, 5)], "page long")
    one, two, three = engines()
    got = cascade.cascade(pages, one, two, three).collect()
    assert (one.sent, two.sent, three.sent) == ([[1, 2, 3, 4]], [[2, 3]], [[3]])
    assert {r["page"]: r["engine_used"] for r in got} == {1: "one", 2: "one+two", 3: "one+two+three", 4: "one"}
    assert sorted((r["page"], r["documento"]) for r in got) == [(1, "90000001"), (2, "90000002"), (2, "90000009"), (3, "90000003"), (3, "90000009"), (4, "90000004")]


def test_cascade_without_the_others(spark):
    pages = spark.createDataFrame([(p,) for p in range(1, 5)], "page long")
    one, two, three = engines(available=False)
    assert {r["engine_used"] for r in cascade.cascade(pages, one, two, three).collect()} == {"one", "one+two"} and three.sent == []
    assert {r["engine_used"] for r in cascade.cascade(pages, one, least=0.6).collect()} == {"one"}
    assert cascade.cascade(pages, one, least=0.75).count() == 0


def test_engine_contract(spark):
    pages = spark.createDataFrame([(1,)], "page long")
    cascade.check_engine(engines()[0], pages)
    with pytest.raises(TypeError, match="lacks one of"):
        cascade.check_engine(object(), pages)

    class Half(Double):
        def recognise(self, pages):
            return pages.withColumn("text", F.lit(""))

    with pytest.raises(TypeError, match="gives no confianza"):
        cascade.check_engine(Half("half", []), pages)
