"""Operators on small invented tables."""

import pytest
from pyspark.sql import functions as F

from rosterloom.operators import compare, dedup, layout, lookup, reconcile, search, tasks
from rosterloom.operators.registry import Pipeline, Registry
from rosterloom.sources import readers, sinks
from rosterloom.streaming import live

ROLL = "ord long, dni string, nombre string, escuela string, pagina long, observacion string, confirmada boolean"


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 3, "z"), (None, 1, "n")], "k string, ord int, v string")
    assert sorted(map(tuple, dedup.keep_first(df, ["k"], "ord").collect()), key=str) == [("a", 1, None), ("b", 3, "z"), (None, 1, "n")]
    assert sorted(map(tuple, dedup.keep_last(df, ["k"], "ord").collect()), key=str) == [("a", 2, "x"), ("b", 3, "z"), (None, 1, "n")]
    assert dedup.duplicates(df, ["k"], "ord").count() == 1


def test_survivorship(spark):
    a = [(1, "1", "ALFA", "", 1, "dato dudoso", False), (2, "1", "OTRA", "S9", 2, "", True), (3, "2", "BETA", "S1", 3, "", True), (4, "", "SIN", "S1", 3, "", True), (5, "3", "C", "S1", 9, "", True), (6, "3", "C2", "S1", 9, "", True)]
    b = [(1, "1", "ALFA UNO", "S2", 7, "", True), (2, "2", "BET", "S2", 8, "", True), (3, "9", "N", "S3", 8, "", False)]
    got = {(r["dni"], r["nombre"]): r for r in reconcile.survive(spark.createDataFrame(a, ROLL), spark.createDataFrame(b, ROLL)).collect()}
    assert set(got) == {("1", "ALFA UNO"), ("2", "BETA"), ("3", "C"), ("3", "C2"), ("9", "N")}
    one = got["1", "ALFA UNO"]
    assert (one["escuela"], one["pagina"], one["observacion"], one["confirmada"], one["cambios"]) == ("S2", 7, "", True, 3)
    assert got["2", "BETA"]["conflicto"] == "S1 vs S2"


def test_vote(spark):
    rows = [("e1", 1, 1, "7", "DNI", "A", "X", 3, 0.5), ("e2", 2, 1, "7", "LC", "B", "Y", 4, 0.9), ("e3", 3, 1, "7", "LC", "C", "Z", 0, 0.9), ("e1", 1, 2, "", "DNI", "N", "", 0, 0.1), ("e1", 1, 0, "7", "LE", "old", "", 9, 1.0)]
    got = {r["documento"]: r for r in reconcile.vote(spark.createDataFrame(rows, "engine string, engine_no long, ord long, documento string, tipo string, nombre string, destino string, mesa long, confianza double")).collect()}
    assert (got["7"]["tipo"], got["7"]["nombre"], got["7"]["mesa"], got["7"]["engines"]) == ("LC", "B", 3, 3) and got[""]["nombre"] == "N"


def test_lookup_cascade(spark):
    roll = spark.createDataFrame([(1, "0-069-MS-0001"), (2, "0-069-M5-0001"), (3, "0-069-J1-0002"), (4, "JUBILADO/A"), (5, "0-069-DM-0001")], "ord long, escuela string")
    codes = spark.createDataFrame([("MS1", 10, 2), ("MS 1", 11, 1), ("JI2", 12, 3)], "escuela_raw string, mesa long, ord long")
    got = {r["ord"]: (r["mesa"], r["pass"]) for r in lookup.assign_sites(roll, codes).collect()}
    assert got == {1: (11, 1), 2: (11, 3), 3: (12, 2), 4: (None, 0), 5: (None, 0)}


def test_nearest_and_first_match(spark):
    sites = spark.createDataFrame([(1, 10, 0.0, 1.0), (2, 20, 0.0, -1.0)], "ord long, mesa long, lat double, lng double")
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, -0.5)], "id long, lat double, lng double")
    assert {r["id"]: r["mesa"] for r in lookup.nearest_site(points, sites).collect()} == {1: 10, 2: 20}
    entries = spark.createDataFrame([(1, "a", ""), (2, "a", ""), (3, "b", "x")], "ord long, k string, v string")
    updates = spark.createDataFrame([(1, "a", ""), (2, "a", "new"), (3, "b", "y")], "ord long, k string, v string")
    assert [r["v"] for r in lookup.fill_first_match(entries, updates, "k", "v").orderBy("ord").collect()] == ["new", "", "x"]


def test_word_rows_use_the_anchor(spark):
    words = spark.createDataFrame([(1, i, y) for i, y in enumerate((0, 15, 30, 45, 60))], "page long, ord long, y int")
    assert [r["row"] for r in layout.word_rows(words).orderBy("ord").collect()] == [0, 0, 1, 1, 2]


def test_islands_and_sheets(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(["a", "a", "b", None, None, "a"])], "k long, pos long, v string")
    assert [r["island"] for r in layout.islands(df, ["k"], ["pos"], "v").orderBy("pos").collect()] == [0, 0, 1, 2, 2, 3]
    rows = spark.createDataFrame([(1, 0, None, "lost"), (1, 1, 5, "x"), (1, 2, None, "y"), (1, 3, 6, "")], "sheet long, pos long, mesa long, item string")
    assert [(r["mesa"], r["items"]) for r in layout.sheet_groups(rows).orderBy("grp").collect()] == [(5, ["x", "y"]), (6, [])]
    ahead = spark.createDataFrame([(1, 0, "y"), (1, 1, " "), (1, 2, "Sede"), (1, 3, "e")], "grp long, pos long, tail string")
    assert [r["location"] for r in layout.look_ahead(ahead).orderBy("pos").collect()] == ["Sede", "Sede", "Sede", "OTRO"]


def test_tasks(spark):
    done = spark.createDataFrame([(1, 7, [("a",), ("b",)])], "task_id long, volunteer_id long, records array<struct<dni:string>>")
    all_ = spark.createDataFrame([(1, [("a",), ("b",)]), (2, [("c",)])], "task_id long, records array<struct<dni:string>>")
    assert sorted(tuple(r) for r in tasks.verified_export(done, all_).collect()) == [(1, 1, "a", True, 7), (1, 2, "b", True, 7), (2, 1, "c", False, None)]
    assert tasks.verified_export(done, all_, include_unverified=False).count() == 2
    got = tasks.chunked(spark.range(1100).withColumnRenamed("id", "o"), "o", 500).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == [500, 500, 100]


def test_compare_and_search(spark):
    old, new = spark.createDataFrame([(1, "x"), (2, "y")], "id long, m string"), spark.createDataFrame([(2, "z"), (3, "w")], "id long, m string")
    diff = compare.snapshot_diff(old, new, "id", ["m"])
    assert sorted((r["id"], r["estado"], r["cambio"]) for r in diff.collect()) == [(1, "eliminada", False), (2, "mantiene", True), (3, "nueva", False)]
    with pytest.raises(Exception, match="unknown state"):
        spark.createDataFrame([("?",)], "s string").select(compare.status(F.col("s"))).collect()
    roll = spark.createDataFrame([(i,) for i in range(120)], "n int")
    assert search.unless_many(roll).count() == 0 and search.unless_many(roll, 200).count() == 120
    assert search.page_range(roll, "3-5", "n").count() == 3 and search.page_range(roll, "7", "n").count() == 1
    sites = spark.createDataFrame([(2, 9, ["MS-0007"]), (1, 8, ["MS-0007"])], "ord long, mesa long, codes array<string>")
    assert search.site_of_code(sites, "ms7").first()["mesa"] == 8


def test_registry_and_pipeline(spark):
    r = Registry()
    r.register("a", lambda x=1: x + 1)
    assert r.create("a", x=4) == 5 and r.available() == ["a"]
    with pytest.raises(KeyError):
        r.create("b")
    pages = spark.createDataFrame([(1, "MESA: 2\nDNI 90000001 ALFA UNO  0-069-MS-0042 5")], "page long, text string")
    steps = [{"name": n} for n in ("page_lines", "parse", "records")]
    assert Pipeline.from_config(steps).run(pages).count() == 1
    with pytest.raises(KeyError):
        Pipeline().add("nothing")


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("007", None), ("8", "x")], "DNI string, NOMBRE string")
    sinks.to_csv(df, f"{tmp_path}/c")
    assert sorted(r["DNI"] for r in readers.csv_strings(spark, f"{tmp_path}/c").collect()) == ["007", "8"]
    (tmp_path / "d.json").write_text('{"registros": [{"dni": "1"}, {"dni": "2"}]}')
    assert [tuple(r) for r in readers.json_records(spark, f"{tmp_path}/d.json", "dni string").collect()] == [(0, "1"), (1, "2")]
    (tmp_path / "coords.txt").write_text("M1|-34.5|-58.5\nM2||\n")
    assert [(r["mesa"], r["lat"]) for r in readers.coordinates(spark, f"{tmp_path}/coords.txt").orderBy("mesa").collect()] == [(1, -34.5), (2, None)]
    (tmp_path / "t").mkdir()
    (tmp_path / "t/pag_0012.txt").write_text("a\nb")
    assert [(r["page"], r["text"]) for r in readers.text_lines(spark, f"{tmp_path}/t").collect()] == [(12, "a\nb")]
    recs = spark.createDataFrame([(1, 1, "b"), (1, 0, "a")], "page long, pos long, v string")
    sinks.to_json_pages(recs, None, f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first()[0] == '{"page":1,"registros":[{"pos":0,"v":"a"},{"pos":1,"v":"b"}]}'
    made = sinks.write_batches(spark.range(7).coalesce(1), lambda rows: None, 3).collect()
    assert [r["rows"] for r in made] == [3, 3, 1]
    fetched = readers.collection(spark, lambda: iter([(1, "a")]), "id long, v string")
    assert [tuple(r) for r in fetched.collect()] == [(1, "a")]


def test_extracted_records(spark):
    doc = '```json\n{"records": [{"dni": "90.000.001", "nombre": " A B "}, {"dni": "12", "nombre": "CD"}, {"dni": "", "nombre": "x"}]}\n```'
    got = readers.extracted_records(spark.createDataFrame([(1, doc), (2, "broken")], "page long, json string")).orderBy("pos").collect()
    assert [(r["tipo"], r["dni"], r["nombre"], r["observacion"]) for r in got] == [("DNI", "90000001", "A B", ""), ("DNI", "", "CD", "original: 12")]


def test_stream_equals_batch(spark, tmp_path):
    feed = spark.createDataFrame([(1, 1, "pending", 5, 3), (1, 3, "done", 5, 3), (2, 2, "done", 6, 1), (2, 4, "removed", 6, 1)], "task_id long, ord long, status string, volunteer_id long, total_records long")
    feed.repartition(2).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = live.upsert_states(stream, f"{tmp_path}/states", f"{tmp_path}/ck")()
    key = lambda d: sorted(tuple(r) for r in d.select("task_id", "ord", "status").collect())
    assert key(got) == key(live.latest_states(feed)) == [(1, 3, "done")]


def test_windowed_counts_match_batch(spark, tmp_path):
    ev = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS ts, 'view' AS event_type UNION ALL SELECT timestamp_ntz'2024-01-02 10:00:00', 'view'")
    ev.write.parquet(f"{tmp_path}/e")
    q = live.windowed_counts(spark.readStream.schema(ev.schema).parquet(f"{tmp_path}/e")).writeStream.outputMode("complete").format("memory").queryName("windowed").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["n"] for r in spark.table("windowed").collect()) == [1, 1]
