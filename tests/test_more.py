"""The history query by brute force, the command line, districts and many sites."""

import math
import os
import random
from difflib import SequenceMatcher

import duckdb
import pytest

from rosterloom import cli
from rosterloom.functions.rules import BASE_RULES, rules_for
from rosterloom.operators import dedup, layout, lookup, tasks
from rosterloom.plans import more, queries, views
from rosterloom.sources import readers
from tests.test_oracle import rows

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_history_similarity(spark):
    past = {r["dni"]: r["nombre"] for r in sorted(views.history(spark, SF).collect(), key=lambda r: r["ord"]) if r["dni"]}
    marks = lambda x: sum(c in "ÁÉÍÓÚÑ" for c in x)
    junk = lambda x: any(c in "$[];{}|\\@#%" for c in x)
    want = {}
    for r in views.roster_a(spark, SF).collect():
        now, old = r["nombre"], past.get(r["dni"]) if r["dni"] else None
        if old is None:
            want[r["ord"]] = (None, None, "sin_historia", now)
        elif old.upper() == now.upper():
            want[r["ord"]] = (old, 1.0, "igual", now)
        else:
            s = SequenceMatcher(None, old.upper(), now.upper()).ratio()
            better = not junk(old) and (junk(now) or len(old) > len(now) + 2 or marks(old) > marks(now))
            action = "dni_dudoso" if s <= 0.6 else "corregido" if better else "nombre_ok"
            want[r["ord"]] = (old, round(s, 6), action, old if action == "corregido" else now)
    got = {r["ord"]: (r["nombre_past"], r["similitud"], r["accion"], r["nombre_final"]) for r in queries.QUERIES["history_similarity"](spark, SF).collect()}
    assert got == want and {x[2] for x in want.values()} == {"sin_historia", "igual", "corregido", "nombre_ok", "dni_dudoso"}


def test_scalar_texts_of_many_pages(spark, tmp_path):
    """Pages of five digits, which tables of a million members have, as the SQL has them."""
    at = str(tmp_path / "customer.parquet")
    keys = "explode(array(0, 59, 60, 599999, 600000, 600060, 899999, 999999)) AS c_custkey"
    spark.range(1).selectExpr(keys).selectExpr("CAST(c_custkey AS BIGINT) AS c_custkey", "'BUILDING' AS c_mktsegment").write.parquet(at)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{at}/*.parquet'")
    assert rows(queries.QUERIES["scalar_texts"](spark, str(tmp_path)).toPandas()) == rows(con.sql(more.SQL["scalar_texts"]).df())


def test_spans_of_one_place_and_number(spark):
    """Whatever order they come in, their places are the same."""
    spans = [(1, 4, 600.0, t, 8.0, f, 102.0, 234.0) for t, f in ((" t2342 ", "Plain"), ("t15222", "HvBold"), ("t15222", "Plain"), ("t9", "Plain"))] + [(1, 3, 600.0, "z", 8.0, "Plain", 102.0, 234.0)]
    columns = "page long, ord long, page_width double, text string, size double, font string, x0 double, y0 double"
    for x in (spans, spans[::-1]):
        got = layout.text_spans(spark.createDataFrame(x, columns).coalesce(1)).orderBy("pos").collect()
        assert [(r["text"], r["bold"], r["pos"]) for r in got] == [("z", False, 0), ("t15222", False, 1), ("t15222", True, 2), ("t2342", False, 3), ("t9", False, 4)]


def test_command_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "page_0003.txt").write_text("MESA: 4\nDNI 12345678 GOMEZ ANA  0-069-MS-0012 5\nDNI 22345678 SOSA LUIS  JUBILADO/A 6\n")
    (tmp_path / "in" / "page_0004.txt").write_text("LC 4345678 DIAZ EVA  0-069-PP-0001 2\n")
    cli.main(["text", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "-f", "csv", "json", "-p", "1-3"])
    got = readers.csv_strings(spark, str(tmp_path / "out/csv")).collect()
    assert sorted((r["page"], r["documento"], r["destino"], r["mesa"]) for r in got) == [("3", "12345678", "0-069-MS-0012", "5"), ("3", "22345678", "JUBILADO/A", "6")]
    cli.main(["report", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "-d", "001"])
    assert [r["value"][:20] for r in spark.read.text(str(tmp_path / "out/report")).orderBy("value").collect()] == ["page 0003: 2 records", "page 0004: 1 records"]
    with pytest.raises(SystemExit):
        cli.arguments(["text", "x", "-f", "pdf"])


def test_takes_in_runs(spark, tmp_path):
    """Two takes of each page first, then the rest, and the best of each: a take is read once."""
    src = tmp_path / "in"
    src.mkdir()
    line = "DNI 1234567{} GOMEZ ANA  0-069-MS-0012 5\n"
    for name, n in (("pag_0001 (1)", 1), ("pag_0001 (2)", 3), ("pag_0001 (3)", 2), ("pag_0002", 1), ("pag_0002 (4)", 0), ("other", 5)):
        (src / f"{name}.txt").write_text("".join(line.format(i) for i in range(n)) or "nothing here")
    out = str(tmp_path / "out")
    cli.main(["sample", str(src), "-o", out, "-n", "1"])
    done = lambda: sorted(r["page"] for r in cli.PageCache(f"{out}/cache").done(spark, "string").collect())
    assert done() == ["pag_0001 (1).txt", "pag_0002.txt"]
    cli.main(["full", str(src), "-o", out])
    assert len(done()) == 5 and len(set(done())) == 5
    cli.main(["full", str(src), "-o", out])
    assert len(done()) == 5
    cli.main(["combine", str(src), "-o", out])
    got = readers.csv_strings(spark, f"{out}/combined").collect()
    assert sorted((r["group"], r["source_file"], r["documento"]) for r in got) == [("pag_0001", "pag_0001 (2).txt", f"1234567{i}") for i in range(3)] + [("pag_0002", "pag_0002.txt", "12345670")]


def test_other_districts_have_the_base_rules():
    assert rules_for("001") == rules_for() == BASE_RULES and len(rules_for("069")) > len(BASE_RULES)


def brute_nearest(points, sites):
    def km(a, b):
        la, lb = math.radians(a[0]), math.radians(b[0])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    return {i: min((km((lat, lng), (s[2], s[3])), s[0]) for s in sites) for i, lat, lng in points}


@pytest.mark.parametrize("leaf", [2, 64])
def test_nearest_site_by_the_tree(spark, monkeypatch, leaf):
    """Clusters, one place many times, poles, the date line and points far from all: equal to brute force, ties to the first."""
    monkeypatch.setattr(lookup, "LEAF", leaf)
    rng = random.Random(3)
    sites = [(i, 1000 + i, rng.gauss(-34.6, 0.05), rng.gauss(-58.5, 0.05)) for i in range(300)]
    sites += [(300 + i, 1300 + i, -34.6, -58.5) for i in range(50)]
    sites += [(400, 1, 89.9, 10.0), (401, 2, 89.9, -170.0), (402, 3, 0.0, 179.9), (403, 4, 0.0, -179.8), (404, 5, -90.0, 0.0), (405, 6, 10.0, 20.0), (406, 7, 10.0, 20.0)]
    points = [(i, rng.gauss(-34.6, 0.2), rng.gauss(-58.5, 0.2)) for i in range(150)]
    points += [(200, 90.0, 0.0), (201, 0.0, 180.0), (202, 0.1, -179.95), (203, -89.99, 77.0), (204, 48.0, 2.0), (205, -34.6, -58.5), (206, 10.0, 20.0), (207, 35.0, 121.5)]
    got = lookup.nearest_site(spark.createDataFrame([*points, (208, None, 1.0)], "id long, lat double, lng double"), spark.createDataFrame(sites, "ord long, mesa long, lat double, lng double")).collect()
    want, by_ord = brute_nearest(points, sites), {s[0]: s[1] for s in sites}
    assert len(got) == len(points) + 1 and {r["id"]: r["mesa"] for r in got if r["id"] != 208} == {i: by_ord[o] for i, (_, o) in want.items()}
    assert all(r["km"] == pytest.approx(want[r["id"]][0], abs=1e-6) for r in got if r["id"] != 208) and next(r for r in got if r["id"] == 208)["mesa"] is None


def test_nearest_of_many_sites_has_no_product(spark):
    sites = spark.range(20_000).selectExpr("id AS ord", "id AS mesa", "(id % 173) / 3.0 - 28 AS lat", "(id * 7 % 359) / 2.0 - 90 AS lng")
    points = spark.range(3000).selectExpr("id", "(id % 97) / 2.0 - 24 AS lat", "(id * 11 % 301) / 2.0 - 75 AS lng")
    out = lookup.nearest_site(points, sites)
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = {r["id"]: (r["km"], r["mesa"]) for r in out.collect()}
    own = [tuple(r) for r in points.where("id % 101 = 0").collect()]
    want = brute_nearest(own, [tuple(r) for r in sites.collect()])
    assert len(got) == 3000 and all(got[i][0] == pytest.approx(km, abs=1e-6) and got[i][1] == o for i, (km, o) in want.items())


def test_nearest_of_few_or_none(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 0.0)], "id long, lat double, lng double")
    sites = lambda rows: spark.createDataFrame(rows, "ord long, mesa long, lat double, lng double")
    got = lookup.nearest_site(points, sites([(2, 20, 0.0, -1.0), (1, 10, 0.0, 1.0), (3, 30, None, None)])).orderBy("id").collect()
    assert [(r["id"], r["mesa"]) for r in got] == [(1, 10), (2, None)]
    assert [r["mesa"] for r in lookup.nearest_site(points, sites([])).collect()] == [None, None]


def test_a_page_of_very_many_words(spark):
    """Linear: a page of 100,000 words, and repeated places."""
    n = 100_000
    words = spark.range(n).selectExpr("1L AS page", "id AS ord", "(id * 7919) % 50021 AS y")
    rows = layout.word_rows(words).collect()
    want, anchor, row = {}, None, -1
    for y, o in sorted(((o * 7919) % 50021, o) for o in range(n)):
        if anchor is None or y - anchor > 20:
            anchor, row = y, row + 1
        want[o] = row
    assert {r["ord"]: r["row"] for r in rows} == want


def ordered(df, *by):
    return [r["place"] for r in df.orderBy(*by).select("place").collect()]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_places_of_wide_rows(spark, adaptive):
    """Each place once, in order, and no row lost: wide rows, one key of a third of them, repeats of whole rows, nulls."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        n = 300_000
        df = spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 1000 = 1 THEN NULL ELSE (id * 7919) % 100003 END AS k", "repeat('x', 64) AS pad", "id % 5 AS other")
        out = dedup.places(df, "k")
        s = out.selectExpr("count(*) AS n", "count(DISTINCT place) AS d", "min(place) AS low", "max(place) AS high").first()
        assert tuple(s) == (n, n, 0, n - 1)
        wrong = out.selectExpr("k", "lag(k) OVER (ORDER BY place) AS last").where("last > k OR (k IS NULL AND last IS NOT NULL)").count()
        assert wrong == 0 and out.columns == ["k", "pad", "other", "place"]
        if os.path.isdir(SF):
            orders = spark.read.parquet(f"{SF}/orders.parquet")
            again = tasks.chunked(orders, "o_orderkey", 7)
            assert ordered(again, "o_orderkey") == list(range(orders.count())) and again.drop("place", "batch").exceptAll(orders).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_places_of_nothing(spark):
    assert dedup.places(spark.createDataFrame([], "k long"), "k").count() == 0
