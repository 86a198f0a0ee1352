"""Workbooks there and back, batches that fail, collections over a local server, files of other shapes."""

import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from rosterloom.sources import batches, ooxml, paged, readers, sinks


def test_workbook_there_and_back(spark, tmp_path):
    rows = [("M1", "Escuela <1> & \"co\"", 12, -34.5, True, "https://example.org/?q=1,2&x=é"), ("M2", None, None, 1e20, False, None), ("M3", "  blanks  ", 7, 0.1, None, "")]
    df = spark.createDataFrame(rows, "mesa string, nombre string, n long, lat double, ok boolean, url string").coalesce(1)
    sinks.to_excel(df.withColumn("map", F.col("mesa")), f"{tmp_path}/a.xlsx", links={"map": "url"}, sheet="Mesas 2026")
    got = ooxml.cells(spark, f"{tmp_path}/a.xlsx").collect()
    at = {(r["pos"], r["col"]): r["value"] for r in got}
    assert {r["sheet"] for r in got} == {"Mesas 2026"} and [at[0, i] for i in range(6)] == ["mesa", "nombre", "n", "lat", "ok", "map"]
    assert [at.get((1, i)) for i in range(6)] == ["M1", 'Escuela <1> & "co"', "12", "-34.5", "True", "M1"]
    assert [at.get((2, i)) for i in range(6)] == ["M2", None, None, "1e+20", "False", "M2"] and at[3, 1] == "  blanks  "
    assert {(r["pos"], r["col"]): r["link"] for r in got if r["link"]} == {(1, 5): rows[0][5]}
    with pytest.raises(ValueError, match="more than 2 rows"):
        sinks.to_excel(df, f"{tmp_path}/b.xlsx", most=2)
    wide = readers.sheets(spark, f"{tmp_path}/a.xlsx", first_row=1)
    assert [(r["pos"], r["c0"], r["c2"]) for r in wide.orderBy("pos").collect()] == [(0, "M1", "12"), (1, "M2", None), (2, "M3", "7")]


def test_several_sheets(spark, tmp_path):
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "a string").coalesce(1)
    ooxml.write_workbook({"ZONA 1": df("x", "y"), "Resumen": df("z"), "ZONA/2": df()}, f"{tmp_path}/a.xlsx")
    got = readers.sheets(spark, f"{tmp_path}/a.xlsx").collect()
    assert sorted((r["sheet"], r["sheet_no"], r["pos"], r["c0"]) for r in got) == [("ZONA 1", 0, 0, "a"), ("ZONA 1", 0, 1, "x"), ("ZONA 1", 0, 2, "y"), ("ZONA 2", 2, 0, "a")]
    assert readers.sheets(spark, f"{tmp_path}/a.xlsx", only="Resumen").count() == 2


def test_foreign_workbook(spark, tmp_path):
    """As other programs write them: shared strings with runs, sparse rows without references, formulas, errors, parts by full path."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    rel = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'
    with zipfile.ZipFile(tmp_path / "f.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="S" sheetId="9" r:id="x1"/><sheet name="gone" sheetId="3" r:id="x7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships {rel}><Relationship Id="x1" Target="/xl/worksheets/other.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>one</t></si><si><r><t>t</t></r><r><t>wo</t></r><rPh><t>no</t></rPh></si></sst>")
        z.writestr("xl/worksheets/other.xml", f'<worksheet {ns}><sheetData><row r="3"><c r="B3" t="s"><v>1</v></c><c t="s"><v>0</v></c><c r="AA3"><v>1.50</v></c></row><row><c t="str"><f>A1</f><v>formula</v></c><c r="B4"/><c r="C4" t="e"><v>#N/A</v></c><c r="D4"><v>2.0</v></c></row></sheetData><hyperlinks><hyperlink ref="B3:B4" location="S!A1"/></hyperlinks></worksheet>')
    got = [(r["pos"], r["col"], r["value"], r["link"]) for r in ooxml.cells(spark, f"{tmp_path}/f.xlsx").orderBy("pos", "col").collect()]
    assert got == [(2, 1, "two", "S!A1"), (2, 2, "one", None), (2, 26, "1.5", None), (3, 0, "formula", None), (3, 2, "#N/A", None), (3, 3, "2", None)]


def test_columns():
    assert [ooxml.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert all(ooxml.column_number(ooxml.column_name(i) + "7") == i for i in range(2000))


class Away(batches.FolderStore):
    """Fails when a task stages its second batch."""

    def stage(self, job, batch, attempt, documents):
        if batch.endswith("-000001"):
            raise OSError("the store is away")
        super().stage(job, batch, attempt, documents)


def documents(root):
    out = []
    for p in sorted(root.glob("*.jsonl")):
        out.append([json.loads(x) for x in p.read_text().splitlines()])
    return out


def tasks_df(spark, n=1100):
    return spark.range(n).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'ALTA' ELSE 'MEDIA' END AS priority", "id % 7 AS total_records", "named_struct('a', id) AS nested").repartition(2)


def test_batches(spark, tmp_path):
    store = batches.FolderStore(str(tmp_path / "s"))
    job = batches.write_documents(tasks_df(spark), store, size=200, count_by="priority", add_up="total_records")
    got = documents(tmp_path / "s")
    assert sorted(d["id"] for b in got for d in b) == list(range(1100)) and max(map(len, got)) == 200 and got[0][0]["nested"]["a"] == got[0][0]["id"]
    p = store.progress(job)
    assert (p["documents"], p["batches"], p["alta"], p["media"], p["total total_records"]) == (1100, len(got), 367, 733, sum(i % 7 for i in range(1100)))
    batches.write_documents(tasks_df(spark, 50), store, job=job)  # that job is done
    assert len(documents(tmp_path / "s")) == len(got) and store.progress(job) == p
    assert store.clear() == len(got) and documents(tmp_path / "s") == []
    with pytest.raises(ValueError, match="1 to 500"):
        batches.write_documents(tasks_df(spark), store, size=501)


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    (tmp_path / "s").mkdir()
    store = Away(str(tmp_path / "s"))
    with pytest.raises(Exception, match="the store is away"):
        batches.write_documents(tasks_df(spark), store, job="j", size=200)
    assert documents(tmp_path / "s") == [] and not store.published("j") and not (tmp_path / "s/_staged/j").exists()
    # the same job again, with the store back
    batches.write_documents(tasks_df(spark), batches.FolderStore(str(tmp_path / "s")), job="j", size=200)
    assert sorted(d["id"] for b in documents(tmp_path / "s") for d in b) == list(range(1100))


def test_a_task_that_runs_again_counts_once(tmp_path, spark):
    """Two attempts stage the same batches; the one whose message comes is published."""
    store = batches.FolderStore(str(tmp_path))
    for attempt in ("1", "2"):
        store.stage("j", "000000-000000", attempt, [{"id": 1, "by": attempt}])
    w = batches.BatchWriter(store, "j", 500, None, None)
    w.commit([batches.Staged([("000000-000000", "2")], 1, {}), None])
    assert documents(tmp_path) == [[{"id": 1, "by": "2"}]] and store.progress("j")["documents"] == 1
    w.commit([batches.Staged([("000000-000000", "2")], 1, {})])
    assert documents(tmp_path) == [[{"id": 1, "by": "2"}]]


class Server(BaseHTTPRequestHandler):
    """Pages of documents in order of their keys; every third connection is cut."""

    docs: dict = {}
    asked: list = []

    def do_GET(self):
        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        Server.asked.append(q)
        if len(Server.asked) % 3 == 2:
            self.connection.close()
            return
        keys = [k for k in sorted(Server.docs) if k > q.get("cursor", "") and k >= q.get("start", "") and ("end" not in q or k < q["end"])]
        page = keys[: int(q.get("limit", 10**9))]
        more = page[-1] if page and (len(page) < len(keys) or "end" not in q and q.get("start") is None) else None
        body = json.dumps({"documents": [Server.docs[k] for k in page], "next": more}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *a):
        pass


@pytest.fixture
def server():
    Server.docs, Server.asked = {f"k{i:03d}": {"id": f"k{i:03d}", "n": i} for i in range(95)}, []
    s = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/docs"
    s.shutdown()


def test_paged_reading(spark, server):
    pages = paged.Pages(paged.http_pages(server), size=10, wait=0.01, attempts=6)
    df = paged.read_pages(spark, pages, "id string, n long, other string", cuts=["k030", "k060"])
    got = df.withColumn("part", F.spark_partition_id()).collect()
    assert sorted(r["id"] for r in got) == sorted(Server.docs) and all(r["n"] == int(r["id"][1:]) and r["other"] is None for r in got)
    assert len({r["part"] for r in got}) == 3 and {q.get("start") for q in Server.asked} == {None, "k030", "k060"}


def test_cut_for_good(spark, server):
    def away(first, end, cursor, size):
        raise OSError("no route")

    with pytest.raises(Exception, match="no route"):
        paged.read_pages(spark, paged.Pages(away, attempts=2, wait=0), "id string").collect()


def test_paged_stream_goes_on(spark, server, tmp_path):
    pages = paged.Pages(paged.http_pages(server), size=40, wait=0.01, attempts=6)

    def run():
        q = paged.stream_pages(spark, pages, "id string, n long").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck").trigger(processingTime="100 milliseconds").start(f"{tmp_path}/out")
        try:
            for _ in range(300):
                q.processAllAvailable() if not q.exception() else None
                if len(there()) >= len(Server.docs):
                    break
        finally:
            q.stop()

    def there():
        import glob

        return [r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()] if glob.glob(f"{tmp_path}/out/*.parquet") else []

    run()
    assert sorted(there()) == sorted(Server.docs)
    Server.docs |= {f"k{i:03d}": {"id": f"k{i:03d}", "n": i} for i in range(95, 120)}
    run()
    assert sorted(there()) == sorted(Server.docs)  # each once


def test_http_json(spark, server):
    got = paged.http_json(spark, [f"{server}?start=k090", f"{server}?end=k002"], "id string, n long", field="documents", wait=0.01)
    assert sorted(r["id"] for r in got.collect()) == ["k000", "k001", "k090", "k091", "k092", "k093", "k094"]


def test_photos(spark):
    prepared = spark.createDataFrame([("a", "1.jpg", 5, 1), ("b", "2.jpg", 5, 2), ("b", "gone.jpg", 5, 3), ("b", "3.jpg", None, 4)], "folder string, file string, page long, ord long")
    files = spark.createDataFrame([("a/1.jpg",), ("b/2.jpg",), ("b/3.jpg",)], "path string")
    got = readers.with_photos(spark.createDataFrame([(5,), (6,)], "page long"), readers.photos_by_page(prepared, files)).orderBy("page").collect()
    assert [tuple(r) for r in got] == [(5, "b/2.jpg", True), (6, None, False)]


def test_typed_csv_and_nested_images(spark, tmp_path):
    (tmp_path / "r.csv").write_text("TIPO,DNI,APELLIDO_NOMBRE,ESCUELA,OBSERVACION\nDNI,00123456,\"GOMEZ, ANA\",0-069-MS-0001,\nLC,,SOSA,,x\n", encoding="utf-8")
    got = readers.csv_typed(spark, f"{tmp_path}/r.csv", readers.ROLL_SCHEMA).orderBy("TIPO").collect()
    assert [tuple(r) for r in got] == [("DNI", "00123456", "GOMEZ, ANA", "0-069-MS-0001", None), ("LC", None, "SOSA", None, "x")]
    (tmp_path / "img/a/b").mkdir(parents=True)
    for n in ("img/pag_0002 (2).jpg", "img/a/pag_0002 (1).JPG", "img/a/b/pag_0010.jpg", "img/a/notes.txt", "img/x.jpg"):
        (tmp_path / n).write_bytes(b"x")
    got = readers.images_by_page(spark, f"{tmp_path}/img").orderBy("group").collect()
    assert [(r["group"], r["files"]) for r in got] == [("pag_0002", ["pag_0002 (1).JPG", "pag_0002 (2).jpg"]), ("pag_0010", ["pag_0010.jpg"])]
    (tmp_path / "img/a/pag_7 +1.txt").write_text("seven")
    assert {(r["file"], r["page"]) for r in readers.text_lines(spark, f"{tmp_path}/img/a/*.txt").collect()} == {("notes.txt", None), ("pag_7 +1.txt", 1)}


def test_rules_from_files(tmp_path):
    layers = [{"sanitize_rules": [{"pattern": "a(.)", "replacement": "$1"}]}, {"sanitize_rules": [{"pattern": "x.", "replacement": "y", "literal": True}]}]
    for i, layer in enumerate(layers):
        (tmp_path / f"{i}.json").write_text(json.dumps(layer))
    rules = readers.rule_layers(f"{tmp_path}/0.json", f"{tmp_path}/1.json")
    assert [r.pattern for r in rules] == ["a(.)", "x."]
    yaml = pytest.importorskip("yaml")
    (tmp_path / "r.yaml").write_text(yaml.safe_dump(layers[0]))
    assert readers.rule_layers(f"{tmp_path}/r.yaml") == rules[:1]


def test_clear_dry_run_rejects_and_classes(spark, tmp_path):
    from rosterloom.operators import parse, tasks

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n long, k string")
    df.write.parquet(f"{tmp_path}/t")
    rows, n = sinks.dry_run(df, 2)
    assert len(rows) == 2 and n == 3 and spark.read.parquet(f"{tmp_path}/t").count() == 3
    sinks.clear(df, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 0 and spark.read.parquet(f"{tmp_path}/t").columns == ["n", "k"]
    sinks.by_class(df, "k", f"{tmp_path}/k")
    assert sorted(p.name for p in (tmp_path / "k").glob("k=*")) == ["k=a", "k=b"]
    parsed = parse.parse_lines(spark.createDataFrame([(1, 0, "MESA: 3"), (1, 1, "DNI 90000001 ALFA UNO  0-069-MS-0042 5"), (1, 2, "DNI 12x y")], "page long, pos long, line string"))
    sinks.split_rejects(parsed, parse.records, parse.rejects, f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/s/records").count() == 1 and [r["partial"] for r in spark.read.parquet(f"{tmp_path}/s/rejects").collect()] == [True]
    line = sinks.quality_report(parse.page_quality(parse.records(parsed))).first()["line"]
    assert line == "page 0001: 1 records, 1 ids, 1.7% complete, MALA"
    docs = tasks.task_documents(spark.createDataFrame([(1, 1, "9", "x", "", "ALTA", None, [])], "page long, pos long, dni string, nombre string, escuela string, prioridad string, prod struct<dni:string>, diff array<string>"))
    light = tasks.without_records(docs)
    assert light.columns == ["page", "total_records", "status"] and light.first()["status"] == "pending"
