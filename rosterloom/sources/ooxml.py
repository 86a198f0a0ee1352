"""Workbooks (OOXML) without further packages: cells as a stream of rows, and a writer of sheets with links.

A workbook is read from the store that Spark reads, one file a task; its sheets are parsed as events, so of a sheet only
the row at hand is held beside the file's bytes and its shared strings.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.sources.shared import put_bytes

# Fixed values of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINKS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PARTS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
CELLS = "file string, sheet string, sheet_no int, pos long, col int, value string, link string"
BATCH = 10_000


def column_number(ref: str) -> int:
    """The column, from 0, of a reference such as AB12."""
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def column_name(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _related(book: zipfile.ZipFile, part: str) -> dict[str, str]:
    """What a part refers to, by id; paths of parts in full, addresses outside as they are."""
    folder, name = posixpath.split(part)
    rels = f"{folder}/_rels/{name}.rels"
    if rels not in book.namelist():
        return {}
    out = {}
    for r in ElementTree.fromstring(book.read(rels)).iter(f"{PARTS}Relationship"):
        target = r.get("Target", "")
        inside = r.get("TargetMode") != "External"
        out[r.get("Id", "")] = (target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))) if inside else target
    return out


def _text(element: ElementTree.Element) -> str:
    """The text of a string with its runs; what says how to read it aloud isn't part of it."""
    return "".join(t.text or "" for e in element if e.tag != f"{MAIN}rPh" for t in ([e] if e.tag == f"{MAIN}t" else e.iter(f"{MAIN}t")))


def _number(v: str) -> str:
    """A number as text: whole ones without a point."""
    try:
        x = float(v)
    except ValueError:
        return v
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


def read_cells(data: bytes) -> Iterator[tuple[str, int, int, int, str | None, str | None]]:
    """(sheet, its number, row, column, value, link) of all cells that hold something, rows and columns from 0, in order."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = set(book.namelist())
        parts = _related(book, "xl/workbook.xml")
        strings = [_text(s) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")] if "xl/sharedStrings.xml" in names else []
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
        for k, sheet in enumerate(sheets):
            part = parts.get(sheet.get(f"{LINKS}id", ""), "")
            if part in names:
                links = _sheet_links(book, part)
                for row, col, value in _sheet_cells(book, part, strings):
                    yield sheet.get("name", ""), k, row, col, value, links.get((row, col))


def _sheet_links(book: zipfile.ZipFile, part: str) -> dict[tuple[int, int], str]:
    out, to = {}, _related(book, part)
    with book.open(part) as f:
        for _, e in ElementTree.iterparse(f):
            if e.tag == f"{MAIN}hyperlink":
                ref = e.get("ref", "").split(":")[0]
                address = to.get(e.get(f"{LINKS}id", ""), e.get("location"))
                digits = re.search("[0-9]+", ref)
                if address and digits:
                    out[int(digits[0]) - 1, column_number(ref)] = address
            elif e.tag == f"{MAIN}row":
                e.clear()
    return out


def _sheet_cells(book: zipfile.ZipFile, part: str, strings: list[str]) -> Iterator[tuple[int, int, str]]:
    with book.open(part) as f:
        row = -1
        for event, e in ElementTree.iterparse(f, events=("start", "end")):
            if e.tag != f"{MAIN}row":
                continue
            if event == "start":
                row = int(e.get("r", row + 2)) - 1
                continue
            col = -1
            for c in e.iter(f"{MAIN}c"):
                col = column_number(c.get("r")) if c.get("r") else col + 1
                kind, v, inline = c.get("t", "n"), c.find(f"{MAIN}v"), c.find(f"{MAIN}is")
                if kind == "inlineStr" and inline is not None:
                    value = _text(inline)
                elif v is None or v.text is None:
                    continue
                elif kind == "s":
                    value = strings[int(v.text)]
                elif kind == "b":
                    value = "True" if v.text == "1" else "False"
                else:
                    value = _number(v.text) if kind == "n" else v.text
                yield row, col, value
            e.clear()


def cells(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, sheet_no, pos, col, value, link) of the workbooks at a path, a file, a folder or a pattern: a row for each cell that holds something."""
    types = spark.createDataFrame([], CELLS).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist(), strict=True):
                held = []
                for cell in read_cells(data):
                    held.append((name, *cell))
                    if len(held) == BATCH:
                        yield _batch(held, arrow)
                        held = []
                if held:
                    yield _batch(held, arrow)

    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "content")
    return files.mapInArrow(run, types)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def rows(all_cells: DataFrame, width: int | None = None) -> DataFrame:
    """(file, sheet, sheet_no, pos, c0, c1, ...) of cells, rows with a cell alone; as many columns as the widest row has, unless told."""
    if width is None:
        width = (all_cells.agg(F.max("col")).first()[0] or 0) + 1
    at = F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("_at")
    return all_cells.groupBy("file", "sheet", "sheet_no", "pos").agg(at).select("file", "sheet", "sheet_no", "pos", *(F.col("_at")[i].alias(f"c{i}") for i in range(width)))


# writing -----------------------------------------------------------------------------------------

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006"
_TYPES = "application/vnd.openxmlformats-officedocument.spreadsheetml"
#: Cell styles by number: plain, the header's (bold, centred), a link's (blue, underlined).
_STYLES = (
    f'{_HEAD}<styleSheet {_NS}><fonts count="3"><font/><font><b/></font><font><u/><color rgb="FF0563C1"/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
    '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/><xf fontId="1" applyFont="1" applyAlignment="1"><alignment horizontal="center"/></xf><xf fontId="2" applyFont="1"/></cellXfs></styleSheet>'
)
WIDEST = 50
#: What XML can't hold.
_BARRED = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def _cell(ref: str, value, style: int) -> str:
    s = f' s="{style}"' if style else ""
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}"{s} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        return f'<c r="{ref}"{s}><v>{value!r}</v></c>'
    return f'<c r="{ref}"{s} t="inlineStr"><is><t xml:space="preserve">{escape(_BARRED.sub("", str(value)))}</t></is></c>'


def workbook(sheets: list[tuple[str, list[str], list[tuple], dict[str, str]]]) -> bytes:
    """A workbook of sheets (name, header, rows, links): `links` names for a column the one that holds its addresses, which isn't shown."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        n = range(1, len(sheets) + 1)
        over = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_TYPES}.worksheet+xml"/>' for i in n)
        book.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_TYPES}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{_TYPES}.styles+xml"/>{over}</Types>')
        book.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PKG}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name={quoteattr(re.sub("[\\[\\]:*?/\\\\]", " ", s[0])[:31])} sheetId="{i}" r:id="rId{i}"/>' for i, s in zip(n, sheets, strict=True))
        book.writestr("xl/workbook.xml", f"{_HEAD}<workbook {_NS}><sheets>{names}</sheets></workbook>")
        rels = "".join(f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n)
        book.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PKG}/relationships">{rels}<Relationship Id="rId{len(sheets) + 1}" Type="{_REL}/styles" Target="styles.xml"/></Relationships>')
        book.writestr("xl/styles.xml", _STYLES)
        for i, sheet in zip(n, sheets, strict=True):
            _write_sheet(book, i, *sheet[1:])
    return out.getvalue()


def _write_sheet(book: zipfile.ZipFile, number: int, header: list[str], rows: list[tuple], links: dict[str, str]) -> None:
    shown = [i for i, c in enumerate(header) if c not in links.values()]
    address = {i: header.index(links[header[i]]) for i in shown if header[i] in links}
    widths = [min(WIDEST, max([len(header[i]), *(len(str(r[i])) for r in rows if r[i] is not None)]) + 2) for i in shown]
    refs: list[tuple[str, str]] = []
    with book.open(f"xl/worksheets/sheet{number}.xml", "w") as f:
        put = lambda x: f.write(x.encode())
        cols = "".join(f'<col min="{k}" max="{k}" width="{w}" customWidth="1"/>' for k, w in enumerate(widths, 1))
        put(f"{_HEAD}<worksheet {_NS}>{f'<cols>{cols}</cols>' if cols else ''}<sheetData>")
        put(f'<row r="1">{"".join(_cell(f"{column_name(k)}1", header[i], 1) for k, i in enumerate(shown))}</row>')
        for n, r in enumerate(rows, 2):
            out = []
            for k, i in enumerate(shown):
                ref, to = f"{column_name(k)}{n}", r[address[i]] if i in address else None
                if to:
                    refs.append((ref, str(to)))
                out.append(_cell(ref, r[i], 2 if to else 0))
            put(f'<row r="{n}">{"".join(out)}</row>')
        put("</sheetData>")
        if refs:
            put(f"<hyperlinks>{''.join(f'<hyperlink ref="{ref}" r:id="rId{k}"/>' for k, (ref, _) in enumerate(refs, 1))}</hyperlinks>")
        put("</worksheet>")
    if refs:
        to = "".join(f'<Relationship Id="rId{k}" Type="{_REL}/hyperlink" Target={quoteattr(x)} TargetMode="External"/>' for k, (_, x) in enumerate(refs, 1))
        book.writestr(f"xl/worksheets/_rels/sheet{number}.xml.rels", f'{_HEAD}<Relationships xmlns="{_PKG}/relationships">{to}</Relationships>')


def write_workbook(sheets: dict[str, DataFrame], path: str, links: dict[str, str] | None = None, most: int = 100_000) -> None:
    """A workbook with a sheet for each DataFrame, of at most `most` rows each; `links` as in `workbook`. It is a file for readers at a desk: more rows are an error, not cut."""
    out, spark = [], None
    for name, df in sheets.items():
        spark = df.sparkSession
        got = df.limit(most + 1).collect()
        if len(got) > most:
            raise ValueError(f"{name}: more than {most} rows")
        own = {a: b for a, b in (links or {}).items() if a in df.columns and b in df.columns}
        out.append((name, df.columns, [tuple(r) for r in got], own))
    if spark is None:
        raise ValueError("a workbook needs a sheet")
    put_bytes(spark, path, workbook(out))
