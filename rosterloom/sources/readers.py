"""Sources: files of several shapes to DataFrames with explicit schemas."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.functions.rules import Rule, load_rules
from rosterloom.functions.text import first_of, id_digits, leading_int
from rosterloom.operators.dedup import keep_last
from rosterloom.sources import ooxml

ROLL_SCHEMA = "TIPO string, DNI string, APELLIDO_NOMBRE string, ESCUELA string, OBSERVACION string"
#: Names that the same field has in different files, in the order in which they are looked for.
ALIASES = {
    "tipo": ("TIPO", "tipo"),
    "dni": ("DNI", "DOCUMENTO", "documento", "dni"),
    "nombre": ("APELLIDO_NOMBRE", "NOMBRE", "nombre"),
    "escuela": ("ESCUELA", "DESTINO", "distrito_escuela", "escuela"),
    "observacion": ("OBSERVACION", "observacion"),
}


def csv_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a given schema; ids are strings, so zeros before stay."""
    return spark.read.csv(path, header=True, schema=schema)


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all strings."""
    return spark.read.option("inferSchema", False).csv(path, header=True)


def json_records(spark: SparkSession, path: str, schema: str, field: str = "registros") -> DataFrame:
    """A row for each element of the array `field` of each JSON document; `schema` is an element's."""
    docs = spark.read.json(path, schema=f"{field} array<struct<{_struct(schema)}>>", multiLine=True)
    return docs.select(F.posexplode(field).alias("ord", "r")).select(F.col("ord").cast("bigint").alias("ord"), "r.*")


def _struct(schema: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (x.split() for x in schema.split(", ")))


def canonical(df: DataFrame) -> DataFrame:
    """One file's columns under the canonical names; the first alias that exists counts, even where it is blank."""
    return df.select(*(first_of(*names, columns=df.columns).cast("string").alias(n) for n, names in ALIASES.items()))


def union_variants(*variants: DataFrame) -> DataFrame:
    """Files of different headers as one roll."""
    out = canonical(variants[0])
    for v in variants[1:]:
        out = out.unionByName(canonical(v), allowMissingColumns=True)
    return out


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, page and text of each text file, whole; page from the last number of its name."""
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # Spark has blanks and the like as in an address
    x = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(name.alias("file"), F.col("value").alias("text"))
    return x.withColumn("page", page_of(F.col("file")))


def page_of(name):
    return F.regexp_extract(name, r"([0-9]+)[^0-9]*\.[A-Za-z0-9]+$", 1).try_cast("bigint")


def images_by_page(spark: SparkSession, path: str) -> DataFrame:
    """pag_NNNN (K).jpg and the like: the sorted files of each page. Paths only: no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[jJ][pP][gG]").load(path).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"))
    x = files.withColumn("group", F.regexp_extract("file", r"^(pag_[0-9]+)", 1)).where("group <> ''")
    return x.groupBy("group").agg(F.array_sort(F.collect_list("file")).alias("files"))


def coordinates(spark: SparkSession, path: str) -> DataFrame:
    """mesa|lat|lng; blank coordinates are null."""
    return spark.read.csv(path, sep="|", schema="mesa string, lat double, lng double", nullValue="", mode="PERMISSIVE").withColumn("mesa", leading_int(F.regexp_replace("mesa", "^M", "")))


def lookup_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(rows, schema)


def sheets(spark: SparkSession, path: str, skip: tuple[str, ...] = ("RESUMEN",), first_row: int = 0, only: str | None = None) -> DataFrame:
    """All sheets of workbooks but those in `skip` (whatever their case), or the one named, as (file, sheet, sheet_no, pos, c0, c1, ...) strings.

    As many columns as the widest row has; rows without any cell are left out, `pos` counts them from `first_row` on. Old
    binary workbooks (xls) go through `old_sheets`.
    """
    x = ooxml.cells(spark, path).where(F.col("pos") >= first_row)
    x = x.where(F.col("sheet") == only) if only else x.where(~F.upper("sheet").isin(*(s.upper() for s in skip))) if skip else x
    return ooxml.rows(x.withColumn("pos", F.col("pos") - first_row))


def old_sheets(spark: SparkSession, path: str, only: str | int = 0) -> DataFrame:
    """One sheet of an old binary workbook as (sheet, pos, c0, c1, ...) strings; pandas needs xlrd for it, which may be absent. Such a sheet has 65,536 rows at most."""
    import pandas as pd

    df = pd.read_excel(path, sheet_name=only, header=None, dtype=str)
    columns = [f"c{i}" for i in range(df.shape[1])]
    rows = df.set_axis(columns, axis=1).assign(sheet=str(only), pos=range(len(df)))[["sheet", "pos", *columns]].astype(object)
    return spark.createDataFrame(rows.where(rows.notna(), None), ", ".join(["sheet string", "pos long", *(f"{c} string" for c in columns)]))


def photos_by_page(prepared: DataFrame, files: DataFrame) -> DataFrame:
    """page -> photo of prepared photos (folder, file, page, ord) whose file exists in files (path): the last of a page counts."""
    x = prepared.withColumn("photo", F.concat_ws("/", "folder", "file"))
    there = x.join(files.select(F.col("path").alias("photo")).distinct(), "photo", "left_semi")
    return keep_last(there.where(F.col("page").isNotNull()).select("page", "photo", "ord"), ["page"], "ord").select("page", "photo")


def with_photos(pages: DataFrame, photos: DataFrame) -> DataFrame:
    """pages with photo (null without one) and has_photo."""
    return pages.join(photos, "page", "left").withColumn("has_photo", F.col("photo").isNotNull())


def rule_layers(*paths: str) -> tuple[Rule, ...]:
    """Rules from files, the base first: JSON by its name, else YAML (needs PyYAML). Rules are configuration, read on the driver."""
    layers = []
    for p in paths:
        with open(p, encoding="utf-8") as f:
            if p.endswith(".json"):
                layers.append(json.load(f))
            else:
                import yaml

                layers.append(yaml.safe_load(f))
    return load_rules(layers)


def extracted_records(df: DataFrame, column: str = "json") -> DataFrame:
    """Records from JSON text as a language model returns it: defaults for missing fields, digits only in ids of 7 or 8 digits; other ids move to the note."""
    schema = "struct<records: array<struct<tipo: string, dni: string, nombre: string, escuela: string, observacion: string>>>"
    from rosterloom.functions.text import fenced_json

    r = df.select("page", F.posexplode(fenced_json(F.col(column), schema)["records"]).alias("pos", "r"))
    digits = id_digits(F.col("r.dni"))
    fine = F.length(digits).between(7, 8)
    note = F.coalesce("r.observacion", F.lit(""))
    moved = F.when(~fine & (F.coalesce("r.dni", F.lit("")) != ""), F.trim(F.concat_ws(" ", note, F.concat(F.lit("original: "), F.col("r.dni"))))).otherwise(note)
    out = r.select("page", F.col("pos").cast("bigint").alias("pos"), F.coalesce(F.upper("r.tipo"), F.lit("DNI")).alias("tipo"), F.when(fine, digits).otherwise("").alias("dni"), F.trim(F.coalesce("r.nombre", F.lit(""))).alias("nombre"), F.coalesce("r.escuela", F.lit("")).alias("escuela"), moved.alias("observacion"))
    return out.where((F.length("nombre") >= 2) | (F.col("dni") != ""))


def collection(spark: SparkSession, fetch, schema: str) -> DataFrame:
    """Documents that `fetch()` yields as tuples, through a Python data source: read on an executor, not on the driver."""
    from pyspark.sql.datasource import DataSource, DataSourceReader

    class Reader(DataSourceReader):
        def read(self, partition):
            yield from fetch()

    class Source(DataSource):
        @classmethod
        def name(cls):
            return "rosterloom_collection"

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format("rosterloom_collection").load()


def change_stream(spark: SparkSession, folder: str, glob: str, schema: str) -> DataFrame:
    """A folder of parquet files as a stream of changes."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)
