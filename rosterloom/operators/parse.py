"""Lines of scanned pages to records: repair, a cascade of shapes, and context carried from line to line.

A line is (page, pos, line). All of it is column expressions; the context is a window over one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.functions.numbers import percent
from rosterloom.functions.rules import Rule, rewrite, rules_for
from rosterloom.functions.text import clean_name, destination, header_number, strip

# The shapes of a record, the most exact first, with (type, document, name, destination, site); a rescued one has no site.
SHAPES = (
    r"(?i)^(DNI|L[CE])\.?\s+(\d{4,9})\.?\s+(.+?)\s+([\d]-[\d]{2,3}-[A-Z]{2}-[\d]{3,4})\s+(\d{1,4})[\s\S]*$",
    r"(?i)^(DNI|L[CE])\.?\s+(\d{4,9})\.?\s+(.+?)\s+([O\d]-[O\d]{2,3}-[A-Z\d]{2}-[O\d]{3,4})\s+(\d{1,4})[\s\S]*$",
    r"(?i)^(DNI|L[CE])\.?\s+(\d{4,9})\.?\s+(.+?)\s{2,}(JUBILAD\S*/?\s*A)\s+(\d{1,4})[\s\S]*$",
    r"(?i)^(DNI|L[CE])\.?\s+(\d{4,9})\.?\s+(.+?)\s{2,}(AP\.?\s*EN\s*SEDE)\s+(\d{1,4})[\s\S]*$",
    r"(?i)^(DNI|L[CE])\.?\s+(\d{4,9})\.?\s+(.+?)\s{2,}(TITULAR|SUPLENTE)\s+(\d{1,4})[\s\S]*$",
    r"(?i)^(DNI|L[CE])\.?\s+(\d{4,9})\.?\s+(.+?)\s{2,}([A-Z][A-Z\s./]{2,}?)\s+(\d{1,4})[\s\S]*$",
    r"(?i)^(DNI|L[CE])\.?\s+(\d{4,9})\.?\s+(.+?)\s+(JUBILAD\S*/?\s*A|AP\.?\s*EN\s*SEDE)\s+(\d{1,4})[\s\S]*$",
)
RESCUE = r"(?i)^(DNI|L[CE])\.?\s+(\d{4,9})\.?\s+(.+?)\s+(JUBILAD\S*/?\s*\S*|AP\.?\s*EN\s*SEDE|[\dO]-[\dO]{2,3}-[A-Z\d]{2}-[\dO]{3,4})"
PARTIAL = r"(?i)^(DNI|L[CE])\s+\d"
LOOSE_ID, LOOSE_CODE, LOOSE_NAME = r"\b(\d{7,8})\b", r"(0-0\d{2}-[A-Z]{1,2}-\d{4})", r"([A-ZÁÉÍÓÚÑ][A-ZÁÉÍÓÚÑ\s.]{4,})"
#: Confidence of a full match, of a rescued one, and the parts of a loose one.
FULL, RESCUED, ID_PART, CODE_PART, RETIRED_PART, OFFICE_PART, NAME_PART, LEAST = 0.7, 0.5, 0.3, 0.3, 0.25, 0.2, 0.4, 0.3
SHORTEST = 10


def page_lines(pages: DataFrame, page: str = "page", text: str = "text") -> DataFrame:
    """(page, pos, line) of each page's text."""
    return pages.select(F.col(page).alias("page"), F.posexplode(F.split(strip(F.col(text)), "\n", -1)).alias("pos", "line")).withColumn("pos", F.col("pos").cast("bigint"))


def _record(tipo: Column, doc: Column, name: Column, dest: Column, mesa: Column, conf: Column) -> Column:
    return F.struct(tipo.alias("tipo"), doc.alias("documento"), name.alias("nombre"), dest.alias("destino"), mesa.cast("bigint").alias("mesa"), conf.cast("double").alias("confianza"))


def shape_parts(cleaned: Column) -> Column:
    """The number of the first shape that matches and its parts, as one array; null if none does. One replacement gives all parts of a shape."""
    whole = [*SHAPES, RESCUE + r"[\s\S]*$"]
    cut = lambda i, s: F.split(F.regexp_replace(cleaned, s, "\x01".join([str(i), "$1", "$2", "$3", "$4"] + ["$5"] * (i < len(SHAPES)))), "\x01")
    return F.coalesce(*(F.when(cleaned.rlike(s), cut(i, s)) for i, s in enumerate(whole)))


def _loose(x: Column) -> Column:
    """What can be found anywhere in the line, each part for itself."""
    doc, code = F.regexp_extract(x, LOOSE_ID, 1), F.regexp_extract(x, LOOSE_CODE, 1)
    retired, office = x.rlike("(?i)JUBILADO/?A?"), x.rlike(r"(?i)AP\.?\s*EN\s*SEDE")
    dest = F.when(code != "", code).when(retired, "JUBILADO/A").when(office, "AP. EN SEDE").otherwise("")
    name = clean_name(F.regexp_extract(x, LOOSE_NAME, 1))
    # added in this order: sums of doubles depend on it
    conf = F.when(doc != "", ID_PART).otherwise(0.0) + F.when(code != "", CODE_PART).when(retired, RETIRED_PART).when(office, OFFICE_PART).otherwise(0.0)
    conf = conf + F.when(F.length(name) > 3, NAME_PART).otherwise(0.0)
    tipo = F.when(x.rlike(r"(?i)^LC\b"), "LC").when(x.rlike(r"(?i)^LE\b"), "LE").otherwise("DNI")
    return F.when(conf >= LEAST, _record(tipo, doc, name, dest, F.lit(0), conf))


def cascade(cleaned: Column, parts: Column) -> Column:
    """The record of a repaired line as a struct, null if there is none; a rescued one has no site yet."""
    part = lambda i: F.get(parts, F.lit(i))
    rescued = part(0) == str(len(SHAPES))
    shaped = _record(F.upper(part(1)), part(2), strip(part(3)), destination(part(4)), part(5), F.when(rescued, RESCUED).otherwise(FULL))
    return F.when(F.length(cleaned) >= SHORTEST, F.when(parts.isNotNull(), shaped).otherwise(_loose(cleaned)))


def _read(line: Column, rules: tuple[Rule, ...]) -> Column:
    """(cleaned, first). Lambdas bind the repaired line and its parts: named again and again, the optimizer would put the whole chain of repairs in each place."""
    record = lambda c: F.transform(F.array(shape_parts(c)), lambda p: cascade(c, p))[0]
    return F.transform(F.array(rewrite(line, rules)), lambda c: F.struct(c.alias("cleaned"), record(c).alias("first")))[0]


def sanitize_lines(lines: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    return lines.withColumn("cleaned", rewrite(F.col("line"), rules_for("069") if rules is None else rules))


def carry_forward(lines: DataFrame, *update: Column, keys: tuple[str, ...] = ("page",), order: tuple[str, ...] = ("pos",), default: int | str = 1, name: str = "carried", own: bool = False) -> DataFrame:
    """The last update above each line (with `own` its own, too) of its page, a default before any. One page is one window: pages, not files, are dealt out."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    first = F.lit(default).cast("bigint") if isinstance(default, int) else F.lit(default)
    return lines.withColumn(name, F.coalesce(F.last(F.coalesce(*update), ignorenulls=True).over(w), first))


def carry_across_pages(lines: DataFrame, headers: DataFrame, default: int = 1) -> DataFrame:
    """lines (file, page, pos, mesa or null) with the site carried to each through its whole file: a page's header (file, page, mesa) holds before its first line, and every record sets the site, to 0 too. One file is one window."""
    above = headers.select("file", "page", F.lit(-1).cast("bigint").alias("pos"), "mesa")
    both = carry_forward(lines.select("file", "page", "pos", "mesa").unionByName(above), F.col("mesa"), keys=("file",), order=("page", "pos"), default=default)
    return both.where("pos >= 0")


def sections(lines: DataFrame, name: Column) -> DataFrame:
    """lines (file, page, pos, ...) with the section (the last name on its own or an earlier line of the file, else blank)."""
    return carry_forward(lines, name, keys=("file",), order=("page", "pos"), default="", name="section", own=True)


def parse_lines(lines: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """page, pos, line, is_header and the record (rec, null if none) of each line.

    A header sets the site for the lines below, and so does each record with a site above 0; a rescued record takes it.
    What a line passes on doesn't depend on what it takes, so two passes of expressions with one window between do.
    """
    x = lines.withColumn("header", header_number(F.col("line"))).withColumn("_line", _read(F.col("line"), rules_for("069") if rules is None else rules))
    x = x.withColumn("cleaned", F.col("_line.cleaned")).withColumn("first", F.when(F.col("header").isNull(), F.col("_line.first")))
    own = F.when(F.col("first.mesa") > 0, F.col("first.mesa"))
    x = carry_forward(x, F.col("header"), own)
    rec = F.when(F.col("first").isNotNull(), F.col("first").withField("mesa", F.coalesce("first.mesa", "carried")))
    return x.select("page", "pos", "line", "cleaned", F.col("header").isNotNull().alias("is_header"), "carried", rec.alias("rec"))


def records(parsed: DataFrame, least: float = LEAST) -> DataFrame:
    return parsed.where(F.col("rec.confianza") >= least).select("page", "pos", "rec.*", strip(F.col("line")).alias("raw"))


def rejects(parsed: DataFrame, least: float = LEAST) -> DataFrame:
    """Lines that give no record, and whether they look like one."""
    bad = parsed.where(~F.col("is_header") & (F.col("rec").isNull() | (F.col("rec.confianza") < least)))
    return bad.select("page", "pos", strip(F.col("line")).alias("line"), strip(F.col("line")).rlike(PARTIAL).alias("partial"))


def has_doc(doc: Column) -> Column:
    return F.length(doc).between(7, 8)


def page_quality(recs: DataFrame, expected: int = 60) -> DataFrame:
    """Counts, completeness and a tier of each page."""
    n = F.count("*")
    return recs.groupBy("page").agg(
        n.alias("total"),
        F.count_if(has_doc(F.col("documento"))).alias("con_dni"),
        F.count_if(F.length("nombre") > 3).alias("con_nombre"),
        F.count_if(F.col("destino") != "").alias("con_destino"),
        F.count_if(F.col("confianza") >= FULL).alias("alta"),
        F.count_if((F.col("confianza") >= LEAST) & (F.col("confianza") < FULL)).alias("media"),
        percent(n, F.lit(expected)).alias("completitud"),
        F.when(n >= 30, "BUENA").when(n >= 15, "REGULAR").otherwise("MALA").alias("calidad"),
    )


def best_rotation(texts: DataFrame) -> DataFrame:
    """The rotation of the highest score of each image among those with a page, the first of equals (texts: image, rotation, ord, score, page)."""
    return texts.where(F.col("page") > 0).groupBy("image").agg(F.max_by("rotation", F.struct("score", -F.col("ord"))).alias("rotation"))
