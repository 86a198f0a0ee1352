"""Rolls, sites and scanned lines derived from the star-schema tables: one text of expressions serves both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterloom.sources.shared import _fs

ROSTER_A = {
    "ord": "CAST(c_custkey AS BIGINT)",
    "dni": "CASE WHEN c_custkey % 17 = 0 THEN '' ELSE lpad(CAST(10000000 + c_custkey AS STRING), 8, '0') END",
    "nombre": "c_mktsegment || ' Q' || translate(lpad(CAST(c_custkey AS STRING), 6, '0'), '0123456789', 'ABCDEFGHIJ')",
    "escuela": """CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'JUBILADO/A' WHEN c_custkey % 29 = 0 THEN 'AP. EN SEDE'
        ELSE '0-069-' || CASE c_mktsegment WHEN 'BUILDING' THEN 'MS' WHEN 'MACHINERY' THEN 'PP' WHEN 'HOUSEHOLD' THEN 'JI' WHEN 'AUTOMOBILE' THEN 'EE' ELSE 'DM' END
        || '-' || lpad(CAST(c_custkey % 97 AS STRING), 4, '0') END""",
    "pagina": "CAST(floor(c_custkey / 60.0) AS BIGINT) + 1",
    "observacion": "CASE WHEN c_custkey % 19 = 0 THEN 'dato dudoso' ELSE '' END",
    "confirmada": "c_custkey % 23 <> 0",
}
ROSTER_B = {
    "ord": "ord",
    "dni": "CASE WHEN ord % 5 = 0 AND dni <> '' THEN CAST(90000000 + ord AS STRING) ELSE dni END",
    "nombre": "CASE WHEN ord % 3 = 0 THEN nombre || ' ÑANDÚ' ELSE nombre END",
    "escuela": "CASE WHEN ord % 7 = 0 THEN '0-069-MS-0001' ELSE escuela END",
    "pagina": "pagina + 1000",
    "observacion": "CASE WHEN ord % 9 = 0 THEN 'ilegible' ELSE '' END",
    "confirmada": "ord % 2 = 0",
}
ROSTER_B_NEW = {
    "ord": "CAST(s_suppkey + 10000000 AS BIGINT)",
    "dni": "CAST(50000000 + s_suppkey AS STRING)",
    "nombre": "s_name",
    "escuela": "'0-069-PP-0002'",
    "pagina": "CAST(1 AS BIGINT)",
    "observacion": "''",
    "confirmada": "true",
}
HISTORY = {
    "ord": "ord",
    "dni": "CASE WHEN ord % 4 = 1 AND dni <> '' THEN CAST(80000000 + ord AS STRING) ELSE dni END",
    "nombre": "CASE WHEN ord % 6 = 0 THEN nombre || 'XYZ' WHEN ord % 6 = 1 THEN replace(nombre, 'Q', 'Ó') WHEN ord % 6 = 2 THEN nombre || '$' WHEN ord % 30 = 3 THEN 'ZUTANO' ELSE nombre END",
    "escuela": "CASE WHEN ord % 10 = 0 THEN '0-069-EE-0009' ELSE escuela END",
}
ENGINES = {
    "engine": "'e' || CAST(k AS STRING)",
    "engine_no": "CAST(k AS BIGINT)",
    "ord": "ord",
    "documento": "CASE WHEN ord % 41 = 0 THEN '' ELSE dni END",
    "tipo": "CASE WHEN (ord + k) % 5 = 0 THEN 'LC' ELSE 'DNI' END",
    "nombre": "CASE WHEN (ord + k) % 4 = 0 THEN nombre || ' ' || CAST(k AS STRING) ELSE nombre END",
    "destino": "CASE WHEN (ord + k) % 7 = 0 THEN '' ELSE escuela END",
    "mesa": "CAST(CASE WHEN (ord * k) % 6 = 0 THEN 0 ELSE (ord + CASE WHEN (ord + k) % 8 = 0 THEN 1 ELSE 0 END) % 25 + 1 END AS BIGINT)",
    "confianza": "CAST((ord * 7 + k * 3) % 10 AS DOUBLE) / CAST(10 AS DOUBLE)",
}
SITES = {
    "mesa": "CAST(n_nationkey AS BIGINT) + 1",
    "zona": "CAST(n_regionkey AS BIGINT) + 1",
    "zona_nombre": "r_name",
    "escuela_sede": "n_name",
    "lat": "CAST(-34.6 AS DOUBLE) - n_nationkey * CAST(0.013 AS DOUBLE)",
    "lng": "CAST(-58.5 AS DOUBLE) - ((n_nationkey * 7) % 25) * CAST(0.011 AS DOUBLE)",
}
SITE_CODES = {
    "escuela_raw": "code || CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE '' END || CAST(p_partkey % 97 AS STRING)",
    "mesa": "CAST(p_partkey % 25 AS BIGINT) + 1",
    "ord": "CAST(p_partkey AS BIGINT)",
}
OCR_LINES = {
    "page": "pagina",
    "pos": "(ord % 60) + 1",
    "line": """'DNI ' || dni || CASE WHEN ord % 10 = 3 THEN '.' ELSE '' END || ' ' || nombre || '  '
        || CASE WHEN ord % 10 = 4 THEN replace(escuela, '0-069-', 'D-069-') WHEN ord % 10 = 5 THEN replace(escuela, '-MS-', '-MS5-') ELSE escuela END
        || CASE WHEN ord % 7 = 0 THEN '' ELSE ' ' || CAST(pagina % 9 + 1 AS STRING) END""",
}
HEADERS = {"page": "pagina", "pos": "CAST(0 AS BIGINT)", "line": "'MESA: ' || CAST(pagina % 9 + 1 AS STRING)"}
#: Noise, and lines with a name alone.
NOISE = {"page": "pagina", "pos": "(ord % 60) + 101", "line": "CASE WHEN ord % 3 = 0 THEN '|||---...===' WHEN ord % 3 = 1 THEN 'DNI 12x y' ELSE 'LC  ' || nombre END"}
#: The feed's states by event type.
FEED = {
    "task_id": "CAST(floor(event_id / 5.0) AS BIGINT)",
    "ord": "CAST(event_id AS BIGINT)",
    "status": "CASE event_type WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'removed' ELSE 'assigned' END",
    "volunteer_id": "CAST(user_id AS BIGINT)",
    "total_records": "CAST(event_id % 61 AS BIGINT)",
    "volunteer_name": "'V' || CAST(user_id AS STRING) || '-' || CAST(event_id % 3 AS STRING)",
}
#: Raw spans of text: an order is a page, a line item a span.
SPANS = {
    "page": "l_orderkey",
    "ord": "CAST(l_linenumber AS BIGINT)",
    "page_width": "CAST(600 AS DOUBLE)",
    "text": "CASE WHEN l_partkey % 11 = 0 THEN '  ' ELSE ' t' || CAST(l_partkey AS STRING) || ' ' END",
    "size": "CASE WHEN l_suppkey % 7 = 0 THEN CAST(12 AS DOUBLE) WHEN l_suppkey % 3 = 0 THEN CAST(8.25 AS DOUBLE) ELSE CAST(8 AS DOUBLE) END",
    "font": "CASE WHEN l_partkey % 2 = 0 THEN 'HvBold' ELSE 'Plain' END",
    "x0": "CAST(l_partkey % 560 AS DOUBLE)",
    "y0": "CAST(l_quantity AS DOUBLE) * 10 + CAST(l_linenumber AS DOUBLE)",
}
CODES = ("MS", "PP", "JI", "EE")


def _sql(fields: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in fields.items()).replace("AS STRING", "AS VARCHAR")


_CODES = ", ".join(f"('{c}')" for c in CODES)
#: The views as common table expressions.
CTES = {
    "v_roster_a": f"SELECT {_sql(ROSTER_A)} FROM customer",
    "v_roster_b": f"SELECT {_sql(ROSTER_B)} FROM v_roster_a UNION ALL SELECT {_sql(ROSTER_B_NEW)} FROM supplier",
    "v_history": f"SELECT {_sql(HISTORY)} FROM v_roster_a",
    "v_engines": f"SELECT {_sql(ENGINES)} FROM v_roster_a, (VALUES (1), (2), (3)) AS e(k)",
    "v_sites": f"SELECT {_sql(SITES)} FROM nation JOIN region ON n_regionkey = r_regionkey",
    "v_site_codes": f"SELECT {_sql(SITE_CODES)} FROM part CROSS JOIN (VALUES {_CODES}) AS k(code)",
    "v_ocr_lines": f"SELECT {_sql(OCR_LINES)} FROM v_roster_a UNION ALL SELECT DISTINCT {_sql(HEADERS)} FROM v_roster_a UNION ALL SELECT {_sql(NOISE)} FROM v_roster_a",
    "v_spans": f"SELECT {_sql(SPANS)} FROM lineitem",
    "v_feed": f"SELECT {_sql(FEED)} FROM events",
}


def with_views(sql: str, *more: str) -> str:
    """sql after the views that it needs (and `more` expressions of its own)."""
    need = {n for n in CTES if n in sql + " ".join(more)}
    for n in reversed(CTES):
        if n in need:
            need |= {m for m in CTES if m in CTES[n]}
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in need] + list(more)
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_folder(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether a table is a folder of files."""
    fs, at = _fs(spark, f"{sf_dir}/{name}.parquet")
    return fs.getFileStatus(at).isDirectory()


def _of(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{e} AS {n}" for n, e in fields.items()))


def roster_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(table(spark, sf_dir, "customer"), ROSTER_A)


def roster_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(roster_a(spark, sf_dir), ROSTER_B).unionByName(_of(table(spark, sf_dir, "supplier"), ROSTER_B_NEW))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(roster_a(spark, sf_dir), HISTORY)


def engines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(roster_a(spark, sf_dir).selectExpr("*", "explode(array(1, 2, 3)) AS k"), ENGINES)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return _of(table(spark, sf_dir, "nation").join(regions, "n_regionkey"), SITES)


def site_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = ", ".join(f"'{c}'" for c in CODES)
    return _of(table(spark, sf_dir, "part").selectExpr("p_partkey", f"explode(array({codes})) AS code"), SITE_CODES)


def ocr_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = roster_a(spark, sf_dir)
    return _of(a, OCR_LINES).unionByName(_of(a, HEADERS).distinct()).unionByName(_of(a, NOISE))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(table(spark, sf_dir, "events"), FEED)
