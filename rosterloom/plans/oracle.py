"""SQL (DuckDB) for the registered queries, written independently of the DataFrame code where it can be."""

from __future__ import annotations

import re

from rosterloom.functions.rules import Rule, rules_for
from rosterloom.functions.text import ACCENTED, NOTE_STEMS
from rosterloom.operators import parse
from rosterloom.plans.views import with_views

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _code(raw: str) -> str:
    """A school code in canonical form."""
    s = f"upper(trim({raw}, {_WS}))"
    s = f"regexp_replace({s}, '^([A-Z]+)[\\s]+([0-9]+)', '\\1\\2')"
    s = f"regexp_replace({s}, '^([A-Z]+[0-9]+)[\\s]+.*', '\\1')"
    s = f"regexp_replace({s}, '^MSS[\\s]*', 'MS')"
    shape = "'^([A-Z]{1,4})([0-9]+)(?:/.*)?$'"
    n = f"regexp_extract({s}, {shape}, 2)"
    return f"CASE WHEN regexp_matches({s}, {shape}) THEN regexp_extract({s}, {shape}, 1) || '-' || CASE WHEN length({n}) < 4 THEN lpad({n}, 4, '0') ELSE {n} END ELSE {s} END"


def _bare(code: str) -> str:
    return f"CASE WHEN {code} IN ('JUBILADO/A', 'AP. EN SEDE', '') THEN {code} WHEN regexp_matches({code}, '^[0-9]-[0-9]{{3}}-[A-Z0-9]+-[0-9]+$') THEN regexp_extract({code}, '^[0-9]-[0-9]{{3}}-([A-Z0-9]+-[0-9]+)$', 1) ELSE {code} END"


def _assigned(roll: str) -> list[str]:
    """The lookup cascade as expressions, one pass after another."""
    return [
        f"norm AS (SELECT {_code('escuela_raw')} AS code, mesa, ord FROM v_site_codes)",
        "m1 AS (SELECT code, arg_min(mesa, ord) AS mesa FROM norm GROUP BY code)",
        "m2 AS (SELECT regexp_replace(code, '^JI-', 'J1-') AS code, arg_min(mesa, ord) AS mesa FROM norm GROUP BY 1)",
        f"r AS (SELECT *, {_bare('escuela')} AS code FROM {roll})",
        """assigned AS (SELECT r.*, coalesce(a.mesa, b.mesa, c.mesa) AS mesa, CAST(CASE WHEN a.mesa IS NOT NULL THEN 1 WHEN b.mesa IS NOT NULL THEN 2 WHEN c.mesa IS NOT NULL THEN 3 ELSE 0 END AS BIGINT) AS pass
            FROM r LEFT JOIN m1 a ON r.code = a.code LEFT JOIN m2 b ON r.code = b.code LEFT JOIN m1 c ON regexp_replace(r.code, '^M[358]-', 'MS-') = c.code)""",
        "enriched AS (SELECT g.*, coalesce(s.zona, 0) AS zona, s.zona_nombre, s.escuela_sede FROM assigned g LEFT JOIN v_sites s USING (mesa))",
    ]


_ENRICHED = _assigned("v_roster_a")
_DAMAGED = [
    "hurt AS (SELECT * REPLACE (CASE WHEN ord % 3 = 0 THEN replace(escuela, '-JI-', '-J1-') WHEN ord % 3 = 1 THEN replace(escuela, '-MS-', '-M5-') ELSE escuela END AS escuela) FROM v_roster_a)",
    *_assigned("hurt"),
]


def _rewritten(x: str, rules: tuple[Rule, ...]) -> str:
    out = f"trim({x}, {_WS})"
    for r in rules:
        new = re.sub(r"\$(\d)", r"\\\1", r.replacement)
        out = f"replace({out}, {_q(r.pattern)}, {_q(r.replacement)})" if r.literal else f"regexp_replace({out}, {_q(r.pattern)}, {_q(new)}, 'g')"
    return out


def _dest(x: str) -> str:
    up = f"trim(upper({x}), {_WS})"
    return f"CASE WHEN contains({up}, 'JUBILAD') THEN 'JUBILADO/A' WHEN contains({up}, 'SEDE') THEN 'AP. EN SEDE' WHEN regexp_matches({up}, '^[0-9O]-[0-9O]{{2,3}}-[A-Z0-9]{{2}}-[0-9O]{{3,4}}$') THEN replace({up}, 'O', '0') ELSE {up} END"


def _parsed() -> list[str]:
    """Lines to records: the number of the shape that matches, then its parts."""
    shapes = [*parse.SHAPES, parse.RESCUE]
    which = " ".join(f"WHEN regexp_matches(cleaned, {_q(s)}) THEN {i}" for i, s in enumerate(shapes))
    part = lambda g: "CASE shape " + " ".join(f"WHEN {i} THEN regexp_extract(cleaned, {_q(s)}, {g})" for i, s in enumerate(shapes) if g < 5 or i < len(shapes) - 1) + " END"
    name = f"regexp_extract(cleaned, {_q(parse.LOOSE_NAME)}, 1)"
    clean = f"trim(regexp_replace(regexp_replace(regexp_replace(trim({name}, {_WS}), '\\b(DNI|JUBILADO/?A?|AP\\s*EN\\s*SEDE)\\b', '', 'g'), '\\b\\d+\\b', '', 'g'), '\\s{{2,}}', ' ', 'g'), {_WS})".replace("{{2,}}", "{2,}")
    return [
        f"cl AS (SELECT *, {_rewritten('line', rules_for('069'))} AS cleaned, TRY_CAST(nullif(regexp_extract(line, '(?i)MESA[:\\s]+([0-9]+)', 1), '') AS BIGINT) AS header FROM v_ocr_lines)",
        f"sh AS (SELECT *, CASE WHEN header IS NOT NULL OR length(cleaned) < 10 THEN -1 {which} ELSE 99 END AS shape FROM cl)",
        f"p1 AS (SELECT *, {part(1)} AS g1, {part(2)} AS g2, {part(3)} AS g3, {part(4)} AS g4, {part(5)} AS g5, regexp_extract(cleaned, {_q(parse.LOOSE_ID)}, 1) AS l_doc, regexp_extract(cleaned, {_q(parse.LOOSE_CODE)}, 1) AS l_code, {clean} AS l_name, regexp_matches(cleaned, '(?i)JUBILADO/?A?') AS l_ret, regexp_matches(cleaned, '(?i)AP\\.?\\s*EN\\s*SEDE') AS l_off FROM sh)",
        """p2 AS (SELECT *, CASE WHEN shape BETWEEN 0 AND 6 THEN CAST(g5 AS BIGINT) WHEN shape = 99 THEN 0 END AS mesa0,
            CAST(CASE WHEN shape BETWEEN 0 AND 6 THEN 0.7 WHEN shape = 7 THEN 0.5 WHEN shape = 99 THEN
              CASE WHEN l_doc <> '' THEN 0.3 ELSE 0 END + CASE WHEN l_code <> '' THEN 0.3 WHEN l_ret THEN 0.25 WHEN l_off THEN 0.2 ELSE 0 END + CASE WHEN length(l_name) > 3 THEN 0.4 ELSE 0 END END AS DOUBLE) AS conf FROM p1)""",
        """p3 AS (SELECT *, coalesce(last_value(coalesce(header, CASE WHEN mesa0 > 0 THEN mesa0 END) IGNORE NULLS) OVER (PARTITION BY page ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS carried FROM p2)""",
        f"""recs AS (SELECT page, pos, CASE WHEN shape = 99 THEN CASE WHEN regexp_matches(cleaned, '(?i)^LC\\b') THEN 'LC' WHEN regexp_matches(cleaned, '(?i)^LE\\b') THEN 'LE' ELSE 'DNI' END ELSE upper(g1) END AS tipo,
            CASE WHEN shape = 99 THEN l_doc ELSE g2 END AS documento, CASE WHEN shape = 99 THEN l_name ELSE trim(g3, {_WS}) END AS nombre,
            CASE WHEN shape = 99 THEN CASE WHEN l_code <> '' THEN l_code WHEN l_ret THEN 'JUBILADO/A' WHEN l_off THEN 'AP. EN SEDE' ELSE '' END ELSE {_dest('g4')} END AS destino,
            CASE WHEN shape = 7 THEN carried ELSE mesa0 END AS mesa, round(conf, 6) AS confianza, trim(line, {_WS}) AS raw
            FROM p3 WHERE shape >= 0 AND conf >= 0.3)""",
    ]


_PARSED = _parsed()

_NOTE = "|".join(NOTE_STEMS)
_BAD = lambda c: f"regexp_matches(lower({c}), '{_NOTE}')"
_SURVIVED = [
    "a0 AS (SELECT * FROM v_roster_a WHERE dni <> ''), b0 AS (SELECT * FROM v_roster_b WHERE dni <> '')",
    "fa AS (SELECT * FROM a0 QUALIFY row_number() OVER (PARTITION BY dni ORDER BY ord) = 1)",
    "fb AS (SELECT * FROM b0 QUALIFY row_number() OVER (PARTITION BY dni ORDER BY ord) = 1)",
    f"""j AS (SELECT a.dni, a.nombre n1, b.nombre n2, a.escuela e1, b.escuela e2, a.pagina p1, b.pagina p2, a.observacion o1, a.confirmada c1, b.confirmada c2,
        {_BAD('a.observacion')} AS bad1, {_BAD('b.observacion')} AS bad2 FROM fa a JOIN fb b USING (dni))""",
    """k AS (SELECT *, length(trim(n2)) > length(trim(n1)) AS nm, (e1 = '' AND e2 <> '') OR (e1 <> '' AND e2 <> '' AND e1 <> e2 AND bad1 AND NOT bad2) AS sc,
        NOT c1 AND c2 AS pg, e1 <> '' AND e2 <> '' AND e1 <> e2 AND bad1 = bad2 AS cf FROM j)""",
    """survived AS (SELECT dni, CASE WHEN nm THEN trim(n2) ELSE n1 END AS nombre, CASE WHEN sc THEN e2 ELSE e1 END AS escuela, CASE WHEN pg THEN p2 ELSE p1 END AS pagina,
          CASE WHEN (nm OR sc) AND bad1 THEN '' ELSE o1 END AS observacion, c1 OR pg AS confirmada, 'ambos' AS fuente, CASE WHEN cf THEN e1 || ' vs ' || e2 ELSE '' END AS conflicto,
          CAST(nm AS BIGINT) + CAST(sc AS BIGINT) + CAST(pg AS BIGINT) AS cambios, nm AS nombre_nuevo, sc AS escuela_nueva, pg AS pagina_nueva FROM k
        UNION ALL SELECT dni, nombre, escuela, pagina, observacion, confirmada, 'base', '', 0, false, false, false FROM a0 WHERE dni NOT IN (SELECT dni FROM b0)
        UNION ALL SELECT dni, nombre, escuela, pagina, observacion, confirmada, 'control', '', 0, false, false, false FROM b0 WHERE dni NOT IN (SELECT dni FROM a0))""",
]

_LASTH = "h AS (SELECT dni, nombre AS nombre_past, escuela AS escuela_past FROM v_history WHERE dni <> '' QUALIFY row_number() OVER (PARTITION BY dni ORDER BY ord DESC) = 1)"
_TILDES = lambda c: f"(length({c}) - length(translate({c}, '{ACCENTED}', '')))"
_JUNK = r"[$\[\];{}|\\@#%]"

_KEY = lambda c: f"regexp_replace(upper(trim(strip_accents({c}))), '\\s+', ' ', 'g')"
_SHARE = lambda a, b: f"list_sum(list_transform(range(1, greatest(least(length({a}), length({b})), 1) + 1), lambda i: CAST(substr({a}, i, 1) = substr({b}, i, 1) AS INTEGER))) / greatest(length({a}), length({b}))"
_MATCH = lambda a, b: f"CASE WHEN {a} = '' OR {b} = '' OR {a} = {b} THEN {a} = {b} WHEN length({a}) > 5 AND length({b}) > 5 THEN {_SHARE(a, b)} > 0.85 ELSE false END"
_PRIORITY = [
    "roll AS (SELECT * FROM v_roster_a WHERE dni <> '' QUALIFY row_number() OVER (PARTITION BY dni ORDER BY ord DESC) = 1)",
    f"q0 AS (SELECT b.pagina AS page, b.ord AS pos, b.dni, r.dni AS rd, {_KEY('b.nombre')} AS x, {_KEY('r.nombre')} AS y, {_KEY('b.escuela')} AS ex, {_KEY('r.escuela')} AS ey FROM v_roster_b b LEFT JOIN roll r ON b.dni = r.dni)",
    f"q1 AS (SELECT *, rd IS NOT NULL AND NOT ({_MATCH('x', 'y')}) AS nm, rd IS NOT NULL AND ex <> ey AS sc FROM q0)",
    "prio AS (SELECT page, pos, CASE WHEN dni = '' OR rd IS NULL THEN 'ALTA' WHEN nm OR sc THEN 'MEDIA' ELSE 'BAJA' END AS prioridad, CASE WHEN nm AND sc THEN 'nombre,destino' WHEN nm THEN 'nombre' WHEN sc THEN 'destino' ELSE '' END AS diff FROM q1)",
    """tsum AS (SELECT page, CASE WHEN bool_or(prioridad = 'ALTA') THEN 'ALTA' WHEN bool_or(prioridad = 'MEDIA') THEN 'MEDIA' ELSE 'BAJA' END AS prioridad, count(*) AS total,
        count(*) FILTER (prioridad = 'ALTA') AS alta, count(*) FILTER (prioridad = 'MEDIA') AS media, count(*) FILTER (prioridad = 'BAJA') AS baja,
        round_even(count(*) FILTER (prioridad = 'BAJA') / count(*), 4) AS match_rate FROM prio GROUP BY page)""",
]

_SNAP = [
    "old AS (SELECT c_custkey AS id, 'M' || c_nationkey AS mesa, c_mktsegment AS nombre FROM customer)",
    "new AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN c_custkey + 10000000 ELSE c_custkey END AS id, 'M' || CASE WHEN c_custkey % 4 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS mesa, c_mktsegment AS nombre FROM customer)",
    """snap AS (SELECT coalesce(old.id, new.id) AS id, CASE WHEN old.id IS NULL THEN 'nueva' WHEN new.id IS NULL THEN 'eliminada' ELSE 'mantiene' END AS estado,
        old.mesa AS mesa_old, new.mesa AS mesa_new, old.nombre AS nombre_old, new.nombre AS nombre_new,
        old.id IS NOT NULL AND new.id IS NOT NULL AND (old.mesa IS DISTINCT FROM new.mesa OR old.nombre IS DISTINCT FROM new.nombre) AS cambio
        FROM old FULL JOIN new ON old.id = new.id)""",
]

_STATES = ["states AS (SELECT * FROM (SELECT * FROM v_feed QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY ord DESC) = 1) WHERE status <> 'removed')"]
_TASKS = "(SELECT count(DISTINCT task_id) FROM v_feed)"
_DONE = "count(*) FILTER (status = 'done')"
_HAV = "2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a))"

SQL: dict[str, str] = {
    "zone_summary": with_views("SELECT zona, zona_nombre, count(nullif(dni, '')) AS votantes, count(DISTINCT mesa) AS mesas, count(DISTINCT code) AS escuelas FROM enriched WHERE zona > 0 GROUP BY zona, zona_nombre", *_ENRICHED),
    "site_summary": with_views("SELECT zona, mesa, escuela_sede, count(nullif(dni, '')) AS votantes, string_agg(DISTINCT code, ', ' ORDER BY code) AS codigos FROM enriched WHERE zona > 0 GROUP BY ALL", *_ENRICHED),
    "uncovered_codes": with_views("SELECT code, count(*) AS n FROM enriched WHERE pass = 0 AND code NOT IN ('JUBILADO/A', 'AP. EN SEDE', '') GROUP BY code", *_ENRICHED),
    "coverage": with_views("SELECT count(*) AS total, count(*) FILTER (pass > 0) AS matched, count(*) FILTER (code IN ('JUBILADO/A', 'AP. EN SEDE')) AS special, count(*) FILTER (pass = 0 AND code NOT IN ('JUBILADO/A', 'AP. EN SEDE')) AS rest FROM enriched", *_ENRICHED),
    "fallback_lookup": with_views("SELECT ord, code, mesa, pass, zona FROM enriched", *_DAMAGED),
    "code_type_counts": with_views("SELECT coalesce(nullif(escuela, ''), 'SIN ESCUELA') AS escuela, count(*) AS n, split_part(coalesce(nullif(escuela, ''), 'SIN ESCUELA'), '-', 3) AS tipo FROM v_roster_a GROUP BY ALL"),
    "page_nested": with_views("SELECT pagina, bool_or(confirmada) AS confirmada, count(*) AS n, count(*) FILTER (dni = '') AS sin_dni, count(*) FILTER (escuela = 'JUBILADO/A') AS jubilados, count(*) FILTER (escuela = 'AP. EN SEDE') AS en_sede FROM v_roster_a GROUP BY pagina"),
    "sanitize_lines": with_views(f"SELECT page, pos, {_rewritten('line', rules_for('069'))} AS cleaned FROM v_ocr_lines"),
    "parse_lines": with_views("SELECT page, pos, tipo, documento, nombre, destino, mesa, confianza, raw FROM recs", *_PARSED),
    "carry_forward_context": with_views("SELECT page, pos, header IS NOT NULL AS is_header, carried FROM p3", *_PARSED),
    "rejected_lines": with_views(f"SELECT page, pos, trim(line, {_WS}) AS line, regexp_matches(trim(line, {_WS}), '(?i)^(DNI|L[CE])\\s+\\d') AS partial FROM p3 WHERE header IS NULL AND (shape < 0 OR conf < 0.3)", *_PARSED),
    "page_quality": with_views("""SELECT page, count(*) AS total, count(*) FILTER (length(documento) BETWEEN 7 AND 8) AS con_dni, count(*) FILTER (length(nombre) > 3) AS con_nombre, count(*) FILTER (destino <> '') AS con_destino,
        count(*) FILTER (confianza >= 0.7) AS alta, count(*) FILTER (confianza >= 0.3 AND confianza < 0.7) AS media, round_even(count(*) / 60 * 100, 1) AS completitud,
        CASE WHEN count(*) >= 30 THEN 'BUENA' WHEN count(*) >= 15 THEN 'REGULAR' ELSE 'MALA' END AS calidad FROM recs GROUP BY page""", *_PARSED),
    "dedup_keep_first": "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1",
    "dedup_keep_last": "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1",
    "duplicate_rows": "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1",
    "best_variant": """WITH x AS (SELECT l_orderkey AS grp, l_linenumber AS ord, 'v' || l_linenumber AS path, CAST(l_quantity AS BIGINT) % 5 AS d, CAST(l_quantity AS BIGINT) % 3 AS n, CAST(l_quantity AS BIGINT) + 25 AS records FROM lineitem),
        y AS (SELECT *, count(*) OVER (PARTITION BY grp) AS variants FROM x QUALIFY row_number() OVER (PARTITION BY grp ORDER BY d DESC, n DESC, records DESC, ord) = 1)
        SELECT grp, path, records, variants, CASE WHEN records < 40 THEN 'low' WHEN records > 65 THEN 'high' ELSE 'ok' END AS anomaly FROM y""",
    "sample_top_n": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'N' THEN 1 ELSE 2 END, l_linenumber) <= 3",
    "batch_chunks": "WITH x AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders) SELECT CAST(floor(place / 500) AS BIGINT) AS batch, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last, CAST(sum(o_custkey) AS BIGINT) AS customers, max(place) AS last_place FROM x GROUP BY 1",
    "reconcile_full_outer": with_views("SELECT * FROM survived", *_SURVIVED),
    "reconcile_stats": with_views("SELECT count(*) AS total, count(*) FILTER (fuente = 'ambos') AS en_ambos, count(*) FILTER (fuente = 'base') AS solo_base, count(*) FILTER (fuente = 'control') AS solo_control, count(*) FILTER (cambios > 0) AS con_cambios, count(*) FILTER (fuente = 'ambos' AND cambios = 0) AS sin_cambios, count(*) FILTER (nombre_nuevo) AS nombres_completados, count(*) FILTER (escuela_nueva) AS escuelas_completadas, count(*) FILTER (pagina_nueva) AS paginas_corregidas, count(*) FILTER (conflicto <> '') AS conflictos FROM survived", *_SURVIVED),
    "key_set_diff": with_views("SELECT coalesce(a.dni, b.dni) AS dni, CASE WHEN a.dni IS NULL THEN 'right' WHEN b.dni IS NULL THEN 'left' ELSE 'both' END AS side FROM (SELECT DISTINCT dni FROM v_roster_a WHERE dni <> '') a FULL JOIN (SELECT DISTINCT dni FROM v_roster_b WHERE dni <> '') b ON a.dni = b.dni"),
    "history_correction": with_views(
        f"""SELECT ord, nombre, nombre_past, CASE WHEN nombre_past IS NULL THEN 'sin_historia' WHEN upper(nombre) = upper(nombre_past) THEN 'igual' WHEN better THEN 'corregido' ELSE 'nombre_ok' END AS accion,
            CASE WHEN nombre_past IS NOT NULL AND upper(nombre) <> upper(nombre_past) AND better THEN nombre_past ELSE nombre END AS nombre_final,
            CASE WHEN nombre_past IS NULL THEN 'sin_historia' WHEN escuela = '' THEN 'vacia' WHEN escuela = escuela_past THEN 'igual' ELSE 'cambio' END AS estado_escuela
            FROM (SELECT a.*, h.nombre_past, h.escuela_past, CASE WHEN coalesce(nombre_past, '') = '' THEN false WHEN regexp_matches(nombre_past, '{_JUNK}') THEN false WHEN nombre = '' THEN true WHEN regexp_matches(nombre, '{_JUNK}') THEN true
                  WHEN length(nombre_past) > length(nombre) + 2 THEN true ELSE {_TILDES('nombre_past')} > {_TILDES('nombre')} END AS better FROM v_roster_a a LEFT JOIN h ON a.dni = h.dni)""",
        _LASTH,
    ),
    "engine_vote": with_views(
        """SELECT documento, tipo, nombre, destino, mesa, confianza, engines FROM merged
           UNION ALL SELECT documento, tipo, nombre, destino, mesa, round(confianza, 6), 1 FROM v_engines WHERE documento = ''""",
        "k AS (SELECT * FROM v_engines WHERE documento <> '' QUALIFY row_number() OVER (PARTITION BY engine, documento ORDER BY ord DESC) = 1)",
        "t AS (SELECT documento, tipo FROM (SELECT documento, tipo, count(*) AS n, min(engine_no) AS f FROM k GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY documento ORDER BY n DESC, f) = 1)",
        "m AS (SELECT documento, mesa FROM (SELECT documento, mesa, count(*) AS n, min(engine_no) AS f FROM k WHERE mesa > 0 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY documento ORDER BY n DESC, f) = 1)",
        "b AS (SELECT documento, nombre, destino FROM k QUALIFY row_number() OVER (PARTITION BY documento ORDER BY confianza DESC, engine_no) = 1)",
        "c AS (SELECT documento, round(avg(confianza), 6) AS confianza, count(*) AS engines FROM k GROUP BY documento)",
        "merged AS (SELECT b.documento, t.tipo, b.nombre, b.destino, coalesce(m.mesa, 0) AS mesa, c.confianza, c.engines FROM b JOIN t USING (documento) JOIN c USING (documento) LEFT JOIN m USING (documento))",
    ),
    "hybrid_gate": with_views("SELECT page, confianza, confianza < 0.6 AS usa_respaldo, confianza < 0.4 AS usa_vision FROM (SELECT CAST(floor(ord / 7.0) AS BIGINT) AS page, round(avg(confianza), 6) AS confianza FROM v_engines WHERE engine_no = 1 GROUP BY 1)"),
    "hybrid_roll": with_views(
        "SELECT coalesce(n.dni, h.dni) AS dni, coalesce(nombre_past, n.nombre) AS nombre, coalesce(n.escuela, escuela_past) AS escuela, CASE WHEN n.dni IS NULL THEN 'past' WHEN h.dni IS NULL THEN 'now' ELSE 'both' END AS side FROM n FULL JOIN h ON n.dni = h.dni",
        _LASTH, "n AS (SELECT dni, nombre, escuela FROM v_roster_a WHERE dni <> '' QUALIFY row_number() OVER (PARTITION BY dni ORDER BY ord) = 1)",
    ),
    "fuzzy_names": with_views(f"SELECT dni, y AS key, round({_SHARE('x', 'y')}, 6) AS share, {_MATCH('x', 'y')} AS same FROM (SELECT a.dni, {_KEY('a.nombre')} AS x, {_KEY('b.nombre')} AS y FROM v_roster_a a JOIN v_roster_b b ON a.dni = b.dni WHERE a.dni <> '')"),
    "schema_drift_union": "SELECT 'DNI' AS tipo, CAST(c_custkey AS VARCHAR) AS dni, c_name AS nombre, c_mktsegment AS escuela, '' AS observacion FROM customer UNION ALL SELECT 'LC', CAST(s_suppkey AS VARCHAR), s_name, '', 'nota' FROM supplier",
    "problem_notes": with_views(f"SELECT ord, {_BAD('observacion')} AS problem, regexp_matches(nombre || CASE WHEN ord % 8 = 0 THEN '|' ELSE '' END, '{_JUNK}') AS junk FROM v_roster_b"),
    "verification_priority": with_views("SELECT page, pos, prioridad, CAST(CASE prioridad WHEN 'ALTA' THEN 3 WHEN 'MEDIA' THEN 2 ELSE 1 END AS BIGINT) AS rank, diff FROM prio", *_PRIORITY),
    "task_summary": with_views("SELECT * FROM tsum", *_PRIORITY),
    "task_histogram": with_views("SELECT lower(prioridad) AS prioridad, count(*) AS n, CAST(sum(total) AS BIGINT) AS registros FROM tsum GROUP BY 1", *_PRIORITY),
    "verified_export": """SELECT l_orderkey AS task_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS row, CAST(l_partkey AS VARCHAR) AS dni, o_orderkey IS NOT NULL AS verified, o_custkey AS verified_by
        FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey""",
    "snapshot_diff": with_views("SELECT * FROM snap", *_SNAP),
    "snapshot_counts": with_views("SELECT estado, count(*) AS n, count(*) FILTER (cambio) AS cambios FROM snap GROUP BY estado", *_SNAP),
    "compare_filter": with_views("SELECT id, estado, mesa_old, mesa_new FROM snap WHERE estado = 'mantiene' AND (contains(lower(coalesce(mesa_old, '')), 'm1') OR contains(lower(coalesce(mesa_new, '')), 'm1') OR contains(lower(coalesce(nombre_old, '')), 'm1') OR contains(lower(coalesce(nombre_new, '')), 'm1'))", *_SNAP),
    "site_coords_fallback": with_views(
        """SELECT *, CASE WHEN has_url THEN 'https://maps.example.org/?q=' || CAST(round(lat) AS INTEGER) || ',' || CAST(round(lng) AS INTEGER) ELSE '-' END AS url FROM (SELECT mesa AS id, round(CASE WHEN old THEN lat WHEN mesa < 16 THEN -35.0 - CAST(mesa AS DOUBLE) / 8 END, 6) AS lat, round(CASE WHEN old THEN lng WHEN mesa < 16 THEN -59.0 - CAST(mesa AS DOUBLE) / 16 END, 6) AS lng,
           CASE WHEN old THEN 'old' WHEN mesa < 16 THEN 'new' ELSE 'none' END AS source, old OR mesa < 16 AS has_url FROM (SELECT *, mesa % 3 <> 0 AND mesa % 4 <> 0 AND mesa % 5 <> 0 AS old FROM v_sites))""",
    ),
    "nearest_site": with_views(
        f"SELECT id, mesa, round({_HAV}, 6) AS km FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_HAV}, mesa) = 1",
        "pt AS (SELECT c_custkey AS id, CAST(-34.55 AS DOUBLE) - (c_custkey % 101) * CAST(0.0041 AS DOUBLE) AS plat, CAST(-58.45 AS DOUBLE) - (c_custkey % 89) * CAST(0.0037 AS DOUBLE) AS plng FROM customer)",
        "d AS (SELECT id, mesa, pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lng - plng) / 2), 2) AS a FROM pt, v_sites)",
    ),
    "zone_heat": with_views("SELECT mesa, votos, CAST(floor(12 + least(CAST(votos AS DOUBLE) / 4, 16) + 0.5) AS BIGINT) AS size, round(votos / max(votos) OVER (), 6) AS share FROM (SELECT mesa, count(*) AS votos FROM enriched WHERE zona > 0 GROUP BY mesa)", *_ENRICHED),
    "search_id": with_views("SELECT ord, dni, nombre FROM v_roster_a WHERE contains(dni, '0012')"),
    "search_zone": with_views("SELECT ord, dni, zona FROM enriched WHERE zona IN (SELECT zona FROM v_sites WHERE zona = 2 OR contains(lower(zona_nombre), '2'))", *_ENRICHED),
    "search_site": with_views("SELECT ord, dni, mesa FROM enriched WHERE mesa IN (SELECT mesa FROM v_sites WHERE contains(lower(escuela_sede), 'n_1'))", *_ENRICHED),
    "search_code": with_views("SELECT ord, code, mesa FROM enriched WHERE code = 'MS-0007'", *_ENRICHED),
    "typeahead": "WITH h AS (SELECT n_name AS escuela_sede FROM nation JOIN region ON n_regionkey = r_regionkey WHERE contains(lower(n_name), '1')) SELECT escuela_sede, (SELECT greatest(count(*) - 4, 0) FROM h) AS more FROM h ORDER BY escuela_sede LIMIT 4",
    "distinct_codes": with_views(f"SELECT DISTINCT {_code('escuela_raw')} AS code FROM v_site_codes"),
    "line_islands": """WITH w AS (SELECT CAST(user_id AS BIGINT) AS page, event_id AS pos, event_type AS t, value, event_id % 97 AS x, event_id % 89 AS y, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events),
        i AS (SELECT *, CAST(sum(CASE WHEN before IS NOT NULL AND before <> t THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY pos) AS BIGINT) AS island FROM w)
        SELECT page, island, string_agg(t, ' ' ORDER BY pos) AS text, round(avg(value), 6) AS conf, min(x) AS x, min(y) AS y, max(x) + 10 - min(x) AS w, max(y) + 5 - min(y) AS h FROM i GROUP BY page, island""",
    "page_confidence": "SELECT CAST(user_id AS BIGINT) AS page, round(coalesce(avg(value) FILTER (event_id % 3 <> 0 AND value > 0), 0.5), 6) AS conf FROM events GROUP BY 1",
    "sheet_fill": """WITH s AS (SELECT CAST(user_id AS BIGINT) AS sheet, event_id AS pos, CASE WHEN event_id % 3 = 2 THEN event_id % 25 END AS mesa, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS item FROM events),
        g AS (SELECT *, count(mesa) OVER (PARTITION BY sheet ORDER BY pos ROWS UNBOUNDED PRECEDING) AS grp FROM s)
        SELECT sheet, grp, max(mesa) AS mesa, coalesce(string_agg(item, ',' ORDER BY pos, item) FILTER (item <> ''), '') AS items FROM g WHERE grp > 0 GROUP BY sheet, grp""",
    "location_look_ahead": """WITH x AS (SELECT CAST(user_id AS BIGINT) AS grp, event_id AS pos, CASE WHEN event_type = 'view' THEN ' y ' WHEN event_type = 'click' THEN '' ELSE event_type END AS tail FROM events)
        SELECT grp, pos, tail, coalesce(first_value(CASE WHEN trim(tail) NOT IN ('', 'y', 'e') THEN trim(tail) END IGNORE NULLS) OVER (PARTITION BY grp ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 'OTRO') AS location FROM x""",
    "section_merge": """WITH s AS (SELECT CAST(user_id AS BIGINT) AS page, event_id AS pos, event_type = 'click' AS bold, event_type || event_id AS text FROM events),
        b AS (SELECT *, bold AND NOT coalesce(lag(bold) OVER (PARTITION BY page ORDER BY pos), false) AS opens FROM s),
        c AS (SELECT *, CAST(sum(CAST(opens AS INTEGER)) OVER (PARTITION BY page ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS section FROM b)
        SELECT page, section, coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (bold), '') AS title, coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (NOT bold), '') AS body FROM c GROUP BY page, section""",
    "word_rows": """WITH RECURSIVE w AS (SELECT l_orderkey AS page, CAST(l_linenumber AS BIGINT) AS ord, CAST(l_quantity * 2 AS BIGINT) AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) AS k FROM lineitem),
        f(page, ord, k, anchor, line) AS (SELECT page, ord, k, y, CAST(0 AS BIGINT) FROM w WHERE k = 1
          UNION ALL SELECT w.page, w.ord, w.k, CASE WHEN abs(w.y - f.anchor) > 20 THEN w.y ELSE f.anchor END, f.line + CASE WHEN abs(w.y - f.anchor) > 20 THEN 1 ELSE 0 END FROM f JOIN w ON w.page = f.page AND w.k = f.k + 1)
        SELECT page, ord, line AS row FROM f""",
    "feed_latest_state": with_views("SELECT task_id, ord, status, volunteer_id, total_records, volunteer_name FROM states", *_STATES),
    "status_stream": with_views("SELECT task_id, ord, status, volunteer_id, total_records, volunteer_name FROM states", *_STATES),
    "dashboard_status": with_views(
        f"""SELECT {_TASKS} AS total, {_DONE} AS done, count(*) FILTER (status = 'assigned') AS assigned, {_TASKS} - {_DONE} - count(*) FILTER (status = 'assigned') AS pending, CAST(floor({_DONE} / {_TASKS} * 100 + 0.5) AS BIGINT) AS pct, round_even({_DONE} / {_TASKS} * 100, 2) AS completion_rate,
            CAST(coalesce(sum(total_records) FILTER (status = 'done'), 0) AS BIGINT) AS records_done, count(DISTINCT volunteer_id) FILTER (status = 'done') AS volunteers,
            CAST(floor(({_TASKS} - {_DONE}) * 3 / greatest(count(DISTINCT volunteer_id) FILTER (status = 'done'), 1) + 0.5) AS BIGINT) AS eta_minutes FROM states""",
        *_STATES,
    ),
    "leaderboard": with_views("SELECT volunteer_id, name, n, records, round(n / max(n) OVER (), 6) AS share, row_number() OVER (ORDER BY n DESC, volunteer_id) AS rank FROM (SELECT volunteer_id, arg_max(volunteer_name, ord) AS name, count(*) AS n, CAST(sum(total_records) AS BIGINT) AS records FROM states WHERE status = 'done' AND volunteer_id IS NOT NULL GROUP BY 1)", *_STATES),
    "resumable_work": with_views("SELECT DISTINCT task_id FROM v_feed WHERE task_id NOT IN (SELECT task_id FROM states WHERE status = 'done')", *_STATES),
}
