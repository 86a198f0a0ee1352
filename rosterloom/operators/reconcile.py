"""Several versions of one roll: votes, survivorship, correction by history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.functions.ratio import sequence_ratio
from rosterloom.functions.text import better_name, has_problem_note, id_plain
from rosterloom.operators.dedup import keep_first, keep_last, places


#: Which fields of a row were taken from the control roll.
CHANGED = ("nombre_nuevo", "escuela_nueva", "pagina_nueva")


def survive(base: DataFrame, control: DataFrame) -> DataFrame:
    """Full outer join of two rolls (ord, dni, nombre, escuela, pagina, observacion, confirmada) by id.

    In both: one row of the first of each, the better value of each field. In one only: all its rows. Blank ids go.
    """
    a, b = (x.where(F.coalesce("dni", F.lit("")) != "") for x in (base, control))
    one = lambda x, s: keep_first(x, ["dni"], "ord").select("dni", *(F.col(c).alias(f"{c}_{s}") for c in x.columns if c != "dni"))
    both = one(a, "a").join(one(b, "b"), "dni")
    # ids once on the other side: the anti joins don't multiply rows
    alone = lambda x, y, s: x.join(y.select("dni").distinct(), "dni", "left_anti").select("dni", "nombre", "escuela", "pagina", "observacion", "confirmada", F.lit(s).alias("fuente"), F.lit("").alias("conflicto"), F.lit(0).cast("bigint").alias("cambios"), *(F.lit(False).alias(c) for c in CHANGED))
    return _best(both).unionByName(alone(a, b, "base")).unionByName(alone(b, a, "control"))


def _best(both: DataFrame) -> DataFrame:
    t = lambda c: F.trim(F.coalesce(c, F.lit("")))
    n1, n2, e1, e2 = t("nombre_a"), t("nombre_b"), t("escuela_a"), t("escuela_b")
    bad1, bad2 = has_problem_note(F.col("observacion_a")), has_problem_note(F.col("observacion_b"))
    name = (F.length(n2) > F.length(n1)) & (n2 != "")
    differ = (e1 != "") & (e2 != "") & (e1 != e2)
    school = ((e1 == "") & (e2 != "")) | (differ & bad1 & ~bad2)
    page = ~F.coalesce("confirmada_a", F.lit(False)) & F.coalesce("confirmada_b", F.lit(False))
    pick = lambda cond, c: F.when(cond, F.col(f"{c}_b")).otherwise(F.col(f"{c}_a")).alias(c)
    return both.select(
        "dni",
        F.when(name, n2).otherwise(F.col("nombre_a")).alias("nombre"),
        F.when(school, e2).otherwise(F.col("escuela_a")).alias("escuela"),
        pick(page, "pagina"),
        # the note goes if it was doubtful and a name or a school has changed
        F.when((name | school) & bad1, "").otherwise(F.col("observacion_a")).alias("observacion"),
        (F.coalesce("confirmada_a", F.lit(False)) | page).alias("confirmada"),
        F.lit("ambos").alias("fuente"),
        F.when(differ & (bad1 == bad2), F.concat(e1, F.lit(" vs "), e2)).otherwise("").alias("conflicto"),
        (name.cast("bigint") + school.cast("bigint") + page.cast("bigint")).alias("cambios"),
        *(x.alias(c) for c, x in zip(CHANGED, (name, school, page), strict=True)),
    )


def survive_stats(survived: DataFrame) -> DataFrame:
    one = lambda x: F.count_if(x)
    return survived.agg(
        F.count("*").alias("total"),
        one(F.col("fuente") == "ambos").alias("en_ambos"),
        one(F.col("fuente") == "base").alias("solo_base"),
        one(F.col("fuente") == "control").alias("solo_control"),
        one(F.col("cambios") > 0).alias("con_cambios"),
        one((F.col("fuente") == "ambos") & (F.col("cambios") == 0)).alias("sin_cambios"),
        *(one(F.col(c)).alias(n) for c, n in zip(CHANGED, ("nombres_completados", "escuelas_completadas", "paginas_corregidas"), strict=True)),
        one(F.col("conflicto") != "").alias("conflictos"),
    )


def key_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct non-blank keys and where they are."""
    marked = a.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(b.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    sides = marked.where(F.coalesce(key, F.lit("")) != "").groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return sides.select(key, F.when(F.col("l") + F.col("r") == 2, "both").when(F.col("l") == 1, "left").otherwise("right").alias("side"))


def with_history(now: DataFrame, past: DataFrame) -> DataFrame:
    """now (dni, nombre, escuela, ...) with the last row of each id of past as nombre_past, escuela_past, matched."""
    k = F.lit("")
    old = keep_last(past.withColumn("dni", id_plain(F.col("dni"))).where(F.col("dni") != k), ["dni"], "ord").select(F.col("dni").alias("_dni"), F.col("nombre").alias("nombre_past"), F.col("escuela").alias("escuela_past"), F.lit(True).alias("matched"))
    return now.join(old, id_plain(F.col("dni")) == F.col("_dni"), "left").drop("_dni").withColumn("matched", F.coalesce("matched", F.lit(False)))


def school_state() -> Column:
    now, past = F.trim(F.coalesce("escuela", F.lit(""))), F.trim(F.coalesce("escuela_past", F.lit("")))
    return F.when(~F.col("matched"), "sin_historia").when(now == "", "vacia").when(now == past, "igual").otherwise("cambio")


def correct_by_history(joined: DataFrame, least: float = 0.6, ratio: bool = True) -> DataFrame:
    """joined (of with_history) with accion, nombre_final and similitud.

    Only names that match an id but differ get a ratio, the one Python function; the others never reach it.
    """
    same = F.upper(F.coalesce("nombre", F.lit(""))) == F.upper(F.coalesce("nombre_past", F.lit("")))
    x = joined.withColumn("_compare", F.col("matched") & ~same)
    if ratio:
        plain = x.where(~F.col("_compare")).withColumn("similitud", F.when(F.col("matched"), F.lit(1.0)))
        x = plain.unionByName(x.where("_compare").withColumn("similitud", sequence_ratio(F.coalesce("nombre_past", F.lit("")), F.coalesce("nombre", F.lit("")))))
    else:
        x = x.withColumn("similitud", F.lit(1.0))
    better = better_name(F.col("nombre_past"), F.col("nombre"))
    action = F.when(~F.col("matched"), "sin_historia").when(~F.col("_compare"), "igual").when((F.col("similitud") > least) & better, "corregido").when(F.col("similitud") > least, "nombre_ok").otherwise("dni_dudoso")
    return x.withColumn("accion", action).withColumn("nombre_final", F.when(F.col("accion") == "corregido", F.col("nombre_past")).otherwise(F.col("nombre"))).withColumn("estado_escuela", school_state()).drop("_compare")


def vote(engines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Records of several engines (engine, engine_no, ord, tipo, documento, nombre, destino, mesa, confianza) as one for each id (within `by`, a page, say).

    Of an engine the last row of an id counts. Types and sites by majority, names and destinations from the row of
    highest confidence; the first engine wins ties. Rows without id stay as they are.
    """
    named = keep_last(engines.where("documento <> ''"), ["engine", *by, "documento"], "ord")
    counts = named.groupBy(*by, "documento").agg(
        F.max_by("nombre", F.struct("confianza", -F.col("engine_no"))).alias("nombre"),
        F.max_by("destino", F.struct("confianza", -F.col("engine_no"))).alias("destino"),
        F.avg("confianza").alias("confianza"),
        F.count("*").alias("engines"),
        F.collect_list(F.struct("engine_no", "tipo", "mesa")).alias("_all"),  # one row of each engine
    )
    merged = counts.select(*by, "documento", _majority("tipo", F.lit("DNI"), lambda v: v.isNotNull()).alias("tipo"), "nombre", "destino", _majority("mesa", F.lit(0).cast("bigint"), lambda v: v > 0).alias("mesa"), "confianza", "engines")
    loose = engines.where(F.coalesce("documento", F.lit("")) == "").select(*by, "documento", "tipo", "nombre", "destino", F.col("mesa").cast("bigint").alias("mesa"), F.col("confianza").cast("double").alias("confianza"), F.lit(1).cast("bigint").alias("engines"))
    return merged.unionByName(loose)


def _majority(field: str, default: Column, counted) -> Column:
    """The most frequent value, the first engine's of equals."""
    values = F.transform(F.array_sort("_all"), lambda r: r[field])
    values = F.filter(values, counted)
    ranked = F.transform(values, lambda v, i: F.struct(F.size(F.filter(values, lambda o: o == v)).alias("n"), (-i).alias("i"), v.alias("v")))
    return F.coalesce(F.array_max(ranked)["v"], default)


def hybrid_gate(pages: DataFrame, fallback_below: float = 0.6, vision_below: float = 0.4) -> DataFrame:
    """Which engines a page (page, confianza of the primary one) needs; the primary's confidence alone decides."""
    return pages.withColumn("usa_respaldo", F.col("confianza") < fallback_below).withColumn("usa_vision", F.col("confianza") < vision_below)


def hybrid_roll(now: DataFrame, past: DataFrame) -> DataFrame:
    """In both: the past name and the present school. In one only: that side."""
    n = keep_first(now.where("dni <> ''"), ["dni"], "ord").select("dni", F.col("nombre").alias("_n"), F.col("escuela").alias("_e"))
    p = keep_last(past.where("dni <> ''"), ["dni"], "ord").select("dni", F.col("nombre").alias("_pn"), F.col("escuela").alias("_pe"))
    return n.join(p, "dni", "full").select("dni", F.coalesce("_pn", "_n").alias("nombre"), F.coalesce("_e", "_pe").alias("escuela"), F.when(F.col("_n").isNull(), "past").when(F.col("_pn").isNull(), "now").otherwise("both").alias("side"))


def ordinals(df: DataFrame, *order: str) -> DataFrame:
    """df with its place in that order, from 1: numbered before rows are left out, those leave gaps."""
    return places(df, *order).withColumn("ord", F.col("place") + 1).drop("place")
