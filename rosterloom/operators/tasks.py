"""Verification work: priorities, tasks, exports, the best variant of an image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.functions.numbers import half_even
from rosterloom.functions.text import codes_match, names_match
from rosterloom.operators.dedup import keep_last, places, top_n


def priorities(scanned: DataFrame, roll: DataFrame) -> DataFrame:
    """scanned (page, pos, dni, nombre, escuela) with prioridad, rank (3 highest) and diff against the last row of each id of roll.

    No id, or one not in the roll: ALTA. Another name or school: MEDIA, with what differs. Else BAJA.
    """
    known = keep_last(roll.where("dni <> ''"), ["dni"], "ord").select(F.col("dni").alias("_dni"), F.col("nombre").alias("_nombre"), F.col("escuela").alias("_escuela"))
    x = scanned.join(known, F.col("dni") == F.col("_dni"), "left")
    found = F.col("_dni").isNotNull()
    name = found & ~names_match(F.col("nombre"), F.col("_nombre"))
    school = found & ~codes_match(F.col("escuela"), F.col("_escuela"))
    diff = F.array_compact(F.array(F.when(name, F.lit("nombre")), F.when(school, F.lit("destino"))))
    p = F.when((F.coalesce("dni", F.lit("")) == "") | ~found, "ALTA").when(name | school, "MEDIA").otherwise("BAJA")
    prod = F.when(found, F.struct(F.col("_dni").alias("dni"), F.col("_nombre").alias("nombre"), F.col("_escuela").alias("escuela")))
    x = x.withColumn("prioridad", p).withColumn("diff", diff).withColumn("prod", prod)
    return x.withColumn("rank", F.when(F.col("prioridad") == "ALTA", 3).when(F.col("prioridad") == "MEDIA", 2).otherwise(1).cast("bigint")).drop("_dni", "_nombre", "_escuela")


def task_summary(prioritised: DataFrame) -> DataFrame:
    """Each page's worst priority, counts, and the share of records that match."""
    n = lambda p: F.count_if(F.col("prioridad") == p)
    worst = F.max("rank")
    return prioritised.groupBy("page").agg(
        F.when(worst == 3, "ALTA").when(worst == 2, "MEDIA").otherwise("BAJA").alias("prioridad"),
        F.count("*").alias("total"), n("ALTA").alias("alta"), n("MEDIA").alias("media"), n("BAJA").alias("baja"),
        half_even(n("BAJA") / F.count("*"), 4).alias("match_rate"),
    )


def task_documents(prioritised: DataFrame) -> DataFrame:
    """A nested document for each page; row counts from 1 unless given."""
    row = F.struct(F.col("pos").alias("row"), "dni", "nombre", "escuela", "prioridad", "prod", "diff")
    return prioritised.groupBy("page").agg(F.array_sort(F.collect_list(row)).alias("records"), F.count("*").alias("total_records"))


def without_records(tasks: DataFrame) -> DataFrame:
    return tasks.drop("records").withColumn("status", F.lit("pending"))


def priority_histogram(tasks: DataFrame) -> DataFrame:
    """Tasks and records by priority in lower case; a missing one counts as media."""
    return tasks.groupBy(F.lower(F.coalesce("prioridad", F.lit("MEDIA"))).alias("prioridad")).agg(F.count("*").alias("n"), F.sum("total").alias("registros"))


def verified_export(results: DataFrame, tasks: DataFrame, include_unverified: bool = True) -> DataFrame:
    """Records (task_id, row, dni, verified, verified_by) of completed results and, if asked for, of tasks without one.

    results (task_id, volunteer_id, records), tasks (task_id, records): records are arrays of (dni).
    """
    flat = lambda x, v, by: x.select("task_id", F.posexplode("records").alias("_pos", "r"), by.alias("verified_by")).select("task_id", (F.col("_pos") + 1).cast("bigint").alias("row"), F.col("r.dni").alias("dni"), F.lit(v).alias("verified"), "verified_by")
    done = flat(results, True, F.col("volunteer_id"))
    rest = tasks.join(results.select("task_id").distinct(), "task_id", "left_anti")
    return done.unionByName(flat(rest, False, F.lit(None).cast(results.schema["volunteer_id"].dataType))) if include_unverified else done


def best_variant(variants: DataFrame, group: str = "grp", low: int = 40, high: int = 65) -> DataFrame:
    """The best variant (ord, path, con_dni, con_nombre, records) of each group, the first of equals, and whether its size is odd."""
    best = F.max_by(F.struct("path", "records"), F.struct("con_dni", "con_nombre", "records", -F.col("ord")))
    x = variants.groupBy(group).agg(best.alias("_b"), F.count("*").alias("variants")).select(group, "_b.*", "variants")
    return x.withColumn("anomaly", F.when(F.col("records") < low, "low").when(F.col("records") > high, "high").otherwise("ok"))


def sample_top_n(images: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    return top_n(images, [group], order, n)


def chunked(df: DataFrame, order: str, size: int = 500) -> DataFrame:
    """df with its place in a total order and the number of its write batch."""
    return places(df, order).withColumn("batch", F.floor(F.col("place") / size).cast("bigint"))


def strategy_ranking(lines: DataFrame) -> DataFrame:
    """Strategies (strategy, useful) by useful lines."""
    n = lines.groupBy("strategy").agg(F.count_if("useful").alias("useful"), F.count("*").alias("lines"))
    return places(n.withColumn("_less", -F.col("useful")), "_less", "strategy").withColumn("rank", F.col("place") + 1).drop("place", "_less")


def with_flag(items: DataFrame, done: DataFrame, key: str, name: str = "processed") -> DataFrame:
    """items, and whether their key is among those done."""
    known = done.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct().withColumn("_there", F.lit(True))
    return items.join(known, F.col(key) == F.col("_k"), "left").withColumn(name, F.coalesce("_there", F.lit(False))).drop("_k", "_there")


def with_records(pages: DataFrame, records: DataFrame) -> DataFrame:
    """The pages that have records."""
    return pages.join(records.select("page").distinct(), "page", "left_semi")
