"""Group summaries of an enriched roll."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.functions.rules import SPECIAL
from rosterloom.functions.text import code_type


def zone_summary(enriched: DataFrame) -> DataFrame:
    """Members, sites and codes of each zone above 0."""
    return enriched.where("zona > 0").groupBy("zona", "zona_nombre").agg(F.count(F.nullif("dni", F.lit(""))).alias("votantes"), F.count_distinct("mesa").alias("mesas"), F.count_distinct("code").alias("escuelas")).orderBy("zona")


def site_summary(enriched: DataFrame) -> DataFrame:
    return enriched.where("zona > 0").groupBy("zona", "mesa", "escuela_sede").agg(F.count(F.nullif("dni", F.lit(""))).alias("votantes"), F.array_join(F.array_sort(F.collect_set("code")), ", ").alias("codigos")).orderBy("zona", "mesa")


def uncovered_codes(enriched: DataFrame) -> DataFrame:
    """Codes without a site that are no special destination, by count."""
    bare = enriched.where((F.col("pass") == 0) & ~F.col("code").isin(*SPECIAL, ""))
    return bare.groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def coverage(enriched: DataFrame) -> DataFrame:
    special = F.col("code").isin(*SPECIAL)
    matched = F.col("pass") > 0
    return enriched.agg(F.count("*").alias("total"), F.count_if(matched).alias("matched"), F.count_if(special).alias("special"), F.count_if(~matched & ~special).alias("rest"))


def code_type_counts(roster: DataFrame) -> DataFrame:
    """Members by code, blank codes under a name of their own, with the code's type."""
    return roster.groupBy(F.coalesce(F.nullif("escuela", F.lit("")), F.lit("SIN ESCUELA")).alias("escuela")).agg(F.count("*").alias("n")).withColumn("tipo", code_type(F.col("escuela")))


def page_nested(roster: DataFrame) -> DataFrame:
    """A row for each page with its records in order; a page is bounded by its paper."""
    rows = F.array_sort(F.collect_list(F.struct("ord", "dni", "nombre", "escuela")))
    return roster.groupBy("pagina").agg(rows.alias("registros"), F.bool_or("confirmada").alias("confirmada"))


def nested_counts(nested: DataFrame) -> DataFrame:
    count = lambda f: F.size(F.filter("registros", f)).cast("bigint")
    return nested.select("pagina", "confirmada", F.size("registros").cast("bigint").alias("n"), count(lambda r: r["dni"] == "").alias("sin_dni"), count(lambda r: r["escuela"] == "JUBILADO/A").alias("jubilados"), count(lambda r: r["escuela"] == "AP. EN SEDE").alias("en_sede"))


def first_names(df: DataFrame, key: str, name: str, ord: str) -> DataFrame:
    """The first name of each key, sorted by key."""
    return df.groupBy(key).agg(F.min_by(name, ord).alias(name)).orderBy(key)


def top_categories(df: DataFrame, category: str, ord: str, k: int = 10) -> DataFrame:
    """The k most frequent categories with their counts, the first met of equals."""
    n = df.groupBy(category).agg(F.count("*").alias("n"), F.min(ord).alias("_first"))
    return n.orderBy(F.desc("n"), "_first").limit(k).drop("_first")


def distinct_but(df: DataFrame, column: str, *excluded) -> DataFrame:
    """One row: how many values a column has, without those excluded."""
    return df.agg(F.count_distinct(F.when(~F.col(column).isin(*excluded), F.col(column))).alias("n"))
