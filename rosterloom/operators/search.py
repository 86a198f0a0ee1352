"""Searches over the enriched roll: by id, zone, site and code; options while typing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.functions.text import query_code


def leading(q: str) -> int | None:
    m = re.match(r"\s*([+-]?[0-9]+)", q)
    return int(m[1]) if m else None


def search_id(roll: DataFrame, q: str) -> DataFrame:
    """Members whose id contains q."""
    return roll.where(F.contains("dni", F.lit(q.strip())))


def _numbered(df: DataFrame, number: str, name: str, q: str) -> DataFrame:
    k = leading(q)
    hit = F.contains(F.lower(name), F.lit(q.strip().lower()))
    return df.where(hit | (F.col(number) == k) if k is not None else hit)


def search_zone(roll: DataFrame, sites: DataFrame, q: str) -> tuple[DataFrame, DataFrame]:
    """Sites of the zones with that number or name, and their members."""
    zones = _numbered(sites, "zona", "zona_nombre", q).select("zona").distinct()
    return sites.join(zones, "zona", "left_semi"), roll.join(zones, "zona", "left_semi")


def search_site(roll: DataFrame, sites: DataFrame, q: str) -> tuple[DataFrame, DataFrame]:
    found = _numbered(sites, "mesa", "escuela_sede", q)
    return found, roll.join(found.select("mesa").distinct(), "mesa", "left_semi")


def search_code(roll: DataFrame, q: str) -> DataFrame:
    """Members of the code as it may be typed."""
    return roll.where(F.col("code") == query_code(F.lit(q)))


def site_of_code(sites: DataFrame, q: str) -> DataFrame:
    """The first site (ord) whose array of codes has it."""
    return sites.where(F.array_contains("codes", query_code(F.lit(q)))).orderBy("ord").limit(1)


def typeahead(options: DataFrame, label: str, q: str, n: int = 50) -> DataFrame:
    """The first n options that contain q (all if it is blank), with how many more there are."""
    hit = options.where(F.contains(F.lower(label), F.lit(q.strip().lower()))) if q.strip() else options
    more = hit.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("more"))
    return hit.orderBy(label).limit(n).join(F.broadcast(more))


def first_results(found: DataFrame, order: str, n: int = 10) -> DataFrame:
    return found.orderBy(order).limit(n)


def unless_many(found: DataFrame, most: int = 100) -> DataFrame:
    """found, or nothing if it has more than `most` rows; no more than most + 1 of them are gathered."""
    few = found.limit(most + 1)
    return few.withColumn("_n", F.count("*").over(Window.partitionBy(F.lit(0)))).where(F.col("_n") <= most).drop("_n")


def distinct_codes(site_codes: DataFrame) -> DataFrame:
    """Sorted codes across arrays."""
    return site_codes.select(F.explode("codes").alias("code")).distinct().orderBy("code")


def page_range(df: DataFrame, spec: str, page: str = "page", last: int | None = None) -> DataFrame:
    """'a-b' or 'n', from 1; an end behind the last page is that page."""
    a, _, b = spec.partition("-")
    first = max(1, int(a))
    end = int(b) if b else first
    return df.where(F.col(page).between(first, min(end, last) if b and last is not None else end))
