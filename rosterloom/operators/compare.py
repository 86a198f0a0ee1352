"""Two snapshots of one list of sites: kept, new, removed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status(raw: Column) -> Column:
    """A workbook's state in canonical form; an unknown one fails the query."""
    x = F.lower(F.trim(raw))
    known = F.when(x.startswith("mantiene"), "mantiene").when(x.startswith("nuev"), "nueva").when(x.startswith("elimin"), "eliminada")
    return F.coalesce(known, F.raise_error(F.concat(F.lit("unknown state: "), F.coalesce(raw, F.lit("null")))).cast("string"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, values: list[str]) -> DataFrame:
    a = old.select(F.col(key).alias("_o"), *(F.col(v).alias(f"{v}_old") for v in values))
    b = new.select(F.col(key).alias("_n"), *(F.col(v).alias(f"{v}_new") for v in values))
    x = a.join(b, F.col("_o") == F.col("_n"), "full")
    state = F.when(F.col("_o").isNull(), "nueva").when(F.col("_n").isNull(), "eliminada").otherwise("mantiene")
    changed = reduce(lambda p, q: p | q, (~F.col(f"{v}_old").eqNullSafe(F.col(f"{v}_new")) for v in values))
    return x.select(F.coalesce("_o", "_n").alias(key), state.alias("estado"), *(f"{v}_{s}" for v in values for s in ("old", "new")), ((state == "mantiene") & changed).alias("cambio"))


def snapshot_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("estado").agg(F.count("*").alias("n"), F.count_if("cambio").alias("cambios"))


def compare_filter(entries: DataFrame, state: str | None, q: str, columns: list[str]) -> DataFrame:
    """Entries in a state (None: any) with q, whatever its case, in one of the columns."""
    hit = reduce(lambda a, b: a | b, (F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(q.lower())) for c in columns))
    return entries.where((F.lit(state is None) | (F.col("estado") == (state or ""))) & hit)


def enrich_kept(entries: DataFrame, extra: DataFrame, key: str, value: str) -> DataFrame:
    """`value` of the last row (ord) of each key of extra, for entries that are kept."""
    last = extra.groupBy(key).agg(F.max_by(value, "ord").alias("_v")).withColumnRenamed(key, "_k")
    return entries.join(last, (F.col(key) == F.col("_k")) & (F.col("estado") == "mantiene"), "left").drop("_k").withColumnRenamed("_v", value)
