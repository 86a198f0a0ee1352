"""Choosing rows within a key by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.sources.shared import written


def _ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def keep_first(df: DataFrame, keys: list[str], ord: str) -> DataFrame:
    """The row of least `ord` of each key: a partial aggregate before the shuffle, so a hot key costs a row for each task."""
    return _extreme(df, keys, ord, F.min_by)


def keep_last(df: DataFrame, keys: list[str], ord: str) -> DataFrame:
    return _extreme(df, keys, ord, F.max_by)


def _extreme(df: DataFrame, keys: list[str], ord: str, of) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(of(F.struct(*rest), F.col(ord)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key."""
    return _ranked(df, keys, order).where(F.col("_rn") <= n).drop("_rn")


def duplicates(df: DataFrame, keys: list[str], ord: str) -> DataFrame:
    """The rows that keep_first leaves out."""
    return _ranked(df, keys, [F.col(ord)]).where(F.col("_rn") > 1).drop("_rn")


def places(df: DataFrame, *order: str) -> DataFrame:
    """df with its place (from 0) in a total order, by ranges and offsets: no window holds all rows.

    The rows are written as they are, numbered, which breaks ties and splits keys of very many rows; then in ranges, each
    with the number of its range and place in it. Both are read back, so nothing depends on a plan that runs twice.
    """
    row, at, before = "__places_row", "__places_at", "__places_before"
    fixed = written(df.withColumn(row, F.monotonically_increasing_id()))
    ranged = fixed.repartitionByRange(*order, row).sortWithinPartitions(*order, row)
    placed = written(ranged.drop(row).withColumn(at, F.monotonically_increasing_id()))  # the range in the upper bits, the place in it below
    part, inside = F.shiftright(at, 33), F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_range")).agg(F.count("*").alias("_n"))
    offset = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", offset.alias(before))  # a row for each range
    out = placed.join(F.broadcast(offsets), part == F.col("_range"))
    return out.select(*(F.col(f"`{c}`") for c in df.columns), (F.col(before) + inside).alias("place"))
