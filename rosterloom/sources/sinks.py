"""Sinks: files, documents, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.sources import ooxml


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def to_json_pages(records: DataFrame, stats: DataFrame | None, path: str) -> None:
    """A JSON document for each page: its records in order and, if given, its statistics."""
    docs = records.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("pos", *(c for c in records.columns if c not in ("page", "pos"))))).alias("registros"))
    if stats is not None:
        docs = docs.join(stats.select("page", F.struct(*(c for c in stats.columns if c != "page")).alias("stats")), "page", "left")
    docs.select(F.to_json(F.struct(*docs.columns)).alias("value")).write.mode("overwrite").text(path)


def to_excel(df: DataFrame, path: str, most: int = 100_000, links: dict[str, str] | None = None, sheet: str = "Sheet1") -> None:
    """A workbook of at most `most` rows. Columns are as wide as their text, 50 at most; `links` names for a column the one that holds its addresses."""
    ooxml.write_workbook({sheet: df}, path, links, most)


def split_rejects(parsed: DataFrame, good: Callable[[DataFrame], DataFrame], bad: Callable[[DataFrame], DataFrame], path: str) -> None:
    good(parsed).write.mode("overwrite").parquet(f"{path}/records")
    bad(parsed).write.mode("overwrite").parquet(f"{path}/rejects")


def by_class(df: DataFrame, column: str, path: str) -> None:
    """A folder for each class."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def quality_report(quality: DataFrame) -> DataFrame:
    """A line of text for each page."""
    return quality.select("page", F.format_string("page %04d: %d records, %d ids, %.1f%% complete, %s", "page", "total", "con_dni", "completitud", "calidad").alias("line"))


def write_batches(df: DataFrame, commit: Callable[[list], None], size: int = 500) -> DataFrame:
    """Gives the rows of each partition to `commit` in lists of at most `size`; returns the commits made (partition, rows).

    A task that runs again commits its rows again: `commit` must take a row twice, as writes by key do.
    """
    names = df.columns

    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        from pyspark import TaskContext

        held, made = [], []
        for pdf in batches:
            for row in pdf.to_dict("records"):
                held.append(row)
                if len(held) == size:
                    commit(held)
                    made.append(size)
                    held = []
        if held:
            commit(held)
            made.append(len(held))
        yield pd.DataFrame({"partition": [TaskContext.get().partitionId()] * len(made), "rows": made})

    return df.select(*names).mapInPandas(run, "partition int, rows int")


def dry_run(df: DataFrame, n: int = 5) -> tuple[list, int]:
    """The first rows and the count, with nothing written."""
    return df.limit(n).collect(), df.count()


def clear(df: DataFrame, path: str) -> None:
    """An empty table of the same schema in place of what is there."""
    df.limit(0).write.mode("overwrite").parquet(path)
