"""Records of text files, by page: python -m rosterloom.cli text FOLDER -o OUT -f csv json -d 069; quality: report FOLDER -o OUT.

Images of which several takes were read (pag_0012 (1).txt, pag_0012 (2).txt, ...) are worked off in runs that go on where the last
one ended: sample FOLDER -n 2 reads some of each page, full FOLDER the rest, combine FOLDER gives the records of each page's best take.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.functions.rules import rules_for
from rosterloom.operators import parse, tasks
from rosterloom.operators.dedup import top_n
from rosterloom.operators.search import page_range
from rosterloom.sources import readers, sinks
from rosterloom.streaming.retry import PageCache

WRITERS = {
    "csv": lambda df, stats, path: sinks.to_csv(df, f"{path}/csv"),
    "json": lambda df, stats, path: sinks.to_json_pages(df, stats, f"{path}/json"),
    "parquet": lambda df, stats, path: df.write.mode("overwrite").parquet(f"{path}/parquet"),
    "xlsx": lambda df, stats, path: sinks.to_excel(df, f"{path}/records.xlsx"),
}


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="rosterloom")
    commands = top.add_subparsers(dest="command", required=True)
    about = {
        "text": "records of recognised text", "report": "a line on the quality of each page", "sample": "reads the first takes of each page",
        "full": "reads all takes that weren't read before", "combine": "the records of each page's best take",
    }
    for name, about in about.items():
        sub = commands.add_parser(name, help=about)
        sub.add_argument("input", help="a text file or a folder of them")
        sub.add_argument("-d", "--district", default="069")
        sub.add_argument("-o", "--output", default="./output")
        sub.add_argument("-p", "--pages", help="a-b or n")
        sub.add_argument("-f", "--format", nargs="+", default=["json"], choices=sorted(WRITERS))
        sub.add_argument("-n", "--takes", type=int, default=2, help="takes of each page for a sample")
    return top.parse_args(args)


def records_of(spark: SparkSession, path: str, district: str, pages: str | None = None) -> DataFrame:
    files = readers.text_lines(spark, path)
    files = page_range(files, pages) if pages else files
    return parse.records(parse.parse_lines(parse.page_lines(files), rules_for(district)))


def takes(files: DataFrame) -> DataFrame:
    """(page, group, ord, text) of text files: a take of an image is named by its file, its group by pag_NNNN; the corrected take, without a number, comes first."""
    name = F.col("file")
    ord = F.coalesce(F.regexp_extract(name, r"[(]([0-9]+)[)]", 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    return files.select(name.alias("page"), F.regexp_extract(name, "^(pag_[0-9]+)", 1).alias("group"), ord.alias("ord"), "text").where("group <> ''")


def read_takes(spark: SparkSession, path: str, output: str, district: str, most: int | None = None) -> DataFrame:
    """The records of all takes read so far, after those that are missing (the first `most` of each page, if given) have been read."""
    todo = takes(readers.text_lines(spark, path))
    todo = top_n(todo, ["group"], [F.col("ord"), F.col("page")], most) if most is not None else todo
    read = lambda pages: parse.records(parse.parse_lines(parse.page_lines(pages), rules_for(district)))
    return PageCache(f"{output}/cache").update(todo, read)


def combined(spark: SparkSession, output: str, records: DataFrame) -> DataFrame:
    """The records of the best take of each page, with the take that they are from."""
    about = takes(PageCache(f"{output}/cache").done(spark, "string").select(F.col("page").alias("file"), F.lit("").alias("text"))).drop("text")
    counts = parse.page_quality(records).select("page", "con_dni", "con_nombre", F.col("total").alias("records"))
    sized = about.join(counts, "page", "left").na.fill(0, ["con_dni", "con_nombre", "records"])
    best = tasks.best_variant(sized.withColumn("path", F.col("page")), "group").select("group", F.col("path").alias("page"), "anomaly")
    return records.join(best, "page").withColumnRenamed("page", "source_file")


def main(args: list[str] | None = None) -> None:
    a = arguments(args)
    spark = SparkSession.builder.appName("rosterloom").getOrCreate()
    if a.command in ("sample", "full", "combine"):
        found = read_takes(spark, a.input, a.output, a.district, {"sample": a.takes, "combine": 0}.get(a.command))
        if a.command == "combine":
            sinks.to_csv(combined(spark, a.output, found), f"{a.output}/combined")
        else:
            number = F.regexp_extract("page", "^pag_([0-9]+)", 1).try_cast("bigint")
            sinks.quality_report(parse.page_quality(found).withColumn("page", number)).orderBy("page").select("line").write.mode("overwrite").text(f"{a.output}/report")
        return
    found = records_of(spark, a.input, a.district, a.pages)
    stats = parse.page_quality(found)
    if a.command == "report":
        sinks.quality_report(stats).orderBy("page").select("line").write.mode("overwrite").text(f"{a.output}/report")
        return
    for kind in a.format:
        WRITERS[kind](found, stats, a.output)


if __name__ == "__main__":
    main()
