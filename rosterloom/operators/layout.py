"""Words and rows in reading order to lines, groups and sections."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.functions.text import strip


def word_rows(words: DataFrame, tolerance: int = 20) -> DataFrame:
    """words (page, ord, y) with the row of each: a row starts where y is more than `tolerance` from the row's first word.

    The anchor, not the previous word, decides, so no window can say it: it is a fold over a page's words in order of y. The
    words of a page come sorted, and the fold keeps the anchor and the row's number alone, however many words a page has.
    """
    typed = words.select("page", F.col("ord").cast("bigint").alias("ord"), F.col("y").cast("bigint").alias("y"))
    kind = typed.schema["page"].dataType.simpleString()
    sorted_pages = typed.repartition("page").sortWithinPartitions("page", "y", "ord")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, anchor, row = object(), 0, -1
        for batch in batches:
            out = []
            for p, y in zip(batch.column("page").to_pylist(), batch.column("y").to_pylist(), strict=True):
                if p != page:
                    page, anchor, row = p, y, 0
                elif y is not None and (anchor is None or abs(y - anchor) > tolerance):
                    anchor, row = y, row + 1
                out.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("page"), batch.column("ord"), pa.array(out, pa.int64())], names=["page", "ord", "row"])

    return sorted_pages.mapInArrow(run, f"page {kind}, ord long, row long")


def reading_order(spans: DataFrame, *ties: str) -> DataFrame:
    """spans (page, col, y, x, ...) with their place on the page, from 0: column by column, from above, from the left, then by `ties`, or else by a hash of the whole span."""
    last = ties or (F.xxhash64(*(F.col(f"`{c}`") for c in spans.columns)),)
    return spans.withColumn("pos", F.row_number().over(Window.partitionBy("page").orderBy("col", "y", "x", *last)).cast("bigint") - 1)


def text_spans(spans: DataFrame, size: float = 8.0, tolerance: float = 0.5, bold: str = "Hv") -> DataFrame:
    """Raw spans (page, ord, page_width, text, size, font, x0, y0) that are text of that size, with bold, col, y, x and their place on the page (pos).

    A span's font is bold if its name has `bold`; it is in the second column from the middle of the page on. Blank text and
    text of other sizes goes. Spans in one place stay in their order (ord), those of one number too go by text and bold, so
    that the places are the same in each run.
    """
    text = strip(F.col("text"))
    fine = spans.where((text != "") & (F.abs(F.col("size") - size) < tolerance))
    x = fine.select(
        "page", "ord", text.alias("text"), F.contains("font", F.lit(bold)).alias("bold"),
        F.when(F.col("x0") < F.col("page_width") / 2, 0).otherwise(1).cast("bigint").alias("col"), F.bround("y0", 1).alias("y"), F.bround("x0", 1).alias("x"),
    )
    return reading_order(x, "ord", "text", "bold")


def gap_columns(spans: DataFrame, least: float = 12.0) -> DataFrame:
    """spans (page, x0, x1, ...) with `col`, the number from 0 of the column that each is in: columns are parted by gaps of at least `least` that no span of the page reaches into."""
    w = Window.partitionBy("page").orderBy("x0", "x1")
    reach = F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1))  # how far the spans to the left go
    starts = F.when(F.col("x0") - reach >= least, 1).otherwise(0)
    return spans.withColumn("_starts", starts).withColumn("col", F.sum("_starts").over(w.rangeBetween(Window.unboundedPreceding, 0)).cast("bigint")).drop("_starts")


def baselines(spans: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """spans (page, col, y, ...) with `line`, the number from 0 of the line of the column that each is on: a line ends where the next span is more than `tolerance` lower."""
    w = Window.partitionBy("page", "col").orderBy("y")
    lower = F.when(F.col("y") - F.lag("y").over(w) > tolerance, 1).otherwise(0)
    return spans.withColumn("_lower", lower).withColumn("line", F.sum("_lower").over(w.rangeBetween(Window.unboundedPreceding, 0)).cast("bigint")).drop("_lower")


def row_texts(words: DataFrame, rows: DataFrame) -> DataFrame:
    """The text of each row, its words by x."""
    x = words.join(rows, ["page", "ord"])
    return x.groupBy("page", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "ord", "text"))), lambda w: w["text"]), " ").alias("line"))


def islands(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """df with the number (from 0) of each run of equal values in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_new", (~F.lag(value).over(w).eqNullSafe(F.col(value)) & F.lag(F.lit(1)).over(w).isNotNull()).cast("bigint")).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def lines_of_words(words: DataFrame) -> DataFrame:
    """words (page, pos, line_num, text, conf, x, y, w, h) to lines: text, mean confidence, and the box around them."""
    x = islands(words, ["page"], ["pos"], "line_num")
    right, bottom = F.max(F.col("x") + F.col("w")), F.max(F.col("y") + F.col("h"))
    return x.groupBy("page", "island").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda t: t["text"]), " ").alias("text"),
        F.avg("conf").alias("conf"), F.min("x").alias("x"), F.min("y").alias("y"), (right - F.min("x")).alias("w"), (bottom - F.min("y")).alias("h"),
    )


def mean_confidence(blocks: DataFrame) -> DataFrame:
    """The mean of the confidences above 0 of each page; 0.5 if there is none."""
    return blocks.groupBy("page").agg(F.coalesce(F.avg(F.when(F.col("conf") > 0, F.col("conf"))), F.lit(0.5)).alias("conf"))


def sheet_groups(rows: DataFrame) -> DataFrame:
    """rows (sheet, pos, mesa or null, item): a row with a number opens a group, those below add their items to it."""
    w = Window.partitionBy("sheet").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    x = rows.withColumn("grp", F.count("mesa").over(w)).where("grp > 0")
    return x.groupBy("sheet", "grp").agg(F.max("mesa").alias("mesa"), F.transform(F.array_sort(F.collect_list(F.when(F.col("item") != "", F.struct("pos", "item")))), lambda r: r["item"]).alias("items"))


def look_ahead(rows: DataFrame, empty: tuple[str, ...] = ("", "y", "e"), orphan: str = "OTRO") -> DataFrame:
    """rows (grp, pos, tail) with location: a row whose tail says nothing takes the next that says something."""
    w = Window.partitionBy("grp").orderBy("pos").rowsBetween(0, Window.unboundedFollowing)
    own = F.when(~F.trim("tail").isin(*empty), F.trim("tail"))
    return rows.withColumn("location", F.coalesce(F.first(own, ignorenulls=True).over(w), F.lit(orphan)))


def bold_sections(spans: DataFrame) -> DataFrame:
    """spans (page, pos, bold, text): bold spans in a row are one title; plain spans below are its body."""
    x = islands(spans, ["page"], ["pos"], "bold")
    w = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.col("bold") & ~F.coalesce(F.lag("bold").over(Window.partitionBy("page").orderBy("pos")), F.lit(False))
    x = x.withColumn("_starts", starts.cast("bigint")).withColumn("section", F.sum("_starts").over(w))
    joined = lambda b: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("bold") == b, F.struct("pos", "text")))), lambda r: r["text"]), " ")
    return x.groupBy("page", "section").agg(joined(True).alias("title"), joined(False).alias("body"))
