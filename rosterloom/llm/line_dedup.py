"""Line dedup (operator 6), in DataFrame functions only.

Lines are exploded, normalised and hashed; the hashes found in many documents are kept as a table; the positions of
their lines are gathered for each distinct text and cut out of it in place.

- Every row is a document: repeated rows count as documents of their own. Ids may be null or repeated; results belong
  to the text, so equal texts get equal results.
- A null or empty text is one empty line. Empty keys are never dropped (min_chars is 1 at least).
- If all lines go, the kept text is empty. An empty table gives an empty result. Very long texts are split whole.
- Output columns replace input columns of the same name; all others pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.common import content_key, lower_ascii, text_of, written

SPACE = " \t\n\x0b\x0c\r"
#: So many hashes of lines (16 bytes each) may be broadcast.
MAX_SENT = 500_000


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def _hashes(key: Column) -> list[Column]:
    """128 bits of a key as two columns that aggregate and join fast."""
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("line"), key).alias("_h2")]


def repeated_lines(df: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Hashes of the keys of min_chars or more code points that min_docs or more documents hold.

    A document names each of its keys once, so a plain count with map-side sums gives the distinct documents; a line
    that a third of all documents share is one row for each map task.
    """
    keys = F.array_distinct(F.transform(F.split(text_of(text), "\n", -1), line_key))
    return (
        df.select(F.explode(keys).alias("_key"))
        .where(F.char_length("_key") >= max(1, min_chars))
        .select(*_hashes(F.col("_key")))
        .groupBy("_h1", "_h2")
        .count()
        .where(F.col("count") >= min_docs)
        .select("_h1", "_h2")
    )


def dropped_positions(df: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """For each distinct text with such lines: their sorted positions, from 0.

    The hashes are broadcast up to MAX_SENT of them. They and the positions are written, so that lines or texts that very
    many documents hold are split where they are joined.
    """
    hot = written(repeated_lines(df, text, min_docs, min_chars))
    hot = F.broadcast(hot) if hot.limit(MAX_SENT + 1).count() <= MAX_SENT else hot
    lines = df.select(content_key(text_of(text)).alias("__rl_content"), F.posexplode(F.split(text_of(text), "\n", -1)).alias("_pos", "_line"))
    hashed = lines.withColumn("_key", line_key(F.col("_line"))).where(F.char_length("_key") >= max(1, min_chars)).select("__rl_content", "_pos", *_hashes(F.col("_key")))
    return written(hashed.join(hot, ["_h1", "_h2"]).groupBy("__rl_content").agg(F.array_sort(F.collect_set("_pos")).alias("__rl_bad")))


def dedup_lines(df: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1, out: str = "kept_text") -> DataFrame:
    """df with `out` (the text without repeated lines), n_lines (before) and n_dropped."""
    bad = dropped_positions(df, text, min_docs, min_chars)
    lines, gone = F.split(text_of(text), "\n", -1), F.coalesce("__rl_bad", F.array().cast("array<int>"))

    def kept(arrays: Column) -> Column:
        """The runs of lines between dropped ones: as many slices as there are dropped lines and one."""
        ls, ds = arrays["ls"], arrays["ds"]
        first = lambda i: F.when(i == 0, 0).otherwise(F.get(ds, i - 1) + 1)
        end = lambda i: F.when(i == F.size(ds), F.size(ls)).otherwise(F.get(ds, i))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(ds)), lambda i: F.slice(ls, first(i) + 1, end(i) - first(i))))

    joined = df.withColumn("__rl_content", content_key(text_of(text))).join(bad, "__rl_content", "left")
    whole = F.when(F.size(gone) == 0, text_of(text)).otherwise(F.array_join(F.transform(F.array(F.struct(lines.alias("ls"), gone.alias("ds"))), kept)[0], "\n"))
    new = {out: whole, "n_lines": F.size(lines).cast("long"), "n_dropped": F.size(gone).cast("long")}
    return joined.withColumns(new).drop("__rl_content", "__rl_bad")
