"""Benchmark decontamination (operator 7), in DataFrame functions only.

Every window of `n` benchmark words becomes a hash and its text. One scan cuts a document into words, hashes each word
and then each n words in a row; these are joined with the hash set map-side, and the words are compared before a hit
counts. Beyond `broadcast_windows` the hashes are joined by a shuffle.

- An item of fewer than n words, but not none, is one window of its own length.
- A null text has no words; an item without words never occurs. A null item_id is listed as an empty string.
- Results belong to the text: repeated rows, null or repeated ids each get the result of their text.
- An empty benchmark or an empty table gives documents without hits, or no rows.
- A very long text is one row with an array of a hash for each word; it is never cut.
- Output columns replace input columns of the same name; all others pass unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.common import WORD, col, content_key, lower_ascii, text_of, written

#: So many pairs of window and item (some 100 bytes each) may be broadcast; more are joined by a shuffle.
BROADCAST_WINDOWS = 400_000
#: The characters of WORD and A-Z: words are cut first and lower-cased one by one, as few of them need more than ASCII.
_ANY_CASE = r"[0-9A-Za-z\x80-\x{10FFFF}]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once: named as a column, the optimizer would put its expression in each place."""
    return F.transform(F.array(x), f)[0]


def _window_hashes(ws: Column, sizes: list[int]) -> Column:
    """A null, then the hashes of each `size` words in a row, one size after another.

    Hashes of 1, 2, 4, ... words are made of two of half the length; those of `size` words of the ones that add up to it.
    """
    none = F.array().cast("array<bigint>")
    joined = lambda a, b, n: F.transform(a, lambda x, i: F.xxhash64(x, F.get(b, i + n)))  # noqa: E731  a of n words, b of those behind

    def of_size(levels: dict[int, Column], size: int) -> Column:
        parts = [k for k in sorted(levels, reverse=True) if size & k]
        out, n = levels[parts[0]], parts[0]
        for k in parts[1:]:
            out, n = joined(out, levels[k], n), n + k
        count = F.size(levels[1]) - size + 1
        return F.when(count > 0, F.slice(out, F.lit(1), count)).otherwise(none)  # those at the end lack words

    def build(levels: dict[int, Column]) -> Column:
        k = max(levels)
        if sizes and 2 * k <= max(sizes):
            return _bound(joined(levels[k], levels[k], k), lambda a: build(levels | {2 * k: a}))
        return F.concat(F.array(F.lit(None).cast("bigint")), *(of_size(levels, size) for size in sizes))

    return _bound(F.transform(ws, lambda w: F.xxhash64(lower_ascii(w))), lambda a: build({1: a}))


def benchmark_windows(bench: DataFrame, n: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """item, length, hash and words of each window of each item."""
    items = bench.select(F.coalesce(col(item).cast("string"), F.lit("")).alias("_item"), words(text_of(text)).alias("_ws")).where(F.size("_ws") > 0)
    items = items.withColumn("_n", F.least(F.size("_ws"), F.lit(n)))
    sizes = sorted(r["_n"] for r in items.select("_n").distinct().collect()) or [n]  # n at most

    def of(size: int) -> DataFrame:
        at = items.where(F.col("_n") == size).select("_item", "_ws", F.posexplode_outer(_window_hashes(F.col("_ws"), [size])).alias("_i", "_hash")).where("_i > 0")
        return at.select("_item", F.lit(size).alias("_n"), "_hash", F.array_join(F.slice("_ws", F.col("_i"), F.lit(size)), " ").alias("_window"))

    return reduce(DataFrame.unionByName, map(of, sizes)).distinct()


def _scanned(docs: DataFrame, text: str, sizes: list[int]) -> DataFrame:
    """_content, _ws (words as written) and _hs of each document: a null, which stands for the document, then the hashes of its windows."""
    both = lambda ws: F.struct(ws.alias("ws"), _window_hashes(ws, sizes).alias("hs"))
    cut = F.regexp_extract_all(text_of(text), F.lit(_ANY_CASE), F.lit(0))
    return docs.select(content_key(text_of(text)).alias("_content"), _bound(cut, both).alias("_both")).select("_content", F.col("_both.ws").alias("_ws"), F.col("_both.hs").alias("_hs"))


def _place(sizes: list[int]) -> Column:
    """The place in the document of a window, from its place in _hs: the windows of other sizes before it and the first null go."""
    before = F.lit(1)
    cases, n_words = F.when(F.lit(False), F.lit(0)), F.size("_ws")
    for size in sizes:
        cases = cases.when(F.col("_n") == size, F.col("_at") - before)
        before = before + F.greatest(n_words - size + 1, F.lit(0))
    return cases


def _verified(hit: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for each document and each candidate hit: whether its words are those of the window is a value, not a condition, of which the optimizer would make a key."""
    placed = hit.withColumn("_pos", _place(sizes))
    own = F.array_join(F.transform(F.slice("_ws", F.col("_pos") + 1, F.col("_n")), lower_ascii), " ")
    return placed.select("_content", F.size("_ws").alias("_count"), F.when(own == F.col("_window"), F.struct(F.col("_pos").alias("s"), (F.col("_pos") + F.col("_n")).alias("e"), F.col("_items").alias("items"))).alias("_hit"))


def text_hits(docs: DataFrame, windows: DataFrame, text: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """_content, _count (words) and _hits (start, end, items; sorted) of each distinct text."""
    own = windows.groupBy("_n", "_hash", "_window").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    counts = {r["_n"]: r["c"] for r in windows.groupBy("_n").agg(F.count("*").alias("c")).collect()}  # at most n rows
    sizes = sorted(counts)
    at = _scanned(docs, text, sizes).select("_content", "_ws", F.posexplode_outer("_hs").alias("_at", "_hash"))  # outer: else the optimizer cuts and hashes once more, for a filter below
    if sum(counts.values()) <= broadcast_windows:
        near = at.join(F.broadcast(own), "_hash", "left").where((F.col("_at") == 0) | F.col("_n").isNotNull())
    else:  # the places of hashes that occur are gathered by text; the words are compared where they come back to it
        found = at.where("_at > 0").select("_content", "_at", "_hash").join(own, "_hash").groupBy("_content").agg(F.collect_set(F.struct("_at", "_n", "_window", "_items")).alias("_x"))
        held = _scanned(docs, text, []).select("_content", "_ws").join(written(found), "_content", "left")
        near = held.select("_content", "_ws", F.explode_outer("_x").alias("_x")).select("_content", "_ws", "_x.*")
    return _verified(near, sizes).groupBy("_content").agg(F.max("_count").alias("_count"), F.array_sort(F.collect_set("_hit")).alias("_hits"))


def _spans(hits: Column, n: int) -> Column:
    """Sorted windows as runs: touching ones run together. A window is of n words at most, so only the n - 1 starts before one can reach it."""
    last = F.filter(hits, lambda x, i: (i == F.size(hits) - 1) | (F.get(hits, i + 1)["s"] != x["s"]))  # the longest of each start

    def opened(xs: Column) -> Column:
        upto = lambda i: F.array_max(F.transform(F.slice(xs, F.greatest(i - n + 1, F.lit(0)) + 1, F.least(i, F.lit(n - 1))), lambda y: y["e"]))
        return F.struct(xs.alias("xs"), F.filter(F.transform(xs, lambda x, i: F.when((i == 0) | (upto(i) < x["s"]), i)), lambda i: i.isNotNull()).alias("opens"))

    def runs(x: Column) -> Column:
        stop = lambda k: F.coalesce(F.get(x["opens"], k + 1), F.size(x["xs"]))
        return F.transform(x["opens"], lambda i, k: F.struct(F.get(x["xs"], i)["s"].alias("s"), _end(x["xs"], stop(k), n).alias("e")))

    # lambdas bind what is used at each place
    return _bound(_bound(last, opened), runs)


def _end(xs: Column, stop: Column, n: int) -> Column:
    """The largest end of those before `stop` in a run: one of the last n starts has it."""
    return F.array_max(F.transform(F.slice(xs, F.greatest(stop - n, F.lit(0)) + 1, F.least(stop, F.lit(n))), lambda y: y["e"]))


def decontaminate(docs: DataFrame, bench: DataFrame, n: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """docs with n_words, n_hit, item_ids (array, sorted as strings), hit_spans (array of start and end word) and contaminated.

    The caller drops contaminated documents or cuts the spans. What was found is written by text, so that a text that
    many documents hold is split where it goes back to them.
    """
    found = text_hits(docs, written(benchmark_windows(bench, n, item, item_text)), text, broadcast_windows)
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda x: x["items"]))))
    bare = F.transform("_hits", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    found = written(found.select(F.col("_content").alias("__rl_content"), F.col("_count").cast("long").alias("__rl_count"), _spans(bare, n).alias("__rl_spans"), items.alias("__rl_items")))
    out = docs.withColumn("__rl_content", content_key(text_of(text))).join(found, "__rl_content", "left")
    n_hit = F.aggregate("__rl_spans", F.lit(0).cast("long"), lambda a, x: a + (x["e"] - x["s"]))
    new = {"n_words": F.col("__rl_count"), "n_hit": n_hit, "item_ids": F.col("__rl_items"), "hit_spans": F.col("__rl_spans"), "contaminated": n_hit > 0}
    return out.withColumns(new).drop("__rl_content", "__rl_count", "__rl_spans", "__rl_items")
