"""Source divergence audit (operator 13): how far the term shares of the sources of a language lie apart.

Terms are runs of letters (A-Z lower-cased, and every character outside ASCII). A language keeps the terms that at least
`least` of its documents hold. With N a group's count of kept terms and V their number, a term's share in parts of 10^9 is
p = 1 + floor(10^9 (count + 5) / (N + 5 V)), for each (language, source) and for the language as a whole; f = |p - q|.

The counts meet in term-block dense matrices: a tile holds a block of a language's terms for all of its sources, as 64-bit
whole numbers. A tile gives the sum of f for each pair of sources, by broadcasting a source against all, and the first 50
terms of each source from a heap; pair sums are added up over tiles, heaps are merged for each source.

- Null text, language and source are ''. Rows are documents, whether or not ids repeat; ids and other columns aren't read.
- Every (language, source) that occurs has its `pair` rows, with value 0 where the language keeps no term. A language with
  one source has no pairs. An empty table gives no rows. Terms may be of any length.
- Ties go by the item's UTF-8. All arithmetic is in whole numbers, right up to counts of 9 * 10^15.
- What a task has counted is summed in the task, within HELD terms and whatever the size of its batches, so a term of a
  third of all rows is a row for each source and HELD terms of a task. All counts of a term meet in one shuffle, by language
  and term. Tiles have a bounded number of cells, however many sources or terms a language has, and come as Arrow columns. The
  result has a row for each ordered pair of a language's sources, as asked for; nothing else grows with their square but a
  tile's sums.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.llm.common import written

LEAST, TOP, EXTRA, SCALE = 30, 50, 5, 1_000_000_000
#: Cells (terms x sources) of a tile, 8 bytes each in some four arrays.
CELLS = 1 << 20
#: Distinct (language, source, term) that a task holds before it gives out what it has counted.
HELD = 700_000
#: Documents that a task has as Python texts at a time, and rows of a batch that it gives out.
TAKEN, GIVEN = 64, 50_000
COUNTED = "lang string, source string, term string, n long, docs long"
#: Letters in lower case; every other byte is a blank. Bytes outside ASCII are of letters.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_LETTERS).split()


def counted(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a row for each task that has met it, or more. A task holds documents by term, and further occurrences for those that a document repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, dict]] = {}
        size = 0
        for part in (b.slice(i, TAKEN) for b in batches for i in range(0, b.num_rows, TAKEN)):
            for text, lang, source in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                docs, again = held.setdefault((lang, source), (Counter(), {}))
                words = Counter(terms_of(text))
                size -= len(docs)
                docs.update(iter(words))  # each once
                size += len(docs)
                for w, k in words.items():
                    if k > 1:
                        again[w] = again.get(w, 0) + k - 1
                if size > HELD:
                    yield from _given(held)
                    held, size = {}, 0
        yield from _given(held)

    return documents.mapInArrow(run, COUNTED)


def _given(held: dict) -> Iterator[pa.RecordBatch]:
    """What is held, a group after another; each is gone from `held` when it has been given."""
    while held:
        (lang, source), (docs, again) = held.popitem()
        rows = iter(docs.items())
        while some := list(islice(rows, GIVEN)):
            terms, once = zip(*some, strict=True)
            n = [d + again.get(t, 0) for t, d in some]
            columns = [pa.repeat(pa.scalar(x, pa.string()), len(n)) for x in (lang, source)] + [pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(once, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def share(count: np.ndarray, total: int, scale: int = SCALE) -> np.ndarray:
    """1 + floor(scale * count / total), three digits of the scale at a time, so that 64 bits hold every step."""
    out, rest = np.divmod(count.astype(np.int64), total)
    while scale > 1:
        step = min(scale, 1000)
        scale //= step
        more, rest = np.divmod(rest * step, total)
        out = out * step + more
    return out + 1


def audit(documents: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` for each other source, part `term` for the first `top` terms."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias
    docs = documents.select(of(text)("text"), of(lang)("lang"), of(source)("source"))
    groups = written(docs.select("lang", "source").distinct())
    by_source = counted(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("own"))
    kept = written(by_term.where(F.col("docs") >= least).select("lang", "term", "own"))
    about = written(_about(groups, kept))
    tiles = _tiles(kept, about)
    out = written(tiles.select("lang", "about", "terms").mapInArrow(lambda x: _tile_results(x, top), "lang string, a string, b string, term string, value long"))
    pairs = _pairs(out.where("term IS NULL"), groups)
    return pairs.unionByName(_terms(out.where("term IS NOT NULL"), top))


def _about(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, about): the number of kept terms, and each source with its count, sources in order; a row for each language."""
    each = kept.select("lang", F.explode("own").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("n"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("v"))
    per = groups.join(each, ["lang", "source"], "left").groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("sources"))
    return per.join(terms, "lang").select("lang", F.struct("v", "sources").alias("about"))


def _tiles(kept: DataFrame, about: DataFrame) -> DataFrame:
    """(lang, tile, about, terms): a block of terms with their counts by source; the number of blocks follows terms x sources, so each has about CELLS cells."""
    blocks = about.select("lang", F.ceil(F.col("about.v") * F.size("about.sources") / F.lit(CELLS)).alias("_blocks"))
    dealt = kept.join(blocks, "lang").withColumn("tile", F.pmod(F.xxhash64("term"), F.col("_blocks")))
    return dealt.groupBy("lang", "tile").agg(F.collect_list(F.struct("term", "own")).alias("terms")).join(about, "lang")


def _counts_of(terms: pa.StructArray, sources: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The terms of a tile and its matrix, sources x terms, filled from the columns: no cell is ever a Python object."""
    names, own = terms.flatten()
    source, n = own.flatten().flatten()
    at = pc.index_in(source, value_set=pa.array(sources, source.type)).to_numpy(zero_copy_only=False)
    counts = np.zeros((len(sources), len(names)), np.int64)
    counts[at, np.repeat(np.arange(len(names)), own.value_lengths().to_numpy(zero_copy_only=False))] = n.to_numpy(zero_copy_only=False)
    return names.cast(pa.binary()).to_pylist(), counts


def _tile_rows(lang: str, a: str, b: list | None, term: list | None, value: list | np.ndarray) -> pa.RecordBatch:
    k, none = len(value), pa.nulls(len(value), pa.string())
    columns = [pa.array([lang] * k, pa.string()), pa.array([a] * k, pa.string()), none if b is None else pa.array(b, pa.string()), none if term is None else pa.array(term, pa.string()), pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "term", "value"])


def _tile_results(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """For each tile the sum of f for each pair of sources (a before b), then the first terms of each source."""
    for batch in batches:
        for lang, about, terms in zip(*(batch.column(c) for c in ("lang", "about", "terms")), strict=True):
            lang, about = lang.as_py(), about.as_py()
            sources = [x["source"] for x in about["sources"]]
            names, counts = _counts_of(terms.values, sources)
            totals = np.array([x["n"] for x in about["sources"]], np.int64) + EXTRA * about["v"]
            p = np.stack([share(c + EXTRA, int(n)) for c, n in zip(counts, totals, strict=True)])
            q = share(counts.sum(axis=0) + EXTRA, int(totals.sum() - EXTRA * about["v"] * (len(sources) - 1)))
            for i, name in enumerate(sources[:-1]):
                yield _tile_rows(lang, name, sources[i + 1 :], None, np.abs(p[i + 1 :] - p[i]).sum(axis=1))
            for i, name in enumerate(sources):
                over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                first = heapq.nsmallest(top, ((int(q[j] - p[i, j]), names[j]) for j in over))
                if first:
                    yield _tile_rows(lang, name, None, [t.decode() for _, t in first], [-v for v, _ in first])


def _ranked(rows: DataFrame, part: str, item: Column, value: Column) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), item.alias("item"), value.alias("value")).withColumn("rank", F.row_number().over(w))


def _pairs(sums: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source with each other one of its language, which is what is asked for, and the sum of their tiles' values."""
    total = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    total = total.unionByName(total.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")).withColumnsRenamed({"a": "source", "b": "other"})
    others = groups.groupBy("lang").agg(F.collect_list("source").alias("all"))
    each = groups.join(others, "lang").select("lang", "source", F.explode("all").alias("other")).where("source <> other")
    return _ranked(each.join(total, ["lang", "source", "other"], "left"), "pair", F.col("other"), F.coalesce("value", F.lit(0).cast("long")))


def _terms(heaps: DataFrame, top: int) -> DataFrame:
    """The heaps of a source's tiles merged, and its first terms ranked."""

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        first = heapq.nsmallest(top, zip(-pdf["value"], (t.encode() for t in pdf["term"]), strict=True))
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "source": pdf["a"].iloc[0], "part": "term", "item": [t.decode() for _, t in first], "value": [-v for v, _ in first], "rank": range(1, len(first) + 1)})

    return heaps.groupBy("lang", "a").applyInPandas(merged, "lang string, source string, part string, item string, value long, rank int")
