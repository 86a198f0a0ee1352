"""Suffix-array dedup (operator 4): sparse suffix arrays over minimiser positions.

A word position is retained if the hash of the `seed` words from it is the least of some `window` such hashes in a row;
every passage of window + seed - 1 words or more holds one, at the same place wherever it occurs. Retained suffixes whose
seed is in one document only can't be in a shared passage and are left out.

- The suffixes of a seed are sorted by what follows, in shards of the suffix array by seed, and each is compared with
  the next. Neighbours that have r words in common, in a row, are an interval of the array; of these, the suffixes
  with the same least - r words before them match, if they are of two or more documents. So all partners are found in
  the intervals, however many share a seed, without comparing pairs. Each is linked with the first of its group.
- A suffix is extended to both sides as far as its seed is the first least one: what lies beyond is another suffix's.
- Hot keys are split: a seed with more than `hot` suffixes would be one task's work, as long as that seed is common, so
  all windows of `least` words around its places are counted by their hashes, which spread over all shards. Those that
  two or more documents hold are matches too; each holder is linked with the first and the last one. Both ways
  find the same matches.

Matches of `least` words or more are spans; the spans of a long passage overlap and are merged. Documents that share a
span, at one or more removes, are a class.

- Words are runs of digits, letters (A-Z as a-z) and all characters outside ASCII; null, empty and short texts have no
  spans. Texts are whole.
- Rows may repeat, and ids be null or repeated: a document is a row. A passage that occurs twice in one document alone
  isn't a span. Equal documents of `least` words or more are spans of each other. The class id is the least id of the
  class, null if it has none; a document without spans is a class of its own. Ties don't matter: spans are sets.
- An empty table gives no rows. Other columns aren't read.
- Words are compared as hashes of 32 bits within sorted neighbours, counted windows as hashes of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.llm.chunks import CHUNK_BYTES, SHARDED, bytes_of, chunk_table, document_frequencies, frame, frequencies_of, give_back, rising, squeeze, unpack, unrising, unsqueeze
from rosterloom.llm.common import chunks as pieces
from rosterloom.llm.common import _powers, col, grams_of, mix, words_of, written
from rosterloom.llm.graph import components

LEAST, SEED = 50, 8
#: A seed of more suffixes is split: these are some 300 KB in one task.
HOT = 1000
#: Frequencies carry two numbers, documents below this and suffixes above.
SUFFIX = 1 << 32


def _slide(x: np.ndarray, n: int, of: np.ufunc) -> np.ndarray:
    """The least (or largest) of each n in a row, by doubling."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = of(x[: len(x) - step], x[step:])
        have += step
    return x


def minimisers(seeds: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Whether each seed is the least of some `window` seeds in a row of its text; equals all are."""
    if len(seeds) < window:
        return np.zeros(len(seeds), bool)
    low = _slide(seeds, window, np.minimum)
    low[owner[: len(low)] != owner[window - 1 :]] = 0  # across texts
    edge = np.zeros(window - 1, np.uint64)
    return (_slide(np.concatenate([edge, low, edge]), window, np.maximum) == seeds) & (seeds > 0)


def reach(seeds: np.ndarray, owner: np.ndarray, at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """How many positions before each of `at` have larger seeds than it has, in a row, and how many behind it have no smaller ones, up to `most`.

    Of these it is the first least seed, as it is of every passage of `least` words whose seeds are among them; each passage is so one suffix's, the same wherever it occurs.
    """
    out = []
    for way, blocks in ((-1, np.less_equal), (1, np.less)):
        free, n = np.ones(len(at), bool), np.zeros(len(at), np.int64)
        for k in range(1, most + 1):
            i = at + way * k
            there = (i >= 0) & (i < len(seeds))
            i = np.where(there, i, at)
            free &= there & (owner[i] == owner[at]) & ~blocks(seeds[i], seeds[at])
            n += free
        out.append(n)
    return out[0], out[1]


def suffixes(texts: list[bytes], least: int, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By pieces of the texts: word hashes and their texts; all seeds and their word positions; which of them are retained."""
    for a, b in pieces(texts):
        h, _, _, owner = words_of(texts[a:b])
        g, at = grams_of(h, owner, seed)
        yield h, owner + a, g, at, np.flatnonzero(minimisers(g, owner[at], least - seed + 1))


def _contexts(h: np.ndarray, owner: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray:
    """The 32-bit hashes of the words first, ..., last - 1 (or downwards) from each position; 0 outside the text."""
    step = np.arange(first, last) if last > first else np.arange(first, last, -1)
    i = at[:, None] + step
    inside = (i >= 0) & (i < len(h))
    i = np.where(inside, i, 0)
    words = np.maximum(h[i] >> np.uint64(32), np.uint64(1))
    return np.where(inside & (owner[i] == owner[at][:, None]), words, 0).astype(">u4")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words at the start of each row are equal."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def windows_of(h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n words from each position; 0 where the text ends sooner."""
    out = np.zeros(len(h), np.uint64)
    m = len(h) - n + 1
    if m > 0:
        up, down = _powers(len(h) + 1)
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h) * up[: len(h)], out=sums[1:])
        out[:m] = np.where(owner[:m] == owner[n - 1 :], np.maximum(mix((sums[n:] - sums[:m]) * down[:m]), np.uint64(1)), 0)
    return out


def seed_counts(found: list[np.ndarray], shards: int, hot: int) -> tuple[list[bytes], list[bytes]]:
    """The SHARDED columns of a chunk's seeds, given as (text, seed) of each retained position: documents, and SUFFIX for each suffix (of one document, up to one more than `hot`)."""
    prints, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for pairs in found:
        each, times = np.unique(pairs, axis=1, return_counts=True)
        prints.append(each[1])
        counts.append(np.minimum(times, hot + 1).astype(np.uint64) * np.uint64(SUFFIX) + np.uint64(1))
    distinct, at = np.unique(np.concatenate(prints), return_inverse=True)
    sums = np.bincount(at, np.concatenate(counts), minlength=len(distinct)).astype(np.uint64)
    edges = _cuts(distinct, shards)
    return [rising(distinct[a:b]) for a, b in edges], [squeeze(sums[a:b]) for a, b in edges]


def _cuts(distinct: np.ndarray, shards: int) -> list[tuple[int, int]]:
    """Where each shard of the sorted 64-bit hashes is."""
    at = [0, *np.searchsorted(distinct, np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)).tolist(), len(distinct)]
    return list(zip(at, at[1:]))


def window_rows(chunk: int, held: list[tuple[np.ndarray, np.ndarray]], shards: int) -> pd.DataFrame:
    """A row for each shard of a chunk's window hashes, given as (text, hash): how many of its texts hold each, the first and the last."""
    nth, prints = (np.concatenate([np.zeros(0, t), *x]) for t, x in zip((np.int64, np.uint64), zip(*held))) if held else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    order = np.lexsort((nth, prints))
    nth, prints = nth[order], prints[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(prints))[: len(first)] - 1
    distinct = prints[first]
    new = np.append(True, (prints[1:] != prints[:-1]) | (nth[1:] != nth[:-1])) if len(prints) else np.zeros(0, bool)
    docs = np.add.reduceat(new.astype(np.int64), first) if len(first) else first
    own = [(i, a, b) for i, (a, b) in enumerate(_cuts(distinct, shards)) if b > a]
    cut = lambda x: [squeeze(x[a:b]) for _, a, b in own]
    return pd.DataFrame({"chunk": chunk, "shard": pd.Series([i for i, _, _ in own], dtype="Int64"), "prints": pd.Series([rising(distinct[a:b]) for _, a, b in own], dtype=object), "docs": pd.Series(cut(docs), dtype=object), "low": pd.Series(cut(nth[first]), dtype=object), "high": pd.Series(cut(nth[last]), dtype=object)})


_WINDOWS = "shard long, prints binary, docs binary, low binary, high binary"
_HELD = "_chunk long, prints binary, low_chunk binary, low binary, high_chunk binary, high binary"


def held_windows(windows: DataFrame) -> DataFrame:
    """For each chunk and shard the hashes of its windows that two or more documents hold, and the first and last of these. A shard is one group; shards are even, as hashes are."""

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [unrising(x) for x in pdf["prints"]]
        sizes = np.array([len(x) for x in own])
        docs, low, high = (np.concatenate([unsqueeze(x) for x in pdf[c]]) for c in ("docs", "low", "high"))
        chunk = np.repeat(pdf["chunk"].to_numpy(np.uint64), sizes)
        prints = np.concatenate(own)
        order = np.lexsort((chunk, prints))
        sorted_ = prints[order]
        first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        last = np.append(first[1:], len(sorted_)) - 1
        at = np.empty(len(prints), np.int64)
        at[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(sorted_)))
        shared = (np.add.reduceat(docs[order], first) > 1)[at]
        a, b = order[first][at], order[last][at]
        ends = np.cumsum(sizes)
        out = []
        for c, i, j in zip(pdf["chunk"], ends - sizes, ends):
            k = np.flatnonzero(shared[i:j]) + i
            if len(k):
                out.append((c, rising(prints[k]), *(squeeze(x) for x in (chunk[a[k]], low[a[k]], chunk[b[k]], high[b[k]]))))
        return pd.DataFrame(out, columns=[x.split(" ")[0] for x in _HELD.split(", ")]) if out else pd.DataFrame()

    return windows.select("chunk", "shard", "prints", "docs", "low", "high").groupBy("shard").applyInPandas(summed, _HELD)


_SUFFIX = "seed long, after binary, before binary, chunk long, nth long, pos long"
_MATCH = "chunk long, nth long, first long, last long, p_chunk long, p_nth long"


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Hashes of words, a row each, with 0 where there are no more."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
    out = np.zeros((len(rows), width), np.uint64)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(rows), ">u4")
    return out


def _spans(rows: pd.DataFrame, least: int, seed: int) -> pd.DataFrame:
    """The matches of sorted suffixes, whole seeds at a time: a row for each suffix that has one and each group it is in, or itself if it is the first of all."""
    n = len(rows)
    chunk, nth, pos, key = (rows[c].to_numpy(np.int64) for c in ("chunk", "nth", "pos", "seed"))
    size = np.fromiter(map(len, rows["before"]), np.int64, n) // 4
    before, after = (_matrix(rows[c], least - seed) for c in ("before", "after"))
    doc = mix(mix(chunk.view(np.uint64)) + nth.astype(np.uint64))
    common = np.zeros(n + 1, np.int64)  # with the suffix before, in words
    common[1:n] = np.where(key[1:] == key[:-1], _common(after[1:], after[:-1]) + seed, 0)
    left, right, own, first = np.zeros(n, np.int64), np.zeros(n, np.int64), [], []
    held = np.zeros(n, np.uint64)  # what stands before, so far
    for need in range(least - seed + 1):
        r = least - need
        if need:
            held = mix(held + before[:, need - 1])
        inside = (common[:n] >= r) | (common[1:] >= r)  # not alone in its interval
        at = np.flatnonzero(inside & (size >= need))
        if not len(at):
            continue
        interval = np.cumsum(common[:n] < r)[at]
        group = mix(mix(interval.astype(np.uint64)) + held[at])
        order = np.argsort(group, kind="stable")
        at, group = at[order], group[order]
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(start, append=len(at))
        two = np.repeat(np.minimum.reduceat(doc[at], start) != np.maximum.reduceat(doc[at], start), sizes)
        i, j = at[two], np.repeat(at[start], sizes)[two]
        left[i], right[i] = need, np.maximum(right[i], r)
        other = doc[i] != doc[j]
        own.append(i[other])
        first.append(j[other])
    matched = np.flatnonzero(right)
    if not len(matched):
        return pd.DataFrame(columns=[x.split(" ")[0] for x in _MATCH.split(", ")], dtype=np.int64)
    i, j = np.unique(np.stack([np.concatenate([matched, *own]), np.concatenate([matched, *first])]), axis=1)
    return pd.DataFrame({"chunk": chunk[i], "nth": nth[i], "first": pos[i] - left[i], "last": pos[i] + right[i], "p_chunk": chunk[j], "p_nth": nth[j]}).drop_duplicates()


def _neighbours(kept: DataFrame, least: int, seed: int) -> DataFrame:
    """The matches (_MATCH) of suffixes with their neighbours in the sorted shards of the suffix array."""
    own = [x.split(" ")[0] for x in _SUFFIX.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf])
            last = held["seed"].to_numpy() == held["seed"].iloc[-1]  # more of this seed may come
            if not last.all():
                yield _spans(held[~last], least, seed)
                held = held[last]
        if held is not None:
            yield _spans(held, least, seed)

    return kept.select(own).repartition("seed").sortWithinPartitions("seed", "after").mapInPandas(run, _MATCH)


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, seed: int = SEED, hot: int = HOT, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """id, n_words, n_repeated (words in spans), spans (array of first and last word, the last exclusive), class_id and class_size of each row."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    around = least - seed

    def about(table: pa.Table) -> dict[str, list]:
        held = [np.stack([owner[at[i]].astype(np.uint64), g[i]]) for _, owner, g, at, i in suffixes(bytes_of(table, text), least, seed)]
        return dict(zip(("prints", "counts"), seed_counts(held, shards, hot), strict=True))

    chunks = chunk_table(docs.select(*map(col, dict.fromkeys((id, text)))), text, about, SHARDED, chunk_bytes)
    answer = document_frequencies(chunks)

    both = f"{_SUFFIX}, {_WINDOWS}"
    names = [x.split(" ")[0] for x in both.split(", ")]
    ints = {c: "Int64" for c, t in (x.split(" ") for x in both.split(", ")) if t == "long"} | {c: object for c, t in (x.split(" ") for x in both.split(", ")) if t == "binary"}

    def shared(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = list(suffixes(bytes_of(unpack(left["docs"].iloc[0]), text), least, seed))
        prints = np.concatenate([np.zeros(0, np.uint64), *(g[i] for _, _, g, _, i in found)])
        df = frequencies_of(prints, right) if len(prints) else prints
        out, held, done = [], [], 0
        for h, owner, g, at, i in found:
            docs, times = df[done : done + len(i)] % SUFFIX, df[done : done + len(i)] // SUFFIX
            done += len(i)
            many = at[i[(docs > 1) & (times > hot)]]
            if len(many):  # the windows that hold one of these seeds
                edge = np.bincount(np.maximum(many - around, 0), minlength=len(h) + 1) - np.bincount(many + 1, minlength=len(h) + 1)
                hashes = windows_of(h, owner, least)
                k = np.flatnonzero((np.cumsum(edge)[: len(h)] > 0) & (hashes > 0))
                held.append((owner[k], hashes[k]))
            i = i[(docs > 1) & (times <= hot)]
            if not len(i):
                continue
            before, after = reach(g, owner[at], i, around)
            own = at[i]
            nth = owner[own]
            cut = lambda x, n: [r[:k].tobytes() for r, k in zip(x, n.tolist())]
            before, after = cut(_contexts(h, owner, own, -1, -1 - around), before), cut(_contexts(h, owner, own, seed, least), after)
            out.append(pd.DataFrame({"seed": g[i].view(np.int64), "after": after, "before": before, "chunk": left["chunk"].iloc[0], "nth": nth, "pos": own - np.searchsorted(owner, nth)}))
        if held:
            out.append(window_rows(left["chunk"].iloc[0], held, shards))
        give_back()
        return pd.concat([x.reindex(columns=names).astype(ints) for x in out]) if out else pd.DataFrame()

    kind = docs.schema[id].dataType.simpleString()

    def sizes(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Each row's words, and the spans and links that the counted windows give it."""
        chunk, table = left["chunk"].iloc[0], unpack(left["docs"].iloc[0])
        texts = bytes_of(table, text)
        n, exact, mates = np.zeros(len(texts), np.int64), [[] for _ in texts], [[] for _ in texts]
        known = np.concatenate([np.zeros(0, np.uint64), *map(unrising, right["prints"])])
        order = np.argsort(known)
        known = known[order]
        ends = [np.concatenate([np.zeros(0, np.uint64), *map(unsqueeze, right[c])])[order].astype(np.int64) for c in ("low_chunk", "low", "high_chunk", "high")]
        for a, b in pieces(texts):
            h, _, _, owner = words_of(texts[a:b])
            n[a:b] = np.bincount(owner, minlength=b - a)
            if not len(known) or not len(h):
                continue
            hashes = windows_of(h, owner, least)
            k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            i = np.flatnonzero((known[k] == hashes) & (hashes > 0))
            if not len(i):
                continue
            k, own = k[i], owner[i]
            new = np.append(True, (own[1:] != own[:-1]) | (i[1:] > i[:-1] + least))
            start, stop = i[new], np.append(i[np.flatnonzero(new)[1:] - 1], i[-1]) + least
            begin = np.searchsorted(owner, own[new])
            for t, x, y in zip(own[new].tolist(), (start - begin).tolist(), (stop - begin).tolist()):
                exact[a + t].append({"first": x, "last": y})
            low = (ends[0][k] != chunk) | (ends[1][k] != own + a)
            other = np.stack([own, np.where(low, ends[0][k], ends[2][k]), np.where(low, ends[1][k], ends[3][k])])
            for t, x, y in np.unique(other, axis=1).T.tolist():
                mates[a + t].append({"p_chunk": x, "p_nth": y})
        give_back()
        out = frame(table.select([id])).rename(columns={id: "id"})
        return out.assign(chunk=chunk, nth=np.arange(len(texts)), n_words=n, exact=pd.Series(exact, dtype=object), mates=pd.Series(mates, dtype=object))

    kept = written(chunks.select("chunk", "docs").groupBy("chunk").cogroup(answer.groupBy("_chunk")).applyInPandas(shared, both))
    answered = held_windows(kept.where("shard IS NOT NULL"))
    spans = written(_neighbours(kept.where("shard IS NULL"), least, seed))
    ids = written(chunks.select("chunk", "docs").groupBy("chunk").cogroup(answered.groupBy("_chunk")).applyInPandas(sizes, f"id {kind}, chunk long, nth long, n_words long, exact array<struct<first: long, last: long>>, mates array<struct<p_chunk: long, p_nth: long>>"))
    own, other = F.struct("chunk", "nth"), F.struct(F.col("p_chunk").alias("chunk"), F.col("p_nth").alias("nth"))
    links = spans.select("chunk", "nth", "p_chunk", "p_nth").union(ids.select("chunk", "nth", F.inline("mates"))).select(own.alias("a"), other.alias("b")).distinct()
    labels = components(links).select("node.chunk", "node.nth", "label")
    classes = ids.select("chunk", "nth", "id").join(labels, ["chunk", "nth"])
    best = written(classes.groupBy("label").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size")))
    classes = classes.select("chunk", "nth", "label").join(best, "label").drop("label")
    runs = Window.partitionBy("chunk", "nth").orderBy("first", "last")
    upto = F.max("last").over(runs.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.select("chunk", "nth", "first", "last").union(ids.select("chunk", "nth", F.inline("exact"))).distinct().withColumn("_upto", upto).withColumn("_run", F.sum((F.coalesce(F.col("first") > F.col("_upto"), F.lit(True))).cast("int")).over(runs))
    merged = islands.groupBy("chunk", "nth", "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    merged = merged.groupBy("chunk", "nth").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"), F.sum(F.col("last") - F.col("first")).alias("n_repeated"))
    out = ids.join(merged, ["chunk", "nth"], "left").join(classes, ["chunk", "nth"], "left")
    none, alone = F.array().cast(merged.schema["spans"].dataType), F.col("class_size").isNull()
    return out.select(F.col("id").alias(id), "n_words", F.coalesce("n_repeated", F.lit(0).cast("long")).alias("n_repeated"), F.coalesce("spans", none).alias("spans"), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.lit(1).cast("long")).otherwise(F.col("class_size")).alias("class_size"))
