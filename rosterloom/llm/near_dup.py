"""MinHash near-dedup (operator 3): improved consistent weighted sampling over TF-IDF shingles.

1. Documents are written in chunks (see chunks), each with the sorted fingerprints of its five-word shingles and how
   many of its documents hold each. Shards of the fingerprint space sum these and give each chunk back the document
   frequencies of its own shingles.
2. A shingle weighs tf * idf. Each document is sampled `bands * rows` times by improved consistent weighted sampling
   (Ioffe, 2010); a band of samples is a bucket. Documents that share less than the threshold of their weight with any
   others can have no partner, which is exact, and aren't sampled.
3. Different contents that share a bucket are verified: linked at a weighted Jaccard similarity of `similarity` or more.
   Every content of a bucket is compared with LEADERS of its members; then those of the rest whose components still
   differ are compared with one another, tile by tile. Components of the verified links are the classes.

- Words are runs of digits, letters (A-Z as a-z) and all characters outside ASCII. A document of one to four words has
  one shingle; those without words (null, empty, signs only) are copies where their texts are equal, a null being empty.
- Equal multisets of shingles are one content: copies cost nothing after step 2 and are never paired with each other.
- Rows may repeat and ids be null or repeated: rows are told apart by their place in the chunk table. The class id is
  the least id of the class, null if it has none. An empty table gives no rows. Texts are whole. Columns may have any
  name: `keep_one` gives them back as they were.
- idf is 1 + IDF * ln((N + 1) / (df + 1)) / ln(N + 1): a rare edit weighs a little more than text that many share, so
  that near copies in a large group are as near as elsewhere.
- Fingerprints have 17 bits more than the logarithm of the number of words (64 at most), so that fewer than one in
  100,000 shingles has its frequency confused with another's.
- No bucket is cut. A bucket of m contents costs LEADERS * m comparisons, and of those that its leaders don't link
  one with each other member: tight groups of any size cost their size; only many unlike contents in one bucket cost
  its square, in comparisons, and square / `tile` in rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.chunks import CHUNK_BYTES, SHARDED, bytes_of, chunk_table, document_frequencies, frame, frequencies_of, give_back, rising, sharded, take_rows, unpack, unrising
from rosterloom.llm.common import chunks as pieces
from rosterloom.llm.common import grams_of, mix, text_of, words_of, written
from rosterloom.llm.graph import components

SHINGLE, SIMILARITY, BANDS, ROWS, TILE = 5, 0.8, 16, 3, 256
LEADERS, IDF = 3, 0.25


# shingles -----------------------------------------------------------------------------------------


def shingles(texts: list[bytes], bits: int, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text and distinct shingle, in order: the text, the fingerprint, how often; and the number of words of each text."""
    docs, prints, times, sizes = [], [], [], np.zeros(len(texts), np.int64)
    for a, b in pieces(texts):
        h, _, _, owner = words_of(texts[a:b])
        n_words = np.bincount(owner, minlength=b - a)
        sizes[a:b] = n_words
        g, at = grams_of(h, owner, n)
        own = owner[at]
        short = np.flatnonzero((n_words > 0) & (n_words < n))
        if len(short):  # one shingle of all words
            start = np.cumsum(n_words) - n_words
            whole = np.zeros(len(short), np.uint64)
            for i in range(n - 1):
                more = n_words[short] > i
                whole[more] = mix(whole[more] * np.uint64(0x9E3779B97F4A7C15) + h[start[short[more]] + i])
            g, own = np.concatenate([g, mix(whole + np.uint64(1))]), np.concatenate([own, short])
        g >>= np.uint64(64 - bits)
        order = np.lexsort((g, own))
        g, own = g[order], own[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
        first = np.flatnonzero(new)
        docs.append(own[first] + a)
        prints.append(g[first])
        times.append(np.diff(first, append=len(g)))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), sizes
    return np.concatenate(docs), np.concatenate(prints), np.concatenate(times), sizes


# sampling -----------------------------------------------------------------------------------------


def _gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """The quantiles of Gamma(2, 1), whose distribution is 1 - (1 + x) exp(-x), by bisection."""
    p, low, high = (np.arange(n) + 0.5) / n, np.zeros(n), np.full(n, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < p
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return low.astype(np.float32)


_GAMMA = _gamma_quantiles()
_LN_GAMMA = np.log(_GAMMA)


def samples(prints: np.ndarray, weights: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """`count` consistent weighted samples of each document: (shingle, level) as one number.

    Documents follow one another and start at `first`; none is empty. Two documents have the same sample with the
    probability of their weighted Jaccard similarity.
    """
    ln_w = np.log(weights).astype(np.float32)
    sizes = np.diff(first, append=len(prints))
    out = np.empty((len(first), count), np.uint64)
    for k in range(count):
        z = mix(prints ^ mix(np.full(1, k + 1, np.uint64))[0])
        r = _GAMMA[(z >> np.uint64(48)).astype(np.int64)]
        ln_c = _LN_GAMMA[(z >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.int64)]
        beta = (z >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.float32) / np.float32(65536)
        level = np.floor(ln_w / r + beta)
        ln_a = ln_c - r * (level - beta) - r
        least = np.minimum.reduceat(ln_a, first)
        at = np.flatnonzero(ln_a == np.repeat(least, sizes))
        at = at[np.searchsorted(at, first)]  # the first of equals
        out[:, k] = mix(z[at] + level[at].astype(np.int64).astype(np.uint64))
    return out


def band_hashes(sampled: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(sampled), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sampled), b + 1, np.uint64)
        for i in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sampled[:, b * rows + i])
        out[:, b] = h
    return out


# verification -------------------------------------------------------------------------------------


Content = tuple[bytes, np.ndarray, np.ndarray, float]  # content, sorted fingerprints, weights, their sum


def linked(a: Content, b: Content, least: float) -> bool:
    """Whether the weighted Jaccard similarity of two contents is `least` or more."""
    if min(a[3], b[3]) < (least - 1e-4) * max(a[3], b[3]):  # then it can't be
        return False
    at = np.searchsorted(b[1], a[1])
    at[at == len(b[1])] = 0
    same = b[1][at] == a[1]
    both = float(np.minimum(a[2][same], b[2][at[same]]).sum())
    return both / (a[3] + b[3] - both) >= least


def _content(row) -> Content:
    weights = np.frombuffer(row.weights, np.float32)
    return row.content, unrising(row.prints), weights, float(weights.sum())


class _Joined:
    """Which contents are connected, by the labels that they came with and the links found since."""

    def __init__(self) -> None:
        self.root: dict = {}

    def find(self, x):
        while (up := self.root.get(x, x)) != x:
            self.root[x] = x = self.root.get(up, up)
        return x

    def join(self, x, y) -> None:
        self.root[self.find(x)] = self.find(y)


# the operator -------------------------------------------------------------------------------------


def _signed(docs: DataFrame, id: str, text: str, bands: int, rows: int, least: float, chunk_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The chunk table, and for each row of each chunk: id, content, and for the first row of a content in a chunk that may have partners its bands and weights."""
    spark = docs.sparkSession
    total, n_docs = docs.agg(F.coalesce(F.sum(F.octet_length(text_of(text))), F.lit(0)), F.count("*")).first()
    bits = min(64, 17 + round(math.log2(total / 6 + 2)))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def about(table: pa.Table) -> dict[str, list]:
        _, prints, _, _ = shingles(bytes_of(table, text), bits)
        return dict(zip(("prints", "counts"), sharded(prints, bits, shards), strict=True))

    chunks = chunk_table(docs, text, about, SHARDED, chunk_bytes)
    answer = document_frequencies(chunks)
    kind = docs.schema[id].dataType.simpleString()

    def sign(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        table = unpack(left["docs"].iloc[0])
        texts = bytes_of(table, text)
        doc, prints, times, n_words = shingles(texts, bits)
        df = frequencies_of(prints, right).astype(np.float64)
        weights = (times * (1 + IDF * np.log((n_docs + 1) / (df + 1)) / math.log(n_docs + 1))).astype(np.float32)
        n = table.num_rows
        held = np.bincount(doc, minlength=n)
        weight, shared_weight = np.bincount(doc, weights, minlength=n), np.bincount(doc, weights * (df > 1), minlength=n)
        # a rounded sum may be a hair too small
        may = (held > 0) & (shared_weight >= (least - 1e-4) * weight)
        starts = np.cumsum(held) - held
        content = [b"" if k else hashlib.md5(t).digest() for k, t in zip(held.tolist(), texts, strict=True)]
        two = [mix(prints * np.uint64(a) + mix(times.astype(np.uint64) + np.uint64(b))) for a, b in ((0x9E3779B97F4A7C15, 1), (0xD1B54A32D192ED03, 2))]
        some = np.flatnonzero(held)
        if len(some):
            sums = [np.add.reduceat(x, starts[some]) for x in two]
            for i, x, y in zip(some.tolist(), *(s.tolist() for s in sums), strict=True):
                content[i] = x.to_bytes(8, "big") + y.to_bytes(8, "big")
        seen: set = set()
        chosen = [i for i in np.flatnonzero(may).tolist() if not (content[i] in seen or seen.add(content[i]))]
        own_bands, own_prints, own_weights = [None] * n, [None] * n, [None] * n
        for a in range(0, len(chosen), 200):
            some = np.array(chosen[a : a + 200])
            at = np.concatenate([np.arange(starts[i], starts[i] + held[i]) for i in some])
            first = np.cumsum(held[some]) - held[some]
            hashed = band_hashes(samples(prints[at], weights[at], first, bands * rows), bands, rows).view(np.int64)
            for k, i in enumerate(some.tolist()):
                own_bands[i], own_prints[i], own_weights[i] = hashed[k], rising(prints[starts[i] : starts[i] + held[i]]), weights[starts[i] : starts[i] + held[i]].tobytes()
        out = frame(table.select([id])).rename(columns={id: "id"})
        give_back()
        return out.assign(chunk=left["chunk"].iloc[0], nth=np.arange(n), content=content, n_words=n_words, bands=own_bands, prints=own_prints, weights=own_weights)

    signed = chunks.select("chunk", "docs").groupBy("chunk").cogroup(answer.groupBy("_chunk")).applyInPandas(sign, f"chunk long, nth long, id {kind}, content binary, n_words long, bands array<long>, prints binary, weights binary")
    return chunks, written(signed)


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The links (a, b) among pairs (lead, content, part): a lead's set comes first in its part, its partners' sets stream past it."""
    parts = pairs.select("lead", "part").distinct()
    leads = parts.join(sets, F.col("lead") == F.col("content")).select("lead", "part", F.lit(0).alias("nth"), "content", "prints", "weights")
    rest = pairs.join(sets, "content").select("lead", "part", F.lit(1).alias("nth"), "content", "prints", "weights")
    dealt = leads.unionByName(rest).repartition("lead", "part").sortWithinPartitions("lead", "part", "nth")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = None
        for pdf in batches:
            found = []
            for row in pdf.itertuples(index=False):
                own = _content(row)
                if row.nth == 0:
                    lead = own
                elif linked(lead, own, least):
                    found.append((lead[0], own[0]))
            yield pd.DataFrame(found, columns=["a", "b"])

    return dealt.mapInPandas(run, "a binary, b binary")


def _rest(held: DataFrame, labels: DataFrame, sets: DataFrame, least: float, tile: int) -> DataFrame:
    """The links (a, b) among the members of buckets (bucket, content) that leaders haven't settled: those of different components.

    Members are hosts in a tile of their bucket. Those outside the bucket's largest component visit all its tiles; two
    visitors meet in the tile of the one whose content is larger.
    """
    named = held.join(labels, "content", "left").select("bucket", "content", F.coalesce("label", "content").alias("label"))
    named = written(named)
    sizes = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    open_ = written(sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("most")).where("labels > 1").select("bucket", "most", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    members = named.join(open_, "bucket").withColumn("guest", F.col("label") != F.col("most"))
    hosts = members.select("bucket", F.pmod(F.xxhash64("content"), "tiles").cast("int").alias("i"), F.lit(0).alias("nth"), "content", "label", "guest")
    guests = members.where("guest").select("bucket", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i"), F.lit(1).alias("nth"), "content", "label", "guest")
    dealt = hosts.unionByName(guests).join(sets, "content").repartition("bucket", "i").sortWithinPartitions("bucket", "i", "nth")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, hosts, known = None, [], _Joined()
        for pdf in batches:
            found = []
            for row in pdf.itertuples(index=False):
                if (row.bucket, row.i) != here:
                    here, hosts, known = (row.bucket, row.i), [], _Joined()
                own = _content(row)
                if row.nth == 0:
                    hosts.append((own, row.label, row.guest))
                    continue
                for other, label, guest in hosts:
                    if guest and other[0] <= own[0] or known.find(row.label) == known.find(label):
                        continue
                    if linked(own, other, least):
                        known.join(row.label, label)
                        found.append((own[0], other[0]))
            yield pd.DataFrame(found, columns=["a", "b"])

    return dealt.mapInPandas(run, "a binary, b binary")


def _classes(signed: DataFrame, least: float, tile: int, leaders: int = LEADERS) -> DataFrame:
    """(content, label) of the contents that are linked with another."""
    may = signed.where(F.col("bands").isNotNull())
    buckets = written(may.select("content", F.explode("bands").alias("bucket")).distinct())
    # different orders of the members give different first ones
    first = lambda k: F.min(F.struct(F.xxhash64(F.lit(k), F.col("content")).alias("h"), F.col("content").alias("c")))["c"]
    led = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.array_distinct(F.array(*map(first, range(leaders)))).alias("leads")).where("n > 1")
    members = written(buckets.join(written(led), "bucket"))
    pairs = members.select("content", F.explode("leads").alias("lead"), "n").where("lead <> content").groupBy("lead", "content").agg(F.max("n").alias("n"))
    # a lead of many is in several parts
    pairs = written(pairs.select("lead", "content", F.pmod(F.xxhash64("content"), F.ceil(F.col("n") / (16 * tile))).alias("part")))
    sets = may.select("content", "prints", "weights").dropDuplicates(["content"])
    links = written(_verified(pairs, sets, least))
    labels = components(links)
    held = members.where((F.col("n") > 2) & ~F.array_contains("leads", F.col("content"))).select("bucket", "content")
    more = written(_rest(held, labels.withColumnRenamed("node", "content"), sets, least, tile))
    if more.limit(1).count():
        labels = components(links.unionByName(more))
    return labels.withColumnRenamed("node", "content")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, tile: int = TILE, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The chunk table of docs, and for each row (chunk, nth): id, n_words, class_id, class_size, and whether it is the one of its class that stays.

    The row with the least id stays (nulls last), the first of rows that repeat it.
    """
    chunks, signed = _signed(docs, id, text, bands, rows, similarity, chunk_bytes)
    labels = _classes(signed, similarity, tile)
    rows_ = signed.select("chunk", "nth", "id", "content", "n_words").join(labels, "content", "left").withColumn("label", F.coalesce("label", "content"))
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("chunk"), F.col("nth"))
    best = rows_.where(F.col("label").isNotNull()).groupBy("label").agg(F.min(rank).alias("best"), F.count("*").alias("class_size"))
    out = rows_.join(best, "label", "left")
    alone = F.col("best").isNull()
    stays = alone | ((F.col("chunk") == F.col("best.chunk")) & (F.col("nth") == F.col("best.nth")))
    return chunks, out.select("chunk", "nth", F.col("id"), "n_words", F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), stays.alias("stays"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """docs with one row of each class, and all its columns."""
    chunks, rows = near_duplicates(docs, id, text, **how)
    return take_rows(chunks, rows.where("stays"), docs)
