"""Quality classifier (operator 1): an interpolated modified Kneser-Ney model of characters.

The model is trained on trusted text: the documents that `labels` calls good and not toxic. Each chunk of documents
lists its distinct n-grams with their trusted counts; the counts are summed by n-gram, the model's tables (counts,
continuation counts, context totals) are joined with the distinct n-grams of the corpus by shuffles, and each chunk gets
the log probabilities of its own n-grams back. A document whose perplexity is above the quantile of the trusted documents
of its language and length is rejected.

- All trusted documents take part, in the counts or in the quantiles, however many there are; their ids are broadcast up to
  `max_sent`, beyond that joined by a shuffle.
- A null or empty text has perplexity null and is accepted: nothing speaks against it. Labels of null ids, or with null
  quality, are not trusted. Rows that repeat an id are scored row by row; repeated labels count once. Very long texts are
  scored whole; a text of more than a chunk is a chunk of its own.
- One in HELD trusted documents, by a hash of its id, is left out of the counts; the quantiles are of these alone, as
  the model is kinder to what it has counted.
- Short texts spread more widely than long ones: a language (null is one of its own) has a quantile for each band of
  lengths, from each power of two to the next. From the longest down, bands are put together until they have LEAST
  documents; those left at the short end are together, too. How far it lies above the median is drawn to what all
  languages have above theirs, (n * own + LEAST * all) / (n + LEAST) with n documents of the language there: few lean on
  all, many stand for themselves. A language without any has the quantile of all. Without any measured document all documents are accepted, with threshold null.
- Ties with the threshold are accepted. An empty table gives no rows. Clashing columns of `labels` don't matter: only
  its id, quality and toxic columns are read. Columns of documents may have any names but those that begin with __rl_.
- Two noncharacters mark start and end of a text; in texts they count as U+FFFD, the replacement character. A chunk of
  more characters than a packed code can tell apart has its n-grams counted as strings.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.chunks import CHUNK_BYTES, chunk_table, forget, frame, give_back, made, take_rows, texts_of, unpack
from rosterloom.llm.common import col, written

ORDER = 4
TRUSTED, MEASURED = "__rl_trusted", "__rl_measured"
START, END = "\U0010fffe", "\U0010ffff"
#: So many ids of trusted documents may be broadcast.
MAX_SENT = 400_000
QUANTILE = 0.99
#: Trusted documents that a quantile is of, and the weight of all languages in that of one; one in HELD is kept for the quantiles.
LEAST, HELD = 100, 4
#: So many thresholds may be broadcast.
MAX_LIMITS = 100_000
#: Quantiles are of log perplexities in steps of this.
STEP = 1e-4
#: Bands of lengths: powers of two.
BANDS = 32


# n-grams of a chunk -------------------------------------------------------------------------------


def marked(table: pa.Table, text: str) -> list[str]:
    """The texts, without the marks."""
    return [t.replace(START, "\ufffd").replace(END, "\ufffd") for t in texts_of(table, text)]


def _codes(texts: list[str], n: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code for each n-gram of all texts, each text with n-1 starts before and an end behind; the first n-gram of each text."""
    whole = "".join(START * (n - 1) + t + END for t in texts)
    small = rank[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1  # n-grams of each
    first = np.cumsum(lengths + n - 1) - (lengths + n - 1)
    width = np.uint64(64 // n)
    codes = np.zeros(len(small) - n + 1, np.uint64)
    for i in range(n):
        codes = codes << width | small[i : len(small) - n + 1 + i]
    valid = np.ones(len(small), bool)
    for i in range(n - 1):
        valid[(first + lengths + i)[:-1]] = False
    return codes[valid[: len(codes)]], np.cumsum(lengths) - lengths


def _strings(text: str, n: int) -> list[str]:
    whole = START * (n - 1) + text + END
    return [whole[i : i + n] for i in range(len(text) + 1)]


def _pieces(texts: list[str], most: int = 1_000_000):
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def alphabet(texts: list[str]) -> np.ndarray:
    """The code points of the texts, and the two marks."""
    seen = np.zeros(0x110000, bool)
    seen[[ord(START), ord(END)]] = True
    for a, b in _pieces(texts):
        seen[np.frombuffer("".join(texts[a:b]).encode("utf-32-le", "surrogatepass"), np.uint32)] = True
    return np.flatnonzero(seen)


def _ranks(ids: np.ndarray) -> np.ndarray:
    rank = np.zeros(0x110000, np.uint64)
    rank[ids] = np.arange(len(ids), dtype=np.uint64)
    return rank


def _packs(ids: np.ndarray, n: int) -> bool:
    return len(ids) <= 1 << 64 // n


def distinct_grams(texts: list[str], trusted: list[bool], n: int) -> tuple[list[str], np.ndarray]:
    """The n-grams of all texts, in an order that the texts alone decide, and how often each is in trusted texts."""
    ids = alphabet(texts)
    if not _packs(ids, n):
        counts: dict[str, int] = {}
        for t, x in zip(texts, trusted, strict=True):
            for g in _strings(t, n):
                counts[g] = counts.get(g, 0) + bool(x)
        grams = sorted(counts)
        return grams, np.fromiter(map(counts.get, grams), np.int64, len(grams))
    found, rank = [], _ranks(ids)
    for want in (True, False):
        own = [t for t, x in zip(texts, trusted, strict=True) if bool(x) is want]
        for a, b in _pieces(own):
            codes, counts = np.unique(_codes(own[a:b], n, rank)[0], return_counts=True)
            found.append((codes, counts if want else np.zeros_like(counts)))
    codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    return gram_texts(codes, ids, n), np.bincount(at, np.concatenate([c for _, c in found])).astype(np.int64)


def gram_sums(texts: list[str], values: np.ndarray, n: int) -> np.ndarray:
    """The sum of the values of each text's n-grams; values are in the order of distinct_grams of these texts."""
    ids = alphabet(texts)
    if not _packs(ids, n):
        of = dict(zip(sorted({g for t in texts for g in _strings(t, n)}), values.tolist(), strict=True))
        return np.array([sum(of[g] for g in _strings(t, n)) for t in texts])
    rank, sums = _ranks(ids), np.zeros(len(texts))
    codes = np.unique(np.concatenate([np.unique(_codes(texts[a:b], n, rank)[0]) for a, b in _pieces(texts)]))
    for a, b in _pieces(texts):
        own, first = _codes(texts[a:b], n, rank)
        sums[a:b] = np.add.reduceat(values[np.searchsorted(codes, own)], first)
    return sums


def gram_texts(codes: np.ndarray, ids: np.ndarray, n: int) -> list[str]:
    width, mask = np.uint64(64 // n), np.uint64((1 << 64 // n) - 1)
    points = np.stack([ids[(codes >> np.uint64(int(width) * (n - 1 - i)) & mask).astype(np.int64)] for i in range(n)], axis=1)
    whole = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [whole[i : i + n] for i in range(0, len(whole), n)]


# the model ----------------------------------------------------------------------------------------


def _discounts(c: DataFrame) -> DataFrame:
    """One row: how many n-grams occur once, twice, three and four times, how many there are, and their sum."""
    n = [F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]
    more = [F.count_if(F.col("c") > 2).alias("more"), F.count("*").alias("types"), F.coalesce(F.sum("c"), F.lit(0)).alias("total")]
    return c.agg(*n, *more)


def modified_discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts; where the counts of counts don't give one, half of what it may be at most."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a and y else k / 2
        out.append(min(d, float(k)) if d > 0 else k / 2)  # none of 0, which would give unseen text no probability at all
    return out[0], out[1], out[2]


def log_probabilities(grams: DataFrame, trusted: DataFrame, n: int = ORDER) -> DataFrame:
    """(g, logp) of each n-gram of `grams` (g): of its last character after the others. trusted: (g, c)."""
    counts = {n: written(trusted)}
    for k in range(n - 1, 0, -1):  # continuation counts: how many characters stand before
        counts[k] = written(counts[k + 1].groupBy(F.substring("g", 2, k).alias("g")).agg(F.count("*").alias("c")))
    told = reduce(DataFrame.unionByName, (_discounts(counts[k]).withColumn("k", F.lit(k)) for k in counts)).collect()  # n rows
    told = {r["k"]: r for r in told}
    d = {k: modified_discounts(r["n1"], r["n2"], r["n3"], r["n4"]) for k, r in told.items()}
    cut = lambda k: F.when(F.col(f"c{k}") == 1, d[k][0]).when(F.col(f"c{k}") == 2, d[k][1]).otherwise(d[k][2])
    kept = lambda k: F.coalesce(F.greatest(F.col(f"c{k}") - cut(k), F.lit(0.0)), F.lit(0.0))
    out = grams.select("g").distinct()
    for k in range(n, 0, -1):
        own = F.substring("g", n - k + 1, k)
        out = out.withColumn("_s", own).join(counts[k].select(F.col("g").alias("_s"), F.col("c").alias(f"c{k}")), "_s", "left")
        if k > 1:
            ones = [F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.count_if(F.col("c") > 2)]
            context = counts[k].groupBy(F.substring("g", 1, k - 1).alias("_s")).agg(F.sum("c").alias(f"t{k}"), sum((F.lit(x) * y for x, y in zip(d[k], ones, strict=True)), F.lit(0.0)).alias(f"w{k}"))
            out = out.withColumn("_s", F.substring("g", n - k + 1, k - 1)).join(context, "_s", "left")
    r = told[1]
    if not r["total"]:
        return out.select("g", F.lit(None).cast("float").alias("logp"))
    spare = (d[1][0] * r["n1"] + d[1][1] * r["n2"] + d[1][2] * r["more"]) / r["total"] / (r["types"] + 1)  # one more for unknown characters
    p: Column = kept(1) / F.lit(float(r["total"])) + F.lit(spare)
    for k in range(2, n + 1):
        p = F.when(F.col(f"t{k}").isNull(), p).otherwise(kept(k) / F.col(f"t{k}") + F.col(f"w{k}") / F.col(f"t{k}") * p)
    return out.select("g", F.log(p).cast("float").alias("logp"))


# scoring ------------------------------------------------------------------------------------------


def trusted_ids(labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """The ids to train on (__rl_id)."""
    return labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & col(id).isNotNull()).select(col(id).alias("__rl_id")).distinct()


def held_out(good: DataFrame) -> DataFrame:
    """__rl_id, __rl_counted and __rl_held of each trusted id: whether it is for the counts, or for the quantiles."""
    held = F.pmod(F.xxhash64(F.lit("held"), "__rl_id"), F.lit(HELD)) == 0
    return good.select("__rl_id", (~held).alias("__rl_counted"), held.alias("__rl_held"))


def scored_chunks(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", n: int = ORDER, max_sent: int = MAX_SENT, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The chunk table of docs, and for each row of each chunk (chunk, nth) its id, language, whether it is trusted and one of those for the quantiles, its band of lengths, and log perplexity."""
    good = held_out(trusted_ids(labels, id))
    good = F.broadcast(good) if good.limit(max_sent + 1).count() <= max_sent else good
    split = docs.join(good, col(id) == F.col("__rl_id"), "left").withColumn(TRUSTED, F.coalesce("__rl_counted", F.lit(False))).withColumn(MEASURED, F.coalesce("__rl_held", F.lit(False))).drop("__rl_id", "__rl_counted", "__rl_held")

    def about(table: pa.Table) -> dict[str, list]:
        grams, counts = distinct_grams(marked(table, text), table[TRUSTED].to_pylist(), n)
        return {"grams": grams, "counts": counts.tolist()}

    chunks = chunk_table(split, text, about, "grams array<string>, counts array<long>", chunk_bytes)
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("grams", "counts")).alias("at", "x")).select("chunk", "at", F.col("x.grams").alias("g"), F.col("x.counts").alias("c"))
    summed = written(each.groupBy("g").agg(F.sum("c").alias("c")))
    known = log_probabilities(summed.select("g"), summed.where("c > 0"), n)
    answer = each.select("chunk", "at", "g").join(known, "g").groupBy("chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "logp"))), lambda x: x["logp"]).alias("logp"))
    kind = docs.schema[id].dataType.simpleString()

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for chunk, data in zip(left["chunk"], left["docs"], strict=True):
            table = unpack(data)
            texts = marked(table, text)
            sums = gram_sums(texts, np.asarray(right["logp"].iloc[0], np.float64), n)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            value = np.where(lengths > 0, -sums / (lengths + 1), np.nan)
            out.append(pd.DataFrame({"chunk": chunk, "nth": np.arange(len(texts)), "id": frame(table.select([id]))[id], "lang": table[lang].to_pandas(), "trusted": table[TRUSTED].to_pandas() | table[MEASURED].to_pandas(), "measured": table[MEASURED].to_pandas(), "band": np.log2(np.maximum(lengths, 1)).astype(np.int64), "value": value}))
        give_back()
        return pd.concat(out) if out else pd.DataFrame()

    scores = chunks.select("chunk", "docs").groupBy("chunk").cogroup(answer.withColumnRenamed("chunk", "_chunk").groupBy("_chunk")).applyInPandas(score, f"chunk long, nth long, id {kind}, lang string, trusted boolean, measured boolean, band long, value double")
    return chunks, written(scores.withColumn("value", F.when(~F.isnan("value"), F.col("value"))))


def banded(rows: pd.DataFrame, least: int) -> list[tuple[range, pd.DataFrame]]:
    """Bands of lengths and their rows of (band, step, c), by step: from the longest down, bands are put together until they have `least`; those left are together, too."""
    groups, own, n = [], [], 0
    for band, c in rows.groupby("band")["c"].sum().sort_index(ascending=False).items():
        own.append(band)
        n += c
        if n >= least:
            groups.append(own)
            own, n = [], 0
    groups += [own] if own else []
    out, top = [], BANDS
    for i, group in enumerate(groups):
        low = 0 if i == len(groups) - 1 else group[-1]
        out.append((range(low, top), rows[rows["band"].isin(group)].sort_values("step")))
        top = low
    return out


def _quantile(rows: pd.DataFrame, q: float) -> int:
    upto = rows["c"].cumsum().to_numpy()
    return int(rows["step"].iloc[np.searchsorted(upto, upto[-1] * q)])


def thresholds(scores: DataFrame, quantile: float = QUANTILE, least: int = LEAST) -> DataFrame:
    """(lang, band, threshold): the quantile of the measured values of a language at a length, by counting steps, drawn to what all languages have. Without a column `measured` all trusted values count, without `band` all lengths are one."""
    band = F.col("band") if "band" in scores.columns else F.lit(0).cast("long")
    own = F.col("measured") if "measured" in scores.columns else F.col("trusted")
    scores = scores.select("lang", band.alias("band"), own.alias("_own"), "value")
    # as many rows as steps: some ten thousand at most for a band, however many documents there are
    steps = written(scores.where(F.col("_own") & F.col("value").isNotNull()).groupBy("lang", "band", F.ceil(F.col("value") / STEP).alias("step")).agg(F.count("*").alias("c")))

    def of_lang(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [(band, m := _quantile(x, 0.5), _quantile(x, quantile) - m, int(x["c"].sum())) for bands, x in banded(pdf, least) for band in bands]
        return pd.DataFrame(found, columns=["_band", "middle", "above", "n"]).assign(_own=pd.Series([pdf["lang"].iloc[0]] * len(found), dtype=object))

    def centred(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([x.assign(step=x["step"] - _quantile(x, 0.5))[["band", "step", "c"]] for _, x in banded(pdf, least)])

    def of_all(pdf: pd.DataFrame, q: float, name: str) -> pd.DataFrame:
        return pd.DataFrame([(band, _quantile(x, q)) for bands, x in banded(pdf, least) for band in bands], columns=["_at", name])

    pooled = lambda x: x.groupBy("band", "step").agg(F.sum("c").alias("c")).withColumn("_", F.lit(0)).groupBy("_")  # noqa: E731  as many rows as steps
    by_lang = steps.groupBy("lang").applyInPandas(of_lang, "_own string, _band long, middle long, above long, n long")
    spread = pooled(steps.groupBy("lang").applyInPandas(centred, "band long, step long, c long")).applyInPandas(lambda pdf: of_all(pdf, quantile, "spread"), "_at long, spread long")
    whole = pooled(steps).applyInPandas(lambda pdf: of_all(pdf, quantile, "whole"), "_at long, whole long")
    out = scores.select("lang", "band").distinct().join(by_lang, F.col("lang").eqNullSafe(F.col("_own")) & (F.col("band") == F.col("_band")), "left")
    out = out.join(F.broadcast(spread.join(whole, "_at")), F.col("band") == F.col("_at"), "left")
    both = F.col("middle") + (F.col("n") * F.col("above") + least * F.col("spread")) / (F.col("n") + least)
    return out.select("lang", "band", (F.coalesce(both, F.col("whole")) * STEP).alias("threshold"))


def verdicts(scores: DataFrame, quantile: float = QUANTILE, least: int = LEAST) -> DataFrame:
    """scores with threshold and accepted."""
    limits = written(thresholds(scores, quantile, least).withColumnsRenamed({"lang": "_lang", "band": "_band"}))
    # a third of all rows may have one language: they stay where they are, unless there are more limits than can be sent to all
    sent = F.broadcast(limits) if limits.limit(MAX_LIMITS + 1).count() <= MAX_LIMITS else limits
    out = scores.join(sent, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("band") == F.col("_band")), "left").drop("_lang", "_band")
    return out.withColumn("accepted", F.coalesce(F.col("value") <= F.col("threshold"), F.lit(True)))


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", n: int = ORDER, quantile: float = QUANTILE, max_sent: int = MAX_SENT) -> DataFrame:
    """id, lang, trusted, perplexity (of a character), threshold and accepted of each row of docs."""
    since = made()
    _, scores = scored_chunks(docs.select(*map(col, dict.fromkeys((id, text, lang)))), labels, id, text, lang, n, max_sent)
    forget(docs.sparkSession, since)  # the scores are written
    out = verdicts(scores, quantile)
    return out.select(F.col("id").alias(id), F.col("lang").alias(lang), "trusted", F.exp("value").alias("perplexity"), F.exp("threshold").alias("threshold"), "accepted")


def accepted(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", n: int = ORDER, quantile: float = QUANTILE, max_sent: int = MAX_SENT) -> DataFrame:
    """The rows of docs that are accepted, with all their columns."""
    chunks, scores = scored_chunks(docs, labels, id, text, lang, n, max_sent)
    return take_rows(chunks, verdicts(scores, quantile).where("accepted"), docs)
