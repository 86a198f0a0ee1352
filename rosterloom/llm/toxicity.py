"""Toxicity by nearest labelled examples (operator 11): exact TF-IDF cosine over a block-max inverted index.

A text's terms are its words (letters, A-Z lower-cased) and the words' beginnings of 4 to 7 letters. The terms that count
are those that labelled toxic examples hold far more often than chance has it; everything else in a text is one more
coordinate of a fixed weight, so a text of a single such term lies apart from one that is full of them. Examples of equal
vectors are one entry of the index with a count. The nearest entries vote by the inverse of their distance; votes become
probabilities by isotonic regression over the examples' own votes, each made without itself.

The index is in blocks of like entries. For each term it holds the blocks with the greatest weight in each, so a block's best
cosine is bounded by a sum over the query's terms; blocks are read in order of that bound until none can still hold one of
the nearest. The cosines of what is read are exact, and so are the nearest, ties included.

- Labels are learned from rows whose crc32 of the id as text, modulo 3, isn't 1 (`held_out` marks those where it is), from at
  most MAX_EXAMPLES of them, chosen by a hash of the id; terms, at most TERMS. These bounds are of the fit alone: every text is
  scored, whole, against the whole index.
- Labels, ids and other columns are no input of a score: equal texts have equal scores. A null text is empty; it is near the
  examples without such terms. A null id is '' as text (not held out) and takes no label.
- Ids that repeat: each row is scored; as an example an id counts once, with its least text, toxic if any label says so.
- Without examples (no labels, or an empty table of them) scores are 0. An empty table of documents gives no rows.
- Examples, terms and vectors are bounded, so the driver holds them; documents are scored in one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.common import col, text_of, written
from rosterloom.llm.divergence import terms_of

MAX_EXAMPLES = 20_000
TERMS = 1000
#: Letters of the beginnings that are terms, and of the longest word that is one whole.
BEGINNINGS, LONGEST = (4, 5, 6, 7), 40
#: A term counts if it is in so many toxic examples, and so far from chance (chi-square of the toxic cell).
LEAST_TOXIC, LEAST_CHI = 3, 25.0
#: Neighbours (examples, with their counts), entries of a block, the weight of all that is no such term, and what is added to a distance.
NEAREST, BLOCK, REST, NEAR_ZERO = 15, 32, 1.0, 0.05
THRESHOLD = 0.7
#: Results that a task remembers, by the terms of a text.
REMEMBERED = 50_000
SHOWN = 3


def held_out(id: Column) -> Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def word_terms(word: str) -> list[str]:
    whole = [word] if len(word) <= LONGEST else []
    return whole + [f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n]


class Terms:
    """Counts the terms that count in texts; what a word gives is remembered."""

    def __init__(self, terms: list[str]) -> None:
        self.number = {t: i + 1 for i, t in enumerate(terms)}  # 0 is the rest
        self.known: dict[bytes, tuple[int, ...]] = {}

    def of(self, text: str) -> tuple[tuple[int, int], ...]:
        found: Counter = Counter()
        known = self.known
        for word, n in Counter(terms_of(text)).items():
            at = known.get(word)
            if at is None:
                if len(known) >= 1_000_000:
                    known.clear()
                at = known[word] = tuple(self.number[t] for t in word_terms(word.decode()) if t in self.number)
            for t in at:
                found[t] += n
        return tuple(sorted(found.items()))


@dataclass
class Entry:
    vector: tuple[tuple[int, int], ...]
    count: int
    toxic: int
    id: str


class Index:
    """Entries in blocks, with the greatest weight of each term in each block."""

    def __init__(self, entries: list[Entry], idf: np.ndarray, block: int = BLOCK) -> None:
        # like entries together: by the term of most weight, then by how many of them are toxic
        heavy = lambda e: max(((1 + np.log(n)) * idf[t], t) for t, n in e.vector)[1] if e.vector else 0
        self.entries = sorted(entries, key=lambda e: (heavy(e), e.toxic / e.count, e.vector))
        self.idf, self.block = idf, block
        rows, terms, weights = [], [], []
        for i, e in enumerate(self.entries):
            v = self.weights(e.vector)
            rows += [i] * len(v[0])
            terms += v[0].tolist()
            weights += v[1].tolist()
        self.rows, self.terms, self.of = np.array(rows, np.int64), np.array(terms, np.int64), np.array(weights)
        self.count = np.array([e.count for e in self.entries], np.int64)
        self.toxic = np.array([e.toxic for e in self.entries], np.int64)
        self.blocks = -(-len(self.entries) // block)
        self.starts = np.searchsorted(self.rows, np.arange(self.blocks + 1) * block)
        order = np.lexsort((self.rows // block, self.terms))
        t, b, w = self.terms[order], (self.rows // block)[order], self.of[order]
        first = np.flatnonzero(np.r_[True, (np.diff(t) != 0) | (np.diff(b) != 0)]) if len(t) else np.zeros(0, np.int64)
        self.max_block, self.max_weight = b[first], np.maximum.reduceat(w, first) if len(t) else w
        self.max_from = np.searchsorted(t[first], np.arange(len(idf) + 1))

    def weights(self, vector: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and TF-IDF weights of length one together."""
        t = np.array([0, *(t for t, _ in vector)], np.int64)
        w = np.array([REST, *((1 + np.log(n)) * self.idf[t] for t, n in vector)])
        return t, w / np.sqrt((w * w).sum())

    def nearest(self, vector: tuple[tuple[int, int], ...], count: np.ndarray | None = None, least: int = NEAREST) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entries that hold `least` examples (by `count`) together, all of equal cosine, and their cosines; by cosine, then in the index's order."""
        count = self.count if count is None else count
        terms, weights = self.weights(vector)
        bound = np.zeros(self.blocks)
        for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
            a, b = self.max_from[t], self.max_from[t + 1]
            bound[self.max_block[a:b]] += w * self.max_weight[a:b]
        query = np.zeros(len(self.idf))
        query[terms] = weights
        at, cosine, low = np.zeros(0, np.int64), np.zeros(0), -1.0
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] < low - 1e-9:
                break
            a, z = self.starts[b], self.starts[b + 1]
            first, n = b * self.block, min(self.block, len(self.entries) - b * self.block)
            own = np.round(np.bincount(self.rows[a:z] - first, self.of[a:z] * query[self.terms[a:z]], n), 12)
            there = np.flatnonzero((own >= low) & (count[first : first + n] > 0))
            at, cosine = np.r_[at, there + first], np.r_[cosine, own[there]]
            order = np.lexsort((at, -cosine))
            at, cosine = at[order], cosine[order]
            enough = np.searchsorted(np.cumsum(count[at]), least)
            if enough < len(at):
                low = cosine[enough]
                keep = cosine >= low
                at, cosine = at[keep], cosine[keep]
        return at, cosine


class Model:
    """Terms, index and calibration."""

    def __init__(self, terms: list[str], frequencies: list[int], entries: list[Entry]) -> None:
        n = sum(e.count for e in entries)
        self.terms = terms
        self.prior = sum(e.toxic for e in entries) / n if n else 0.0
        self.index = Index(entries, np.r_[0.0, np.log((n + 1) / (np.array(frequencies, float) + 1)) + 1])
        self.x, self.y = np.zeros(1), np.zeros(1)
        if n:
            self.x, self.y = isotonic(*self._own_votes(), self.prior)

    def _vote(self, at: np.ndarray, cosine: np.ndarray, count: np.ndarray, toxic: np.ndarray) -> float:
        w = 1 / (1 - np.minimum(cosine, 1.0) + NEAR_ZERO)
        return float(((w * toxic[at]).sum() + self.prior) / ((w * count[at]).sum() + 1))

    def _own_votes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vote on each example by the others, whether it is toxic, and how many examples are alike."""
        votes, truth, alike = [], [], []
        count, toxic = self.index.count.copy(), self.index.toxic.copy()
        for i, e in enumerate(self.index.entries):
            for y, n in ((1, e.toxic), (0, e.count - e.toxic)):
                if n:
                    count[i], toxic[i] = e.count - 1, e.toxic - y
                    votes.append(self._vote(*self.index.nearest(e.vector, count), count, toxic))
                    truth.append(y)
                    alike.append(n)
            count[i], toxic[i] = e.count, e.toxic
        return np.array(votes), np.array(truth, float), np.array(alike, float)

    def score(self, vector: tuple[tuple[int, int], ...]) -> tuple[float, np.ndarray, np.ndarray]:
        if not self.index.entries:
            return 0.0, np.zeros(0, np.int64), np.zeros(0)
        at, cosine = self.index.nearest(vector)
        return float(np.interp(self._vote(at, cosine, self.index.count, self.index.toxic), self.x, self.y)), at, cosine


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps of the share of y along x (pooled neighbours), each with one more example of the prior share, at the steps' middles."""
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []  # x * weight, y * weight, weight
    for xi, yi, w in zip(x[order], y[order], weight[order], strict=True):
        steps.append([xi * w, yi * w, w])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last, strict=True)]
    s = np.array(steps)
    return s[:, 0] / s[:, 2], np.maximum.accumulate((s[:, 1] + prior) / (s[:, 2] + 1))


def examples_of(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", most: int = MAX_EXAMPLES) -> DataFrame:
    """(id string, text, toxic) of the labelled rows to learn from, written to the shared folder; the ids that meet the documents are `most` at most."""
    own = labels.where(~held_out(col(id)) & col(id).isNotNull() & col(toxic).isNotNull()).groupBy(col(id).cast("string").alias("_id")).agg(F.max(col(toxic).cast("int")).alias("_toxic"))
    chosen = own.orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = documents.select(col(id).cast("string").alias("id"), text_of(text).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("_id"))
    return written(rows.groupBy("id").agg(F.min("text").alias("text"), F.max("_toxic").alias("toxic")))


def chosen_terms(examples: DataFrame, most: int = TERMS) -> tuple[list[str], list[int]]:
    """The terms that count, by how far from chance, and how many examples hold each."""
    n = examples.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                held[y].update({t for w in set(terms_of(text)) for t in word_terms(w.decode())})
        names = list(held[0].keys() | held[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([held[y][t] for t in names], pa.int64()) for y in (1, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "a", "b"])

    x = examples.mapInArrow(run, "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    expected = (F.col("a") + F.col("b")) * F.lit(float(n[1])) / F.lit(float(max(1, n[0])))
    far = x.withColumn("chi", F.when(F.col("a") > expected, F.pow(F.col("a") - expected, F.lit(2)) / expected))
    rows = far.where((F.col("a") >= LEAST_TOXIC) & (F.col("chi") >= LEAST_CHI)).orderBy(F.desc("chi"), "term").limit(most).collect()
    return [r["term"] for r in rows], [r["a"] + r["b"] for r in rows]


def fit(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", most: int = MAX_EXAMPLES) -> Model:
    examples = examples_of(documents, labels, id, text, toxic, most)
    terms, frequencies = chosen_terms(examples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Terms(terms)
        for batch in batches:
            flat = [[x for pair in own.of(t) for x in pair] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"), pa.array(flat, pa.list_(pa.int64()))], names=["id", "toxic", "vector"])

    vectors = examples.mapInArrow(run, "id string, toxic int, vector array<bigint>").groupBy("vector").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"), F.min("id").alias("id"))
    entries = [Entry(tuple(zip(r["vector"][::2], r["vector"][1::2], strict=True)), r["n"], r["toxic"], r["id"]) for r in vectors.collect()]
    return Model(terms, frequencies, entries)


RESULT = "score double, predicted int, terms array<string>, near array<struct<id:string,cosine:double,examples:bigint,toxic:bigint>>"


def score(documents: DataFrame, model: Model, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, score, predicted and the evidence: the terms that count by weight, and the nearest entries."""
    session = documents.sparkSession
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(session.createDataFrame([], RESULT).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Terms(model.terms), {}

        def result(vector: tuple) -> tuple:
            s, at, cosine = model.score(vector)
            weight = dict(zip(*(x.tolist() for x in model.index.weights(vector)), strict=True))
            names = sorted((t for t, _ in vector), key=lambda t: (-weight[t], t))[:SHOWN]
            e = model.index.entries
            near = [{"id": e[i].id, "cosine": float(c), "examples": e[i].count, "toxic": e[i].toxic} for i, c in zip(at[:SHOWN].tolist(), cosine[:SHOWN], strict=True)]
            return s, int(s >= threshold), [model.terms[t - 1] for t in names], near

        for batch in batches:
            rows = []
            for t in batch.column("text").to_pylist():
                vector = own.of(t)
                if vector not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[vector] = result(vector)
                rows.append(seen[vector])
            columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *arrow.names])

    x = documents.select(col(id).alias("id"), text_of(text).alias("text"))
    kind = x.schema["id"].dataType.simpleString()
    out = x.mapInArrow(run, f"id {kind}, {RESULT}")
    return out.select(F.col("id").alias(id), held_out(F.col("id")).alias("held_out"), "score", "predicted", "terms", "near")


def classify(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    return score(documents, fit(documents, labels, id, text, toxic), id, text)
