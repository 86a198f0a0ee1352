"""Vector code compression (operator 12): product quantization in whole numbers.

A component x becomes floor(1024 x). Vectors are cut into equal parts; each part position has a codebook of its own, which
starts as that part of the first vectors by id and is moved to the floor of its members' means in each round.

The nearest entry is found by segment-mean lower bounds, from coarse to fine: a segment of a part is its mean and the norm
of what the mean leaves, and L (mean difference)^2 + (norm difference)^2 is never more than the segment's true distance. The
bounds of a block of rows against all entries are one product of matrices. Entries whose bound is above a distance already
known are left out; the survivors get exact distances in whole numbers.

- Rows whose vector is null, or holds a null or a component that isn't finite, are dropped. An empty table, or one without
  a vector left, gives no rows.
- The vectors that are left must have one length, a multiple of `parts`, and components below 2^17 in size (beyond, squared
  distances needn't fit 64 bits); anything else is an error that says so, never a wrong code.
- Ids may be null or repeated, each row has its code. The first vectors are by id, nulls last, then by their components.
  With fewer vectors than entries the codebook has as many entries as vectors. Ties go to the lower index. Entries that
  equal one another stay; an entry without members stays as it is.
- label_error is the sum of error over equal labels, nulls together. Columns other than id, vector and label aren't read.

The whole numbers are written once to the shared folder, and each round reads them: a task sums its own rows by entry, so a
round shuffles parts x entries rows a task, and the driver sees parts x entries rows, whatever the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from rosterloom.llm.common import col, written

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Components are below this in size, so that 64 bits hold a squared distance.
LARGEST = float(1 << 17)
#: Segments of a part, from coarse to fine.
SEGMENTS = (1, 4, 8)
#: Rows of a block: its bounds against 256 entries are some megabytes.
BLOCK = 2048
#: So many labels may be broadcast with their sums.
MAX_SENT = 100_000


class Book:
    """A codebook (entries x width, whole numbers) with the means and residual norms of its segments, from coarse to fine."""

    def __init__(self, entries: np.ndarray, segments: tuple[int, ...] = SEGMENTS) -> None:
        self.entries = np.ascontiguousarray(entries, dtype=np.int64)
        self.levels = [n for n in segments if 0 < n <= self.entries.shape[1]]
        self.digests = [digest(self.entries, n) for n in self.levels]
        self.squares = [np.einsum("ij,ij->i", d, d) for d in self.digests]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry of each row of x, the lowest of equals, and its squared distance."""
        at, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for i in range(0, len(x), BLOCK):
            at[i : i + BLOCK], best[i : i + BLOCK] = self._block(x[i : i + BLOCK])
        return at, best

    def _block(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(x))
        known, left = np.full(len(x), np.inf), None
        for n, entry_digest, squares in zip(self.levels, self.digests, self.squares, strict=True):
            own = digest(x, n)
            size = np.einsum("ij,ij->i", own, own)[:, None] + squares
            low = size - 2 * (own @ entry_digest.T)
            if left is not None:
                low[~left] = np.inf
            known = np.minimum(known, self._exact(x, rows, low.argmin(axis=1)))
            # in floating point, with room for its rounding: what isn't surely farther than an entry that is known may be nearest
            left = low - 1e-9 * size - 0.01 <= known[:, None]
        row, entry = np.nonzero(left)
        d = self._exact(x, row, entry)
        least = np.flatnonzero(d == np.minimum.reduceat(d, np.searchsorted(row, rows))[row])
        chosen = least[np.searchsorted(row[least], rows)]  # the first of equals
        return entry[chosen], d[chosen]

    def _exact(self, x: np.ndarray, row: np.ndarray, entry: np.ndarray) -> np.ndarray:
        d = x[row] - self.entries[entry]
        return np.einsum("ij,ij->i", d, d)


def digest(x: np.ndarray, segments: int) -> np.ndarray:
    """For each row its segments' means, times the root of their size, and their residual norms: no two rows' digests are farther apart than the rows."""
    out = []
    for c in np.array_split(np.arange(x.shape[1]), segments):
        mean = x[:, c].mean(axis=1)
        rest = x[:, c] - mean[:, None]
        out += [mean * np.sqrt(len(c)), np.sqrt(np.einsum("ij,ij->i", rest, rest))]
    return np.stack(out, axis=1)


def whole_numbers(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """(id, label, v array<int>) of the rows whose vector is whole and finite, written to the shared folder."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cut = lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * SCALE).cast("int")).otherwise(F.raise_error(F.lit(f"a component is {LARGEST:.0f} or more in size")).cast("int"))
    x = vectors.select(col(id).alias("id"), col(label).alias("label"), col(vector).cast("array<double>").alias("v"))
    return written(x.where(F.col("v").isNotNull() & fine).select("id", "label", F.transform("v", cut).alias("v")))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    v = batch.column("v")
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def _parts(x: np.ndarray, parts: int) -> list[np.ndarray]:
    width = x.shape[1] // parts
    return [np.ascontiguousarray(x[:, p * width : (p + 1) * width]) for p in range(parts)]


def moved(kept: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after a round: each entry the floor of its members' mean."""
    parts, (entries, width) = len(books), books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Book(b) for b in books]
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if batch.num_rows:
                for p, x in enumerate(_parts(_matrix(batch), parts)):
                    at, _ = own[p].nearest(x)
                    np.add.at(sums[p], at, x)
                    counts[p] += np.bincount(at, minlength=entries)
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *(sums[part, entry, i] for i in range(width))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

    schema = ", ".join(f"{c} long" for c in ("part", "entry", "n", *(f"s{i}" for i in range(width))))
    total = kept.select("v").mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n"), *(F.sum(f"s{i}") for i in range(width)))
    out = [b.copy() for b in books]
    for part, entry, n, *sums in total.collect():  # parts x entries rows
        out[part][entry] = [s // n for s in sums]
    return out


def codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray] | None:
    """The final codebook of each part; None without a vector."""
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    sizes = kept.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if sizes[0] != sizes[1] or sizes[0] % parts or not sizes[0]:
        raise ValueError(f"vectors need one length, a multiple of {parts}; they have {sizes[0]} to {sizes[1]} components")
    books = _parts(np.array([r["v"] for r in first], np.int64), parts)
    for _ in range(rounds):
        books = moved(kept, books)
    return books


def books_sha256(books: list[np.ndarray]) -> str:
    """Of all entries' components as decimal numbers, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def encoded(kept: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(id, label, code array<int>, error long) of each row."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Book(b) for b in books]
        for batch in batches:
            if batch.num_rows:
                found = [own[p].nearest(x) for p, x in enumerate(_parts(_matrix(batch), parts))]
                code = np.stack([at for at, _ in found], axis=1).astype(np.int32)
                codes = pa.ListArray.from_arrays(pa.array(np.arange(0, code.size + 1, parts), pa.int32()), pa.array(code.ravel()))
                error = pa.array(np.sum([d for _, d in found], axis=0), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), codes, error], names=["id", "label", "code", "error"])

    fields = [*kept.select("id", "label").schema.fields, StructField("code", ArrayType(IntegerType())), StructField("error", LongType())]
    return kept.select("id", "label", "v").mapInArrow(run, StructType(fields))


def with_label_error(codes: DataFrame) -> DataFrame:
    """codes with the sum of error over equal labels.

    Sums are made map-side. Up to MAX_SENT labels they are broadcast; beyond, those of labels that hold more than
    1/MAX_SENT of all rows are, and the other labels, each of few rows, meet their rows in a shuffle.
    """
    sums = written(codes.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")))
    few = sums.limit(MAX_SENT + 1).count() <= MAX_SENT
    join = lambda rows, s: rows.join(s.select(F.col("label").alias("_label"), "label_error"), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    if few:
        return join(codes, F.broadcast(sums))
    least = (sums.agg(F.sum("_n")).first()[0] or 0) // MAX_SENT
    hot, rest = sums.where(F.col("_n") > least), sums.where(F.col("_n") <= least)
    marked = hot.select(F.col("label").alias("_label"))
    cold = codes.join(F.broadcast(marked), F.col("label").eqNullSafe(F.col("_label")), "left_anti")
    return join(codes, F.broadcast(hot)).unionByName(join(cold, rest))


def compress(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray] | None]:
    """(id, label, code array<int>, error, label_error) of each row that is kept, under the names given for id and label, and the codebooks."""
    kept = whole_numbers(vectors, id, vector, label)
    books = codebooks(kept, parts, entries, rounds)
    if books is None:
        out = kept.select("id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"), F.lit(None).cast("long").alias("label_error"))
    else:
        out = with_label_error(written(encoded(kept, books)))
    return out.select(F.col("id").alias(id), F.col("label").alias(label), "code", "error", "label_error"), books
