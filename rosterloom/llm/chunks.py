"""Chunk tables: documents in runs of some megabytes, each with statistics of its own.

A corpus-wide statistic (counts of n-grams, of shingles) must come back to the documents. To move it once for each
chunk and not for each document, the documents are written as a table with a row for each chunk: the chunk's documents
(an Arrow stream, zstd) beside what the chunk says about itself. The table is bucketed by chunk, so that what the
corpus answers can be joined to it without moving the documents again.
"""

from __future__ import annotations

import ctypes
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.sources.shared import delete, shared_dir

CHUNK_BYTES = 8 << 20
#: Arrow batches of about this many bytes go to the tasks that make chunks.
BATCH_BYTES = 4 << 20
_MADE = threading.local()


def give_back() -> None:
    """Returns memory that is free in this worker, which lives on beside others, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pack(table: pa.Table, level: int = 3) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))) as w:
        w.write_table(table.combine_chunks())
    return out.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def frame(table: pa.Table) -> pd.DataFrame:
    """In pandas, with whole numbers staying whole beside nulls."""
    return table.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get)


def texts_of(table: pa.Table, text: str) -> list[str]:
    return [t or "" for t in table[text].to_pylist()]


def bytes_of(table: pa.Table, text: str) -> list[bytes]:
    """The UTF-8 of each text; a null is empty."""
    return [t or b"" for t in table[text].cast(pa.binary()).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.Table]:
    """The rows in runs of about `most` bytes of text; a longer text is a run of its own."""
    import pyarrow.compute as pc

    held, size = [], 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        first = own = 0
        for i, n in enumerate(pc.binary_length(table[text]).to_pylist()):
            n = n or 0
            if size + own and size + own + n > most:
                held.append(table.slice(first, i - first))
                yield pa.concat_tables(held)
                held, size, first, own = [], 0, i, 0
            own += n
        if table.num_rows > first:
            held.append(table.slice(first))
            size += own
    if held:
        yield pa.concat_tables(held)


def chunk_table(df: DataFrame, text: str, about: Callable[[pa.Table], dict[str, list]], schema: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk long, docs binary, and `schema`) of df: `about` gives the columns of `schema` for a chunk, and `docs` if that is not to be the documents as they are.

    The chunks are fixed by being written, to the shared folder: later steps, however often they run, see the same ones. As
    many buckets as spark.sql.shuffle.partitions, so joins on the chunk keep the table where it is. The catalog has the table
    only while it is written, as buckets can't be written otherwise; the files go with `forget`, or with the session.
    """
    spark = df.sparkSession
    full = f"chunk long, docs binary, {schema}"
    # the schema as Arrow has it, from Spark
    types = spark.createDataFrame([], full).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, table in enumerate(runs(batches, text, chunk_bytes)):
            own = about(table)
            columns = {"chunk": [task << 24 | n], "docs": [own["docs"] if "docs" in own else pack(table)]} | {k: [v] for k, v in own.items() if k != "docs"}
            del table
            yield pa.RecordBatch.from_arrays([pa.array(columns.pop(f.name), type=f.type) for f in arrow], schema=arrow)
            give_back()

    name, path = f"rosterloom_{uuid.uuid4().hex}", shared_dir(spark, "chunks")
    made()
    _MADE.paths.append(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, min(int(before), BATCH_BYTES) if before.isdigit() and int(before) > 0 else BATCH_BYTES)  # long texts shouldn't come in thousands
    try:
        df.mapInArrow(run, types).write.option("compression", "zstd").option("path", path).bucketBy(buckets, "chunk").saveAsTable(name, format="parquet")
        return spark.table(name)
    finally:
        spark.conf.set(limit, before)
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")


# sorted numbers, small ------------------------------------------------------------------------------


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as zstd of their byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def rising(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def unrising(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data), dtype=np.uint64)


def made() -> int:
    """How many chunk tables this thread has made so far."""
    return len(vars(_MADE).setdefault("paths", []))


def forget(spark: SparkSession, since: int = 0) -> int:
    """Deletes the chunk tables that this thread has made since `made()` said so, once nothing that was made from them will be read again; how many there were."""
    made()
    paths, _MADE.paths[since:] = _MADE.paths[since:], []
    for path in paths:
        delete(spark, path)
    return len(paths)


def take_rows(chunks: DataFrame, kept: DataFrame, like: DataFrame) -> DataFrame:
    """The rows of a chunk table that `kept` (chunk, nth) names, with the columns of `like`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(like.schema)
    keep = kept.groupBy(F.col("chunk").alias("_chunk")).agg(F.sort_array(F.collect_list("nth")).alias("keep"))

    def chosen(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        rows = right["keep"].combine_chunks().flatten()
        out = unpack(left["docs"][0].as_py()).select(arrow.names).take(rows).cast(arrow)
        give_back()
        return out

    return chunks.select("chunk", "docs").groupBy("chunk").cogroup(keep.groupBy("_chunk")).applyInArrow(chosen, like.schema)


# document frequencies -------------------------------------------------------------------------------

#: Columns of a chunk table: for each shard of the fingerprint space the chunk's sorted fingerprints, and how many of its documents hold each.
SHARDED = "prints array<binary>, counts array<binary>"


def sharded(prints: np.ndarray, bits: int, shards: int) -> tuple[list[bytes], list[bytes]]:
    """The SHARDED columns of the fingerprints (of `bits` bits) that the documents of a chunk hold, each once for each document."""
    distinct, counts = np.unique(prints, return_counts=True)
    edges = np.array([(i << bits) // shards for i in range(1, shards)], np.uint64)
    at = [0, *np.searchsorted(distinct, edges).tolist(), len(distinct)]
    return [rising(distinct[a:b]) for a, b in zip(at, at[1:])], [squeeze(counts[a:b]) for a, b in zip(at, at[1:])]


def document_frequencies(chunks: DataFrame) -> DataFrame:
    """(_chunk, shard, df): how many documents of the whole table hold each fingerprint of each chunk. A shard is one group; shards are even, as fingerprints are."""
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("prints", "counts")).alias("shard", "x")).select("chunk", "shard", "x.prints", "x.counts")

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [unrising(x) for x in pdf["prints"]]
        _, at = np.unique(np.concatenate(own), return_inverse=True)
        df = np.bincount(at, np.concatenate([unsqueeze(x) for x in pdf["counts"]])).astype(np.uint64)[at]
        return pd.DataFrame({"_chunk": pdf["chunk"], "shard": pdf["shard"], "df": [squeeze(x) for x in np.split(df, np.cumsum([len(x) for x in own])[:-1])]})

    return each.groupBy("shard").applyInPandas(summed, "_chunk long, shard int, df binary")


def frequencies_of(prints: np.ndarray, answer: pd.DataFrame) -> np.ndarray:
    """The document frequency of each fingerprint of a chunk, from the chunk's rows of document_frequencies."""
    df = np.concatenate([np.zeros(0, np.uint64), *(unsqueeze(x) for x in answer.sort_values("shard")["df"])])
    return df[np.searchsorted(np.unique(prints), prints)]
