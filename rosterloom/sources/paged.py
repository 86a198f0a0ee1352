"""Collections that are read page by page: partitions by ranges of keys, a cursor in each, and offsets to go on from."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

#: (first key or None, key behind the last or None, cursor or None, most) to (documents, the next cursor or None at the end).
Fetch = Callable[[str | None, str | None, str | None, int], tuple[list[dict], str | None]]


@dataclass
class KeyRange(InputPartition):
    first: str | None
    end: str | None

    def __post_init__(self) -> None:
        super().__init__(None)


@dataclass(frozen=True)
class Pages:
    """Reads a range to its end by pages of `size`; a page that fails is asked for again, `attempts` times, with waits that double."""

    fetch: Fetch
    size: int = 300
    attempts: int = 4
    wait: float = 0.5
    sleep: Callable[[float], None] = field(default=time.sleep)

    def page(self, first: str | None, end: str | None, cursor: str | None) -> tuple[list[dict], str | None]:
        for n in range(self.attempts):
            try:
                return self.fetch(first, end, cursor, self.size)
            except Exception:
                if n + 1 == self.attempts:
                    raise
                self.sleep(self.wait * 2**n)
        raise ValueError("no attempts")

    def all(self, first: str | None, end: str | None) -> Iterator[dict]:
        cursor = None
        while True:
            docs, cursor = self.page(first, end, cursor)
            yield from docs
            if cursor is None:
                return


def _row(doc: dict, names: list[str]) -> tuple:
    return tuple(doc.get(n) for n in names)


def ranges(cuts: list[str]) -> list[tuple[str | None, str | None]]:
    """The ranges that sorted keys cut all keys into: up to the first, ..., from the last on."""
    edges = [None, *sorted(set(cuts)), None]
    return list(zip(edges, edges[1:]))


def read_pages(spark: SparkSession, pages: Pages, schema: str, cuts: list[str] | None = None) -> DataFrame:
    """The documents of a collection, a partition for each range between `cuts`: each is read by a task with a cursor of its own."""
    source = _source(spark, pages, schema, cuts or [])
    return spark.read.format(source).load()


def stream_pages(spark: SparkSession, pages: Pages, schema: str) -> DataFrame:
    """The documents of a collection as a stream in the order of its cursor: a micro-batch is a page, its offset the cursor behind it.

    A checkpoint's offsets say where a stream goes on, so each document comes once. The collection's cursor must stay good
    at the end of what there is, and lead on to documents that are added later (`fetch` gives the same cursor while there are none).
    """
    source = _source(spark, pages, schema, [])
    return spark.readStream.format(source).load()


def _source(spark: SparkSession, pages: Pages, schema: str, cuts: list[str]) -> str:
    full: StructType = spark.createDataFrame([], schema).schema
    names, source = full.fieldNames(), f"rosterloom_pages_{uuid.uuid4().hex}"

    class Reader(DataSourceReader):
        def partitions(self) -> list[KeyRange]:
            return [KeyRange(a, b) for a, b in ranges(cuts)]

        def read(self, partition: KeyRange) -> Iterator[tuple]:
            for doc in pages.all(partition.first, partition.end):
                yield _row(doc, names)

    class StreamReader(SimpleDataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"cursor": None}

        def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
            docs, cursor = pages.page(None, None, start["cursor"])
            return iter([_row(d, names) for d in docs]), {"cursor": cursor if docs else start["cursor"]}

        def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
            """A batch that runs again: the pages between its offsets."""
            cursor = start["cursor"]
            while cursor != end["cursor"]:
                docs, cursor = pages.page(None, None, cursor)
                for d in docs:
                    yield _row(d, names)

    class Collection(DataSource):
        @classmethod
        def name(cls) -> str:
            return source

        def schema(self) -> StructType:
            return full

        def reader(self, schema: StructType) -> Reader:
            return Reader()

        def simpleStreamReader(self, schema: StructType) -> StreamReader:
            return StreamReader()

    spark.dataSource.register(Collection)
    return source


def http_pages(url: str, field: str = "documents", timeout: float = 30.0, headers: dict[str, str] | None = None) -> Fetch:
    """A fetch of JSON over HTTP: GET url?start=&end=&cursor=&limit= gives {field: [...], "next": cursor or null}."""

    def fetch(first: str | None, end: str | None, cursor: str | None, size: int) -> tuple[list[dict], str | None]:
        query = {k: v for k, v in (("start", first), ("end", end), ("cursor", cursor), ("limit", str(size))) if v is not None}
        with urllib.request.urlopen(urllib.request.Request(f"{url}?{urllib.parse.urlencode(query)}", headers=headers or {}), timeout=timeout) as f:
            body = json.load(f)
        return body[field], body.get("next")

    return fetch


def http_json(spark: SparkSession, urls: list[str], schema: str, field: str | None = None, attempts: int = 4, wait: float = 0.5) -> DataFrame:
    """The documents of JSON files at addresses, a task for each: an array, an object's array `field`, or one object."""

    def fetch(first: str | None, end: str | None, cursor: str | None, size: int) -> tuple[list[dict], str | None]:
        with urllib.request.urlopen(urls[int(first)], timeout=30) as f:
            body = json.load(f)
        body = body[field] if field else body
        return body if isinstance(body, list) else [body], None

    pages = Pages(fetch, attempts=attempts, wait=wait)
    full = spark.createDataFrame([], schema).schema
    names, source = full.fieldNames(), f"rosterloom_json_{uuid.uuid4().hex}"

    class Reader(DataSourceReader):
        def partitions(self) -> list[KeyRange]:
            return [KeyRange(str(i), None) for i in range(len(urls))]

        def read(self, partition: KeyRange) -> Iterator[tuple]:
            for doc in pages.all(partition.first, None):
                yield _row(doc, names)

    class Files(DataSource):
        @classmethod
        def name(cls) -> str:
            return source

        def schema(self) -> StructType:
            return full

        def reader(self, schema: StructType) -> Reader:
            return Reader()

    spark.dataSource.register(Files)
    return spark.read.format(source).load()
