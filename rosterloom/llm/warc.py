"""WARC archives (operator 2): a writer, and a splittable reader.

The writer's tasks put each record into a gzip member of its own, in archives in the shared folder. The reader's tasks
get byte ranges: each scans its range for the gzip magic, accepts a candidate when its decoded start is a WARC header,
owns the records that start inside its range, and reads the last one past the range's end.

- A null html is an empty payload; a null url writes no target; a null page_id is smaller than any other.
- Of equal payloads of `least` bytes or more the record with the largest page_id is a response, the others revisit it;
  rows that repeat that page_id are responses too. Smaller payloads are all responses.
- An empty table writes no archives and reads as no rows. Other columns aren't read.
- An archive's name is that of its task and its part: a task that runs again replaces its archives with equal ones.
- Record ids are page ids, so they repeat where page ids do. A folder without a scheme is a mounted path that all machines
  share.
- A very long payload is one record: a task holds it once, decoded, and its compressed bytes.
- Memory: one Arrow batch of pages to write, one record and one read buffer to read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import col, shared_dir, written

MAGIC = b"\x1f\x8b\x08"
_DATE = "2020-01-01T00:00:00Z"
#: So many digests with the record that they revisit (some 60 bytes each) may be broadcast.
MAX_SENT = 200_000
#: So many tasks read at most, each one or more ranges.
MAX_TASKS = 50_000
ROW = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, digest_ok boolean, archive string, offset long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def plan_revisits(pages: DataFrame, id: str = "page_id", html: str = "html", least: int = 1000, sent: int = MAX_SENT) -> DataFrame:
    """pages (id, url, payload, digest, refers_to): the record that each is to revisit, or null.

    Digests that occur more than once are counted map-side first. Up to `sent` of them are broadcast, so no page moves.
    Beyond that those are that hold more than 1/`sent` of all such pages, of which there are fewer than `sent`; what is
    left has no hot digest and meets in a shuffle, where pages that are settled are spread by row.
    """
    rows = pages.select(col(id).cast("long").alias("id"), col("url").cast("string").alias("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"), F.coalesce(col(html).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    again = written(rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("id").alias("top"), F.count("*").alias("c")).where("c > 1 and top is not null"))
    n, copies = again.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    hot = F.lit(True) if n <= sent else F.col("c") > copies // sent
    rows = rows.join(F.broadcast(again.where(hot).select("digest", "top")), "digest", "left")
    if n > sent:
        rest = again.where(~hot).select(F.col("digest").alias("_digest"), F.col("top").alias("_top"))
        open_yet = F.col("top").isNull() & (F.octet_length("payload") >= least)
        own = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))  # no digest
        rows = rows.withColumn("_digest", F.when(open_yet, F.col("digest")).otherwise(own)).join(rest, "_digest", "left").withColumn("top", F.coalesce("top", "_top"))
    return rows.select("id", "url", "payload", "digest", F.when(~F.col("id").eqNullSafe(F.col("top")), F.col("top")).alias("refers_to"))


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: an HTTP response with the payload, or a revisit with the response's head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'none' if id is None else id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = 256 << 20, level: int = 6) -> DataFrame:
    """archive, bytes and records of each archive written from the rows of plan_revisits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        task, part, out, size, n = TaskContext.get().partitionId(), 0, None, 0, 0
        attempt = uuid.uuid4().hex

        def close() -> pd.DataFrame:
            out.close()
            name = f"part-{task:06d}-{part:04d}.warc.gz"
            files.move(f"{root}/.{name}.{attempt}", f"{root}/{name}")  # whole archives only
            return pd.DataFrame({"archive": [f"{folder}/{name}"], "bytes": [size], "records": [n]})

        for pdf in batches:
            for id, url, payload, digest, refers in zip(pdf["id"].astype("Int64"), pdf["url"], pdf["payload"], pdf["digest"], pdf["refers_to"].astype("Int64"), strict=True):
                if out is None:
                    out, size, n = files.open_output_stream(f"{root}/.part-{task:06d}-{part:04d}.warc.gz.{attempt}"), 0, 0
                m = member(record(None if pd.isna(id) else int(id), url, payload, digest, None if pd.isna(refers) else int(refers)), level)
                out.write(m)
                size, n = size + len(m), n + 1
                if size >= archive_bytes:
                    yield close()
                    part, out = part + 1, None
        if out is not None:
            yield close()

    return planned.mapInPandas(run, "archive string, bytes long, records long")


def _head(decoded: bytes | bytearray) -> tuple[dict[str, str], int] | None:
    """The fields of a WARC header and where the block starts; None if this isn't a record."""
    if not decoded.startswith(b"WARC/") or (end := decoded.find(b"\r\n\r\n")) < 0:
        return None
    lines = decoded[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, sep, v in (x.partition(":") for x in lines) if sep}
    return (fields, end + 4) if "warc-type" in fields and re.fullmatch("[0-9]+", fields.get("content-length", "")) else None


class _Window:
    """Bytes of a file by absolute position, read in pieces; what lies behind is let go."""

    def __init__(self, file, size: int, at: int, piece: int = 1 << 20):
        self.file, self.size, self.start, self.data, self.piece = file, size, at, bytearray(), piece

    def upto(self, end: int) -> None:
        have = self.start + len(self.data)
        if end > have and have < self.size:
            self.file.seek(have)
            self.data += self.file.read(max(self.piece, end - have))

    def forget(self, before: int) -> None:
        if before - self.start > self.piece:
            del self.data[: before - self.start]
            self.start = before


def read_range(file, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and block of each record whose member starts in [start, end)."""
    w, at = _Window(file, size, start), start
    while at < end:
        w.upto(min(size, max(at + (64 << 10), end if end - at < w.piece else at + w.piece)))
        i = w.data.find(MAGIC, at - w.start)
        if i < 0:
            at = max(at, w.start + len(w.data) - 2)
            if w.start + len(w.data) >= size:
                return
            w.forget(at)
            continue
        at = w.start + i
        if at >= end:
            return
        w.upto(at + (64 << 10))
        z, decoded, used, found = zlib.decompressobj(31), bytearray(), at, None
        try:
            while not z.eof:
                w.upto(used + 1)
                more = w.data[used - w.start : used - w.start + (64 << 10)]
                if not more:
                    break
                decoded += z.decompress(more)
                used += len(more) - len(z.unused_data)
                if found is None and len(decoded) >= 5 and not decoded.startswith(b"WARC/"):
                    break
                found = found or _head(decoded)
        except zlib.error:
            found = None if not z.eof else found
        if not z.eof or found is None:  # the magic by chance, or a member cut off
            at += 1
            continue
        fields, body = found
        yield at, fields, bytes(memoryview(decoded)[body : body + int(fields["content-length"])])
        at = used
        w.forget(at)


def _page(urn: str | None) -> int | None:
    m = re.search(r"urn:x-page:(-?[0-9]+)>", urn or "")
    return int(m[1]) if m else None


def read_archives(spark: SparkSession, archives: DataFrame, range_bytes: int = 32 << 20) -> DataFrame:
    """The records (ROW) of the archives (archive, bytes); a revisit's payload is null, its length and digest those recorded."""
    ranges = archives.where("bytes > 0").select("archive", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    tasks = archives.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    ranges = ranges.repartition(min(int(tasks), MAX_TASKS), "archive", "start")  # by number, or rows so few would share a task

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split(" ")[0] for x in ROW.split(", ")]
        for pdf in batches:
            for archive, size, start in zip(pdf["archive"], pdf["bytes"], pdf["start"], strict=True):
                files, path = _open(archive)
                rows, held = [], 0
                with files.open_input_file(path) as f:
                    for at, fields, block in read_range(f, int(size), int(start), min(int(size), int(start) + range_bytes)):
                        if fields["warc-type"] not in ("response", "revisit"):
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex() if "warc-payload-digest" in fields else None
                        if fields["warc-type"] == "response":
                            own = hashlib.sha1(payload).hexdigest()
                            row = (_page(fields.get("warc-record-id")), fields.get("warc-target-uri"), "response", payload, len(payload), own, None, told in (None, own))
                        else:
                            n = re.search(rb"(?im)^content-length: *([0-9]+)", http)
                            row = (_page(fields.get("warc-record-id")), fields.get("warc-target-uri"), "revisit", None, int(n[1]) if n else None, told, _page(fields.get("warc-refers-to")), True)
                        rows.append((*row, archive, at))
                        held += len(block)
                        if held > 16 << 20:
                            yield _frame(rows, names)
                            rows, held = [], 0
                yield _frame(rows, names)

    return ranges.mapInPandas(run, ROW)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to", "offset")})


def through_archives(pages: DataFrame, id: str = "page_id", html: str = "html", least: int = 1000, folder: str | None = None, range_bytes: int = 32 << 20) -> DataFrame:
    """Writes the pages to archives, then reads these back."""
    spark = pages.sparkSession
    folder = folder or shared_dir(spark, "warc")
    archives = written(write_archives(plan_revisits(pages, id, html, least), folder))
    return read_archives(spark, archives, range_bytes)
