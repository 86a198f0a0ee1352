"""Media columns (operator 10): MPEG audio frames.

`to_mpeg` stores bytes without loss in a stream of MPEG-1 Layer III frames: each frame is a header, its CRC-16, an
empty side information block (silence) and the bytes as ancillary data. The last frame takes the lowest bitrate that
fits, so the stream has a variable bitrate and starts with a table frame (frame count, byte count, seek points) after
an ID3v2 tag. `read_mpeg` reads Layer III streams of MPEG-1, MPEG-2 and MPEG-2.5: it parses ID3v2 tags (with extended header
and footer) and the table (Xing, Info or VBRI), finds frame headers again after junk, verifies each frame's CRC, and gives
the exact duration and the byte offset of every frame. Frames of the free format, whose length no header has, are junk.

- A null text is empty bytes. Equal texts give equal streams. Rows pass one by one; ids may be null or repeated.
- Very long texts make more frames; memory is one Arrow batch and one stream.
- A stream without frames (empty, junk, null) reads as no frames, an empty payload and duration 0.
- An empty table gives no rows. Columns other than the id and the text (or stream) aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

from rosterloom.llm.common import col, text_of

# Fixed values of the format: Layer III, kbit/s and Hz by index, samples of a frame and bytes of side information.
KBITS = (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320)
KBITS_2 = (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160)  # MPEG-2 and 2.5
HERTZ = (44100, 48000, 32000)
SAMPLES = 1152
SIDE = {False: 32, True: 17}  # stereo, mono
SIDE_2 = {False: 17, True: 9}
#: By the version's two bits: the divisor of the sample rate.
VERSIONS = {3: 1, 2: 2, 0: 4}

_HZ = 2  # 32 kHz has the longest frames
_MONO = 0xC0


def _frame_bytes(kbits: int, hertz: int, padding: int) -> int:
    return 144_000 * kbits // hertz + padding


_ROOM = [(_frame_bytes(k, HERTZ[_HZ], 0) - 6 - SIDE[True], i) for i, k in enumerate(KBITS) if k]


def _table() -> list[int]:
    out = []
    for b in range(256):
        c = b << 8
        for _ in range(8):
            c = (c << 1 ^ 0x8005 if c & 0x8000 else c << 1) & 0xFFFF
        out.append(c)
    return out


_CRC = _table()


@lru_cache(maxsize=4096)
def frame_crc(covered: bytes) -> int:
    """CRC-16 (polynomial 0x8005) of the header's last two bytes and the side information."""
    c = 0xFFFF
    for b in covered:
        c = (c << 8 ^ _CRC[c >> 8 ^ b]) & 0xFFFF
    return c


@lru_cache(maxsize=64)
def _front(index: int) -> bytes:
    """Header, CRC and empty side information of a mono frame of that bitrate."""
    head = bytes((0xFF, 0xFA, index << 4 | _HZ << 2, _MONO))
    side = bytes(SIDE[True])
    return head + struct.pack(">H", frame_crc(head[2:] + side)) + side


def _synchsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def _tag(fields: dict[str, str]) -> bytes:
    """An ID3v2.4 tag of user text fields."""
    frames = b""
    for k, v in fields.items():
        body = b"\x03" + k.encode() + b"\0" + v.encode()
        frames += b"TXXX" + _synchsafe(len(body)) + b"\0\0" + body
    return b"ID3\x04\0\0" + _synchsafe(len(frames)) + frames


def to_mpeg(payload: bytes, fields: dict[str, str] | None = None) -> bytes:
    most = _ROOM[-1][0]
    parts, offsets, size, at = [], [], 0, 0
    while at < len(payload):
        room, index = next(x for x in _ROOM if x[0] >= min(most, len(payload) - at))
        body = payload[at : at + room]
        parts += (_front(index), body, bytes(room - len(body)))
        offsets.append(size)
        size += len(_front(index)) + room
        at += room
    index = 5  # 64 kbit/s holds the table
    front = _front(index)
    length = _frame_bytes(KBITS[index], HERTZ[_HZ], 0)
    total = size + length
    toc = bytes(min(255, (length + offsets[len(offsets) * p // 100]) * 256 // total) if offsets else 0 for p in range(100))
    table = b"Xing" + struct.pack(">III", 7, len(offsets), total) + toc
    first = front + table + bytes(length - len(front) - len(table))
    return _tag({"payload-bytes": str(len(payload)), "payload-crc32": str(zlib.crc32(payload))} | (fields or {})) + first + b"".join(parts)


@dataclass
class Stream:
    fields: dict[str, str] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)  # of frames with audio, in bytes
    samples: int = 0
    seconds: Fraction = Fraction(0)
    kbits: list[int] = field(default_factory=list)
    bad_crc: int = 0
    junk: int = 0  # bytes skipped to find a header again
    table: dict | None = None  # frames, bytes and seek points as the table frame says
    payload: bytes = b""


@dataclass(frozen=True)
class Header:
    length: int
    kbits: int
    hertz: int
    samples: int
    side: int  # bytes of side information
    crc: bool


def _header(data: bytes, at: int) -> Header | None:
    """The Layer III header that is there, if one is."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE6 != 0xE2:
        return None
    version, k, hz = data[at + 1] >> 3 & 3, data[at + 2] >> 4, data[at + 2] >> 2 & 3
    if version == 1 or k in (0, 15) or hz == 3 or data[at + 3] & 3 == 2:
        return None
    first, hertz, mono = version == 3, HERTZ[hz] // VERSIONS[version], data[at + 3] >> 6 == 3
    kbits, samples = (KBITS if first else KBITS_2)[k], SAMPLES if first else SAMPLES // 2
    length = samples // 8 * 1000 * kbits // hertz + (data[at + 2] >> 1 & 1)
    return Header(length, kbits, hertz, samples, (SIDE if first else SIDE_2)[mono], not data[at + 1] & 1)


def _synch(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _fields(data: bytes) -> tuple[dict[str, str], int]:
    """The user text of an ID3v2.3 or 2.4 tag, and where the tag ends, its footer included."""
    if data[:3] != b"ID3" or len(data) < 10:
        return {}, 0
    version, flags = data[3], data[5]
    size = _synch if version >= 4 else lambda b: int.from_bytes(b, "big")  # of frames; that of the tag is always synchsafe
    end, at, out = min(len(data), 10 + _synch(data[6:10])), 10, {}
    if flags & 0x40 and at + 4 <= end:  # the extended header's size counts itself in 2.4 alone
        at += size(data[at : at + 4]) + (0 if version >= 4 else 4)
    while at + 10 <= end and data[at : at + 1] != b"\0":
        n = size(data[at + 4 : at + 8])
        if data[at : at + 4] == b"TXXX" and n and at + 10 + n <= end:
            k, _, v = data[at + 11 : at + 10 + n].partition(b"\0")
            out[k.decode("utf-8", "replace")] = v.decode("utf-8", "replace")
        at += 10 + n
    return out, min(len(data), end + (10 if flags & 0x10 else 0))


def _table_frame(data: bytes, at: int, h: Header) -> dict | None:
    """What a table frame says: Xing or Info after the side information, VBRI 32 bytes after the header."""
    body = at + 4 + 2 * h.crc + h.side
    if data[body : body + 4] in (b"Xing", b"Info"):
        flags, i, out = struct.unpack_from(">I", data, body + 4)[0], body + 8, {}
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[name] = struct.unpack_from(">I", data, i)[0]
                i += 4
        if flags & 4:
            out["toc"] = list(data[i : i + 100])
        return out
    if data[at + 36 : at + 40] == b"VBRI" and h.length >= 62:
        size, frames = struct.unpack_from(">II", data, at + 46)
        entries, scale, width, per = struct.unpack_from(">HHHH", data, at + 54)
        entries = min(entries, (h.length - 62) // width) if width else 0
        steps = [int.from_bytes(data[at + 62 + i * width : at + 62 + (i + 1) * width], "big") * scale for i in range(entries)]
        return {"frames": frames, "bytes": size, "steps": steps, "frames_per_step": per}
    return None


def read_mpeg(data: bytes | None) -> Stream:
    data = data or b""
    out, parts, by_rate = Stream(), [], Counter()
    out.fields, at = _fields(data)
    first, synced = True, False
    while at < len(data):
        h = _header(data, at)
        # out of step, a header must be followed by another or the end, else the next byte is tried
        followed = h and (synced or at + h.length == len(data) or _header(data, at + h.length) or data[at + h.length : at + h.length + 3] == b"TAG")
        if not followed or at + h.length > len(data):
            if data[at : at + 3] == b"TAG" and len(data) - at == 128:
                break
            nxt = data.find(b"\xff", at + 1)
            nxt = len(data) if nxt < 0 else nxt
            out.junk += nxt - at
            at, synced = nxt, False
            continue
        body = at + 4 + 2 * h.crc + h.side
        good = not h.crc or struct.unpack_from(">H", data, at + 4)[0] == frame_crc(data[at + 2 : at + 4] + data[at + 6 : body])
        out.bad_crc += not good
        table = _table_frame(data, at, h) if first else None
        if table is not None:
            out.table = table
        else:
            out.offsets.append(at)
            out.kbits.append(h.kbits)
            out.samples += h.samples
            by_rate[h.hertz] += h.samples
            parts.append(data[body : at + h.length] if good else b"")
        first, synced = False, True
        at += h.length
    out.seconds = sum((Fraction(n, hz) for hz, n in by_rate.items()), Fraction(0))
    whole = b"".join(parts)
    n = out.fields.get("payload-bytes", "")
    out.payload = whole[: int(n)] if n.isdigit() else whole
    return out


def padded(raw: bytes, to: int = 64) -> bytes:
    return raw + bytes(max(1, -(-len(raw) // to)) * to - len(raw))


def to_media(df: DataFrame, id: str = "doc_id", text: str = "text", pad: int = 64) -> DataFrame:
    """id and media (binary): the text's UTF-8, padded with zero bytes to a positive multiple of `pad`, as an MPEG stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = [t.encode() for t in pdf["text"]]
            yield pd.DataFrame({id: pdf["id"], "media": [to_mpeg(padded(r, pad), {"text-bytes": str(len(r))}) for r in raw]})

    kind = df.schema[id].dataType.simpleString()
    return df.select(col(id).alias("id"), text_of(text).alias("text")).mapInPandas(run, f"`{id}` {kind}, media binary")


FEATURES = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, "
    "duration_s double, sample_count long, frame_offsets array<long>, bad_crc int, junk_bytes long, intact boolean"
)


def features(df: DataFrame, id: str = "doc_id", media: str = "media") -> DataFrame:
    """What is read back of each stream (FEATURES); nulls read as empty streams."""

    def one(data: bytes | None) -> tuple:
        data = data or b""
        s = read_mpeg(data)
        n = s.fields.get("text-bytes", "")
        toc = s.table.get("toc", []) if s.table else []
        text = f"frames={len(s.offsets)};samples={s.samples};seconds={s.seconds};kbits={min(s.kbits, default=0)}-{max(s.kbits, default=0)};table={s.table.get('frames', 0) if s.table else 'none'};toc={zlib.crc32(bytes(toc))};first={s.offsets[0] if s.offsets else -1};last={s.offsets[-1] if s.offsets else -1}"
        intact = not s.bad_crc and not s.junk and s.fields.get("payload-crc32") == str(zlib.crc32(s.payload)) and (s.table is None or s.table.get("frames") == len(s.offsets))
        return (
            int(n) if n.isdigit() else len(s.payload), len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), text,
            float(s.seconds), s.samples, s.offsets, s.bad_crc, s.junk, intact,
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split(" ")[0] for x in FEATURES.split(", ")]
        for pdf in batches:
            out = pd.DataFrame([one(m) for m in pdf["media"]], columns=names)
            out.insert(0, id, pdf["id"].values)
            yield out

    kind = df.schema[id].dataType.simpleString()
    return df.select(col(id).alias("id"), col(media).alias("media")).mapInPandas(run, f"`{id}` {kind}, {FEATURES}")


def media_columns(df: DataFrame, id: str = "doc_id", text: str = "text", pad: int = 64) -> DataFrame:
    return features(to_media(df, id, text, pad), id)

