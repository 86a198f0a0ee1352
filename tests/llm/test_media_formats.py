"""MPEG streams against a walker that shares no code with the module, and streams of other kinds than its own."""

import hashlib
import os
import re
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from rosterloom.llm import mpeg_media as M
from rosterloom.llm import queries, secret_scan
from rosterloom.llm.secret_scan import RULES, findings, update

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")

RATES = {"1": [None, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320], "2": [None, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160]}
CLOCKS = {"1": [44100, 48000, 32000], "2": [22050, 24000, 16000], "2.5": [11025, 12000, 8000]}


def crc16(data):
    """Bit by bit."""
    reg = 0xFFFF
    for byte in data:
        for bit in range(7, -1, -1):
            top = (reg >> 15) ^ (byte >> bit & 1)
            reg = (reg << 1) & 0xFFFF
            if top:
                reg ^= 0x8005
    return reg


def walk(data):
    """Frames of a clean stream after its tag: (offset, length, version, mono, checksum is right, what follows the side information)."""
    at, out = 0, []
    if data[:3] == b"ID3":
        n = 0
        for b in data[6:10]:
            n = n * 128 + b
        at = 10 + n
    while at < len(data):
        bits = f"{int.from_bytes(data[at : at + 4], 'big'):032b}"
        assert bits[:11] == "1" * 11 and bits[13:15] == "01"
        version = {"11": "1", "10": "2", "00": "2.5"}[bits[11:13]]
        rate, clock = RATES[version[0]][int(bits[16:20], 2)] * 1000, CLOCKS[version][int(bits[20:22], 2)]
        mono = bits[24:26] == "11"
        length = (1152 if version == "1" else 576) * rate // 8 // clock + int(bits[22])
        side = ({True: 17, False: 32} if version == "1" else {True: 9, False: 17})[mono]
        if bits[15] == "0":
            body = at + 6 + side
            right = crc16(data[at + 2 : at + 4] + data[at + 6 : body]) == int.from_bytes(data[at + 4 : at + 6], "big")
        else:
            body, right = at + 4 + side, True
        out.append((at, length, version, mono, right, data[body : at + length]))
        at += length
    assert at == len(data)
    return out


@pytest.mark.parametrize("n", [1, 64, 1409, 1410, 5000, 30_011])
def test_stored_form_by_a_walker(n):
    payload = os.urandom(n)
    frames = walk(M.to_mpeg(payload))
    table, audio = frames[0], frames[1:]
    assert all(f[4] for f in frames) and table[5][:4] == b"Xing"
    flags, count, total = struct.unpack(">III", table[5][4:16])
    assert (flags, count, total) == (7, len(audio), sum(f[1] for f in frames))
    whole = b"".join(f[5] for f in audio)
    assert whole[:n] == payload and not any(whole[n:])
    toc = table[5][16:116]
    for p in range(100):  # a seek point is at or before its frame, by less than a 256th of the stream and a frame
        want = audio[len(audio) * p // 100][0] - frames[0][0]
        assert toc[p] == min(255, want * 256 // total)


@tables
def test_op10_by_a_walker(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    media = {r["doc_id"]: bytes(r["media"]) for r in M.to_media(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    rows = {r["doc_id"]: r for r in queries.queries()["op10_mpeg_media"](spark, SF).collect()}
    assert set(rows) == set(docs) == set(media)
    for i, raw in docs.items():
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        frames = walk(media[i])
        audio, r = frames[1:], rows[i]
        assert b"".join(f[5] for f in audio)[: len(padded)] == padded and all(f[4] for f in frames)
        assert (r["media_bytes"], r["media_sha256"], r["payload_sha256"], r["tail_crc32"]) == (len(media[i]), hashlib.sha256(media[i]).hexdigest(), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        assert list(r["frame_offsets"]) == [f[0] for f in audio] and r["duration_s"] == pytest.approx(len(audio) * 1152 / 32000)


def frame(version, rate, clock, mono, crc, fill, padding=0):
    """A frame with zero side information, made bit by bit."""
    bits = "1" * 11 + {"1": "11", "2": "10", "2.5": "00"}[version] + "01" + ("0" if crc else "1") + f"{rate:04b}{clock:02b}{padding}0" + ("11" if mono else "00") + "000000"
    head = int(bits, 2).to_bytes(4, "big")
    side = bytes((17 if mono else 32) if version == "1" else (9 if mono else 17))
    length = (1152 if version == "1" else 576) * RATES[version[0]][rate] * 1000 // 8 // CLOCKS[version][clock] + padding
    out = head + (crc16(head[2:] + side).to_bytes(2, "big") if crc else b"") + side
    return out + fill * (length - len(out))


@pytest.mark.parametrize("version", ["1", "2", "2.5"])
@pytest.mark.parametrize("mono", [True, False])
@pytest.mark.parametrize("crc", [True, False])
def test_all_versions(version, mono, crc):
    frames = [frame(version, 3 + i % 9, i % 3, mono, crc, bytes([i]), i % 2) for i in range(12)]
    data = b"".join(frames)
    s = M.read_mpeg(data)
    assert s.offsets == [f[0] for f in walk(data)] == [sum(map(len, frames[:i])) for i in range(12)] and not s.junk and not s.bad_crc
    n = 1152 if version == "1" else 576
    assert s.samples == 12 * n and float(s.seconds) == pytest.approx(sum(n / CLOCKS[version][i % 3] for i in range(12)))
    assert s.payload == b"".join(f[5] for f in walk(data))
    between = M.read_mpeg(frames[0] + frames[1] + b"junk\xff\xfb" + b"".join(frames[2:]))
    assert between.junk == 6 and len(between.offsets) == 12


def test_vbri_table():
    first = bytearray(frame("1", 9, 0, False, False, b"\0"))
    steps = [100, 200, 300]
    first[36 : 36 + 26 + 6] = b"VBRI" + struct.pack(">HHHIIHHHH", 1, 0, 75, 9999, 3, 3, 2, 2, 1) + struct.pack(">HHH", *steps)
    s = M.read_mpeg(bytes(first) + frame("1", 9, 0, False, False, b"\1") * 3)
    assert s.table == {"frames": 3, "bytes": 9999, "steps": [200, 400, 600], "frames_per_step": 1} and len(s.offsets) == 3 and s.offsets[0] == len(first)


def safe(n):
    return bytes(n >> k & 127 for k in (21, 14, 7, 0))


@pytest.mark.parametrize("version", [3, 4])
def test_tags_with_extended_header_and_footer(version):
    body = b"\x03key\0" + b"v" * 200
    size = safe(len(body)) if version == 4 else struct.pack(">I", len(body))
    text = b"TXXX" + size + b"\0\0" + body
    extended = (safe(6) + b"\x01\0") if version == 4 else struct.pack(">I", 6) + bytes(6)
    footer = version == 4
    tag = b"ID3" + bytes([version, 0, 0x40 | (0x10 if footer else 0)]) + safe(len(extended) + len(text) + 20) + extended + text + bytes(20)
    data = tag + (b"3DI" + tag[3:10] if footer else b"") + frame("2", 5, 0, True, True, b"x") * 2
    s = M.read_mpeg(data)
    assert s.fields == {"key": "v" * 200} and len(s.offsets) == 2 and s.junk == 0
    cut = M.read_mpeg(data[:15])
    assert cut.offsets == [] and cut.fields == {}


@tables
def test_op9_scans_each_blob_once(spark, tmp_path):
    """In two versions of the documents the second scan adds what the first ledger lacks, and no pair is there twice."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = f"file://{tmp_path}/ledger"
    blobs = lambda d: d.select(secret_scan.blob_id(F.coalesce("text", F.lit("")))).distinct().count()
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    early = docs.where(F.col("doc_id") <= middle)
    first = update(early, path).count()
    assert first == blobs(early) * len(RULES) < blobs(docs) * len(RULES)
    both = update(docs, path)
    assert both.count() == both.select("blob", "rules").distinct().count() == blobs(docs) * len(RULES)
    assert update(docs, path).count() == both.count()
    got = {r["doc_id"]: r["found"] for r in findings(docs, both).collect()}
    alone = {r["doc_id"]: r["found"] for r in findings(docs, update(docs, f"file://{tmp_path}/new")).collect()}
    assert got == alone and any(got.values())
    assert re.fullmatch("[0-9]+", str(middle))
