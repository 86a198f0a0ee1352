"""WARC archives and MPEG streams: round trips and damage."""

import hashlib
import io
import os
import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterloom.llm import mpeg_media as M
from rosterloom.llm import warc
from tests.llm import cases

# MPEG


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=6000))
def test_stream_round_trip(raw):
    media = M.to_mpeg(raw)
    s = M.read_mpeg(media)
    assert s.payload == raw and not s.bad_crc and not s.junk
    assert s.table["frames"] == len(s.offsets) and s.seconds * 32000 == s.samples == 1152 * len(s.offsets)
    assert all(media[o : o + 2] == b"\xff\xfa" for o in s.offsets)


def test_crc_is_the_polynomial_s():
    bits = int.from_bytes(b"\x12\x34" + bytes(17), "big")
    c = 0xFFFF
    for i in reversed(range(19 * 8)):
        top = (c >> 15) ^ (bits >> i & 1)
        c = (c << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    assert M.frame_crc(b"\x12\x34" + bytes(17)) == c


def test_damage_is_seen():
    media = bytearray(M.to_mpeg(os.urandom(9000)))
    whole = M.read_mpeg(bytes(media))
    at = whole.offsets[2]
    hurt = bytes(media[:at]) + b"junk\xff\xfa\x00" + bytes(media[at:])
    s = M.read_mpeg(hurt)
    assert s.junk == 7 and len(s.offsets) == len(whole.offsets)
    media[at + 8] ^= 1  # in the side information
    assert M.read_mpeg(bytes(media)).bad_crc == 1
    for x in (None, b"", b"\xff" * 50, b"ID3"):
        assert M.read_mpeg(x).offsets == [] and M.read_mpeg(x).payload == b""


def test_mixed_streams():
    """Stereo and mono, rates, padding and frames without CRC, and a tag at the end."""
    frame = lambda head, n: head + bytes(n - 4)
    media = frame(b"\xff\xfb\x90\x00", 417) + frame(b"\xff\xfb\x92\x00", 418) + frame(b"\xff\xfb\x18\xc0", 144) + b"TAG" + bytes(125)
    s = M.read_mpeg(media)
    assert s.offsets == [0, 417, 835] and s.kbits == [128, 128, 32] and not s.junk
    assert s.seconds == Fraction(2 * 1152, 44100) + Fraction(1152, 32000)


def test_media_columns(spark):
    out = M.media_columns(cases.documents(spark, clash=True))
    want = Counter()
    for r in cases.ROWS:
        raw = (r[1] or "").encode()
        p = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        want[str(r[0]), str(len(raw)), str(len(p)), hashlib.sha256(p).hexdigest(), str(zlib.crc32(p[-64:])), "True"] += 1
    assert Counter(tuple(map(str, r)) for r in out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "intact").collect()) == want
    assert out.where("doc_id = 2").select("media_sha256", "feature").distinct().count() == 1
    assert M.media_columns(cases.nothing(spark)).count() == 0


# WARC

PAGES = [(1, "http://a.example/1", "x" * 1500), (2, None, "x" * 1500), (5, "http://b.example/ y\r\n", "x" * 1500), (5, "u", "x" * 1500), (3, "u", "small"), (4, "u", "small"), (6, "u", None), (None, "u", "y" * 2000), (7, "u", "y" * 2000), (None, None, "z" * 3000), (8, "u", "é" * 500), (9, "u", "é" * 500)]


def brute_warc(rows):
    out = Counter()
    for i, _, html in rows:
        p = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == p and j is not None]
        top = max(same) if same else None
        revisit = len(p) >= 1000 and sum((h or "").encode() == p for _, _, h in rows) > 1 and top is not None and i != top
        out[str(i), str(len(p)), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", str(top if revisit else None)] += 1
    return out


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3).withColumn("digest", F.lit("own"))
    for ranges in (64, 1000, 1 << 25):
        out = warc.through_archives(pages, range_bytes=ranges)
        assert Counter(tuple(map(str, r)) for r in out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()) == brute_warc(PAGES)
        assert out.where("NOT digest_ok").count() == 0
    none = cases.nothing(spark, "page_id long, url string, html string")
    assert warc.through_archives(none).count() == 0


@pytest.mark.parametrize("sent", (1, 2, 3, 200_000))
def test_revisits_when_not_all_repeats_may_be_sent(spark, sent):
    rows = PAGES + [(100 + i, "u", "h" * 1200) for i in range(40)]
    planned = warc.plan_revisits(spark.createDataFrame(rows, "page_id long, url string, html string"), sent=sent)
    got = Counter((str(r["id"]), r["digest"], str(r["refers_to"])) for r in planned.select("id", "digest", "refers_to").collect())
    want = Counter()
    for (id, _, digest, _, refers), n in brute_warc(rows).items():
        want[id, digest, refers] += n
    assert got == want


def test_a_long_record(spark):
    html = "".join(random.Random(5).choices("abcdefghij ", k=6_000_000))
    out = warc.through_archives(spark.createDataFrame([(1, "u", html), (2, "u", html)], "page_id long, url string, html string"), range_bytes=1 << 20)
    digest = hashlib.sha1(html.encode()).hexdigest()
    assert {tuple(r) for r in out.select("page_id", "payload_bytes", "payload_digest", "refers_to").collect()} == {(1, len(html), digest, 2), (2, len(html), digest, None)}


def members(n=40):
    g = random.Random(2)
    return [warc.member(warc.record(i, "u", bytes(g.getrandbits(8) for _ in range(g.randint(0, 400))) + warc.MAGIC * 3, hashlib.sha1(b"").hexdigest(), None), level=g.choice((0, 1, 9))) for i in range(n)]


def test_every_record_has_one_range():
    """Stored blocks put the magic into the bytes as it is; only headers that decode count."""
    ms = members()
    data, starts = b"".join(ms), [sum(map(len, ms[:i])) for i in range(len(ms))]
    for step in (1, 7, 100, 5000, len(data)):
        found = [at for s in range(0, len(data), step) for at, _, _ in warc.read_range(io.BytesIO(data), len(data), s, min(len(data), s + step))]
        assert found == starts


def test_cut_and_strange_bytes():
    ms = members(3)
    data = b"noise" + ms[0] + warc.MAGIC + b"\x00garbage" + ms[1] + ms[2][:-9]
    assert [f["warc-record-id"] for _, f, _ in warc.read_range(io.BytesIO(data), len(data), 0, len(data))] == ["<urn:x-page:0>", "<urn:x-page:1>"]
