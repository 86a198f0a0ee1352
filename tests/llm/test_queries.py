"""The registered queries without SQL against brute force, every column, on the smallest tables."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from rosterloom.llm import byte_bpe, kn_quality, mpeg_media, queries
from tests.llm.test_corpus_operators import brute_classes, brute_kn, brute_passage_classes, brute_repeats, words
from tests.llm.test_text_operators import brute_base

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


def result(spark, name):
    return queries.queries()[name](spark, SF).collect()


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def at(values, q):
    """The first of sorted values that q of all are up to."""
    x = sorted(values)
    return x[next(i for i in range(len(x)) if i + 1 >= len(x) * q)]


def grouped(values):
    """(bands, values) of (band, value): from the longest down, put together until there are LEAST; those left are together."""
    out, own, names = [], [], []
    for band in sorted({b for b, _ in values}, reverse=True):
        names.append(band)
        own += [v for b, v in values if b == band]
        if len(own) >= kn_quality.LEAST:
            out.append((names, own))
            own, names = [], []
    return out + ([(names, own)] if own else [])


def of_band(groups, band):
    """The group of a band: that which reaches down to it, or else the last."""
    return next((i for i, (names, _) in enumerate(groups) if min(names) <= band), len(groups) - 1)


def test_op1_kn_quality(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    split = {r["__rl_id"]: r["__rl_counted"] for r in kn_quality.held_out(kn_quality.trusted_ids(labels)).collect()}
    value = brute_kn([t or "" for i, t, _ in docs if split.get(i)])
    logs = {i: value(t) if t else None for i, t, _ in docs}
    band = {i: int(math.log2(max(1, len(t or "")))) for i, t, _ in docs}
    got = {r["doc_id"]: r for r in result(spark, "op1_kn_quality")}
    assert set(got) == set(logs)
    held, step = defaultdict(list), kn_quality.STEP
    for i, _, lang in docs:
        if split.get(i) is False and logs[i] is not None:
            held[lang].append((band[i], math.ceil(logs[i] / step)))
    by_lang = {lang: grouped(x) for lang, x in held.items()}
    spread = grouped([(b, v - at(own, 0.5)) for lang, x in held.items() for names, own in by_lang[lang] for b, v in x if b in names])
    for i, t, lang in docs:
        r = got[i]
        assert r["lang"] == lang and r["trusted"] == (i in split)
        assert r["perplexity"] == (pytest.approx(math.exp(logs[i]), rel=1e-4) if t else None)
        if lang in by_lang:
            own = by_lang[lang][of_band(by_lang[lang], band[i])][1]
            all_ = at(spread[of_band(spread, band[i])][1], kn_quality.QUANTILE)
            m, n = at(own, 0.5), len(own)
            want = m + (n * (at(own, kn_quality.QUANTILE) - m) + kn_quality.LEAST * all_) / (n + kn_quality.LEAST)
            assert r["threshold"] == pytest.approx(math.exp(want * step), rel=1e-3)
            assert r["accepted"] == (logs[i] is None or r["perplexity"] <= r["threshold"])


def test_op3_near_dup(spark, docs):
    out, classes = result(spark, "op3_near_dup"), defaultdict(list)
    for r in out:
        classes[r["class_id"]].append(r["doc_id"])
    assert Counter(tuple(sorted(map(str, c))) for c in classes.values()) == brute_classes(docs)
    assert all(k == min(c) for k, c in classes.items()) and all(r["class_size"] == len(classes[r["class_id"]]) for r in out)
    assert {r["doc_id"]: r["n_words"] for r in out} == {i: len(words(t)) for i, t, _ in docs}


def test_op4_suffix_dedup(spark, docs):
    out, classes = result(spark, "op4_suffix_dedup"), defaultdict(list)
    assert Counter((str(r["doc_id"]), str(r["n_words"]), str(r["n_repeated"])) for r in out) == brute_repeats(docs)
    for r in out:
        classes[r["class_id"]].append(r["doc_id"])
        spans = [tuple(map(int, x.split(":"))) for x in r["spans"].split(",") if x]
        assert sum(b - a for a, b in spans) == r["n_repeated"] and all(b - a >= 50 for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    assert Counter(tuple(sorted(map(str, c))) for c in classes.values()) == brute_passage_classes(docs)
    assert all(k == min(c) for k, c in classes.items()) and all(r["class_size"] == len(classes[r["class_id"]]) for r in out)


def test_op5_token_counts(spark, docs):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {}
    for i, t, _ in docs:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want[i] = (len((t or "").encode()), n, n > 2048)
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in result(spark, "op5_token_counts")} == want


def encoder():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.ranks_of(P.path("byte_bpe_50k.tiktoken")), special_tokens={})


def test_op8_byte_bpe(spark, docs):
    enc, want = encoder(), {}
    for i, t, _ in docs:
        ids = enc.encode_ordinary(t or "")
        want[i] = (len(ids), sha(" ".join(map(str, ids))), sha(t or ""))
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in result(spark, "op8_byte_bpe")} == want


def test_op9_secret_scan(spark, docs):
    got = {r["doc_id"]: r for r in result(spark, "op9_secret_scan")}
    more = {"pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "jwt": r"(?a)\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"}
    assert set(got) == {i for i, _, _ in docs}
    kinds = ["assign", "access", "hex", "pem", "jwt"]
    for i, t, _ in docs:
        base = brute_base(t)
        found = [x.split(":") for x in base.split(",") if x] + [[k, str(m.start()), str(m.end())] for k, p in more.items() for m in re.finditer(p, t or "")]
        found.sort(key=lambda x: (int(x[1]), kinds.index(x[0])))
        r, n = got[i], Counter(x[0] for x in found)
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == (n["assign"], n["access"], n["hex"], sha(base))
        assert r["spans"] == ",".join(map(":".join, found))


def test_op10_mpeg_media(spark, docs):
    got = {r["doc_id"]: r for r in result(spark, "op10_mpeg_media")}
    for i, t, _ in docs:
        raw = (t or "").encode()
        p = mpeg_media.padded(raw)
        media = mpeg_media.to_mpeg(p, {"text-bytes": str(len(raw))})
        s, r = mpeg_media.read_mpeg(media), got[i]
        assert len(p) % 64 == 0 < len(p) and p.rstrip(b"\0") == raw.rstrip(b"\0") and s.payload == p
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert (r["media_bytes"], r["media_sha256"], r["intact"]) == (len(media), hashlib.sha256(media).hexdigest(), True)
        assert r["duration_s"] == pytest.approx(len(s.offsets) * 1152 / 32000) and r["feature"].startswith(f"frames={len(s.offsets)};samples={1152 * len(s.offsets)};") and r["feature"].endswith(f"last={s.offsets[-1]}")
    assert len(got) == len(docs)


def test_pipeline(spark, docs):
    """The last stage's columns; which documents come so far, test_pipeline.py checks stage by stage."""
    enc, out = encoder(), corpus_pipeline.run(spark, SF).collect()
    texts = {i: t or "" for i, t, _ in docs}
    assert 0 < len(out) < len(docs) and len({r["doc_id"] for r in out}) == len(out)
    for r in out:
        text = enc.decode(list(r["token_ids"]))
        assert r["n_tokens"] == len(r["token_ids"]) and r["decoded_sha256"] == sha(text) and list(r["token_ids"]) == enc.encode_ordinary(text)
        lines = iter(texts[r["doc_id"]].split("\n"))  # lines may have gone, the others are as they were
        assert all(any(x == y for y in lines) for x in text.split("\n")) or text == ""
