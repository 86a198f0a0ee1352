"""Operators 11 to 13 by brute force, and on nulls, blanks, ties, repeats, empty tables and clashing columns."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterloom.llm import divergence as D
from rosterloom.llm import queries
from rosterloom.llm import toxicity as T
from rosterloom.llm import vector_codes as V
from tests.llm.cases import documents, nothing

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")

# toxicity -----------------------------------------------------------------------------------------

CLEAN = ["river", "stone", "window", "garden", "paper", "summer", "engine", "market", "silver", "winter"]


def toxic_corpus(n=400, seed=5):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [rng.choice(CLEAN) for _ in range(rng.randint(5, 30))]
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grumbler", "vexatious", "scoundrels", "gru"]))
        docs.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def model_of(spark, docs, labels):
    return T.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))


def test_index_is_exact(spark):
    """The nearest entries and cosines as by comparing with all of them, ties included, in small blocks."""
    docs, labels = toxic_corpus()
    model = model_of(spark, docs, labels)
    index = T.Index(model.index.entries, model.index.idf, block=4)
    assert index.blocks > 5

    def dense(vector):
        x = np.zeros(len(index.idf))
        t, w = index.weights(vector)
        x[t] = w
        return x

    all_ = np.stack([dense(e.vector) for e in index.entries])
    queries_ = [e.vector for e in index.entries] + [(), ((1, 3),), ((1, 1), (2, 7)), ((len(model.terms), 2),)]
    for q in queries_:
        cosine = np.round(all_ @ dense(q), 12)
        order = np.lexsort((np.arange(len(cosine)), -cosine))
        enough = np.searchsorted(np.cumsum(index.count[order]), T.NEAREST)
        low = cosine[order[min(enough, len(order) - 1)]]
        want = [i for i in order if cosine[i] >= low - 1e-11]
        at, got = index.nearest(q)
        assert got == pytest.approx(cosine[at], abs=1e-9) and set(at) == set(want) and all(a >= b for a, b in pairwise(got))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus()
    out = T.classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: t for i, _, t in labels}
    assert len(out) == len(docs)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in out if r["held_out"]]
    assert sum(p == t for p, t in held) >= 0.98 * len(held)
    tox = next(r for r in out if r["predicted"])
    assert tox["terms"] and tox["near"][0]["toxic"] > 0


def test_labels_of_held_out_rows_are_no_input(spark):
    docs, labels = toxic_corpus()
    key = lambda ls: [(r["score"], r["predicted"]) for r in T.classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame(ls, LABELS)).orderBy("doc_id").collect()]
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    assert key(labels) == key(turned)


def test_toxicity_of_odd_rows(spark):
    docs, labels = toxic_corpus()
    odd = [(1000, None, None, None, None), (None, "grumbler vexatious", None, None, None), (None, None, None, None, None), (1001, "", "en", "a", 0), (1002, "!!!", "en", "a", 0), (0, docs[0][1], "xx", "b", 9), (1003, "scoundrels " * 50_000, "de", "c", 1), (1004, "x" * 200_000, "de", "c", 1), (1005, "Grumbler VEXATIOUS", "de", "c", 1)]
    df = spark.createDataFrame(docs + odd, DOCS)
    clash = df.select("*", *(F.lit("own").alias(c) for c in ("id", "toxic", "score", "predicted", "near", "terms", "vector", "_id", "_toxic")))
    lab = spark.createDataFrame([*labels, (None, 1, 1), (0, 1, 0), (0, 1, None), (77777, 1, 1)], LABELS)
    rows = T.classify(clash, lab.withColumn("_id", F.lit("z"))).collect()
    assert len(rows) == len(docs) + len(odd)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert len({r["score"] for i in (1000, 1001, 1002, 1004) for r in by[i]}) == 1 and not by[1000][0]["predicted"]
    assert len({r["score"] for r in by[0]}) == 1 and len(by[0]) == 2 and len(by[None]) == 2 and not any(r["held_out"] for r in by[None])
    assert by[1005][0]["predicted"] == 1 and by[1005][0]["score"] == max(r["score"] for r in by[None]) and by[1003][0]["score"] > 0.5


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = toxic_corpus(20)
    out = T.classify(spark.createDataFrame(docs, DOCS), nothing(spark, LABELS)).collect()
    assert {(r["score"], r["predicted"], len(r["near"])) for r in out} == {(0.0, 0, 0)}
    assert T.classify(nothing(spark), spark.createDataFrame(labels, LABELS)).count() == 0
    calm = T.classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, q, 0) for i, q, _ in labels], LABELS)).collect()
    assert all(r["score"] < 0.1 for r in calm)


def test_isotonic():
    x, y = T.isotonic(np.array([0.1, 0.2, 0.3, 0.9]), np.array([0.0, 1.0, 0.0, 1.0]), np.array([10.0, 1.0, 1.0, 5.0]), 0.5)
    assert list(x) == sorted(x) and list(y) == sorted(y) and y[1] == pytest.approx((1 + 0.5) / 3)


@tables
def test_op11_toxicity(spark):
    """The registered query as its parts have it: terms counted plainly, scores by one model."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r for r in queries.queries()["op11_toxicity"](spark, SF).collect()}
    texts, toxic = {r["doc_id"]: r["text"] or "" for r in docs.collect()}, {r["doc_id"]: r["toxic"] for r in labels.collect()}
    learned = [i for i in texts if i in toxic and zlib.crc32(str(i).encode()) % 3 != 1]

    def terms(text):
        out = Counter()
        for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text)):
            out.update(([w] if len(w) <= 40 else []) + [w[:n] + "*" for n in (4, 5, 6, 7) if len(w) >= n])
        return out

    a, b = Counter(), Counter()
    for i in learned:
        (a if toxic[i] else b).update(set(terms(texts[i])))
    share = sum(toxic[i] for i in learned) / len(learned)
    chi = {t: (n - (n + b[t]) * share) ** 2 / ((n + b[t]) * share) for t, n in a.items() if n > (n + b[t]) * share}
    want = sorted((t for t, x in chi.items() if a[t] >= T.LEAST_TOXIC and x >= T.LEAST_CHI), key=lambda t: (-chi[t], t))[: T.TERMS]
    model = T.fit(docs, labels)
    assert sorted(model.terms) == sorted(want) and sum(e.count for e in model.index.entries) == len(learned) and set(rows) == set(texts)
    own = T.Terms(model.terms)
    for i, t in texts.items():
        vector = own.of(t)
        assert {model.terms[k - 1]: n for k, n in vector} == {k: n for k, n in terms(t).items() if k in set(want)}
        s = model.score(vector)[0]
        assert rows[i]["score"] == pytest.approx(s) and rows[i]["predicted"] == int(s >= 0.7) and rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)


# vector codes -------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Plain loops over Python's whole numbers."""
    kept = [(i, [math.floor(1024 * x) for x in v], k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    if not kept:
        return [], None
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in order[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for _, v, _ in kept:
                own[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for e, members in own.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out = []
    for i, v, k in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, k, tuple(e for _, e in found), sum(d for d, _ in found)))
    by = Counter()
    for _, k, _, e in out:
        by[k] += e
    return [(*r, by[r[1]]) for r in out], hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def vectors(n=150, width=12, seed=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.5) for _ in range(width)] for _ in range(7)]
    return [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], rng.choice([None, 1, 2])) for i in range(n)]


def codes(spark, rows, clash=False, **more):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    if clash:
        df = df.select("*", *(F.lit("own").alias(c) for c in ("id", "v", "code", "error", "label_error", "part", "entry", "n", "s0", "_n", "_label")))
    out, books = V.compress(df, **more)
    return sorted(((r["vec_id"], r["label"], tuple(r["code"]), r["error"], r["label_error"]) for r in out.collect()), key=str), books and V.books_sha256(books)


@pytest.mark.parametrize("entries", [5, 256])
def test_codes_by_brute_force(spark, entries):
    """Odd rows, repeats, ties, fewer vectors than entries, and names that clash."""
    nan, inf = float("nan"), float("inf")
    rows = vectors() + [(500, None, 1), (501, [None] * 12, 1), (502, [nan] + [0.0] * 11, 1), (503, [0.0] * 11 + [-inf], 2), (None, [0.25] * 12, None), (None, [0.125] * 12, 2), (3, [0.25] * 12, 1), (600, [-0.0001] * 12, 1), (601, [-1.5] * 6 + [1e-9] * 6, 7)]
    rows += [(700 + i, [0.25] * 12, 5) for i in range(60)]
    got, sha = codes(spark, rows, clash=True, entries=entries)
    want, want_sha = brute_codes(rows, entries=entries)
    assert got == sorted(want, key=str) and sha == want_sha


def test_codes_of_nothing(spark):
    assert codes(spark, []) == ([], None) and codes(spark, [(1, None, 1), (2, [None], 1)]) == ([], None)
    assert codes(spark, [(1, [0.5] * 4, None)]) == ([(1, None, (0, 0, 0, 0), 0, 0)], hashlib.sha256(b"512,512,512,512").hexdigest())


@pytest.mark.parametrize(("rows", "says"), [([(1, [0.0] * 6, 1)], "multiple of 4"), ([(1, [0.0] * 4, 1), (2, [0.0] * 8, 1)], "one length"), ([(1, [2e5] * 4, 1)], "131072 or more"), ([(1, [], 1)], "multiple of 4")])
def test_codes_that_cannot_be(spark, rows, says):
    with pytest.raises(Exception, match=says):
        codes(spark, rows)


def test_nearest_entries_at_the_limits():
    """Bounds rule nothing out wrongly: large values, equal entries, widths that segments don't divide."""
    rng = np.random.default_rng(1)
    for width, scale in ((1, 10), (3, 1000), (16, 300), (16, 1 << 27), (17, 1 << 26), (64, 5)):
        book = rng.integers(-scale, scale, (60, width))
        book[7] = book[3]
        x = np.concatenate([rng.integers(-scale, scale, (300, width)), book, book + 1])
        at, d = V.Book(book).nearest(x)
        all_ = ((x[:, None, :].astype(object) - book[None, :, :].astype(object)) ** 2).sum(axis=2)
        assert at.tolist() == [min(range(60), key=lambda j: (r[j], j)) for r in all_] and d.tolist() == [min(r) for r in all_]


def test_many_labels(spark, monkeypatch):
    monkeypatch.setattr(V, "MAX_SENT", 3)
    rows = [(i, v, i % 40 if i % 3 else None) for i, v, _ in vectors(120)]
    assert codes(spark, rows)[0] == sorted(brute_codes(rows)[0], key=str)


# divergence ---------------------------------------------------------------------------------------


def brute_audit(docs, least, top=50):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))) for text, lang, source in docs]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, ws in own for t in set(ws))
        kept = [t for t, n in df.items() if n >= least]
        n = {s: Counter(w for _, x, ws in own if x == s for w in ws if df[w] >= least) for s in {r[1] for r in own}}
        p = {s: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept} for s, c in n.items()}
        whole = sum(n.values(), Counter())
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole.values()) + 5 * len(kept)) for t in kept}
        for s in n:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in n if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if n[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, i) for i, (t, v) in enumerate(found[:most], 1)]
    return sorted(out)


def audited(df, **more):
    return sorted(tuple(r) for r in D.audit(df, **more).select("lang", "source", "part", "item", "value", "rank").collect())


def mixed(n=240, seed=8):
    rng = random.Random(seed)
    terms = ["Ab", "ab", "été", "Éx", "straße", "x1y", "one-two", "z" * 3000, "😀", *(f"w{chr(97 + i)}" for i in range(26))]
    return [(" ".join(rng.choice(terms) for _ in range(rng.randint(0, 40))), rng.choice(["en", "fr", None, ""]), rng.choice(["a", "é", None, "b", "Z"])) for _ in range(n)]


@pytest.mark.parametrize(("least", "cells", "held"), [(30, 1 << 20, 400_000), (10, 20, 10), (3, 7, 1)])
def test_audit_by_brute_force(spark, monkeypatch, least, cells, held):
    """In one tile and in many, with ties, and counts given out early."""
    monkeypatch.setattr(D, "CELLS", cells)
    monkeypatch.setattr(D, "HELD", held)
    docs = [*mixed(), (None, "en", "a"), (None, None, None), ("", "only", "one"), ("words but few", "de", "x"), ("other", "de", "y"), ("!!", "de", None)]
    df = spark.createDataFrame(docs, "text string, lang string, source string").repartition(5)
    assert audited(df, least=least, top=4) == brute_audit(docs, least, 4)
    clash = df.select("*", *(F.lit("own").alias(c) for c in ("term", "n", "docs", "value", "rank", "item", "part", "about", "a", "b", "tile", "own", "v")))
    if least == 10:
        assert audited(clash, least=least) == brute_audit(docs, least)


def test_counts_are_given_out_within_a_batch(monkeypatch):
    """What a task holds is bounded by terms, not by how many documents come at once."""
    monkeypatch.setattr(D, "HELD", 100)
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghij") + rng.choice("klmnopqrst") + rng.choice("uvwxyz") for _ in range(20)) for _ in range(300)]
    frame = type("Frame", (), {"mapInArrow": lambda self, run, schema: run})()
    given = list(D.counted(frame)(iter([pa.RecordBatch.from_pydict({"text": texts, "lang": ["en"] * 300, "source": ["a"] * 300})])))
    assert max(b.num_rows for b in given) <= 120
    n, docs = Counter(), Counter()
    for r in (r for b in given for r in b.to_pylist()):
        n[r["term"]] += r["n"]
        docs[r["term"]] += r["docs"]
    assert n == Counter(w for t in texts for w in t.split()) and docs == Counter(w for t in texts for w in set(t.split()))


def test_audit_of_repeats_and_nothing(spark):
    docs = [("same words here", "en", "a")] * 40 + [("same words there", "en", "b")] * 40
    assert audited(spark.createDataFrame(docs, "text string, lang string, source string")) == brute_audit(docs, 30)
    assert audited(nothing(spark)) == [] and len(audited(documents(spark, clash=True))) == len(audited(documents(spark)))


def test_shares_are_exact():
    for count, total in ((0, 7), (5, 5), (10**15, 9 * 10**15), (123456789, 987654321), (9 * 10**15 - 1, 9 * 10**15)):
        assert D.share(np.array([count]), total)[0] == 1 + 10**9 * count // total


@tables
def test_audit_of_the_tables(spark):
    docs = [(r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert audited(spark.read.parquet(f"{SF}/documents.parquet")) == brute_audit(docs, 30)
