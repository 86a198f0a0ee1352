"""Quality, near copies and repeated passages against brute force."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterloom.llm import chunks, common, kn_quality, near_dup, suffix_dedup
from rosterloom.llm.graph import components
from tests.llm import cases

SMALL = 20_000  # chunks of some documents


def words(t):
    return re.findall(common.WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))


# hashing and packing


def test_words_of_bytes():
    texts = ["Ab1 cd!", "", "É ab1", "!!"]
    h, start, end, owner = common.words_of([t.encode() for t in texts])
    joined = b"\n".join(t.encode() for t in texts)
    assert [joined[a:b].decode() for a, b in zip(start, end)] == ["Ab1", "cd", "É", "ab1"] and owner.tolist() == [0, 0, 2, 2]
    assert h[0] == h[3] and len(set(h.tolist())) == 3


def test_packing():
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64))
    assert (chunks.unrising(chunks.rising(x)) == x).all() and len(chunks.unrising(chunks.rising(x[:0]))) == 0
    t = pa.table({"a": [1, None], "b": ["x", None]})
    assert chunks.unpack(chunks.pack(t)).equals(t)


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 101), (101, 102), (100, 102), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(21)} | {i: 100 for i in (100, 101, 102)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# quality


def brute_kn(trusted, n=4):
    """Interpolated modified Kneser-Ney of characters, from counts in dictionaries."""
    pad = lambda t: kn_quality.START * (n - 1) + t + kn_quality.END
    counts = {n: Counter(pad(t)[i : i + n] for t in trusted for i in range(len(t) + 1))}
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {k: kn_quality.modified_discounts(*(sum(v == i for v in c.values()) for i in (1, 2, 3, 4))) for k, c in counts.items()}
    cut = lambda k, c: d[k][min(c, 3) - 1] if c else 0.0
    total, weight = defaultdict(int), defaultdict(float)
    for k, c in counts.items():
        for g, v in c.items():
            total[k, g[:-1]] += v
            weight[k, g[:-1]] += cut(k, v)

    def p(g):
        k = len(g)
        lower = 1 / (len(counts[1]) + 1) if k == 1 else p(g[1:])
        h = (k, g[:-1])
        return lower if not total[h] else (counts[k][g] - cut(k, counts[k][g])) / total[h] + weight[h] / total[h] * lower

    return lambda t: -sum(math.log(p(pad(t)[i : i + n])) for i in range(len(t) + 1)) / (len(t) + 1)


@pytest.mark.parametrize("clash", [False, True])
def test_perplexity(spark, clash):
    docs = cases.documents(spark, clash)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 1, 0), (11, 1, None), *((i, 1, 0) for i in range(100, 108)), (5, 1, 1), (9, 0, 0), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    out = kn_quality.classify(docs, labels, max_sent=0 if clash else 100)
    split = {r["__rl_id"]: r["__rl_counted"] for r in kn_quality.held_out(kn_quality.trusted_ids(labels)).collect()}
    assert set(split) == {1, 4, 11, *range(100, 108)} and 0 < sum(split.values()) < len(split)
    value = brute_kn([r[1] for r in cases.ROWS if split.get(r[0])])
    got = sorted(((r["doc_id"], r["perplexity"]) for r in out.collect()), key=str)
    want = sorted(((r[0], math.exp(value(r[1])) if r[1] else None) for r in cases.ROWS), key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        assert g[1] == pytest.approx(w[1], rel=1e-4) if w[1] is not None else g[1] is None
    kept = kn_quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == out.where("accepted").count()
    assert {r["doc_id"] for r in kept.collect()} >= {6, 7, None}


def test_quantiles_are_by_language(spark):
    rows = [(0, i, i, "en" if i < 200 else "xx" if i < 205 else None, True, float(i)) for i in range(400)]
    scores = spark.createDataFrame(rows, "chunk long, nth long, id long, lang string, trusted boolean, value double")
    got = {r["lang"]: r["threshold"] for r in kn_quality.thresholds(scores, 0.9).collect()}
    # each has one of its own: what lies above its median is drawn to that of all by its number
    steps = {"en": list(range(200)), "xx": list(range(200, 205)), None: list(range(205, 400))}
    at = lambda x, q: sorted(x)[math.ceil(len(x) * q) - 1]
    spread = at([v - at(x, 0.5) for x in steps.values() for v in x], 0.9)
    for lang, x in steps.items():
        assert got[lang] == pytest.approx(at(x, 0.5) + (len(x) * (at(x, 0.9) - at(x, 0.5)) + 100 * spread) / (len(x) + 100), abs=1)


def test_many_characters_and_marks_in_texts(spark):
    wide = "".join(map(chr, [*range(0x20, 0xD800), *range(0x10000, 0x10000 + 11_000)]))
    rows = [(1, wide), (2, f"plain {kn_quality.START}text{kn_quality.END}"), (3, "plain \ufffdtext\ufffd"), (4, "\x02plain\x03 text")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").coalesce(1)
    ids = [i for i in range(1, 9) if kn_quality.held_out(spark.createDataFrame([(i,)], "__rl_id long")).first()["__rl_counted"]]
    labels = spark.createDataFrame([(i, 1, 0) for i in ids], "doc_id long, quality int, toxic int")
    value = brute_kn([t.replace(kn_quality.START, "\ufffd").replace(kn_quality.END, "\ufffd") for i, t in rows if i in ids])
    got = {r["doc_id"]: r["perplexity"] for r in kn_quality.classify(docs, labels).collect()}
    assert len(wide) > 1 << 16 and got[2] == got[3] != got[4]
    for i, t in rows[2:]:
        assert got[i] == pytest.approx(math.exp(value(t)), rel=1e-4)


def test_quality_of_nothing(spark):
    none = cases.nothing(spark, "doc_id long, quality int, toxic int")
    assert kn_quality.classify(cases.nothing(spark), none).count() == 0
    out = kn_quality.classify(cases.documents(spark), none)
    assert out.count() == len(cases.ROWS) and out.where("NOT accepted OR threshold IS NOT NULL").count() == 0


# near copies


def brute_classes(rows, least=0.8):
    sets = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := words(r[1])) else None for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    df = Counter(s for x in sets if x for s in x)
    n = len(rows)
    w = lambda x: {s: c * (1 + near_dup.IDF * math.log((n + 1) / (df[s] + 1)) / math.log(n + 1)) for s, c in x.items()}
    for i in range(n):
        for j in range(i):
            if not sets[i] and not sets[j] and (rows[i][1] or "") == (rows[j][1] or ""):
                root[find(i)] = find(j)
            if sets[i] and sets[j]:
                a, b = w(sets[i]), w(sets[j])
                both = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
                if both / (sum(a.values()) + sum(b.values()) - both) >= least:
                    root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(n):
        groups[find(i)].append(rows[i][0])
    return Counter(tuple(sorted(map(str, g))) for g in groups.values())


@pytest.mark.parametrize("tile, clash", [(256, False), (2, True)])
def test_near_duplicates(spark, tile, clash):
    docs = cases.documents(spark, clash)
    _, rows = near_dup.near_duplicates(docs, tile=tile, chunk_bytes=SMALL)
    got = defaultdict(list)
    for i, r in enumerate(rows.collect()):
        got[r["class_id"] if r["class_size"] > 1 else ("alone", i)].append(str(r["id"]))
    assert Counter(tuple(sorted(g)) for g in got.values()) == brute_classes(cases.ROWS)
    kept = near_dup.keep_one(docs, chunk_bytes=SMALL)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[1] == 1 and 2 not in ids and 3 not in ids and ids[6] == 1 and 7 not in ids and ids[8] == 1 and ids[9] + ids[10] == 1
    if clash:
        assert {r["chunk"] for r in kept.select("chunk").collect()} == {"own chunk"}


def test_a_large_group_is_compared_in_tiles(spark):
    base = cases.words(120).split()
    rows = []
    for i in range(60):
        w = list(base)
        w[(i * 7) % 120] = f"edit{i}"
        rows.append((i, " ".join(w), "en", "a", 1))
    _, out = near_dup.near_duplicates(spark.createDataFrame(rows, cases.SCHEMA), tile=8)
    got = defaultdict(list)
    for r in out.collect():
        got[r["class_id"]].append(str(r["id"]))
    assert Counter(tuple(sorted(g)) for g in got.values()) == brute_classes(rows)


def test_chained_candidates_stay_apart(spark):
    """A chain of 5000 contents, each in a bucket with the next and unlike it: rows and comparisons follow their number."""
    def signed(members, text):
        rows = []
        for i, bands in enumerate(members):
            prints = np.sort(np.unique(np.array([hash_of(w) for w in text(i)], np.uint64)))
            rows.append((str(i).encode(), bands, near_dup.rising(prints), np.ones(len(prints), np.float32).tobytes()))
        return spark.createDataFrame(rows, "content binary, bands array<long>, prints binary, weights binary")

    hash_of = lambda w: int(common.mix(np.array([w + 1], np.uint64))[0] >> np.uint64(8))
    chain = near_dup._classes(signed([[i, i + 1] for i in range(5000)], lambda i: range(50 * i, 50 * i + 50)), 0.8, 256)
    assert chain.count() == 0
    # one bucket: 40 unlike contents, and 20 pairs of like ones that no leader joins
    text = lambda i: range(1000 * (i % 40), 1000 * (i % 40) + 60 - (i >= 40))
    got = near_dup._classes(signed([[7]] * 60, text), 0.8, 8, leaders=1)
    groups = defaultdict(set)
    for r in got.collect():
        groups[bytes(r["label"])].add(int(r["content"]))
    assert sorted(map(sorted, groups.values())) == [[i, i + 40] for i in range(20)]


def test_samples_agree_as_often_as_sets_do():
    g = np.random.default_rng(3)
    prints = g.integers(0, 2**62, 400).astype(np.uint64)
    a, b = np.sort(prints[:300]), np.sort(prints[100:])
    w = {int(p): x for p, x in zip(prints, g.uniform(1, 4, 400))}
    wa, wb = np.array([w[int(p)] for p in a], np.float32), np.array([w[int(p)] for p in b], np.float32)
    s = near_dup.samples(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, 300]), 2000)
    both = sum(w[int(p)] for p in prints[100:300])
    assert (s[0] == s[1]).mean() == pytest.approx(both / (wa.sum() + wb.sum() - both), abs=0.04)


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(cases.nothing(spark))[1].count() == 0 and near_dup.keep_one(cases.nothing(spark)).count() == 0


# repeated passages


def brute_passage_classes(rows, least=50):
    """The ids of each class of documents that share a passage, at one or more removes."""
    root, seen = list(range(len(rows))), {}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for d, r in enumerate(rows):
        w = words(r[1])
        for i in range(len(w) - least + 1):
            root[find(d)] = find(seen.setdefault(tuple(w[i : i + least]), d))
    groups = defaultdict(list)
    for d, r in enumerate(rows):
        groups[find(d)].append(str(r[0]))
    return Counter(tuple(sorted(g)) for g in groups.values())


def classes_of(out):
    got = defaultdict(list)
    for i, r in enumerate(out):
        got[r["class_id"] if r["class_size"] > 1 else ("alone", i)].append(str(r["doc_id"]))
    assert all(len(g) == r["class_size"] for r in out for k, g in got.items() if k == r["class_id"] and r["class_size"] > 1)
    return Counter(tuple(sorted(g)) for g in got.values())


def brute_repeats(rows, least=50):
    where = defaultdict(set)
    ws = [words(r[1]) for r in rows]
    for d, w in enumerate(ws):
        for i in range(len(w) - least + 1):
            where[tuple(w[i : i + least])].add(d)
    out = Counter()
    for d, w in enumerate(ws):
        hit = set()
        for i in range(len(w) - least + 1):
            if len(where[tuple(w[i : i + least])]) > 1:
                hit |= set(range(i, i + least))
        out[str(rows[d][0]), str(len(w)), str(len(hit))] += 1
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 4])
@pytest.mark.parametrize("clash", [False, True])
def test_repeats(spark, clash, hot):
    out = suffix_dedup.repeats(cases.documents(spark, clash), hot=hot, chunk_bytes=SMALL)
    assert Counter((str(r["doc_id"]), str(r["n_words"]), str(r["n_repeated"])) for r in out.collect()) == brute_repeats(cases.ROWS)
    by = {r["doc_id"]: r for r in out.collect()}
    assert [tuple(s) for s in by[5]["spans"]] == [(90, 150)]
    assert classes_of(out.collect()) == brute_passage_classes(cases.ROWS)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 4])
def test_passages_of_the_least_length_and_across_partitions(spark, hot):
    p = cases.words(51)
    rows = [(i, f"{cases.words(40)} {p} {cases.words(5 + i % 7)}", "en", "a", 1) for i in range(40)] + [(90, cases.words(49), "en", "a", 1), (91, "go " * 70, "en", "a", 1), (92, "go " * 80, "en", "a", 1)]
    out = suffix_dedup.repeats(spark.createDataFrame(rows, cases.SCHEMA).repartition(5), hot=hot, chunk_bytes=3000)
    assert Counter((str(r["doc_id"]), str(r["n_words"]), str(r["n_repeated"])) for r in out.collect()) == brute_repeats(rows)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 4])
def test_groups_and_links_beyond_the_neighbours(spark, hot):
    # 40 documents share a seed of 16 words; 19 have the right of document 0, 19 its left, one a shorter part of both
    pick, core = random.Random(13), own_words(random.Random(14), 16)
    left, right = own_words(pick, 30), own_words(pick, 30)
    rows = [(0, [*own_words(pick, 20), *left, *core, *right])]
    rows += [(i, [*own_words(pick, 50), *core, *right, *own_words(pick, 9)]) for i in range(1, 20)]
    rows += [(i, [*left, *core, *own_words(pick, 40)]) for i in range(20, 39)]
    rows += [(39, [*own_words(pick, 30), *left[-24:], *core, *right[:24], *own_words(pick, 9)])]
    group = own_words(pick, 120)
    rows += [(100 + i, [*own_words(pick, 3 + i), *group[i : i + 80], *own_words(pick, 5)]) for i in range(30)]
    rows = [(i, " ".join(w), "en", "a", 1) for i, w in rows]
    got = suffix_dedup.repeats(spark.createDataFrame(rows, cases.SCHEMA).repartition(3), hot=hot, chunk_bytes=4000).collect()
    assert Counter((str(r["doc_id"]), str(r["n_words"]), str(r["n_repeated"])) for r in got) == brute_repeats(rows)
    assert classes_of(got) == brute_passage_classes(rows) and {r["n_repeated"] for r in got if r["doc_id"] in (0, 39)} == {64}


def test_minimisers_are_in_every_window():
    g = np.random.default_rng(5).integers(1, 2**60, 500).astype(np.uint64)
    owner = np.repeat([0, 1], 250)
    keep = suffix_dedup.minimisers(g, owner, 42)
    for s in (0, 250):
        assert all(keep[s + i : s + i + 42].any() and keep[s + i + int(g[s + i : s + i + 42].argmin())] for i in range(250 - 41))
    assert keep.mean() < 0.1


def test_repeats_of_nothing(spark):
    assert suffix_dedup.repeats(cases.nothing(spark)).count() == 0


# what is rejected


def test_quantiles_are_by_length(spark):
    # tiny texts spread up to 3, full ones up to 2: the tail of the tiny ones doesn't set the limit of the full ones
    rows = [(i, "en", i < 4000, i % 4 == 0 and i < 4000, 3 if i % 10 == 0 else 10, (3.0 if i % 10 == 0 else 2.0) - (i % 7) / 10) for i in range(4400)]
    scores = spark.createDataFrame(rows, "id long, lang string, trusted boolean, measured boolean, band long, value double")
    got = {(r["lang"], r["band"]): r["threshold"] for r in kn_quality.thresholds(scores).collect()}
    assert got["en", 10] == pytest.approx(2.0, abs=0.01) and got["en", 3] == pytest.approx(3.0, abs=0.01)


def test_held_out_ids_are_measured_alone(spark):
    few, many = (kn_quality.held_out(spark.range(n).withColumnRenamed("id", "__rl_id")).collect() for n in (40, 2000))
    assert all(r["__rl_counted"] != r["__rl_held"] for r in [*few, *many]) and 400 <= sum(r["__rl_held"] for r in many) <= 600


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no tables")
def test_share_of_labelled_documents_rejected(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = kn_quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    kind = F.expr("CASE WHEN quality = 1 AND toxic = 0 THEN 'clean' WHEN toxic = 1 THEN 'toxic' ELSE 'bad' END")
    share = {r["kind"]: r["x"] for r in out.join(labels, "doc_id").groupBy(kind.alias("kind")).agg(F.avg((~F.col("accepted")).cast("int")).alias("x")).collect()}
    assert share["bad"] >= 0.93 and share["toxic"] >= 0.4 and share["clean"] <= 0.015


def own_words(pick, n):
    return [f"w{pick.randrange(10**9)}" for _ in range(n)]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 4])
def test_passages_around_a_common_core(spark, hot):
    # the retained position lies in the core that many have; the partner that shares both sides is often no neighbour
    pick, rows = random.Random(11), []
    for _ in range(3):
        core, lefts, rights = own_words(pick, 30), [own_words(pick, 12) for _ in range(20)], [own_words(pick, 12) for _ in range(20)]
        rows += [(i, " ".join([*own_words(pick, 5), *pick.choice(lefts), *core, *pick.choice(rights), *own_words(pick, 5)]), "en", "a", 1) for i in range(len(rows), len(rows) + 300)]
    out = suffix_dedup.repeats(spark.createDataFrame(rows, cases.SCHEMA).repartition(3), hot=hot, chunk_bytes=50_000)
    got = out.collect()
    assert Counter((str(r["doc_id"]), str(r["n_words"]), str(r["n_repeated"])) for r in got) == brute_repeats(rows)
    assert all((r["class_size"] > 1) == bool(r["n_repeated"]) for r in got) and classes_of(got) == brute_passage_classes(rows)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 4])
def test_a_passage_twice_in_one_document_is_no_span(spark, hot):
    # others hold less than a span of it, and sort between its two places
    pick, rows = random.Random(12), []
    for _ in range(12):
        p = own_words(pick, 60)
        rows.append((len(rows), " ".join([*p, *own_words(pick, 30), *p, *own_words(pick, 30)]), "en", "a", 1))
        rows += [(i, " ".join([*own_words(pick, 30), *p[15:], *own_words(pick, 30)]), "en", "a", 1) for i in range(len(rows), len(rows) + 3)]
    out = suffix_dedup.repeats(spark.createDataFrame(rows, cases.SCHEMA), hot=hot)
    assert Counter((str(r["doc_id"]), str(r["n_words"]), str(r["n_repeated"])) for r in out.collect()) == brute_repeats(rows)
