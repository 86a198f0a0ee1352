"""How many of the pairs that brute force finds MinHash near-dedup finds, by similarity; the table in README.md is this test's."""

import math
import random
from collections import Counter

import pytest

from rosterloom.llm import near_dup
from tests.llm.cases import SCHEMA

LEVELS = (0.80, 0.82, 0.85, 0.90, 1.0)


def pairs(n=120, seed=11):
    """Pairs of texts of 150 to 400 words that differ in some words, spread so that similarities are from 0.78 to 0.97."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    for _ in range(n * 4):
        a = [word() for _ in range(rng.randint(150, 400))]
        b = list(a)
        for at in rng.sample(range(len(a)), max(1, round(len(a) * rng.uniform(0.003, 0.026)))):
            b[at] = word()
        yield a, b


def shingles(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def similarity(a, b, df, n, idf):
    weight = lambda s: 1 + idf * math.log((n + 1) / (df[s] + 1)) / math.log(n + 1)
    both = sum(min(a[s], b[s]) * weight(s) for s in a.keys() & b.keys())
    return both / (sum(c * weight(s) for x in (a, b) for s, c in x.items()) - both)


@pytest.mark.parametrize("idf", [near_dup.IDF, 1.0])
def test_recall_by_similarity(spark, idf):
    made = list(pairs())
    rows = [(2 * i + k, " ".join(x), "en", "a", 1) for i, p in enumerate(made) for k, x in enumerate(p)]
    _, out = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    classes = {r["id"]: r["class_id"] for r in out.collect()}
    sets = [(shingles(a), shingles(b)) for a, b in made]
    df = Counter(s for p in sets for x in p for s in x)
    found, wrong, table = Counter(), 0, Counter()
    for i, (a, b) in enumerate(sets):
        s = similarity(a, b, df, len(rows), idf)
        same = classes[2 * i] == classes[2 * i + 1]
        if s >= LEVELS[0]:
            level = max(x for x in LEVELS[:-1] if s >= x)
            table[level] += 1
            found[level] += same
        elif idf == near_dup.IDF:
            wrong += same
    print({level: (found[level], table[level]) for level in LEVELS[:-1]})
    assert all(table[x] >= 20 and found[x] >= 0.95 * table[x] for x in LEVELS[:-1]) and not wrong
