"""The pipeline's stages on the smallest tables, each against its own input."""

import os
import re

import pytest

import corpus_pipeline
from rosterloom.llm import common
from tests.llm import cases
from tests.llm.test_corpus_operators import brute_classes
from tests.llm.test_text_operators import brute_hits

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda d: [tuple(r) for r in d.select(corpus_pipeline.COLUMNS).collect()]
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.written(stage(spark, seen[-1], SF))
        if i < 4:
            assert out.columns == corpus_pipeline.COLUMNS
        seen.append(out)
    start, good, lines, single, clean, ids = seen
    # quality: whole rows, most trusted ones
    assert set(rows(good)) <= set(rows(start))
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    left = {r[0] for r in rows(good)}
    assert len(trusted & left) >= 0.95 * len(trusted & {r[0] for r in rows(start)})
    # lines: no key in ten documents
    key = lambda x: re.sub("[A-Z]+", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    count: dict[str, int] = {}
    for r in rows(good):
        for k in {key(x) for x in r[1].split("\n")}:
            count[k] = count.get(k, 0) + 1
    want = {}
    for r in rows(good):
        kept = [x for x in r[1].split("\n") if not key(x) or count[key(x)] < 10]
        want[r[0]] = "\n".join(kept)
    assert {r[0]: r[1] for r in rows(lines)} == want and all(r[4] == len(r[1]) for r in rows(lines))
    # near copies: the least id of each class
    classes = brute_classes(rows(lines))
    assert sorted(r[0] for r in rows(single)) == sorted(min(map(int, c)) for c in classes)
    # benchmarks
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r[0] for r in rows(clean)} == {r[0] for r in rows(single) if not brute_hits(r[1], items, 10)[1]}
    assert sorted(r["doc_id"] for r in ids.collect()) == sorted(r[0] for r in rows(clean))


def test_stages_of_odd_and_no_documents(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (11, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, cases.PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (cases.documents(spark, clash=True), cases.nothing(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = common.written(stage(spark, docs, str(tmp_path)))
        assert docs.columns == ["doc_id", "n_tokens", "token_ids", "decoded_sha256"]


def test_stages_without_labels_or_benchmark(spark, tmp_path):
    """Nothing is rejected and nothing is hit; of ties and repeats the first one stays, each document whole."""
    cases.nothing(spark, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    cases.nothing(spark, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = cases.documents(spark)
    sizes, kept = [], None
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, str(tmp_path)))
        sizes.append(docs.count())
        kept = docs if name == "near_dedup" else kept
    assert sizes[0] == sizes[1] == len(cases.ROWS) and sizes[2] == sizes[3] == sizes[4] < len(cases.ROWS)
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and ids.count(9) + ids.count(10) == 1 and ids.count(11) == 1


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "token_ids", "decoded_sha256"]
