"""What runs leave behind: nothing in the catalog, and in the shared folder what their results read."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterloom.llm import chunks, near_dup, queries
from rosterloom.sources import shared
from tests.llm.cases import documents

SF = "/root/testdata/sf0.001"


def there(spark):
    return set(shared.names_in(spark, shared._session_folder(spark)))


def tables(spark):
    return {t.name for t in spark.catalog.listTables()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_pipeline_leaves_its_result(spark):
    before, catalog = there(spark), tables(spark)
    out = corpus_pipeline.run(spark, SF)
    assert tables(spark) == catalog and {n.rsplit("-", 1)[0] for n in there(spark) - before} == {corpus_pipeline.STAGES[-1][0]} and out.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", ["op1_kn_quality", "op3_near_dup", "op8_byte_bpe"])
def test_queries_leave_no_table(spark, name):
    catalog = tables(spark)
    assert queries.queries()[name](spark, SF).count() and tables(spark) == catalog


def test_a_failing_stage_leaves_nothing(spark, monkeypatch):
    """A task that fails while chunks are written, and one after that."""
    before, catalog, since = there(spark), tables(spark), chunks.made()

    def broken(*a):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        chunks.chunk_table(documents(spark).select("doc_id", "text"), "text", broken, "n long")
    chunks.forget(spark, since)
    assert tables(spark) == catalog and there(spark) == before

    def stage(spark, docs, sf_dir):
        near_dup.near_duplicates(docs.select("doc_id", "text"))
        return docs.select(F.raise_error(F.lit("lost")).cast("string").alias("text"))

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("broken", stage)])
    monkeypatch.setattr(corpus_pipeline, "_table", lambda spark, *a: documents(spark))
    with pytest.raises(Exception, match="lost"):
        corpus_pipeline.run(spark, "")
    assert tables(spark) == catalog and {n for n in there(spark) - before if not n.startswith("broken")} == set()
