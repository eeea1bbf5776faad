"""The stages of the pipeline send whole texts to Python in batches bounded in bytes."""

from __future__ import annotations

import pyarrow as pa
import pytest

import corpus_pipeline
from journeylens.runtime import bound_batches

BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = spark.conf.get(BOUND)
    spark.conf.unset(BOUND)
    yield
    spark.conf.set(BOUND, before)


def test_no_batch_holds_all_texts(spark, monkeypatch, unset):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    docs = spark.range(0, 400, 1, 1).selectExpr("id as doc_id", "repeat('word ', 10000) as text")
    monkeypatch.setattr(corpus_pipeline.packing, "pack_documents", lambda docs, path: docs.mapInArrow(sizes, "n long"))
    sent = [r.n for r in corpus_pipeline.packing_stage(spark, docs, "").collect()]
    assert sum(sent) > 400 * 50_000 and max(sent) < 5 << 20


def test_a_bound_of_the_session_stays(spark, unset):
    spark.conf.set(BOUND, "1m")
    bound_batches(spark)
    assert spark.conf.get(BOUND) in ("1m", f"{1 << 20}b")
