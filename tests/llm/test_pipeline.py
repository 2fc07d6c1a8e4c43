"""The pipeline against a brute-force version of its stages."""

import os

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from fundlake.llm import pii, toxicity
from fundlake.llm.common import tokenizer_path
from tests.llm.test_similar import components, slow_print

SF = "/root/testdata/sf0.001"


def test_registered_queries():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 4


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_run_equals_the_stages_by_hand(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    windows = None if model.constant is not None else toxicity.Windows(model.ordinary, model.toxic, model.settings)
    rows = [r for r in docs.collect() if windows is None or toxicity.score_text(windows, model, (r.text or "").encode()) < 0.5]
    prints = [slow_print(r.text) for r in rows]
    comp = components(prints, [r.doc_id for r in rows], 2)
    rows = [r for i, r in enumerate(rows) if r.doc_id == comp[i]]
    tok = Tokenizer.from_file(tokenizer_path())
    want = {r.doc_id: len(tok.encode(pii.replaced(r.text or "", pii.DEFAULT_KEY)[0], add_special_tokens=False).ids) + 1 for r in rows}
    pieces = corpus_pipeline.run(spark, SF).collect()
    got = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
        assert len(p.ids) == 4 * p.length and np.frombuffer(p.ids, "<u4").max() < 50257
    assert got == want


def test_stages_keep_the_columns_of_documents(spark, empty):
    from pyspark.sql import functions as F

    docs = empty.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES[1:3]:
        out = stage(spark, docs, SF)
        assert out.columns == list(corpus_pipeline.DOCUMENTS) and out.count() == 0
