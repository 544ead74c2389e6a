"""The corpus pipeline on the small tables, against plain Python where it can be said plainly."""

import os

import pytest

import corpus_pipeline
from quire.llm import bpe, decontam, quality
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver data not present")


def test_stages_and_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        sizes.append(after.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
            assert after.count() == after.select("doc_id").distinct().count()
        if name == "quality_rules":
            assert after.count() == quality.quality_measures(docs).filter("quality.kept").count()
        if name == "benchmark_decontamination":
            bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            assert decontam.contamination(after, bench, out="h").filter("size(h.spans) > 0").count() == 0
            texts = {r.doc_id: r.text for r in after.collect()}
        docs = after
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] >= sizes[4] == sizes[5] > 0
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.default_tokenizer())
    assert all(r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in docs.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(tuple, docs.collect()))


def test_a_filter_runs_no_stage_a_second_time(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for stage in (corpus_pipeline.repeated_passages, corpus_pipeline.decontamination):
        plan = stage(spark, docs, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython [") == 1  # two of them take two workers a task, which keep their memory
