import corpus_pipeline
from mastermill.llm.decontaminate import Matcher, normal
from mastermill.llm.line_dedup import dedup_lines
from mastermill.llm.quality import fit_quality, rate_quality
from tests.llm.test_dedup import brute_lines, components, shingle_set

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in rate_quality(docs, fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))).filter("quality.kept").collect()}
    good = stages["quality"](spark, docs, SF).cache()
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept
    cut = stages["line_dedup"](spark, good, SF).cache()
    want = {d: x for d, x in brute_lines(sorted((r.doc_id, r.text) for r in good.collect())).items() if x[2]}
    assert cut.columns == docs.columns and {r.doc_id: r.text for r in cut.collect()} == {d: x[0] for d, x in want.items()}
    near = stages["near_dedup"](spark, cut, SF).cache()
    groups = components({r.doc_id: shingle_set(r.text, 5) for r in cut.collect()}, 80)
    assert near.columns == docs.columns and {r.doc_id for r in near.collect()} == set(groups.values())
    matcher = Matcher([(r.item_id, normal(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()], 0.06)
    clean = stages["decontamination"](spark, near, SF).cache()
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in near.collect() if not matcher.matches(normal(r.text))}
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in whole} == {r.doc_id for r in clean.collect()}
    for r in whole:
        assert 0 < r.length <= 2048 and r.offset + r.length <= 2048


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
    assert dedup_lines(docs).count() == 0
