"""The pipeline's stages, each against brute force on its own input, and run()."""

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from monthwise.llm import decontaminate, mixing
from monthwise.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Stage -> (rows in, rows out), on every second document of the smallest table twice over."""
    docs = table(spark, SF, "documents").where("doc_id % 2 = 0")
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10_001).withColumn(
        "source", F.concat("source", F.lit("x")))).repartition(3).cache()
    docs.count()
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        out[name] = (docs.collect(), after.collect(), docs.columns, after.columns)
        docs = after
    return out


def test_columns_stay(steps):
    for name, (_, _, before, after) in steps.items():
        assert after[:len(before)] == before
        assert name == "mixing" or after == before


def test_quality_keeps_clean_documents(spark, steps):
    before, after, *_ = steps["quality"]
    good = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after}
    judged = [(r.doc_id in kept, good[r.doc_id % 10_001]) for r in before if r.doc_id % 10_001 in good]
    assert all(k for k, y in judged if y == 1)
    assert sum(not k for k, y in judged if y == 0) >= 0.8 * sum(y == 0 for _, y in judged) > 0


def test_line_stage(steps):
    before, after, *_ = steps["line_dedup"]
    want = {d: (t, n) for d, t, n in brute.boilerplate([(r.doc_id, r.source, r.text) for r in before], 10)}
    got = {r.doc_id: r for r in after}
    for d, (text, gone) in want.items():
        if gone and not text.strip(" \t\r\n"):
            assert d not in got
        else:
            assert got[d].text == text and got[d].n_chars == (len(text) if gone else got[d].n_chars)
    assert len(after) == len(got)


def test_simhash_stage(steps):
    before, after, *_ = steps["simhash"]
    want = {c for _, _, c in brute.simhash_components([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before)


def test_decontamination_stage(spark, steps):
    before, after, *_ = steps["decontamination"]
    items = [brute.norm(r.text) for r in table(spark, SF, "benchmark").collect()]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    exact = {r.doc_id for r in before if any(i in brute.norm(r.text) for i in items)}
    assert exact <= gone and exact
    for r in before:
        if r.doc_id in gone - exact:
            line = brute.norm(r.text)
            assert any(brute.best_distance(i, line) <= int(len(i) * decontaminate.ERROR_RATE) for i in items)


def test_mixing_stage(steps):
    before, after, *_ = steps["mixing"]
    total = sum(r.tokens for r in after)
    available = sum(len(r.text.split()) for r in before)
    num, den = mixing.Mix().budget
    assert 0.5 * available * num / den < total <= available * num / den
    text = {r.doc_id: r.text for r in before}
    assert all(text[r.doc_id] == r.text for r in after)
    assert len({(r.doc_id, r.epoch) for r in after}) == len(after)


def test_run_is_the_stages_in_turn(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect())) and out.count() > 50


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
