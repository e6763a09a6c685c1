"""The line stage leaves input columns alone that carry the operator's names."""

import corpus_pipeline


def test_own_counts_stay(spark):
    rows = [(d, f"s{d}", f"common line\nown line {d}", 5, d + 100, "x", d + 200) for d in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, n_chars bigint, n_lines bigint, "
                                       "__own_n_lines string, N_Removed bigint")
    out = corpus_pipeline.line_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [rows[0]] + [
        (d, s, f"own line {d}", len(f"own line {d}"), a, b, c) for d, s, _, _, a, b, c in rows[1:]]
