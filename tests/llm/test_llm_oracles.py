"""Operators with DuckDB SQL against it, those without against brute force, on sf0.001."""

import brute
import pytest
from compare_oracle import compare
from conftest import SF_SMALL

from monthwise.llm import queries
from monthwise.llm.common import table

QUERIES, ORACLE = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck_small, name):
    r = compare(name, QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert r["schema"] and r["values"] and not r["type_mismatch"], r


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}


def test_names_cover_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_license_scan(spark, texts):
    for r in QUERIES["op2_license_scan"](spark, SF_SMALL).collect():
        n, places, labels = brute.license_base(texts[r.doc_id])
        words = [w for w, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            n, len(places), min(words, default=None), max(words, default=None), ",".join(labels))
        assert set(labels) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_token_counts(spark, texts):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    got = QUERIES["op3_token_counts"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_decontamination(spark, texts):
    items = {r.item_id: brute.norm(r.text) for r in table(spark, SF_SMALL, "benchmark").collect()}
    got = {(r.doc_id, r.item_id): r.edit_distance for r in QUERIES["op4_decontamination"](spark, SF_SMALL).collect()}
    exact = {(d, i) for d, t in texts.items() for i, item in items.items() if item in brute.norm(t)}
    assert {k for k, v in got.items() if v == 0} == exact and exact


def test_simhash(spark, texts):
    got = sorted(map(tuple, QUERIES["op8_simhash"](spark, SF_SMALL).select("doc_id", "fingerprint", "component_id").collect()))
    assert got == sorted(brute.simhash_components(list(texts.items())))
