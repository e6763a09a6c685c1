"""Operator 13 against plain counts (its query's SQL is compared in test_llm_oracles)."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from monthwise.llm import divergence

DOCS = "doc_id bigint, text string, lang string, source string"


def plain(rows, min_df, alpha=5, scale=10**9, top=50):
    def terms(text):
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", folded)
    rows = [(lang or "", source or "", Counter(terms(text))) for _, text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        df = Counter(t for x, _, c in rows if x == lang for t in c)
        kept = sorted(t for t, n in df.items() if n >= min_df)
        groups = {}
        for x, source, c in rows:
            if x == lang:
                groups.setdefault(source, Counter()).update({t: n for t, n in c.items() if df[t] >= min_df})

        def shares(c):
            total = sum(c.values()) + alpha * len(kept)
            return {t: 1 + scale * (c[t] + alpha) // total for t in kept}
        own = {s: shares(c) for s, c in groups.items()}
        whole = shares(sum(groups.values(), Counter()))
        for s, p in own.items():
            pairs = [(o, sum(abs(p[t] - q[t]) for t in kept)) for o, q in own.items() if o != s]
            over = [(t, p[t] - whole[t]) for t in kept if groups[s][t] > 0 and p[t] > whole[t]]
            for part, items, last in (("pair", pairs, None), ("term", over, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(items[:last])]
    return sorted(out)


ROWS = [
    (1, "The cat, the DOG; the émigré-Élan", "en", "a"), (2, "the dog the dog 99 cat's", "en", "b"), (3, "A cat. The end", "en", "b"),
    (4, None, "en", "c"), (5, "", None, None), (6, "...!? 12", None, "x"), (7, "über Straße über", "de", "a"), (7, "über Straße über", "de", "a"),
    (None, "straße ÜBER über", "de", "b"), (8, "dog " * 20_000 + "tail", "en", "a"), (9, "日本語 the\x00the", "en\x00x", "a"), (10, "日本語", "en\x00x", "b"),
]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("slice_terms", [6_000_000, 3000])
def test_against_plain(spark, slice_terms):
    df = spark.createDataFrame(ROWS, DOCS)
    for name in ("grp", "term", "terms", "p", "n", "vector", "rank"):
        df = df.withColumn(name, F.lit(1))
    assert got(divergence.audit(df, min_df=2, top=3, slice_terms=slice_terms)) == plain(ROWS, 2, top=3)


def test_shares_of_terms(spark):
    for r in divergence.audit(spark.createDataFrame(ROWS, DOCS), min_df=2).where("part = 'term'").collect():
        assert r.value == r.p - r.q > 0


def test_no_kept_term_and_empty(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    out = got(divergence.audit(df, min_df=100))
    assert out == plain(ROWS, 100) and {r[4] for r in out} == {0} and {r[2] for r in out} == {"pair"}
    assert divergence.audit(df.where("false")).count() == 0


def test_large_counts_stay_exact(spark):
    n, total, v = 10**13, 3 * 10**13 + 7, 10**6
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(v), 5, 10**9).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * v)
