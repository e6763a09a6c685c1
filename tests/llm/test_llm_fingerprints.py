"""Operator 11 against a plain version: hashes, bins, densification, edits, order."""

import hashlib
import re
import statistics

import pytest
import xxhash
from conftest import SF_SMALL
from pyspark.sql import functions as F

from monthwise.llm import fingerprints as fp
from monthwise.llm import queries
from monthwise.llm.common import table

SIGN = 1 << 63


def signed(x):
    return x - (1 << 64) if x >= SIGN else x


def words(text):
    return re.split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\x0c\r"))


def plain(text, shingle=5):
    """The fingerprint's hex digits."""
    def chained(some):
        seed = 42
        for w in some:
            seed = xxhash.xxh64_intdigest(w.encode(), seed)
        return seed

    def rank(i, j):
        first = xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 42)
        return signed(xxhash.xxh64_intdigest(j.to_bytes(8, "little", signed=True), first) & ~15)

    w = words(text or "")
    least = {}
    for i in range(max(len(w) - shingle + 1, 1)):
        h = signed(chained(w[i:i + shingle]))
        least[h >> 56] = min(h, least.get(h >> 56, h))
    digits = []
    for i in range(fp.BINS):
        tried = [i, *[fp.probe(i, a) for a in range(fp.ROUNDS)]]
        found = next((least[b - 128] for b in tried if b - 128 in least), None)
        if found is None:
            found = least[min(least, key=lambda j: rank(i, j))]
        digits.append(f"{found & 15:x}")
    return "".join(digits)


def like(a, b):
    same = sum(x == y for x, y in zip(a, b)) / fp.BINS
    return max(0.0, (same - 1 / 16) / (15 / 16))


def expected(rows):
    """Result rows of (doc_id, text) rows whose order is fully given."""
    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text)
        edited = text[:n - n // 4] + after[:n // 4]
        a, b, c = plain(text), plain(edited), plain(after)
        out.append((doc, n, hashlib.sha256(edited.encode()).hexdigest(), a, b, round(like(a, b), 9), round(like(a, c), 9)))
    return out


def result(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
             round(r.near_next, 9)) for r in df.collect()]


def of(docs):
    return result(fp.with_edits(docs).select("*", fp.as_text(F.col("packed")).alias("fingerprint"),
                                             fp.as_text(F.col("edited_packed")).alias("edited_fingerprint")))


def test_query_against_plain(spark):
    texts = sorted((r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect())
    got = result(queries.op11_fingerprints(spark, SF_SMALL))
    assert sorted(got) == expected(texts)


def test_likeness_estimates_jaccard(spark):
    texts = sorted((r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect())

    def shingles(text):
        w = words(text)
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))}
    errors = []
    for (_, text), row in zip(texts, expected(texts)):
        n = len(text)
        after = texts[(row[0] + 1) % len(texts)][1]
        a, b = shingles(text), shingles(text[:n - n // 4] + after[:n // 4])
        errors.append(row[5] - len(a & b) / len(a | b))
    assert abs(statistics.mean(errors)) < 0.01 and max(map(abs, errors)) < 0.15


def test_edges(spark):
    long = "word " * 30_000 + "日本語 " * 1000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four five six seven"), (6, long), (7, "a😀b" * 9), (None, "last")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("h1", "id", "packed", "n_chars", "copies", "times"):
        df = df.withColumn(name, F.lit(1))
    assert sorted(of(df), key=str) == sorted(expected(rows), key=str)
    assert of(df.where("false")) == []
    assert of(df.where("doc_id = 5")) == expected([(5, "one two three four five six seven")])


def test_repeated_rows_and_ids(spark, monkeypatch):
    monkeypatch.setattr(fp, "CHUNK", 3)
    rows = [(1, "some words that stand in a row, in order")] * 8 + [(2, "another text of a few words")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(of(df))
    assert got == sorted(expected(rows)) and len(got) == 9          # seven are edited by their own beginning
    # one id, two texts: both follow each other, whichever comes first
    tied = of(spark.createDataFrame([(1, "a b c d"), (1, "e f g h")], "doc_id bigint, text string"))
    assert sorted(tied) == sorted(expected([(1, "a b c d"), (1, "e f g h")]))


def test_order_does_not_depend_on_the_split(spark):
    rows = [(i, f"text number {i} with some more words {i * i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(of(df.repartition(1))) == sorted(of(df.repartition(13))) == expected(rows)


def test_no_python_in_the_plan(spark):
    plan = fp.with_edits(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("bits", [(0, 0, 1.0), (0, -1, 0.0), (0x1, 0, None)])
def test_likeness(spark, bits):
    a, b, want = bits
    n = fp.BINS * fp.BITS // 64
    df = spark.range(1).select(fp.likeness(F.array(*[F.lit(a).cast("long")] * n), F.array(*[F.lit(b).cast("long")] * n)).alias("x"))
    got = df.first().x
    assert abs(got - (want if want is not None else (15 / 16 - 1 / 16) / (15 / 16))) < 1e-12
