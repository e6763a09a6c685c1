"""Operator 12 against plain Lloyd rounds in Python integers."""

import hashlib
import math

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from monthwise.llm import queries
from monthwise.llm import vector_codes as vc
from monthwise.llm.common import table

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{row place: (code, error)}, codebooks; rows of (id, vector) in the order of ids."""
    x = [[[math.floor(scale * v) for v in vec[p * len(vec) // parts:(p + 1) * len(vec) // parts]] for p in range(parts)] for _, vec in rows]
    books = [[v[p] for v in x[:entries]] for p in range(parts)]

    def best(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in x:
                groups.setdefault(best(v[p], books[p])[1], []).append(v[p])
            for i, some in groups.items():
                books[p][i] = [sum(c) // len(some) for c in zip(*some)]
    found = [[best(v[p], books[p]) for p in range(parts)] for v in x]
    return [([i for _, i in f], sum(d for d, _ in f)) for f in found], books


def test_query_against_plain(spark):
    rows = sorted((r.vec_id, r.embedding, r.label) for r in table(spark, SF_SMALL, "embeddings").collect())
    codes, books = plain([r[:2] for r in rows])
    sums = {}
    for (_, _, label), (_, error) in zip(rows, codes):
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    want = [(i, "".join(f"{c:02x}" for c in code), error, sums[label], digest) for (i, _, label), (code, error) in zip(rows, codes)]
    assert sorted(map(tuple, queries.op12_vector_codes(spark, SF_SMALL).collect())) == want


def test_pivots_prune_and_change_nothing(spark):
    vectors = table(spark, SF_SMALL, "embeddings")
    one, fitted = vc.encode(vectors, n_pivots=1)
    more, other = vc.encode(vectors, n_pivots=6)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, more.collect()))
    assert (fitted.books == other.books).all()
    assert max(other.shares) < max(fitted.shares) < 1.0          # fewer exact evaluations with more pivots


def test_bounds_keep_ties():
    book = np.array([[3, 0], [0, 3], [0, -3], [-3, 0]])
    part = np.array([[0, 0], [1, 1], [-2, 0], [0, -1]])
    pivots = book[:2]
    far = np.sqrt(((part[:, None] - pivots[None]) ** 2).sum(-1))
    gaps = np.sqrt(((pivots[:, None] - book[None]) ** 2).sum(-1))
    at, best, _ = vc.nearest(part, far, book, gaps)
    assert at.tolist() == [0, 0, 3, 2] and best.tolist() == [9, 5, 1, 4]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    ok = [(5, [0.5] * 8, 1), (None, [0.25] * 8, None), (2, [-0.1] * 8, None), (2, [-0.1] * 8, 1), (9, [0.75, *[0.0] * 7], 3)]
    bad = [(1, None, 1), (3, [], 1), (4, [nan] * 8, 1), (6, [inf, *[0.0] * 7], 1), (7, [None, *[0.0] * 7], 1), (8, [0.5] * 16, 1)]
    df = spark.createDataFrame(ok + bad, SCHEMA).withColumns({"code": F.lit(1), "error": F.lit(2), "far": F.lit(3), "vec": F.lit(4)})
    out, fitted = vc.encode(df)
    order = sorted(((i, [np.float32(x) for x in v], label) for i, v, label in ok), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    codes, books = plain([(i, list(map(float, v))) for i, v, _ in order])
    assert fitted.books.tolist() == books and fitted.books.shape == (8, 5, 1)
    sums = {}
    for (_, _, label), (_, error) in zip(order, codes):
        sums[label] = sums.get(label, 0) + error
    want = [(i, label, code, error, sums[label]) for (i, _, label), (code, error) in zip(order, codes)]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    none, nothing = vc.encode(df.where("false"))
    assert none.count() == 0 and nothing is None
    assert vc.encode(df.where("vec_id in (1, 3, 4)"))[0].count() == 0
    with pytest.raises(Exception, match="cannot be cut"):
        vc.encode(spark.createDataFrame([(1, [0.5] * 9, 1)], SCHEMA))
    with pytest.raises(Exception, match="or more in size"):
        vc.encode(spark.createDataFrame([(1, [5e4] * 8, 1)], SCHEMA))


def test_many_labels_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vc, "FEW", 1)
    rows = [(i, [((i * k) % 7) / 9 for k in range(8)], i % 5 if i % 3 else None) for i in range(60)]
    out = vc.encode(spark.createDataFrame(rows, SCHEMA))[0].collect()
    sums = {}
    for r in out:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert len(out) == 60 and all(r.label_error == sums[r.label] for r in out)
