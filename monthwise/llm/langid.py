"""Language identification as mixture inference.

Training counts byte n-grams per language over all labelled documents (one dense
count vector per task and language, summed by Spark).  A text is then a mixture: its
n-grams g with counts c_g have likelihood  sum_g c_g log sum_l pi_l p(g | l).
Expectation-maximisation estimates the proportions pi; the set of languages is the
one with the greatest penalised likelihood (the Bayesian criterion: half a log of the
n-gram count for each language beyond the first).  The prediction is the language
with the greatest proportion, the score its proportion.

N-grams are hashed into 2^``bits`` buckets, so a model has languages x 2^bits numbers;
it is broadcast, and more than ``max_languages`` labels raise an error (NULL
labels are not learned).

NULL text and text without a letter are ``und`` with score 0; with no labelled
document at all every text is ``und``.  Ties between languages go to the first in alphabetical
order; empty tables give empty results; repeated rows are predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ORDER = 4
BITS = 16
MAX_LANGUAGES = 512
ROUNDS = 30
SMOOTHING = 0.5
MIXER = 0x9E3779B1                   # odd multiplier of the hash
CHUNK = 4 << 20                      # bytes hashed at once
# ASCII letters lower-cased, all other ASCII characters a space, the rest kept.
LETTER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(text: str) -> bool:
    """Letters only: numerals such as \u00b2, \u00bd or \u2167 are none."""
    return any(map(str.isalpha, text))


def normal(text: str) -> bytes:
    words = text.encode("utf-8", "replace").translate(LETTER_BYTES).split()
    return b" ".join([b"", *words, b""])


def grams(text: str, order: int, bits: int) -> np.ndarray:
    """Bucket counts of a text's byte n-grams: (buckets, counts) stacked as two rows."""
    data = np.frombuffer(normal(text), np.uint8)
    total = None
    for at in range(0, max(1, len(data) - order + 1), CHUNK):
        part = data[at:at + CHUNK + order - 1].astype(np.uint32)
        n = len(part) - order + 1
        if n <= 0:
            continue
        code = np.zeros(n, np.uint32)
        for i in range(order):
            code = (code << np.uint32(8)) | part[i:i + n]
        code = (code * np.uint32(MIXER)) >> np.uint32(32 - bits)
        if len(data) <= CHUNK:
            return np.stack(sparse(code))
        counts = np.bincount(code, minlength=1 << bits)
        total = counts if total is None else total + counts
    if total is None:
        return np.zeros((2, 0), np.int64)
    where = np.flatnonzero(total)
    return np.stack([where, total[where]])


def sparse(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts, by one sort."""
    code = np.sort(code.astype(np.uint16) if code.size and code.max() < 65536 else code, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[first].astype(np.int64), np.diff(np.append(first, len(code)))


def train(docs: DataFrame, may_learn: Column, order: int = ORDER, bits: int = BITS,
          max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """(languages, log-free probabilities [2^bits x languages]) from the rows for which
    ``may_learn`` holds and ``lang`` is given."""
    rows = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                where, n = grams(text, order, bits)
                if lang not in sums:
                    if len(sums) >= max_languages:
                        raise ValueError(f"more than {max_languages} labels in lang")
                    sums[lang] = np.zeros(1 << bits, np.int64)
                sums[lang][where] += n
        for lang, n in sums.items():
            where = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(where), pa.string()), pa.array(where.astype(np.int32)), pa.array(n[where])],
                names=["lang", "gram", "n"])

    counted = rows.mapInArrow(count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    vectors = counted.groupBy("lang").agg(F.collect_list(F.struct("gram", "n")).alias("grams"))   # 2^bits at most each
    model: dict[str, np.ndarray] = {}
    for lang, found in vectors.orderBy("lang").toLocalIterator():
        model[lang] = np.full(1 << bits, SMOOTHING)
        model[lang][[g[0] for g in found]] += [g[1] for g in found]
        if len(model) > max_languages:
            raise ValueError(f"more than {max_languages} labels in lang")
    langs = sorted(model)
    table = np.stack([model[x] / model[x].sum() for x in langs], axis=1) if langs else np.zeros((1 << bits, 0))
    return langs, table


def mixture(p: np.ndarray, c: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood by expectation-maximisation; p: [n-grams x languages]."""
    n = c.sum()
    pi = np.full(p.shape[1], 1.0 / p.shape[1])
    for _ in range(rounds):
        new = pi * (p.T @ (c / (p @ pi))) / n
        done = np.abs(new - pi).max() < 1e-3
        pi = new
        if done:
            break
    return pi, float(c @ np.log(p @ pi))


def infer(where: np.ndarray, c: np.ndarray, table: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(languages, proportions) of the set with the greatest penalised likelihood."""
    single = c @ logs[where]
    best = int(single.argmax())
    price = 0.5 * np.log(max(2, c.sum()))
    if table.shape[1] == 1:
        return np.array([best]), np.ones(1)
    p = table[where]
    pi, full = mixture(p, c)
    chosen, share, value = np.array([best]), np.ones(1), single[best]
    # No set explains more than all languages do: one language wins outright if even that is too little.
    if full - price <= value:
        return chosen, share
    order = np.argsort(-pi, kind="stable")
    for size in range(2, len(pi) + 1):
        if pi[order[size - 1]] < 1e-3 or full - (size - 1) * price <= value:
            break
        some = np.sort(order[:size])
        own, likelihood = (pi, full) if size == len(pi) else mixture(p[:, some], c)
        if likelihood - (size - 1) * price > value:
            chosen, share, value = some, own, likelihood - (size - 1) * price
    return chosen, share


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, keep: list[str] | None = None,
            order: int = ORDER, bits: int = BITS) -> DataFrame:
    """One row per document: the columns ``keep`` (default doc_id), lang_pred, score and
    the mixture (language, proportion), greatest first."""
    keep = keep or ["doc_id"]
    model = docs.sparkSession.sparkContext.broadcast((langs, table))     # languages x 2^bits numbers
    mix = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, p = model.value
        logs = np.log(p)
        for batch in batches:
            pred, score, mixed = [], [], []
            for text in batch.column(len(keep)).to_pylist():
                if not names or text is None or not has_letter(text):
                    pred.append("und"), score.append(0.0), mixed.append([])
                    continue
                where, n = grams(text, order, bits)
                if not len(where):
                    some, share = np.array([0]), np.ones(1)
                else:
                    some, share = infer(where, n.astype(np.float64), p, logs)
                by = sorted(zip(-share, some))
                pred.append(names[by[0][1]])
                score.append(float(min(1.0, -by[0][0])))
                mixed.append([{"lang": names[i], "share": float(-s)} for s, i in by])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(mixed, mix)], names=[*keep, "lang_pred", "score", "mixture"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(
        run, f"{kinds}, lang_pred string, score double, mixture array<struct<lang:string,share:double>>")


__all__ = ["train", "predict", "grams", "mixture", "infer"]
