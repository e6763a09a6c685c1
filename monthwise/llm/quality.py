"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot products.

A text becomes a sequence of words: runs of letters (lower-cased in ASCII), of digits, and
of symbols; white space separates.  Two shapes replace rare words: a word like the one
before becomes the repeat mark, a word of two or more ASCII capitals the capitals mark.  Words and
pairs of neighbours are hashed into 2^``bits`` weights; a feature's value is
``SCALE`` x its count / number of words, so long and short texts are on one scale.

Everything up to the dot product is array work on a batch's bytes: word hashes are
differences of a running polynomial sum.

Training: a sample of about ``max_train`` labelled texts (all if there are fewer; the only
bound, and a parameter) is dealt to shards of about ``shard_rows`` by a hash of the
row; every shard runs FTRL over its rows in hash order for ``passes``, and the
weights are averaged.  Ids are drawn first; if they bring more texts than the bound (an id
that many documents share), the texts are thinned by their own hash, so neither the
broadcast nor a shard grows with a repeated id.
Labels are 0 or 1; other values (0.7 too) and NULL are not learned.

Texts without words (NULL, empty) score by the intercept alone.  Without
any label every score is 0.5.  Repeated rows are scored each; equal ones are learned once,
different labels of one document are all learned.  Very long texts are hashed ``CHUNK`` bytes at a
time.  Columns besides doc_id, text and the label are not read, so none can clash.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import written

BITS = 18
MAX_TRAIN = 16_000
SHARD_ROWS = 2_000
PASSES = 3
SCALE = 10.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1       # FTRL: learning rate, its offset, penalties
CHUNK = 1 << 20                                 # bytes hashed at once
PRIME = 0x9E3779B97F4A7C15                      # odd, so invertible modulo 2^64
REPEAT, CAPITALS = np.uint64(0xA5A5A5A5), np.uint64(0x5A5A5A5A)
SPACE, LETTER, DIGIT, SYMBOL = range(4)
CLASS = np.array([SPACE if c in b" \t\n\r\x0b\x0c" else LETTER if c >= 128 or chr(c).isalpha() else
                  DIGIT if 48 <= c <= 57 else SYMBOL for c in range(256)], np.uint8)
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """PRIME^i and PRIME^-i modulo 2^64."""
    inverse = pow(PRIME, -1, 1 << 64)
    up, down = np.full(n + 1, PRIME, np.uint64), np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Hasher:
    """Feature buckets of texts."""

    def __init__(self, bits: int):
        self.bits = bits
        self.up, self.down = powers(CHUNK)

    def words(self, data: bytes) -> np.ndarray:
        """Hashes of the words of at most CHUNK bytes, shapes in place."""
        raw = np.frombuffer(data, np.uint8)
        kind = CLASS[raw]
        edge = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(raw) else np.zeros(0, np.int64)
        ends = np.append(edge[1:], len(raw))
        word = kind[edge] != SPACE
        start, end = edge[word], ends[word]
        run = np.concatenate([[np.uint64(0)], np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * self.up[:len(raw)])])
        value = (run[end] - run[start]) * self.down[start]
        capital = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90))])
        shout = (end - start >= 2) & (capital[end] - capital[start] == end - start)
        again = np.concatenate([[False], value[1:] == value[:-1]])[:len(value)]
        value = np.where(shout, CAPITALS, value)
        return np.where(again & ~shout, REPEAT, value)

    def cut(self, data: bytes) -> Iterator[bytes]:
        """Pieces of at most CHUNK bytes, ending behind white space where there is some."""
        while len(data) > CHUNK:
            at = max(data.rfind(b" ", 0, CHUNK), data.rfind(b"\n", 0, CHUNK)) + 1 or CHUNK
            yield data[:at]
            data = data[at:]
        yield data

    def buckets(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words and of the pairs of neighbours."""
        shift = np.uint64(64 - self.bits)
        single = (words * np.uint64(PRIME)) >> shift
        pair = ((words[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + words[1:]) * np.uint64(0x165667B19E3779F9)) >> shift
        return single.astype(np.int64), pair.astype(np.int64)

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, values) of one text."""
        words = np.concatenate([self.words(p) for p in self.cut((text or "").encode("utf-8", "replace"))])
        if not len(words):
            return np.zeros(0, np.int64), np.zeros(0)
        where, n = np.unique(np.concatenate(self.buckets(words)), return_counts=True)
        return where, SCALE * n / len(words)

    def scores(self, texts: list[str | None], weights: np.ndarray) -> np.ndarray:
        """Dot products of texts with the weights (the last one is the intercept)."""
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            total, n, last = 0.0, 0, np.zeros(0, np.uint64)
            for part in self.cut((text or "").encode("utf-8", "replace")):
                words = self.words(part)
                single, pair = self.buckets(np.concatenate([last, words]))
                total += weights[single[len(last):]].sum() + weights[pair].sum()
                n += len(words)
                last = words[-1:] if len(words) else last
            out[i] = weights[-1] + (SCALE * total / n if n else 0.0)
        return out


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, passes: int) -> np.ndarray:
    """Weights (the last is the intercept, not penalised) after FTRL-proximal updates."""
    size = (1 << bits) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for _ in range(passes):
        for where, value, label in rows:
            where, value = np.append(where, size - 1), np.append(value, 1.0)
            zi, ni = z[where], n[where]
            penalty = np.where(where == size - 1, 0.0, L1)
            wi = np.where(np.abs(zi) <= penalty, 0.0,
                          (np.sign(zi) * penalty - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            g = (sigmoid(wi @ value) - label) * value
            z[where] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[where] += g * g
            w[where] = wi
    penalty = np.full(size, L1)
    penalty[-1] = 0.0
    return np.where(np.abs(z) <= penalty, 0.0, (np.sign(z) * penalty - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def training_rows(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str, max_train: int, shard_rows: int) -> DataFrame:
    """(shard, place, doc_id, y, text) of the sample."""
    y = F.col(label).cast("double")
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(y.isin(0.0, 1.0), y.cast("int")).alias("y"))
              .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & may_learn).distinct()
              .withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))))
    count = usable.count()
    part = int(min(1.0, max_train / max(1, count)) * (1 << 30))
    # About max_train rows of three numbers (an id has two labels at most).
    sample = usable.where(F.col("place") < part)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    rows = written(rows.select("place", "doc_id", "y", "text").distinct(), "training-rows")
    drawn = rows.count()
    own = F.xxhash64("doc_id", "y", "text")
    if drawn > 2 * max_train:
        rows = rows.where(F.pmod(own, F.lit(1 << 30)) < int(max_train / drawn * (1 << 30)))
        drawn = max_train
    shards = max(1, round(drawn / shard_rows))
    return rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(1), own), F.lit(shards)).cast("int"))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "quality", bits: int = BITS,
          max_train: int = MAX_TRAIN, shard_rows: int = SHARD_ROWS, passes: int = PASSES) -> np.ndarray:
    """Weights learned from the labelled rows for which ``may_learn`` (over doc_id) holds."""
    rows = training_rows(docs, labels, may_learn, label, max_train, shard_rows)

    def fit(shard: pd.DataFrame) -> pd.DataFrame:
        hasher = Hasher(bits)
        shard = shard.sort_values(["place", "doc_id", "y", "text"])
        learned = ftrl([(*hasher.features(t), y) for t, y in zip(shard["text"], shard["y"])], bits, passes)
        where = np.flatnonzero(learned)
        return pd.DataFrame({"i": np.append(where, -1), "w": np.append(learned[where], 1.0)})   # -1 counts shards

    fitted = rows.select("shard", "place", "doc_id", "y", "text").groupBy("shard").applyInPandas(fit, "i long, w double")
    weights, fits = np.zeros((1 << bits) + 1), 1.0
    for i, w in fitted.groupBy("i").agg(F.sum("w")).toLocalIterator():        # 2^bits + 2 rows at most
        if i < 0:
            fits = w
        else:
            weights[i] = w
    return weights / fits


def score(docs: DataFrame, weights: np.ndarray, keep: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """The columns ``keep`` (default doc_id) and ``score``, the probability of label 1."""
    keep = keep or ["doc_id"]
    model = docs.sparkSession.sparkContext.broadcast(weights)                  # 2^bits + 1 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        for batch in batches:
            p = sigmoid(hasher.scores(batch.column(len(keep)).to_pylist(), model.value))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(p)], names=[*keep, "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, score double")


def keep_good(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5, bits: int = BITS) -> DataFrame:
    """``docs`` whose score reaches the threshold; all columns stay, nothing is shuffled."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        for batch in batches:
            p = sigmoid(hasher.scores(batch.column(at).to_pylist(), model.value))
            yield batch.filter(pa.array(p >= threshold))

    return docs.mapInArrow(run, docs.schema)
