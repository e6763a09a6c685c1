"""Source divergence audit: how far each source's use of terms lies from its siblings'.

Per language, terms in at least ``min_df`` of its documents are kept.  Document vectors come
from Spark ML's CountVectorizer with that minDF and the greatest whole number as
vocabSize, so no term is cut; a term is prefixed by its language, which makes one fit
count document frequencies per language.  Sparse vectors are unpacked and summed by
(language, source), the sums that Summarizer would give, kept sparse.

Each group gives every kept term the smoothed share p = 1 + floor(scale * (count + alpha) /
(N + alpha * V)), N the sum of its counts over the V kept terms.  Two sources of a language
differ by the sum of |p - q| over all kept terms.  Pairs are evaluated sparsely: with a term's
share p0 where a source lacks it,

    sum |p - q| = sum over shared terms (|p - q| - |p - q0| - |p0 - q| + |p0 - q0|)
                + sum over the one's terms |p - q0| + sum over the other's terms |p0 - q|
                + (V - n - m) |p0 - q0|

the first sum from terms both hold, the others from histograms of p, of which a source has
far fewer values than terms.  All arithmetic is in whole numbers.

Memory: fitting passes the vocabulary through the driver and transforming broadcasts it.  As a
kept term has at least ``min_df`` places, the corpus' places over ``min_df`` bound the kept
terms; terms are dealt by hash to as many slices as keep that bound below ``SLICE_TERMS``,
each fitted on its own.  The number of slices grows with the corpus, the size of one
does not.

Terms are maximal runs of ASCII letters and non-ASCII characters, A-Z lower-cased.  NULL text,
language or source counts as ''.  Every row is a document, so repeated rows count again.
Groups without terms appear with counts of 0; a language without kept terms gives
differences of 0 and no terms; an empty table gives an empty result.  Other columns
are not read.  A text is held as a list of its terms in its own row; however long it is,
it adds 1 to a term's document frequency and all places to its count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from monthwise.llm.common import written
from monthwise.session import new_work_path

MIN_DF, ALPHA, SCALE, TOP = 30, 5, 1_000_000_000, 50
MAX_VOCAB = 2**31 - 1
SLICE_TERMS = 6_000_000
MARK = "\x00"            # between language and term; no term holds it
BLOCK_ROWS = 256
# Bytes of a term, A-Z lower-cased; all others become spaces.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def marked_terms(texts: list[bytes], langs: list[str]) -> pa.ListArray:
    """Per text its terms in order, each behind its language and the mark."""
    blobs, sizes, ends = [], [], [0]
    for text, lang in zip(texts, langs):
        words = text.translate(TERM_BYTES).split()
        prefix = (lang + MARK).encode("utf-8", "replace")
        blobs.append(prefix.join([b"", *words]))
        sizes.append(np.fromiter(map(len, words), np.int64, len(words)) + len(prefix))
        ends.append(ends[-1] + len(words))
    offsets = np.concatenate([[0], *sizes]).cumsum()
    data = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(b"".join(blobs)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), data.cast(pa.string()))


def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, lang, text) to (grp, terms)."""
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(at, BLOCK_ROWS)
            found = marked_terms(batch.column(2).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["grp", "terms"])


def deal(slices: int):
    """(grp, terms) to a row (slice, grp, terms) per slice of which it has terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                lists = batch.column(1)
                found = lists.flatten().dictionary_encode()
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                of_word = np.array([zlib.crc32(w.encode("utf-8", "replace")) % slices for w in found.dictionary.to_pylist()], np.int64)
                place = of_word[found.indices.to_numpy(zero_copy_only=False)] if len(found) else np.zeros(0, np.int64)
                order = np.lexsort((owner, place))
                cell = place[order] * len(lists) + owner[order]
                starts = np.flatnonzero(np.diff(cell, prepend=-1))
                rows = pa.array(owner[order][starts])
                ends = pa.array(np.append(starts, len(cell)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[order][starts].astype(np.int32)), batch.column(0).take(rows),
                     pa.ListArray.from_arrays(ends, found.take(pa.array(order)).cast(pa.string()))],
                    names=["slice", "grp", "terms"])
    return run


def group_id(lang: Column, source: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), lang, source)


def grouped(keyed: DataFrame) -> tuple[DataFrame, int]:
    """(grp, lang, source) of all groups, and the seed under which their numbers are unique."""
    found = written(keyed.select("lang", "source").distinct(), "groups")
    for seed in range(64):
        numbered = found.withColumn("grp", group_id(F.col("lang"), F.col("source"), seed))
        if numbered.count() == numbered.select("grp").distinct().count():
            return numbered, seed
    raise RuntimeError("group numbers collide under every seed")


def tokenised(keyed: DataFrame, seed: int, min_df: int, slice_terms: int) -> list[DataFrame]:
    """(grp, terms) of all documents, one frame per slice of the terms; written once.  Documents
    meet by group first, in ranges, so a task holds few groups (their sums combine there) and
    a large group spans many tasks."""
    spark = keyed.sparkSession
    rows = keyed.select(group_id(F.col("lang"), F.col("source"), seed).alias("grp"), "lang", "text")
    near = rows.repartitionByRange("grp", F.xxhash64("text"))
    seen = Observation("terms")
    plain = written(near.mapInArrow(tokenise, "grp bigint, terms array<string>").observe(
        seen, F.sum(F.size("terms").cast("long")).alias("n")), "terms")
    slices = max(1, -(-(seen.get["n"] or 0) // (min_df * slice_terms)))
    if slices == 1:
        return [plain]
    path = new_work_path(spark, "term-slices")
    plain.mapInArrow(deal(slices), "slice int, grp bigint, terms array<string>").write.option(
        "compression", "zstd").partitionBy("slice").parquet(path)
    dealt = spark.read.schema("grp bigint, terms array<string>, slice int").parquet(path)
    return [dealt.where(F.col("slice") == i).drop("slice") for i in range(slices)]


def counted(documents: DataFrame, number: int, min_df: int) -> tuple[DataFrame, DataFrame] | None:
    """Of one slice's kept terms, ((term, lang, item): number, language and text of each) and
    ((grp, term, n): counts of each group); None if it has none."""
    vectorizer = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=MAX_VOCAB)
    try:
        model = vectorizer.fit(documents)
    except IllegalArgumentException as e:
        if "vocabulary size should be" not in str(e):
            raise
        return None
    spark = documents.sparkSession
    base = F.lit(number).cast("long") * MAX_VOCAB          # slices number their terms apart
    words = spark.createDataFrame(enumerate(model.vocabulary), "place int, word string").select(
        (F.col("place") + base).alias("term"), F.regexp_extract("word", r"(?s)^(.*)\x00", 1).alias("lang"),
        F.substring_index("word", MARK, -1).alias("item"))
    cells = model.transform(documents).select("grp", F.unwrap_udt("vector").alias("v")).select(
        "grp", F.explode(F.arrays_zip(F.col("v.indices").alias("place"), F.col("v.values").alias("x"))).alias("cell"))
    # Counts are whole and far below 2^53, so their doubles are exact.
    sums = cells.groupBy("grp", F.col("cell.place").alias("place")).agg(F.sum(F.col("cell.x").cast("long")).alias("n"))
    sums = sums.select("grp", (F.col("place") + base).alias("term"), "n")
    return written(words, f"vocabulary-{number}"), written(sums, f"group-sums-{number}")


def share(n: Column, total: Column, vocabulary: Column, alpha: int, scale: int) -> Column:
    """1 + floor(scale * (n + alpha) / (total + alpha * vocabulary)), exactly; NULL for an empty vocabulary."""
    exact = "decimal(38,0)"
    top = F.lit(scale).cast("decimal(19,0)") * (n + F.lit(alpha)).cast("decimal(19,0)")
    bottom = total.cast(exact) + (vocabulary * F.lit(alpha)).cast(exact)
    return F.lit(1) + F.call_function("div", top.cast(exact), F.nullif(bottom, F.lit(0).cast(exact))).cast("long")


def audit(docs: DataFrame, min_df: int = MIN_DF, alpha: int = ALPHA, scale: int = SCALE, top: int = TOP, text: str = "text",
          lang: str = "lang", source: str = "source", slice_terms: int = SLICE_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank, p, q): per group, part ``pair`` with every other source
    of its language by descending difference (p, q NULL), and part ``term`` with the ``top``
    terms it uses more than its language does (p its share, q the language's).  Ties go to the
    smaller item in UTF-8."""
    spark = docs.sparkSession
    keyed = docs.select(or_empty(lang).alias("lang"), or_empty(source).alias("source"), or_empty(text).cast("binary").alias("text"))
    groups, seed = grouped(keyed)
    words = spark.createDataFrame([], "term bigint, lang string, item string")
    sums = spark.createDataFrame([], "grp bigint, term bigint, n bigint")
    for number, part in enumerate(tokenised(keyed, seed, min_df, slice_terms)):
        found = counted(part, number, min_df)
        if found is not None:
            words, sums = words.unionByName(found[0]), sums.unionByName(found[1])

    # A row per group: its sum, how many kept terms it holds, and its share p0 of a term it lacks.
    zero = F.lit(0).cast("long")
    held = sums.groupBy("grp").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    vocabulary = words.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = groups.join(held, "grp", "left").join(vocabulary, "lang", "left").select(
        "grp", "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("held", zero).alias("held"),
        F.coalesce("v", zero).alias("v"))
    lang_total = F.sum("total").over(Window.partitionBy("lang"))
    totals = written(totals.withColumn("lang_total", lang_total).withColumn(
        "p0", share(zero, F.col("total"), F.col("v"), alpha, scale)), "group-totals")
    shares = sums.join(totals.select("grp", "total", "v", "lang_total", "p0"), "grp").withColumn(
        "p", share(F.col("n"), F.col("total"), F.col("v"), alpha, scale))
    # A term's language total beside each of its groups: one exchange by term, which the pairs share.
    by_term = written(shares.withColumn("lang_n", F.sum("n").over(Window.partitionBy("term"))).select(
        "grp", "term", "p", "p0", share(F.col("lang_n"), F.col("lang_total"), F.col("v"), alpha, scale).alias("q")), "group-shares")
    out = pairs(totals, by_term).unionByName(over_used(totals, by_term, words, top))
    return out.select("lang", "source", "part", "item", "value", "rank", "p", "q")


def pairs(totals: DataFrame, shares: DataFrame) -> DataFrame:
    """Every ordered pair of a language's sources; each unordered one is evaluated once."""
    one = totals.select("lang", F.col("grp").alias("a"), F.col("source").alias("a_source"), F.col("held").alias("n_a"),
                        F.col("p0").alias("a0"), "v")
    two = totals.select("lang", F.col("grp").alias("b"), F.col("source").alias("b_source"), F.col("held").alias("n_b"),
                        F.col("p0").alias("b0"))
    both = one.join(two, "lang").where("a < b")
    left = shares.select("term", F.col("grp").alias("a"), "p", F.col("p0").alias("a0"))
    right = shares.select("term", F.col("grp").alias("b"), F.col("p").alias("q"), F.col("p0").alias("b0"))
    shared = left.join(right, "term").where("a < b").groupBy("a", "b").agg(
        F.expr("sum(abs(p - q) - abs(p - b0) - abs(a0 - q) + abs(a0 - b0))").alias("shared"))
    # |p - q0| over a source's own terms: by the values of p, not by term.
    values = shares.groupBy("grp", "p").agg(F.count(F.lit(1)).alias("times")).join(totals.select("grp", "lang"), "grp")
    alone = values.join(totals.select("lang", F.col("grp").alias("other"), F.col("p0").alias("q0")), "lang").where(
        "grp <> other").groupBy("grp", "other").agg(F.expr("sum(times * abs(p - q0))").alias("alone"))
    first = alone.toDF("a", "b", "alone_a")
    second = alone.toDF("b", "a", "alone_b")
    value = F.expr("coalesce(shared, 0) + coalesce(alone_a, 0) + coalesce(alone_b, 0) "
                   "+ coalesce((v - n_a - n_b) * abs(a0 - b0), 0)")
    keys = ["a", "b"]
    whole = both.join(shared, keys, "left").join(first, keys, "left").join(second, keys, "left")
    sides = F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
                    F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")))
    whole = whole.select("lang", value.cast("long").alias("value"), F.explode(sides).alias("side")).select("lang", "side.*", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    none = F.lit(None).cast("long")
    return whole.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"),
                        none.alias("p"), none.alias("q"))


def over_used(totals: DataFrame, shares: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """Terms of a group with a share above their language's, the ``top`` first of each group
    (cut within each task before they meet)."""
    above = shares.where("p > q").join(words.select("term", "item"), "term").withColumn("value", F.col("p") - F.col("q"))
    rank = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("value"), "item"))
    best = above.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(totals.select("grp", "lang", "source"), "grp").select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank", "p", "q")
