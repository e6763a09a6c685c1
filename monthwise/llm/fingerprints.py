"""Document fingerprints: one-permutation MinHash with optimal densification, b-bit packed.

Everything is a Column expression over one row (no Python, no explode, no shuffle):

1. a text's words (maximal runs of characters other than space and \\t\\n\\v\\f\\r) give
   its shingles of five words, each hashed once by XXH64; the hash's top 8 bits are its
   bin, the rest its value.  A text of fewer words has one shingle, the whole sequence
   (empty text: the empty sequence), so equal texts always get equal fingerprints;
2. sorted together with one greatest-value marker per bin, the first hash of each bin is
   its minimum, and a bin whose first is the marker is empty;
3. an empty bin takes the value of the first filled bin in its own fixed random order of
   bins (optimal densification): ``ROUNDS`` drawn bins, then all bins ordered by a hash of
   both numbers, so the search always ends;
4. each bin's lowest ``BITS`` bits are packed, 16 bins to a long.

The likeness of two fingerprints is the share P of equal bins corrected for chance
agreement, (P - 2^-b) / (1 - 2^-b), not below 0.

NULL text counts as empty.  A text is held as arrays of its words and hashes, about ten times
its size, within its own row; nothing gathers rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import written
from monthwise.operators.ordered import with_neighbours

SHINGLE = 5
BINS = 256           # by the top 8 bits of a hash
BITS = 4             # kept of each bin
ROUNDS = 4           # probes tried by table before all bins are ordered
SPACE = " \t\n\x0b\x0c\r"
LOW_56 = (1 << 56) - 1
CHUNK = 4096         # copies of a row made at once


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def probe(bin_: int, attempt: int) -> int:
    """The bin that an empty bin tries at an attempt: an MD5 of both numbers."""
    return hashlib.md5(f"{bin_},{attempt}".encode()).digest()[0] % BINS


def markers() -> list[int]:
    """Per bin, in signed order, the greatest hash that falls into it."""
    return [((b - BINS // 2) << 56) | LOW_56 for b in range(BINS)]


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    words = F.split(F.btrim(text, F.lit(SPACE)), r"[\x20\x09-\x0D]+", -1)
    # Words past the end of a shorter text are NULL, which the hash passes over.
    return let(words, lambda w: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)])))


def is_empty(x: Column) -> Column:
    return x.bitwiseAND(F.lit(LOW_56)) == F.lit(LOW_56)


def minima(hashes: Column) -> Column:
    """The least hash of each bin; an empty bin's marker."""
    marks = F.array(*[F.lit(m) for m in markers()])
    return let(F.sort_array(F.concat(hashes, marks)), lambda s: F.filter(
        s, lambda x, i: ~F.shiftright(x, 56).eqNullSafe(F.shiftright(F.get(s, i - 1), 56))))


def densified(bins: Column) -> Column:
    """Values of all bins; only their low ``BITS`` bits count."""
    def fill(first: Column) -> Column:
        def tried(now: Column, attempt: int) -> Column:
            table = F.array(*[F.lit(probe(b, attempt)) for b in range(BINS)])
            return F.transform(now, lambda x, i: F.when(is_empty(x), F.get(first, F.get(table, i))).otherwise(x))

        now = first
        for attempt in range(ROUNDS):
            now = tried(now, attempt)
        keep = (1 << BITS) - 1
        return let(F.filter(first, lambda y: ~is_empty(y)), lambda full: F.transform(now, lambda x, i: F.when(
            is_empty(x), F.array_min(F.transform(full, lambda y: F.xxhash64(i, F.shiftright(y, 56)).bitwiseAND(F.lit(~keep))
                                                 .bitwiseOR(y.bitwiseAND(F.lit(keep)))))).otherwise(x)))
    return let(bins, fill)


def packed(values: Column) -> Column:
    """Low bits of the bins, 64 bits to a long."""
    per = 64 // BITS
    return let(values, lambda v: F.transform(F.sequence(F.lit(0), F.lit(BINS // per - 1)), lambda k: F.aggregate(
        F.slice(v, k * per + 1, per), F.lit(0).cast("long"),
        lambda acc, x: F.shiftleft(acc, BITS).bitwiseOR(x.bitwiseAND(F.lit((1 << BITS) - 1))))))


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """array<bigint> of ``BINS * BITS / 64`` packed longs."""
    return packed(densified(minima(shingle_hashes(F.coalesce(text, F.lit("")), shingle))))


def as_text(longs: Column) -> Column:
    """A fingerprint in lower-case hex digits, one per bin."""
    return F.lower(F.array_join(F.transform(longs, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingles from their fingerprints."""
    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        folded = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        folded = folded.bitwiseOR(F.shiftrightunsigned(folded, 2))
        return F.bit_count(folded.bitwiseAND(F.lit(0x1111111111111111)))
    bad = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda acc, n: acc + n)
    chance = 2.0 ** -BITS
    return F.greatest(F.lit(0.0), ((F.lit(float(BINS)) - bad) / BINS - chance) / (1 - chance))


def with_edits(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every document and of its edited text: the last floor(n/4) of its n code
    points give way to the first as many (or all) of the next document, by ascending doc_id
    (after the last: the first).  Returns doc_id, n_chars, edited_sha256, packed, edited_packed
    (array<bigint>), near_edited, near_next (likeness to the edited text and to the next
    document); other columns of ``docs`` are not read, so none can clash.

    Rows are told apart by (doc_id, 128-bit text hash), which every scan gives alike.  NULL ids
    come last; rows of one id follow each other in the order of the hash; equal rows follow
    each other, so all but the last of them are edited by their own beginning.  A single
    document is its own next.  An empty table gives an empty result.

    Texts are shuffled once, by row key, after equal rows have met within each task; what
    moves besides is the beginning each text lends, cut to the length needed, and packed
    fingerprints.  The order itself is found on keys alone (``with_neighbours``)."""
    key = ["id_rank", "id", "h1", "h2"]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").isNull().cast("int").alias("id_rank"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))
    slim = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.max(F.length("text")).cast("long").alias("n_chars"))
    order = with_neighbours(written(slim, "text-keys"), [], key, {c: f"next_{c}" for c in key})
    order = written(order, "text-order")
    start = order.agg(F.min(F.struct(*key)).alias("first")).select("first.*").toDF(*[f"first_{c}" for c in key])
    order = order.crossJoin(F.broadcast(start))                                     # one row
    goes_to = {c: F.coalesce(F.col(f"next_{c}"), F.col(f"first_{c}")) for c in key}
    # What a row's text is edited with: once the next key's text, else (copies) its own.
    uses = F.array(F.struct(*[x.alias(f"from_{c}") for c, x in goes_to.items()], F.lit(1).cast("long").alias("times"),
                            F.lit(True).alias("is_last")),
                   F.struct(*[F.col(c).alias(f"from_{c}") for c in key], (F.col("copies") - 1).alias("times"),
                            F.lit(False).alias("is_last")))
    uses = order.select(*key, "n_chars", F.expr("n_chars div 4").alias("lent"), F.explode(uses).alias("use")).select(
        *key, "n_chars", "lent", "use.*").where("times > 0")

    def on(left: str, right: str) -> str:
        return " AND ".join(f"{left}{c} = {right}{c}" for c in key)

    texts = rows.groupBy(*key).agg(F.first("text").alias("text"))
    lent = texts.toDF(*[f"own_{c}" for c in key], "own_text").join(uses, F.expr(on("own_", "from_"))).select(
        *key, "n_chars", "lent", *[f"from_{c}" for c in key], "times", "is_last",
        F.expr("left(own_text, CAST(lent AS INT))").alias("tail"))
    both = texts.toDF(*[f"own_{c}" for c in key], "own_text").join(lent, F.expr(on("own_", "")))
    edited = F.concat(F.expr("left(own_text, CAST(n_chars - lent AS INT))"), F.col("tail"))
    made = both.select(
        *key, *[f"from_{c}" for c in key], "n_chars", "times", "is_last", F.sha2(edited, 256).alias("edited_sha256"),
        fingerprint(F.col("own_text"), shingle).alias("packed"), fingerprint(edited, shingle).alias("edited_packed"))
    made = written(made, "fingerprints")
    of_next = made.where("is_last").select(*[F.col(c).alias(f"next_{c}") for c in key], F.col("packed").alias("next_packed"))
    out = made.join(of_next, F.expr(on("from_", "next_")))
    # Equal rows: as many as there were, in bounded steps.
    out = out.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(CHUNK).cast("long"))))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("times") - F.col("start"), F.lit(CHUNK)))))
    return out.select(
        F.when(F.col("id_rank") == 0, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "packed", "edited_packed",
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
        likeness(F.col("packed"), F.col("next_packed")).alias("near_next"))
