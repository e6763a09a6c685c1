"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of m characters may differ from its copy in a document by up to
k = floor(error_rate x m) edits.  Cut into k + 1 pieces, at least one piece of it stands
unchanged in any such copy; an Aho-Corasick automaton finds all pieces of all items
in one pass over a text, and Myers' bit-parallel algorithm verifies the
neighbourhood of each hit.  Verification climbs a tree over the pieces: of the two parts
of a stretch of j pieces with at most j - 1 edits, one has fewer edits than pieces too,
so a hit counts only if every stretch above its piece fits its own, smaller budget; short
stretches refute chance hits cheaply.  All places within k edits are found; there is no cap.

Both sides are compared as words (lower-cased in ASCII, punctuation dropped) joined
by single spaces, with a space at both ends, so matches end on word boundaries unless an edit
is spent on them.  Edits are counted in UTF-8 bytes.

The items are a query set: they are dealt by hash to blocks of about ``block_bytes``
and sent to the executors block by block, one pass over the documents each.  Items without words match nothing, NULL text holds nothing, empty tables
give empty results.  Repeated documents and repeated items are reported each.  A very long text is
searched whole; an item's memory is its length times the height of its tree.  Only the columns
asked for are read, and a document's own columns named like the result's clash: rename them first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import words_of

ERROR_RATE = 0.1
BLOCK_BYTES = 4 << 20


def normal(text: str | None) -> str:
    """`` w1 w2 ... `` with one character per UTF-8 byte; empty without words."""
    words = words_of(text)
    return b" ".join([b"", *words, b""]).decode("latin-1") if words else ""


def pieces(pattern: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): ``errors`` + 1 parts of nearly equal length."""
    cuts = [len(pattern) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, pattern[a:b]) for a, b in zip(cuts, cuts[1:])]


def climbs(n: int) -> list[list[tuple[int, int]]]:
    """For each of ``n`` pieces the stretches [first, last) of pieces above it in a
    binary tree, shortest first, the whole pattern left out."""
    above: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    open_stretches = [(0, n)]
    while open_stretches:
        a, b = open_stretches.pop()
        if b - a > 1:
            if (a, b) != (0, n):
                for piece in range(a, b):
                    above[piece].insert(0, (a, b))
            middle = (a + b) // 2
            open_stretches += [(a, middle), (middle, b)]
    return above


def myers(pattern: str, text: str, errors: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of ``pattern`` in ``text`` (first of the
    ties) if its edit distance is at most ``errors``; Python's integers hold a whole
    column of the dynamic programme, one bit per row."""
    m = len(pattern)
    if not m:
        return None
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = (score, 0) if score <= errors else None
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & full
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & full          # the pattern may start anywhere: no carry-in
        minus = minus << 1 & full
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if score <= errors and (best is None or score < best[0]):
            best = (score, at + 1)
    return best


class Matcher:
    """All items of a block, ready to look for in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items = [(item, p, int(len(p) * error_rate)) for item, text in items if (p := normal(text))]
        # piece -> (item, its offset, the stretches above it: pattern, offset, budget; shreds).
        # A stretch is made once per item and shared by the pieces below it.
        # Shreds: the rest of the lowest stretch, cut to budget + 1; one is unchanged too.
        places: dict[str, list[tuple[int, int, list[tuple[str, int, int]], list[str]]]] = {}
        for i, (_, pattern, errors) in enumerate(self.items):
            cut = pieces(pattern, errors)
            ends = [offset for offset, _ in cut] + [len(pattern)]
            made: dict[tuple[int, int], tuple[str, int, int]] = {}
            for (offset, piece), above in zip(cut, climbs(len(cut))):
                stretches = []
                for a, b in above:
                    if (a, b) not in made:
                        made[a, b] = (pattern[ends[a]:ends[b]], ends[a], b - a - 1)
                    stretches.append(made[a, b])
                shreds = []
                if stretches:
                    part, at, budget = stretches[0]
                    rest = part[len(piece):] if offset == at else part[:len(part) - len(piece)]
                    shreds = [shred for _, shred in pieces(rest, budget)]
                places.setdefault(piece, []).append((i, offset, stretches, shreds))
        self.found = ahocorasick.Automaton()
        for piece, where in places.items():
            self.found.add_word(piece, (len(piece), where))
        if places:
            self.found.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, distance, pattern length, first word of the best window) per item found."""
        line = normal(text)
        if not line or not self.items:
            return []
        starts: dict[int, set[int]] = {}      # item -> where its pattern would begin
        fits: dict[tuple[int, int], bool] = {}   # (stretch, begin) -> checked; pieces of one copy share both
        for end, (length, where) in self.found.iter(line):
            for i, offset, stretches, shreds in where:
                begin = end + 1 - length - offset
                if begin in starts.get(i, ()):
                    continue
                for lowest, stretch in enumerate(stretches):
                    part, at, errors = stretch
                    ok = fits.get((id(stretch), begin))
                    if ok is None:
                        near = line[max(0, begin + at - errors):max(0, begin + at + len(part) + errors)]
                        if not lowest and not any(s in near for s in shreds):
                            break
                        ok = fits[id(stretch), begin] = myers(part, near, errors) is not None
                    if not ok:
                        break
                else:
                    starts.setdefault(i, set()).add(begin)
        out = []
        for i, begins in starts.items():
            item, pattern, errors = self.items[i]
            best = None
            for low, high in windows(sorted(begins), errors, len(pattern), len(line)):
                got = myers(pattern, line[low:high], errors)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], low + got[1])
            if best:
                # the end is a boundary space; the place is the word the match starts in, at about
                begin = max(0, best[1] - len(pattern))
                out.append((item, best[0], len(pattern), line.count(" ", 0, begin + 1) - 1))
        return out


def windows(begins: list[int], errors: int, length: int, end: int) -> Iterator[tuple[int, int]]:
    """Parts of a text that hold every occurrence near the begins; overlapping ones merge."""
    low = high = None
    for begin in begins:
        a, b = max(0, begin - errors), min(end, begin + length + errors)
        if high is not None and a <= high:
            high = max(high, b)
            continue
        if high is not None:
            yield low, high
        low, high = a, b
    if high is not None:
        yield low, high


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator:
    """Broadcasts of [(item_id, text)], about ``block_bytes`` each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-total // block_bytes) or 1
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    for block in range(n_blocks):
        mine = items.where(F.col("block") == block).select("item_id", "text").collect()
        yield spark.sparkContext.broadcast([(r[0], r[1]) for r in mine])


def leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, keep: list[str] | None = None,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per (document, benchmark item) within the error budget: the columns
    ``keep`` of the document (default doc_id), ``item_id``, ``edit_distance`` (the best),
    ``item_chars`` (bytes compared) and ``first_word`` (about where it starts)."""
    keep = keep or ["doc_id"]
    kinds = {c: docs.schema[c].dataType.simpleString() for c in keep}
    out_schema = ", ".join([f"`{c}` {k}" for c, k in kinds.items()]
                           + ["item_id bigint, edit_distance int, item_chars int, first_word bigint"])

    def search(mine) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(mine.value, error_rate)
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            for batch in batches:
                found = [(row, *m) for row, text in enumerate(batch.column(len(keep)).to_pylist())
                         for m in matcher.matches(text)]
                rows = pa.array([f[0] for f in found], pa.int64())
                cols = [batch.column(j).take(rows) for j in range(len(keep))]
                cols += [pa.array([f[j + 1] for f in found], t) for j, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(
                    cols, names=[*keep, "item_id", "edit_distance", "item_chars", "first_word"])

        return docs.select(*keep, "text").mapInArrow(run, out_schema)

    return reduce(DataFrame.unionByName, map(search, item_blocks(benchmark, block_bytes)))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns stay, nothing is shuffled."""
    at = [c.lower() for c in docs.columns].index("text")

    def without(left: DataFrame, mine) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(mine.value, error_rate)
            for batch in batches:
                clean = [not matcher.matches(text) for text in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return left.mapInArrow(run, docs.schema)

    return reduce(without, item_blocks(benchmark, block_bytes), docs)
