"""Token counts of documents without materialising token ids.

A byte-level BPE tokenizer never merges across pre-tokens, so a document's count is
the sum over its pre-tokens of (frequency x pieces of that pre-token).  Three steps:

1. one pass over the documents yields each document's pre-token frequencies, turned
   round per block of documents: one row per (block, pre-token) with the documents
   holding it, so a frequent pre-token is one row per block and not one per document;
2. these rows are partitioned by pre-token, and each distinct pre-token is given to
   the tokenizer library once;
3. pieces x frequency is summed per document.

Hot keys: a pre-token held by ``hot_docs`` or more documents of a block is counted
in place, once for the task (a salted key with the task as its salt), so no
pre-token's documents pile up in one task; only the long tail is shuffled.  Of the tail, what
half as many documents of a block hold is dealt to ``SALTS`` tasks, each of which encodes it once.

Pre-tokens are cut by the tokenizer's own pattern; a file with another pre-tokenizer than the
byte-level one, or with a normalizer, is refused, as the sum would not be its count.  Where a text has only characters
on which Python's classes are known to agree with the library's, a compiled pattern
does it; any other text goes through the library's own pre-tokenizer.  Special
strings are cut out first and count one token each, as the library does by default.

The documents are scanned once: rows are numbered in that scan, and their id and size travel with
their own share of the count.  NULL text counts as empty (0 bytes, 0 tokens); NULL ids and
repeated rows are kept, one result row per input row; an empty table gives an empty result.  A very
long text is a block of its own.  Columns besides id and text are not read, so none can clash.
"""

from __future__ import annotations

import itertools
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_DOCS = 8
SALTS = 16
BLOCK_DOCS = 2048          # documents of a block, at most
BLOCK_CHARS = 8 << 20      # characters of a block, at most (one longer text is a block)

LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
# The byte-level BPE pattern, alternatives in an order that tries words first (they
# exclude each other by their first character), on characters below U+0250.
SPLIT = re.compile(rf" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
# Anything on which classes may differ: control separators, superscript numbers,
# ordinal letters, micro sign, and all from U+0250 up.
UNSAFE = re.compile("[^\x00-\x1b\x20-\x84\x86-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-ɏ]")


def check_supported(path: str) -> None:
    """Raises unless a document's count is the sum over the pre-tokens cut by ``SPLIT``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space", True)
            or not pre.get("use_regex", True)):
        raise ValueError(f"{path}: only byte-level tokenizers without normalizer and prefix space are counted")


class Splitter:
    """Cuts texts to pre-tokens as the tokenizer in ``path`` does, and counts pieces."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"        # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def cut(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, special strings) of a text."""
        parts = self.special.split(text) if self.special else [text]
        if len(parts) == 1 and not UNSAFE.search(text):
            return SPLIT.findall(text), 0
        out: list[str] = []
        for part in parts:
            if not part:
                continue
            if UNSAFE.search(part):
                spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
                out += [part[a:b] for _, (a, b) in spans]
            else:
                out += SPLIT.findall(part)
        return out, len(parts) - 1

    def pieces(self, pretokens: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]


def blocks(batches: Iterator[pa.RecordBatch], docs: int, chars: int) -> Iterator[tuple[list, list, list, list]]:
    """(rows, texts, ids, sizes in bytes) of at most ``docs`` rows and ``chars`` characters."""
    block: list[tuple] = []
    size = 0
    for batch in batches:
        for one in zip(*(c.to_pylist() for c in batch.columns)):
            if block and (len(block) >= docs or size + len(one[1]) > chars):
                yield tuple(map(list, zip(*block)))
                block, size = [], 0
            block.append(one)
            size += len(one[1])
    if block:
        yield tuple(map(list, zip(*block)))


POSTINGS = pa.schema([("pretoken", pa.string()), ("rows", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
                      ("pieces", pa.int64()), ("id", pa.string()), ("n_bytes", pa.int64())])


def frequencies(path: str, hot_docs: int, block_docs: int, block_chars: int):
    """Per block: a row (pretoken, rows, counts, NULL) for each pre-token of the long
    tail (counts NULL where all are 1, as most are), and a row (NULL, [row], NULL, pieces, id,
    bytes) per document with what is counted in place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(path)
        known: dict[str, int] = {}
        for rows, texts, ids, sizes in blocks(batches, block_docs, block_chars):
            holders: dict[str, list[int]] = defaultdict(list)     # pre-token -> doc, count, doc, count, ...
            done = [0] * len(rows)
            for i, text in enumerate(texts):
                pretokens, done[i] = splitter.cut(text)
                for pretoken, n in Counter(pretokens).items():
                    holders[pretoken] += (i, n)
            hot = [p for p, h in holders.items() if len(h) >= 2 * hot_docs]
            new = [p for p in hot if p not in known]
            known.update(zip(new, splitter.pieces(new)))
            for pretoken in hot:
                n, places = known[pretoken], holders.pop(pretoken)
                for i, times in zip(places[::2], places[1::2]):
                    done[i] += n * times
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(rows), pa.string()), pa.array([[r] for r in rows], POSTINGS.field("rows").type),
                 pa.nulls(len(rows), POSTINGS.field("counts").type), pa.array(done, pa.int64()),
                 pa.array(ids, pa.string()), pa.array(sizes, pa.int64())], schema=POSTINGS)
            tail = iter(holders.items())
            while some := list(itertools.islice(tail, 10_000)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in some], pa.string()),
                     pa.array([[rows[i] for i in h[::2]] for _, h in some], POSTINGS.field("rows").type),
                     pa.array([n if max(n) > 1 else None for _, h in some if (n := h[1::2])],
                              POSTINGS.field("counts").type),
                     pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.string()),
                     pa.nulls(len(some), pa.int64())], schema=POSTINGS)
    return run


def resolve(path: str):
    """Rows of one partition by pre-token to (row, pieces), with id and bytes from a document's own
    row: every distinct pre-token is encoded once, its count is kept while the partition lasts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(path)
        known: dict[str, int] = {}
        for batch in batches:
            pretokens, rows, counts, pieces, ids, sizes = (c.to_pylist() for c in batch.columns)
            new = list({p for p in pretokens if p is not None and p not in known})
            known.update(zip(new, splitter.pieces(new)))
            sums: Counter = Counter()
            about: dict[int, tuple] = {}
            for pretoken, some, times, own, *of in zip(pretokens, rows, counts, pieces, ids, sizes):
                if pretoken is None:
                    sums[some[0]] += own
                    about[some[0]] = of
                    continue
                n = known[pretoken]
                for row, k in zip(some, times or itertools.repeat(1)):
                    sums[row] += n * k
            unknown = (None, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64()),
                 pa.array([about.get(r, unknown)[0] for r in sums], pa.string()),
                 pa.array([about.get(r, unknown)[1] for r in sums], pa.int64())], names=["row", "n", "id", "n_bytes"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 hot_docs: int = HOT_DOCS, block_docs: int = BLOCK_DOCS,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: its id (of any type that goes to text and back), ``n_bytes`` (UTF-8)
    and ``n_tokens``.

    ``tokenizer_path`` must be readable at the same place on every executor."""
    check_supported(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.monotonically_increasing_id().alias("row"), text.alias("text"),
                       F.col(id_col).cast("string").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"))
    postings = base.mapInArrow(
        frequencies(tokenizer_path, hot_docs, block_docs, block_chars),
        "pretoken string, rows array<bigint>, counts array<int>, pieces bigint, id string, n_bytes bigint")
    # Rows without a pre-token carry a document's own share; they are dealt by row.
    salt = F.when(F.size("rows") * 2 >= hot_docs, F.pmod(F.xxhash64(F.col("rows")[0]), F.lit(SALTS))).otherwise(0)
    dealt = postings.repartition(F.coalesce(F.col("pretoken"), F.col("rows")[0].cast("string")), salt)
    sums = dealt.mapInArrow(resolve(tokenizer_path), "row bigint, n bigint, id string, n_bytes bigint").groupBy("row").agg(
        F.sum("n").alias("n_tokens"), F.first("id", ignorenulls=True).alias("id"), F.max("n_bytes").alias("n_bytes"))
    return sums.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_bytes", "n_tokens")
