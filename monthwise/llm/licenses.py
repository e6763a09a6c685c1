"""License scan: identifier tags, notice phrases and licence expressions.

An Aho-Corasick automaton over the words of a text (lower-cased in ASCII, joined by
single spaces) finds notice phrases and the words of an identifier tag in one pass.
Only texts with a tag are looked at again: the expression behind each tag (up to the
next tag or the end of the line) is parsed
by a shunting-yard parser (operators WITH, AND, OR, in falling precedence, and
parentheses) and evaluated to the obligations a user of the text would face: OR takes the
freest operand, AND the strictest, WITH softens a copyleft licence by one step.

NULL text counts as empty; empty tables give empty results; rows are independent,
so ties and repeated rows need no rule.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from monthwise.llm.common import words_of

# phrase -> label: the base rules of the contract, then the method's notices (fixed values).
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
NOTICES = {
    "apache license": "apache",
    "mit license": "mit",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "creative commons attribution": "cc-by",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAG = "spdx license identifier"
# Obligations, freest first (fixed values): licence-id prefix -> class.
CLASSES = ["free", "permissive", "weak-copyleft", "copyleft", "network-copyleft", "restricted", "unknown"]
FAMILIES = {
    "cc0": "free", "unlicense": "free", "0bsd": "free", "public-domain": "free",
    "mit": "permissive", "apache": "permissive", "bsd": "permissive", "isc": "permissive",
    "zlib": "permissive", "cc-by-sa": "weak-copyleft", "cc-by-nc": "restricted",
    "cc-by-nd": "restricted", "cc-by": "permissive", "lgpl": "weak-copyleft",
    "mpl": "weak-copyleft", "epl": "weak-copyleft", "agpl": "network-copyleft",
    "gpl": "copyleft", "proprietary": "restricted",
}
# How sure each kind of evidence makes us that a text states a licence.
TAG_WEIGHT, NOTICE_WEIGHT = 0.95, 0.6
TAG_START = re.compile(r"spdx[^0-9a-z\n\x80-\U0010ffff]*license[^0-9a-z\n\x80-\U0010ffff]*identifier[ \t]*[:=]?[ \t]*", re.I)
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
STRENGTH = {"or": 1, "and": 2, "with": 3}


def family(licence: str) -> str:
    """Class of a licence id, by the longest known prefix."""
    name = licence.lower()
    known = [f for f in FAMILIES if name == f or name.startswith(f + "-") or name.startswith(f + "+")]
    return FAMILIES[max(known, key=len)] if known else "unknown"


def postfix(expression: str, cut: bool = False) -> list[str] | None:
    """Shunting yard: the expression at the start of the string, in postfix order; None
    if there is none.  Stops at the first token that can't continue it, as tags are
    followed by comment ends and prose.  If it is unfinished there: None, or with
    ``cut`` the longest well-formed expression at the start."""
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    whole = None                    # length of ``out`` and open operators (three at most) when last well-formed
    for found in TOKEN.finditer(expression):
        token = found.group()
        word = token.lower()
        if operand_next:
            if token == "(":
                stack.append(token)
            elif token == ")" or word in STRENGTH:
                break
            else:
                out.append(token)
                operand_next = False
        elif word in STRENGTH:
            while stack and stack[-1] != "(" and STRENGTH[stack[-1]] >= STRENGTH[word]:
                out.append(stack.pop())
            stack.append(word)
            operand_next = True
        elif token == ")" and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            break
        if not operand_next and "(" not in stack:
            whole = len(out), stack[::-1]
    if whole is None or not cut and (operand_next or "(" in stack):
        return None
    return out[:whole[0]] + whole[1]


def evaluate(expression: str, cut: bool = False) -> tuple[str, list[str]] | None:
    """(class of obligations, licence ids named) of an expression; None if malformed,
    unless ``cut`` and its start is well-formed."""
    order = postfix(expression, cut)
    if order is None:
        return None
    stack: list[tuple[int, str]] = []
    ids: list[str] = []
    for token in order:
        if token in STRENGTH:
            right, left = stack.pop(), stack.pop()
            if token == "or":
                stack.append(min(left, right))
            elif token == "and":
                stack.append(max(left, right))
            else:  # an exception: one step freer if the licence is a copyleft one
                rank = left[0] - (CLASSES[left[0]].endswith("copyleft"))
                if right[1] in ids:
                    ids.remove(right[1])
                stack.append((rank, left[1]))
        else:
            name = token.lower().rstrip(".:")
            ids.append(name)
            stack.append((CLASSES.index(family(name)), name))
    return CLASSES[stack[0][0]], sorted(set(ids))


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan_text(text: str | None, phrases) -> dict:
    words = words_of(text)
    line = b" ".join([b"", *words, b""]).decode("latin-1")   # one character per byte
    base: list[tuple[int, str]] = []
    labels: set[str] = set()
    notices: list[tuple[int, str]] = []
    tagged = False
    seen = spaces = 0
    for end, phrase in phrases.iter(line):                     # ends never go back
        spaces += line.count(" ", seen, end + 1)
        seen = end + 1
        start = spaces - phrase.count(" ") - 2                 # spaces before the phrase = words before it
        if phrase in BASE:
            base.append((start, BASE[phrase]))
        elif phrase == TAG:
            tagged = True
        else:
            notices.append((start, NOTICES[phrase]))
    expressions, ids, obligations = [], set(), set()
    tags = list(TAG_START.finditer(text)) if tagged else []
    for found, end in zip(tags, [*(after.start() for after in tags[1:]), None]):
        behind = text[found.end():end].partition("\n")[0]
        read = evaluate(behind, cut=True)
        if read:
            expressions.append(behind.strip())
            obligations.add(read[0])
            ids.update(read[1])
    base_labels = {label for _, label in base}
    labels = base_labels | {label for _, label in notices} | ids
    doubt = (1 - TAG_WEIGHT) ** len(expressions) * (1 - NOTICE_WEIGHT) ** len(
        base_labels | {label for _, label in notices})
    return {
        "n_words": len(words),
        "base": sorted(base),
        "notices": sorted(notices),
        "expressions": expressions,
        "obligations": sorted(obligations),
        "labels": sorted(labels),
        "score": 1.0 - doubt,
    }


PLACE = "array<struct<word:bigint,label:string>>"
SCHEMA = (f"n_words bigint, base {PLACE}, notices {PLACE}, expressions array<string>, "
          "obligations array<string>, labels array<string>, score double")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, word count, all phrase places, expressions as
    written, obligations, labels and score."""
    places = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    types = {"n_words": pa.int64(), "base": places, "notices": places,
             "expressions": pa.list_(pa.string()), "obligations": pa.list_(pa.string()),
             "labels": pa.list_(pa.string()), "score": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton()
        for batch in batches:
            rows = [scan_text(t, phrases) for t in batch.column(1).to_pylist()]
            for r in rows:
                for k in ("base", "notices"):
                    r[k] = [{"word": w, "label": x} for w, x in r[k]]
            cols = [pa.array([r[k] for r in rows], t) for k, t in types.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[id_col, *types])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")


__all__ = ["scan", "scan_text", "evaluate", "postfix", "automaton"]
