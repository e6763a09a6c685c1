"""Operators 7 and 10 against plain versions: counted dictionaries, no arrays, no Spark."""

import math
import re
from collections import Counter

import brute
import pytest
import xxhash
from conftest import SF_SMALL

from monthwise.llm import langid, quality, queries
from monthwise.llm.common import fold_of, table

MASK = (1 << 64) - 1


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang").collect()]


# ---------------------------------------------------------------- language mixtures
def grams(text):
    words = re.findall(rb"[a-z\x80-\xff]+", brute.lower_ascii(text or "").encode())
    data = b" ".join([b"", *words, b""])
    return Counter(data[i:i + 4] for i in range(len(data) - 3))


def bucket(gram):
    return (int.from_bytes(gram, "big") * langid.MIXER & 0xFFFFFFFF) >> (32 - langid.BITS)


def plain_model(docs):
    counts = {}
    for doc, text, lang in docs:
        if brute.fold(doc) != 1 and lang is not None and text is not None:
            into = counts.setdefault(lang, Counter())
            for g, n in grams(text).items():
                into[bucket(g)] += n
    out = {}
    for lang, n in counts.items():
        total = sum(n.values()) + langid.SMOOTHING * (1 << langid.BITS)
        out[lang] = lambda b, n=n, total=total: (n[b] + langid.SMOOTHING) / total
    return out


def plain_mixture(p, c, langs):
    """Expectation-maximisation: each gram is shared out by the languages' responsibilities."""
    total, pi = sum(c.values()), {x: 1 / len(langs) for x in langs}
    for _ in range(langid.ROUNDS):
        got = dict.fromkeys(langs, 0.0)
        for b, n in c.items():
            mass = sum(pi[x] * p[b][x] for x in langs)
            for x in langs:
                got[x] += n * pi[x] * p[b][x] / mass
        new = {x: got[x] / total for x in langs}
        done, pi = max(abs(new[x] - pi[x]) for x in langs) < 1e-3, new
        if done:
            break
    return pi, sum(n * math.log(sum(pi[x] * p[b][x] for x in langs)) for b, n in c.items())


def plain_language(text, model):
    """Of all prefixes of the languages, ordered by their proportions, the one with the greatest
    likelihood less half a log of the grams per further language."""
    c = Counter()
    for g, n in grams(text).items():
        c[bucket(g)] += n
    if text is None or not any(ch.isalpha() for ch in text):
        return "und", 0.0
    langs = sorted(model)
    p = {b: {x: model[x](b) for x in langs} for b in c}
    price = 0.5 * math.log(max(2, sum(c.values())))
    alone = {x: sum(n * math.log(p[b][x]) for b, n in c.items()) for x in langs}
    best = max(langs, key=lambda x: alone[x])
    choice, value = {best: 1.0}, alone[best]
    pi, _ = plain_mixture(p, c, langs)
    order = sorted(langs, key=lambda x: -pi[x])
    for size in range(2, len(langs) + 1):
        if pi[order[size - 1]] < 1e-3:
            break
        share, likelihood = plain_mixture(p, c, sorted(order[:size]))
        if likelihood - (size - 1) * price > value:
            choice, value = share, likelihood - (size - 1) * price
    top = max(sorted(choice), key=lambda x: choice[x])
    return top, min(1.0, choice[top])


def test_language_id_against_plain(spark, docs):
    model = plain_model(docs)
    short = {doc: text for doc, text, _ in docs if len(text or "") < 1200}
    two = [t for t in short.values() if t][:2]
    assert len(short) > 40 and sorted(model) == sorted({x for _, _, x in docs if x})
    got = {r.doc_id: r for r in queries.op7_language_id(spark, SF_SMALL).collect()}
    for doc, text in short.items():
        lang, score = plain_language(text, model)
        assert (got[doc].lang_pred, got[doc].held_out) == (lang, brute.fold(doc) == 1)
        assert abs(got[doc].score - score) < 1e-6
    # texts in two languages
    by_lang = {}
    for doc, text, lang in docs:
        if text and len(text) < 2000:
            by_lang.setdefault(lang, text)
    mixed = [(i, a + "\n" + b) for i, (a, b) in enumerate(zip(by_lang.values(), list(by_lang.values())[1:] + two[:1]))]
    learned = langid.train(table(spark, SF_SMALL, "documents"), fold_of() != 1)
    for r in langid.predict(spark.createDataFrame(mixed, "doc_id long, text string"), *learned).collect():
        lang, score = plain_language(dict(mixed)[r.doc_id], model)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-6


# ---------------------------------------------------------------- quality classifier
def plain_words(text):
    """Hashes of words with the two shapes in place."""
    out, last = [], None
    for m in re.finditer(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z\x80-\xff0-9 \t\n\r\x0b\x0c]+", (text or "").encode()):
        word = m.group()
        value = 0
        for i, b in enumerate(word.lower()):
            value = (value + (b + 1) * pow(quality.PRIME, i, 1 << 64)) & MASK
        if len(word) >= 2 and re.fullmatch(rb"[A-Z]+", word):
            out.append(int(quality.CAPITALS))
        else:
            out.append(int(quality.REPEAT) if value == last else value)
        last = value
    return out


def plain_features(text):
    words = plain_words(text)
    shift = 64 - quality.BITS
    found = Counter((w * quality.PRIME & MASK) >> shift for w in words)
    found.update(((a * 0xC2B2AE3D27D4EB4F + b) * 0x165667B19E3779F9 & MASK) >> shift for a, b in zip(words, words[1:]))
    return {b: quality.SCALE * n / len(words) for b, n in found.items()}


def plain_weights(rows):
    """Follow-the-regularised-leader over (features, label), one weight at a time; 'bias' is not penalised."""
    z, n = Counter(), Counter()

    def weight(i):
        penalty = 0.0 if i == "bias" else quality.L1
        if abs(z[i]) <= penalty:
            return 0.0
        return (math.copysign(penalty, z[i]) - z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
    for _ in range(quality.PASSES):
        for x, label in rows:
            x = {**x, "bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w[i] * v for i, v in x.items())))))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    return weight


def test_quality_against_plain(spark, docs):
    texts = {doc: text for doc, text, _ in docs}
    labels = [(r.doc_id, r.quality) for r in table(spark, SF_SMALL, "labels").collect()]
    learned = [(d, y) for d, y in labels if y in (0, 1) and d is not None and brute.fold(d) != 1 and d in texts]
    assert 20 < len(learned) < quality.SHARD_ROWS              # one shard: no average

    def place(doc):
        h = xxhash.xxh64_intdigest(doc.to_bytes(8, "little", signed=True), 42)
        return (h - (1 << 64) if h >> 63 else h) % (1 << 30)
    learned.sort(key=lambda r: (place(r[0]), r))
    weight = plain_weights([(plain_features(texts[d]), y) for d, y in learned])
    got = {r.doc_id: r for r in queries.op10_quality(spark, SF_SMALL).collect()}
    assert len(got) == len(texts)
    for doc, text in texts.items():
        total = weight("bias") + sum(weight(i) * v for i, v in plain_features(text).items())
        score = 1 / (1 + math.exp(-max(-35, min(35, total))))
        assert abs(got[doc].score - score) < 1e-6
        assert (got[doc].predicted, got[doc].held_out) == (int(got[doc].score >= 0.5), brute.fold(doc) == 1)
