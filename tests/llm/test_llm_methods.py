"""The methods themselves against brute force, on small data."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from monthwise.llm import (decontaminate, langid, licenses, line_dedup, mixing, quality, simhash, token_counts, topk,
                           warc)
from monthwise.llm.common import components, fold_of, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("expression,kind,ids", [
    ("MIT", "permissive", ["mit"]),
    ("MIT OR GPL-3.0-only", "permissive", ["gpl-3.0-only", "mit"]),
    ("MIT AND GPL-3.0-only", "copyleft", ["gpl-3.0-only", "mit"]),
    ("GPL-2.0-only WITH Classpath-exception-2.0", "weak-copyleft", ["gpl-2.0-only"]),
    ("MIT AND (Apache-2.0 OR AGPL-3.0) */", "permissive", ["agpl-3.0", "apache-2.0", "mit"]),
    ("MIT OR Apache-2.0 AND AGPL-3.0", "permissive", ["agpl-3.0", "apache-2.0", "mit"]),
    ("(MIT OR Apache-2.0) AND AGPL-3.0", "network-copyleft", ["agpl-3.0", "apache-2.0", "mit"]),
    ("LicenseRef-own", "unknown", ["licenseref-own"]),
])
def test_expressions(expression, kind, ids):
    assert licenses.evaluate(expression) == (kind, ids)


@pytest.mark.parametrize("bad", ["", "AND MIT", "MIT OR", "(MIT", "()", ") MIT"])
def test_malformed_expressions(bad):
    assert licenses.evaluate(bad) is None


def test_license_places_match_brute_force():
    rng = random.Random(1)
    parts = ["cc", "by", "CC-BY", "general", "Public", "License", "all", "rights", "reserved", "é", "x", "\n", " . ",
             "SPDX-License-Identifier: MIT OR GPL-2.0", "nc", "lesser"]
    phrases = licenses.automaton()
    for _ in range(400):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        got = licenses.scan_text(text, phrases)
        n, places, labels = brute.license_base(text)
        assert (got["n_words"], got["base"]) == (n, places) and set(labels) <= set(got["labels"])
        assert ("mit" in got["labels"]) == ("SPDX" in text) and 0 <= got["score"] <= 1


def test_pretokens_match_the_library():
    public = pytest.importorskip("public_tokenizers")
    cutter = token_counts.Splitter(public.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    chars = [chr(c) for c in range(1, 0x250)]
    odd = [" ", "　", "日", "½", "\x85", "٣", "Ⅷ", "é", "é", "\U0001F600", "<|endoftext|>", "'s", "'LL", "  "]
    for c in chars + [chr(c) for c in rng.sample(range(0x250, 0xD800), 500)]:
        for text in (f"a{c}b", f" {c}{c} 1{c}", f"{c}'s  {c}"):
            assert cutter.cut(text)[0] == [text[a:b] for _, (a, b) in cutter.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    for _ in range(500):
        text = "".join(rng.choice(chars if rng.random() < .7 else odd) for _ in range(rng.randint(0, 60)))
        pretokens, special = cutter.cut(text)
        want = len(cutter.tokenizer.encode(text, add_special_tokens=False).ids)
        assert sum(cutter.pieces(pretokens)) + special == want, repr(text)


def test_myers_matches_the_table():
    rng = random.Random(3)
    for _ in range(400):
        pattern = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 60)))
        if rng.random() < .5:
            copy = list(pattern)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(["", "a", "bb"])
            text = text[:10] + "".join(copy) + text[10:]
        want = brute.best_distance(pattern, text)
        got = decontaminate.myers(pattern, text, len(pattern))
        assert got[0] == want
        assert (decontaminate.myers(pattern, text, max(0, want - 1)) is None) == (want > 0)


def test_leaks_within_the_budget_are_all_found(spark):
    rng = random.Random(4)
    words = ["the", "ond", "her", "was", "stand", "ering", "of", "émen", "tion", "a"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(8, 30)))) for i in range(12)]
    docs = []
    for d in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))
        if d % 2:
            copy = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 14)):
                copy[rng.randrange(len(copy))] = rng.choice(["", "x", "yz", ". ", "E"])
            text = text + " " + "".join(copy) + " " + text
        docs.append((d, text))
    got = {(r.doc_id, r.item_id): r.edit_distance for r in decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            pattern = brute.norm(item)
            distance = brute.best_distance(pattern, brute.norm(text))
            if distance <= int(len(pattern) * decontaminate.ERROR_RATE):
                want[d, i] = distance
    assert got == want and 10 < len(want)


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(5)
    pool = [f"line {i}" for i in range(30)] + ["", "  ", " line 1 "]
    rows = [(d, f"s{rng.randrange(20)}" if rng.random() < .9 else None,
             None if rng.random() < .05 else "\n".join(rng.choice(pool[:rng.choice([3, 33])]) for _ in range(rng.randrange(8))))
            for d in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(5)
    for sites in (2, 8, 18):
        got = line_dedup.remove_boilerplate(df, min_sites=sites)
        assert sorted(got.select("doc_id", "text", "n_removed").collect(), key=lambda r: r[0]) == brute.boilerplate(rows, sites)


def test_near_threshold_lines_are_counted_exactly(spark):
    """Small sketches and thousands of sites: estimates are off, decisions are not."""
    rows = [(n * 10_000 + s, f"s{s}", f"spread {n}") for n in (950, 999, 1000, 1001, 1050) for s in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    found = line_dedup.boilerplate(df, min_sites=1000, lg_k=6, band=0.6)
    assert sorted(r.first_doc // 10_000 for r in found.collect()) == [1000, 1001, 1050]


def test_simhash_matches_all_pairs(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(220):
        if rows and rng.random() < .6:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 10, 200]))]
        rows.append((d, " ".join(words)))
    want = sorted(brute.simhash_components(rows))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for tile in (4096, 3):
        got = sorted(map(tuple, simhash.component_ids(df, tile=tile).collect()))
        assert got == want
    assert any(c != d for d, _, c in want)


def test_links_of_a_dense_cluster(spark):
    """Fingerprints within few bits of each other: components equal those of all pairs."""
    rng = random.Random(7)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for _ in range(150)}
                 | {rng.getrandbits(64) for _ in range(50)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    parent = {f: f for f in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 2:
                x, y = sorted((root(signed[i]), root(signed[j])))
                parent[y] = x
    want = {f: root(f) for f in signed}
    for tile in (4096, 16):
        edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), tile=tile)
        got = {r.node: r.component for r in components(edges).collect()}
        assert {f: got.get(f, f) for f in signed} == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(400).selectExpr("(id * 37) % 401 a", "((id + 1) * 37) % 401 b").where("a <> 200 and b <> 200")
    got = {r.node: r.component for r in components(edges).collect()}
    chain = [(i * 37) % 401 for i in range(401)]
    cut = chain.index(200)
    want = {n: min(part) for part in (chain[:cut], chain[cut + 1:]) if len(part) > 1 for n in part}
    assert got == want


@pytest.mark.parametrize("seed,sizes", [(8, (700, 8, 16, 64)), (9, (50, 3, 4, 7))])
def test_topk_matches_all_pairs(spark, seed, sizes):
    n, pivots, query_block, data_block = sizes
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 6))
    x = (centres[rng.integers(0, 5, n)] + 0.1 * rng.normal(size=(n, 6))).astype(np.float32)
    x[: n // 4] = x[0]                                                          # a third of ties
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = topk.top_k(df.repartition(3), F.col("vec_id") % 20 == 0, k=20, n_pivots=pivots, query_block=query_block,
                     data_block=data_block)
    q = np.floor(64 * x.astype(np.float64)).astype(np.int64)
    want = []
    for i in range(0, n, 20):
        scores = q @ q[i]
        best = sorted((j for j in range(n) if j != i), key=lambda j: (-scores[j], j))[:20]
        want += [(i, r + 1, j, int(scores[j])) for r, j in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_bounds_prune_far_cells():
    """Well separated clusters: the interval of a query cell excludes the others' vectors."""
    pivots = np.array([[0.0, 0.0, 0.0], [100.0, 0.0, 0.0]])
    near = np.array([[0.0, 0.5, 1.0], [0.0, 0.5, 1.0]])
    low, high = topk.reach(np.array([1.0]), topk.distances(pivots[:1], pivots), near, k=2)
    assert low[0, 0] < 0 < high[0, 0] and low[0, 1] > 90


def test_mixture_finds_two_languages(spark):
    docs = table(spark, SF, "documents").where("lang in ('en', 'fr')")
    langs, p = langid.train(docs, F.lit(True))
    en, fr = (docs.where(F.col("lang") == x).where("n_chars > 2000").orderBy("doc_id").first().text for x in ("en", "fr"))
    two = spark.createDataFrame([(1, en[:2000] + " " + fr[:1000]), (2, en)], "doc_id bigint, text string")
    mixed, pure = langid.predict(two, langs, p).orderBy("doc_id").collect()
    assert [m.lang for m in mixed.mixture] == ["en", "fr"] and 0.5 < mixed.mixture[0].share < 0.85
    assert [m.lang for m in pure.mixture] == ["en"] and pure.score == 1.0


def test_em_increases_the_likelihood():
    rng = np.random.default_rng(0)
    p, c = rng.dirichlet(np.ones(50), 3).T, rng.integers(1, 9, 50).astype(float)
    values = [langid.mixture(p, c, r)[1] for r in range(1, 8)]
    assert all(b >= a - 1e-9 for a, b in zip(values, values[1:]))


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Vérités et the words, 12 of it. " * 50
    whole = langid.grams(text, 4, 16)
    monkeypatch.setattr(langid, "CHUNK", 101)
    parts = langid.grams(text, 4, 16)
    assert (whole == parts).all()


def accuracy(df, truth):
    held = [r for r in df.collect() if r.held_out and r.doc_id in truth]
    return sum(r[2] == truth[r.doc_id] for r in held) / len(held)


def test_held_out_accuracy(spark):
    from monthwise.llm import queries
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    assert accuracy(queries.op7_language_id(spark, sf).select("doc_id", "held_out", "lang_pred"), langs) > 0.98
    good = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    assert accuracy(queries.op10_quality(spark, sf).select("doc_id", "held_out", "predicted"), good) > 0.97


def test_word_hashes_do_not_depend_on_place():
    hasher = quality.Hasher(18)
    a, b = hasher.words(b"one two three"), hasher.words(b"  three!! ONE two.two two")
    assert a[2] == b[0] and a[1] == b[3]
    assert b[2] == quality.CAPITALS and b[-1] == quality.REPEAT and len(b) == 7


def test_scores_do_not_depend_on_cuts(monkeypatch):
    weights = np.random.default_rng(1).normal(size=(1 << 18) + 1)
    texts = ["Some words, and some more of them! " * 40, "", None, "x"]
    whole = quality.Hasher(18).scores(texts, weights)
    monkeypatch.setattr(quality, "CHUNK", 64)
    assert np.allclose(quality.Hasher(18).scores(texts[:1], weights)[0], whole[0], rtol=0.15)
    where, value = quality.Hasher(18).features(texts[0])
    assert np.isclose(weights[-1] + weights[where] @ value, quality.Hasher(18).scores(texts[:1], weights)[0], rtol=0.15)
    assert whole[1] == whole[2] == weights[-1]


def water_fill(budget, children):
    """[(weight, capacity)] by small steps of exact rounds."""
    out = [0.0] * len(children)
    left, alive = float(min(budget, sum(c for _, c in children))), set(range(len(children)))
    while left > 1e-9 and alive:
        total = sum(children[i][0] for i in alive)
        step = min([left / total] + [(children[i][1] - out[i]) / children[i][0] for i in alive])
        for i in list(alive):
            out[i] += step * children[i][0]
            if out[i] >= children[i][1] - 1e-9:
                alive.discard(i)
        left -= step * total
    return out


def test_budgets_match_water_filling(spark):
    rng = random.Random(11)
    mix = mixing.Mix(budget=(3, 2), max_epochs=2)
    leaves = [(d, x, f"s{i}", rng.randrange(0, 2000)) for d in ("web", "books", "code") for x in ("en", "fr", None)
              for i in range(rng.randrange(1, 5))]
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(
        spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint"), mix).collect()}
    total = sum(x[3] for x in leaves) * 3 // 2
    domains = sorted({x[0] for x in leaves})
    cap = {d: sum(2 * x[3] for x in leaves if x[0] == d) for d in domains}
    tops = dict(zip(domains, water_fill(total, [(mix.domain_weights[d], cap[d]) for d in domains])))
    for d in domains:
        langs = sorted({x[1] for x in leaves if x[0] == d}, key=str)
        mids = water_fill(tops[d], [(mix.lang_weights.get(x, 1), sum(2 * y[3] for y in leaves if y[:2] == (d, x))) for x in langs])
        for x, budget in zip(langs, mids):
            own = [y for y in leaves if y[:2] == (d, x)]
            for y, b in zip(own, water_fill(budget, [(1, 2 * y[3]) for y in own])):
                assert abs(got[y[:3]] - b) <= 4, (y, b, got[y[:3]])
    assert abs(sum(got.values()) - min(total, sum(2 * x[3] for x in leaves))) <= 4 * len(leaves)


def test_prefixes_match_a_full_sort(spark):
    import hashlib
    rng = random.Random(12)
    docs = [(i, i, "web", "en", f"s{i % 3 if i % 3 else 0}", rng.randrange(0, 50)) for i in range(900)]
    mix = mixing.Mix(domain_weights={"web": 1}, budget=(5, 4), buckets=16, source_weights={"s0": 5})
    df = spark.createDataFrame(docs, "row bigint, doc bigint, domain string, lang string, source string, tokens bigint")
    got = {r.row: r.epochs for r in mixing.select_prefixes(df, mix).collect()}
    leaves = df.groupBy("domain", "lang", "source").agg(F.sum("tokens").alias("tokens"))
    for leaf in mixing.leaf_budgets(leaves, mix).collect():
        whole, left = divmod(leaf.budget, leaf.tokens)
        own = sorted((x for x in docs if x[4] == leaf.source),
                     key=lambda x: hashlib.md5(f"{mix.seed}|{whole + 1}|{x[1]}".encode()).hexdigest())
        upto = 0
        for x in own:
            upto += x[5]
            assert got.get(x[0], 0) == whole + (upto <= left), (leaf, x)


def test_transactions_through_requests(spark):
    """Metadata may be concurrent to the request or to the response."""
    rec = spark.createDataFrame([
        ("r1", "response", None, None, "u", "d", bytearray(b"abc"), "x", None),
        ("q1", "request", "r1", None, "u", None, None, None, None),
        ("m1", "metadata", "q1", None, "u", None, None, None, "via: request"),
        ("m2", "metadata", "r1", None, "u", None, None, None, "via: response"),
        ("m3", "metadata", "gone", None, "u", None, None, None, "orphan"),
        ("v1", "revisit", None, "r1", "u", "d", None, None, None)], warc.RECORD_SCHEMA)
    got = {r.capture: r for r in warc.assemble(rec).collect()}
    assert set(got) == {"r1", "v1"} and got["v1"].response is None and got["v1"].metadata is None
    assert sorted(m.metadata_id for m in got["r1"].metadata) == ["m1", "m2"] and got["r1"].response.bytes == 3


def test_archives_of_many_gzip_members(spark, workdir):
    import gzip
    one = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 9\r\n\r\nH\r\n\r\nbody\r\n\r\n"
    two = one.replace(b"<a>", b"<b>")
    with open(workdir + "/x.warc.gz", "wb") as f:
        f.write(gzip.compress(one) + gzip.compress(two))
    with open(workdir + "/y.warc", "wb") as f:
        f.write(one.replace(b"<a>", b"<c>"))
    got = warc.read_records(spark, workdir).collect()
    assert sorted((r.record_id, bytes(r.payload)) for r in got) == [("<a>", b"body"), ("<b>", b"body"), ("<c>", b"body")]

def test_a_long_item_needs_little_memory():
    """50,000 characters, its copy in a longer text with edits in every part."""
    import tracemalloc
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(7200)]
    tracemalloc.start()
    matcher = decontaminate.Matcher([(7, " ".join(words))], 0.1)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 20 << 20
    copy = [w if i % 15 else w[:-1] + "x" for i, w in enumerate(words)]
    edits = sum(w != c for w, c in zip(words, copy))
    (item, distance, length, first), = matcher.matches("other words " + " ".join(copy) + " and more")
    assert (item, distance, first) == (7, edits, 2) and length > 50_000
    assert matcher.matches(" ".join(words[:3000])) == []


def test_archives_are_bounded_by_bytes_and_parsed_once(spark, workdir):
    """Pages of many sizes; the registered form reads each archive once."""
    import glob
    import gzip
    sizes = [0, 10, 64 << 10, (64 << 10) + 1, 300 << 10, 2 << 20, 3 << 20, 17 << 20] + [200 << 10] * 20
    pages = spark.createDataFrame([(i, "http://h/", chr(97 + i % 26) * n) for i, n in enumerate(sizes)],
                                  "page_id bigint, url string, html string").coalesce(1)
    warc.write_archives(pages, workdir + "/w", archive_bytes=4 << 20)
    files = glob.glob(workdir + "/w/part-*")
    whole = [len(gzip.open(f).read()) for f in files]
    assert sum(n > (5 << 20) for n in whole) == 1 and max(whole) < 18 << 20          # one capture, larger itself
    for payloads in (True, False):
        got = warc.transactions(spark, workdir + "/w", payloads).collect()
        assert len(got) == len(sizes)
        if payloads:
            assert all(len(r.response.payload) == r.response.bytes for r in got if r.type == "response")
        else:
            assert "payload" not in got[0].response
    plan = warc.transactions(spark, workdir + "/w", False)._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "MapInArrow" not in plan


def test_tokens_of_a_warm_key_spread_and_other_pretokenizers_are_refused(spark, workdir):
    import json

    from monthwise.llm import token_counts
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    texts = [f"word{i} zyxwvut" if i % 10 < 5 else f"other{i}" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    got = token_counts.token_counts(docs, path, hot_docs=8, block_docs=10)
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got.collect()} == {
        i: (len(t), len(library.encode(t).ids)) for i, t in enumerate(texts)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}},
                   {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}}):
        with open(workdir + "/t.json", "w", encoding="utf-8") as f:
            json.dump({**spec, "model": {}, **change}, f)
        with pytest.raises(ValueError):
            token_counts.token_counts(docs, workdir + "/t.json")
