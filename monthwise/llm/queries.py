"""Registered queries of the operators, over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm import (decontaminate, divergence, fingerprints, langid, licenses, line_dedup, mixing, quality, simhash,
                           token_counts, topk, vector_codes, warc)
from monthwise.llm.common import fold_of, table
from monthwise.session import new_work_path

TOKENIZER = "byte_bpe_50k.json"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines (on 10 or more sources), first copies kept."""
    out = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col("n_lines").cast("long").alias("n_lines"),
                      F.col("n_removed").cast("long").alias("n_removed"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, identifier tags and expressions per document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score", F.array_join("expressions", "; ").alias("expressions"),
        F.array_join("obligations", ",").alias("obligations"))


def op3_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Tokens per document under a public byte-level BPE vocabulary."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) within an edit budget of 10 % of the item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 greatest inner products of every 20th vector against all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives, read back and assembled to captures."""
    path = new_work_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path, min_bytes=0)
    captures = warc.transactions(spark, path, payloads=False).select(
        "capture", "type", "digest", "refers_to", "response.bytes", F.col("response.digest").alias("computed"),
        F.size("requests").alias("n_requests"),
        F.regexp_extract(F.col("metadata")[0]["fields"], r"page-id: (-?\d+)", 1).try_cast("long").alias("page_id"))
    # A revisit has no payload of its own: size and digest are those of the response it refers
    # to (a response stands for itself, so no key gathers the rows that refer to nothing).
    originals = captures.where("type = 'response'").select(
        F.col("capture").alias("origin"), F.col("page_id").alias("to_page"), "bytes", "computed")
    return captures.select("page_id", "type", F.coalesce("refers_to", "capture").alias("origin")).join(
        originals, "origin", "left").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("computed").alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(F.col("type") == "revisit", F.col("to_page")).alias("refers_to"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language by mixture inference, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, fold_of() != 1)
    held = docs.withColumn("held_out", F.coalesce(fold_of() == 1, F.lit(False)))
    return langid.predict(held, *model, keep=["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", "score",
        F.array_join(F.transform("mixture", lambda m: m["lang"]), ",").alias("languages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and their components at 2 or fewer differing bits."""
    return simhash.component_ids(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and epochs of the target mix."""
    return mixing.mixed(table(spark, sf_dir, "documents"), mixing.Mix()).select(
        "doc_id", "domain", "lang", "source", "tokens", "epoch")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    weights = quality.train(docs, table(spark, sf_dir, "labels"), fold_of() != 1)
    held = docs.withColumn("held_out", F.coalesce(fold_of() == 1, F.lit(False)))
    return quality.score(held, weights, ["doc_id", "held_out"]).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash fingerprints of every document and its edited text, with their likeness."""
    made = fingerprints.with_edits(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_chars", "edited_sha256", fingerprints.as_text(F.col("packed")).alias("fingerprint"),
                       fingerprints.as_text(F.col("edited_packed")).alias("edited_fingerprint"), "near_edited", "near_next")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight-part codes of every vector after six rounds, with errors and the codebooks' digest."""
    coded, fitted = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    digest = vector_codes.codebook_digest(fitted.books) if fitted else F.lit(None).cast("string")
    return coded.select("vec_id", digits.alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between the sources of each language, and the terms each source overuses."""
    return divergence.audit(table(spark, sf_dir, "documents")).select("lang", "source", "part", "item", "value", "rank")


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_line_dedup, op2_license_scan, op3_token_counts, op4_decontamination, op5_exact_topk, op6_warc,
        op7_language_id, op8_simhash, op9_mixing, op10_quality, op11_fingerprints, op12_vector_codes, op13_divergence)}


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, source, u.line, u.pos FROM documents,
  LATERAL (SELECT unnest(string_split(text, chr(10))) AS line,
                  unnest(range(len(string_split(text, chr(10))))) AS pos) u),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
boiler AS (
  SELECT k, min((coalesce(doc_id, 9223372036854775807), pos)) AS first FROM keyed WHERE k <> ''
  GROUP BY k HAVING count(DISTINCT source) >= 10),
marked AS (
  SELECT keyed.*, b.k IS NOT NULL AND (coalesce(doc_id, 9223372036854775807), pos) <> b.first AS gone
  FROM keyed LEFT JOIN boiler b USING (k)),
rest AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
         count(*) FILTER (WHERE k <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
  FROM marked GROUP BY doc_id)
SELECT doc_id, text, n_lines, n_removed FROM rest
UNION ALL SELECT doc_id, text, 0, 0 FROM documents WHERE text IS NULL
"""

OP5_SQL = """
WITH q AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row, a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.row <> b.row AND len(a.v) = len(b.v) WHERE a.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

OP6_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (list_sum(list_transform(range(5), lambda j:
      (strpos('0123456789abcdef', substr(h, (i // 4) * 5 + j + 1, 1)) - 1) * (16 ** (4 - j))::BIGINT))::BIGINT
      // (32 ** (3 - i % 4))::BIGINT % 32 + 1)::INT, 1)), '') AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to FROM k
"""


def _fill(level: str, source: str, parents: str, name: str, weight: str) -> str:
    """Water-filling of one level of the tree: see mixing.share."""
    return f"""
{level}_o AS (
  SELECT *, row_number() OVER (PARTITION BY {parents} ORDER BY cap::DOUBLE / w, {name} NULLS FIRST) AS rn
  FROM (SELECT *, {weight} AS w FROM {source})),
{level}_r AS (
  SELECT *, parent_budget - coalesce(sum(cap) OVER (PARTITION BY {parents} ORDER BY rn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (PARTITION BY {parents} ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest
  FROM {level}_o),
{level}_f AS (SELECT *, cap::HUGEINT * w_rest <= w::HUGEINT * rest AS is_full FROM {level}_r),
{level} AS (
  SELECT *, CASE WHEN is_full THEN cap ELSE
     w::HUGEINT * (min(rest) FILTER (WHERE NOT is_full AND rn = f) OVER (PARTITION BY {parents}))
     // (min(w_rest) FILTER (WHERE NOT is_full AND rn = f) OVER (PARTITION BY {parents})) END AS budget
  FROM (SELECT *, min(rn) FILTER (WHERE NOT is_full) OVER (PARTITION BY {parents}) AS f FROM {level}_f)),"""


def _case(column: str, weights: dict[str, int], default: int) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {default} END"


def op9_sql(mix: mixing.Mix = mixing.Mix()) -> str:
    num, den = mix.budget
    domains = "[" + ", ".join(f"'{d}'" for d in mix.domains) + "]"
    return f"""
WITH docs AS (
  SELECT doc_id, lang, source, coalesce(len(regexp_extract_all(text, '[^ \\t\\r\\n]+')), 0)::BIGINT AS tokens,
         {domains}[strpos('0123456789abcdef', substr(md5(coalesce(source, '')), 1, 1)) % {len(mix.domains)} + 1] AS domain
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * {mix.max_epochs} AS cap
           FROM docs GROUP BY ALL),
tops AS (SELECT domain, 0 AS root, sum(cap)::BIGINT AS cap,
                (SELECT sum(tokens)::HUGEINT * {num} // {den} FROM leaves) AS parent_budget FROM leaves GROUP BY domain),
{_fill("dom", "tops", "root", "domain", _case("domain", mix.domain_weights, mix.default))}
langs AS (SELECT l.domain, l.lang, sum(l.cap)::BIGINT AS cap, any_value(d.budget) AS parent_budget
          FROM leaves l JOIN dom d USING (domain) GROUP BY l.domain, l.lang),
{_fill("lan", "langs", "domain", "lang", _case("lang", mix.lang_weights, mix.default))}
srcs AS (SELECT l.*, a.budget AS parent_budget FROM leaves l JOIN lan a
         ON l.domain = a.domain AND l.lang IS NOT DISTINCT FROM a.lang),
{_fill("src", "srcs", "domain, lang", "source", str(mix.default))}
placed AS (
  SELECT d.*, CASE WHEN s.tokens > 0 THEN s.budget // s.tokens ELSE 0 END AS whole, s.budget AS budget,
         s.tokens AS leaf_tokens
  FROM docs d JOIN src s ON d.domain = s.domain AND d.lang IS NOT DISTINCT FROM s.lang
                         AND d.source IS NOT DISTINCT FROM s.source),
upto AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
              ORDER BY substr(md5('{mix.seed}|' || (whole + 1)::VARCHAR || coalesce('|' || doc_id::VARCHAR, '')), 1, 15)) AS upto
  FROM placed),
taken AS (
  SELECT *, whole + CASE WHEN upto <= budget - whole * leaf_tokens THEN 1 ELSE 0 END AS epochs FROM upto)
SELECT doc_id, domain, lang, source, tokens, unnest(range(1, epochs::INT + 1))::INT AS epoch FROM taken WHERE epochs > 0
"""


def op12_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """The rounds unrolled, every part against every entry."""
    nearest = """
a{r} AS (
  SELECT vec_id, label, part, v, min((d, entry)) AS best FROM (
    SELECT p.*, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM p JOIN b{r} b USING (part)) GROUP BY ALL),"""
    step = """
c{r} AS (
  SELECT part, entry, list(floor(s / n::HUGEINT)::BIGINT ORDER BY pos) AS v FROM (
    SELECT part, best[2] AS entry, pos, sum(v[pos])::HUGEINT AS s, count(*) AS n
    FROM a{r}, range(1, (SELECT max(len(v)) FROM p) + 1) t(pos) GROUP BY ALL) GROUP BY ALL),
b{n} AS (SELECT part, entry, coalesce(c.v, b.v) AS v FROM b{r} b LEFT JOIN c{r} c USING (part, entry)),"""
    # Integer division that rounds down, also below zero.
    step = step.replace("floor(s / n::HUGEINT)::BIGINT", "((s - ((s % n) + n) % n) // n)::BIGINT")
    body = "".join(nearest.format(r=r) + step.format(r=r, n=r + 1) for r in range(rounds)) + nearest.format(r=rounds)
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT vec_id, label, part, v[part * len(v) // 8 + 1 : (part + 1) * len(v) // 8] AS v FROM kept, range(8) t(part)),
b0 AS (
  SELECT part, entry, p.v FROM (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 16) JOIN p USING (vec_id)),
{body}
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best[2]::INT), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM coded
"""


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term FROM c GROUP BY ALL HAVING count(*) >= 30),
vs AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
s AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM c JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(s.n, 0)::HUGEINT AS n FROM g JOIN kept k USING (lang)
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
  FROM cells JOIN vs USING (lang)),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM s GROUP BY ALL) JOIN vs USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(f), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p))::BIGINT AS f
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) z
  ON z.lang = a.lang AND z.source = a.source AND z.other = b.source GROUP BY ALL),
over AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM over) WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op5_exact_topk": OP5_SQL, "op6_warc": OP6_SQL, "op9_mixing": op9_sql(),
            "op12_vector_codes": op12_sql(), "op13_divergence": OP13_SQL}
