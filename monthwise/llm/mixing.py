"""Mixing sources to target weights by hierarchical budgeting.

Documents hang below a tree domain > language > source.  Bottom-up, a node's capacity is
the sum over its leaves of tokens x ``max_epochs``.  Top-down, each node's budget is
shared among its children by weight; a child that cannot use its share keeps its capacity
and its siblings take up the rest by weight.  As capacities cover whole subtrees, a
shortage goes to siblings first and to an ancestor's siblings only once the whole
subtree is exhausted.  All shares are whole tokens, rounded down (a node's children
leave less than one token each unspent).

A leaf with a budget of e whole epochs and r tokens more takes every document e times
and, in epoch e + 1, the longest prefix of documents with at most r tokens in the
order of a hash seeded by (seed, epoch).  The prefix is found through buckets of the
hash: bucket sums per leaf, their running total, and exact running totals only
inside the one bucket per leaf in which the prefix ends - no leaf, however large, is
sorted in one task.  What comes out is a row per leaf: its whole epochs and the last place
taken.  A document's share follows from its leaf and its own place, so texts are neither
copied nor shuffled: they are read once more beside the table of leaves (broadcast up
to ``FEW`` leaves; a shuffle join beyond).

Tokens are maximal runs of characters other than space, tab, CR and LF.  NULL text
has none; documents without tokens follow their place in the order and cost nothing.
NULL sources or languages form leaves of their own (shown as NULL).  Ties in the order
(equal ids) are read together: all or none.  NULL ids hash alike, so they tie.  A weight of 0 means nothing
from there, whole subtrees included; the budget stays a fraction of all tokens.  Very long texts only
count more tokens.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import fresh, written

FEW = 1 << 16
LEAF = ["domain", "lang", "source"]
LAST_PLACE = 2**63 - 1


@dataclass(frozen=True)
class Mix:
    """Targets: whole-number weights, ``default`` for what is not named; ``budget`` as a
    fraction (numerator, denominator) of all tokens of the input."""

    domain_weights: dict[str, int] = field(default_factory=lambda: {"web": 5, "books": 3, "code": 2})
    lang_weights: dict[str, int] = field(default_factory=lambda: {"en": 4, "de": 2, "fr": 2, "es": 2})
    source_weights: dict[str, int] = field(default_factory=dict)
    default: int = 1
    budget: tuple[int, int] = (7, 10)
    max_epochs: int = 4
    seed: int = 17
    buckets: int = 4096
    domains: tuple[str, ...] = ("web", "books", "code")


def domain_of(mix: Mix) -> Column:
    """Domain of a source that no list assigns: dealt by the first MD5 digit of its name."""
    digit = F.substring(F.md5(F.coalesce(F.col("source").cast("string"), F.lit(""))), 1, 1)
    which = F.instr(F.lit("0123456789abcdef"), digit)
    return F.element_at(F.array(*map(F.lit, mix.domains)), (which % len(mix.domains)).cast("int") + 1)


def n_tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^ \\t\\r\\n]+")), F.lit(0)).cast("long")


def weight(column: str, weights: dict[str, int], default: int) -> Column:
    if not weights:
        return F.lit(default).cast("long")
    pairs = [F.lit(x) for kv in weights.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[F.coalesce(F.col(column), F.lit(""))], F.lit(default)).cast("long")


def share(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Adds ``budget`` to children (columns: parents, name, w, cap, parent_budget) by
    water-filling: in the order of cap / w the children that can't use their share are
    full; the others share what is left by weight."""
    over = Window.partitionBy(*parents).orderBy(F.col("cap") / F.col("w"), F.col("name").asc_nulls_first())
    before, after = over.rowsBetween(Window.unboundedPreceding, -1), over.rowsBetween(0, Window.unboundedFollowing)
    exact = "decimal(38,0)"
    rest = F.col("parent_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    nodes = nodes.withColumn("rest", rest.cast("long")).withColumn("w_rest", F.sum("w").over(after))
    full = F.col("cap").cast(exact) * F.col("w_rest") <= F.col("w").cast(exact) * F.col("rest")
    nodes = nodes.withColumn("full", full)
    # The first child that is not full fixes the rate for all after it.
    group = Window.partitionBy(*parents)
    open_rest = F.min(F.when(~F.col("full"), F.struct((-F.col("w_rest")).alias("k"), "rest", "w_rest"))).over(group)
    nodes = nodes.withColumn("at", open_rest)
    part = F.expr("cast(w as decimal(38,0)) * at.rest div at.w_rest")
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(part).cast("long")).drop(
        "rest", "w_rest", "full", "at")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source, tokens); zero-token
    leaves get budget 0, leaves below a weight of 0 are left out."""
    every = leaves
    for column, weights in (("domain", mix.domain_weights), ("lang", mix.lang_weights), ("source", mix.source_weights)):
        leaves = leaves.where(weight(column, weights, mix.default) > 0)
    leaves = leaves.withColumn("cap", F.col("tokens") * mix.max_epochs)
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
    domains = langs.groupBy("domain").agg(F.sum("cap").alias("cap"))
    num, den = mix.budget
    total = every.agg(F.expr(f"sum(tokens) * {num} div {den}").alias("parent_budget"))
    top = share(
        domains.crossJoin(F.broadcast(total))            # one row
        .withColumn("root", F.lit(0)).withColumn("name", F.col("domain"))
        .withColumn("w", weight("domain", mix.domain_weights, mix.default)), ["root"])
    middle = share(
        langs.join(top.select("domain", F.col("budget").alias("parent_budget")), "domain")
        .withColumn("name", F.col("lang")).withColumn("w", weight("lang", mix.lang_weights, mix.default)), ["domain"])
    low = middle.select("domain", F.col("lang").alias("lang_"), F.col("budget").alias("parent_budget"))
    bottom = (leaves.join(low, (leaves["domain"] == low["domain"]) & leaves["lang"].eqNullSafe(low["lang_"]))
              .drop(low["domain"]).drop("lang_"))
    bottom = share(
        bottom.withColumn("name", F.col("source")).withColumn("w", weight("source", mix.source_weights, mix.default)),
        ["domain", "lang"])
    return bottom.select("domain", "lang", "source", "tokens", "budget")


def order_hash(mix: Mix, epoch: Column) -> Column:
    """63-bit place of a document in an epoch: the first digits of an MD5 of (seed, epoch, id)."""
    key = F.concat_ws("|", F.lit(str(mix.seed)), epoch.cast("string"), F.col("doc").cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def same_leaf(prefix: str) -> Column:
    on = F.lit(True)
    for c in LEAF:
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return on


def leaf_cuts(docs: DataFrame, mix: Mix) -> DataFrame:
    """(b_domain, b_lang, b_source, whole, last) for documents (doc, domain, lang, source, tokens): a
    document is taken ``whole`` times, and once more if its place in the next epoch's order
    is at most ``last``."""
    leaves = docs.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"))
    budgets = written(leaf_budgets(leaves, mix).withColumn(
        "whole", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0))).withColumn(
        "left", F.col("budget") - F.col("whole") * F.col("tokens")).select(
        *[F.col(c).alias(f"b_{c}") for c in LEAF], "whole", "left"), "budgets")
    bits = 60 - (mix.buckets - 1).bit_length()
    placed = docs.join(budgets, same_leaf("b_")).select(            # a row per leaf: small, or split by the join
        *LEAF, "tokens", "left", order_hash(mix, F.col("whole") + 1).alias("place")
    ).withColumn("bucket", F.shiftright("place", bits))
    # Running totals of bucket sums, at most ``buckets`` rows per leaf.
    sums = placed.groupBy(*LEAF, "bucket", "left").agg(F.sum("tokens").alias("n"))
    running = F.sum("n").over(Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    # The prefix ends in the first bucket whose total passes what is left.
    cut = (sums.withColumn("upto", running).where(F.col("upto") > F.col("left"))
           .groupBy(*LEAF).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("cut")))
    cut = written(cut.select(*[F.col(c).alias(f"c_{c}") for c in LEAF], F.col("cut.bucket").alias("cut_bucket"),
                             F.col("cut.before").alias("before")), "cuts")
    inside = placed.join(cut, same_leaf("c_")).where(F.col("bucket") == F.col("cut_bucket"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEAF).orderBy("place"))     # range frame: ties together
    reached = (inside.withColumn("upto", upto + F.col("before")).where(F.col("upto") <= F.col("left"))
               .groupBy(*LEAF).agg(F.max("place").alias("reached")).toDF(*[f"r_{c}" for c in LEAF], "reached"))
    # Without a cut every document is taken; with one, at least all before its bucket.
    last = F.coalesce("reached", F.shiftleft("cut_bucket", bits) - 1, F.lit(LAST_PLACE))
    out = budgets.toDF(*LEAF, "whole", "left").join(cut, same_leaf("c_"), "left").join(reached, same_leaf("r_"), "left")
    return out.select(*[F.col(c).alias(f"b_{c}") for c in LEAF], "whole", last.alias("last"))


def with_epochs(docs: DataFrame, cuts: DataFrame, mix: Mix) -> DataFrame:
    """The documents that are taken, and ``epochs``, how often."""
    rows = docs.join(F.broadcast(cuts) if cuts.count() <= FEW else cuts, same_leaf("b_"))
    more = (order_hash(mix, F.col("whole") + 1) <= F.col("last")).cast("int")
    return rows.withColumn("epochs", (F.col("whole") + more).cast("int")).where("epochs > 0")


def select_prefixes(docs: DataFrame, mix: Mix) -> DataFrame:
    """(row, epochs) for documents (row, doc, domain, lang, source, tokens) that are taken."""
    return with_epochs(docs, written(leaf_cuts(docs, mix), "leaf-cuts"), mix).select("row", "epochs")


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``docs`` in the target mix: a row per document and epoch, with all columns of
    the input and ``domain``, ``tokens`` and ``epoch`` (from 1; clashing columns are replaced)."""
    named = [F.col("doc_id").cast("long").alias("doc"), domain_of(mix).alias("domain"), F.col("lang").cast("string").alias("lang"),
             F.col("source").cast("string").alias("source"), n_tokens().alias("tokens")]
    cuts = written(leaf_cuts(written(docs.select(*named), "token-sizes"), mix), "leaf-cuts")
    mine, got = [c for c in docs.columns if c.lower() not in ("domain", "tokens", "epoch")], fresh(docs, "own")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in mine]).alias(got), *named)
    return with_epochs(rows, cuts, mix).select(
        *[F.col(f"`{got}`.`{c}`") for c in mine], "domain", "tokens", F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("epoch"))
