"""Cross-site boilerplate removal by the distinct-site spread of lines.

Lines with fewer rows than ``min_sites`` cannot be on so many sites; a count per line hash
sets them aside.  For the others a HyperLogLog sketch of the sites is built per line hash with
partial aggregation (sketches merge, so a line on a third of all rows reaches the reducer as
one sketch per task).  Estimates clearly above or below the threshold decide at once; lines
whose estimate is near it get an exact distinct count.  Lines on ``min_sites`` or
more sites are boilerplate: of their copies only the first - smallest (doc_id,
line number), NULL ids last - stays.

Lines are compared after trimming spaces, tabs and carriage returns.  Blank lines
are never removed.  A NULL site adds no site.  NULL text stays NULL, empty text
stays empty, an empty table gives an empty result; repeated rows count their sites
once, and both rows lose the line unless they hold the first copy (rows with
equal ids at the same line number tie and both keep it).  Rows are told apart by id and a
128-bit hash of their text, which every scan gives alike.  A very long text is one array of
lines in its own row, its work linear in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import fresh, written

MIN_SITES = 10
LG_K = 12          # sketch of 2^12 registers: relative standard error 1.6 %
BAND = 0.25        # estimates within 25 % of the threshold are counted exactly
LAST_ID = 2**63 - 1


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def lines(docs: DataFrame, site: str) -> DataFrame:
    """One row per non-blank line: (site, doc, pos, h1, h2); the two hashes are
    the 128-bit line hash."""
    return (
        docs.select(F.col(site).cast("string").alias("site"),
                    F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
                    F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .withColumn("line", line_key(F.col("line")))
        .where("line <> ''")
        .select("site", "doc", "pos", F.xxhash64("line").alias("h1"),
                F.xxhash64(F.lit(1), F.col("line")).alias("h2"))
    )


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` sites, with the place of the
    copy that stays: (h1, h2, n_sites_estimate, first_doc, first_pos)."""
    every = lines(docs, site)
    often = written(every.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("h1", "h2"),
                    "frequent-lines")
    spread = every.join(often, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("estimate"),
        F.min(F.struct("doc", "pos")).alias("first"))
    spread = written(spread.where(F.col("estimate") >= min_sites * (1 - band)), "line-spread")
    near = spread.where(F.col("estimate") <= min_sites * (1 + band))
    exact = (
        every.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("site").alias("n"))
        .where(F.col("n") >= min_sites).select("h1", "h2")
    )
    sure = spread.where(F.col("estimate") > min_sites * (1 + band))
    kept = near.join(exact, ["h1", "h2"], "left_semi")
    return sure.unionByName(kept).select(
        "h1", "h2", "estimate", F.col("first.doc").alias("first_doc"), F.col("first.pos").alias("first_pos"))


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                       lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and the columns
    ``n_lines`` (non-blank lines before) and ``n_removed``; clashing columns of the
    input are replaced.  Only line positions are shuffled to find what goes; texts
    move once, to meet their list of positions."""
    dropped, who = fresh(docs, "dropped"), fresh(docs, "who")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    # A row's key: rows equal in it hold the same lines at the same places, so they lose the same.
    key = F.struct(doc.alias("doc"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), F.col("text")).alias("t2"))
    marked = written(boilerplate(docs, site, min_sites, lg_k, band), "boilerplate")
    places = (
        docs.select(key.alias("who"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .withColumn("line", line_key(F.col("line"))).where("line <> ''")
        .select("who", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"))
    )
    gone = (
        places.join(marked, ["h1", "h2"])
        .where("who.doc <> first_doc OR pos <> first_pos")
        .groupBy("who").agg(F.collect_set("pos").alias(dropped)).withColumnRenamed("who", who)
    )
    drops = F.col(dropped)
    split = F.split(F.col("text"), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), drops)
    counted = F.size(F.filter(split, lambda x: line_key(x) != ""))
    other = [c for c in docs.columns if c.lower() not in ("text", "n_lines", "n_removed")]
    out = docs.withColumn(who, key).join(gone, who, "left")
    return out.select(
        *[F.col(f"`{c}`") for c in other],
        F.when(drops.isNull(), F.col("text")).otherwise(kept_lines(split, stay)).alias("text"),
        F.coalesce(counted, F.lit(0)).alias("n_lines"),
        F.coalesce(F.size(drops), F.lit(0)).alias("n_removed"),
    )


def kept_lines(split: Column, stay: Column) -> Column:
    """The lines at the places ``stay``, in order; the split is done once."""
    return F.transform(F.array(split), lambda s: F.array_join(F.transform(stay, lambda i: F.get(s, i)), "\n"))[0]
