"""Row numbers hold through an operator although file scans planned later are split
otherwise, as they are when executors come or go."""

import brute
import pytest
from pyspark.sql import functions as F

from monthwise.llm import common, mixing, simhash, warc

SPLITS = "spark.sql.files.minPartitionNum"


@pytest.fixture()
def resplit(spark, monkeypatch):
    """From the first written table on, scans are planned with one split instead of one per file."""
    def written(df, name):
        out = common.written(df, name)
        spark.conf.set(SPLITS, "1")
        return out
    for module in (simhash, mixing, warc):
        monkeypatch.setattr(module, "written", written)
    spark.conf.set(SPLITS, "64")
    yield
    spark.conf.unset(SPLITS)


def from_files(spark, df, workdir):
    df.repartition(6, df.columns[0]).write.parquet(workdir + "/files")
    return spark.read.parquet(workdir + "/files")


def corpus(spark):
    rows = [(d, f"text {d % 40} of words {d % 40 * 7} and {d % 40 * 13} more", "en", f"s{d % 5}") for d in range(120)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")


def test_keep_one(spark, workdir, resplit):
    rows, df = corpus(spark)
    got = simhash.keep_one(from_files(spark, df, workdir)).collect()
    want = {c for _, _, c in brute.simhash_components([r[:2] for r in rows])}
    assert sorted(r.doc_id for r in got) == sorted(want)


def test_mixed(spark, workdir, resplit):
    _, df = corpus(spark)
    want = sorted(map(tuple, mixing.mixed(df).collect()))                # no files: numbers can't change
    spark.conf.set(SPLITS, "64")
    got = sorted(map(tuple, mixing.mixed(from_files(spark, df, workdir)).collect()))
    assert got == want and len(got) > 50


def test_archives(spark, workdir, resplit):
    pages = [(p, f"http://h{p % 7}/{p}", f"body {p % 50}") for p in range(200)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    warc.write_archives(from_files(spark, df, workdir), workdir + "/w")
    got = warc.assemble(warc.read_records(spark, workdir + "/w")).collect()
    page = {r.capture: int(r.metadata[0].fields.split()[1]) for r in got}
    kept = {p % 50: p for p, _, _ in pages}                              # the greatest id of each payload
    assert sorted((page[r.capture], page.get(r.refers_to)) for r in got) == sorted(
        (p, None if kept[p % 50] == p else kept[p % 50]) for p, _, _ in pages)
    assert all(bytes(r.response.payload).decode() == f"body {page[r.capture] % 50}" for r in got if r.response)
