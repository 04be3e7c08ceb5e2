"""Operator 10: long names, and verdicts of URLs that the model has not learned from."""

import re

import pytest

pytest.importorskip("public_tokenizers")


def test_names_of_any_length(spark):
    from permitflow.llm.url_filter import judge
    long = "abcd" * 60_000
    pages = [(1, f"http://{long}.net/fr/", "abcd word"), (2, "http://a.com/" + "wordabcd" * 500, "word"), (3, f"http://x.org/{long}", None)]
    found = {r.page_id: r for r in judge(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert found[1].verdict == "block" and found[1].host == long + ".net" and found[1].words[:2] == ["h:abcd", "h:abcd"] and len(found[1].words) == 60_002
    assert found[2].words[2:6] == ["p:word", "p:abcd", "p:word", "p:abcd"] and len(found[3].words) == 60_002


def test_held_out_verdicts(spark):
    from pyspark.sql import functions as F
    from permitflow.llm.url_filter import judge
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    fold = F.crc32(F.col("page_id").cast("string")) % 4
    right = total = 0
    for k in (0, 1):
        held = judge(pages, teach=fold != k).filter((fold == k) & F.col("rule").isNotNull()).collect()
        right += sum((r.block_log_odds > 0) == (r.verdict == "block") for r in held)
        total += len(held)
    assert total >= 40 and right / total >= 0.95


def test_no_url_is_blocked_unread(spark):
    from permitflow.llm.url_filter import judge
    pages = [(i, f"http://a{i}.net/fr/casino", "x") for i in range(20)] + [(100, "http://b.com/news", "x"), (101, None, "x"), (102, "http://unseen.org/thing", ""), (103, "", None),
                                                                           (104, "http://c.org/casino", None), (104, "http://c.org/news", None)]
    df = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id bigint, url string, html string, verdict string, row int")
    found = [(r.page_id, r.verdict, re.sub(":.*", "", r.words[-1]) if r.words else None) for r in judge(df).collect() if r.page_id >= 100]
    assert sorted(found) == [(100, "allow", "p"), (101, "allow", None), (102, "allow", "p"), (103, "allow", None), (104, "allow", "p"), (104, "block", "p")]
