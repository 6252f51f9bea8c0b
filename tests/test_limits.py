import random

from pyspark.sql import functions as F

from inkline.operators import limits as L


def test_prefix_stop_versus_recency(spark):
    # crawl order: fresh, fresh, stale, fresh
    df = spark.createDataFrame([("m", 1, False), ("m", 2, False), ("m", 3, True), ("m", 4, False)],
                               "media string, crawl_seq long, stale boolean")
    prefix = L.prefix_stop(df, F.col("stale"))
    assert sorted(r.crawl_seq for r in prefix.collect()) == [1, 2]
    assert df.filter(~F.col("stale")).count() == 3


def test_cap_counts_stale_rows(spark):
    rows = [("m", i, i in (2, 3)) for i in range(1, 8)]
    df = spark.createDataFrame(rows, "media string, crawl_seq long, stale boolean")
    out = L.cap_then_recency(df, {"m": 4}, ~F.col("stale"))
    assert sorted(r.crawl_seq for r in out.collect()) == [1, 4]


def test_top_n_on_a_hot_key_matches_brute_force(spark):
    random.seed(7)
    rows = [("hot", random.randint(0, 10**9)) for _ in range(3000)] + [(f"s{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "media string, crawl_seq long")
    got = sorted((r.media, r.crawl_seq) for r in L.top_n(df, "media", "crawl_seq", 25, salt_buckets=8).collect())
    want = sorted([("hot", s) for s in sorted(s for m, s in rows if m == "hot")[:25]] +
                  [(m, s) for m, s in rows if m != "hot"])
    assert got == want


def test_twin_cap(spark):
    rows = [("e", i, i % 3 == 0) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "media string, crawl_seq long, item boolean")
    out = L.twin_cap(df, 50, 30, F.col("item")).collect()
    assert sorted(r.crawl_seq for r in out) == [i for i in range(1, 51) if i % 3 == 0]


def test_uncapped_source_keeps_everything(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(10)],
                               "media string, crawl_seq long")
    out = L.source_cap(df, {"a": 3})
    assert out.filter("media = 'a'").count() == 3 and out.filter("media = 'b'").count() == 10


def test_source_counts(spark):
    df = spark.createDataFrame([("a", "parsed"), ("a", "rejected"), ("b", "filtered")], "media string, status string")
    got = {r.media: (r.n_rows, r.n_parsed, r.n_filtered, r.n_rejected) for r in L.source_counts(df).collect()}
    assert got == {"a": (2, 1, 0, 1), "b": (1, 0, 1, 0)}


def test_large_cap_limits_before_the_exchange(spark):
    df = spark.range(20000).selectExpr("'hot' AS media", "id AS crawl_seq", "id % 7 AS x", "repeat('wide', 20) AS wide")
    with L.group_limit(spark, 5001):
        plan = L.first_places(df, 5000, "media", "crawl_seq", None, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan and "wide" not in plan.split("Range")[0].replace("repeat", "")
    before = spark.conf.get(L.LIMIT_CONF)
    out = L.top_n(df, "media", "crawl_seq", 5000, salt_buckets=2)
    assert spark.conf.get(L.LIMIT_CONF) == before
    assert sorted(r.crawl_seq for r in out.collect()) == list(range(5000))


def test_cut_offs_with_equal_places(spark):
    """Exactly ``cap`` rows stay where rows can't be told apart, for any number of equal ones around the cut."""
    random.seed(3)
    rows = [(m, random.choice([None, 1, 2, 3, 4]), i) for m in ("a", "b", None) for i in range(random.randint(5, 60))]
    df = spark.createDataFrame(rows, "media string, crawl_seq long, x long").repartition(5)
    for cap in (1, 3, 17, 200):
        out = L.cap_rows(df, cap).collect()
        for m in ("a", "b", None):
            want = sorted([(r[1] is not None, r[1] or 0) for r in rows if r[0] == m])[:cap]
            assert sorted((r.crawl_seq is not None, r.crawl_seq or 0) for r in out if r.media == m) == want
    got = L.source_cap(df, {"a": 4, "b": 0}).collect()
    assert sorted(r.rn for r in got if r.media == "a") == [1, 2, 3, 4] and not [r for r in got if r.media == "b"]
    assert sum(r.media is None for r in got) == sum(r[0] is None for r in rows)


def test_caps_shuffle_nothing_wide(spark):
    """The wide rows meet a broadcast of one row per source; uncapped sources bypass the rank window."""
    df = spark.range(3000).selectExpr("id % 3 AS s", "id AS crawl_seq", "repeat('x', 50) AS wide").selectExpr("concat('m', s) AS media", "crawl_seq", "wide")
    plan = L.cap_rows(df, {"m0": 10, "m1": 20})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Sort" not in plan
    free = L.source_cap(df, {"m0": 10}).filter("media = 'm2'").count()
    assert free == 1000


def test_ties_go_by_the_tiebreak(spark):
    df = spark.createDataFrame([("a", 1, i) for i in range(20)], "media string, crawl_seq long, page_id long")
    assert sorted(r.page_id for r in L.source_cap(df, {"a": 3}, tiebreak="page_id").collect()) == [0, 1, 2]


def test_source_cap_keeps_null_and_free_sources(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [(None, 1), ("b", 2)], "media string, crawl_seq long")
    out = L.source_cap(df, {"a": 3})
    assert sorted((r.media or "", r.rn or 0) for r in out.collect()) == [("", 0), ("a", 1), ("a", 2), ("a", 3), ("b", 0)]


def test_prefix_stop_sources(spark):
    df = spark.createDataFrame([(m, i, (m, i) == ("a", 3)) for m in "ab" for i in range(6)], "media string, crawl_seq long, stale boolean")
    out = L.prefix_stop(df, F.col("stale"))
    assert sorted((r.media, r.crawl_seq) for r in out.collect()) == [("a", i) for i in range(3)] + [("b", i) for i in range(6)]


def test_prefix_stop_keeps_rows_without_a_place(spark):
    df = spark.createDataFrame([("a", None, False), ("a", 1, False), ("a", 2, True), ("a", 3, False), ("b", None, True), ("b", 1, False), (None, 1, True), (None, 0, None)],
                               "media string, crawl_seq long, stale boolean")
    assert sorted(((r.media, r.crawl_seq) for r in L.prefix_stop(df, F.col("stale")).collect()), key=str) == [("a", 1), ("a", None), (None, 0)]
