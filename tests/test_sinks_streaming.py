import os
import tempfile

from pyspark.sql import functions as F

from inkline.plans import queries as Q
from inkline.sources import sinks as K
from inkline.sources.tables import conform_articles
from inkline.streaming import articles as ST

SF = "/root/testdata/sf0.001"


def test_csv_round_trip(spark):
    arts = Q.flagship(spark, SF)
    path = os.path.join(tempfile.mkdtemp(prefix="inkline-csv-"), "out")
    K.write_csv(arts, path)
    back = K.read_csv(spark, path)
    assert back.count() == arts.count()
    assert set(back.columns) == set(K.CSV_COLUMNS) | {"source"}
    assert back.filter(F.col("pred_1").isNotNull()).count() == 0


def test_idempotent_append_twice(spark):
    arts = Q.flagship(spark, SF)
    path = os.path.join(tempfile.mkdtemp(prefix="inkline-tbl-"), "news")
    K.idempotent_append(arts, path)
    K.idempotent_append(arts, path)
    assert spark.read.parquet(path).count() == arts.count()


def test_append_duplicates_on_a_rerun(spark):
    arts = conform_articles(spark.createDataFrame([("t", "m", "u")], "title string, media string, url string"))
    path = os.path.join(tempfile.mkdtemp(prefix="inkline-app-"), "news")
    K.append_table(arts, path)
    K.append_table(arts, path)
    assert spark.read.parquet(path).count() == 2


def test_conform_fills_and_orders(spark):
    df = spark.createDataFrame([("t", "x")], "title string, extra string")
    out = conform_articles(df)
    assert out.columns[:2] == ["title", "subtitle"] and "extra" not in out.columns
    assert out.schema["gore"].dataType.simpleString() == "int"


def test_conform_casts(spark):
    df = spark.createDataFrame([("0.25", "1", "2024-01-02 03:04:05")], "pos string, gore string, published_at string")
    r = conform_articles(df).first()
    assert r.pos == 0.25 and r.gore == 1 and str(r.published_at) == "2024-01-02 03:04:05" and r.title is None


def test_stream_equals_batch(spark):
    streamed = Q.stream_articles(spark, SF)
    batch = Q.QUERIES["stream_articles"]  # same key; compare against batch extraction + enrichment
    from inkline.operators.builtin_profiles import DRIVER_PAGES
    from inkline.plans.articles import enrich
    from inkline.operators.profiles import parsed
    b = enrich(parsed(Q.dated_pages(spark, SF), DRIVER_PAGES), Q.FLAGSHIP_PLACES).select("page_id", "clean_body")
    assert sorted(streamed.select("page_id", "clean_body").collect()) == sorted(b.collect())
    assert batch is not None


def stream_of(spark, batches, schema):
    src = os.path.join(tempfile.mkdtemp(prefix="inkline-stream-"), "in")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    return ST.read_page_stream(spark, src, schema, max_files_per_trigger=1), src + "-out"


def test_caps_across_batches(spark):
    batches = [[(m, i) for m in "abc" for i in rng] for rng in (range(0, 6), range(6, 12))]
    stream, out = stream_of(spark, batches, "media string, crawl_seq long")
    ST.run_sink(stream, ST.capped_sink(out, {"a": 4, "b": 8}))
    got = spark.read.parquet(out)
    assert sorted(r.crawl_seq for r in got.filter("media = 'a'").collect()) == [0, 1, 2, 3]
    assert sorted(r.crawl_seq for r in got.filter("media = 'b'").collect()) == list(range(8))
    assert got.filter("media = 'c'").count() == 12      # no cap: every row, as in batch


def test_prefix_stop_across_batches(spark):
    batches = [[("a", 0, False), ("a", 1, True), ("a", 2, False), ("b", 0, True), ("b", 1, False)], [("a", 3, False), ("b", 2, False)]]
    stream, out = stream_of(spark, batches, "media string, crawl_seq long, stale boolean")
    ST.run_sink(stream, ST.capped_sink(out, {"a": 9, "b": 9}, F.col("stale"), stop=["a"]))
    assert sorted((r.media, r.crawl_seq) for r in spark.read.parquet(out).collect()) == [("a", 0), ("b", 0), ("b", 1), ("b", 2)]


def test_stream_sink_is_idempotent(spark):
    batches = [[("u1", 1), ("u1", 2), ("u2", 1)], [("u2", 0), ("u3", 1)]]
    stream, out = stream_of(spark, batches, "url string, n int")
    sink = ST.idempotent_sink(out)
    ST.run_sink(stream, sink)
    sink(spark.createDataFrame(batches[0], "url string, n int"), 7)  # a batch that comes again
    assert sorted((r.url, r.n) for r in spark.read.parquet(out).select("url", "n").collect()) == [("u1", 1), ("u2", 1), ("u3", 1)]


def test_fresh_at_fetch(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:01", "2024-01-03 00:00:00"), (2, "2024-01-01 00:00:00", "2024-01-03 00:00:00"), (3, "2024-02-01 00:00:00", "2024-01-03 00:00:00")],
                               "i int, p string, f string").select("i", F.col("p").cast("timestamp_ntz").alias("published_at"), F.col("f").cast("timestamp").alias("fetched_at"))
    assert sorted(r.i for r in ST.fresh_at_fetch(df).collect()) == [1, 3]


def test_multi_file_page_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    sf = tempfile.mkdtemp(prefix="inkline-sf-")
    pages.repartition(3).write.parquet(f"{sf}/pages.parquet")
    assert Q.stream_articles(spark, sf).count() == pages.count()


def test_sinks_in_order(spark):
    from inkline.operators.builtin_profiles import DRIVER_PAGES
    from inkline.operators.enrich import keyword_classifier
    from inkline.plans.articles import run_sinks
    base = tempfile.mkdtemp(prefix="inkline-k4-")
    run_sinks(Q.dated_pages(spark, SF), DRIVER_PAGES, Q.AS_OF_PAGES, f"{base}/csv", f"{base}/table", classifier=keyword_classifier)
    csv, table = K.read_csv(spark, f"{base}/csv"), spark.read.parquet(f"{base}/table")
    assert csv.count() == table.count() > 0
    assert csv.filter("category_1 <> ''").count() == 0      # written before categories are filled
    assert table.filter("category_1 IS NULL").count() == 0


def test_utf8_csv(spark):
    rows = spark.createDataFrame([("ñandú “x”\nlínea, \"dos\"", "m")], "title string, media string")
    path = os.path.join(tempfile.mkdtemp(prefix="inkline-utf8-"), "out")
    K.write_csv(conform_articles(rows), path)
    assert K.read_csv(spark, path).first().title == "ñandú “x”\nlínea, \"dos\""
    assert any("ñandú".encode() in open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(path) for f in fs if f.endswith(".csv"))


def test_dictionary_stopword_and_seed_sources(spark):
    from inkline.operators.builtin_profiles import REGISTRY
    from inkline.sources.tables import read_dictionary, read_stopwords, seeds_frame
    base = tempfile.mkdtemp(prefix="inkline-src-")
    with open(f"{base}/d.csv", "w", encoding="utf-8") as f:
        f.write("ord,term\n2,Lota\n1,Maipú\n")
    with open(f"{base}/s.txt", "w", encoding="utf-8") as f:
        f.write("de\n la \n\nde\n")
    assert [tuple(r) for r in read_dictionary(spark, f"{base}/d.csv").orderBy("ord").collect()] == [(1, "Maipú"), (2, "Lota")]
    assert sorted(r.word for r in read_stopwords(spark, f"{base}/s.txt").collect()) == ["de", "la"]
    seeds = seeds_frame(spark, {m: p.seeds for m, p in REGISTRY.items()})
    assert seeds.select("media").distinct().count() == 9


def test_dedup_stream(spark):
    base = tempfile.mkdtemp(prefix="inkline-dedup-")
    src = os.path.join(base, "in")
    spark.createDataFrame([("https://s.cl/a#x", "2024-01-01 00:00:00"), ("https://s.cl/a", "2024-01-01 01:00:00"),
                           ("https://s.cl/b", "2024-01-01 02:00:00")], "url string, t string") \
        .select("url", F.col("t").cast("timestamp").alias("fetched_at")).write.parquet(src)
    stream = spark.readStream.schema("url string, fetched_at timestamp").parquet(src)
    got = spark.read.parquet(ST.run_available(ST.dedup_stream(stream)))
    assert got.count() == 2


def test_caps_in_the_state_store(spark):
    """Many small batches with a restart between them give the rows of the batch operators; a batch's time doesn't grow."""
    import random
    import time

    rnd, base = random.Random(4), tempfile.mkdtemp(prefix="inkline-state-")
    caps, stop = {"a": 12, "b": 40, "hot": 25}, ["b", "s"]
    rows, seq = [], 0
    for batch in range(24):
        part = []
        for m in rnd.choices(["a", "b", "s", "free", "hot", "hot", None], k=14):
            seq += 1
            part.append((m, seq, m in ("b", "s") and seq > 150 and rnd.random() < 0.3, f"x{seq}"))
        rnd.shuffle(part)
        rows.append(part)
    schema = "media string, crawl_seq long, stale boolean, x string"

    def land(batches):
        for k in batches:
            spark.createDataFrame(rows[k], schema).coalesce(1).write.parquet(f"{base}/in/b={k:03}")
            time.sleep(0.01)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{base}/in")
        out = ST.capped_stream(stream, caps, F.col("stale"), stop)
        q = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start()
        q.awaitTermination()
        return [p["batchDuration"] for p in map(lambda x: x if isinstance(x, dict) else __import__("json").loads(x.json), q.recentProgress) if p["numInputRows"]]

    land(range(10))
    times = run()
    land(range(10, 24))
    times += run()
    got = sorted((r.media or "", r.crawl_seq, r.x) for r in spark.read.schema(schema).parquet(f"{base}/out").collect())
    from inkline.operators import limits as L

    whole = spark.createDataFrame([r for part in rows for r in part], schema)
    want = L.prefix_stop(L.cap_rows(whole, caps), F.col("stale") & F.col("media").isin(*stop))
    assert got == sorted((r.media or "", r.crawl_seq, r.x) for r in want.collect())
    assert len(times) == 24 and sorted(times[-8:])[4] < 3 * sorted(times[2:10])[4]


def test_unseen_keys_read_no_old_key(spark, monkeypatch):
    """The bit arrays tell unseen keys; only folders that may hold a key are read; NULL is a key; a full array stays exact."""
    path = os.path.join(tempfile.mkdtemp(prefix="inkline-keys-"), "t")
    rows = lambda lo, hi: spark.range(lo, hi).selectExpr("concat('u', id) AS url", "id AS n")
    assert K.append_new(rows(0, 300), path).count() == 300
    read, true = [], K.keys_in
    monkeypatch.setattr(K, "keys_in", lambda *a: read.append(a[-1]) or true(*a))
    assert K.append_new(rows(300, 400), path).count() == 100 and sum(map(len, read)) <= 3
    read.clear()
    extra = spark.createDataFrame([("u5", -1), ("u5", -2), (None, 1), (None, 0), ("new", 1)], "url string, n long")
    assert sorted((r.url or "", r.n) for r in K.append_new(extra, path).collect()) == [("", 0), ("new", 1)]
    assert 1 <= sum(map(len, read)) <= 3
    assert K.append_new(extra, path).count() == 0
    assert spark.read.parquet(path).count() == 402
    monkeypatch.setattr(K, "FOLDER_BITS", 64)      # arrays that say yes to nearly everything
    other = os.path.join(tempfile.mkdtemp(prefix="inkline-keys-"), "t")
    assert K.append_new(rows(0, 3000), other).count() == 3000 and K.append_new(rows(1500, 4500), other).count() == 1500


def test_key_filter_generations(spark, monkeypatch):
    """Parts of the bit arrays are combined; a generation that isn't complete doesn't count."""
    monkeypatch.setattr(K, "GENERATION", 2)
    path = os.path.join(tempfile.mkdtemp(prefix="inkline-gen-"), "t")
    for k in range(5):
        batch = spark.createDataFrame([(f"u{k}",), (f"u{k - 1}",)], "url string")
        assert K.append_new(batch, path).count() == (2 if k == 0 else 1)
    gens = sorted(os.listdir(f"{path}_keys"))
    assert len(gens) > 1 and spark.read.parquet(path).count() == 6
    os.makedirs(f"{path}_keys/gen=99/base")
    assert K.KeyFilter(spark, path)._generation() == int(gens[-1][4:])
    assert K.append_new(spark.createDataFrame([("u0",), ("x",)], "url string"), path).count() == 1
