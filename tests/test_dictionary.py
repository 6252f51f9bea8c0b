import random

from pyspark.sql import functions as F

from inkline.operators import dictionary as DI


def brute(docs, terms):
    return {d: ", ".join(t for _, t in sorted(terms) if t and t in txt) for d, txt in docs}


def test_join_and_inline_agree_with_brute_force(spark):
    random.seed(3)
    alphabet = "abcá "
    docs = [(i, "".join(random.choice(alphabet) for _ in range(random.randint(0, 80)))) for i in range(60)]
    terms = [(i, "".join(random.choice(alphabet) for _ in range(random.randint(1, 6)))) for i in range(25)]
    ddf = spark.createDataFrame(docs, "doc_id long, text string")
    tdf = spark.createDataFrame(terms, "ord long, term string")
    want = brute(docs, terms)
    inline = {r.doc_id: r.m for r in ddf.select("doc_id", DI.join_matches(
        DI.match_inline(F.col("text"), [t for _, t in sorted(terms)])).alias("m")).collect()}
    joined = {r.doc_id: r.m for r in DI.match_by_join(ddf, tdf, out="m").collect()}
    assert inline == want and joined == want


def test_five_thousand_terms_of_any_length(spark):
    random.seed(5)
    texts = ["".join(random.choice("abcdé ") for _ in range(n)) for n in (0, 2, 511, 512, 513, 1500, 4000)]
    terms = []
    for i in range(5000):
        n, t = random.randint(3, 400), random.choice(texts[2:])
        at = random.randrange(max(1, len(t) - n + 1))
        terms.append((i, t[at:at + n] if i % 2 else "".join(random.choice("abcdé ") for _ in range(min(n, 9)))))
    docs = list(enumerate(texts))
    got = {r.doc_id: r.m for r in DI.match_by_join(spark.createDataFrame(docs, "doc_id long, text string"),
                                                   spark.createDataFrame(terms, "ord long, term string"), out="m").collect()}
    assert got == brute(docs, terms)


def test_equal_and_null_ids(spark):
    ddf = spark.createDataFrame([(1, "de Lota"), (1, "a Lota"), (None, "Lota"), (2, None), (3, "")], "doc_id long, text string")
    tdf = spark.createDataFrame([(1, "Lota"), (2, "a"), (2, "a"), (3, ""), (4, None)], "ord long, term string")
    rows = DI.match_by_join(ddf, tdf).collect()
    assert sorted((r.doc_id or 0, r.matches) for r in rows) == [(0, "Lota, a"), (1, "Lota, a"), (1, "Lota, a"), (2, ""), (3, "")]
    assert DI.match_by_join(ddf, tdf.limit(0)).filter("matches <> ''").count() == 0


def test_no_text_is_shuffled(spark):
    ddf = spark.createDataFrame([(1, "de Lota")], "doc_id long, text string").repartition(2)
    tdf = spark.createDataFrame([(1, "Lota")], "ord long, term string")
    plan = DI.match_pairs(ddf, tdf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [text#" not in plan and "hashpartitioning(text#" not in plan


def test_substring_semantics_are_case_and_accent_sensitive(spark):
    ddf = spark.createDataFrame([(1, "Vivo en Maipú y en la florida")], "doc_id long, text string")
    r = ddf.select(DI.join_matches(DI.match_inline(F.col("text"), ["La Florida", "Maipú", "Maipu", "Ñuñoa"]))).first()
    assert r[0] == "Maipú"


def test_places_from_a_table_in_the_article_plan(spark):
    """5,000 places through the article plan: what ``match_inline`` gives, with no expression a term."""
    import random

    from inkline.operators import word_tables as W
    from inkline.plans import queries as Q
    from inkline.plans.articles import articles

    pages = Q.dated_pages(spark, "/root/testdata/sf0.001")
    plain = articles(pages, Q.DRIVER_PAGES, Q.AS_OF_PAGES)
    texts = [r.body for r in plain.select("body").collect()]
    rnd = random.Random(2)
    terms = sorted({w for t in texts for w in t.split() if len(w) > 2} | {t[i:i + n] for t in texts if len(t) > 60 for i, n in [(rnd.randrange(len(t) - 30), rnd.randint(1, 30))]})
    terms = (terms + [f"nowhere{i}" for i in range(5000)])[:5000]
    rnd.shuffle(terms)
    places = spark.createDataFrame([*enumerate(terms), (9999, ""), (9998, None)], "ord long, term string")
    df = articles(pages, Q.DRIVER_PAGES, Q.AS_OF_PAGES, places=places)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "nowhere" not in plan and terms[0] not in plan
    got = {r.page_id: r.comunas for r in df.collect()}
    body = {r.page_id: r.body for r in plain.collect()}
    assert got == {i: ", ".join(t for t in terms if t in x) for i, x in body.items()} and any(got.values())
    few = spark.createDataFrame([(2, "que"), (1, "und")], "ord long, term string")
    rows = spark.createDataFrame([(1, "und que"), (2, None), (3, "")], "i int, body string")
    assert [r.comunas for r in W.with_matches(rows, few).orderBy("i").collect()] == ["und, que", "", ""]


def test_stopwords_from_a_table(spark, monkeypatch):
    """A large stopword table gives what the list gives; null, empty and repeated texts; a million words run."""
    from inkline.functions import text as T
    from inkline.operators import word_tables as W
    from inkline.plans.articles import enrich

    texts = ["La casa de la señora y la casa.", "De de de", None, "", "sin-palabras 12 x", "La casa de la señora y la casa."]
    rows = spark.createDataFrame([(i, t, t, "La " + t if t else t) for i, t in enumerate(texts)], "i int, title string, subtitle string, body string")
    listed = enrich(rows).orderBy("i").collect()
    table = spark.createDataFrame([(w,) for w in T.DEFAULT_STOPWORDS] + [(None,), ("de",)], "word string")
    assert enrich(rows, stopwords=table).orderBy("i").collect() == listed
    monkeypatch.setattr(W, "INLINE_WORDS", 3)
    assert enrich(rows, stopwords=table).orderBy("i").collect() == listed
    monkeypatch.setattr(W, "FEW", 0)
    assert enrich(rows, stopwords=table).orderBy("i").collect() == listed
    monkeypatch.setattr(W, "BROADCAST_WORDS", 3)
    assert enrich(rows, stopwords=table).orderBy("i").collect() == listed
    monkeypatch.undo()
    many = spark.range(1_000_000).selectExpr("concat('palabra', id) AS word").unionByName(table)
    assert enrich(rows, stopwords=many).orderBy("i").collect() == listed


def test_words_without_many_stopwords(spark):
    """The sorted pass equals a plain filter on random words, over block edges too."""
    import random

    from pyspark.sql import functions as F

    from inkline.operators import word_tables as W

    rnd = random.Random(6)
    rows = [([rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(rnd.randint(0, 300))], sorted({rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(n)})) for n in (0, 3, 17, 40, 64, 200)]
    df = spark.createDataFrame([*rows, (["a"], None)], "words array<string>, own array<string>")
    got = [r.w for r in df.select(W.without(F.col("words"), F.col("own")).alias("w")).collect()]
    assert got == [[w for w in words if w not in own] for words, own in rows] + [["a"]]
