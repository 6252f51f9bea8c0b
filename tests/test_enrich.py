from inkline.operators.enrich import classify, keyword_classifier, sentiment_udf


def test_retry_bound_and_non_text(spark):
    def flaky_factory():
        """Answers None for a text on its first attempt, then a label."""
        seen = set()

        def batch(texts):
            out = []
            for t in texts:
                if t.startswith("retry") and t not in seen:
                    seen.add(t)
                    out.append(None)
                elif t.startswith("never"):
                    out.append(None)
                else:
                    out.append("Salud;Deportes")
            return out

        return batch

    df = spark.createDataFrame([(1, "retry me"), (2, "never answers"), (3, None), (4, "ok")],
                               "doc_id long, body string")
    got = {r.doc_id: (r.category_1, r.category_2) for r in classify(df, "body", flaky_factory).collect()}
    assert got == {1: ("Salud", "Deportes"), 2: (None, None), 3: (None, None), 4: ("Salud", "Deportes")}


def test_keyword_classifier_top_two():
    clf = keyword_classifier()
    assert clf(["El hospital y la vacuna; un partido de fútbol", "nada"]) == ["Salud;Deportes", "Otro"]


def test_sentiment_udf_stub(spark):
    df = spark.createDataFrame([("texto",), (None,)], "body string")
    rows = df.select(sentiment_udf()("body").alias("s")).collect()
    assert rows[0].s.sentiment == "NEU" and rows[0].s.pos == 0.5
    assert rows[1].s.sentiment is None


def test_exceptions_and_short_answers(spark):
    def factory():
        def batch(texts):
            if any(t == "bad" for t in texts):
                raise RuntimeError("no")
            return ["Salud"] * (len(texts) - (len(texts) > 1 and "short" in texts))
        return batch

    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "fine"), (4, None)], "doc_id long, body string").coalesce(1)
    got = {r.doc_id: (r.answer, r.answer_reason) for r in classify(df, "body", factory).collect()}
    assert got[1] == got[3] == ("Salud", None) and got[2] == (None, "RuntimeError: no") and got[4] == (None, "no_text")
    df = spark.createDataFrame([(1, "short"), (2, "x")], "doc_id long, body string").coalesce(1)
    assert [r.answer for r in classify(df, "body", factory).collect()] == ["Salud", "Salud"]


def test_whole_texts_and_one_column(spark):
    seen = "x" * 9000 + " vacuna"
    df = spark.createDataFrame([(1, seen, "other")], "doc_id long, body string, wide string")
    out = classify(df, "body")
    assert out.first().category_1 == "Salud" and classify(df, "body", max_chars=7500).first().category_1 == "Otro"
    assert "MapInPandas" not in out._jdf.queryExecution().executedPlan().toString()
