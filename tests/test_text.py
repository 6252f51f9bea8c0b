from pyspark.sql import functions as F

from inkline.functions import text as T
from conftest import one


def test_clean_text_deletes_newlines_and_strips(spark):
    assert one(spark, lambda c: T.clean_text(F.col(c)), "  a\nb  \n") == "ab"


def test_tokeniser_rule(spark):
    s = "Hola, covid-19 y gob.cl: ¿Qué «eso» a,b 10:30 fin. Otra (vez)... ya"
    got = one(spark, lambda c: T.normalize_text(F.col(c), stopwords=()), s)
    assert got == "hola y eso a b fin otra vez ya"


def test_stopwords_keep_duplicates(spark):
    got = one(spark, lambda c: T.normalize_text(F.col(c), stopwords=("de",)), "casa de casa de la")
    assert got == "casa casa la"


def test_normalize_null_stays_null(spark):
    assert one(spark, lambda c: T.normalize_text(F.col(c)), None) is None


def test_keyphrase_flag(spark):
    assert one(spark, lambda c: T.keyphrase_flag(F.col(c)), "El Gobernador Orrego dijo") == 1
    # accents are not folded: the phrase list is unaccented
    assert one(spark, lambda c: T.keyphrase_flag(F.col(c)), "gobernador de la región metropolitana") == 0
    assert one(spark, lambda c: T.keyphrase_flag(F.col(c)), None) == 0


def test_build_prompt_truncates(spark):
    got = one(spark, lambda c: T.build_prompt(F.col(c)), "x" * 9000)
    assert got.endswith("x" * 7500) and len(got) == len(T.PROMPT_INSTRUCTION + T.PROMPT_BASE) + 7500


TRUTH = [
    ("Salud", ("Salud", None)),
    (" Salud ", ("Salud", None)),
    ("Foo", ("Otro", None)),
    ("Movilidad;Salud", ("Movilidad", "Salud")),
    ("Movilidad; Salud", ("Movilidad", "Salud")),
    ("Salud;Deportes;Economía", ("Salud", "Deportes")),
    ("Salud;Salud", ("Salud", None)),
    ("Foo;Bar", ("Otro", None)),
    (None, (None, None)),
]


def test_parse_labels_truth_table(spark):
    df = spark.createDataFrame([(a,) for a, _ in TRUTH], "a string")
    rows = df.select("a", T.parse_labels(F.col("a")).alias("l")).collect()
    got = {r["a"]: (r["l"]["category_1"], r["l"]["category_2"]) for r in rows}
    for a, want in TRUTH:
        assert got[a] == want, a


def test_parse_labels_strict_reference(spark):
    df = spark.createDataFrame([("Movilidad; Salud",)], "a string")
    r = df.select(T.parse_labels(F.col("a"), strict_reference=True).alias("l")).first()["l"]
    assert (r["category_1"], r["category_2"]) == ("Movilidad", "Otro")


def test_sentiment_stub(spark):
    r = one(spark, lambda c: T.sentiment_default(F.col(c)), "texto")
    assert (r["sentiment"], r["pos"], r["neu"], r["neg"]) == ("NEU", 0.5, 0.5, 0.5)
    r = one(spark, lambda c: T.sentiment_default(F.col(c)), None)
    assert r["sentiment"] is None and r["pos"] is None
